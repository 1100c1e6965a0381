"""The methods below the queries, against brute force and the library."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.llm import bpe_codec, char_model, decontaminate, kneser_ney, labelled, pretokens, quality_model
from gaugeline.llm import quality_rules, secret_scan, simhash, token_counts, token_files, toxicity, trigrams
from gaugeline.llm.arrays import packed, unpacked
from gaugeline.llm.components import connected_components, forest
from gaugeline.operators.stage import stage
from tests.llm import brute

BITS = ["a", "bc", "é", "1", "22", " ", "  ", "\n", "'", "'s", "'re", "'LL", "!", "日", "́", "🙂", "the ", "<|endoftext|>"]
hard_text = st.lists(st.sampled_from(BITS), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(hard_text, st.text(max_size=60)), max_size=6))
def test_pretokens_give_the_library_s_ids(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, counts = pretokens.encoder_for(path).encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
    assert [p.tolist() for p in parts] == [brute.encoded(path, t) for t in texts]


@settings(max_examples=120, deadline=None)
@given(hard_text, st.integers(3, 30), st.sampled_from([1, 2, 16]))
def test_joined_halves_equal_the_whole(text, leaf, window):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = pretokens.encoder_for(path)
    parts = [bpe_codec.encode_part(t, encoder) for t in bpe_codec.halves(text, leaf)]
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [bpe_codec.join_parts(*p, encoder, window) if len(p) == 2 else p[0] for p in pairs]
    assert parts[0].ids.tolist() == brute.encoded(path, text)


def test_unsplit_text_through_leaves(spark, tokenizer):
    texts = ["ab" * 900, " " * 700 + "x" * 900, "the cat's " * 300, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe_codec.encode_documents(docs, tokenizer, leaf_chars=100).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == brute.encoded(tokenizer, texts[r.doc_id])


def test_broken_bytes_decode_as_in_the_library(tokenizer):
    ids = np.array([brute.encoded(tokenizer, "日")[0], 65])
    known = pretokens.load_vocabulary(tokenizer)
    assert bpe_codec.decode_ids(ids, known) == brute.library(tokenizer).decode(ids.tolist(), skip_special_tokens=False)


def test_counts_when_nothing_is_remembered(spark, hard, tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_PIECES", 0)
    rows = token_counts.count_tokens(hard, tokenizer, buckets=3, batch_chars=1000).collect()
    expected = sorted(len(brute.encoded(tokenizer, r.text)) for r in hard.collect())
    assert sorted(r.n_tokens for r in rows) == expected


@given(st.lists(st.integers(0, 2**63), max_size=50))
def test_packed(values):
    assert unpacked(packed(np.array(values, np.uint64))).tolist() == values


@settings(deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), min_size=1, max_size=9000))
def test_blocks_round_trip(ids):
    counts = np.array([1, len(ids) - 1])
    image = np.frombuffer(token_files.file_image(np.array([3, 9]), counts, np.array(ids, np.uint32)), np.uint8)
    index, read = token_files.read_documents(image)
    assert read.tolist() == ids and index["count"].tolist() == counts.tolist()
    assert token_files.read_document(image, 9).tolist() == ids[1:]


EXAMPLES = {
    "assign": ["password: abcdefghijkl", "API_KEY=0123456789ab", 'Token"="x"', "apikey = zzzzzzzzzzzz"],
    "access": ["AKIA" + "Z" * 14],
    "pem": ["-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"],
    "hub": ["ghp_" + "a" * 36],
    "chat": ["xoxb-1234567890"],
    "cloud": ["AIza" + "b" * 35],
    "jwt": ["eyJabcdefgh.eyJabcdefgh.abcdefgh"],
}


def holds(query, text: str) -> bool:
    if isinstance(query, tuple):
        return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])
    return query is True or query in text.lower()


def test_trigram_queries_hold_for_matches():
    rules = {r.kind: r for r in secret_scan.RULES}
    for kind, texts in EXAMPLES.items():
        query = trigrams.trigram_query(rules[kind].pattern)
        assert query is not True
        assert all(holds(query, t) for t in texts) and not holds(query, "nothing of the sort")
    assert trigrams.trigram_query(rules["hex"].pattern) is True


@pytest.mark.parametrize(
    "pattern, query",
    [
        ("abc", "abc"),
        ("ab.cd", True),
        ("abcd", ("and", ("abc", "bcd"))),
        ("(abc|abd)x?", ("or", ("abc", "abd"))),
        ("abc*", True),
        ("(abc)+", "abc"),
        ("a{3}", "aaa"),
        ("(?i)ABC", "abc"),
    ],
)
def test_trigram_queries(pattern, query):
    assert trigrams.trigram_query(pattern) == query


def test_secrets_with_every_kind_and_redaction(spark):
    texts = [t for group in EXAMPLES.values() for t in group] + ["🙂 password='aaaaaaaaaaaa' 🙂 deadbeefdeadbeef"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.find_secrets(docs, name="s")
    rows = {r.doc_id: r for r in found.select("*", secret_scan.redacted(found.text, found.s).alias("out")).collect()}
    rules = {r.kind: r for r in secret_scan.RULES}
    for i, text in enumerate(texts):
        expected = set()
        for rule in rules.values():
            for m in re.finditer(rule.pattern, text, re.ASCII):
                if len(m[rule.group]) >= rule.least:
                    expected.add((m.start(), m.end(), rule.kind))
        assert {(s.start, s.end, s.kind) for s in rows[i].s} == expected
    assert rows[len(texts) - 1].out == "🙂 [SECRET] 🙂 [SECRET]".replace("[SECRET] 🙂", "[SECRET]' 🙂")


def test_contamination_spans_and_many_automata(spark):
    texts = ["Ünï a-B c, d e! tail", "x a b c d e", "a b c", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "A b c D e"), (2, "d e")], "item_id long, text string")
    one = decontaminate.write_windows(bench)
    many = decontaminate.write_windows(bench, shard_chars=3)
    assert len(one) == 1 and len(many) > 1
    found = decontaminate.scan_texts(texts, one)
    assert found == decontaminate.scan_texts(texts, many)
    assert [(s["start"], s["end"]) for s in found[0][3]] == [(4, 14)]
    assert texts[0][4:14] == "a-B c, d e" and found[1][2] == ["1", "2"] and found[2][1] == 0


def close_prints(n: int, seed: int) -> np.ndarray:
    draw = random.Random(seed)
    out = [draw.getrandbits(64) for _ in range(n)]
    for i in range(n):
        flips = sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 6)))
        out.append(draw.choice(out) ^ flips)
    return np.array(sorted(set(out)), np.uint64)


def test_bk_trees_find_all_pairs():
    values = close_prints(300, 1)
    keys = np.zeros(len(values), np.int64)
    keys[len(values) // 3 :] = 7
    found = {(int(a), int(b)) for q, n in simhash.BKForest(keys, values).within(3) for a, b in zip(q, n)}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    same = keys[:, None] == keys[None, :]
    expected = {(i, j) for i, j in zip(*np.nonzero((apart <= 3) & same)) if j < i}
    assert found == expected and len(expected) > 50


@pytest.mark.parametrize("shard_rows", [20_000, 1])
def test_near_links_connect_what_is_near(spark, shard_rows):
    """Large shards are dealt again; with a limit of one row, all of them are."""
    values = close_prints(400, 2)
    rows = [(int(v), i) for i, v in enumerate(values.view(np.int64))]
    links = simhash.near_links(spark.createDataFrame(rows, "bits long, doc long"), shard_rows)
    pairs = np.array([(r.u, r.v) for r in links.collect()])
    roots = forest(pairs[:, 0], pairs[:, 1], len(values)).tolist()
    assert roots == brute.components(values.tolist(), list(range(len(values))))


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(500), draw.randrange(500)) for _ in range(420)]
    pairs += [(i, i + 1) for i in range(600, 700)] + [(1000, i) for i in range(1001, 1300)]
    found = connected_components(spark.createDataFrame(pairs, "u long, v long").repartition(8))
    names = sorted({x for p in pairs if p[0] != p[1] for x in p})
    place = {x: i for i, x in enumerate(names)}
    a, b = (np.array([place[p[k]] for p in pairs if p[0] != p[1]]) for k in (0, 1))
    roots = forest(a, b, len(names))
    assert {r.vertex: r.component for r in found.collect()} == {x: names[roots[i]] for x, i in place.items()}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_ablation_counts(spark, tiny_dir):
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet")
    rows = quality_rules.ledger(docs)
    masks = [r.failures for r in rows.collect()]
    policy = quality_rules.policy_mask("v1")
    names = [name for name, _ in quality_rules.RULES]
    report = {r.rule: r for r in quality_rules.ablation(rows, "v1").collect()}
    assert set(report) == set(quality_rules.POLICIES["v1"])
    for name, r in report.items():
        bit = 1 << names.index(name)
        assert r.failed == sum(bool(m & bit) for m in masks)
        assert r.only_it == sum(m & policy == bit for m in masks)
        assert r.kept == sum(m & policy == 0 for m in masks)


def test_rules_stay_native(spark, sf_dir):
    from gaugeline.llm.queries import QUERIES

    for name in ("op1_quality_rules", "op5_secret_scan"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.fixture(scope="module")
def chars(spark):
    words = "you are a stupid moron an idiot and a clown or loser that is trash scum pathetic worthless disgusting "
    docs = spark.createDataFrame([(words * 40,), (None,)], "text string")
    counts = {r.code: r.times for r in char_model.count_trigrams(docs).collect()}
    return char_model.CharModel(counts)


@pytest.mark.parametrize(
    "written, plain",
    [
        ("1d10t", "idiot"),
        ("St*pid", "stupid"),
        ("m0r0n!!", "moron!!"),
        ("stuuuupid", "stupid"),
        ("i d i o t", "idiot"),
        ("m.o.r.o.n", "moron"),
        ("w0rthle$$", "worthless"),
        ("plain text, as it was!", "plain text, as it was!"),
        ("on*** er### 12345", "on*** er### 12345"),
        ("", ""),
        (None, ""),
    ],
)
def test_disguises_are_undone(chars, written, plain):
    assert char_model.restore(written, chars) == plain


def test_viterbi_finds_the_best_reading(chars):
    """Against all readings of the lattice, scored one by one."""
    import itertools

    for span in ("1d10t", "tr4sh", "cl0wn", "l0o0oser"):
        columns = char_model.lattice(span, False)

        def score(path) -> float:
            a = b = 0
            total = 0.0
            for symbol, _, channel in [*path, (0, "", 0.0), (0, "", 0.0)]:
                total += channel
                if symbol is not None:
                    total += chars.log[a][b][symbol]
                    a, b = b, symbol
            return total

        best = max(itertools.product(*columns), key=score)
        assert chars.read(span) == "".join(text for _, text, _ in best)


def test_cuts():
    good = np.array([False, False, True, True])
    assert 1 < quality_model.best_cut(np.array([0.0, 1.0, 2.0, 3.0]), good) < 2
    assert toxicity.toxic_cut(np.array([0.0, 0.0, 2.0]), np.array([False, False, True])) == 1.0
    assert quality_model.fit_ranking([([0.0] * quality_model.FEATURES, 1)]).scores(np.zeros((1, quality_model.FEATURES))) >= 0.7


def test_bradley_terry_orders_pairs():
    draw = np.random.default_rng(1)
    truth = np.array([2.0, -1.0, 0.0])
    x, y = draw.normal(size=(4000, 3)), draw.normal(size=(4000, 3))
    wins = draw.random(4000) < 1 / (1 + np.exp(-(x - y) @ truth))
    found = quality_model.fit_pairs(np.where(wins[:, None], x - y, y - x))
    np.testing.assert_allclose(found, truth, atol=0.2)


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_probabilities_add_up(spark, order):
    texts = ["the cat sat on the mat the cat", "a dog sat", "the dog", "the cat sat on a dog", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = kneser_ney.learn(docs, order, shards=2)
    words = ["the", "cat", "sat", "on", "mat", "a", "dog", "unknownword"]
    for context in ("", "the", "the cat", "the cat sat on", "mat a", "unknownword", "cat unknownword the", "cat unknownword"):
        before = len(context.split())
        total = 10 ** kneser_ney.token_scores(model, [context])[3][before]  # the end
        total += sum(10 ** kneser_ney.token_scores(model, [f"{context} {w}"])[3][before] for w in words)
        assert total == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_of_the_language_model(spark, order, monkeypatch):
    """Against plain counting; portions, batches and shards are tiny."""
    for limit, value in (("BATCH_TOKENS", 50), ("MERGE_ENTRIES", 20), ("SHARD_TOKENS", 300), ("SCORE_CHARS", 100)):
        monkeypatch.setattr(kneser_ney, limit, value)
    draw = np.random.default_rng(order)
    texts = [" ".join(f"w{i}" for i in draw.zipf(1.4, draw.integers(0, 40)) % 60) for _ in range(150)]
    source = [*enumerate([*texts, None, "", " \n", "W1 W2 " * 400, *texts[:20]])]
    docs = spark.createDataFrame(source, "doc_id long, text string")
    train = [t for i, t in source if brute.fold(i, 10) != 0]
    model = kneser_ney.learn(spark.createDataFrame([(t,) for t in train], "text string"), order, shards=3)
    assert model.shards == max(3, model.vocabulary.tokens // 300) and model.order == order
    scored = kneser_ney.score_documents(docs, model, F.lit(False)).orderBy("doc_id").collect()
    expected = brute.kneser_ney(source, order)
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in scored] == [e[1:4] for e in expected]
    np.testing.assert_allclose([(r.base_score, r.score) for r in scored], [e[4:] for e in expected], rtol=1e-9)


def test_sorted_hash_arrays(tmp_path):
    draw = np.random.default_rng(5)
    hashes = np.unique(draw.integers(0, 1 << 64, 60_000, dtype=np.uint64))
    values = np.stack([draw.integers(0, 4, len(hashes)), draw.zipf(1.3, len(hashes)) % (1 << 40)])
    uri = kneser_ney.store_table(str(tmp_path), hashes, values)
    asked = draw.permutation(np.concatenate([hashes[::3], draw.integers(0, 1 << 64, 20_000, dtype=np.uint64)]))
    known = {h: v for h, v in zip(hashes.tolist(), values.T.tolist())}
    assert kneser_ney.table_values(uri, asked).T.tolist() == [known.get(h, [0, 0]) for h in asked.tolist()]


def test_pieces_between_tables_are_shuffled_and_not_staged_as_well(spark, monkeypatch):
    staged, write = [], kneser_ney.stage
    monkeypatch.setattr(kneser_ney, "stage", lambda df, label: staged.append(df.columns) or write(df, label))
    model = kneser_ney.learn(spark.createDataFrame([("a b c a b",), ("b c",)], "text string"), shards=2)
    assert model.order == 3 and [t.total for t in model.tables] == [7, 9, 9]
    assert staged and not [c for columns in staged for c in columns if c in ("columns", "numbers")]


def test_ngrams_of_a_batch_are_hashed_once(monkeypatch):
    draw, hashed, gram_hashes = np.random.default_rng(2), [], kneser_ney.gram_hashes
    chunks = [draw.integers(0, 9, (3, 1000), np.uint64) for _ in range(20)]
    monkeypatch.setattr(kneser_ney, "gram_hashes", lambda grams: hashed.append(grams.shape[1]) or gram_hashes(grams))
    assert len([*kneser_ney._counted(iter(chunks), 4)]) == 1
    assert sum(hashed) == 20_000


def test_repeated_ngrams_share_a_batch(monkeypatch):
    """A batch is dealt once its distinct n-grams fill it, however often they occur."""
    monkeypatch.setattr(kneser_ney, "BATCH_TOKENS", 100)
    chunks = [np.arange(90, dtype=np.uint64).reshape(3, 30) for _ in range(50)]
    (rows,) = kneser_ney._counted(iter(chunks), 2)
    counts = np.concatenate([kneser_ney.unpacked(numbers[0]) for _, _, numbers in rows])
    assert counts.tolist() == [50] * 30


@pytest.mark.parametrize("keys", [[], [7], [5, 5, 5], [3, 2, 1, 0, 3], [(9 << 40) + i % 100 for i in range(1000, 0, -1)]])
def test_groups_of_keys_that_differ_in_their_last_bits(keys):
    keys = np.array(keys, np.uint64)
    distinct, order, first = kneser_ney._grouped(keys)
    assert order.tolist() == np.argsort(keys, kind="stable").tolist()
    assert distinct.tolist() == sorted({*keys.tolist()}) == keys[order][first].tolist()
    found, places = kneser_ney._distinct(keys)
    assert found[places].tolist() == keys.tolist()


def test_a_row_of_values_takes_about_a_byte(tmp_path):
    draw = np.random.default_rng(3)
    hashes = np.unique(draw.integers(0, 1 << 64, 50_000, dtype=np.uint64))
    a = draw.zipf(2.2, len(hashes))
    values = np.stack([a, np.where(a > 50, a, 0), a, a // 3, a // 5])
    uri = kneser_ney.store_table(str(tmp_path), hashes, values)
    assert kneser_ney.table_values(uri, hashes).tolist() == values.tolist()
    assert len(kneser_ney.mapped_file(uri)) < 8 * len(hashes)


@pytest.mark.parametrize("base, step", [(0, 1), ((1 << 64) - 3001, 3), (1 << 63, 1 << 20), (12345, 1 << 45)])
def test_sorted_hash_arrays_over_any_span(tmp_path, base, step):
    """Hashes next to each other, at both ends, and asked for outside the table."""
    hashes = np.array([base + i * step for i in range(1000)], np.uint64)
    uri = kneser_ney.store_table(str(tmp_path), hashes, np.arange(1, 1001)[None])
    between = max(1, step // 2)
    outside = (0, base - 1, base + between, base + 999 * step + between, (1 << 64) - 1)
    outside = [h for h in outside if 0 <= h < 1 << 64]
    asked = np.array([*hashes.tolist(), *outside], np.uint64)
    known = {h: i for i, h in enumerate(hashes.tolist(), 1)}
    assert kneser_ney.table_values(uri, asked)[0].tolist() == [known.get(h, 0) for h in asked.tolist()]
    empty = kneser_ney.store_table(str(tmp_path), hashes[:0], np.zeros((1, 0), np.int64))
    assert not kneser_ney.table_values(empty, asked).any()


def test_a_repeated_doc_id_does_not_break_the_bound_of_the_sample(spark):
    """One labelled id on many rows of different texts."""
    docs = spark.range(900).select(
        F.when(F.col("id") < 800, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")
    )
    labels = spark.createDataFrame([(7, 1), *((i, 0) for i in range(800, 900))], "doc_id long, toxic int")
    drawn = labelled.labelled_sample(docs, labels, "toxic", F.lit(True), 50)
    found = labelled.bounded(stage(drawn, "sample"), 50)
    assert found.count() == min(50, drawn.count())
    everything = labelled.labelled_sample(docs, labels, "toxic", F.lit(True), 500)
    found = labelled.bounded(stage(everything, "sample"), 500).collect()
    assert len(found) == 500 and len({r.text for r in found}) == 500
    assert {tuple(r) for r in found} <= {tuple(r) for r in everything.collect()}
