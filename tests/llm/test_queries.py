"""Every query of the operators on hard rows, an empty table and the given tables."""

from __future__ import annotations

import os
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from gaugeline.llm import kneser_ney, simhash, token_files
from gaugeline.llm.queries import QUERIES
from gaugeline.llm.sql import SQL
from tests.compare import connect, differences
from tests.llm import brute

NAMES = sorted(QUERIES)


def ordered(rows) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), 0 if v is None else v) for v in row))


@pytest.fixture(scope="module", params=["hard", "given"])
def folder(request, table_dir, tiny_dir) -> str:
    return table_dir if request.param == "hard" else tiny_dir


@pytest.fixture(scope="module")
def source(spark, folder) -> list[tuple]:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in docs.collect()]


def result(spark, folder, name, *columns) -> list[tuple]:
    return ordered(tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, table_dir, empty_dir, name):
    for folder in (sf_dir, table_dir, empty_dir):
        with connect_any(folder) as connection:
            assert differences(QUERIES[name](spark, folder), connection, SQL[name]) == []


def connect_any(folder: str):
    """Views on files of the given tables or folders of Parquet files."""
    if os.path.isfile(f"{folder}/documents.parquet"):
        return connect(folder)
    connection = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_rules(spark, folder, source):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = [(i, *brute.rules(t)) for i, t in source]
    assert result(spark, folder, "op1_quality_rules", *columns) == ordered(expected)
    assert not [r for r in QUERIES["op1_quality_rules"](spark, folder).collect() if r.kept and r.base_failed]


def test_token_counts(spark, folder, source, tokenizer):
    expected = []
    for i, t in source:
        n = len(brute.encoded(tokenizer, t))
        expected.append((i, len((t or "").encode()), n, n > 1024))
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert result(spark, folder, "op2_token_counts", *columns) == ordered(expected)


def test_codec(spark, folder, source, tokenizer):
    expected = []
    for i, t in source:
        ids = brute.encoded(tokenizer, t)
        decoded = brute.library(tokenizer).decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(decoded)))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert result(spark, folder, "op3_bpe_codec", *columns) == ordered(expected)


def test_secrets(spark, folder, source):
    expected = [(i, *brute.secrets(t)[0], brute.secrets(t)[1]) for i, t in source]
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert result(spark, folder, "op5_secret_scan", *columns) == ordered(expected)


def test_contamination(spark, folder, source):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    expected = [(i, *row) for (i, _), row in zip(source, brute.contamination([t for _, t in source], items))]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert result(spark, folder, "op6_decontaminate", *columns) == ordered(expected)


def test_token_files(spark, folder, source, tokenizer):
    ids = [(i, [*brute.encoded(tokenizer, t), 0]) for i, t in source]
    found = result(spark, folder, "op7_token_files", "doc_id", "start", "n_tokens", "ids_crc32")
    crc = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids]
    assert ordered((i, n, c) for i, _, n, c in found) == ordered(crc)
    at = 0
    for i, start, n, _ in sorted(found, key=lambda r: r[1]):
        assert start == at
        at += n
    by_start = [(-1 << 63) if i is None else i for i, *_ in sorted(found, key=lambda r: r[1])]
    assert by_start == sorted(by_start)


def test_simhash(spark, folder, source):
    prints = [brute.fingerprint(t) for _, t in source]
    known = [(p, i) for p, (i, _) in zip(prints, source) if i is not None]
    groups = dict(zip((p for p, _ in known), brute.components([p for p, _ in known], [i for _, i in known])))
    expected = [(i, f"{p:016x}", groups.get(p)) for p, (i, _) in zip(prints, source)]
    assert result(spark, folder, "op8_simhash", "doc_id", "fingerprint", "component_id") == ordered(expected)


def test_kneser_ney(spark, folder, source):
    expected = ordered((i, *row) for (i, _), row in zip(source, brute.kneser_ney(source)))
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    found = result(spark, folder, "op10_kneser_ney", *columns)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    np.testing.assert_allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("name, folds, held", [("op4_toxicity", 3, 1), ("op9_quality_classifier", 4, 2)])
def test_scores(spark, folder, source, name, folds, held):
    rows = QUERIES[name](spark, folder).collect()
    assert ordered((r.doc_id,) for r in rows) == ordered((i,) for i, _ in source)
    for r in rows:
        assert r.held_out == (brute.fold(r.doc_id, folds) == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


@pytest.mark.parametrize("name, label", [("op4_toxicity", "toxic"), ("op9_quality_classifier", "quality")])
def test_held_out_accuracy(spark, name, label):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, folder).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows)
    assert len(rows) > 900 and right > 0.96


def test_language_model_beats_the_base(spark, sf_dir):
    held = [r for r in QUERIES["op10_kneser_ney"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    model = kneser_ney.learn(docs, shards=3)
    again = kneser_ney.learn(docs.repartition(5), shards=7)
    text = docs.first().text
    np.testing.assert_allclose(
        [float(x[0]) for x in kneser_ney.score_texts(model, [text])],
        [float(x[0]) for x in kneser_ney.score_texts(again, [text])],
    )


def test_files_hold_what_is_read(spark, tokenizer, hard):
    manifest = token_files.write_token_files(hard, tokenizer, files=3)
    for row in manifest.collect():
        image = token_files.mapped_file(row.uri)
        index, ids = token_files.read_documents(image)
        assert len(ids) == row.n_ids and len(index) == row.n_docs
        for doc_id, first, count in index.tolist():
            if (index["doc_id"] == doc_id).sum() == 1:
                assert token_files.read_document(image, doc_id).tolist() == ids[first : first + count].tolist()


def test_pipeline(spark, table_dir, tiny_dir, empty_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "secret_scans",
        "bpe_encoding_decoding",
    ]
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
    for folder in (table_dir, tiny_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        columns = docs.dtypes
        for _, apply in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stage(apply(spark, docs, folder), "test")
            assert docs.dtypes == columns
        assert corpus_pipeline.run(spark, folder).count() == docs.count()


def test_stages_decide(spark, tiny_dir, table_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in QUERIES["op9_quality_classifier"](spark, tiny_dir).collect() if r.predicted}
    assert {r.doc_id for r in stages["quality_classifier"](spark, docs, tiny_dir).collect()} == kept
    groups = brute.components([brute.fingerprint(t) for _, t in rows], [i for i, _ in rows])
    one = stages["simhash_near_dedup"](spark, docs, tiny_dir).collect()
    assert sorted(r.doc_id for r in one) == sorted(set(groups))
    items = [tuple(r) for r in spark.read.parquet(f"{tiny_dir}/benchmark.parquet").collect()]
    clean = {i for (i, _), row in zip(rows, brute.contamination([t for _, t in rows], items)) if not row[-1]}
    found = stages["benchmark_decontamination"](spark, docs, tiny_dir).collect()
    assert {r.doc_id for r in found} == clean
    redacted = stages["secret_scans"](spark, docs, tiny_dir).collect()
    assert len(redacted) == len(rows)
    before = dict(rows)
    for r in redacted:
        assert brute.secrets(r.text)[0] == (0, 0, 0) and r.n_chars == len(r.text)
        assert ("[SECRET]" in r.text) == (brute.secrets(before[r.doc_id])[0] != (0, 0, 0))


def test_repeated_rows_leave_one(spark, hard):
    kept = [tuple(r) for r in simhash.one_of_each(hard).collect()]
    assert len(kept) == len(set(kept))
    # Null, empty and blank texts share fingerprint zero.
    assert [r[0] for r in kept if not (r[1] or "").strip()] == [0]
    assert len([r for r in kept if r[0] is None]) == 1


@pytest.fixture(scope="module")
def shared_ids(spark) -> tuple[list[tuple], list[int]]:
    """Rows of unrelated texts under one doc_id, near copies under others and none; the group of each."""
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]

    def text() -> str:
        return " ".join(draw.choice(words, 400))

    a, b, c, d, alone = (text() for _ in range(5))
    rows = [(5, a), (5, b), (9, f"{a} x"), (4, f"{b} x"), (7, c), (None, f"{c} x y z"), (None, d), (None, f"{d} x")]
    rows += [(5, alone), (None, alone), (3, None), (None, "")]
    return rows, [0, 1, 0, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_texts_under_one_id_are_not_linked(spark, shared_ids, tmp_path):
    rows, groups = shared_ids
    prints = [brute.fingerprint(t) for _, t in rows]
    assert brute.components(prints, groups) == groups and len(set(prints[:8])) == 8
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    names = brute.components(prints, [np.inf if i is None else i for i, _ in rows])
    assert names == [5, 4, 5, 4, 7, 7, np.inf, np.inf, 5, 5, 3, 3]
    expected = [(i, f"{p:016x}", None if n == np.inf else n) for (i, _), p, n in zip(rows, prints, names)]
    found = result(spark, str(tmp_path), "op8_simhash", "doc_id", "fingerprint", "component_id")
    assert found == ordered(expected)


def test_texts_under_one_id_are_kept(spark, shared_ids):
    rows, groups = shared_ids
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [rows.index(tuple(r)) for r in simhash.one_of_each(docs).collect()]
    assert sorted(groups[i] for i in kept) == [0, 1, 2, 3, 4, 5]
    assert sorted(i for i in kept if i not in (6, 7)) == [0, 3, 4, 8, 10]


def test_rows_that_hash_alike_but_for_nulls_are_kept(spark):
    text = "some words that are here once"
    docs = spark.createDataFrame([(1, text, None), (1, None, text)], "doc_id long, text string, lang string")
    assert simhash.one_of_each(docs).count() == 2
