"""Following links from page to page, in as many joins as the chain's length has binary digits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.stage import stage

# What a page's link leads to.
FOLLOWED, LAST, MISSING, CYCLE, UNREACHABLE = "followed", "last", "missing", "cycle", "unreachable"


def follow_chain(links: DataFrame, starts: DataFrame) -> DataFrame:
    """Every page of ``links`` (page, next) with its place in the chains from ``starts`` (page).

    Returns start, page, next, position (0 for the start), differing and status:

    - followed: the next page is at the next position
    - last: there is no next page
    - missing: the next page was not landed
    - cycle: the next page was already passed on the way
    - unreachable: no start leads to the page; start and position are NULL

    A page that several starts reach has a row for each. A start that was not
    landed is a row of its own, missing. A page landed more than once counts
    once, with the smallest next; ``differing`` says that its landings disagree.
    Rows without a page are left out.

    Pointers are doubled: after k rounds the pages up to 2^k steps away are
    known and every page points 2^k steps ahead, so a chain of a million pages
    takes 20 rounds, and a cycle ends when a round finds no new page.
    """
    pages = stage(
        links.filter(F.col("page").isNotNull())
        .groupBy("page")
        .agg(
            F.min("next").alias("next"),
            (F.count_distinct("next") + F.max(F.col("next").isNull().cast("int")) > 1).alias("differing"),
        ),
        "pages",
    )
    known = pages.select(F.col("page").alias("_known"))
    jump = pages.join(known, F.col("next") == F.col("_known")).select("page", F.col("next").alias("_target"))
    begun = starts.filter(F.col("page").isNotNull()).select("page").distinct()
    seen = stage(
        begun.join(known, F.col("page") == F.col("_known"))
        .select(F.col("page").alias("start"), "page", F.lit(0).cast("long").alias("position")),
        "reached-pages",
    )
    step, found = 1, seen.count()
    while True:
        ahead = seen.join(jump, "page").select(
            "start", F.col("_target").alias("page"), (F.col("position") + step).alias("position")
        )
        grown = seen.unionByName(ahead).groupBy("start", "page").agg(F.min("position").alias("position"))
        seen = stage(grown, "reached-pages")
        before, found = found, seen.count()
        if found == before:
            break
        further = jump.select(F.col("page").alias("_target"), F.col("_target").alias("_further"))
        jump = stage(jump.join(further, "_target").select("page", F.col("_further").alias("_target")), "jumps")
        step *= 2

    following = seen.select("start", F.col("page").alias("next"), F.col("position").alias("_next"))
    placed = pages.join(seen, "page", "left").join(following, ["start", "next"], "left")
    landed = F.col("_known").isNotNull()
    status = (
        F.when(F.col("position").isNull(), UNREACHABLE)
        .when(F.col("next").isNull(), LAST)
        .when(~landed, MISSING)
        .when(F.col("_next") == F.col("position") + 1, FOLLOWED)
        .otherwise(CYCLE)
    )
    columns = ["start", "page", "next", "position", "differing", "status"]
    walked = placed.join(known, F.col("next") == F.col("_known"), "left").withColumn("status", status)
    gone = begun.join(known, F.col("page") == F.col("_known"), "left_anti").select(
        F.col("page").alias("start"),
        "page",
        F.lit(None).cast("string").alias("next"),
        F.lit(0).cast("long").alias("position"),
        F.lit(False).alias("differing"),
        F.lit(MISSING).alias("status"),
    )
    return walked.select(*columns).unionByName(gone)


def chain_summary(walked: DataFrame) -> DataFrame:
    """Pages by status, per start; a chain is whole if all of its pages are followed but one, the last."""
    return walked.groupBy("start", "status").agg(
        F.count(F.lit(1)).alias("pages"), F.max("position").alias("furthest")
    )
