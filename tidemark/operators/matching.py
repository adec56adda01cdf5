"""One-to-one matching by elimination: what is certain is accepted, which makes more certain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .baseline import written


def unique_candidates(people: DataFrame, candidates: DataFrame, counted: DataFrame) -> DataFrame:
    """person, short, why, round: one row for each person, with the abbreviation that is certainly theirs, or null.

    people: person, official (a count). candidates: person, short. counted: short, n. A candidate counts where the count of
    the abbreviation equals the official one. Round by round, a person's only candidate left is accepted unless it is
    another one's only candidate too; it is then struck off all others. A round keeps nothing but the open candidates, and
    rounds end when one accepts nothing. why: accepted; zero (no official count, or 0: nothing can be confirmed); nomatch (no
    candidate's count agrees); taken (all of them became others'); shared (one is left, another person has only that one as
    well); many. round: of the acceptance, from 1. Repeated candidates are one; null abbreviations are none; people without
    a row in `people` are left out, repeated people are one by their largest official count.
    """
    people = people.groupBy("person").agg(F.max("official").alias("official"))
    agree = candidates.filter("short IS NOT NULL").select("person", "short").distinct().join(people.filter("official > 0"), "person").join(counted, "short").filter("n = official")
    first = written(agree.select("person", "short").distinct(), "candidates")
    left, accepted, number = first, None, 0
    while True:
        number += 1
        only = left.groupBy("person").agg(F.min("short").alias("short"), F.count("*").alias("n")).filter("n = 1")
        sure = only.groupBy("short").agg(F.min("person").alias("person"), F.count("*").alias("n")).filter("n = 1")
        sure = written(sure.select("person", "short", F.lit(number).alias("round")), "accepted")
        if not sure.limit(1).count():
            break
        accepted = sure if accepted is None else written(accepted.unionByName(sure), "accepted")
        left = written(left.join(sure.select("person"), "person", "left_anti").join(sure.select("short"), "short", "left_anti"), "candidates")
    accepted = sure if accepted is None else accepted
    had = first.groupBy("person").agg(F.count("*").alias("had"))
    open_ = left.groupBy("person").agg(F.count("*").alias("open"))
    why = (
        F.when(F.col("short").isNotNull(), "accepted").when(F.coalesce("official", F.lit(0)) <= 0, "zero").when(F.col("had").isNull(), "nomatch")
        .when(F.col("open").isNull(), "taken").when(F.col("open") == 1, "shared").otherwise("many")
    )
    out = people.join(accepted, "person", "left").join(had, "person", "left").join(open_, "person", "left")
    return out.select("person", "short", why.alias("why"), "round")
