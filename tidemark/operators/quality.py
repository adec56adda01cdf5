"""Data quality: rule lists with quarantine, constraint counts, guards against drift, leakage checks, reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def judged(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rows with reasons: names of the rules that a row breaks (a rule that is null is broken)."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return rows.withColumn("reasons", F.array_compact(F.array(*broken)))


def quarantine(rows: DataFrame, rules: dict[str, Column], most: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with reasons); raises if more than this share is bad."""
    all_ = judged(rows, rules)
    if most < 1.0:
        share = all_.agg(F.avg((F.size("reasons") > 0).cast("int")).alias("s")).first()["s"]
        if share is not None and share > most:
            raise ValueError(f"{share:.1%} of the rows break rules")
    return all_.filter(F.size("reasons") == 0).drop("reasons"), all_.filter(F.size("reasons") > 0)


def violations(rows: DataFrame, rules: dict[str, Column], unique: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """rule, n: broken rows of each rule in one pass, and surplus rows of keys that should be unique."""
    bad = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]
    out = rows.agg(*bad).select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])))
    for name, keys in (unique or {}).items():
        extra = rows.groupBy(*keys).agg((F.count("*") - 1).alias("x")).agg(F.coalesce(F.sum("x"), F.lit(0)).alias("n"))
        out = out.unionByName(extra.select(F.lit(name).alias("rule"), "n"))
    return out


def leak_rows(build: Callable[[DataFrame], DataFrame], rows: DataFrame, day: str, at: int, key: Sequence[str]) -> DataFrame:
    """Features of rows before `at` that change when all rows from `at` on are taken away: must be empty."""
    full, cut = build(rows), build(rows.filter(F.col(day) < at))
    return full.join(cut.select(*key), list(key), "left_semi").exceptAll(cut)


def agreement(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """col, both, same, only_a, only_b: how two sources agree on each column."""
    x = a.select(*key, *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(1).alias("__a"))
    y = b.select(*key, *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(1).alias("__b"))
    j = x.join(y, list(key), "full_outer")
    has = lambda s, c: F.col(f"{s}_{c}").isNotNull()
    counts = []
    for c in cols:
        counts += [
            F.count_if(has("a", c) & has("b", c)).alias(f"both_{c}"), F.count_if(F.col(f"a_{c}") == F.col(f"b_{c}")).alias(f"same_{c}"),
            F.count_if(has("a", c) & ~has("b", c)).alias(f"only_a_{c}"), F.count_if(~has("a", c) & has("b", c)).alias(f"only_b_{c}"),
        ]
    rows = [F.struct(F.lit(c).alias("col"), *[F.col(f"{k}_{c}").alias(k) for k in ("both", "same", "only_a", "only_b")]) for c in cols]
    return j.agg(*counts).select(F.inline(F.array(*rows)))


def guarded_replace(old: DataFrame, new: DataFrame, part: str, least: float) -> DataFrame:
    """Rows of new for each part, but of old where new has fewer than `least` of its rows (the write is refused), with replaced.

    Parts that only new has are taken; parts that new lacks keep their old rows.
    """
    sides = old.select(part, F.lit(1).alias("a"), F.lit(0).alias("b")).union(new.select(part, F.lit(0), F.lit(1)))
    ok = (F.sum("b") > 0) & (F.sum("b") >= least * F.sum("a"))
    ok = sides.groupBy(F.col(part).alias("__part")).agg(ok.alias("replaced"))  # null is a part as well
    taken = lambda df, yes: df.join(ok, df[part].eqNullSafe(ok["__part"])).filter(F.col("replaced") == yes).drop("__part")
    return taken(old, False).unionByName(taken(new, True))
