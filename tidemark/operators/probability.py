"""Probabilities inside an event, their calibration and evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rolling import rolling


def normalised(weight: Column, event: Sequence[str]) -> Column:
    """Share of an event's weight; equal shares where the weights sum to 0."""
    w = Window.partitionBy(*event)
    total = F.sum(weight).over(w)
    return F.when(total > 0, weight / total).otherwise(1 / F.count("*").over(w))


def calibration(rows: DataFrame, p: str, hit: Column, bands: int = 10) -> DataFrame:
    """n, mean p and hit rate in equal bands of p."""
    band = F.least(F.floor(F.col(p) * bands), F.lit(bands - 1).cast("long"))
    return rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(hit.cast("int")).alias("rate"))


def interpolate(x: Column, points: Sequence[tuple[float, float]]) -> Column:
    """Piecewise linear through the points (ascending), flat beyond them."""
    out = F.lit(points[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(points, points[1:], strict=False))):
        out = F.when(x < x1, F.lit(y0) + (x - x0) * ((y1 - y0) / (x1 - x0))).otherwise(out)
    return F.when(x <= points[0][0], F.lit(points[0][1])).otherwise(out)


def isotonic(cells: DataFrame, by: str, cell: str) -> DataFrame:
    """by, cell, x, y with the neighbours' x0, y0, x1, y1: the non-decreasing fit of hits h of n over a bounded table.

    The fit at i is the largest over a <= i of the least mean of [a, b] over b >= i; pairs of cells are few.
    """
    w = Window.partitionBy(by).orderBy(cell)
    runs = cells.withColumn("cn", F.sum("n").over(w)).withColumn("ch", F.sum("h").over(w))
    a = runs.select(by, F.col(cell).alias("a"), (F.col("cn") - F.col("n")).alias("n0"), (F.col("ch") - F.col("h")).alias("h0"))
    b = runs.select(by, F.col(cell).alias("b"), "cn", "ch")
    mean = (F.col("ch") - F.col("h0")) / (F.col("cn") - F.col("n0"))
    spans = a.join(b, by).filter("a <= b").withColumn("m", mean)
    least = F.min("m").over(Window.partitionBy(by, "a").orderBy(F.desc("b")))
    fit = spans.withColumn("m", least).groupBy(by, F.col("b").alias(cell)).agg(F.max("m").alias("y"))
    fit = fit.join(cells.select(by, cell, "x"), [by, cell])
    near = [f(c).over(w).alias(n) for f, c, n in ((F.lag, "x", "x0"), (F.lag, "y", "y0"), (F.lead, "x", "x1"), (F.lead, "y", "y1"))]
    return fit.select(by, cell, "x", "y", *near)


def kolmogorov(d: Column, n: Column, terms: int = 100) -> Column:
    """p value of the statistic d of n values: the alternating series with the usual correction for small n."""
    root = F.sqrt(n.cast("double"))
    t = (root + 0.12 + 0.11 / root) * d
    parts = F.transform(F.sequence(F.lit(1), F.lit(terms)), lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * t * t))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)))


def mixed(p: Column, q: Column, a: float, b: float, event: Sequence[str]) -> Column:
    """p' in proportion to exp(a ln p + b logit q), normalised in the event; both clipped away from 0 and 1."""
    clip = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-6)), F.lit(1e-6))
    weight = F.exp(a * F.log(clip(p)) + b * F.log(clip(q) / (1 - clip(q))))
    return normalised(weight, event)


def harville(rows: DataFrame, event: str, runner: str, p: str, places: int) -> DataFrame:
    """Ordered combinations of 2 or 3 runners of an event with their Harville probability; joins stay inside events."""
    one = rows.select(event, F.col(runner).alias("r1"), F.col(p).alias("p1"))
    two = rows.select(event, F.col(runner).alias("r2"), F.col(p).alias("p2"))
    out = one.join(two, event).filter("r1 <> r2").withColumn("prob", F.col("p1") * F.try_divide(F.col("p2"), 1 - F.col("p1")))
    if places == 2:
        return out.select(event, "r1", "r2", "prob")
    three = rows.select(event, F.col(runner).alias("r3"), F.col(p).alias("p3"))
    out = out.join(three, event).filter("r3 <> r1 AND r3 <> r2")
    return out.select(event, "r1", "r2", "r3", (F.col("prob") * F.try_divide(F.col("p3"), 1 - F.col("p1") - F.col("p2"))).alias("prob"))


#: Distribution function of the Poisson law of mean 1 at 0 to 5. Fixed values.
POISSON_ONE = (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406)


def poisson_weight(key: Column, b: Column, seed: int = 7) -> Column:
    """A deterministic Poisson(1) draw for each (cluster, resample): the bootstrap without collecting clusters."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key, b).cast("binary"))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / 4294967296.0
    out = F.lit(6)
    for k, cut in reversed(list(enumerate(POISSON_ONE))):
        out = F.when(u < cut, k).otherwise(out)
    return out


def log_loss(p: Column, hit: Column) -> Column:
    clip = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.avg(-F.when(hit, F.log(clip)).otherwise(F.log(1 - clip)))


def binomial_tail(k: Column, n: Column) -> Column:
    """Two-sided exact p of k of n at one half (McNemar): terms by recursion in logarithms of ratios."""
    low = F.least(k, n - k)
    start = F.struct((-n * F.log(F.lit(2.0))).alias("t"), F.lit(0.0).alias("s"))

    def step(acc: Column, i: Column) -> Column:
        return F.struct((acc["t"] + F.log((n - i) / (i + 1))).alias("t"), (acc["s"] + F.exp(acc["t"])).alias("s"))

    total = F.aggregate(F.sequence(F.lit(0).cast("long"), low), start, step, lambda a: a["s"])
    return F.least(F.lit(1.0), 2 * total)


def payout_coefficients(prices: DataFrame, winners: DataFrame, *, by: Sequence[str], day: str, days: int, least: int) -> DataFrame:
    """by, day, n, coef: for every day with prices, the median of payout / price of the winners of the days before.

    prices: by and day; winners: by, day, price and payout for a price of 1. Cells of fewer than `least` have no row.
    """
    facts = winners.select(*by, day, F.try_divide("payout", "price").alias("__ratio"))
    out = rolling(prices.select(*by, day).distinct(), facts, by=list(by), day=day, value="__ratio", days=days)
    return out.filter(F.col("window_n") >= least).select(*by, day, F.col("window_n").alias("n"), F.col("window").alias("coef"))
