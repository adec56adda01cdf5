"""Queries of the E family."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import neighbours
from ..operators import probability as pr
from ..operators import selection, stats
from ..operators.resampling import resampled_sums
from ..sources.io import written
from .aggregates import PB, implied
from .demo import hu, participations, query, with_pt


def probs(spark, d):
    return implied(participations(spark, d))


@query("E1_implied", with_pt("SELECT event, runner_no, round(p, 9) AS p FROM pb", PB))
def e1(spark, d):
    return probs(spark, d).select("event", "runner_no", F.round("p", 9).alias("p"))


@query("E2_calibration", with_pt("SELECT band, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(won::INT), 6) AS rate FROM (SELECT *, least(floor(round(p, 9) * 10), 9)::BIGINT AS band FROM pb) GROUP BY 1", PB))
def e2(spark, d):
    c = pr.calibration(probs(spark, d).withColumn("p", F.round("p", 9)), "p", F.col("won"))
    return c.select("band", "n", F.round("mean_p", 6).alias("mean_p"), F.round("rate", 6).alias("rate"))


POINTS = [(0.0, 0.0), (0.1, 0.08), (0.3, 0.28), (0.6, 0.62), (1.0, 1.0)]


@query("E3_remapped", with_pt(f"SELECT event, runner_no, {hu('v / sum(v) OVER (PARTITION BY event)', 6)} AS p FROM (SELECT *, CASE WHEN p < 0.1 THEN p * 0.8 WHEN p < 0.3 THEN 0.08 + (p - 0.1) WHEN p < 0.6 THEN 0.28 + (p - 0.3) * (0.34 / 0.3::DOUBLE) ELSE 0.62 + (p - 0.6) * 0.95 END AS v FROM pb)", PB))
def e3(spark, d):
    v = pr.interpolate(F.col("p"), POINTS)
    return probs(spark, d).withColumn("v", v).select("event", "runner_no", stats.half_up(pr.normalised(F.col("v"), ["event"]), 6).alias("p"))


#: Cells of p in a calibration table, and the bands of field sizes that have a table of their own.
CELLS, FIELDS = 50, ((3, "small"), (5, "middle"), (99, "large"))
FIELD_SQL = "CASE WHEN field_size <= 3 THEN 'small' WHEN field_size <= 5 THEN 'middle' ELSE 'large' END"
E4 = (
    f"cal AS (SELECT event, runner_no, p, won, {FIELD_SQL} AS field, least(floor(round(p, 9) * {CELLS}), {CELLS - 1})::BIGINT AS cell FROM pb JOIN (SELECT event, runner_no, field_size FROM pt) USING (event, runner_no))",
    "cells AS (SELECT field, cell, count(*) AS n, count(*) FILTER (WHERE won) AS h, round(avg(p), 9) AS x FROM cal GROUP BY 1, 2)",
    "runs AS (SELECT *, sum(n) OVER w AS cn, sum(h) OVER w AS ch FROM cells WINDOW w AS (PARTITION BY field ORDER BY cell))",
    "iso AS (SELECT i.field, i.cell, any_value(i.x) AS x, max(m) AS y FROM runs i JOIN (SELECT a.field, a.cell AS a, c.cell AS i, (SELECT min((b.ch - a.ch + a.h) / (b.cn - a.cn + a.n)::DOUBLE) FROM runs b WHERE b.field = a.field AND b.cell >= c.cell) AS m FROM runs a JOIN runs c ON a.field = c.field AND a.cell <= c.cell) t ON t.field = i.field AND t.i = i.cell GROUP BY 1, 2)",
    "steps AS (SELECT field, cell, x, y, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lag(x) OVER w AS x0, lag(y) OVER w AS y0 FROM iso WINDOW w AS (PARTITION BY field ORDER BY cell))",
)


@query("E4_monotone", with_pt("SELECT c.event, c.runner_no, round(CASE WHEN round(p, 9) < x THEN y0 + (round(p, 9) - x0) * (y - y0) / (x - x0) ELSE coalesce(y + (round(p, 9) - x) * (y1 - y) / (x1 - x), y) END, 6) AS p FROM (SELECT c.*, s.x, s.y, s.x1, s.y1, coalesce(s.x0, -1) AS x0, coalesce(s.y0, s.y) AS y0 FROM cal c JOIN steps s USING (field, cell)) c", PB, *E4))
def e4(spark, d):
    """A monotone table of each field-size band (isotonic regression over cells of p), applied by interpolation."""
    size = participations(spark, d).select("event", "runner_no", "field_size")
    rows = probs(spark, d).join(size, ["event", "runner_no"]).withColumn("p", F.round("p", 9))
    field = F.lit(FIELDS[-1][1])
    for most, name in reversed(FIELDS[:-1]):
        field = F.when(F.col("field_size") <= most, name).otherwise(field)
    rows = rows.withColumn("field", field).withColumn("cell", F.least(F.floor(F.col("p") * CELLS), F.lit(CELLS - 1).cast("long")))
    cells = rows.groupBy("field", "cell").agg(F.count("*").alias("n"), F.count_if("won").alias("h"), F.round(F.avg("p"), 9).alias("x"))
    steps = pr.isotonic(written(cells, "cells"), "field", "cell")  # CELLS rows a band at most
    j = rows.join(F.broadcast(steps), ["field", "cell"])
    p, x, y = F.col("p"), F.col("x"), F.col("y")
    x0, y0 = F.coalesce("x0", F.lit(-1.0)), F.coalesce("y0", y)
    below = y0 + (p - x0) * (y - y0) / (x - x0)
    above = F.coalesce(y + (p - x) * (F.col("y1") - y) / (F.col("x1") - x), y)
    return j.select("event", "runner_no", F.round(F.when(p < x, below).otherwise(above), 6).alias("p"))


@query("E5_mixed", with_pt("SELECT event, runner_no, round(w / sum(w) OVER (PARTITION BY event), 6) AS p FROM (SELECT *, exp(0.7 * ln(greatest(least(p, 1 - 1e-6), 1e-6)) + 0.3 * ln(greatest(least(q, 1 - 1e-6), 1e-6) / (1 - greatest(least(q, 1 - 1e-6), 1e-6)))) AS w FROM (SELECT *, price / sum(price) OVER (PARTITION BY event) AS q FROM pb))", PB))
def e5(spark, d):
    rows = probs(spark, d).withColumn("q", F.col("price") / F.sum("price").over(Window.partitionBy("event")))
    return rows.select("event", "runner_no", F.round(pr.mixed(F.col("p"), F.col("q"), 0.7, 0.3, ["event"]), 6).alias("p"))


@query("E6_logit_pool")
def e6(spark, d):
    """Two-parameter conditional logit by Newton steps; each step is one pass that sums gradient and Hessian."""
    from ..sources import io

    w = Window.partitionBy("event")
    rows = probs(spark, d).withColumn("x", F.log("p")).withColumn("y", F.log(F.col("price") / F.sum("price").over(w)))
    path = io.new_path(spark, "logit")
    rows.select("event", "x", "y", F.col("won").cast("int").alias("z")).write.parquet(path)
    rows, (a, b) = spark.read.parquet(path), (1.0, 0.0)
    for _ in range(6):
        s = rows.withColumn("e", F.exp(F.lit(a) * F.col("x") + F.lit(b) * F.col("y")))
        g = s.groupBy("event").agg(*[F.sum(c).alias(n) for n, c in {"s": F.col("e"), "ex": F.col("e") * F.col("x"), "ey": F.col("e") * F.col("y"), "exx": F.col("e") * F.col("x") ** 2, "eyy": F.col("e") * F.col("y") ** 2, "exy": F.col("e") * F.col("x") * F.col("y"), "wx": F.col("z") * F.col("x"), "wy": F.col("z") * F.col("y")}.items()])
        mx, my = F.col("ex") / F.col("s"), F.col("ey") / F.col("s")
        t = g.agg(F.sum(F.col("wx") - mx).alias("ga"), F.sum(F.col("wy") - my).alias("gb"), F.sum(F.col("exx") / F.col("s") - mx * mx).alias("aa"), F.sum(F.col("eyy") / F.col("s") - my * my).alias("bb"), F.sum(F.col("exy") / F.col("s") - mx * my).alias("ab")).first()
        det = t["aa"] * t["bb"] - t["ab"] ** 2
        if not det:
            break
        a, b = a + (t["bb"] * t["ga"] - t["ab"] * t["gb"]) / det, b + (t["aa"] * t["gb"] - t["ab"] * t["ga"]) / det
    return rows.groupBy().agg(F.count("*").alias("n"), F.lit(round(a, 4)).alias("a"), F.lit(round(b, 4)).alias("b"))


HV = "hv AS (SELECT a.event, a.runner_no AS r1, b.runner_no AS r2, c.runner_no AS r3, a.p * b.p / nullif(1 - a.p, 0) * c.p / nullif(1 - a.p - b.p, 0) AS prob FROM pb a JOIN pb b ON a.event = b.event AND a.runner_no <> b.runner_no JOIN pb c ON c.event = a.event AND c.runner_no <> a.runner_no AND c.runner_no <> b.runner_no)"


@query("E7_harville", with_pt(f"SELECT a.event, a.runner_no AS r1, b.runner_no AS r2, {hu('a.p * b.p / (1 - a.p)', 6)} AS prob FROM pb a JOIN pb b ON a.event = b.event AND a.runner_no <> b.runner_no", PB))
def e7(spark, d):
    h = pr.harville(probs(spark, d), "event", "runner_no", "p", 2)
    return h.withColumn("prob", stats.half_up(F.col("prob"), 6))


@query("E8_pair_in_three", with_pt("SELECT event, lo, hi, round(sum(prob), 6) AS prob FROM (SELECT event, prob, unnest([least(r1, r2), least(r1, r3), least(r2, r3)]) AS lo, unnest([greatest(r1, r2), greatest(r1, r3), greatest(r2, r3)]) AS hi FROM hv) GROUP BY 1, 2, 3", PB, HV))
def e8(spark, d):
    h = pr.harville(probs(spark, d), "event", "runner_no", "p", 3)
    pair = lambda a, b: F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    return h.select("event", "prob", F.inline(F.array(pair("r1", "r2"), pair("r1", "r3"), pair("r2", "r3")))).groupBy("event", "lo", "hi").agg(F.round(F.sum("prob"), 6).alias("prob"))


E9 = (
    "hp AS (SELECT a.event, a.runner_no AS r1, b.runner_no AS r2, a.price * b.price AS x, round(a.p * b.p / nullif(1 - a.p, 0), 9) AS prob FROM pb a JOIN pb b ON a.event = b.event AND a.runner_no <> b.runner_no)",
    "hr AS (SELECT event, r1, r2, " + hu("x / sum(x) OVER (PARTITION BY event) / nullif(prob, 0)", 6) + " AS ratio, floor(ln(greatest(prob, 1e-9)) * 8)::BIGINT AS peer FROM hp)",
)


@query("E9_anomaly", with_pt(f"SELECT event, r1, r2, ratio, n, {hu('surrogate')} AS surrogate FROM hr JOIN (SELECT peer, count(*) AS n, quantile_cont(ratio, 0.95) AS lim, median(ratio) AS surrogate FROM hr GROUP BY 1) USING (peer) WHERE n >= 20 AND ratio > lim", PB, *E9))
def e9(spark, d):
    """Observed price share of ordered pairs over their Harville probability: those beyond the 95th percentile among
    pairs of similar probability, with the peers' median as what a surrogate pick would show."""
    j, g = anomalies(spark, d)
    # Peers are eighths of a logarithm: 170 at most.
    return j.join(F.broadcast(g.filter("n >= 20")), "peer").filter("ratio > limit").select("event", "r1", "r2", "ratio", "n", stats.half_up(F.col("surrogate")).alias("surrogate"))


def anomalies(spark, d):
    """Ordered pairs with their ratio and peers, and the peers' limits.

    Events are written once, a row each; pairs come out of these rows wherever they are asked for and are never moved.
    """
    runner = F.struct("runner_no", "p", "price")
    fields = written(probs(spark, d).groupBy("event").agg(F.collect_list(runner).alias("field"), F.sum("price").alias("s"), F.sum(F.col("price") * F.col("price")).alias("q")), "fields")
    one = fields.select("event", "field", (F.col("s") * F.col("s") - F.col("q")).alias("all"), F.explode("field").alias("x"))
    pairs = one.select("event", "all", "x", F.explode("field").alias("y")).filter("x.runner_no <> y.runner_no")
    prob = F.round(F.col("x.p") * F.try_divide(F.col("y.p"), 1 - F.col("x.p")), 9)
    j = pairs.select("event", F.col("x.runner_no").alias("r1"), F.col("y.runner_no").alias("r2"), prob.alias("prob"), F.try_divide(F.col("x.price") * F.col("y.price"), "all").alias("share"))
    j = j.withColumn("ratio", stats.half_up(F.try_divide("share", "prob"), 6)).withColumn("peer", F.floor(F.log(F.greatest("prob", F.lit(1e-9))) * 8)).drop("share")
    counts = written(j.groupBy("peer", "ratio").agg(F.count("*").alias("times")), "ratios")
    g = counts.groupBy("peer").agg(F.sum("times").alias("n"))
    for q, name in ((0.95, "limit"), (0.5, "surrogate")):
        g = g.join(selection.percentiles(counts, ["peer"], "ratio", q, small=500_000, times="times").withColumnRenamed("percentile", name), "peer", "left")
    return j, written(g, "limits")


_NEAR = "last_value({0} IGNORE NULLS) OVER (ORDER BY prob {1}, h {1}, event {1}, r1 {1}, r2 {1} ROWS BETWEEN UNBOUNDED PRECEDING AND {2})"
_FREE, _SPOT = "CASE WHEN NOT pick THEN s END", "CASE WHEN NOT pick AND {0}.event <> event THEN {0} END"
E9_SURROGATES = (
    "hq AS (SELECT hp.event, hp.r1, hp.r2, prob, ratio, coalesce(g.n >= 20 AND ratio > lim, false) AS pick, md5('7:' || event || ':' || r1 || ':' || r2) AS h FROM hr JOIN hp USING (event, r1, r2) JOIN (SELECT peer, count(*) AS n, quantile_cont(ratio, 0.95) AS lim FROM hr GROUP BY 1) g USING (peer) WHERE prob IS NOT NULL)",
    f"h1 AS (SELECT *, {_NEAR.format(_FREE, 'ASC', '1 PRECEDING')} AS lo, {_NEAR.format(_FREE, 'DESC', '1 PRECEDING')} AS hi FROM (SELECT *, {{'event': event, 'r1': r1, 'r2': r2, 'prob': prob, 'ratio': ratio}} AS s FROM hq))",
    f"h2 AS (SELECT *, CASE WHEN lo.event <> event THEN lo ELSE {_NEAR.format(_SPOT.format('lo'), 'ASC', 'CURRENT ROW')} END AS low, CASE WHEN hi.event <> event THEN hi ELSE {_NEAR.format(_SPOT.format('hi'), 'DESC', 'CURRENT ROW')} END AS high FROM h1)",
    "h3 AS (SELECT *, CASE WHEN low.event IS NOT NULL AND (high.event IS NULL OR prob - low.prob <= high.prob - prob) THEN low ELSE high END AS t FROM h2 WHERE pick)",
)


@query("E9_surrogates", with_pt("SELECT event, r1, r2, ratio, t.event AS s_event, t.r1 AS s_r1, t.r2 AS s_r2, t.ratio AS s_ratio FROM h3", PB, *E9, *E9_SURROGATES))
def e9_surrogates(spark, d):
    """Each anomalous pair with one surrogate: the pair of another event that is no pick itself and nearest in probability."""
    j, g = anomalies(spark, d)
    rows = j.join(F.broadcast(g.select("peer", "n", "limit")), "peer")  # 170 peers at most
    rows = rows.select("event", "r1", "r2", "prob", "ratio", (F.col("n") >= 20).alias("many"), "limit").withColumn("pick", F.col("many") & (F.col("ratio") > F.col("limit")))
    out = neighbours.nearest_other(rows, key="prob", group="event", ids=["r1", "r2"], pick="pick", carry=["ratio"])
    return out.select("event", "r1", "r2", "ratio", "s_event", "s_r1", "s_r2", "s_ratio")


E10 = "CASE WHEN discount < 0.03 THEN 'long' WHEN discount < 0.07 THEN 'mid' ELSE 'short' END"


@query("E10_expected_value", with_pt(f"SELECT b, any_value(round(coef, 6)) AS coef, count(*) AS bets, count(*) FILTER (WHERE won) AS hits, round(sum(CASE WHEN won THEN 1 / (discount + 0.05) * 0.1 ELSE 0 END) / count(*), 6) AS back FROM (SELECT *, round(p * (0.1 / (discount + 0.05)) * coef, 9) AS ev FROM (SELECT *, {E10} AS b FROM pb WHERE day >= DATE '2000-01-01') JOIN (SELECT {E10} AS b, count(*) FILTER (WHERE won) / sum(p) AS coef FROM pb WHERE day < DATE '2000-01-01' GROUP BY 1) USING (b)) WHERE ev >= 0.2 GROUP BY 1", PB))
def e10(spark, d):
    """Bets whose expected value reaches a line; the coefficient of each odds band is observed over expected before 2000."""
    from ..functions.exprs import band

    rows = probs(spark, d).withColumn("b", band(F.col("discount"), [0.03, 0.07], ["long", "mid", "short"]))
    since = F.lit("2000-01-01").cast("date")
    coef = rows.filter(F.col("day") < since).groupBy("b").agg((F.count_if("won") / F.sum("p")).alias("coef"))
    odds = 0.1 / (F.col("discount") + 0.05)
    rows = rows.filter(F.col("day") >= since).join(F.broadcast(coef), "b")  # three rows
    rows = rows.withColumn("ev", F.round(F.col("p") * odds * F.col("coef"), 9)).filter("ev >= 0.2")
    back = F.sum(F.when(F.col("won"), 1 / (F.col("discount") + 0.05) * 0.1).otherwise(0.0)) / F.count("*")
    return rows.groupBy("b").agg(F.round(F.first("coef"), 6).alias("coef"), F.count("*").alias("bets"), F.count_if("won").alias("hits"), F.round(back, 6).alias("back"))


@query("E11_walk_forward", with_pt("SELECT m, count(*) AS n, count(*) FILTER (WHERE won = (rate >= 0.25)) AS right FROM (SELECT p.month AS m, p.won, r.h / r.n AS rate FROM (SELECT date_trunc('month', day)::DATE AS month, going, finish = 1 AS won FROM pt) p JOIN (SELECT a.month, b.going, sum(b.n) AS n, sum(b.h) AS h FROM (SELECT DISTINCT date_trunc('month', day)::DATE AS month FROM pt) a JOIN (SELECT date_trunc('month', day)::DATE AS month, going, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS h FROM pt GROUP BY 1, 2) b ON b.month < a.month AND b.month >= a.month - INTERVAL 12 MONTH GROUP BY 1, 2) r ON r.month = p.month AND r.going = p.going) GROUP BY 1").replace(" AS right FROM", " AS hits FROM"))
def e11(spark, d):
    p = participations(spark, d).select(F.trunc("day", "month").alias("m"), "going", (F.col("finish") == 1).alias("won"))
    monthly = p.groupBy("m", "going").agg(F.count("*").alias("n"), F.count_if("won").alias("h"))
    ahead = monthly.select("going", "n", "h", F.explode(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.add_months("m", k))).alias("m"))
    rate = ahead.groupBy("m", "going").agg((F.sum("h") / F.sum("n")).alias("rate"))
    return p.join(rate, ["m", "going"]).groupBy("m").agg(F.count("*").alias("n"), F.count_if(F.col("won") == (F.col("rate") >= 0.25)).alias("hits"))


#: Clusters are groups of events, so that the draws don't grow with the events.
GROUPS, RESAMPLES = 1000, 200
POISSON = pr.POISSON_ONE


@query("E12_bootstrap", with_pt("SELECT round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.5), 6) AS mid, round(quantile_cont(m, 0.975), 6) AS high, count(*) AS resamples FROM (SELECT b, sum(w * h) / sum(w * n)::DOUBLE AS m FROM (SELECT *, CASE " + " ".join(f"WHEN u < {c} THEN {k}" for k, c in enumerate(POISSON)) + f" ELSE 6 END AS w FROM (SELECT g, n, h, b, ('0x' || substr(md5('7:' || g || ':' || b), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM (SELECT event % {GROUPS} AS g, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS h FROM pt WHERE popularity = 1 GROUP BY 1), range({RESAMPLES}) r(b))) GROUP BY 1)"))
def e12(spark, d):
    """95 % interval of the favourites' hit rate over resampled groups of events: a weight for each (group, resample)."""
    fav = participations(spark, d).filter("popularity = 1")
    g = fav.groupBy((F.col("event") % GROUPS).alias("g")).agg(F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("h"))
    r = g.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(RESAMPLES - 1)))).withColumn("w", pr.poisson_weight(F.col("g"), F.col("b")))
    means = r.groupBy("b").agg((F.sum(F.col("w") * F.col("h")) / F.sum(F.col("w") * F.col("n"))).alias("m"))
    q = lambda p: F.round(F.percentile("m", p), 6)
    return means.agg(q(0.025).alias("low"), q(0.5).alias("mid"), q(0.975).alias("high"), F.count("*").alias("resamples"))


def _clusters_sql(kind: str, cluster: str) -> str:
    weight = "CASE " + " ".join(f"WHEN u < {c} THEN {k}" for k, c in enumerate(POISSON)) + " ELSE 6 END"
    return (f"SELECT '{kind}' AS cluster, any_value(k) AS clusters, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.5), 6) AS mid, round(quantile_cont(m, 0.975), 6) AS high, count(*) AS resamples FROM (SELECT b, count(*) AS k, round(sum(w * h) / sum(w * n)::DOUBLE, 9) AS m FROM (SELECT *, {weight} AS w FROM "
        f"(SELECT g, n, h, b, ('0x' || substr(md5('7:' || g || ':' || b), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM (SELECT {cluster} AS g, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS h FROM pt WHERE popularity = 1 GROUP BY 1), range({RESAMPLES}) r(b))) GROUP BY 1)")


@query("E12_clusters", with_pt(_clusters_sql("event", "event") + " UNION ALL " + _clusters_sql("day", "d_idx")))
def e12_clusters(spark, d):
    """95 % intervals of the favourites' hit rate with whole events and whole days as clusters.

    A cluster's Poisson weight in a resample is a hash of both, so that it is the same wherever its rows lie; each task
    adds up its clusters for all resamples before anything moves.
    """
    fav = participations(spark, d).filter("popularity = 1").select(F.explode(F.array(F.struct(F.lit("event").alias("cluster"), F.col("event").cast("long").alias("g")), F.struct(F.lit("day").alias("cluster"), F.col("d_idx").cast("long").alias("g")))).alias("c"), "finish")
    g = fav.groupBy(F.col("c.cluster").alias("cluster"), F.col("c.g").alias("g")).agg(F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("h"))
    sums = resampled_sums(g.withColumn("k", F.lit(1)), "g", ["cluster"], ["n", "h", "k"], RESAMPLES)
    means = sums.select("cluster", F.when(F.col("r") < 0, F.col("k")).cast("long").alias("k"), F.when(F.col("r") >= 0, F.round(F.col("h") / F.col("n"), 9)).alias("m"))
    q = lambda p: F.round(F.percentile("m", p), 6)
    return means.groupBy("cluster").agg(F.max("k").alias("clusters"), q(0.025).alias("low"), q(0.5).alias("mid"), q(0.975).alias("high"), F.count("m").alias("resamples"))


@query("E13_metrics", with_pt("""SELECT round(avg(-CASE WHEN won THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss,
  (SELECT round((sum(r) FILTER (WHERE won) - count(*) FILTER (WHERE won) * (count(*) FILTER (WHERE won) + 1) / 2.0::DOUBLE) / (count(*) FILTER (WHERE won) * count(*) FILTER (WHERE NOT won)), 6) FROM (SELECT won, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM pq)) AS auc,
  (SELECT round(sum(w * (lower + same / 2)) FILTER (WHERE won) / (sum(w) FILTER (WHERE won) * sum(w) FILTER (WHERE NOT won)), 6) FROM (SELECT won, w, coalesce(sum(CASE WHEN NOT won THEN w END) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - coalesce(sum(CASE WHEN NOT won THEN w END) OVER (PARTITION BY p), 0) AS lower, coalesce(sum(CASE WHEN NOT won THEN w END) OVER (PARTITION BY p), 0) AS same FROM pq)) AS weighted_auc,
  (SELECT count(*) FROM pq a JOIN pq b ON a.event = b.event AND a.won AND NOT b.won) AS pairs,
  (SELECT round(sum(CASE WHEN a.p > b.p THEN 1 WHEN a.p = b.p THEN 0.5 ELSE 0 END) / count(*), 6) FROM pq a JOIN pq b ON a.event = b.event AND a.won AND NOT b.won) AS concordance,
  (SELECT round(avg((finish <= 3)::INT), 6) FROM (SELECT finish, row_number() OVER (PARTITION BY event ORDER BY p DESC, runner_no) AS k FROM pq) WHERE k = 1) AS top1_in_top3
FROM pq""", PB, "pq AS (SELECT event, runner_no, finish, won, price AS w, greatest(least(round(p, 9), 1 - 1e-9), 1e-9) AS p FROM pb)"))
def e13(spark, d):
    """Log-loss, AUC, AUC weighted by price, share of (winner, other) pairs of an event in the right order, first pick placed."""
    p = F.greatest(F.least(F.round("p", 9), F.lit(1 - 1e-9)), F.lit(1e-9))
    rows = probs(spark, d).select("event", "runner_no", "finish", "won", F.col("price").alias("w"), p.alias("p"))
    # Ranks over the distinct values of p: counts by value, then running sums over those, within bins and over bins.
    won, lost = (lambda c: F.sum(F.when(F.col("won"), c).otherwise(0)), lambda c: F.sum(F.when(F.col("won"), 0).otherwise(c)))
    loss = F.sum(-F.when(F.col("won"), F.log("p")).otherwise(F.log(1 - F.col("p"))))
    v = rows.groupBy("p").agg(F.count("*").alias("n"), loss.alias("loss"), won(F.lit(1)).alias("h"), lost(F.lit(1)).alias("m"), won(F.col("w")).alias("hw"), lost(F.col("w")).alias("mw"))
    v = v.withColumn("bin", F.floor(F.col("p") * 1000))
    inner, over = Window.partitionBy("bin").orderBy("p"), Window.orderBy("bin")
    per = v.groupBy("bin").agg(F.sum("m").alias("bm"), F.sum("mw").alias("bw"))
    per = per.select("bin", (F.sum("bm").over(over) - F.col("bm")).alias("m0"), (F.sum("bw").over(over) - F.col("bw")).alias("w0"))  # 1001 rows at most
    r = v.select("*", (F.sum("m").over(inner) - F.col("m") / 2).alias("m1"), (F.sum("mw").over(inner) - F.col("mw") / 2).alias("w1")).join(F.broadcast(per), "bin")
    total = lambda c: F.sum(c)
    auc = total(F.col("h") * (F.col("m0") + F.col("m1"))) / (total("h") * total("m"))
    weighted = total(F.col("hw") * (F.col("w0") + F.col("w1"))) / (total("hw") * total("mw"))
    ranks = r.agg(F.round(total("loss") / total("n"), 6).alias("log_loss"), F.round(auc, 6).alias("auc"), F.round(weighted, 6).alias("weighted_auc"))
    e = Window.partitionBy("event")
    best = F.max(F.when(F.col("won"), F.col("p"))).over(e)
    k = F.row_number().over(e.orderBy(F.desc("p"), "runner_no"))
    near = rows.select("finish", "p", best.alias("best"), (~F.col("won") & best.isNotNull()).alias("other"), k.alias("k"))
    right = F.sum(F.when(F.col("other"), F.when(F.col("best") > F.col("p"), 1.0).when(F.col("best") == F.col("p"), 0.5).otherwise(0.0)))
    top = F.avg(F.when(F.col("k") == 1, (F.col("finish") <= 3).cast("int")))
    pairs = near.agg(F.count_if("other").alias("pairs"), F.round(right / F.count_if("other"), 6).alias("concordance"), F.round(top, 6).alias("top1_in_top3"))
    return ranks.crossJoin(F.broadcast(pairs))  # one row each


E14_SQL = with_pt("""SELECT venue, k, n, round(p, 6) AS p, round(least(1.0, max(step) OVER (ORDER BY p, venue)), 6) AS holm FROM (SELECT *, (count(*) OVER () - row_number() OVER (ORDER BY p, venue) + 1) * p AS step FROM (
  SELECT venue, k, n, least(1.0, 2 * list_sum(list_transform(range(least(k, n - k) + 1), lambda i: CASE WHEN n = 0 THEN 1.0 ELSE exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2.0)) END))) AS p
  FROM (SELECT venue, count(*) FILTER (WHERE a AND NOT b) AS k, count(*) FILTER (WHERE a <> b) AS n FROM (SELECT event, venue, bool_or(popularity = 1 AND finish = 1) AS a, bool_or(runner_no = 1 AND finish = 1) AS b FROM pt GROUP BY 1, 2) GROUP BY 1)))""")


@query("E14_mcnemar", E14_SQL)
def e14(spark, d):
    """Favourite against dearest as picks of the winner, by venue: exact p, and Holm's correction over the venues."""
    p = participations(spark, d)
    picks = p.groupBy("event", "venue").agg(F.bool_or((F.col("popularity") == 1) & (F.col("finish") == 1)).alias("a"), F.bool_or((F.col("runner_no") == 1) & (F.col("finish") == 1)).alias("b"))
    g = picks.groupBy("venue").agg(F.count_if(F.col("a") & ~F.col("b")).alias("k"), F.count_if(F.col("a") != F.col("b")).alias("n"))
    g = g.withColumn("p", pr.binomial_tail(F.col("k"), F.col("n")))
    m = g.agg(F.count("*").alias("m"))
    w = Window.orderBy("p", "venue")  # one row for each venue
    g = g.crossJoin(F.broadcast(m)).withColumn("step", (F.col("m") - F.row_number().over(w) + 1) * F.col("p"))
    return g.select("venue", "k", "n", F.round("p", 6).alias("p"), F.round(F.least(F.lit(1.0), F.max("step").over(w)), 6).alias("holm"))


@query("E15_uniformity", with_pt("SELECT venue, d, n, round(greatest(0, least(1, list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * k * k * ((sqrt(n) + 0.12 + 0.11 / sqrt(n)) * d) ** 2))))), 4) AS p FROM (SELECT venue, round(max(greatest(abs(u - k / n), abs(u - (k - 1) / n))), 6) AS d, max(n)::BIGINT AS n FROM (SELECT venue, u, row_number() OVER (PARTITION BY venue ORDER BY u, event)::DOUBLE AS k, count(*) OVER (PARTITION BY venue)::DOUBLE AS n FROM (SELECT venue, event, round((finish - 0.5) / field_size, 9)::DOUBLE AS u FROM pt WHERE popularity = 1)) GROUP BY 1)"))
def e15(spark, d):
    rows = participations(spark, d).filter("popularity = 1").select("venue", F.round((F.col("finish") - 0.5) / F.col("field_size"), 9).alias("u"))
    # Ties first: a value's steps are bounded by the running counts on either side of it.
    v = rows.groupBy("venue", "u").agg(F.count("*").alias("c"))
    w = Window.partitionBy("venue").orderBy("u")
    upto, n = F.sum("c").over(w), F.sum("c").over(Window.partitionBy("venue"))
    s = v.select("venue", "u", upto.alias("k"), (upto - F.col("c")).alias("j"), n.alias("n"))
    step = F.greatest(F.abs(F.col("u") - F.col("k") / F.col("n")), F.abs(F.col("u") - F.col("j") / F.col("n")))
    out = s.groupBy("venue").agg(F.round(F.max(step), 6).alias("d"), F.max("n").alias("n"))
    return out.withColumn("p", F.round(pr.kolmogorov(F.col("d"), F.col("n")), 4))


@query("E16_market_gap", with_pt("SELECT event, runner_no, round(ln(p) - ln(q), 6) AS gap, rank() OVER (PARTITION BY event ORDER BY p DESC)::INT AS rank_p, rank() OVER (PARTITION BY event ORDER BY q DESC)::INT AS rank_q FROM (SELECT event, runner_no, round(p, 9) AS p, round(price / sum(price) OVER (PARTITION BY event), 9) AS q FROM pb) WHERE p >= 0.1", PB))
def e16(spark, d):
    e = Window.partitionBy("event")
    rows = probs(spark, d).select("event", "runner_no", F.round("p", 9).alias("p"), F.round(F.col("price") / F.sum("price").over(e), 9).alias("q")).filter("p >= 0.1")
    return rows.select("event", "runner_no", F.round(F.log("p") - F.log("q"), 6).alias("gap"), F.rank().over(e.orderBy(F.desc("p"))).alias("rank_p"), F.rank().over(e.orderBy(F.desc("q"))).alias("rank_q"))


E16 = "mg AS (SELECT p.*, t.rider, t.d_idx, t.measure FROM pb p JOIN (SELECT event, runner_no, rider, d_idx, measure FROM pt) t USING (event, runner_no)), md AS (SELECT rider, d_idx, sum(measure) AS s, count(*) AS n, arg_max(measure, (-finish, event, runner_no)) AS top, min(finish) AS f FROM mg GROUP BY 1, 2), mn AS (SELECT rider, d_idx, sum(s) OVER w / sum(n) OVER w AS norm, arg_max(top, (-f, d_idx)) OVER w AS best FROM md WINDOW w AS (PARTITION BY rider ORDER BY d_idx RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"


@query("E16_field_weights", with_pt("SELECT event, runner_no, round(measure - avg(measure) OVER e, 6) AS rel, round((measure - avg(measure) OVER e) / nullif(stddev_samp(measure) OVER e, 0), 6) AS z, round(percent_rank() OVER (PARTITION BY event ORDER BY measure), 6) AS pct, round(measure - norm, 6) AS vs_norm, round(measure - best, 6) AS vs_best, round(p, 9) >= 0.15 AND round(p * (1 / (discount + 0.05)), 9) >= 1.5 AND 1 / (discount + 0.05) BETWEEN 8 AND 18 AS picked FROM mg JOIN mn USING (rider, d_idx) WINDOW e AS (PARTITION BY event)", PB, E16))
def field_weights(spark, d):
    """A runner's weight (measure) against the field's mean, spread and ranks, against its rider's norm of all earlier days
    and the value of the best earlier result, and whether rules on probability, expectation and odds pick it."""
    t = participations(spark, d).select("event", "runner_no", "rider", "d_idx", "measure")
    rows = probs(spark, d).select("event", "runner_no", "finish", "discount", "p").join(t, ["event", "runner_no"])
    top = F.struct(-F.col("finish"), "event", "runner_no")
    days = rows.groupBy("rider", "d_idx").agg(F.sum("measure").alias("s"), F.count("*").alias("n"), F.max_by("measure", top).alias("top"), F.min("finish").alias("f"))
    w = Window.partitionBy("rider").orderBy("d_idx").rangeBetween(Window.unboundedPreceding, -1)
    past = days.select("rider", "d_idx", (F.sum("s").over(w) / F.sum("n").over(w)).alias("norm"), F.max_by("top", F.struct(-F.col("f"), "d_idx")).over(w).alias("best"))
    e, m = Window.partitionBy("event"), F.col("measure")
    rel = m - F.avg("measure").over(e)
    sd = F.when(F.count("*").over(e) > 1, F.nullif(F.stddev_samp("measure").over(e), F.lit(0.0)))
    # To nine digits, or the order in which an event's probabilities were added up decides at the bounds.
    odds = 1 / (F.col("discount") + 0.05)
    picked = (F.round("p", 9) >= 0.15) & (F.round(F.col("p") * odds, 9) >= 1.5) & odds.between(8, 18)
    return rows.join(past, ["rider", "d_idx"]).select(
        "event", "runner_no", F.round(rel, 6).alias("rel"), F.round(F.try_divide(rel, sd), 6).alias("z"), F.round(F.percent_rank().over(e.orderBy("measure")), 6).alias("pct"),
        F.round(m - F.col("norm"), 6).alias("vs_norm"), F.round(m - F.col("best"), 6).alias("vs_best"), picked.alias("picked"),
    )


MARKS = ["best", "second", "third"]


@query("E17_marks", with_pt("SELECT event, runner_no, CASE k WHEN 1 THEN 'best' WHEN 2 THEN 'second' WHEN 3 THEN 'third' END AS mark, round(p / sum(p) OVER (PARTITION BY event), 6) AS p FROM (SELECT *, row_number() OVER (PARTITION BY event ORDER BY round(p, 9) DESC, runner_no) AS k FROM pb JOIN (SELECT event AS e2, runner_no AS r2, status FROM pt) s ON event = e2 AND runner_no = r2 WHERE status <> 'O')", PB))
def e17(spark, d):
    """Marks by rank of probability among those that run; the rest is normalised again without the withdrawn."""
    gone = participations(spark, d).filter("status = 'O'").select("event", "runner_no")
    rows = probs(spark, d).join(gone, ["event", "runner_no"], "left_anti")
    e = Window.partitionBy("event")
    k = F.row_number().over(e.orderBy(F.desc(F.round("p", 9)), "runner_no"))
    return rows.select("event", "runner_no", F.get(F.array(*map(F.lit, MARKS)), k - 1).alias("mark"), F.round(F.col("p") / F.sum("p").over(e), 6).alias("p"))


@query("E18_residual_probe", with_pt("""SELECT q, count(*) AS n, round(avg(r), 6) AS mean, (SELECT round(2 * sqrt(sum(e * e)) / sum(c), 6) FROM (SELECT sum(r - m) AS e, count(*) AS c FROM (SELECT event, r, avg(r) OVER () AS m FROM rq b WHERE b.q = rq.q) GROUP BY event)) AS twice_se,
  (SELECT count(*) FILTER (WHERE m > 0) FROM (SELECT round(avg(r), 9) AS m FROM rq b WHERE b.q = rq.q GROUP BY yr)) AS years_up, count(DISTINCT yr) AS years FROM rq GROUP BY q""", PB,
  "rq AS (SELECT event, yr, r, least(5, 1 + floor(5 * (below + same / 2) / n))::INT AS q FROM (SELECT event, yr, r, count(*) OVER (PARTITION BY venue ORDER BY measure RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE - same AS below, same, n FROM (SELECT p.event, year(p.day) AS yr, p.venue, t.measure, p.won::INT - p.p AS r, count(*) OVER (PARTITION BY p.venue, t.measure)::DOUBLE AS same, count(*) OVER (PARTITION BY p.venue)::DOUBLE AS n FROM pb p JOIN (SELECT event, runner_no, measure FROM pt) t USING (event, runner_no))))"))
def e18(spark, d):
    """Residuals by fifth of a feature within its venue: mean, twice the standard error over events, sign of each year.

    Fifths are cut by counts of values, so that ties stay together and no window holds a venue's rows.
    """
    p = participations(spark, d).select("event", "runner_no", "measure")
    rows = probs(spark, d).join(p, ["event", "runner_no"]).withColumn("r", F.col("won").cast("int") - F.col("p"))
    v = rows.groupBy("venue", "measure").agg(F.count("*").alias("same"))
    w = Window.partitionBy("venue")
    place = (F.sum("same").over(w.orderBy("measure")) - F.col("same") / 2) / F.sum("same").over(w)
    fifth = v.select(F.col("venue"), F.col("measure"), F.least(F.lit(5).cast("long"), 1 + F.floor(5 * place)).cast("int").alias("q"))
    rows = rows.join(fifth, ["venue", "measure"]).select("q", "event", F.year("day").alias("yr"), "r")
    means = rows.groupBy("q").agg(F.count("*").alias("n"), F.avg("r").alias("m"), F.count_distinct("yr").alias("years"))
    events = rows.groupBy("q", "event").agg(F.sum("r").alias("s"), F.count("*").alias("c")).join(F.broadcast(means), "q")  # five rows
    error = events.groupBy("q").agg((2 * F.sqrt(F.sum(F.pow(F.col("s") - F.col("c") * F.col("m"), 2))) / F.sum("c")).alias("se"))
    years = rows.groupBy("q", "yr").agg(F.round(F.avg("r"), 9).alias("ym")).groupBy("q").agg(F.count_if(F.col("ym") > 0).alias("years_up"))
    return means.join(error, "q").join(years, "q").select("q", "n", F.round("m", 6).alias("mean"), F.round("se", 6).alias("twice_se"), "years_up", "years")


#: Feature groups of a probability and their weights in its exponent. Fixed values.
PARTS = {"market": 0.6, "weight": 0.3, "form": 0.5}
E18A = ("hs AS (SELECT entity, d_idx, sum(n) OVER w AS n, sum(h) OVER w AS h FROM (SELECT entity, d_idx, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS h FROM pt GROUP BY 1, 2) WINDOW w AS (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
    "ft AS (SELECT p.event, p.runner_no, p.won, year(p.day)::INT AS yr, ln(p.p) AS market, ln(t.measure) AS weight, ln((coalesce(h.h, 0) + 1) / (coalesce(h.n, 0) + 5)) AS form FROM pb p JOIN (SELECT event, runner_no, measure, d_idx FROM pt) t USING (event, runner_no) JOIN hs h ON h.entity = p.entity AND h.d_idx = t.d_idx)",
    "sc AS (" + " UNION ALL ".join(f"SELECT '{out}' AS part, event, runner_no, won, yr, exp({' + '.join(f'{w} * {k}' for k, w in PARTS.items() if k != out)}) AS s FROM ft" for out in ("none", *PARTS)) + ")",
    "ly AS (SELECT part, yr, count(*) AS n, sum(loss) AS loss FROM (SELECT part, yr, won, -ln(s / sum(s) OVER (PARTITION BY part, event)) AS loss FROM sc) WHERE won GROUP BY 1, 2)",
    "la AS (SELECT a.part, a.yr, a.n, a.loss - b.loss AS delta FROM ly a JOIN ly b ON b.part = 'none' AND b.yr = a.yr WHERE a.part <> 'none')")


@query("E18_ablation", with_pt("SELECT part, sum(n)::BIGINT AS n, round(sum(delta) / sum(n), 6) AS delta, count(*) FILTER (WHERE delta > 0) AS years_up, count(*) AS years FROM la GROUP BY 1", PB, *E18A))
def e18_ablation(spark, d):
    """What each feature group is worth: by how much the winners' log loss rises without it, and in how many years."""
    p = participations(spark, d).select("event", "runner_no", "entity", "d_idx", "measure", "finish")
    days = p.groupBy("entity", "d_idx").agg(F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("h"))
    w = Window.partitionBy("entity").orderBy("d_idx").rangeBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    past = days.select("entity", "d_idx", F.log((total("h") + 1) / (total("n") + 5)).alias("form"))
    rows = probs(spark, d).select("event", "runner_no", "day", "won", "p").join(p, ["event", "runner_no"]).join(past, ["entity", "d_idx"])
    logs = {"market": F.log("p"), "weight": F.log("measure"), "form": F.col("form")}
    e = Window.partitionBy("event")
    losses = []
    for out in ("none", *PARTS):
        s = sum((w * logs[k] for k, w in PARTS.items() if k != out), F.lit(0.0))
        losses.append((-F.log(F.exp(s) / F.sum(F.exp(s)).over(e))).alias(out))  # one window for all
    won = rows.select("won", F.year("day").alias("yr"), *losses).filter("won")
    years = won.groupBy("yr").agg(F.count("*").alias("n"), *[F.sum(F.col(k) - F.col("none")).alias(k) for k in PARTS])
    parts = years.select("n", F.inline(F.array(*[F.struct(F.lit(k).alias("part"), F.col(k).alias("d")) for k in PARTS])))
    return parts.groupBy("part").agg(F.sum("n").alias("n"), F.round(F.sum("d") / F.sum("n"), 6).alias("delta"), F.count_if(F.col("d") > 0).alias("years_up"), F.count("*").alias("years"))


def _past_form(p):
    """Log of the win rate before the day, shrunk to one in five, by entity and day."""
    days = p.groupBy("entity", "d_idx").agg(F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("h"))
    w = Window.partitionBy("entity").orderBy("d_idx").rangeBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    return days.select("entity", "d_idx", F.log((total("h") + 1) / (total("n") + 5)).alias("form"))


#: The last year that the refitted models learn from.
LEARN_UNTIL = 1998


def refit_rows(spark, d):
    """Rows once for each left-out feature group, whose column is 0 there."""
    p = participations(spark, d).select("event", "runner_no", "entity", "d_idx", "measure", "finish")
    rows = probs(spark, d).select("event", "runner_no", F.year("day").alias("yr"), "won", "p").join(p, ["event", "runner_no"]).join(_past_form(p), ["entity", "d_idx"])
    rows = rows.select("event", "yr", F.col("won").cast("int").alias("won"), F.log("p").alias("market"), F.log("measure").alias("weight"), "form")
    rows = rows.withColumn("part", F.explode(F.array(*[F.lit(x) for x in ("none", *PARTS)])))
    return rows.select("part", "event", "yr", "won", *[F.when(F.col("part") == c, 0.0).otherwise(F.col(c)).alias(c) for c in PARTS])


@query("E18_refits")
def e18_refits(spark, d):
    """What each feature group is worth when the model is fitted anew without it: all fits are one grouped regression on
    the years until LEARN_UNTIL; the log loss of later years' winners, normalised within events, tells the rest."""
    from ..operators import models
    from ..operators.baseline import written

    rows = written(refit_rows(spark, d), "refit-rows")
    model = models.softmax_fit(rows.filter(F.col("yr") <= LEARN_UNTIL), ["part"], list(PARTS), "won", 2)
    later = models.score(rows.filter(F.col("yr") > LEARN_UNTIL), model, ["part"], list(PARTS), ["lost", "p"])
    share = F.col("p") / F.sum("p").over(Window.partitionBy("part", "event"))
    loss = later.withColumn("loss", -F.log(share)).filter("won = 1").groupBy("part", "yr").agg(F.count("*").alias("n"), F.sum("loss").alias("loss"))
    full = loss.filter("part = 'none'").select("yr", F.col("loss").alias("least"))
    g = loss.filter("part <> 'none'").join(full, "yr").withColumn("d", F.col("loss") - F.col("least")).groupBy("part")
    return g.agg(F.sum("n").alias("n"), stats.half_up(F.sum("d") / F.sum("n"), 6).alias("delta"), F.count_if(F.col("d") > 0).alias("years_up"), F.count("*").alias("years"))


MODEL = ["rate", "n", "popularity"]


def model_rows(spark, d, keep=("popularity", "finish")):
    """As-of features of each row: hit rate and rows of the 365 days before, and popularity."""
    from .windows import asof_rate

    rows = asof_rate(spark, d, 365, keep=keep)
    number = lambda c: F.col(c).cast("double").alias(c)
    return rows.select("event", "runner_no", F.coalesce("rate", F.lit(0.0)).alias("rate"), number("n"), number("popularity"), *[c for c in keep if c != "popularity"])


@query("E19_model")
def e19(spark, d):
    """Logistic regression of a win on as-of features."""
    from ..operators import models

    rows = model_rows(spark, d).withColumn("all", F.lit(0)).withColumn("won", (F.col("finish") == 1).cast("int"))
    model = models.softmax_fit(rows, ["all"], MODEL, "won", 2)
    return models.score(rows, model, ["all"], MODEL, ["lost", "p"]).select("event", "runner_no", stats.half_up(F.col("p"), 6).alias("p"))


@query("E19_venue_classes")
def e19_venues(spark, d):
    """Three classes (unplaced, second or third, won) with a model for each venue, all fitted side by side."""
    from ..operators import models

    rows = model_rows(spark, d, keep=("popularity", "finish", "venue"))
    rows = rows.withColumn("class", F.when(F.col("finish") == 1, 2).when(F.col("finish") <= 3, 1).otherwise(0))
    model = models.softmax_fit(rows, ["venue"], MODEL, "class", 3)
    out = models.score(rows, model, ["venue"], MODEL, ["p_unplaced", "p_placed", "p_won"])
    return out.select("event", "runner_no", "venue", *[stats.half_up(F.col(c), 6).alias(c) for c in ("p_unplaced", "p_placed", "p_won")])


@query("E20_strongest", with_pt("SELECT event, round(a - b, 6) AS lead FROM (SELECT event, max(CASE WHEN k = 1 THEN p END) AS a, max(CASE WHEN k = 2 THEN p END) AS b FROM (SELECT event, round(p, 9) AS p, row_number() OVER (PARTITION BY event ORDER BY round(p, 9) DESC, runner_no) AS k FROM pb) WHERE k <= 2 GROUP BY 1) WHERE b IS NOT NULL ORDER BY round(a - b, 6) DESC, event LIMIT 20", PB).replace(" AS lead FROM", " AS ahead FROM"))
def e20(spark, d):
    k = F.row_number().over(Window.partitionBy("event").orderBy(F.desc(F.round("p", 9)), "runner_no"))
    top = probs(spark, d).select("event", F.round("p", 9).alias("p"), k.alias("k")).filter("k <= 2")
    g = top.groupBy("event").agg(F.max(F.when(F.col("k") == 1, F.col("p"))).alias("a"), F.max(F.when(F.col("k") == 2, F.col("p"))).alias("b"))
    return g.filter("b IS NOT NULL").select("event", F.round(F.col("a") - F.col("b"), 6).alias("ahead")).orderBy(F.desc("ahead"), "event").limit(20)
