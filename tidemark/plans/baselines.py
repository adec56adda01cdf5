"""Queries of the B family."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import asof
from ..operators import baseline as bl
from ..operators import probability as pr
from ..operators import selection, stats
from ..operators.resampling import resampled_sums
from ..operators.rolling import rolling
from ..sources import commits
from ..sources.io import new_path, written
from .demo import hu, participations, query, with_pt
from .windows import DAYBIAS, day_bias

FINE = "SELECT a.venue, a.going, a.class, a.d_idx, median(b.price) AS m FROM (SELECT DISTINCT venue, going, class, d_idx FROM pt) a JOIN pt b ON a.venue = b.venue AND a.going = b.going AND a.class = b.class AND b.d_idx BETWEEN a.d_idx - 1095 AND a.d_idx - 1 GROUP BY ALL HAVING count(*) >= 8"
COARSE = "SELECT a.venue, a.going, a.d_idx, median(b.price) AS m FROM (SELECT DISTINCT venue, going, d_idx FROM pt) a JOIN pt b ON a.venue = b.venue AND a.going = b.going AND b.d_idx BETWEEN a.d_idx - 365 AND a.d_idx - 1 GROUP BY ALL HAVING count(*) >= 8"
LEVELS = [("fine", ["venue", "going", "class"], 1095), ("coarse", ["venue", "going"], 365)]
B1 = (f"b1f AS ({FINE})", f"b1c AS ({COARSE})", "b1 AS (SELECT p.*, coalesce(f.m, c.m) AS baseline, CASE WHEN f.m IS NOT NULL THEN 'fine' WHEN c.m IS NOT NULL THEN 'coarse' END AS level FROM pt p LEFT JOIN b1f f USING (venue, going, class, d_idx) LEFT JOIN b1c c USING (venue, going, d_idx))")


def baselines(p):
    rows = p.select("event", "runner_no", "venue", "going", "class", "d_idx", "day", "finish", "distance", "price")
    return bl.asof_medians(rows, LEVELS, day="d_idx", value="price")


@query("B1_fallback_median", with_pt("SELECT event, runner_no, round(baseline, 4) AS baseline, level FROM b1", *B1))
def fallback_median(spark, d):
    rows = participations(spark, d).select("event", "runner_no", "venue", "going", "class", "d_idx", "price")
    return bl.asof_medians(rows, LEVELS, day="d_idx", value="price").select("event", "runner_no", F.round("baseline", 4).alias("baseline"), "level")


@query("B2_day_value", with_pt(f"SELECT venue, d_idx, {hu('median(v)')} AS value, count(*) AS events FROM (SELECT venue, d_idx, event, median((price - baseline) / distance * 1000) AS v FROM b1 WHERE baseline IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 3) GROUP BY 1, 2 HAVING count(*) >= 2", *B1))
def day_value(spark, d):
    b = baselines(participations(spark, d)).filter("baseline IS NOT NULL")
    e = b.groupBy("venue", "d_idx", "event").agg(F.percentile((F.col("price") - F.col("baseline")) / F.col("distance") * 1000, 0.5).alias("v"), F.count("*").alias("n")).filter("n >= 3")
    return e.groupBy("venue", "d_idx").agg(stats.half_up(F.percentile("v", 0.5)).alias("value"), F.count("*").alias("events")).filter("events >= 2")


@query("B2_condition_value", with_pt(f"SELECT venue, d_idx, going, {hu('median(v)')} AS value, count(*) AS events FROM (SELECT venue, d_idx, going, event, median((price - baseline) / distance * 1000) AS v FROM b1 WHERE baseline IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= 2) GROUP BY 1, 2, 3", *B1))
def condition_value(spark, d):
    """The day value of each condition on its own."""
    b = baselines(participations(spark, d)).filter("baseline IS NOT NULL")
    e = b.groupBy("venue", "d_idx", "going", "event").agg(F.percentile((F.col("price") - F.col("baseline")) / F.col("distance") * 1000, 0.5).alias("v"), F.count("*").alias("n")).filter("n >= 2")
    return e.groupBy("venue", "d_idx", "going").agg(stats.half_up(F.percentile("v", 0.5)).alias("value"), F.count("*").alias("events"))


@query("B3_rank_matched", with_pt("SELECT p.event, p.runner_no, round(median(q.price), 4) AS baseline, count(*) AS n FROM pt p JOIN pt q ON q.venue = p.venue AND q.finish = p.finish AND q.d_idx BETWEEN p.d_idx - 180 AND p.d_idx - 1 WHERE p.finish <= 5 GROUP BY 1, 2 HAVING count(*) >= 8"))
def rank_matched(spark, d):
    p = participations(spark, d).filter("finish <= 5")
    known = written(p.groupBy("venue", "finish", "d_idx", "price").agg(F.count("*").alias("times")), "prices")
    probe = known.select("venue", "finish", "d_idx").distinct()
    med = rolling(probe, known, by=["venue", "finish"], day="d_idx", value="price", times="times", days=180).filter("window_n >= 8")
    med = med.select("venue", "finish", "d_idx", F.round("window", 4).alias("baseline"), F.col("window_n").alias("n"))
    return p.join(med, ["venue", "finish", "d_idx"]).select("event", "runner_no", "baseline", "n")


B4 = (
    "rv AS (SELECT *, price - baseline AS v FROM b1 WHERE baseline IS NOT NULL)",
    "ab AS (SELECT event, runner_no, sum(v * pow(0.8, k - 1)) / sum(pow(0.8, k - 1)) AS ability FROM (SELECT a.event, a.runner_no, q.v, row_number() OVER (PARTITION BY a.event, a.runner_no ORDER BY q.d_idx DESC, q.event DESC, q.runner_no DESC) AS k FROM rv a JOIN rv q ON q.entity = a.entity AND q.d_idx < a.d_idx) WHERE k <= 5 GROUP BY 1, 2)",
)


@query("B4_blended", with_pt(f"SELECT venue, d_idx, count(*) AS n, {hu('(median(v) + coalesce(median(v - ability), median(v))) / 2', 2)} AS value FROM rv LEFT JOIN ab USING (event, runner_no) GROUP BY 1, 2", *B1, *B4))
def blended(spark, d):
    """Half the day value, half what the participants' own earlier values project (a decayed mean of their last five)."""
    p = participations(spark, d)
    rows = p.select("event", "runner_no", "entity", "venue", "going", "class", "d_idx", "price")
    rows = bl.written(bl.asof_medians(rows, LEVELS, day="d_idx", value="price").filter("baseline IS NOT NULL").withColumn("v", F.col("price") - F.col("baseline")), "values")
    last = asof.last_before(rows, ["entity"], "d_idx", ["event", "runner_no"], ["v"], 5)
    weights = F.transform("last", lambda x, i: F.pow(F.lit(0.8), i))
    top = F.aggregate(F.zip_with("last", weights, lambda r, k: r["v"] * k), F.lit(0.0), lambda a, x: a + x)
    last = last.select("entity", "d_idx", F.try_divide(top, F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)).alias("ability"))
    day = rows.join(last, ["entity", "d_idx"]).groupBy("venue", "d_idx").agg(F.percentile("v", 0.5).alias("own"), F.percentile(F.col("v") - F.col("ability"), 0.5).alias("projected"), F.count("*").alias("n"))
    return day.select("venue", "d_idx", "n", stats.half_up((F.col("own") + F.coalesce("projected", "own")) / 2, 2).alias("value"))


#: What a month's values weigh against those of the month after it.
FADE = 0.9
MONTH = "year(day) * 12 + month(day)"
B4M = (
    f"mv AS (SELECT *, {MONTH} AS m, price - baseline AS v FROM b1 WHERE baseline IS NOT NULL)",
    "mo AS (SELECT entity, m, sum(v) AS s, count(*) AS n FROM mv GROUP BY 1, 2)",
    f"pj AS (SELECT a.entity, a.m, sum(b.s * pow({FADE}, a.m - b.m)) / sum(b.n * pow({FADE}, a.m - b.m)) AS p FROM mo a JOIN mo b ON b.entity = a.entity AND b.m < a.m GROUP BY 1, 2)",
    "an AS (SELECT m, avg(p) AS zero FROM pj GROUP BY 1)",
)


@query("B4_monthly_anchor", with_pt(f"SELECT venue, d_idx, count(*) AS n, {hu('(median(v) + coalesce(median(v - (p - zero)), median(v))) / 2', 2)} AS value FROM mv LEFT JOIN pj USING (entity, m) LEFT JOIN an USING (m) GROUP BY 1, 2", *B1, *B4M))
def monthly_anchor(spark, d):
    """Half the day value, half what participants' values of all earlier months project, anchored anew each month.

    A projection is the mean of an entity's values so far, each month weighing FADE of the next; a month's projections are
    shifted to mean zero, so that they tell participants apart and leave the level to the day. A participant without
    earlier months has no projection, and a day without any takes its own value.
    """
    p = participations(spark, d).select("event", "runner_no", "entity", "venue", "going", "class", "d_idx", "day", "price")
    rows = bl.asof_medians(p, LEVELS, day="d_idx", value="price").filter("baseline IS NOT NULL")
    rows = bl.written(rows.select("entity", "venue", "d_idx", F.expr(MONTH).alias("m"), (F.col("price") - F.col("baseline")).alias("v")), "values")
    months = rows.groupBy("entity", "m").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    before = Window.partitionBy("entity").orderBy("m").rangeBetween(Window.unboundedPreceding, -1)
    last = F.max("m").over(Window.partitionBy("entity"))
    faded = F.pow(F.lit(FADE), last - F.col("m"))  # the same weights but for a factor of the entity
    months = months.select("entity", "m", "s", "n", faded.alias("f"))
    projected = F.try_divide(F.sum(F.col("s") * F.col("f")).over(before), F.sum(F.col("n") * F.col("f")).over(before))
    projected = months.select("entity", "m", projected.alias("p")).filter("p IS NOT NULL")
    projected = bl.written(projected, "projections")
    zero = projected.groupBy("m").agg(F.avg("p").alias("zero"))
    projected = projected.join(zero, "m").select("entity", "m", (F.col("p") - F.col("zero")).alias("ability"))
    day = rows.join(projected, ["entity", "m"], "left").groupBy("venue", "d_idx")
    day = day.agg(F.percentile("v", 0.5).alias("own"), F.percentile(F.col("v") - F.col("ability"), 0.5).alias("projected"), F.count("*").alias("n"))
    return day.select("venue", "d_idx", "n", stats.half_up((F.col("own") + F.coalesce("projected", "own")) / 2, 2).alias("value"))


@query("B5_frozen_history", with_pt(f"SELECT venue, d_idx, {hu('bias')} AS bias, d_idx < 0 AS frozen FROM wb", DAYBIAS))
def frozen_history(spark, d):
    b = day_bias(participations(spark, d)).select("venue", "d_idx", stats.half_up(F.col("bias")).alias("bias"))
    old = b.filter("d_idx < 0").withColumn("frozen", F.lit(True))
    return old.unionByName(b.filter("d_idx >= 0").withColumn("frozen", F.lit(False)))


ROUNDS = 10


def alternating_sql(rows: str, factors: list[str], value: str, rounds: int) -> list[str]:
    """The rounds of `alternating_medians` as a chain of common tables; the last effect of factor f is f_{rounds}."""
    out, have = [], {}
    for k in range(1, rounds + 1):
        for f in factors:
            others = [g for g in factors if g != f and g in have]
            joins = " ".join(f"JOIN {have[g]} USING ({g})" for g in others)
            rest = " - ".join([value, *[f"{have[g]}.effect" for g in others]])
            out.append(f"e_{f}_{k} AS MATERIALIZED (SELECT {f}, median({rest}) AS effect FROM {rows} {joins} GROUP BY 1)")
            have[f] = f"e_{f}_{k}"
    return out


B6 = ("cb AS (SELECT class, distance, median(price) AS base FROM pt GROUP BY 1, 2)", "rs AS MATERIALIZED (SELECT sire, d_idx, price - base AS r FROM pt JOIN cb USING (class, distance))")
B13 = ("wn AS MATERIALIZED (SELECT class, venue, d_idx, price, measure, event FROM pt WHERE finish = 1)", *alternating_sql("wn", ["class", "venue", "d_idx"], "price", ROUNDS))


@query("B6_group_differences", with_pt(f"SELECT sire, round(effect, 2) AS effect FROM e_sire_{ROUNDS}", *B6, *alternating_sql("rs", ["d_idx", "sire"], "r", ROUNDS)))
def group_differences(spark, d):
    """Day and sire effects on the residual over the class median, alternating ten times."""
    p = participations(spark, d).groupBy("class", "distance", "sire", "d_idx", "price").agg(F.count("*").alias("times"))
    p = bl.written(p, "prices")
    base = selection.percentiles(p, ["class", "distance"], "price", times="times").withColumnRenamed("percentile", "base")
    r = p.join(base, ["class", "distance"]).select("sire", "d_idx", (F.col("price") - F.col("base")).alias("r"), "times")
    return bl.alternating_medians(r, ["d_idx", "sire"], "r", rounds=ROUNDS, times="times")["sire"].select("sire", F.round("effect", 2).alias("effect"))


B6F = ("cm AS (SELECT class, distance, median(measure) AS base FROM pt WHERE 2 * runner_no <= field_size GROUP BY 1, 2)", "fs AS MATERIALIZED (SELECT sire, d_idx, measure - base AS r FROM pt JOIN cm USING (class, distance) WHERE 2 * runner_no <= field_size)")


@query("B6_front_split", with_pt(f"SELECT sire, n, round(effect, 2) AS effect FROM e_sire_{ROUNDS} JOIN (SELECT sire, count(*) AS n FROM fs GROUP BY 1) USING (sire)", *B6F, *alternating_sql("fs", ["d_idx", "sire"], "r", ROUNDS)))
def front_split(spark, d):
    """The same on the measure of the field's front half, with the rows behind each effect."""
    p = participations(spark, d).filter(2 * F.col("runner_no") <= F.col("field_size")).select("class", "distance", "sire", "d_idx", "measure")
    base = selection.percentiles(p, ["class", "distance"], "measure").withColumnRenamed("percentile", "base")
    r = bl.written(p.join(base, ["class", "distance"]).select("sire", "d_idx", (F.col("measure") - F.col("base")).alias("r")), "residual")
    e = bl.alternating_medians(r, ["d_idx", "sire"], "r", rounds=ROUNDS)["sire"]
    return e.join(r.groupBy("sire").agg(F.count("*").alias("n")), "sire").select("sire", "n", F.round("effect", 2).alias("effect"))


@query("B7_deviation_words", with_pt("SELECT venue, d_idx, CASE WHEN bias < lo THEN 'low' WHEN bias > hi THEN 'high' ELSE 'normal' END AS word FROM wb JOIN (SELECT venue, quantile_cont(bias, 0.1) AS lo, quantile_cont(bias, 0.9) AS hi FROM wb GROUP BY 1 HAVING count(*) >= 30) USING (venue)", DAYBIAS))
def deviation_words(spark, d):
    b = day_bias(participations(spark, d))
    q = b.groupBy("venue").agg(F.percentile("bias", 0.1).alias("lo"), F.percentile("bias", 0.9).alias("hi"), F.count("*").alias("n")).filter("n >= 30")
    word = F.when(F.col("bias") < F.col("lo"), "low").when(F.col("bias") > F.col("hi"), "high").otherwise("normal")
    return b.join(q, "venue").select("venue", "d_idx", word.alias("word"))


#: Days that a cell needs for ranges of its own.
CELL_DAYS = 30
B8 = (
    "vy AS (SELECT venue, year(day) AS yr, count(*) AS n, min(d_idx) AS first FROM pt GROUP BY 1, 2)",
    "vc AS (SELECT *, CASE WHEN lag(n) OVER w IS NULL OR 10 * abs(n - lag(n) OVER w) > lag(n) OVER w THEN first END AS cut FROM vy WINDOW w AS (PARTITION BY venue ORDER BY yr))",
    "rg AS (SELECT venue, yr, max(cut) OVER (PARTITION BY venue ORDER BY yr) AS regime FROM vc)",
    f"gd AS (SELECT venue, going, regime, d_idx, {hu('avg(popularity - finish)', 6)} AS g FROM pt JOIN rg USING (venue) WHERE rg.yr = year(day) GROUP BY 1, 2, 3, 4)",
    *[f"{n} AS (SELECT {keys}, count(*) AS n, median(g) AS mid, quantile_cont(g, 0.1) AS p10, quantile_cont(g, 0.9) AS p90 FROM gd GROUP BY {keys})" for n, keys in (("gr", "venue, going, regime"), ("ga", "venue, going"))],
)


@query("B8_normal_ranges", with_pt(f"""SELECT venue, going, regime, gr.n, CASE WHEN gr.n >= {CELL_DAYS} THEN 'regime' ELSE 'all' END AS level, """ + ", ".join(f"{hu(f'CASE WHEN gr.n >= {CELL_DAYS} THEN gr.{c} ELSE ga.{c} END')} AS {c}" for c in ("mid", "p10", "p90")) + " FROM gr JOIN ga USING (venue, going)", *B8))
def normal_ranges(spark, d):
    """Median and outer deciles of a running-day contrast by venue and condition, within the venue's regime as of the day.

    A venue's regime begins in its first year and in each year whose rows differ by more than a tenth from the year
    before. Cells of fewer than CELL_DAYS days take the ranges of the venue and condition over all regimes.
    """
    p = participations(spark, d).withColumn("yr", F.year("day"))
    years = p.groupBy("venue", "yr").agg(F.count("*").alias("n"), F.min("d_idx").alias("first"))
    w = Window.partitionBy("venue").orderBy("yr")
    last = F.lag("n").over(w)
    cuts = years.withColumn("cut", F.when(last.isNull() | (10 * F.abs(F.col("n") - last) > last), F.col("first")))
    regimes = cuts.select("venue", "yr", F.max("cut").over(w).alias("regime"))
    contrast = stats.half_up(F.avg(F.col("popularity") - F.col("finish")), 6).alias("g")
    g = p.groupBy("venue", "going", "yr", "d_idx").agg(contrast).join(regimes, ["venue", "yr"])
    quantiles = [F.percentile("g", q).alias(c) for c, q in (("mid", 0.5), ("p10", 0.1), ("p90", 0.9))]
    own = g.groupBy("venue", "going", "regime").agg(F.count("*").alias("n"), *quantiles)
    wide = g.groupBy("venue", "going").agg(*[q.alias(f"all_{c}") for q, c in zip(quantiles, ("mid", "p10", "p90"), strict=True)])
    enough = F.col("n") >= CELL_DAYS
    pick = lambda c: stats.half_up(F.when(enough, F.col(c)).otherwise(F.col(f"all_{c}"))).alias(c)
    return own.join(wide, ["venue", "going"]).select("venue", "going", "regime", "n", F.when(enough, "regime").otherwise("all").alias("level"), pick("mid"), pick("p10"), pick("p90"))


@query("B9_own_excluded", with_pt("SELECT p.event, p.runner_no, round(median(q.measure), 4) AS others FROM pt p JOIN pt q ON q.venue = p.venue AND q.d_idx = p.d_idx AND (q.event, q.runner_no) <> (p.event, p.runner_no) GROUP BY 1, 2"))
def own_excluded(spark, d):
    p = participations(spark, d).select("event", "runner_no", "venue", "d_idx", "measure")
    out = bl.median_of_others(p, ["venue", "d_idx"], "measure", ["event", "runner_no"]).filter("others IS NOT NULL")
    return out.select("event", "runner_no", F.round("others", 4).alias("others"))


@query("B10_pace_labels", with_pt("SELECT event, CASE WHEN m < quantile_cont(m, 0.25) OVER v THEN 'fast' WHEN m < quantile_cont(m, 0.5) OVER v THEN 'quick' WHEN m < quantile_cont(m, 0.75) OVER v THEN 'even' ELSE 'slow' END AS pace FROM (SELECT event, venue, min(price) AS m FROM pt GROUP BY 1, 2) WINDOW v AS (PARTITION BY venue)"))
def pace_labels(spark, d):
    e = participations(spark, d).groupBy("event", "venue").agg(F.min("price").alias("m"))
    cuts = e.groupBy("venue").agg(*[F.percentile("m", q).alias(f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75))])
    j = e.join(cuts, "venue")
    pace = F.when(F.col("m") < F.col("q0"), "fast").when(F.col("m") < F.col("q1"), "quick").when(F.col("m") < F.col("q2"), "even").otherwise("slow")
    return j.select("event", pace.alias("pace"))


B10 = "pe AS (SELECT event, venue, d_idx, min(price) AS m FROM pt GROUP BY 1, 2, 3), ph AS (SELECT venue, d_idx, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q, min(d_idx) OVER w AS since, max(d_idx) OVER w AS until FROM (SELECT venue, d_idx, count(*) AS n, sum(round(m)::BIGINT) AS s, sum(round(m)::BIGINT ** 2) AS q FROM pe GROUP BY 1, 2) WINDOW w AS (PARTITION BY venue ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING))"


@query("B10_pace_log", with_pt("SELECT event, n::BIGINT AS n, since, until, round((m - s / n) / sqrt((q - s * (s / n)) / (n - 1)), 3) AS z, CASE WHEN m < s / n - 0.6745 * sqrt((q - s * (s / n)) / (n - 1)) THEN 'fast' WHEN m < s / n THEN 'quick' WHEN m < s / n + 0.6745 * sqrt((q - s * (s / n)) / (n - 1)) THEN 'even' ELSE 'slow' END AS pace FROM pe JOIN ph USING (venue, d_idx) WHERE n >= 30", B10))
def pace_log(spark, d):
    """Each event's fastest value against the venue's 365 days before: standardised residual, the normal quartile that it
    falls in, and the days and events of the window that the figures come from. Venues need 30 earlier events."""
    e = participations(spark, d).groupBy("event", "venue", "d_idx").agg(F.min("price").alias("m"))
    whole = F.round("m").cast("long")  # whole numbers, so that sums don't depend on the order of rows
    days = asof.day_buckets(e, ["venue"], "d_idx", {"n": F.lit(1), "s": whole, "q": whole * whole})
    w = Window.partitionBy("venue").orderBy("d_idx").rangeBetween(-365, -1)
    past = asof.window_sums(days, ["venue"], "d_idx", ["n", "s", "q"], 365).select("*", F.min("d_idx").over(w).alias("since"), F.max("d_idx").over(w).alias("until"))
    past = past.filter("n_before >= 30").select("venue", "d_idx", F.col("n_before").alias("n"), "since", "until", F.col("s_before").alias("s"), F.col("q_before").cast("double").alias("q"))
    mean = F.col("s") / F.col("n")
    sd = F.sqrt((F.col("q") - F.col("s") * mean) / (F.col("n") - 1))
    j = e.join(past, ["venue", "d_idx"]).withColumn("mean", mean).withColumn("sd", sd)
    cut = lambda k: F.col("m") < F.col("mean") + k * F.col("sd")
    pace = F.when(cut(-0.6745), "fast").when(cut(0.0), "quick").when(cut(0.6745), "even").otherwise("slow")
    return j.select("event", "n", "since", "until", F.round((F.col("m") - F.col("mean")) / F.col("sd"), 3).alias("z"), pace.alias("pace"))


@query("B10_kept_log", with_pt("SELECT event, n::BIGINT AS n, since, until, round((m - s / n) / sqrt((q - s * (s / n)) / (n - 1)), 3) AS z, CASE WHEN d_idx < -730 THEN 1 ELSE 2 END AS version FROM pe JOIN ph USING (venue, d_idx) WHERE n >= 30", B10))
def kept_log(spark, d):
    """The log of B10_pace_log kept in a committed table: a first run has the days before -730, a second one all days and
    logs only what is new, a third one finds nothing. A row has the version that brought it."""
    path = new_path(spark, "pace-log")
    early = participations(spark, d).filter("d_idx < -730").select("event").distinct()
    rows = written(pace_log(spark, d).drop("pace"), "pace")
    for part in (rows.join(early, "event", "left_semi"), rows, rows):
        commits.append_new(part, path, ["event"])
    schema = rows.schema
    one = commits.read(spark, path, schema, 1).withColumn("version", F.lit(1))
    whole = commits.read(spark, path, schema).withColumn("version", F.lit(2)).join(one.select("event"), "event", "left_anti")
    return one.unionByName(whole)


@query("B11_merged_ranks", with_pt("SELECT event, runner_no, row_number() OVER (PARTITION BY event ORDER BY q, runner_no)::INT AS predicted FROM (SELECT event, runner_no, 0.6 * percent_rank() OVER (PARTITION BY event ORDER BY measure DESC) + 0.4 * percent_rank() OVER (PARTITION BY event ORDER BY popularity) AS q FROM pt)"))
def merged_ranks(spark, d):
    e = Window.partitionBy("event")
    q = 0.6 * F.percent_rank().over(e.orderBy(F.desc("measure"))) + 0.4 * F.percent_rank().over(e.orderBy("popularity"))
    rows = participations(spark, d).select("event", "runner_no", q.alias("q"))
    return rows.select("event", "runner_no", F.row_number().over(e.orderBy("q", "runner_no")).alias("predicted"))


@query("B11_evaluation", with_pt("SELECT count(*) AS events, round(avg(rho), 6) AS spearman FROM (SELECT 1 - 6 * sum((predicted - finish) ** 2) / (count(*) * (count(*) ** 2 - 1)) AS rho FROM (SELECT event, finish, row_number() OVER (PARTITION BY event ORDER BY q, runner_no) AS predicted FROM (SELECT event, runner_no, finish, 0.6 * percent_rank() OVER (PARTITION BY event ORDER BY measure DESC) + 0.4 * percent_rank() OVER (PARTITION BY event ORDER BY popularity) AS q FROM pt)) GROUP BY event HAVING count(*) >= 3)"))
def evaluation(spark, d):
    """Mean rank correlation of the merged ranks with the results, over events of three and more."""
    got = merged_ranks(spark, d).join(participations(spark, d).select("event", "runner_no", "finish"), ["event", "runner_no"])
    n = F.count("*")
    rho = 1 - 6 * F.sum(F.pow(F.col("predicted") - F.col("finish"), 2)) / (n * (n * n - 1))
    return got.groupBy("event").agg(rho.alias("rho"), n.alias("n")).filter("n >= 3").agg(F.count("*").alias("events"), F.round(F.avg("rho"), 6).alias("spearman"))


@query("B12_course_profile", with_pt("SELECT venue, g AS going, count(*) AS n, round(median(price), 4) AS mid, count(*) FILTER (WHERE runner_no <= 2) AS inner_gate, count(*) FILTER (WHERE popularity = 1) AS favourite, count(*) FILTER (WHERE sole) AS sole_leader FROM (SELECT venue, price, runner_no, popularity, measure > others AS sole, unnest([going, 'any']) AS g FROM (SELECT *, max(CASE WHEN finish > 1 THEN measure END) OVER (PARTITION BY event) AS others FROM pt) WHERE finish = 1) GROUP BY 1, 2"))
def course_profile(spark, d):
    """Winners by venue and condition, and under any: median, counts by gate, by popularity and of sole leaders."""
    others = F.max(F.when(F.col("finish") > 1, F.col("measure"))).over(Window.partitionBy("event"))
    win = participations(spark, d).withColumn("others", others).filter("finish = 1")
    win = win.select("venue", "price", "runner_no", "popularity", (F.col("measure") > F.col("others")).alias("sole"), F.explode(F.array("going", F.lit("any"))).alias("going"))
    return win.groupBy("venue", "going").agg(
        F.count("*").alias("n"), F.round(F.percentile("price", 0.5), 4).alias("mid"), F.count_if(F.col("runner_no") <= 2).alias("inner_gate"),
        F.count_if(F.col("popularity") == 1).alias("favourite"), F.count_if("sole").alias("sole_leader"),
    )


def effects(spark, d):
    p = bl.written(participations(spark, d).filter("finish = 1").select("class", "venue", "d_idx", "price", "measure", "event"), "winners")
    return p, bl.alternating_medians(p, ["class", "venue", "d_idx"], "price", rounds=ROUNDS)


@query("B13_alternating", with_pt(f"SELECT venue, round(effect, 2) AS effect FROM e_venue_{ROUNDS}", *B13))
def alternating(spark, d):
    return effects(spark, d)[1]["venue"].select("venue", F.round("effect", 2).alias("effect"))


@query("B14_speed_index", with_pt(f"SELECT event, round(least(80 + 1000 / greatest(abs(c.effect + v.effect), 1000) * (c.effect + v.effect - price + d.effect) / 100 + 2 * (measure - 25), 200), 4) AS speed FROM wn JOIN e_class_{ROUNDS} c USING (class) JOIN e_venue_{ROUNDS} v USING (venue) JOIN e_d_idx_{ROUNDS} d USING (d_idx)", *B13))
def speed_index(spark, d):
    p, e = effects(spark, d)
    for f in ("class", "venue", "d_idx"):
        p = p.join(e[f].withColumnRenamed("effect", f"e_{f}"), f)
    base = F.col("e_class") + F.col("e_venue")
    index = 80 + 1000 / F.greatest(F.abs(base), F.lit(1000.0)) * (base - F.col("price") + F.col("e_d_idx")) / 100 + 2 * (F.col("measure") - 25)
    return p.select("event", F.round(F.least(index, F.lit(200.0)), 4).alias("speed"))


#: The class whose effect is zero in every fit, the years that a fit looks back, runs that weigh as much as the mean.
ANCHOR, BACK, PULL = "PROMO", 3, 5
FIT = ("wf AS MATERIALIZED (SELECT event, class, venue, going, d_idx, price, measure, distance, year(day)::INT AS yr FROM pt WHERE finish = 1)",
    "rf AS MATERIALIZED (SELECT fit || '|' || class AS fc, fit || '|' || venue AS fv, fit || '|' || d_idx AS fd, price FROM (SELECT *, yr + k AS fit FROM wf, range(1, 4) t(k)) WHERE fit <= (SELECT max(yr) FROM wf))",
    *alternating_sql("rf", ["fc", "fv", "fd"], "price", ROUNDS),
    f"an AS (SELECT split_part(fc, '|', 1) AS fit, effect AS zero FROM e_fc_{ROUNDS} WHERE fc LIKE '%|{ANCHOR}')",
    f"fx AS (SELECT event, venue, going, d_idx, price, measure, distance, v.effect + zero AS course, c.effect - zero AS grade, price - v.effect - c.effect AS r FROM wf JOIN e_fc_{ROUNDS} c ON c.fc = yr || '|' || class JOIN e_fv_{ROUNDS} v ON v.fv = yr || '|' || venue JOIN an ON an.fit = yr::VARCHAR)",
    f"ds AS (SELECT venue, going, d_idx, (count(*) * median(r) + {PULL} * any_value(mg)) / (count(*) + {PULL}) AS shift FROM (SELECT *, avg(r) OVER (PARTITION BY venue, going) AS mg FROM fx) GROUP BY 1, 2, 3)")


def fitted(spark, d):
    """Winners with the course and class effects of the three years before theirs, and their day's shrunk shift.

    A year's fit alternates medians ten times over the rows of the years before; the anchor class has effect zero in
    each, so that courses compare over the years. A day's shift is its median residual, pulled to the venue's mean under
    that condition.
    """
    p = participations(spark, d).filter("finish = 1").select("event", "class", "venue", "going", "d_idx", "price", "measure", "distance", F.year("day").alias("yr"))
    p = bl.written(p, "winners")
    last = p.agg(F.max("yr").alias("last"))
    rows = p.withColumn("fit", F.explode(F.array(*[F.col("yr") + k for k in range(1, BACK + 1)]))).crossJoin(F.broadcast(last)).filter("fit <= last")  # one row
    key = lambda c, y="fit": F.concat_ws("|", y, c)
    rows = bl.written(rows.select(key("class").alias("fc"), key("venue").alias("fv"), key("d_idx").alias("fd"), "price"), "fits")
    e = bl.alternating_medians(rows, ["fc", "fv", "fd"], "price", rounds=ROUNDS)
    zero = e["fc"].filter(F.col("fc").endswith(f"|{ANCHOR}")).select(F.substring_index("fc", "|", 1).cast("int").alias("yr"), F.col("effect").alias("zero"))
    x = p.withColumn("fc", key("class", "yr")).withColumn("fv", key("venue", "yr"))
    x = x.join(e["fc"].withColumnRenamed("effect", "c"), "fc").join(e["fv"].withColumnRenamed("effect", "v"), "fv").join(F.broadcast(zero), "yr")  # one row a year
    x = x.select("event", "venue", "going", "d_idx", "price", "measure", "distance", (F.col("v") + F.col("zero")).alias("course"), (F.col("c") - F.col("zero")).alias("grade"), (F.col("price") - F.col("v") - F.col("c")).alias("r"))
    mean = x.groupBy("venue", "going").agg(F.avg("r").alias("mg"))
    n = F.count("*")
    day = x.groupBy("venue", "going", "d_idx").agg(F.percentile("r", 0.5).alias("m"), n.alias("n")).join(mean, ["venue", "going"])
    day = day.select("venue", "going", "d_idx", ((F.col("n") * F.col("m") + PULL * F.col("mg")) / (F.col("n") + PULL)).alias("shift"))
    return x.join(day, ["venue", "going", "d_idx"])


@query("B13_rolling_fit", with_pt(f"SELECT event, {hu('course', 2)} AS course, {hu('grade', 2)} AS grade, {hu('shift', 2)} AS shift FROM fx JOIN ds USING (venue, going, d_idx)", *FIT))
def rolling_fit(spark, d):
    return fitted(spark, d).select("event", *[stats.half_up(F.col(c), 2).alias(c) for c in ("course", "grade", "shift")])


@query("B14_anchored_index", with_pt("SELECT event, " + hu("80 + 1000 / greatest(abs(course + grade), 1000) * (course + grade - least(price, 1.5 * greatest(course + grade, 1000)) + shift * distance / 250) / 100 + 2 * (measure - 25)", 3) + " AS speed FROM fx JOIN ds USING (venue, going, d_idx)", *FIT))
def anchored_index(spark, d):
    """Speed index over the base of rolling fits: the value capped at one and a half bases, the day's shift by distance."""
    base = F.col("course") + F.col("grade")
    capped = F.least(F.col("price"), 1.5 * F.greatest(base, F.lit(1000.0)))
    index = 80 + 1000 / F.greatest(F.abs(base), F.lit(1000.0)) * (base - capped + F.col("shift") * F.col("distance") / 250) / 100 + 2 * (F.col("measure") - 25)
    return fitted(spark, d).select("event", stats.half_up(index, 3).alias("speed"))


#: Runs of a day that weigh as much as no shift.
SHIFT = 11.1
B15 = f"sh AS (SELECT venue, d_idx, bias * c / (c + {SHIFT}) AS shift FROM wb JOIN (SELECT venue, d_idx, count(*) AS c FROM pt WHERE finish = 1 GROUP BY 1, 2) USING (venue, d_idx)), ad AS (SELECT event, venue, d_idx, round(price - coalesce(shift, 0), 6) AS v FROM pt LEFT JOIN sh USING (venue, d_idx) WHERE finish = 1)"


@query("B15_pool_percentile", with_pt("SELECT p.event, count(*) AS pool_n, CASE WHEN count(*) >= 20 THEN round((count(*) FILTER (WHERE q.v < p.v) + count(*) FILTER (WHERE q.v = p.v) / 2.0::DOUBLE) / count(*), 6) END AS pct FROM ad p JOIN ad q ON q.venue = p.venue AND q.d_idx BETWEEN p.d_idx - 365 AND p.d_idx - 1 GROUP BY 1", DAYBIAS, B15))
def pool_percentile(spark, d):
    """Percentile of a winner's value, less the day's shift shrunk by n / (n + SHIFT), in the venue's pool of 365 days."""
    win = bl.written(participations(spark, d).filter("finish = 1").select("event", "venue", "d_idx", "price", "finish"), "winners")
    n = win.groupBy("venue", "d_idx").agg(F.count("*").alias("c"))
    shift = day_bias(win).join(n, ["venue", "d_idx"]).select("venue", "d_idx", (F.col("bias") * F.col("c") / (F.col("c") + SHIFT)).alias("shift"))
    win = win.join(shift, ["venue", "d_idx"], "left").select("event", "venue", "d_idx", F.round(F.col("price") - F.coalesce("shift", F.lit(0.0)), 6).alias("v"))
    out = bl.pooled_percentile(win, win, by=["venue"], day="d_idx", value="v")
    return out.select("event", "pool_n", F.round("pct", 6).alias("pct"))


@query("B16_leave_year_out", with_pt(f"SELECT event, runner_no, {hu('measure - (t.s - y.s) / (t.n - y.n)', 6)} AS residual FROM pt p JOIN (SELECT sire, going, sum(measure) AS s, count(*) AS n FROM pt GROUP BY 1, 2) t USING (sire, going) JOIN (SELECT sire, going, year(day) AS yr, sum(measure) AS s, count(*) AS n FROM pt GROUP BY 1, 2, 3) y ON y.sire = p.sire AND y.going = p.going AND y.yr = year(p.day) WHERE t.n - y.n >= 30"))
def leave_year_out(spark, d):
    p = participations(spark, d).withColumn("yr", F.year("day"))
    y = p.groupBy("sire", "going", "yr").agg(F.sum("measure").alias("s"), F.count("*").alias("n"))
    t = y.groupBy("sire", "going").agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    e = y.join(t, ["sire", "going"]).filter("tn - n >= 30").select("sire", "going", "yr", ((F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n"))).alias("expected"))
    return p.join(e, ["sire", "going", "yr"]).select("event", "runner_no", stats.half_up(F.col("measure") - F.col("expected"), 6).alias("residual"))


#: Groups of events that are left out one after the other for the interval.
JACK = 50
B17 = f"""jk AS (SELECT venue, going, event % {JACK} AS g, count(*) FILTER (WHERE popularity = 1)::DOUBLE AS n, coalesce(sum(CASE WHEN popularity = 1 THEN measure END), 0) AS a, count(*) FILTER (WHERE popularity > 1)::DOUBLE AS k, coalesce(sum(CASE WHEN popularity > 1 THEN measure END), 0) AS b FROM pt GROUP BY 1, 2, 3),
 jt AS (SELECT venue, going, sum(n) AS n, sum(a) AS a, sum(k) AS k, sum(b) AS b FROM jk GROUP BY 1, 2), gs AS (SELECT DISTINCT g FROM jk),
 lo AS (SELECT g, sum((a / n - b / k) * n) / sum(n) AS est FROM (SELECT gs.g, t.n - coalesce(j.n, 0) AS n, t.a - coalesce(j.a, 0) AS a, t.k - coalesce(j.k, 0) AS k, t.b - coalesce(j.b, 0) AS b FROM gs CROSS JOIN jt t LEFT JOIN jk j ON j.g = gs.g AND j.venue = t.venue AND j.going = t.going) WHERE n > 0 AND k > 0 GROUP BY 1)"""


@query("B17_matched_strata", with_pt(f"SELECT {hu('f.est', 6)} AS difference, treated, round(f.est - 1.96 * se, 4) AS low, round(f.est + 1.96 * se, 4) AS high FROM (SELECT sum((a / n - b / k) * n) / sum(n) AS est, sum(n)::BIGINT AS treated FROM jt WHERE n > 0 AND k > 0) f, (SELECT sqrt((count(*) - 1) / count(*) * sum((est - m) ** 2)) AS se FROM (SELECT est, avg(est) OVER () AS m FROM lo))", B17))
def matched_strata(spark, d):
    """Difference within strata weighted by treated rows, with a 95 % interval by leaving out groups of events."""
    one, more = F.col("popularity") == 1, F.col("popularity") > 1
    total = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("measure"))), F.lit(0.0))
    g = participations(spark, d).groupBy("venue", "going", (F.col("event") % JACK).alias("g")).agg(
        F.count_if(one).alias("n"), total(one).alias("a"), F.count_if(more).alias("k"), total(more).alias("b")
    )
    g = bl.written(g, "strata")  # strata times JACK rows
    names = ("n", "a", "k", "b")
    whole = g.groupBy("venue", "going").agg(*[F.sum(c).alias(f"t{c}") for c in names])
    effect = lambda n, a, k, b: F.sum((a / n - b / k) * n) / F.sum(n)
    full = whole.filter("tn > 0 AND tk > 0").agg(effect(*[F.col(f"t{c}") for c in names]).alias("est"), F.sum("tn").alias("treated"))
    every = whole.crossJoin(F.broadcast(g.select("g").distinct())).join(g, ["venue", "going", "g"], "left")
    rest = [(F.col(f"t{c}") - F.coalesce(c, F.lit(0))).alias(f"r{c}") for c in names]
    left = every.select("g", *rest).filter("rn > 0 AND rk > 0").groupBy("g").agg(effect(*[F.col(f"r{c}") for c in names]).alias("e"))
    se = left.agg(F.sqrt((F.count("*") - 1) / F.count("*") * F.var_pop("e") * F.count("*")).alias("se"))
    out = full.crossJoin(F.broadcast(se))  # one row each
    band = lambda k: F.round(F.col("est") + k * F.col("se"), 4)
    return out.select(stats.half_up(F.col("est"), 6).alias("difference"), "treated", band(-1.96).alias("low"), band(1.96).alias("high"))

#: Resamples of whole events, a Poisson weight each.
B17_RESAMPLES = 200
_B17_WEIGHT = "CASE " + " ".join(f"WHEN u < {c} THEN {k}" for k, c in enumerate(pr.POISSON_ONE)) + " ELSE 6 END"
B17_BOOT = f"""ev AS (SELECT venue, going, event, count(*) FILTER (WHERE popularity = 1) AS n, coalesce(sum(CASE WHEN popularity = 1 THEN measure END), 0) AS a, count(*) FILTER (WHERE popularity > 1) AS k, coalesce(sum(CASE WHEN popularity > 1 THEN measure END), 0) AS b FROM pt GROUP BY 1, 2, 3),
 wt AS (SELECT event, r, {_B17_WEIGHT} AS w FROM (SELECT event, r, ('0x' || substr(md5('7:' || event || ':' || r), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM (SELECT DISTINCT event FROM ev), range({B17_RESAMPLES}) q(r))),
 al AS (SELECT -1 AS r, venue, going, sum(n)::DOUBLE AS n, sum(a) AS a, sum(k)::DOUBLE AS k, sum(b) AS b FROM ev GROUP BY 2, 3 UNION ALL SELECT r, venue, going, sum(w * n)::DOUBLE, sum(w * a), sum(w * k)::DOUBLE, sum(w * b) FROM ev JOIN wt USING (event) GROUP BY 1, 2, 3),
 es AS (SELECT r, round(sum((a / n - b / k) * n) / sum(n), 9) AS est, sum(n)::BIGINT AS treated FROM al WHERE n > 0 AND k > 0 GROUP BY 1)"""


@query("B17_event_bootstrap", with_pt(f"SELECT {hu('f.est', 6)} AS difference, f.treated, {hu('low', 6)} AS low, {hu('high', 6)} AS high, resamples FROM (SELECT est, treated FROM es WHERE r = -1) f, (SELECT quantile_cont(est, 0.025) AS low, quantile_cont(est, 0.975) AS high, count(*) AS resamples FROM es WHERE r >= 0)", B17_BOOT))
def event_bootstrap(spark, d):
    """Difference within strata weighted by treated rows, with the 95 % interval of resampled whole events.

    An event's rows in all strata share its weight, a hash of event and resample, which is formed once for them; tasks add up
    strata for all resamples, so that strata x resamples rows are shuffled for each task, whatever the events' number.
    """
    one, more = F.col("popularity") == 1, F.col("popularity") > 1
    total = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("measure"))), F.lit(0.0))
    ev = participations(spark, d).groupBy("venue", "going", "event").agg(F.count_if(one).alias("n"), total(one).alias("a"), F.count_if(more).alias("k"), total(more).alias("b"))
    s = resampled_sums(ev, "event", ["venue", "going"], ["n", "a", "k", "b"], B17_RESAMPLES)
    es = s.filter("n > 0 AND k > 0").groupBy("r").agg(F.round(F.sum((F.col("a") / F.col("n") - F.col("b") / F.col("k")) * F.col("n")) / F.sum("n"), 9).alias("est"), F.sum("n").cast("long").alias("treated"))
    drawn = F.when(F.col("r") >= 0, F.col("est"))
    whole = lambda c: F.max(F.when(F.col("r") < 0, F.col(c)))
    out = es.agg(whole("est").alias("est"), whole("treated").alias("treated"), F.percentile(drawn, 0.025).alias("low"), F.percentile(drawn, 0.975).alias("high"), F.count(drawn).alias("resamples"))
    return out.select(stats.half_up(F.col("est"), 6).alias("difference"), "treated", stats.half_up(F.col("low"), 6).alias("low"), stats.half_up(F.col("high"), 6).alias("high"), "resamples")
