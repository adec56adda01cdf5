"""Column expressions on hand-made rows."""

from pyspark.sql import functions as F

from tidemark.functions import exprs as x


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_margin(spark):
    got = column(spark, ["head", "3", "1/4", "2.1/2", "far away", None, "1/0"], "string", lambda c: x.margin_to_number(c, {"head": 0.2}))
    assert got == [0.2, 3.0, 0.25, 2.5, None, None, None]


def test_clock(spark):
    assert column(spark, ["0930", "23:59", "2400", "9:30", None], "string", x.clock_minutes) == [570, 1439, None, None, None]
    assert column(spark, ["1:02.5", "59.9", "x"], "string", x.clock_seconds) == [62.5, 59.9, None]


def test_half_up_and_bands(spark):
    assert column(spark, [0.5, 1.5, -0.5, None], "double", lambda c: x.half_up(c, 1)) == [1.0, 2.0, 0.0, None]
    assert column(spark, [1.0, 10.0, 99.0, None], "double", lambda c: x.band(c, [10, 20], ["a", "b", "c"])) == ["a", "b", "c", None]


def test_ordered_groups(spark):
    got = column(spark, ["7,(2,10)-1", "5", "", "1-(2", "a,b", None], "string", x.ordered_groups)
    assert [(r.id, r.rank) for r in got[0]] == [(7, 1), (2, 2), (10, 2), (1, 4)]
    assert [(r.id, r.rank) for r in got[1]] == [(5, 1)]
    assert got[2:] == [None] * 4


def test_row_stats(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 4.0, None), (None, None, None)], "a double, b double, c double")
    s = x.row_stats([F.col("a"), F.col("b"), F.col("c")])
    rows = df.select(*[s[k].alias(k) for k in s]).collect()
    assert (rows[0].n, rows[0].mean, round(rows[0].std, 6), rows[0].slope) == (3, 2.0, 0.816497, -1.0)
    assert (rows[1].n, rows[1].mean, rows[1].std, rows[1].slope) == (1, 4.0, None, None)
    assert (rows[2].n, rows[2].mean) == (0, None)


def test_slots_halves_and_intervals(spark):
    df = spark.createDataFrame([([None, 4, 5, 6],), ([7],), ([None],)], "a array<int>")
    got = df.select(*[x.slot(F.col("a"), n).alias(n) for n in ("first", "second", "second_last", "last")]).collect()
    assert [tuple(r) for r in got] == [(4, 5, 5, 6), (7, None, None, 7), (None, None, None, None)]
    a, b, c = x.halves(F.array(*map(F.lit, (1.0, 3.0, 5.0, 7.0))))
    assert tuple(spark.range(1).select(a, b, c).first()) == (2.0, 6.0, 6.0)
    since, until = x.text_interval(F.col("t"))
    rows = spark.createDataFrame([("2019-05",), ("2019-05~07",), ("2019-11~2020-02",), ("2019-05-03",), ("soon",)], "t string").select(since.alias("a"), until.alias("b")).collect()
    assert [(str(r.a), str(r.b)) for r in rows] == [("2019-05-01", "2019-05-31"), ("2019-05-01", "2019-07-31"), ("2019-11-01", "2020-02-29"), ("2019-05-03", "2019-05-03"), ("None", "None")]
