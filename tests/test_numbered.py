"""Places in an order, numbered range by range."""

import random

from pyspark.sql import functions as F

from tidemark.operators import stats


def test_places_in_order(spark):
    r = random.Random(2)
    rows = [(r.randrange(40), r.randrange(9), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int, i int").repartition(5)
    for part in (3, 1 << 20):  # bytes: many small ranges, one large
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{part}b")
        out = stats.numbered(df, [F.desc("a"), "b", "i"]).collect()
        assert [tuple(x)[:3] for x in sorted(out, key=lambda x: x.place)] == sorted(rows, key=lambda x: (-x[0], x[1], x[2]))
        assert sorted(x.place for x in out) == list(range(1, 2001))
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert stats.numbered(df.filter("false"), ["a"]).count() == 0


def test_all_lines_are_ordered(spark):
    from tidemark.plans import registry

    sf = "/root/testdata/sf0.001"
    rows = registry.queries()["O1_order_all"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/lineitem.parquet").count() and [x.place for x in rows] == list(range(1, len(rows) + 1))
    assert [tuple(x)[:3] for x in rows] == [tuple(x) for x in registry.queries()["O1_order"](spark, sf).collect()]
