"""The median of the others, by place, against plain Python."""

import random
from statistics import median

from tidemark.operators import baseline


def test_median_of_others(spark):
    r = random.Random(5)
    rows = [(g, i, r.choice([None, 1.0, 2.0, 2.0, 3.5, 7.0])) for g in range(40) for i in range(g % 9 + 1)]
    df = spark.createDataFrame(rows, "g int, i int, v double")
    got = {(x.g, x.i): x.others for x in baseline.median_of_others(df, ["g"], "v", ["i"]).collect()}
    assert len(got) == len(rows)
    for g, i, _ in rows:
        rest = [v for h, j, v in rows if h == g and j != i and v is not None]
        assert got[g, i] == (median(rest) if rest else None)
