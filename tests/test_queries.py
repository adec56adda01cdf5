"""Every registered query of the library on the smallest tables, against DuckDB where it has SQL."""

import math
from pathlib import Path

import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


#: Queries without SQL: each is tested by value in test_models.py or test_graph.py.
BRUTE_FORCE = {"E6_logit_pool", "E18_refits", "E19_model", "E19_venue_classes"}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, int | float) and not isinstance(v, bool) else v if v is None or isinstance(v, bool) else str(v)


def rows_of(columns, rows):
    """Rows with columns by name, in an order that the last digits of numbers don't change."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    out = [[plain(r[i]) for i in order] for r in rows]
    return sorted(out, key=lambda r: [(v is None, f"{v:.3e}" if isinstance(v, float) and v != int(v) else str(v)) for v in r])


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1.1e-4)  # results are rounded to four digits or more
    return a == b


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if sql := registry.oracle_sql().get(name):
        want = duck.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(got.columns) == sorted(names)
        left, right = rows_of(got.columns, rows), rows_of(names, want.fetchall())
        assert len(left) == len(right)
        assert [(a, b) for a, b in zip(left, right, strict=True) if not all(map(same, a, b))] == []
    else:
        assert name in BRUTE_FORCE and rows
