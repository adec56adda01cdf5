"""All registered queries and their oracle SQL."""

from __future__ import annotations

from importlib import import_module

from . import demo

_MODULES = ("projections", "joins", "aggregates", "windows", "ticks", "sources", "baselines", "probabilities", "entities", "texts", "flagship")
for _name in _MODULES:
    import_module(f"{__package__}.{_name}")


def queries() -> dict:
    return dict(demo.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(demo.ORACLES)


def flagship(spark, sf_dir):
    return demo.QUERIES["flagship_asof_ranks"](spark, sf_dir)
