"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each query reads the driver tables (or frames Spark derives from them) so its
work grows with the data. Floating measures are reported to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from vitals.queries import marts, rules_q, sources_q, stage_q, warehouse_q, quality_q, model_q, landing_q  # noqa: F401
    return QUERIES
