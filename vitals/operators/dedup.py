"""De-duplication with deterministic "first occurrence" semantics.

``keep_first`` is an aggregate, not a window: ``min_by(row, order)`` is
combined map-side, so a key that holds a third of all rows is reduced to one
row per map task before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _orderable(df: DataFrame, columns: list[str]) -> bool:
    """Whether Spark can compare the columns (maps and variants it cannot)."""
    return not any(k in df.schema[c].dataType.simpleString() for c in columns for k in ("map<", "variant"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` tuple (a total order)."""
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    # one struct, the order first: each column is buffered once
    rest = [c for c in payload if c not in order]
    first = F.struct(*[F.col(c) for c in order if c in payload], *[F.col(c) for c in rest])
    if all(c in payload or c in keys for c in order) and _orderable(df, rest):
        best = F.min(first)
    else:
        best = F.min_by(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(c) for c in order]))
    return (df.groupBy(*keys).agg(best.alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload])
            .select(*df.columns))


def union_with_priority(frames: list[DataFrame], keys: list[str], tie: list[str] | None = None) -> DataFrame:
    """Union by name; per key the row of the earliest frame wins."""
    tagged = [f.withColumn("_prio", F.lit(i)) for i, f in enumerate(frames)]
    u = tagged[0]
    for f in tagged[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    rest = [c for c in u.columns if c not in keys and c != "_prio"]
    return keep_first(u, keys, ["_prio", *(tie or rest)]).drop("_prio")
