"""Idempotent dimension loads (K3) and slowly-changing history.

Both are written as joins + unions; the caller writes the result to a new
version folder and commits it to the table's version log, so a failed load never leaves a half
table behind.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.operators.dedup import keep_first
from vitals.operators.keys import max_id, sequential_ids
from vitals.session import materialize


def upsert_ignore(existing: DataFrame | None, incoming: DataFrame, natural_key: list[str],
                  id_col: str) -> DataFrame:
    """Insert-if-absent: existing rows and ids untouched, new members get max(id)+1….

    One member per natural key: of conflicting attributes the smallest row
    counts. New members are ordered by natural key, so loading the same input
    twice yields the same rows and ids.
    """
    attributes = [c for c in incoming.columns if c not in natural_key and c != id_col]
    incoming = keep_first(incoming.select(*natural_key, *attributes), natural_key, attributes)
    if existing is None:
        return sequential_ids(incoming, id_col, natural_key, start=1)
    fresh = incoming.join(existing.select(*natural_key), natural_key, "left_anti")
    start = max_id(existing, id_col) + 1
    added = sequential_ids(fresh, id_col, natural_key, start=start)
    return existing.unionByName(added.select(*existing.columns))


def scd2_merge(current: DataFrame, incoming: DataFrame, key: list[str], attrs: list[str],
               as_of: dt.date, id_col: str) -> DataFrame:
    """Close-and-open SCD type 2 merge.

    ``current`` carries id, key, attrs, fecha_inicio_vigencia,
    fecha_fin_vigencia, es_version_actual, version. A changed attribute closes
    the open version the day before ``as_of`` and opens version+1 from
    ``as_of``; unseen keys open version 1; keys absent from ``incoming`` keep
    their open version. Of repeated incoming keys the smallest row counts; the
    join is written once and read by each part of the result.
    """
    start = F.lit(as_of).cast("date")
    history = current.where(~F.col("es_version_actual"))
    open_rows = current.where(F.col("es_version_actual"))
    inc = keep_first(incoming.select(*key, *attrs), key, attrs).select(*key, *[F.col(a).alias(f"_new_{a}") for a in attrs], F.lit(True).alias("_in"))
    joined = materialize(open_rows.join(inc, key, "full_outer"), "scd2-join")
    same = None
    for a in attrs:
        c = F.col(a).eqNullSafe(F.col(f"_new_{a}"))
        same = c if same is None else same & c
    has_old = F.col(id_col).isNotNull()
    has_new = F.col("_in").isNotNull()
    changed = has_old & has_new & ~same
    cols = current.columns
    kept = joined.where(has_old & ~changed).select(*cols)
    closed = (joined.where(changed)
              .withColumn("fecha_fin_vigencia", F.date_sub(start, 1))
              .withColumn("es_version_actual", F.lit(False))
              .select(*cols))
    opened = (joined.where(changed | (~has_old & has_new))
              .select(*key, *[F.col(f"_new_{a}").alias(a) for a in attrs],
                      start.alias("fecha_inicio_vigencia"),
                      F.lit(None).cast("date").alias("fecha_fin_vigencia"),
                      F.lit(True).alias("es_version_actual"),
                      (F.coalesce(F.col("version"), F.lit(0)) + 1).cast("int").alias("version")))
    base = history.unionByName(kept).unionByName(closed)
    first = max_id(current, id_col) + 1
    added = sequential_ids(opened, id_col, [*key, "version"], start=first)
    return base.unionByName(added.select(*cols))
