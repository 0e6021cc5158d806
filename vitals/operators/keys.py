"""Surrogate keys (W4) without a global window.

Rows are range-partitioned and sorted on the natural key, the lineage is cut
by a reliable checkpoint (so partition contents are stable and survive
executor loss), and each row's id is its partition's offset plus its position
inside the partition. Only one count per partition reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.operators.lookup import SIZE_ATTR, row_bytes
from vitals.session import cut_lineage

_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row index


def _with_positions(df: DataFrame) -> DataFrame:
    mid = F.monotonically_increasing_id()
    return (df.withColumn("_mid", mid)
            .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
            .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW)))
            .drop("_mid"))


def sequential_ids(df: DataFrame, id_col: str, order: list[str] | None = None,
                   start: int = 1, id_type: str = "bigint") -> DataFrame:
    """Dense ids start, start+1, … in ``order`` (any stable order when None).

    As ``RDD.zipWithIndex`` does, one job counts the rows of each partition of
    the checkpointed frame and the offsets are computed from those counts (one
    number per partition); they join back as a broadcast local table. The
    returned frame knows its exact rows and bytes (``SIZE_ATTR``, summed in the
    same job), which serve as its size proof for later broadcast joins.
    """
    staged = df
    if order:
        staged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = cut_lineage(staged)
    positioned = _with_positions(staged)
    sizes = sorted((r["_pid"], r["_n"], r["_b"]) for r in positioned.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(row_bytes(staged)).alias("_b")).collect())
    offsets, total, size = [], 0, 0
    for pid, n, b in sizes:
        offsets.append((pid, total))
        total, size = total + n, size + b + 16 * n
    offs = df.sparkSession.createDataFrame(offsets, "_pid long, _off long")
    out = positioned.join(F.broadcast(offs), "_pid").select(
        (F.col("_off") + F.col("_pos") + F.lit(start)).cast(id_type).alias(id_col), *df.columns)
    setattr(out, SIZE_ATTR, (total, size))
    return out


def max_id(df: DataFrame, id_col: str) -> int:
    """Largest id in a table (one scalar to the driver), 0 when empty."""
    v = df.agg(F.max(id_col)).first()[0]
    return int(v) if v is not None else 0
