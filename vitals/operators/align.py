"""Schema alignment of landed files.

All decisions are made on column *names* (driver-side metadata); data never
passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_header(name: str) -> str:
    """Drop embedded line breaks, then strip."""
    return name.replace("\n", "").replace("\r", "").strip()


def align(df: DataFrame, target: T.StructType, renames: dict[str, str] | None = None,
          drop: list[str] | None = None, copy_if_absent: dict[str, str] | None = None) -> DataFrame:
    """Clean headers, rename variants, drop named extras, copy a column
    when the target is absent, impute missing columns as typed NULL and project
    to the target order (extra columns dropped)."""
    df = df.toDF(*[clean_header(c) for c in df.columns])
    renames = {k: v for k, v in (renames or {}).items() if k in df.columns and v not in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    if drop:
        df = df.drop(*drop)
    for target_col, source_col in (copy_if_absent or {}).items():
        if target_col not in df.columns and source_col in df.columns:
            df = df.withColumn(target_col, F.col(source_col))
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def drift(df_columns: list[str], target: T.StructType, source: str,
          renames: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """U4/Q7: (source, kind, column) rows for missing and extra columns (after header
    cleaning and known renames)."""
    have = [(renames or {}).get(clean_header(c), clean_header(c)) for c in df_columns]
    want = [f.name for f in target.fields]
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    return [(source, "faltante", c) for c in missing] + [(source, "extra", c) for c in extra]


def drift_report(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "archivo string, tipo string, columna string")
