"""Reshaping: wide→long unpivot (P14/P15) and weekly→monthly rollup."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_COLUMN = re.compile(r"^(19|20)\d\d-")


def date_columns(df: DataFrame) -> list[str]:
    """Value columns are the ones named like a date (prefix 19/20 and a dash)."""
    return [c for c in df.columns if DATE_COLUMN.match(c)]


def wide_to_long(df: DataFrame, ids: list[str], value_name: str = "n",
                 date_name: str = "fecha") -> DataFrame:
    """One row per id × date cell, coerced to date and integer, zeros and NULLs dropped.

    ``unpivot`` is a narrow Expand (no shuffle); the filter runs in the same stage.
    """
    cols = date_columns(df)
    long = df.unpivot(ids, cols, "_col", "_val")
    n = F.col("_val").cast("string").try_cast("double").try_cast("bigint")
    fecha = F.coalesce(F.try_to_date(F.col("_col"), "yyyy-MM-dd"),
                       F.try_to_date(F.concat(F.col("_col"), F.lit("-01")), "yyyy-MM-dd"))
    return (long.select(*ids, fecha.alias(date_name), n.alias(value_name))
            .where(F.col(value_name).isNotNull() & (F.col(value_name) > 0) & F.col(date_name).isNotNull()))


def weekly_to_monthly(weekly: DataFrame, keys: list[str], date_col: str, flows: list[str],
                      stocks: list[str], reports: str = "semanas_reporte") -> DataFrame:
    """A4: flows summed (all-NULL → 0), stocks = last non-NULL value by date, report count.

    ``max_by`` with a NULL filter is a plain aggregate: partial aggregation
    keeps the shuffle at one row per key per map task.
    """
    g = (weekly.where(F.col(date_col).isNotNull())
         .withColumn("anio", F.year(date_col).cast("int"))
         .withColumn("mes", F.month(date_col).cast("int")))
    for k in keys:
        g = g.where(F.col(k).isNotNull())  # pandas groupby drops NULL keys
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_mes") for c in flows]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(date_col))).alias(f"{c}_fin")
             for c in stocks]
    aggs.append(F.count(date_col).cast("bigint").alias(reports))
    return g.groupBy(*keys, "anio", "mes").agg(*aggs)


def wide_csv_to_long(spark, paths, n_ids: int, id_names: list[str] | None = None,
                     value_name: str = "n", date_name: str = "fecha", sep: str = ",", keep: list[str] | None = None) -> DataFrame:
    """S3/P14/P15 for very wide files (one column per date, ~1,000+ columns).

    ``unpivot`` plans one projection per column. Here a record's cells become one array
    that is ``posexplode``-d against the dates of its file's header, so the plan has the
    same size for any width. Files may carry different dates; every file
    has its header (one without is left out). Line ends inside quotes are part of
    a cell. Zero, empty and non-numeric cells are dropped. ``keep`` names columns of the
    records (file, line) to pass on.
    """
    from vitals.sources import lines

    def hopeful(head):
        return head.rlike(f"(^|[{sep}\"])(19|20)[0-9]{{2}}-")

    found = lines.recognise(spark, paths, sep, hopeful, lambda cells: len(cells) > n_ids and any(map(DATE_COLUMN.match, cells[n_ids:])))
    if not found.headers:
        raise ValueError("no file with date columns")
    names = id_names or [c.strip() for c in found.headers[0][:n_ids]]
    layouts = spark.createDataFrame(
        [(k, len(h), [c if DATE_COLUMN.match(c) else None for c in h[n_ids:]]) for k, h in found.headers.items()],
        "layout int, _width int, _days array<string>")
    # at most lines.MOST_LAYOUTS rows; a record with another number of cells than its header is left out
    rows = (found.rows.join(F.broadcast(layouts), "layout").withColumn("_cells", lines.cell_array(F.col("value"), sep))
            .where(F.size("_cells") == F.col("_width")))
    long = (rows.select(*(keep or []), *[F.nullif(F.get("_cells", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(names)],
                        F.slice("_cells", n_ids + 1, 1 << 30).alias("_cells"), "_days")
            .select(*(keep or []), *names, "_days", F.posexplode_outer("_cells").alias("_pos", "_cell")))
    day = F.get("_days", F.col("_pos"))
    fecha = F.coalesce(F.try_to_date(day, "yyyy-MM-dd"), F.try_to_date(F.concat(day, F.lit("-01")), "yyyy-MM-dd"))
    n = F.trim("_cell").try_cast("double").try_cast("bigint")
    return (long.where(~F.col("_cell").isin("", "0"))
            .select(*(keep or []), *names, fecha.alias(date_name), n.alias(value_name))
            .where(F.col(value_name).isNotNull() & (F.col(value_name) > 0) & F.col(date_name).isNotNull()))
