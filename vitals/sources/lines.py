"""Delimited text files as numbered records.

The lines of a folder are staged once as a table (file, split start, row, text);
everything after that reads the table, so its row numbers stay what they are when an
executor is lost. What a line needs to know of the lines before it in its file
(its number, whether it lies inside an open quote, the last value of a merged cell)
comes from a prefix per chunk of ``1 << CHUNK_BITS`` rows: one aggregate per chunk,
a window over the chunks of each file (a few rows), and a join back. So a file of
any size is spread over tasks, and files are never opened one by one: the number of
jobs does not depend on the number of files, and no path reaches the driver.

Quotes follow RFC 4180 (a quote inside quotes is doubled): a line with an odd
number of quotes opens or closes a record that goes on over line ends. A record of
more than ``MOST_LINES`` lines is a stray quote; its lines stand alone and fail later.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.operators.lookup import bounded
from vitals.session import materialize

BOM = "﻿"
CHUNK_BITS = 16
MOST_LINES = 1000
MOST_LAYOUTS = 500
KEYS = ["file", "block", "chunk"]


def stage_lines(spark: SparkSession, paths, glob: str | None = None, quote: str = '"') -> DataFrame:
    """(file, block, row, value, odd) of every line below ``paths``, written once.
    ``odd``: the line holds an odd number of quotes."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return materialize(reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value", odd_quotes(F.col("value"), quote).alias("odd")), "lines")


def odd_quotes(text: Column, quote: str = '"') -> Column:
    """The text holds an odd number of quotes."""
    return F.pmod(F.length(text) - F.length(F.replace(text, F.lit(quote), F.lit(""))), F.lit(2)) == 1


def chunked(lines: DataFrame) -> DataFrame:
    return lines.withColumn("chunk", F.shiftright("row", CHUNK_BITS))


def before_chunk() -> Window:
    """The chunks of a file before the current one."""
    return Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)


def in_chunk() -> Window:
    return Window.partitionBy(*KEYS).orderBy("row")


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with their number in the file (``line``, from 1), whether an odd number
    of quotes precedes their chunk (``open``) and whether their file has any odd line."""
    chunks = (chunked(lines).groupBy(*KEYS)
              .agg(F.min("row").alias("_first"), F.count(F.lit(1)).alias("_n"), F.count_if("odd").alias("_odd")))
    w = before_chunk()
    carry = materialize(chunks.select(
        *KEYS, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"),
        (F.pmod(F.coalesce(F.sum("_odd").over(w), F.lit(0)), F.lit(2)) == 1).alias("open"),
        (F.sum("_odd").over(Window.partitionBy("file")) > 0).alias("multi")), "chunks")
    return (chunked(lines).join(bounded(carry), KEYS)
            .withColumn("line", F.col("_before") + F.col("row") - F.col("_first") + 1).drop("_before", "_first"))


def records(lines: DataFrame) -> DataFrame:
    """(file, line, value): one row per record, with its first line's number; lines
    that an open quote joins are put together with their line ends."""
    rows = numbered(lines)
    single = rows.where(~F.col("multi")).select("file", "line", "value")
    many = rows.where("multi")
    if many.isEmpty():
        return single
    inside = F.pmod(F.coalesce(F.count_if("odd").over(in_chunk().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                    + F.col("open").cast("int"), F.lit(2)) == 1
    marked = materialize(many.withColumn("_inside", inside)
                         .withColumn("_start", F.max(F.when(~F.col("_inside"), F.col("line"))).over(in_chunk())), "open-lines")
    carry = materialize(marked.groupBy(*KEYS).agg(F.max("_start").alias("_last"))
                        .select(*KEYS, F.max("_last").over(before_chunk()).alias("_carried")), "open-chunks")
    owned = (marked.join(bounded(carry), KEYS)
             .select("file", "line", "value", F.coalesce("_start", "_carried", "line").alias("_start")))
    sizes = (owned.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > 1))
    joined = owned.join(sizes, ["file", "_start"], "left")
    alone = joined.where(F.col("_size").isNull() | (F.col("_size") > MOST_LINES)).select("file", "line", "value")
    whole = (joined.where(F.col("_size") <= MOST_LINES).groupBy("file", F.col("_start").alias("line"))
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("value")))
    return single.unionByName(alone).unionByName(whole)


@dataclass
class Recognised:
    """``rows``: (file, line, value, layout) of every record that is not blank and no
    known header; ``layout`` is null in files without one. ``headers``: the cells of
    each layout's header; ``files``: (file, head, layout)."""
    rows: DataFrame
    headers: dict[int, list[str]]
    files: DataFrame


def header_cells(line: str, sep: str) -> list[str]:
    cells = next(csv.reader([line], delimiter=sep), [])
    return [c.lstrip(BOM) for c in cells]


def recognise(spark: SparkSession, paths, sep: str, hopeful: Callable[[Column], Column],
              accept: Callable[[list[str]], bool] = lambda cells: True, glob: str | None = None) -> Recognised:
    """Records of all files with the layout of their file: the first record that is
    not blank is its header. Headers are grouped in the engine; only the distinct ones
    for which ``hopeful`` (a condition on the text) holds come to the driver."""
    found = records(stage_lines(spark, paths, glob))
    found = found.where(F.trim("value") != "")
    # the numbers first: an aggregate over the texts themselves would sort all lines
    first = materialize(found.groupBy("file").agg(F.min("line").alias("line")), "head-lines")
    heads = materialize(found.join(bounded(first), ["file", "line"]).select("file", F.col("line").alias("head_line"), F.col("value").alias("head")), "heads")
    distinct = heads.where(hopeful(F.col("head"))).groupBy("head").agg(F.min("file").alias("file")).orderBy("file").limit(MOST_LAYOUTS + 1).collect()
    if len(distinct) > MOST_LAYOUTS:
        raise ValueError(f"more than {MOST_LAYOUTS} distinct headers")
    known: dict[int, list[str]] = {}
    named: list[tuple[str, int]] = []
    for r in distinct:
        cells = header_cells(r["head"], sep)
        if accept(cells):
            number = next((k for k, v in known.items() if v == cells), len(known))
            known[number] = cells
            named.append((r["head"], number))
    layouts = spark.createDataFrame(named, "head string, layout int")
    files = heads.join(F.broadcast(layouts), "head", "left")  # at most MOST_LAYOUTS rows
    of = materialize(files.select("file", "head_line", "layout"), "file-layouts")
    rows = found.join(bounded(of), "file").where(F.col("layout").isNull() | (F.col("line") > F.col("head_line")))
    return Recognised(rows.select("file", "line", "value", "layout"), known, files.select("file", "head", "layout"))


def cells_of(value: Column, n: int, sep: str) -> Column:
    """The cells of a record as a struct _0 … _{n-1} of text, and _bad, the record
    itself where it has another number of cells or is not well formed."""
    schema = ", ".join([*(f"_{i} string" for i in range(n)), "_bad string"])
    return F.from_csv(value, schema, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def cell_array(value: Column, sep: str) -> Column:
    """The cells of a record as one array, for records too wide for a struct: the plan
    is the same for any width. Between quotes (the odd parts of a split at quotes) the
    separator is masked; an empty part between two of them is a doubled quote."""
    mask, by = "\x01", re.escape(sep)
    parts = F.split(value, '"', -1)
    n = F.size(parts)
    text = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.replace(x, F.lit(sep), F.lit(mask)))
                                    .when((x == "") & (i > 0) & (i < n - 1), F.lit('"')).otherwise(x)), "")
    quoted = F.transform(F.split(text, by, -1), lambda x: F.replace(x, F.lit(mask), F.lit(sep)))
    return F.when(F.contains(value, F.lit('"')), quoted).otherwise(F.split(value, by, -1))


def fill_down(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Each NULL of ``columns`` takes the last value above it in its file.
    ``rows`` carry (file, block, row); a chunk learns the last value of the chunks
    before it, so no task holds more than a chunk."""
    own = materialize(chunked(rows), "fill")
    last = own.groupBy(*KEYS).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("row"))).alias(f"_l_{c}") for c in columns])
    carry = materialize(last.select(*KEYS, *[F.last(f"_l_{c}", ignorenulls=True).over(before_chunk()).alias(f"_c_{c}") for c in columns]), "fill-chunks")
    upto = in_chunk().rowsBetween(Window.unboundedPreceding, 0)
    return (own.join(bounded(carry), KEYS)
            .withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_c_{c}")) for c in columns})
            .select(*rows.columns))
