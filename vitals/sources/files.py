"""File landing sources.

Every reader is one multi-path scan; per-file decisions (format, bad header)
are made on file *names and headers* only, never on data routed through the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.session import materialize

BOM = "\ufeff"
SUPPORTED = {"json": "*.json", "csv": "*.csv"}


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Distributed file listing (path, length); file contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            .select("path", "length"))


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Data file paths of a folder (hidden/marker files skipped): names only."""
    rows = list_files(spark, folder).where(~F.regexp_like(F.col("path"), F.lit(r".*/[._][^/]*$"))).collect()
    return sorted(r.path for r in rows)


def strip_bom(df: DataFrame) -> DataFrame:
    """A UTF-8 BOM glued to the first header name is removed."""
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def read_csv_typed(spark: SparkSession, paths, schema: T.StructType, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Comma CSV with header, explicit types and date parsing (no inference pass)."""
    return (spark.read.schema(schema).option("header", True).option("dateFormat", date_format)
            .option("mode", "PERMISSIVE").csv(paths))


def read_csv_text(spark: SparkSession, paths, sep: str = ";") -> DataFrame:
    """Delimited text kept as text (no NA inference); empty field → NULL; BOM dropped."""
    df = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(paths)
    return strip_bom(df)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Write each partition as one file holding a JSON array of its records.

    Framing uses each row's position inside its partition and the partition
    size (one count per partition), so no partition is gathered into a row.
    """
    from vitals.operators.keys import _with_positions
    from vitals.session import cut_lineage
    staged = _with_positions(cut_lineage(df))
    sizes = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    line = F.concat(F.when(F.col("_pos") == 0, F.lit("[")).otherwise(F.lit(",")), body,
                    F.when(F.col("_pos") == F.col("_n") - 1, F.lit("]")).otherwise(F.lit("")))
    # broadcast join keeps the checkpointed partitioning: one partition → one file
    out = (staged.join(F.broadcast(sizes), "_pid")
           .sortWithinPartitions("_pos").select(line.alias("value")))
    out.write.mode("overwrite").text(path)


def write_text_files(df: DataFrame, key: str, header: str, path: str, order: str | None = None, parts: int = 1) -> None:
    """Write lines (``value``) as text, one folder per value of ``key`` with one file, or a
    subfolder of one file for each of ``parts``; every file begins with ``header`` and ``order``
    sorts its lines."""
    if parts > 1:
        split = df.withColumn("parte", F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int"))
        rows = split.select(key, "parte", F.lit(1).alias("_part"), (F.col(order) if order else F.lit(0)).alias("_order"), "value")
        heads = (df.select(key).distinct().select(key, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("parte"), F.lit(0).alias("_part"),
                                                  F.lit(None).alias("_order"), F.lit(header).alias("value")))
        (heads.unionByName(rows).repartition(key, "parte").sortWithinPartitions(key, "parte", "_part", "_order").select(key, "parte", "value")
         .write.partitionBy(key, "parte").text(path))
        return
    rows = df.select(key, F.lit(1).alias("_part"), (F.col(order) if order else F.lit(0)).alias("_order"), "value")
    heads = df.select(key).distinct().select(key, F.lit(0).alias("_part"), F.lit(None).alias("_order"), F.lit(header).alias("value"))
    (heads.unionByName(rows).repartition(key).sortWithinPartitions(key, "_part", "_order").select(key, "value")
     .write.partitionBy(key).text(path))


def read_json_array(spark: SparkSession, paths, schema: T.StructType) -> DataFrame:
    """Whole-file JSON arrays of records (one task per file)."""
    return spark.read.schema(schema).option("multiLine", True).json(paths)


def split_json(spark: SparkSession, folder: str, glob: str = SUPPORTED["json"]) -> tuple[list[str], list[str]]:
    """JSON files of a folder by kind: whole-file arrays (also over many lines) and
    one record per line, told apart by the first text of each file in one job."""
    text = spark.read.option("pathGlobFilter", glob).text(folder)
    first = (text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                         F.monotonically_increasing_id().alias("row"), F.ltrim("value").alias("value"))
             .where("value <> ''").groupBy("file").agg(F.min_by(F.substring("value", 1, 1), F.struct("at", "row")).alias("c")))
    found = first.collect()
    return [r.file for r in found if r.c == "["], [r.file for r in found if r.c != "["]


def read_mixed(spark: SparkSession, folder: str, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """JSON and CSV files of one folder read by extension and unioned by name;
    files of any other extension are rejected and returned by name."""
    parts = []
    arrays, lines = split_json(spark, folder)
    if arrays:
        parts.append(read_json_array(spark, arrays, schema))
    if lines:
        parts.append(spark.read.schema(schema).json(lines))
    parts.append(spark.read.schema(schema).option("pathGlobFilter", SUPPORTED["csv"]).option("header", True).csv(folder))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    rejected = [p for p in data_files(spark, folder) if not p.endswith((".json", ".csv"))]
    return out, rejected


def read_parquet_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """An explicit list of Parquet parts in one scan."""
    return spark.read.parquet(*paths)


def read_sheet(spark: SparkSession, paths, names: list[str], skip: int = 2,
               fill_down: list[str] | None = None, glob: str | None = None) -> DataFrame:
    """Spreadsheets exported as CSV with a title row above the header.

    The first ``skip`` lines of each file (title, header) are dropped, columns are
    named by position, rows without any value are dropped and merged cells
    (``fill_down``) take the value above them, also across the splits of a file.
    """
    from vitals.sources import lines
    rows = lines.numbered(lines.stage_lines(spark, paths, glob)).where(F.col("line") > skip)
    cells = rows.withColumn("_c", lines.cells_of(F.col("value"), len(names), ","))
    out = cells.select("file", "block", "row", "line", F.inline_outer(F.array("_c"))).drop("_bad").toDF("file", "block", "row", "line", *names)
    out = out.dropna(how="all", subset=names)
    return (lines.fill_down(out, fill_down) if fill_down else out).select("file", "line", *names)


def with_file_name(df: DataFrame, name: str = "archivo_origen", level: str = "folder") -> DataFrame:
    """The landed file of each row (its name, or the folder holding it)."""
    path = F.col("_metadata.file_path")
    value = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1) if level == "folder" else F.col("_metadata.file_name")
    return df.withColumn(name, value)


def read_tolerant(spark: SparkSession, paths, expected: list[str], schema: T.StructType) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The rows of all files with a header of the schema, missing, extra,
    reordered or differently spaced columns aligned; and the files left out with the
    reason. Fails only when no file is readable. A fixed number of jobs for any
    number of files (``sources.lines``)."""
    from vitals.sources import landing
    landed = landing.read_files(spark, paths, landing.Layout(schema))
    out = landed.files.where("layout IS NULL").orderBy("file").select("file", looks_like_html(F.col("head")).alias("html")).collect()
    return landed.good().select(*expected), [(r["file"], "html" if r["html"] else "cabecera_inesperada") for r in out]


def _probe_parquet(spark: SparkSession, path: str) -> tuple[str, str | None]:
    try:
        spark.read.parquet(path).schema  # footer only
        return path, None
    except Exception:  # noqa: BLE001 - not a Parquet file: find out what it is
        try:
            head = spark.read.text(path).limit(1).first()
        except Exception as e:  # noqa: BLE001
            return path, type(e).__name__
        text = head[0] if head else ""
        html = text.startswith("<!DOCTYPE") or "<html" in text[:200].lower()
        return path, "html" if html else "ilegible"


def read_parquet_parts_tolerant(spark: SparkSession, paths) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Parquet parts read in one scan; a part that is an HTML page (a login
    form served instead of data) or unreadable is left out and listed. One job reads all
    footers, one the scan's file names (no column); only parts that gave no row are
    looked at one by one."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    good = (spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").option("recursiveFileLookup", "true")
            .parquet(*paths))
    # written, one row per part: within the anti join the optimizer drops a distinct, and every row would be sorted
    seen = materialize(good.select(F.col("_metadata.file_path").alias("path")).distinct(), "parts-seen")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")
              .where(~F.regexp_like(F.col("path"), F.lit(r".*/[._][^/]*$"))))
    bad = [(r.path, why) for r in listed.join(seen, "path", "left_anti").collect() if (why := _probe_parquet(spark, r.path)[1])]
    return good, bad


def looks_like_html(text: Column) -> Column:
    """A payload that is an HTML page (starts with <!DOCTYPE, or <html in the first 200 chars)."""
    return text.startswith("<!DOCTYPE") | F.lower(F.substring(text, 1, 200)).contains("<html")


def quarantine(df: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Split payloads into (accepted, quarantined)."""
    flag = F.coalesce(looks_like_html(F.col(text_col)), F.lit(False))
    return df.where(~flag), df.where(flag)
