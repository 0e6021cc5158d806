"""Warehouse layers as Parquet table folders.

Layout: ``<root>/<layer>/<table>/v=<version>/`` plus ``_current``, an
append-only log of one-line files naming committed versions. A load writes a
new version, then appends its name (each file appears atomically at commit);
readers take the greatest name (versions sort by a zero-padded nanosecond
clock). Nothing is overwritten, so readers never see a half-written table or a
missing pointer, and a failed load leaves the previous version live;
``expire`` removes replaced versions after a time of grace. ``root`` must be a shared folder
(by default the one named by ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vitals.operators.lookup import bounded


def _table_dir(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def current_version(spark: SparkSession, root: str, layer: str, name: str) -> str:
    latest = spark.read.text(f"{_table_dir(root, layer, name)}/_current").agg(F.max("value")).first()[0]
    if latest is None:
        raise FileNotFoundError(f"no committed version of {layer}.{name}")
    return latest


def read_version(spark: SparkSession, root: str, layer: str, name: str, version: str) -> DataFrame:
    """A version, committed or not. Of a numbered one (``<version>#<id column>``) each
    row's id is its file's offset and its place in the file (W4): nothing was copied to
    number it, and ids are dense whatever order files are listed or read in."""
    folder, _, id_col = version.partition("#")
    table = f"{_table_dir(root, layer, name)}"
    df = spark.read.parquet(f"{table}/{folder}")
    if not id_col:
        return df
    offsets = spark.read.parquet(f"{table}/_ids/{folder}")
    placed = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return (placed.join(bounded(offsets), "_file")
            .select((F.col("_offset") + F.col("_row") + 1).alias(id_col), *df.columns))


def table_exists(spark: SparkSession, root: str, layer: str, name: str) -> bool:
    """Whether a table has a committed version: a metadata lookup (no Spark job) for
    paths pyarrow understands, a read of the version log otherwise."""
    path = f"{_table_dir(root, layer, name)}/_current"
    try:
        import os

        import pyarrow.fs as pafs
        fs, p = pafs.FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path))
        return fs.get_file_info(p).type != pafs.FileType.NotFound
    except Exception:  # noqa: BLE001 - scheme unknown to pyarrow: ask Spark
        try:
            current_version(spark, root, layer, name)
            return True
        except FileNotFoundError:
            return False
        except AnalysisException as e:  # any other failure is not "absent"
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False


def read_table(spark: SparkSession, root: str, layer: str, name: str, jdbc: dict | None = None) -> DataFrame:
    """Read a layer table (Parquet by default; JDBC when connection options are given).

    JDBC reads are split on ``partitionColumn`` between ``lowerBound`` and
    ``upperBound`` into ``numPartitions`` ranges and the query is pushed down
    as a subquery (``dbtable = "(SELECT …) t"``).
    """
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    return read_version(spark, root, layer, name, current_version(spark, root, layer, name))


def write_version(df: DataFrame, root: str, layer: str, name: str, id_col: str | None = None,
                  partition_by: list[str] | None = None) -> str:
    """A new version that nobody reads until it is committed. With ``id_col`` its rows
    are numbered: the rows of each file are counted from the footers and the offsets
    kept beside the version (one row per file)."""
    version, table = f"v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}", _table_dir(root, layer, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table}/{version}")
    if not id_col:
        return version
    files = (df.sparkSession.read.schema(df.schema).parquet(f"{table}/{version}").groupBy(F.col("_metadata.file_name").alias("_file"))
             .agg(F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")).write.parquet(f"{table}/_ids/{version}")
    return f"{version}#{id_col}"


def commit(spark: SparkSession, root: str, layer: str, name: str, version: str) -> str:
    """Make a version the current one: its name is appended to the log."""
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("append").text(f"{_table_dir(root, layer, name)}/_current")
    return version


def write_replace(df: DataFrame, root: str, layer: str, name: str, partition_by: list[str] | None = None) -> str:
    """K1/K2: replace-table load: write a new version folder, then commit its name to the log."""
    return commit(df.sparkSession, root, layer, name, write_version(df, root, layer, name, partition_by=partition_by))


@contextmanager
def lease(spark: SparkSession, root: str, layer: str, name: str):
    """The current version of a table, kept by ``expire`` while the block runs."""
    version, table = current_version(spark, root, layer, name), _table_dir(root, layer, name)
    held = f"{table}/_leases/{uuid.uuid4().hex}"
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.text(held)
    try:
        yield read_version(spark, root, layer, name, version)
    finally:
        _delete(spark, held)


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []


def expire(spark: SparkSession, root: str, layer: str, name: str, grace_seconds: float) -> list[str]:
    """K1 retention: removes versions that a committed one has replaced for at least
    ``grace_seconds`` (longer than any read), and versions that were never committed and
    are that old, except those under a lease. The current version and younger ones stay."""
    table = _table_dir(root, layer, name)
    log = sorted(r["value"] for r in spark.read.text(f"{table}/_current").collect())  # one line per load
    if not log:
        return []
    now = time.time_ns()
    leases = f"{table}/_leases"
    kept = {log[-1].partition("#")[0]}
    for x in _children(spark, leases):
        kept |= {r["value"].partition("#")[0] for r in spark.read.text(f"{leases}/{x}").collect()}
    stamps = [int(v[2:22]) for v in log]
    gone = []
    for folder in sorted(x for x in _children(spark, table) if x.startswith("v=")):
        made = int(folder[2:22])
        replaced = min((s for s in stamps if s > made), default=None)
        if folder not in kept and replaced is not None and now - replaced >= grace_seconds * 1e9:
            _delete(spark, f"{table}/{folder}")
            _delete(spark, f"{table}/_ids/{folder}")
            gone.append(folder)
    return gone


def write_verified(df: DataFrame, root: str, layer: str, name: str) -> DataFrame:
    """K4: rows counted while writing (``observe``, no extra pass) against a re-read count."""
    spark = df.sparkSession
    obs = Observation(f"load_{name}")
    write_replace(df.observe(obs, F.count(F.lit(1)).alias("rows")), root, layer, name)
    written = int(obs.get["rows"])
    read_back = read_table(spark, root, layer, name).count()  # Parquet footer counts
    return spark.createDataFrame([(name, written, read_back, written == read_back)],
                                 "tabla string, filas_escritas bigint, filas_leidas bigint, coincide boolean")


def digest(df: DataFrame, key: list[str], buckets: int = 64) -> DataFrame:
    """(cubeta, filas, suma, cruz): per bucket of the key an order-free digest of all
    columns, from one scan with a partial aggregate. Sums of two 64-bit hashes as exact
    decimals, so equal rows cannot cancel out."""
    names = sorted(df.columns)
    row = [F.col(f"`{c}`") for c in names]
    return (df.groupBy(F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("cubeta"))
            .agg(F.count(F.lit(1)).alias("filas"), F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias("suma"),
                 F.sum(F.xxhash64(F.lit(7), *row[::-1]).cast("decimal(38,0)")).alias("cruz")))


def differing_buckets(a: DataFrame, b: DataFrame, key: list[str], buckets: int = 64) -> list[int]:
    """Buckets of the key in which two tables differ, of at most ``buckets``."""
    x, y = digest(a, key, buckets), digest(b, key, buckets)
    both = x.join(y.select("cubeta", *[F.col(c).alias(f"_{c}") for c in ("filas", "suma", "cruz")]), "cubeta", "full_outer")
    same = F.lit(True)
    for c in ("filas", "suma", "cruz"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return sorted(r["cubeta"] for r in both.where(~same).select("cubeta").collect())


def replicate(spark: SparkSession, src_root: str, dst_root: str, layer: str,
              dims: list[str], facts: list[str]) -> DataFrame:
    """Copy every table (dimensions first, then facts) keeping ids; a failing
    table is reported and the run goes on. Output: tabla, orden, filas_origen,
    filas_destino, estado."""
    rows = []
    for order, name in enumerate([*dims, *facts], start=1):
        try:
            src = read_table(spark, src_root, layer, name)
            n_src = src.count()
            write_replace(src, dst_root, layer, name)
            n_dst = read_table(spark, dst_root, layer, name).count()
            rows.append((name, order, n_src, n_dst, "ok" if n_src == n_dst else "diferencia"))
        except Exception as e:  # noqa: BLE001 - per-table failure is part of the report
            rows.append((name, order, None, None, f"error:{type(e).__name__}"))
    return spark.createDataFrame(rows, "tabla string, orden int, filas_origen bigint, filas_destino bigint, "
                                       "estado string")


def verify_replica(spark: SparkSession, src_root: str, dst_root: str, layer: str, keys: dict[str, list[str]],
                   foreign: dict[str, list[tuple[str, str, str]]]) -> DataFrame:
    """The copy against its source, content by content: (tabla, filas_origen,
    filas_destino, cubetas_distintas, claves_rotas, estado). ``keys``: table → natural key;
    ``foreign``: table → (column, dimension, its key), verified on the copy."""
    rows = []
    for name, key in keys.items():
        a, b = read_table(spark, src_root, layer, name), read_table(spark, dst_root, layer, name)
        bad = differing_buckets(a, b, key)
        broken = 0
        for column, dim, dim_key in foreign.get(name, []):
            used = b.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
            lost = used.join(read_table(spark, dst_root, layer, dim).select(F.col(dim_key).alias("_k")), "_k", "left_anti")
            broken += lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        rows.append((name, a.count(), b.count(), bad, broken, "ok" if not bad and not broken else "diferencia"))
    return spark.createDataFrame(rows, "tabla string, filas_origen bigint, filas_destino bigint, cubetas_distintas array<int>, "
                                       "claves_rotas bigint, estado string")


@dataclass
class Source:
    """K5: one landing job of the registry: a function building the landed frame, or a
    ``job`` (spark, root, table name) that lands its own table, verified and with provenance,
    and returns it with its report."""
    name: str
    build: Callable[[SparkSession], DataFrame] | None = None
    job: Callable[[SparkSession, str, str], tuple[DataFrame, DataFrame]] | None = None


class Registry:
    """K5/Q10: allow-listed sources; run all or a named subset, failures isolated."""

    def __init__(self, sources: list[Source]):
        self.sources = {s.name: s for s in sources}

    def land(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.sources:
            raise ValueError(f"unknown source '{name}'; allowed: {sorted(self.sources)}")
        df = self.sources[name].build(spark)
        # provenance (P6): sources that already name a per-row origin keep it
        return df if "fuente_origen" in df.columns else df.withColumn("fuente_origen", F.lit(name))

    def run(self, spark: SparkSession, root: str, names: list[str] | None = None,
            layer: str = "sandbox") -> DataFrame:
        """Q4: one row per source: estado ("diferencia" when fewer or more rows were
        read back than written), filas, columnas, error, mensaje, inicio, fin, segundos."""
        names = list(self.sources) if names is None else names
        unknown = [n for n in names if n not in self.sources]
        if unknown:
            raise ValueError(f"unknown sources {unknown}; allowed: {sorted(self.sources)}")
        rows = []
        for n in names:
            start = dt.datetime.now(dt.timezone.utc)
            try:
                if self.sources[n].job:
                    df, rep = self.sources[n].job(spark, root, n)
                    lost = rep.first().asDict().get("filas_rechazadas")
                    row = (n, "ok", df.count(), len(df.columns), None, f"{lost} rechazadas" if lost else None)
                else:
                    df = self.land(spark, n)
                    rep = write_verified(df, root, layer, n).first()
                    told = None if rep.coincide else f"{rep.filas_escritas} escritas, {rep.filas_leidas} leidas"
                    row = (n, "ok" if rep.coincide else "diferencia", rep.filas_escritas, len(df.columns), None, told)
            except Exception as e:  # noqa: BLE001 - one failing source does not stop the others
                row = (n, "error", 0, 0, type(e).__name__, str(e)[:500])
            end = dt.datetime.now(dt.timezone.utc)
            rows.append((*row, start, end, (end - start).total_seconds()))
        return spark.createDataFrame(rows, "fuente string, estado string, filas bigint, columnas int, error string, "
                                           "mensaje string, inicio timestamp, fin timestamp, segundos double")


def run_summary(report: DataFrame) -> DataFrame:
    """Q4 summary: sources ok / failed and total rows."""
    return report.agg(F.count_if(F.col("estado") == "ok").cast("bigint").alias("ok"),
                      F.count_if(F.col("estado") != "ok").cast("bigint").alias("fallidas"),
                      F.sum("filas").cast("bigint").alias("filas_totales"))
