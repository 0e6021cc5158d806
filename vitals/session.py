"""Spark session and shared-folder helpers.

Everything the library writes (landed files, warehouse layers, lineage cuts)
goes below one shared root. On a cluster that root is the folder named by
``spark.checkpoint.dir``; a local temporary folder is only used when that
setting is unset and Spark runs in local mode (tests, the bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcasts are explicit and size-checked (operators.lookup.bounded, fixed
    # catalogues); the planner's file-size estimate never broadcasts a big table
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "UTC",
    # generated code of wide projections is longer than what the JVM compiles by default;
    # interpreted, the stage jobs take two to three times as long
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of ids / splits are removed once no plan references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: enough shuffle partitions that the biggest
    shuffle (about the input size here: the adapter's joins shuffle narrow key
    columns of the fact tables) gives ~target_partition_bytes per task, at least
    3 waves of the cluster's cores; AQE coalesces the small stages back down."""
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {"spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
            "spark.sql.files.maxPartitionBytes": str(256 << 20),
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20)}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vitals", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


_LOCAL_ROOTS: dict[int, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir``; a private folder is made only when the
    setting is unset and the master is local (a cluster must name its own).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    root = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            root = None
    if not root:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        key = id(sc) if sc is not None else id(spark)
        root = _LOCAL_ROOTS.get(key)
        if root is None:
            root = tempfile.mkdtemp(prefix="vitals-shared-")
            _LOCAL_ROOTS[key] = root
    root = root.rstrip("/")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root + "/checkpoints")
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once as a Parquet table in the shared folder and read it back.

    Used where one derived table feeds several plans (stage → dimensions and
    facts): later reads get column pruning and filter pushdown, and a lost
    executor recomputes nothing upstream of the written table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
