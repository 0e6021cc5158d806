"""Incremental landing (S10 + P6) with Structured Streaming.

The batch landing re-reads a whole folder; when yearly files keep arriving,
the same landing can run as a file stream: each trigger picks up only files
not seen before, adds the provenance columns and appends to the sandbox
table. ``availableNow`` processes the backlog and stops (a scheduled batch
with exactly-once bookkeeping kept in the checkpoint folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landing_stream(spark: SparkSession, folder: str, schema: T.StructType, source: str,
                   fmt: str = "csv", options: dict | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in {"header": "true", **(options or {})}.items():
        reader = reader.option(k, v)
    return (reader.load(folder)
            .withColumn("fuente_origen", F.lit(source))
            .withColumn("archivo_origen", F.col("_metadata.file_name")))


def land_available(spark: SparkSession, folder: str, schema: T.StructType, source: str, target: str,
                   checkpoint: str, fmt: str = "csv", options: dict | None = None) -> int:
    """Append every not-yet-landed file of ``folder`` to the Parquet table ``target``.

    Returns the number of rows landed by this run. ``checkpoint`` must sit in a
    shared folder so a restarted driver resumes without re-landing files.
    """
    stream = landing_stream(spark, folder, schema, source, fmt, options)
    query = (stream.writeStream.format("parquet").option("path", target)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    progress = query.recentProgress
    return int(sum(p.get("numInputRows", 0) for p in progress)) if progress else 0
