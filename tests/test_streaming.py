"""Incremental landing picks up only new files, exactly once."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.session import scratch_path
from vitals.streaming.landing import land_available


def test_incremental_landing(spark, sf_small):
    folder, target, ckpt = (scratch_path(spark, n) for n in ("inbox", "sandbox", "ckpt"))
    c = spark.read.parquet(f"{sf_small}/customer.parquet").select("c_custkey", "c_name", "c_nationkey")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType())])
    c.where(F.col("c_nationkey") < 10).write.option("header", True).mode("append").csv(folder)
    first = land_available(spark, folder, schema, "customer", target, ckpt)
    c.where(F.col("c_nationkey") >= 10).write.option("header", True).mode("append").csv(folder)
    second = land_available(spark, folder, schema, "customer", target, ckpt)
    third = land_available(spark, folder, schema, "customer", target, ckpt)  # nothing new
    landed = spark.read.parquet(target)
    assert first + second == c.count() and third == 0
    assert landed.count() == c.count()
    assert landed.select("c_custkey").distinct().count() == c.count()
    assert set(landed.columns) >= {"fuente_origen", "archivo_origen"}
