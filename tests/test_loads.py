"""Contracts as gates, ids from file offsets, versions of a place, replicas, retention."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from vitals.operators.upsert import scd2_merge
from vitals.plans import contracts as K
from vitals.plans import facts as H
from vitals.sources import layers

RULES = K.Contract((("k", "int", False, None), ("t", "string", True, 3)), (("k",),), (("k", "dim_d", "id"),), "sk")


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, t string")


def test_a_bad_load_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    dims = {"dim_d": spark.range(1, 10).withColumnRenamed("id", "id")}
    first = K.publish(table(spark, [("1", "a"), ("2", "b")]), root, "dw", "f", RULES, dimensions=dims)
    assert sorted(map(tuple, first.collect())) == [(1, 1, "a"), (2, 2, "b")]
    bad = {"nulos": [(None, "a")], "tipo": [("x", "a")], "longitud": [("1", "abcd")], "unica": [("1", "a"), ("1", "b")], "foranea": [("77", "a")]}
    for rule, rows in bad.items():
        with pytest.raises(K.ContractError) as e:
            K.publish(table(spark, rows), root, "dw", "f", RULES, dimensions=dims)
        assert [r for r, _, n in e.value.violations if n] == [rule]
        assert layers.read_table(spark, root, "dw", "f").count() == 2
    with pytest.raises(K.ContractError):
        K.publish(table(spark, [("1", "a")]).drop("t"), root, "dw", "f", RULES, dimensions=dims)
    assert len(K.CONTRACTS) == 12


def test_ids_survive_a_lost_file_order(spark, tmp_path):
    root, moved = str(tmp_path / "a"), str(tmp_path / "b")
    wide = spark.range(1000).select(F.col("id").alias("v")).repartition(13)
    version = layers.write_version(wide, root, "dw", "f", "sk")
    layers.commit(spark, root, "dw", "f", version)
    ids = {r.v: r.sk for r in layers.read_table(spark, root, "dw", "f").collect()}
    assert sorted(ids.values()) == list(range(1, 1001))
    # the same files listed in another order, with other times and splits
    shutil.copytree(root, moved)
    folder = f"{moved}/dw/f/{version.partition('#')[0]}"
    for k, name in enumerate(sorted(os.listdir(folder), reverse=True)):
        os.utime(f"{folder}/{name}", (k, k))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        again = layers.read_table(spark, moved, "dw", "f")
        assert {r.v: r.sk for r in again.repartition(3).collect()} == ids
        assert again.where("sk = 500").count() == 1 and again.select("v").distinct().count() == 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert layers.read_version(spark, root, "dw", "f", layers.write_version(wide.where("v < 0"), root, "dw", "f", "sk")).count() == 0


def test_a_fact_takes_the_version_of_its_date(spark):
    start = spark.createDataFrame([(1, "A", "m", "r1", dt.date(2015, 1, 1), None, True, 1)],
                                  "id_geografia int, nombre_departamento string, nombre_municipio string, region string, fecha_inicio_vigencia date, "
                                  "fecha_fin_vigencia date, es_version_actual boolean, version int")
    new = spark.createDataFrame([("A", "m", "r2")], "nombre_departamento string, nombre_municipio string, region string")
    geo = scd2_merge(start, new, ["nombre_departamento", "nombre_municipio"], ["region"], dt.date(2020, 3, 1), "id_geografia")
    fact = spark.createDataFrame([(2010, 5), (2019, 0), (2020, 2), (2020, 3), (2024, None)], "anio int, mes int").select(
        "*", F.lit("A").alias("departamento"), F.lit("m").alias("municipio"))
    got = H._geo_fk(fact, geo).join(geo.select("id_geografia", "version"), "id_geografia").collect()
    assert sorted((r.anio, r.mes or 0, r.version) for r in got) == [(2010, 5, 1), (2019, 0, 1), (2020, 2, 1), (2020, 3, 2), (2024, 0, 2)]


def test_a_replica_with_one_altered_row(spark):
    a = spark.range(5000).select("id", F.concat(F.lit("t"), F.col("id") % 7).alias("t"), F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("x"))
    assert layers.differing_buckets(a, a.repartition(7).select("x", "id", "t"), ["id"]) == []
    for changed in (a.withColumn("t", F.when(F.col("id") == 1234, "u").otherwise(F.col("t"))), a.where("id <> 1234"), a.unionByName(a.where("id = 1234")),
                    a.withColumn("x", F.when(F.col("id") != 1234, F.col("x")))):
        assert len(layers.differing_buckets(a, changed, ["id"])) == 1


def test_retention(spark, tmp_path):
    root = str(tmp_path)
    for k in range(20):
        layers.write_replace(spark.range(k + 1), root, "dw", "t")
        if k == 9:
            with layers.lease(spark, root, "dw", "t") as held:
                layers.write_replace(spark.range(99), root, "dw", "t")
                layers.expire(spark, root, "dw", "t", 0)
                assert held.count() == 10  # its files are still there
        layers.expire(spark, root, "dw", "t", 0)
        folders = [x for x in os.listdir(f"{root}/dw/t") if x.startswith("v=")]
        assert len(folders) == 1
    assert layers.read_table(spark, root, "dw", "t").count() == 20
    layers.write_replace(spark.range(3), root, "dw", "t")
    assert layers.expire(spark, root, "dw", "t", 3600) == []  # within the time of grace
    failed = layers.write_version(spark.range(5), root, "dw", "t")  # never committed, younger than the current one
    assert layers.expire(spark, root, "dw", "t", 0) and os.path.isdir(f"{root}/dw/t/{failed}")
