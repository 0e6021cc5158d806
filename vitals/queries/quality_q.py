"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitals import adapter as A
from vitals.operators import quality
from vitals.queries import query


@query("profile_table")
def q_profile_table(spark, d):
    o = A.read(spark, d, "orders")
    return o.agg(F.count(F.lit(1)).cast("bigint").alias("filas"),
                 F.countDistinct("o_custkey").cast("bigint").alias("clientes_distintos"),
                 F.min("o_orderdate").alias("fecha_min"), F.max("o_orderdate").alias("fecha_max"),
                 F.round(F.sum("o_totalprice"), 2).alias("total"),
                 F.count_if(F.col("o_orderpriority").isNull()).cast("bigint").alias("nulos_prioridad"),
                 F.sort_array(F.collect_set("o_orderstatus")).alias("estados"))


@query("value_counts")
def q_value_counts(spark, d):
    return quality.value_counts(A.read(spark, d, "documents"), "lang")


@query("null_counts")
def q_null_counts(spark, d):
    docs = A.read(spark, d, "documents").select("doc_id", "lang", "n_chars")
    labelled = docs.join(A.read(spark, d, "labels"), "doc_id", "left")
    return quality.null_counts(labelled, ["doc_id", "lang", "n_chars", "quality", "toxic"])


@query("top_k_groups")
def q_top_k_groups(spark, d):
    out = quality.top_k_groups(A.read(spark, d, "documents"), "source", "n_chars", 5)
    return out.withColumn("total", F.col("total").cast("bigint"))


@query("age_text_flags")
def q_age_text_flags(spark, d):
    """Chronic-case age texts that the infant rule catches although they name older ages."""
    raw = A.cases_raw(spark, d)
    q = F.col("Casos").cast("string")
    texts = raw.select(F.when(F.col("l_linenumber") % 5 == 0, F.concat(F.lit("menor de "), q))
                       .when(F.col("l_linenumber") % 5 == 1, F.concat(F.lit("< "), q))
                       .otherwise(F.col("Grupo Etario")).alias("grupo"))
    return quality.age_text_flags(texts, "grupo")


@query("profile_columns")
def q_profile_columns(spark, d):
    """Q2: the profile of two whole tables, one of them merged from the profiles of its parts."""
    o = A.read(spark, d, "orders").withColumn("nota", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")))
    parts = quality.profile_sketches(o.where("o_orderkey % 2 = 0")).unionByName(quality.profile_sketches(o.where("o_orderkey % 2 = 1")))
    both = (quality.finished(quality.merge_profiles(parts)).withColumn("tabla", F.lit("orders"))
            .unionByName(quality.profile(A.read(spark, d, "customer")).withColumn("tabla", F.lit("customer"))))
    return both.select("tabla", "columna", "filas", "nulos", "minimo", "maximo", "primero", "ultimo")
