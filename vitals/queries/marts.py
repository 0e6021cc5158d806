"""Mart queries: observed series, baseline, excess label and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals import adapter as A
from vitals.plans import marts as M
from vitals.queries import query


# ---------------------------------------------------------------- marts

def observed_by_department(spark, d) -> DataFrame:
    return M.monthly_observed(A.monthly_death_counts(spark, d, A.TEST_YEARS), years=A.TEST_YEARS)


def labelled_by_department(spark, d) -> DataFrame:
    return M.excess_one_pass(observed_by_department(spark, d), years=A.TEST_BASELINE_YEARS)


def labelled_by_nation(spark, d) -> DataFrame:
    """World-model grain: entity = nation (municipio column), region = its region."""
    counts = A.monthly_death_counts(spark, d, A.TEST_YEARS)
    obs = M.monthly_observed(counts.withColumn("miembro", F.col("municipio")),
                             entity="municipio", member="miembro", years=A.TEST_YEARS)
    regions = A.geo_catalogue(spark, d).select("municipio", F.col("departamento").alias("region"))
    labelled = M.excess_one_pass(obs, entity="municipio", years=A.TEST_BASELINE_YEARS)
    return labelled.join(A.checked(regions), "municipio", "left")


@query("monthly_observed")
def q_monthly_observed(spark, d):
    return observed_by_department(spark, d).orderBy("departamento", "anio", "mes")


@query("baseline")
def q_baseline(spark, d):
    obs = observed_by_department(spark, d)
    return M.round_doubles(M.baseline(obs, years=A.TEST_BASELINE_YEARS))


@query("excess_label")
def q_excess_label(spark, d):
    return M.round_doubles(labelled_by_department(spark, d))


@query("class_distribution")
def q_class_distribution(spark, d):
    return M.round_doubles(M.class_distribution(labelled_by_department(spark, d)))


@query("excess_by_region")
def q_excess_by_region(spark, d):
    out = M.excess_by_region(labelled_by_nation(spark, d))
    return M.round_doubles(out).orderBy(F.desc("porcentaje_con_exceso"), "region")


@query("annual_excess")
def q_annual_excess(spark, d):
    return M.round_doubles(M.annual_excess(labelled_by_department(spark, d)))


@query("year_profile")
def q_year_profile(spark, d):
    return M.year_profile(observed_by_department(spark, d))


@query("entity_series")
def q_entity_series(spark, d):
    return M.round_doubles(M.entity_series(labelled_by_department(spark, d), "america"))


@query("available_entities")
def q_available_entities(spark, d):
    return M.available_entities(A.geo_catalogue(spark, d), ("departamento", "municipio"))
