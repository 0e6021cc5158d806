"""Stage pipeline queries (T1–T5) and the discard report (Q1)."""

from __future__ import annotations

from vitals import adapter as A
from vitals.operators import quality
from vitals.plans import stage as S
from vitals.queries import query

STAGE_YEARS = (1996, 2001)


def stage_deaths_df(spark, d, columns=None):
    return S.stage_deaths(A.deaths_raw(spark, d), A.ine_dictionary(spark, d),
                          S.icd_catalogue(A.icd_catalogue_raw(spark, d)),
                          A.TEST_COVID_START, A.TEST_COVID_END, columns)


def stage_cases_df(spark, d):
    return S.stage_cases(A.cases_raw(spark, d), years=STAGE_YEARS,
                         covid_start=A.TEST_COVID_START, covid_end=A.TEST_COVID_END)


def stage_covid_local_df(spark, d):
    return S.stage_covid_local(A.covid_local_long(spark, d), years=STAGE_YEARS, covid_end=A.TEST_COVID_END)


def regional_df(spark, d):
    return S.homologate_regional(A.regional_panama(spark, d), A.regional_costa_rica(spark, d))


def stage_mortality_world_df(spark, d):
    return S.stage_mortality_world(A.world_mortality(spark, d), regional_df(spark, d), min_year=STAGE_YEARS[0],
                                   covid_start=A.TEST_COVID_START, covid_end=A.TEST_COVID_END)


def stage_covid_world_df(spark, d):
    return S.stage_covid_world(A.covid_world_weekly(spark, d), A.TEST_COVID_START, A.TEST_COVID_END)


@query("stage_deaths")
def q_stage_deaths(spark, d):
    return stage_deaths_df(spark, d)


@query("stage_cases")
def q_stage_cases(spark, d):
    return stage_cases_df(spark, d)


@query("stage_covid_local")
def q_stage_covid_local(spark, d):
    return stage_covid_local_df(spark, d)


@query("stage_mortality_world")
def q_stage_mortality_world(spark, d):
    return stage_mortality_world_df(spark, d)


@query("stage_covid_world")
def q_stage_covid_world(spark, d):
    return stage_covid_world_df(spark, d)


@query("discard_report")
def q_discard_report(spark, d):
    return quality.discard_report(A.cases_raw(spark, d), S.cases_filter_rules(STAGE_YEARS))
