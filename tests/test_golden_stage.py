"""Golden cases of FIXTURES.md §2 that run through the stage operators."""

import datetime as dt

from pyspark.sql import functions as F

from vitals.operators import lookup
from vitals.plans import stage as S


def test_tr004_dictionary_defaults(spark):
    dic = spark.createDataFrame([("Sexo del difunto(a)", "1.0", "Hombre", 1), ("Sexo del difunto(a)", "2", "Mujer", 2)],
                                "variable string, codigo string, etiqueta string, pos long")
    df = spark.createDataFrame([(None,), ("9999",), ("1",), (" 2 ",)], "Sexo string")
    out = lookup.decode(df, lookup.normalised_dictionary(dic), {"sexo": ("Sexo", "Sexo del difunto(a)")})
    assert [r.sexo for r in out.collect()] == ["Ignorado / No especificado", "Código no encontrado: 9999",
                                               "Hombre", "Mujer"]


def test_tr006_dates_and_year_window(spark):
    raw = spark.createDataFrame(
        [("Guatemala", "mixco", 1, 1000, "2020-08-10", 2, "a"), ("Guatemala", "mixco", 1, 1000, "2010-05-01", 2, "b"),
         ("Guatemala", "mixco", 1, 1000, "2021-02-30", 2, "c"), ("Guatemala", "mixco", 1, 1000, "2014-03-01", 2, "d")],
        "departamento string, municipio string, codigo_municipio long, poblacion long, "
        "fecha_fallecimiento string, fallecidos long, pos string").withColumn(
        "codigo_departamento", F.lit(1)).withColumn("fecha_fallecimiento", F.try_to_date("fecha_fallecimiento"))
    out = S.stage_covid_local(raw, years=(2015, 2024)).collect()
    assert [(r.anio, r.mes) for r in out] == [(2020, 8)]


def test_tr008_discards(spark):
    raw = spark.createDataFrame(
        [("G", "m", 1, 1000, dt.date(2021, 1, 1), 0, "a"), ("G", "m", 1, 1000, dt.date(2021, 1, 2), None, "b"),
         ("G", "m", 1, 1000, None, 3, "c"), ("G", "m", 1, 1000, dt.date(2021, 1, 3), 3, "d")],
        "departamento string, municipio string, codigo_municipio long, poblacion long, fecha_fallecimiento date, "
        "fallecidos long, pos string").withColumn("codigo_departamento", F.lit(1))
    out = S.stage_covid_local(raw, years=(2020, 2024)).collect()
    assert [(r.fecha_fallecimiento, r.fallecidos) for r in out] == [(dt.date(2021, 1, 3), 3)]
    cases = spark.createDataFrame(
        [(2020, "G", "M", None, "d", "x", "F", 1, 1), (2020, "G", "M", "J18", "d", "x", "F", None, 2),
         (2020, "G", "M", "J18", "d", "x", "F", 5, 3)],
        "`Año` int, Departamento string, Municipio string, `CIE-10` string, `Diagnóstico` string, "
        "`Grupo Etario` string, Sexo string, Casos long, l_linenumber int").withColumn("l_orderkey", F.lit(1))
    assert S.stage_cases(cases, years=(2012, 2024)).count() == 1


def test_tr013_countries(spark):
    world = spark.createDataFrame(
        [("GTM", "Guatemala", 2020, 3, "monthly", 10.0), ("ESP", "España", 2020, 3, "monthly", 9.0),
         ("ZAF", "Sudáfrica", 2020, 3, "monthly", 8.0), ("GTM", "Guatemala", 2014, 3, "monthly", 7.0)],
        "iso3c string, country_name string, year int, time int, time_unit string, deaths double")
    regional = spark.createDataFrame([], "pais string, anio int, defunciones_general long, fuente_origen string")
    out = S.stage_mortality_world(world, regional, min_year=2015).collect()
    assert sorted(r.iso3c for r in out) == ["ESP", "GTM"]
    weekly = spark.createDataFrame(
        [(dt.date(2021, 1, 4), "GT", "Guatemala", "AMRO", 1, 1, 1, 1), (dt.date(2021, 1, 4), "ZA", "Sudáfrica", "AFRO", 1, 1, 1, 1)],
        "Date_reported date, Country_code string, Country string, WHO_region string, New_cases long, "
        "Cumulative_cases long, New_deaths long, Cumulative_deaths long")
    assert [r.country_code for r in S.stage_covid_world(weekly).collect()] == ["GT"]
