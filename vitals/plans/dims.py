"""Conformed dimensions (D1–D5) built from the stage frames.

Every builder is distinct/union work (partial aggregation before the
shuffle); ids are assigned by ``sequential_ids`` in natural-key order, so
the same stage input always gives the same ids. Any stage frame may be left
out (None): the dimension is then built from the ones given.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals import catalogues as C
from vitals.functions import rules as R
from vitals.operators import dedup
from vitals.operators.keys import sequential_ids


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ``numbered=False``: the members alone, for a load that gives the ids (plans.load)


def time_members(cases=None, covid_local=None, deaths=None, world=None, covid_world=None) -> DataFrame:
    """D1 members: distinct (anio, mes) of every stage table, annual member mes = 0."""
    parts = []
    if cases is not None:
        parts.append(cases.where(F.col("anio").isNotNull()).select("anio", F.lit(0).alias("mes")))
    if covid_local is not None:
        parts.append(covid_local.where(F.col("anio").isNotNull()).select("anio", "mes"))
    if deaths is not None:
        parts.append(deaths.where(F.col("anio_ocurrencia").isNotNull())
                     .select(F.col("anio_ocurrencia").alias("anio"), F.col("mes_ocurrencia").alias("mes")))
    if world is not None:
        parts.append(world.where(F.col("anio").isNotNull() & F.col("mes").isNotNull()).select("anio", "mes"))
        parts.append(world.where(F.col("anio").isNotNull() & (F.col("time_unit") == "annual"))
                     .select("anio", F.lit(0).alias("mes")))
    if covid_world is not None:
        parts.append(covid_world.where(F.col("anio").isNotNull()).select("anio", "mes"))
    parts = [p.select(F.col("anio").cast("int").alias("anio"), F.col("mes").cast("int").alias("mes")).distinct()
             for p in parts]
    return (_union(parts).select("anio", F.coalesce(F.col("mes"), F.lit(0)).alias("mes")).distinct())


def dim_time(members: DataFrame, covid_start: int = 2020, covid_end: int = 2021, numbered: bool = True) -> DataFrame:
    """id_tiempo, anio, mes, trimestre, periodo."""
    d = members.select("anio", "mes", R.quarter_of(F.col("mes")).alias("trimestre"),
                       R.classify_period(F.col("anio"), covid_start, covid_end).alias("periodo"))
    return sequential_ids(d, "id_tiempo", ["anio", "mes"], id_type="int") if numbered else d


def geo_members(deaths=None, cases=None, covid_local=None) -> DataFrame:
    parts = []
    if deaths is not None:
        parts.append(deaths.where(F.col("nombre_depto_ocurrencia").isNotNull()).select(
            F.col("nombre_depto_ocurrencia").alias("d"), F.col("nombre_muni_ocurrencia").alias("m")))
    for f in (cases, covid_local):
        if f is not None:
            parts.append(f.where(F.col("departamento").isNotNull()).select(
                F.col("departamento").alias("d"), F.col("municipio").alias("m")))
    u = _union([p.distinct() for p in parts])
    return u.select(R.strip(F.coalesce(F.col("d"), F.lit(C.GEO_MISS))).alias("nombre_departamento"),
                    R.strip(F.coalesce(F.col("m"), F.lit(C.GEO_MISS))).alias("nombre_municipio")).distinct()


def dim_geo(members: DataFrame, valid_from: dt.date = dt.date.fromisoformat(C.GEO_VALID_FROM), numbered: bool = True) -> DataFrame:
    """National geography with SCD2 columns (version 1, open)."""
    d = members.select(
        "nombre_departamento", "nombre_municipio",
        F.lit(C.GEO_COUNTRY).alias("region"), F.lit(C.GEO_COUNTRY).alias("pais"), F.lit(C.GEO_ISO3).alias("iso3c"),
        F.lit(valid_from).cast("date").alias("fecha_inicio_vigencia"),
        F.lit(None).cast("date").alias("fecha_fin_vigencia"),
        F.lit(True).alias("es_version_actual"), F.lit(1).alias("version"))
    return sequential_ids(d, "id_geografia", ["nombre_departamento", "nombre_municipio"], id_type="int") if numbered else d


def dim_country(world=None, covid_world=None, numbered: bool = True) -> DataFrame:
    """D3: one row per ISO3 (world-mortality source first), ISO codes completed both ways."""
    iso2_to_iso3 = R.literal_map([(r[0], r[1]) for r in C.SELECTED_COUNTRIES])
    iso3_to_iso2 = R.literal_map([(r[1], r[0]) for r in C.SELECTED_COUNTRIES])
    frames = []
    if world is not None:
        m = world.where(F.col("iso3c").isNotNull()).select(
            F.col("country_name").alias("nombre_pais"), "iso3c").distinct()
        frames.append(m.withColumn("iso2", F.element_at(iso3_to_iso2, F.upper(R.strip(F.col("iso3c"))))))
    if covid_world is not None:
        c = covid_world.where(F.col("country_code").isNotNull()).select(
            F.col("country_name").alias("nombre_pais"), F.col("country_code").alias("iso2")).distinct()
        frames.append(c.withColumn("iso3c", F.element_at(iso2_to_iso3, F.upper(R.strip(F.col("iso2"))))))
    frames = [f.withColumn("iso3c", F.upper(R.strip(F.col("iso3c")))).where(F.col("iso3c").isNotNull())
              for f in frames]
    one = dedup.union_with_priority(frames, ["iso3c"], tie=["nombre_pais", "iso2"])
    region = F.coalesce(F.element_at(R.literal_map(C.DIM_REGION_BY_ISO3), F.col("iso3c")), F.lit("Otro"))
    d = one.select("nombre_pais", "iso3c", "iso2", region.alias("region"))
    return sequential_ids(d, "id_pais", ["iso3c"], id_type="int") if numbered else d


def dim_cause(spark: SparkSession, cases=None, deaths=None, numbered: bool = True) -> DataFrame:
    """Codes of both sources + seed codes, one row per code, chapter and category."""
    frames = []
    if cases is not None:
        frames.append(cases.where(F.col("codigo_cie10").isNotNull()).select(
            "codigo_cie10", F.col("diagnostico").alias("descripcion")).distinct())
    if deaths is not None:
        frames.append(deaths.where(F.col("codigo_cie10").isNotNull()).select(
            "codigo_cie10", F.col("descripcion_causa").alias("descripcion")).distinct())
    frames.append(spark.createDataFrame(C.SEED_CAUSES, "codigo_cie10 string, descripcion string"))
    frames = [f.select(R.icd_upper(F.col("codigo_cie10")).alias("codigo_cie10"),
                       F.coalesce(F.col("descripcion"), F.lit(C.CAUSE_DIM_MISS)).alias("descripcion"))
              for f in frames]
    one = dedup.union_with_priority(frames, ["codigo_cie10"], tie=["descripcion"])
    d = one.select("codigo_cie10", "descripcion",
                   R.icd_chapter_dim(F.col("codigo_cie10")).alias("capitulo_cie10"),
                   R.icd_category(F.col("codigo_cie10")).alias("categoria"))
    return sequential_ids(d, "id_causa", ["codigo_cie10"], id_type="int") if numbered else d


def dim_static(spark: SparkSession) -> dict[str, DataFrame]:
    """Fixed catalogues with fixed ids."""
    return {"dim_sexo": C.sex_df(spark), "dim_grupo_etario": C.age_group_df(spark),
            "dim_fuente": C.source_df(spark)}
