"""Fact builders (H1–H5), FK reports (J10/Q3) and the drill-across view (H6).

Pattern of every fact: aggregate the stage frame first (partial + final hash
aggregate, the only shuffle of the big side), then attach dimension ids with
size-checked broadcast lookups, report NULL FKs and drop the orphans. The
dimensions are bounded by geography × calendar × code lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals import catalogues as C
from vitals.functions import rules as R
from vitals.operators import lookup


@dataclass
class FactBuild:
    """The fact before orphan removal, the FK columns that must be present, and the final fact."""
    resolved: DataFrame
    required: list[str]
    columns: list[str]

    @property
    def fact(self) -> DataFrame:
        cond = F.lit(True)
        for c in self.required:
            cond = cond & F.col(c).isNotNull()
        return self.resolved.where(cond).select(*self.columns)

    def null_report(self) -> DataFrame:
        from vitals.operators.quality import fk_null_report
        return fk_null_report(self.resolved, self.required)


def scalar_id(dim: DataFrame, name_col: str, name: str, id_col: str, fallback: int) -> int:
    """Id of one named member (a single value to the driver), fallback when absent."""
    row = dim.where(F.col(name_col) == name).agg(F.min(id_col)).first()
    return int(row[0]) if row and row[0] is not None else fallback


def _time_fk(df: DataFrame, dim_time: DataFrame) -> DataFrame:
    return lookup.foreign_key(df, dim_time, [("anio", "anio"), ("mes", "mes")], "id_tiempo")


def _geo_fk(df: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """Place by name; of a place with history (D7) the version valid on the fact's
    first day. The first version also holds before its start."""
    on = [("departamento", "nombre_departamento"), ("municipio", "nombre_municipio")]
    if "fecha_inicio_vigencia" in dim_geo.columns and "anio" in df.columns:
        day = F.make_date("anio", F.greatest(F.coalesce(F.col("mes"), F.lit(1)), F.lit(1)), F.lit(1))
        versions = dim_geo.withColumn("_from", F.when(F.col("version") > 1, F.col("fecha_inicio_vigencia")))
        if (size := getattr(dim_geo, lookup.SIZE_ATTR, None)) is not None:
            setattr(versions, lookup.SIZE_ATTR, size)
        return lookup.foreign_key(df, versions, on, "id_geografia", valid=(day, "_from", "fecha_fin_vigencia"))
    if "es_version_actual" in dim_geo.columns:  # facts without a date take the open version
        dim_geo = dim_geo.where("es_version_actual")
    return lookup.foreign_key(df, dim_geo, on, "id_geografia")


def _geo_keys(df: DataFrame) -> DataFrame:
    return (df.withColumn("departamento", R.strip(F.coalesce(F.col("departamento"), F.lit(C.GEO_MISS))))
            .withColumn("municipio", R.strip(F.coalesce(F.col("municipio"), F.lit(C.GEO_MISS)))))


def _age_fk(df: DataFrame, dim_age: DataFrame, label_col: str) -> DataFrame:
    out = lookup.foreign_key(df, dim_age, [(label_col, "rango")], "id_grupo_etario")
    return out.withColumn("id_grupo_etario", F.coalesce(F.col("id_grupo_etario"), F.lit(C.AGE_GROUP_ID_MISS)))


def fact_deaths(stage: DataFrame, dim_time: DataFrame, dim_geo: DataFrame, dim_cause: DataFrame,
                dim_age: DataFrame, dim_source: DataFrame) -> FactBuild:
    """H1: deaths counted per time × place × sex × age band × cause × period."""
    agg = (stage.where(F.col("anio_ocurrencia").isNotNull())
           .groupBy(F.col("anio_ocurrencia").alias("anio"), F.col("mes_ocurrencia").alias("mes"),
                    F.col("nombre_depto_ocurrencia").alias("departamento"),
                    F.col("nombre_muni_ocurrencia").alias("municipio"),
                    "sexo", "grupo_etario", "codigo_cie10", "periodo")
           .agg(F.count(F.lit(1)).cast("bigint").alias("total_casos")))
    df = (_geo_keys(agg).withColumn("mes", F.coalesce(F.col("mes"), F.lit(0)))
          .withColumn("codigo_cie10", R.icd_upper(F.col("codigo_cie10")))
          .withColumn("id_sexo", R.sex_id(F.col("sexo")))
          .withColumn("grupo_std", R.age_label_to_dim(F.col("grupo_etario"))))
    df = _time_fk(df, dim_time)
    df = _geo_fk(df, dim_geo)
    df = lookup.foreign_key(df, dim_cause, [("codigo_cie10", "codigo_cie10")], "id_causa")
    df = _age_fk(df, dim_age, "grupo_std")
    df = df.withColumn("id_fuente", F.lit(scalar_id(dim_source, "nombre", "INE", "id_fuente", 1)))
    return FactBuild(df, ["id_tiempo", "id_geografia", "id_causa", "id_sexo", "id_grupo_etario"],
                     ["id_tiempo", "id_geografia", "id_causa", "id_sexo", "id_grupo_etario", "id_fuente",
                      "total_casos", "periodo"])


def fact_cases(stage: DataFrame, dim_time: DataFrame, dim_geo: DataFrame, dim_cause: DataFrame,
               dim_age: DataFrame, min_year: int = 2015) -> FactBuild:
    """H2: chronic cases summed per year (annual member, mes = 0)."""
    agg = (stage.where(F.col("anio").isNotNull() & (F.col("anio") >= min_year))
           .groupBy("anio", "departamento", "municipio", "codigo_cie10", "grupo_etario", "sexo", "periodo")
           .agg(F.sum("casos").alias("casos")))
    df = (_geo_keys(agg).withColumn("mes", F.lit(0))
          .withColumn("codigo_cie10", R.icd_upper(F.col("codigo_cie10")))
          .withColumn("id_sexo", R.sex_id(F.col("sexo")))
          .withColumn("rango_std", R.age_group_from_text(F.col("grupo_etario")))
          .withColumn("id_fuente", F.lit(2)))
    df = _time_fk(df, dim_time)
    df = _geo_fk(df, dim_geo)
    df = lookup.foreign_key(df, dim_cause, [("codigo_cie10", "codigo_cie10")], "id_causa")
    df = _age_fk(df, dim_age, "rango_std")
    df = df.withColumn("casos", F.coalesce(F.col("casos"), F.lit(0)).cast("bigint"))
    return FactBuild(df, ["id_tiempo", "id_geografia", "id_causa", "id_grupo_etario"],
                     ["id_tiempo", "id_geografia", "id_causa", "id_grupo_etario", "id_sexo", "id_fuente",
                      "casos", "periodo"])


def fact_covid_local(stage: DataFrame, dim_time: DataFrame, dim_geo: DataFrame, dim_cause: DataFrame,
                     dim_source: DataFrame, rate: str = "max_daily") -> FactBuild:
    """H3: monthly local COVID deaths. ``rate="max_daily"`` keeps the published measure
    (MAX of the daily rates); ``rate="monthly"`` gives deaths of the month per 100k of
    the place's population."""
    agg = (stage.groupBy("anio", "mes", "departamento", "municipio", "periodo")
           .agg(F.sum("fallecidos").alias("fallecidos"), F.max("tasa_por_100k").alias("tasa_por_100k"),
                F.max("poblacion").alias("_pob")))
    if rate == "monthly":
        agg = agg.withColumn("tasa_por_100k", R.rate_per_100k(F.col("fallecidos"), F.col("_pob")))
    agg = agg.drop("_pob")
    df = _geo_keys(agg).withColumn("mes", F.coalesce(F.col("mes"), F.lit(0)))
    df = _time_fk(df, dim_time)
    df = _geo_fk(df, dim_geo)
    df = (df.withColumn("id_causa", F.lit(scalar_id(dim_cause, "codigo_cie10", "U071", "id_causa", 1)))
          .withColumn("id_fuente", F.lit(scalar_id(dim_source, "nombre", "MSPAS_COVID", "id_fuente", 3)))
          .withColumn("fallecidos", F.coalesce(F.col("fallecidos"), F.lit(0)).cast("bigint"))
          .withColumn("tasa_por_100k", F.col("tasa_por_100k").cast("decimal(10,4)")))
    return FactBuild(df, ["id_tiempo", "id_geografia"],
                     ["id_tiempo", "id_geografia", "id_causa", "id_fuente", "fallecidos", "tasa_por_100k",
                      "periodo"])


SOURCE_IDS = [("WORLD_MORTALITY", 4), ("CENTROAMERICA_RDS", 5)]


def fact_mortality_world(stage: DataFrame, dim_time: DataFrame, dim_country: DataFrame,
                         weeks_to_month: bool = False) -> FactBuild:
    """H4: deaths per country × year × month/week. Weekly rows carry no month, so by
    default they land on the annual member (month 0) as published; with
    ``weeks_to_month`` they land on the month of their ISO week."""
    if weeks_to_month:
        stage = stage.withColumn("mes", F.coalesce(
            F.col("mes"), F.when(F.col("semana").isNotNull(), R.iso_week_month(F.col("anio"), F.col("semana")))))
    agg = (stage.groupBy("iso3c", "anio", "mes", "semana", "time_unit", "fuente", "periodo")
           .agg(F.sum("deaths").alias("deaths")))
    df = (agg.withColumn("mes", F.coalesce(F.col("mes"), F.lit(0)))
          .withColumn("id_fuente", F.coalesce(F.element_at(R.literal_map(SOURCE_IDS), F.col("fuente")), F.lit(4))))
    df = _time_fk(df, dim_time)
    df = lookup.foreign_key(df, dim_country, [("iso3c", "iso3c")], "id_pais")
    df = (df.withColumnRenamed("id_pais", "id_geografia_mundial")
          .withColumn("deaths", F.coalesce(F.col("deaths"), F.lit(0.0)).cast("bigint")))
    return FactBuild(df, ["id_tiempo", "id_geografia_mundial"],
                     ["id_tiempo", "id_geografia_mundial", "id_fuente", "deaths", "time_unit", "semana", "periodo"])


def fact_covid_world(stage: DataFrame, dim_time: DataFrame, dim_country: DataFrame) -> FactBuild:
    """H5: monthly world COVID rows (no re-aggregation), country by ISO2."""
    df = _time_fk(stage, dim_time)
    df = lookup.foreign_key(df, dim_country, [("country_code", "iso2")], "id_pais")
    df = df.withColumnRenamed("id_pais", "id_geografia_mundial").withColumn("id_fuente", F.lit(6))
    for c in ["new_cases_mes", "new_deaths_mes", "cum_cases_fin", "cum_deaths_fin"]:
        df = df.withColumn(c, R.to_long_or_zero(F.col(c)))
    df = df.withColumn("semanas_reporte", F.col("semanas_reporte").cast("int"))
    return FactBuild(df, ["id_tiempo", "id_geografia_mundial"],
                     ["id_tiempo", "id_geografia_mundial", "id_fuente", "new_cases_mes", "new_deaths_mes",
                      "cum_cases_fin", "cum_deaths_fin", "semanas_reporte", "periodo"])


# Conformed-dimension matrix (H6): which fact uses which dimension.
CONFORMED = {
    "fact_defunciones_gt": ["dim_tiempo", "dim_geografia_gt", "dim_causa_cie10", "dim_sexo",
                            "dim_grupo_etario", "dim_fuente"],
    "fact_morbimortalidad_mec": ["dim_tiempo", "dim_geografia_gt", "dim_causa_cie10", "dim_sexo",
                                 "dim_grupo_etario", "dim_fuente"],
    "fact_mortalidad_covid_gt": ["dim_tiempo", "dim_geografia_gt", "dim_causa_cie10", "dim_fuente"],
    "fact_mortalidad_mundial": ["dim_tiempo", "dim_geografia_mundial", "dim_fuente"],
    "fact_covid_mundial": ["dim_tiempo", "dim_geografia_mundial", "dim_fuente"],
}


def shared_dimensions(a: str, b: str) -> list[str]:
    return [d for d in CONFORMED[a] if d in CONFORMED[b]]


def drill_across(left: DataFrame, left_measure: str, right: DataFrame, right_measure: str,
                 keys: list[str]) -> DataFrame:
    """H6: each fact rolled up to the shared keys, then a full outer join on them."""
    a = left.groupBy(*keys).agg(F.sum(left_measure).cast("bigint").alias(left_measure))
    b = right.groupBy(*keys).agg(F.sum(right_measure).cast("bigint").alias(right_measure))
    return a.join(b, keys, "full_outer")


def denormalise(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Fact ids → natural keys (inner joins on bounded dimensions)."""
    out = fact
    for _, (dim, id_col, natural) in dims.items():
        out = out.join(lookup.bounded(dim.select(id_col, *natural), proof=dim), id_col).drop(id_col)
    return out
