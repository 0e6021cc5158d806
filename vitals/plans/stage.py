"""Stage pipelines (T1–T5): sandbox frames → cleaned stage frames.

Each job is one lazy plan of narrow column rules plus, where the source needs
it, one dedup aggregate or one rollup. Lookups against catalogues are size
checked broadcasts; fixed maps are literal map expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals import catalogues as C
from vitals.functions import rules as R
from vitals.operators import dedup, lookup, reshape

FILE, LOADED = "archivo_origen", "fecha_carga"


def _file(raw: DataFrame) -> list[Column]:
    """The landed file of each row, where the sandbox names it."""
    return [F.col(FILE)] if FILE in raw.columns else []


def loaded(stage: DataFrame, at: str) -> DataFrame:
    """stage rows with the time of their load (one per run)."""
    return stage.withColumn(LOADED, F.lit(at))


# FIXED VALUES — dictionary variable of each decoded death-record column
DEATH_CODES = {
    "nombre_depto_registro": ("Depreg", "Departamento de registro"),
    "nombre_muni_registro": ("Mupreg", "Municipio de registro"),
    "nombre_depto_ocurrencia": ("Depocu", "Departamento de ocurrencia"),
    "nombre_muni_ocurrencia": ("Mupocu", "Municipio de ocurrencia"),
    "sexo": ("Sexo", "Sexo del difunto(a)"),
    "asistencia_medica": ("Asist", "Asistencia recibida"),
    "lugar_ocurrencia": ("Ocur", "Sitio de ocurrencia"),
    "pueblo_pertenencia": ("Puedif", "Pueblo de pertenencia del difunto(a)"),
}


def deaths_filter_rules():
    """T1 row rules, in order (also used by the discard report)."""
    return [("causa_no_nula", F.col("Caudef").isNotNull()),
            ("cie10_valido", R.icd_valid(F.col("Caudef")))]


def stage_deaths(raw: DataFrame, dictionary: DataFrame, icd_catalogue: DataFrame,
                 covid_start: int = 2020, covid_end: int = 2021, columns: list[str] | None = None) -> DataFrame:
    """Valid ICD rows, dictionary labels, age in years/bands, period, cause text.
    ``columns``: only these of the stage table; the planner does not drop a left join
    whose output is not read, so labels that are not asked for are not looked up."""
    df = raw
    for _, keep in deaths_filter_rules():
        df = df.where(keep)
    codes = {k: v for k, v in DEATH_CODES.items() if columns is None or k in columns}
    if codes:
        df = lookup.decode(df, lookup.normalised_dictionary(dictionary), codes)
    age = R.age_in_years(F.col("Edadif"), F.col("Perdif"))
    df = (df.withColumn("edad_anios", age)
          .withColumn("grupo_etario", R.age_group(F.col("edad_anios")))
          .withColumn("periodo", R.classify_period(F.col("Añoocu"), covid_start, covid_end))
          .withColumn("codigo_cie10", R.icd_upper(F.col("Caudef"))))
    if columns is None or "descripcion_causa" in columns:
        df = lookup.describe(df, icd_catalogue, "codigo_cie10", "descripcion_causa", C.CAUSE_MISS)
    df = (df.withColumn("anio_ocurrencia", F.col("Añoocu").cast("int"))
          .withColumn("mes_ocurrencia", F.col("Mesocu").cast("int"))
          .withColumn("fuente_origen", F.lit(C.STAGE_TAG_DEATHS)))
    return df.select(*(columns or [
        "l_orderkey", "l_linenumber", "anio_ocurrencia", "mes_ocurrencia",
        "nombre_depto_registro", "nombre_muni_registro", "nombre_depto_ocurrencia", "nombre_muni_ocurrencia",
        "pueblo_pertenencia", "sexo", "edad_anios", "grupo_etario", "codigo_cie10", "descripcion_causa",
        "asistencia_medica", "lugar_ocurrencia", "periodo", "fuente_origen"]), *([] if columns else _file(raw)))


def icd_catalogue(raw: DataFrame, code: str = "codigo_cie10", description: str = "descripcion",
                  position: str = "pos") -> DataFrame:
    """J2 catalogue: code (strip/upper) → description, last definition wins."""
    d = raw.select(R.icd_upper(F.col(code)).alias("codigo"), F.col(description).alias("descripcion"),
                   F.col(position).alias("pos"))
    return lookup.last_definition_wins(d, ["codigo"], "descripcion", "pos")


CASES_KEY = ["Año", "Departamento", "Municipio", "CIE-10", "Grupo Etario", "Sexo"]


def cases_filter_rules(years=(2012, 2024)):
    return [("cie10_no_nulo", R.not_blank(F.col("CIE-10"))),
            ("anio_no_nulo", F.col("Año").isNotNull()),
            ("casos_no_nulos", F.col("Casos").isNotNull()),
            ("anio_en_rango", R.to_double(F.col("Año")).between(*years))]


def stage_cases(raw: DataFrame, years=(2012, 2024), order=("l_orderkey", "l_linenumber"),
                covid_start: int = 2020, covid_end: int = 2021) -> DataFrame:
    """Critical NULLs and year range dropped, first of each duplicate kept, text rules."""
    df = raw
    for _, keep in cases_filter_rules(years):
        df = df.where(keep)
    df = dedup.keep_first(df, CASES_KEY, list(order)).withColumn("_codigo", R.icd_normalise(F.col("CIE-10")))
    code = F.col("_codigo")  # a column of its own: its rule is generated once, not at each mention
    return df.select(
        R.truncated_int(F.col("Año")).cast("int").alias("anio"),
        R.title_case(F.col("Departamento")).alias("departamento"),
        R.title_case(F.col("Municipio")).alias("municipio"),
        code.alias("codigo_cie10"),
        R.title_case(F.col("Diagnóstico")).alias("diagnostico"),
        R.icd_chapter_stage(code).alias("capitulo_cie10"),
        R.strip(F.col("Grupo Etario").cast("string")).alias("grupo_etario"),
        R.sex_normalise(F.col("Sexo")).alias("sexo"),
        R.truncated_int(F.col("Casos")).alias("casos"),
        R.classify_period(F.col("Año"), covid_start, covid_end).alias("periodo"),
        F.lit(C.STAGE_TAG_CASES).alias("fuente_origen"), *_file(raw))


def covid_local_rules(years=(2020, 2024)):
    fecha = F.to_date(F.col("fecha_fallecimiento"))
    return [("fecha_no_nula", F.col("fecha_fallecimiento").isNotNull()),
            ("fallecidos_no_nulos", F.col("fallecidos").isNotNull()),
            ("fallecidos_positivos", R.to_double(F.col("fallecidos")) > 0),
            ("anio_en_rango", F.year(fecha).between(*years))]


def stage_covid_local(raw: DataFrame, years=(2020, 2024), covid_end: int = 2021,
                      dedup_key=("municipio", "fecha_fallecimiento"), order=("pos",)) -> DataFrame:
    """Positive counts in range, first of each (place, date) kept, rate per 100k."""
    df = raw.withColumn("fecha_fallecimiento", F.to_date(F.col("fecha_fallecimiento")))
    for _, keep in covid_local_rules(years):
        df = df.where(keep)
    rest = [c for c in df.columns if c not in dedup_key and c not in order]
    df = dedup.keep_first(df, list(dedup_key), [*order, *rest])
    fall = R.truncated_int(F.col("fallecidos"))
    pob = R.truncated_int(F.col("poblacion"))
    return df.select(
        "fecha_fallecimiento",
        F.year("fecha_fallecimiento").cast("int").alias("anio"),
        F.month("fecha_fallecimiento").cast("int").alias("mes"),
        R.title_case(F.col("departamento")).alias("departamento"),
        R.truncated_int(F.col("codigo_departamento")).alias("codigo_departamento"),
        R.title_case(F.col("municipio")).alias("municipio"),
        R.truncated_int(F.col("codigo_municipio")).alias("codigo_municipio"),
        pob.alias("poblacion"),
        fall.alias("fallecidos"),
        R.rate_per_100k(fall, pob).alias("tasa_por_100k"),
        R.classify_period_covid(F.year("fecha_fallecimiento"), covid_end).alias("periodo"),
        F.lit(C.STAGE_TAG_COVID_LOCAL).alias("fuente_origen"), *_file(raw))


def homologate_regional(panama: DataFrame, costa_rica: DataFrame) -> DataFrame:
    """P16/U2 (L5): two layouts → one 12-column layout with typed structural NULLs."""
    pa = panama.select(
        F.lit(C.REGIONAL_SOURCES[0][0]).alias("pais"), "anio", "defunciones_general",
        "defunciones_infantil_menores_de_un_anio", "defunciones_menores_de_5_anios",
        "defunciones_materna", "defunciones_de_mujeres_en_edad_fertil",
        F.lit(None).cast("bigint").alias("poblacion_total"),
        F.lit(None).cast("double").alias("tasa_bruta_mortalidad_por_mil"),
        F.lit(dict(C.REGIONAL_SOURCES)["Panama"]).alias("fuente_origen"))
    cr = costa_rica.select(
        F.lit(C.REGIONAL_SOURCES[1][0]).alias("pais"), "anio", F.col("defunciones").alias("defunciones_general"),
        F.lit(None).cast("bigint").alias("defunciones_infantil_menores_de_un_anio"),
        F.lit(None).cast("bigint").alias("defunciones_menores_de_5_anios"),
        F.lit(None).cast("bigint").alias("defunciones_materna"),
        F.lit(None).cast("bigint").alias("defunciones_de_mujeres_en_edad_fertil"),
        F.col("poblacion_total_al_30_de_junio").alias("poblacion_total"),
        F.col("tasa_bruta_de_mortalidad_por_mil_habitantes").alias("tasa_bruta_mortalidad_por_mil"),
        F.lit(dict(C.REGIONAL_SOURCES)["Costa Rica"]).alias("fuente_origen"))
    return pa.unionByName(cr)


def _selected_iso3() -> list[str]:
    return [r[1] for r in C.SELECTED_COUNTRIES]


def stage_mortality_world(world: DataFrame, regional: DataFrame, min_year: int = 2015,
                          covid_start: int = 2020, covid_end: int = 2021) -> DataFrame:
    """T4: selected countries from the world series ∪ the regional annual rows."""
    region_by_iso3 = R.literal_map([(r[1], r[3]) for r in C.SELECTED_COUNTRIES])
    mes, semana = R.split_time_unit(F.col("time"), F.col("time_unit"))
    wm = (world.where(F.col("iso3c").isin(_selected_iso3()) & (F.col("year") >= min_year))
          .select("iso3c", "country_name",
                  F.element_at(region_by_iso3, F.col("iso3c")).alias("region"),
                  F.col("year").cast("int").alias("anio"), mes.alias("mes"), semana.alias("semana"),
                  F.col("deaths").cast("double").alias("deaths"), "time_unit",
                  R.classify_period(F.col("year"), covid_start, covid_end).alias("periodo"),
                  F.lit(C.STAGE_TAG_WORLD).alias("fuente"), *_file(world)))
    iso = F.element_at(R.literal_map(C.REGIONAL_NAME_TO_ISO3), F.col("pais"))
    ca = (regional.withColumn("iso3c", iso)
          .where(F.col("iso3c").isNotNull() & (F.col("anio") >= min_year)
                 & F.col("defunciones_general").isNotNull())
          .select("iso3c", F.col("pais").alias("country_name"), F.lit(C.REGIONAL_REGION).alias("region"),
                  F.col("anio").cast("int").alias("anio"),
                  F.lit(None).cast("int").alias("mes"), F.lit(None).cast("int").alias("semana"),
                  F.col("defunciones_general").cast("double").alias("deaths"),
                  F.lit("annual").alias("time_unit"),
                  R.classify_period(F.col("anio"), covid_start, covid_end).alias("periodo"),
                  F.col("fuente_origen").alias("fuente"), *_file(regional)))
    return wm.unionByName(ca, allowMissingColumns=True)


def stage_covid_world(weekly: DataFrame, covid_start: int = 2020, covid_end: int = 2021) -> DataFrame:
    """T5: valid dates, selected countries, weekly → monthly, readable regions, period."""
    selected = [r[0] for r in C.SELECTED_COUNTRIES]
    region_by_iso2 = R.literal_map([(r[0], r[3]) for r in C.SELECTED_COUNTRIES])
    df = (weekly.withColumn("Date_reported", F.to_date(F.col("Date_reported").cast("string")))
          .where(F.col("Date_reported").isNotNull() & F.col("Country_code").isin(selected)))
    for c in ["New_cases", "Cumulative_cases", "New_deaths", "Cumulative_deaths"]:
        df = df.withColumn(c, R.to_double(F.col(c)))
    m = reshape.weekly_to_monthly(df, ["Country_code", "Country", "WHO_region"], "Date_reported",
                                  flows=["New_cases", "New_deaths"],
                                  stocks=["Cumulative_cases", "Cumulative_deaths"])
    return m.select(
        "anio", "mes",
        F.col("Country_code").alias("country_code"), F.col("Country").alias("country_name"),
        F.col("WHO_region").alias("who_region"),
        R.who_region_name(F.col("WHO_region")).alias("who_region_desc"),
        F.element_at(region_by_iso2, F.col("Country_code")).alias("region"),
        F.col("New_cases_mes").alias("new_cases_mes"), F.col("New_deaths_mes").alias("new_deaths_mes"),
        F.col("Cumulative_cases_fin").alias("cum_cases_fin"),
        F.col("Cumulative_deaths_fin").alias("cum_deaths_fin"),
        "semanas_reporte",
        R.classify_period(F.col("anio"), covid_start, covid_end).alias("periodo"),
        F.lit(C.STAGE_TAG_COVID_WORLD).alias("fuente_origen"))


def overlap_entities(world: DataFrame, regional: DataFrame, key: str = "iso3c") -> DataFrame:
    """Keys present in both sources (both are kept in stage)."""
    return world.select(key).intersect(regional.select(key))
