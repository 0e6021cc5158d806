"""The sandbox of the warehouse: one landing job per source over a folder of files.

``jobs(folder)`` is the registry (K5): every job reads the files below
``<folder>/<source>``, whatever their drift, and lands a verified table with
provenance (P6) under the source's name; delimited sources also land what they reject
as ``<source>_rechazos``. ``write_sources`` lays such a folder down from the driver
tables: yearly files of which some carry another column, a web page in place of a file,
sheets with merged cells, a column per day, JSON beside CSV, two countries' layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals import adapter as A
from vitals import catalogues as C
from vitals.sources import files, landing, layers


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType()}


def _layout(columns: str, **how) -> landing.Layout:
    """A layout from "name type, …" (types of one word)."""
    fields = [c.strip().rsplit(" ", 1) for c in columns.split(",")]
    return landing.Layout(T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields]), **how)


# FIXED VALUES: columns of the sources
DEATHS = _layout("l_orderkey bigint, l_linenumber int, Depreg string, Mupreg string, Depocu string, Mupocu string, Sexo string, "
                 "Asist string, Ocur string, Puedif string, Añoocu int, Mesocu int, Edadif double, Perdif int, Caudef string")
CASES = _layout("l_orderkey bigint, l_linenumber int, Año int, Departamento string, Municipio string, CIE-10 string, "
                "Diagnóstico string, Grupo Etario string, Sexo string, Casos bigint", sep=";")
COVID_PLACE = ["departamento", "codigo_departamento", "municipio", "codigo_municipio", "poblacion", "pos"]
WORLD = _layout("iso3c string, country_name string, year int, time int, time_unit string, deaths double")
PANAMA = _layout("anio int, defunciones_general bigint, defunciones_infantil_menores_de_un_anio bigint, "
                 "defunciones_menores_de_5_anios bigint, defunciones_materna bigint, defunciones_de_mujeres_en_edad_fertil bigint",
                 name="Panama")
COSTA_RICA = _layout("anio int, poblacion_total_al_30_de_junio bigint, defunciones bigint, "
                     "tasa_bruta_de_mortalidad_por_mil_habitantes double", name="Costa Rica")
REGIONAL_NAMES = {"Costa Rica": {"defunciones": "defunciones_general", "poblacion_total_al_30_de_junio": "poblacion_total",
                                 "tasa_bruta_de_mortalidad_por_mil_habitantes": "tasa_bruta_mortalidad_por_mil"}}
COVID_WORLD = _layout("Date_reported date, Country_code string, Country string, WHO_region string, New_cases bigint, "
                      "Cumulative_cases bigint, New_deaths bigint, Cumulative_deaths bigint", strict=True, strip=True)


def jobs(folder: str) -> layers.Registry:
    """The landing jobs of the eight sandbox tables over ``<folder>/<table>``."""
    def delimited(layout):
        def job(spark, root, name):
            return landing.land_files(landing.read_files(spark, f"{folder}/{name}", layout), name, root)
        return job

    def dictionary(spark, root, name):
        return landing.land_dictionary(spark, f"{folder}/{name}", root, name)

    def causes(spark, root, name):
        return landing.land_cause_sheet(spark, f"{folder}/{name}", root, name)

    def covid_local(spark, root, name):
        return landing.land_wide(spark, f"{folder}/{name}", len(COVID_PLACE), COVID_PLACE, name, root, "fallecidos", "fecha_fallecimiento")

    def world(spark, root, name):
        rows, _ = landing.read_json_folder(spark, f"{folder}/{name}", WORLD)
        return landing.land(rows, name, root)

    def regional(spark, root, name):
        landed = landing.read_files(spark, f"{folder}/{name}", [PANAMA, COSTA_RICA], least=0.3)
        tags = F.create_map(*[F.lit(x) for pair in C.REGIONAL_SOURCES for x in pair])
        rows = landing.homologated(landed, REGIONAL_NAMES).withColumn(landing.ORIGIN, tags[F.col("pais")])
        return landing.land(rows, name, root)

    return layers.Registry([layers.Source(name, job=job) for name, job in {
        "sandbox_ine": delimited(DEATHS), "sandbox_ine_diccionario": dictionary, "sandbox_ine_cie10": causes,
        "sandbox_mspas_mec": delimited(CASES), "sandbox_mspas_covid": covid_local, "sandbox_world_mortality": world,
        "sandbox_centroamerica": regional, "sandbox_covid_mundial": delimited(COVID_WORLD)}.items()])


def _years(df: DataFrame, year: str, path: str, sep: str = ",") -> None:
    """One folder of files per year."""
    out = df.withColumn("_anio", F.col(year))
    (out.repartition("_anio").write.mode("append").partitionBy("_anio").option("header", True).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _quoted(column: str):
    return F.concat(F.lit('"'), F.replace(F.col(column), F.lit('"'), F.lit('""')), F.lit('"'))


#: rows of a sheet's file
SHEET_ROWS = 50_000


def write_sources(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The files of all sources, from the driver tables."""
    deaths = A.deaths_raw(spark, sf_dir)
    _years(deaths.where("`Añoocu` % 2 = 0"), "Añoocu", f"{folder}/sandbox_ine")
    _years(deaths.where("`Añoocu` % 2 = 1").withColumn("Cantidad", F.lit(1)), "Añoocu", f"{folder}/sandbox_ine")
    A.read(spark, sf_dir, "pages").select(F.col("html").alias("value")).write.text(f"{folder}/sandbox_ine/pagina")

    d = A.ine_dictionary(spark, sf_dir)
    first = d.groupBy("variable").agg(F.min("pos").alias("_first"))  # the cell that a merged one shows
    d = d.join(first, "variable").select("pos", F.lit(0).alias("hoja"), F.concat_ws(
        ",", F.when(F.col("pos") == F.col("_first"), F.col("variable")).otherwise(""), "codigo", _quoted("etiqueta")).alias("value"))
    files.write_text_files(d, "hoja", "Diccionario,,\nvariable,codigo,etiqueta", f"{folder}/sandbox_ine_diccionario", "pos")
    icd = A.icd_catalogue_raw(spark, sf_dir).select(
        "pos", F.format_string("%09d", F.floor(F.col("pos") / SHEET_ROWS)).alias("hoja"), F.concat_ws(",", "codigo_cie10", _quoted("descripcion")).alias("value"))
    files.write_text_files(icd, "hoja", "CIE-10,\ncodigo,descripcion", f"{folder}/sandbox_ine_cie10", "pos")

    _years(A.cases_raw(spark, sf_dir), "Año", f"{folder}/sandbox_mspas_mec", ";")

    long = A.covid_local_long(spark, sf_dir).withColumn("dia", F.to_date("fecha_fallecimiento").cast("string"))
    days = [r["dia"] for r in long.select("dia").distinct().orderBy("dia").collect()]  # a calendar
    wide = long.groupBy(*COVID_PLACE).agg(F.map_from_entries(F.collect_list(F.struct("dia", "fallecidos"))).alias("m"))  # at most one entry a day
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in COVID_PLACE], F.array_join(F.transform(
        F.split(F.lit(",".join(days)), ","), lambda x: F.coalesce(F.col("m")[x].cast("string"), F.lit(""))), ","))
    files.write_text_files(wide.select(F.col("codigo_departamento").alias("hoja"), line.alias("value")), "hoja",
                           ",".join([*COVID_PLACE, *days]), f"{folder}/sandbox_mspas_covid")

    w = A.world_mortality(spark, sf_dir)
    w.where("time_unit = 'weekly'").write.json(f"{folder}/sandbox_world_mortality")
    w.where("time_unit <> 'weekly'").write.mode("append").option("header", True).csv(f"{folder}/sandbox_world_mortality")
    A.regional_panama(spark, sf_dir).write.option("header", True).csv(f"{folder}/sandbox_centroamerica/x")
    A.regional_costa_rica(spark, sf_dir).write.option("header", True).csv(f"{folder}/sandbox_centroamerica/y")
    A.covid_world_weekly(spark, sf_dir).write.option("header", True).csv(f"{folder}/sandbox_covid_mundial")
