"""Driver tables → domain records.

The driver ships TPC-H-like tables; the health warehouse needs death records,
case counts and country series. These views derive them with arithmetic only
(the same text runs in DuckDB for the oracle):

  deaths      lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region, one row per line
              anio/mes = year/month(o_orderdate), departamento = r_name,
              municipio = n_name, sexo = l_returnflag, edad = l_quantity,
              unidad = (l_linenumber-1)%4+1, causa = letter(partkey) || 2 digits(suppkey)

Join order is chosen for scale: customer is attached to orders first (orders
is ~1/4 of lineitem) and lineitem meets the result on the order key; only
integer keys travel through these two shuffles. Names come from nation ⋈
region (25 rows, size-checked broadcast) after the big joins or after the
aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.functions.rules import within_years
from vitals.operators.lookup import bounded
from vitals.session import table_path

# Period cut-points and baseline window of the driver data (1995-01 … 2001-08).
TEST_COVID_START, TEST_COVID_END = 1999, 2000
TEST_BASELINE_YEARS = (1995, 1998)
TEST_YEARS = (1995, 2001)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


SMALL_TABLE_ROWS = 100_000


def checked(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """``df`` as a broadcast side when its rows and bytes are proven small, else as is."""
    return bounded(df, max_rows)


def small(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A reference table (nation, region): broadcast only when its row count
    (answered from the Parquet footers) is within SMALL_TABLE_ROWS."""
    return checked(read(spark, sf_dir, name))


def geo_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: 25 rows in every scale factor (fixed by the schema)."""
    nation = small(spark, sf_dir, "nation")
    region = small(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("nationkey"),
                    F.col("r_regionkey").alias("regionkey"),
                    F.col("r_name").alias("departamento"),
                    F.col("n_name").alias("municipio")))


def order_nation(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """orders with their month and the customer's nation key (orders ⋈ customer);
    ``years`` limits the scan to a range of order dates.

    Only integer keys travel through this shuffle join; place names are
    attached later by ``with_geo`` (a broadcast join after the big joins or
    after aggregation), so shuffled rows stay narrow.
    """
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if years:
        orders = orders.where(within_years("o_orderdate", *years))
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .select("o_orderkey",
                    F.year("o_orderdate").cast("int").alias("anio"),
                    F.month("o_orderdate").cast("int").alias("mes"),
                    F.col("c_nationkey").alias("nationkey")))


def with_geo(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Attach regionkey, departamento, municipio by nation key (size-checked broadcast, inner)."""
    geo = checked(geo_catalogue(spark, sf_dir))
    return df.join(geo, "nationkey")


def cause_code(partkey, suppkey):
    letter = F.char((F.lit(65) + F.col(partkey) % 26).cast("int"))
    return F.concat(letter, F.lpad((F.col(suppkey) % 100).cast("string"), 2, "0"))


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per death record (row grain of the deaths microdata)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    on = order_nation(spark, sf_dir)
    return (with_geo(spark, sf_dir, li.join(on, li.l_orderkey == on.o_orderkey))
            .select("l_orderkey", "l_linenumber", "anio", "mes", "departamento", "municipio",
                    F.col("l_returnflag").alias("sexo"),
                    F.col("l_quantity").alias("edad"),
                    ((F.col("l_linenumber") - 1) % 4 + 1).cast("int").alias("unidad"),
                    cause_code("l_partkey", "l_suppkey").alias("causa"),
                    F.col("l_quantity").alias("casos")))


def monthly_death_counts(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Deaths counted per (departamento, municipio, anio, mes), of ``years`` or all.

    Aggregate-before-join: lineitem is reduced to one count per order key
    (map-side partial aggregation) before it meets orders, so the big join
    shuffles (key, count) pairs instead of line rows.
    """
    per_order = (read(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")))
    on = order_nation(spark, sf_dir, years)
    by_nation = (per_order.join(on, per_order.l_orderkey == on.o_orderkey)
                 .groupBy("nationkey", "anio", "mes").agg(F.sum("n").alias("n")))
    # names attached to the aggregated rows (nation × month), then rolled up by name
    return (with_geo(spark, sf_dir, by_nation)
            .groupBy("departamento", "municipio", "anio", "mes")
            .agg(F.sum("n").cast("bigint").alias("total_casos")))


# ----------------------------------------------------------------------------- countries
# Nation k stands for selected country number k + 10; nations past the end of
# the list stand for non-selected countries (codes "Z?" / "ZZ?").
COUNTRY_OFFSET = 10

# Test-fixture map: driver region name → WHO region code.
REGION_TO_WHO = [("AFRICA", "AFRO"), ("AMERICA", "AMRO"), ("ASIA", "SEARO"),
                 ("EUROPE", "EURO"), ("MIDDLE EAST", "EMRO")]


def nation_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vitals import catalogues as C
    from vitals.functions.rules import literal_map
    sel = spark.createDataFrame([(i, *row) for i, row in enumerate(C.SELECTED_COUNTRIES)],
                                "idx int, iso2 string, iso3 string, country string, region string")
    nation = small(spark, sf_dir, "nation")
    region = small(spark, sf_dir, "region")
    z = F.char((F.lit(65) + F.col("n_nationkey")).cast("int"))
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .join(F.broadcast(sel), nation.n_nationkey + COUNTRY_OFFSET == sel.idx, "left")
            .select(F.col("n_nationkey").alias("nationkey"),
                    F.coalesce("iso2", F.concat(F.lit("Z"), z)).alias("iso2"),
                    F.coalesce("iso3", F.concat(F.lit("ZZ"), z)).alias("iso3"),
                    F.coalesce("country", F.col("n_name")).alias("country"),
                    F.element_at(literal_map(REGION_TO_WHO), F.col("r_name")).alias("who_region"),
                    F.col("r_name").alias("r_name")))


def order_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                  "o_orderstatus", "o_orderpriority")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nc = checked(nation_countries(spark, sf_dir))
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nc, F.col("c_nationkey") == nc.nationkey)
            .drop("c_custkey"))


def world_mortality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sandbox_world_mortality: iso3c, country_name, year, time, time_unit, deaths."""
    oc = order_countries(spark, sf_dir)
    weekly = F.col("nationkey") % 3 == 0
    return (oc.select(F.col("iso3").alias("iso3c"), F.col("country").alias("country_name"),
                      F.year("o_orderdate").cast("int").alias("year"),
                      F.when(weekly, F.weekofyear("o_orderdate")).otherwise(F.month("o_orderdate"))
                      .cast("int").alias("time"),
                      F.when(weekly, F.lit("weekly")).otherwise(F.lit("monthly")).alias("time_unit"))
            .groupBy("iso3c", "country_name", "year", "time", "time_unit")
            .agg(F.count(F.lit(1)).cast("double").alias("deaths")))


def regional_panama(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panama-layout annual table from finished and partly finished orders."""
    o = read(spark, sf_dir, "orders").where(~F.col("o_orderstatus").eqNullSafe("O"))
    return (o.groupBy(F.year("o_orderdate").cast("int").alias("anio"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("defunciones_general"),
                 F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("bigint")
                 .alias("defunciones_infantil_menores_de_un_anio"),
                 F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).cast("bigint")
                 .alias("defunciones_menores_de_5_anios"),
                 F.count_if(F.col("o_orderpriority") == "5-LOW").cast("bigint").alias("defunciones_materna"),
                 F.count_if(F.col("o_orderpriority") == "3-MEDIUM").cast("bigint")
                 .alias("defunciones_de_mujeres_en_edad_fertil")))


def regional_costa_rica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costa-Rica-layout annual table from open orders."""
    o = read(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    return (o.groupBy(F.year("o_orderdate").cast("int").alias("anio"))
            .agg(F.countDistinct("o_custkey").cast("bigint").alias("poblacion_total_al_30_de_junio"),
                 F.count(F.lit(1)).cast("bigint").alias("defunciones"))
            .withColumn("tasa_bruta_de_mortalidad_por_mil_habitantes",
                        F.round(F.col("defunciones") * 1000.0 / F.col("poblacion_total_al_30_de_junio"), 4)))


def covid_world_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sandbox_covid_mundial: one row per country-week with new and cumulative counts.

    The running totals are windows per country over its weeks (rows already
    aggregated to country × week, so a partition holds one country's weeks).
    """
    from pyspark.sql import Window
    oc = order_countries(spark, sf_dir)
    wk = (oc.groupBy(F.col("iso2").alias("Country_code"), F.col("country").alias("Country"),
                     F.col("who_region").alias("WHO_region"),
                     F.to_date(F.date_trunc("week", "o_orderdate")).alias("Date_reported"))
          .agg(F.count(F.lit(1)).cast("bigint").alias("New_cases"),
               F.count_if(F.col("o_orderstatus") == "F").cast("bigint").alias("New_deaths")))
    w = Window.partitionBy("Country_code").orderBy("Date_reported").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.weekofyear("Date_reported") % 6 == 0
    return (wk.withColumn("Cumulative_cases", F.sum("New_cases").over(w).cast("bigint"))
            .withColumn("Cumulative_deaths",
                        F.when(gap, F.lit(None).cast("bigint")).otherwise(F.sum("New_deaths").over(w).cast("bigint")))
            .select("Date_reported", "Country_code", "Country", "WHO_region", "New_cases",
                    "Cumulative_cases", "New_deaths", "Cumulative_deaths"))


def covid_local_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sandbox_mspas_covid (long): deaths per place and date, raw text, with repeats.

    ``pos`` is the row order of the landed file (tie-break for keep-first).
    """
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = small(spark, sf_dir, "nation").join(
        small(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pop = customer.groupBy(F.col("c_nationkey").alias("pk")).agg(
        (F.count(F.lit(1)) * 1000).cast("bigint").alias("poblacion"))
    g = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .groupBy("c_nationkey", "o_orderdate", "o_orderstatus")
         .agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    return (g.join(geo, g.c_nationkey == geo.n_nationkey)
            .join(pop, g.c_nationkey == pop.pk)  # shuffle join; AQE splits a hot nation
            .select(F.upper(F.col("r_name")).alias("departamento"),
                    F.col("r_regionkey").cast("bigint").alias("codigo_departamento"),
                    F.when(F.col("o_orderstatus") == "F", F.concat(F.lower("n_name"), F.lit(" ")))
                    .otherwise(F.lower("n_name")).alias("municipio"),
                    F.col("n_nationkey").cast("bigint").alias("codigo_municipio"),
                    "poblacion",
                    F.col("o_orderdate").alias("fecha_fallecimiento"),
                    F.when(F.col("o_orderstatus") == "P", F.col("n") - 1).otherwise(F.col("n"))
                    .cast("bigint").alias("fallecidos"),
                    F.col("o_orderstatus").alias("pos")))


def cases_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sandbox_mspas_mec: chronic cases with the raw text noise of the source."""
    dd = deaths(spark, sf_dir)
    ln = F.col("l_linenumber")
    q = F.col("edad").cast("int").cast("string")
    cie = (F.when(ln == 7, F.lit(None).cast("string"))
           .when(ln % 4 == 0, F.lower("causa"))
           .when(ln % 4 == 1, F.concat(F.lit(" "), F.col("causa"), F.lit(" ")))
           .when(ln % 4 == 2, F.concat(F.substring("causa", 1, 2), F.lit(":"), F.substring("causa", 3, 2)))
           .otherwise(F.col("causa")))
    grupo = (F.when(ln % 4 == 0, F.lit("< 1 año"))
             .when(ln % 4 == 1, F.concat(q, F.lit(" a "), (F.col("edad").cast("int") + 4).cast("string"), F.lit(" años")))
             .when(ln % 4 == 2, F.concat(q, F.lit("+")))
             .otherwise(F.lit("sin dato")))
    sexo = (F.when(F.col("sexo") == "A", F.lit(" f ")).when(F.col("sexo") == "R", F.lit("M"))
            .otherwise(F.lit("X")))
    return dd.select(
        "l_orderkey", "l_linenumber",
        F.col("anio").alias("Año"),
        F.when(ln % 2 == 0, F.concat(F.upper("departamento"), F.lit(" "))).otherwise(F.lower("departamento"))
        .alias("Departamento"),
        F.lower("municipio").alias("Municipio"),
        cie.alias("CIE-10"),
        F.concat(F.lit("diagnostico "), F.lower("causa")).alias("Diagnóstico"),
        grupo.alias("Grupo Etario"),
        sexo.alias("Sexo"),
        F.col("edad").cast("bigint").alias("Casos"))


# ----------------------------------------------------------------------------- coded deaths
def deaths_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sandbox_ine: coded death records (codes decoded by the dictionary in stage)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    on = order_nation(spark, sf_dir)
    ln = F.col("l_linenumber")
    causa = cause_code("l_partkey", "l_suppkey")
    return (with_geo(spark, sf_dir, li.join(on, li.l_orderkey == on.o_orderkey))
            .select("l_orderkey", "l_linenumber",
                    ((F.col("regionkey") + 1) % 5).cast("string").alias("Depreg"),
                    ((F.col("nationkey") + 3) % 25).cast("string").alias("Mupreg"),
                    F.col("regionkey").cast("string").alias("Depocu"),
                    F.when(ln == 6, F.lit(None)).when(ln == 5, F.col("nationkey") + 30)
                    .otherwise(F.col("nationkey")).cast("string").alias("Mupocu"),
                    F.when(F.col("l_returnflag") == "A", F.lit("1"))
                    .when(F.col("l_returnflag") == "R", F.lit("2")).otherwise(F.lit("9")).alias("Sexo"),
                    F.when(F.col("l_linestatus") == "O", F.lit("1")).otherwise(F.lit("2")).alias("Asist"),
                    (ln % 3 + 1).cast("string").alias("Ocur"),
                    (F.col("l_partkey") % 5).cast("string").alias("Puedif"),
                    F.col("anio").alias("Añoocu"), F.col("mes").alias("Mesocu"),
                    F.col("l_quantity").alias("Edadif"),
                    ((ln - 1) % 4 + 1).cast("int").alias("Perdif"),
                    F.when(ln == 7, F.concat(F.lit("9"), causa))
                    .when(ln == 3, F.concat(F.lit(" "), F.lower(causa)))
                    .otherwise(causa).alias("Caudef")))


def ine_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variable/code/label dictionary from region and nation (pos = row order).

    Nations with key % 5 = 0 are defined twice; the later definition wins.
    """
    region = small(spark, sf_dir, "region")
    nation = small(spark, sf_dir, "nation")
    dep = region.select(F.lit("Departamento de ocurrencia").alias("variable"),
                        F.concat(F.col("r_regionkey").cast("string"), F.lit(".0")).alias("codigo"),
                        F.col("r_name").alias("etiqueta"), F.col("r_regionkey").cast("bigint").alias("pos"))
    mun = nation.select(F.lit("Municipio de ocurrencia").alias("variable"),
                        F.col("n_nationkey").cast("string").alias("codigo"),
                        F.col("n_name").alias("etiqueta"), (F.col("n_nationkey") + 100).cast("bigint").alias("pos"))
    redo = nation.where(F.col("n_nationkey") % 5 == 0).select(
        F.lit("Municipio de ocurrencia").alias("variable"),
        F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("codigo"),
        F.lower("n_name").alias("etiqueta"), (F.col("n_nationkey") + 200).cast("bigint").alias("pos"))
    sex = region.where(F.col("r_regionkey") < 2).select(
        F.lit("Sexo del difunto(a)").alias("variable"),
        (F.col("r_regionkey") + 1).cast("string").alias("codigo"),
        F.when(F.col("r_regionkey") == 0, F.lit("Hombre")).otherwise(F.lit("Mujer")).alias("etiqueta"),
        (F.col("r_regionkey") + 300).cast("bigint").alias("pos"))
    dreg = region.select(F.lit("Departamento de registro").alias("variable"),
                         F.col("r_regionkey").cast("string").alias("codigo"), F.col("r_name").alias("etiqueta"),
                         (F.col("r_regionkey") + 400).cast("bigint").alias("pos"))
    mreg = nation.select(F.lit("Municipio de registro").alias("variable"),
                         F.col("n_nationkey").cast("string").alias("codigo"), F.col("n_name").alias("etiqueta"),
                         (F.col("n_nationkey") + 500).cast("bigint").alias("pos"))
    asist = region.where(F.col("r_regionkey") < 2).select(
        F.lit("Asistencia recibida").alias("variable"), (F.col("r_regionkey") + 1).cast("string").alias("codigo"),
        F.when(F.col("r_regionkey") == 0, F.lit("Con asistencia")).otherwise(F.lit("Sin asistencia")).alias("etiqueta"),
        (F.col("r_regionkey") + 600).cast("bigint").alias("pos"))
    sitio = region.where(F.col("r_regionkey") < 3).select(
        F.lit("Sitio de ocurrencia").alias("variable"), (F.col("r_regionkey") + 1).cast("string").alias("codigo"),
        F.concat(F.lit("Sitio "), F.col("r_name")).alias("etiqueta"), (F.col("r_regionkey") + 700).cast("bigint").alias("pos"))
    pueblo = region.where(F.col("r_regionkey") < 4).select(
        F.lit("Pueblo de pertenencia del difunto(a)").alias("variable"), F.col("r_regionkey").cast("string").alias("codigo"),
        F.concat(F.lit("Pueblo "), F.lower("r_name")).alias("etiqueta"), (F.col("r_regionkey") + 800).cast("bigint").alias("pos"))
    return (dep.unionByName(mun).unionByName(redo).unionByName(sex).unionByName(dreg).unionByName(mreg)
            .unionByName(asist).unionByName(sitio).unionByName(pueblo))


def icd_catalogue_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICD catalogue sheet from part: code (with case noise), description, row order."""
    p = read(spark, sf_dir, "part")
    code = cause_code("p_partkey", "p_partkey")
    return p.select(F.when(F.col("p_partkey") % 3 == 0, F.lower(code)).otherwise(code).alias("codigo_cie10"),
                    F.col("p_name").alias("descripcion"), F.col("p_partkey").alias("pos"))
