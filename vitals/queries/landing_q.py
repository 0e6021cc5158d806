"""Landing jobs over files with drift, each written and read back from the sandbox."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals import adapter as A
from vitals.queries import query
from vitals.session import scratch_path
from vitals.sources import files, landing

DEATHS = landing.Layout(T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType()),
    T.StructField("dia", T.DateType())]), drop=("Cantidad",))
CASES = landing.Layout(T.StructType([
    T.StructField("codigo", T.LongType()), T.StructField("nombre", T.StringType()),
    T.StructField("segmento", T.StringType())]), renames={"cod igo": "codigo", "Nombre": "nombre", "Segmento": "segmento"}, sep=";")
WORLD = landing.Layout(T.StructType([
    T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType())]))


def _stamped(df, *columns):
    """The columns with their source, and whether file and load time are there."""
    return df.select(*columns, landing.ORIGIN, (F.col(landing.FILE).isNotNull() & F.col(landing.LOADED).isNotNull()).alias("con_origen"))


@query("land_deaths_years")
def q_land_deaths_years(spark, d):
    """L1: yearly files, of which odd years lack a column, every third year carries an
    extra one, and one file is an HTML page."""
    root = scratch_path(spark, "deaths-years")
    o = A.read(spark, d, "orders").withColumn("dia", F.to_date("o_orderdate")).withColumn("anio", F.year("dia"))
    columns = [f.name for f in DEATHS.schema.fields]
    for kind in range(3):
        own = o.where(F.col("anio") % 3 == kind)
        for odd in range(2):
            part = own.where(F.col("anio") % 2 == odd)
            keep = [c for c in columns if not (odd and c == "o_orderpriority")]
            extra = [F.lit(1).alias("Cantidad")] if kind == 0 else []
            part.select(*keep, *extra, "anio").write.partitionBy("anio").option("header", True).csv(f"{root}/{kind}{odd}")
    A.read(spark, d, "pages").select(F.col("html").alias("value")).write.text(f"{root}/pagina")
    landed = landing.read_files(spark, root, DEATHS)
    if landed.foreign.isEmpty():
        raise AssertionError("the HTML payload should have been rejected")
    out, _ = landing.land(landed.good(), "INE", scratch_path(spark, "landed"))
    return _stamped(out, *columns)


@query("land_chronic_years")
def q_land_chronic_years(spark, d):
    """L2: semicolon files with a byte-order mark and header variants, blank text to NULL."""
    root = scratch_path(spark, "chronic-years")
    c = A.read(spark, d, "customer")
    text = F.when(F.col("c_custkey") % 7 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment"))
    variants = [("\ufeffcodigo", "nombre", "segmento"), ("cod igo", "Nombre", "Segmento"), ("codigo", "nombre", " segmento ")]
    for k, (code, name, segment) in enumerate(variants):
        (c.where(F.col("c_custkey") % 3 == k).select(F.col("c_custkey").alias(code), F.col("c_name").alias(name), text.alias(segment))
         .write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{k}"))
    out, _ = landing.land(landing.read_files(spark, root, CASES, glob="*.csv").good(), "MSPAS", scratch_path(spark, "landed"))
    return _stamped(out, "codigo", "nombre", "segmento")


@query("land_world_mortality")
def q_land_world_mortality(spark, d):
    """L4: JSON arrays, JSON lines and CSV of one folder."""
    root = scratch_path(spark, "world-mortality")
    n = A.read(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    files.write_json_arrays(n.where("n_nationkey % 3 = 0"), f"{root}/a")
    n.where("n_nationkey % 3 = 1").write.json(f"{root}/b")
    n.where("n_nationkey % 3 = 2").write.option("header", True).csv(f"{root}/c")
    rows = None
    for part in "abc":
        one, _ = landing.read_json_folder(spark, f"{root}/{part}", WORLD, ".txt" if part == "a" else ".json")
        rows = one if rows is None else rows.unionByName(one)
    out, _ = landing.land(rows, "WMD", scratch_path(spark, "landed"))
    return _stamped(out, "n_nationkey", "n_name", "n_regionkey")


COVID = landing.Layout(T.StructType([
    T.StructField("Date_reported", T.DateType()), T.StructField("Country_code", T.StringType()),
    T.StructField("Country", T.StringType()), T.StructField("WHO_region", T.StringType()),
    T.StructField("New_cases", T.LongType()), T.StructField("New_deaths", T.LongType())]),
    renames={"Fecha": "Date_reported", "Casos": "New_cases", "Muertes": "New_deaths"}, strict=True, strip=True)


def _covid_files(spark, d) -> str:
    """One line per order as a report of its day: files by order key, of which some have
    other column names and order, one name goes over two lines, some lines are cut
    short, hold text for a number, or are empty; and web pages in place of a file."""
    root = scratch_path(spark, "covid-files")
    o = A.read(spark, d, "orders").withColumn("dia", F.to_date("o_orderdate"))
    k = F.col("o_orderkey")
    code = F.concat(F.lit("C"), (F.col("o_custkey") % 30).cast("string"))
    name = (F.when(k % 29 == 0, F.concat(F.lit('"Norte\nSur '), code, F.lit('"')))
            .when(k % 31 == 0, F.concat(F.lit('"dijo ""'), code, F.lit('"", luego"'))).otherwise(F.concat(F.lit(" Pais "), code, F.lit(" "))))
    region = F.when(k % 11 == 0, F.lit("")).otherwise(F.col("o_orderstatus"))
    cases, deaths = (k % 500).cast("string"), F.when(k % 13 == 0, F.lit("")).otherwise((k % 7).cast("string"))
    day = F.col("dia").cast("string")
    plain = F.concat_ws(",", day, code, name, region, cases, deaths)
    line = (F.when(k % 37 == 0, F.concat_ws(",", day, code, name)).when(k % 41 == 0, F.concat_ws(",", day, code, name, region, F.lit("n/d"), deaths))
            .when(k % 43 == 0, F.lit(",,,,,")).otherwise(plain))
    other = F.concat_ws(",", code, cases, deaths, day, F.lit("nota"), name, region)
    files.write_text_files(o.where(k % 4 != 0).select((k % 4).alias("g"), line.alias("value"), k.alias("k")), "g",
                           "Date_reported,Country_code,Country,WHO_region,New_cases,New_deaths", f"{root}/a", "k")
    files.write_text_files(o.where(k % 4 == 0).select((k % 8).alias("g"), other.alias("value"), k.alias("k")), "g",
                           "Country_code, Casos ,Muertes,Fecha,Nota,Country,WHO_region", f"{root}/b", "k")
    A.read(spark, d, "pages").select(F.col("html").alias("value")).write.text(f"{root}/c")
    return root


@query("land_world_covid")
def q_land_world_covid(spark, d):
    """What is landed, over drifted, broken and foreign files."""
    landed = landing.read_files(spark, _covid_files(spark, d), COVID)
    out, _ = landing.land_files(landed, "OMS_COVID_MUNDIAL", scratch_path(spark, "landed"))
    return _stamped(out, *COVID.fields)


@query("land_world_covid_rejected")
def q_land_world_covid_rejected(spark, d):
    """What is rejected, by reason, with the records read; good and rejected rows are
    the rows read (else the load fails). Pages count as one, however many lines they have."""
    landed = landing.read_files(spark, _covid_files(spark, d), COVID)
    root = scratch_path(spark, "landed")
    landing.land_files(landed, "OMS_COVID_MUNDIAL", root)
    rejected = landing.layers.read_table(spark, root, "sandbox", "OMS_COVID_MUNDIAL_rechazos")
    html = F.col(landing.REASON) == "html"
    return (rejected.groupBy(landing.REASON)
            .agg(F.when(F.first(html), F.lit(1)).otherwise(F.count(F.lit(1))).cast("bigint").alias("filas"),
                 F.bool_and(F.col(landing.LINE) > 0).alias("con_linea"), F.first(landing.ORIGIN).alias(landing.ORIGIN)))


@query("land_dictionary")
def q_land_dictionary(spark, d):
    """Both sheets of the dictionary. Sheet one: parts of a brand under the merged
    cell of their brand, brands in order, a row of nothing before each; sheet two: codes in
    lower case with spaces."""
    root = scratch_path(spark, "dictionary")
    p = A.read(spark, d, "part").select("p_partkey", "p_name", "p_brand", F.substring("p_brand", 7, 1).alias("hoja"))
    label = F.concat(F.lit('"'), F.col("p_name"), F.lit(', x"'))
    first = p.groupBy("hoja", "p_brand").agg(F.min("p_partkey").alias("k"))
    rows = (p.join(first.select("p_brand", "k"), "p_brand").select(
        "hoja", F.struct("p_brand", F.lit(1).alias("t"), F.col("p_partkey").alias("k")).alias("orden"),
        F.concat(F.when(F.col("p_partkey") == F.col("k"), F.col("p_brand")).otherwise(""), F.lit(", "), F.col("p_partkey").cast("string"), F.lit(" ,"), label).alias("value")))
    blank = first.select("hoja", F.struct("p_brand", F.lit(0).alias("t"), "k").alias("orden"), F.lit(",,").alias("value"))
    files.write_text_files(rows.unionByName(blank), "hoja", "Diccionario,,\nvariable,codigo,etiqueta", f"{root}/defunciones", "orden")
    files.write_text_files(p.select("hoja", F.col("p_partkey").alias("orden"), F.concat(F.lit(" a"), F.col("p_partkey").cast("string"), F.lit(" ,"), label).alias("value")),
                           "hoja", "CIE-10,\ncodigo,descripcion", f"{root}/cie10", "orden")
    landed = scratch_path(spark, "landed")
    codes, _ = landing.land_dictionary(spark, f"{root}/defunciones", landed)
    causes, _ = landing.land_cause_sheet(spark, f"{root}/cie10", landed)
    return (_stamped(codes, "variable", "codigo", "etiqueta")
            .unionByName(_stamped(causes, F.lit(None).cast("string").alias("variable"), F.col("codigo_cie10").alias("codigo"), F.col("descripcion").alias("etiqueta"))))


@query("land_covid_local")
def q_land_covid_local(spark, d):
    """L3: wide files (a column per month) with places whose names hold commas and line
    ends, one file with fewer months."""
    root = scratch_path(spark, "covid-local")
    months = [f"{y}-{m:02d}-01" for y in range(1992, 1999) for m in range(1, 13)]
    l = A.read(spark, d, "lineitem").select("l_suppkey", F.date_trunc("month", "l_shipdate").cast("date").cast("string").alias("mes"))
    cells = (l.groupBy("l_suppkey", "mes").agg(F.count(F.lit(1)).alias("n")).groupBy("l_suppkey")
             .agg(F.map_from_entries(F.collect_list(F.struct("mes", "n"))).alias("m")))  # at most one entry a month
    k = F.col("l_suppkey")
    name = F.when(k % 5 == 0, F.concat(F.lit('"Lugar\n'), k.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit('"Lugar, '), k.cast("string"), F.lit('"')))
    for part, some in (("a", months), ("b", months[:40])):
        own = cells.where((k % 7 == 0) if part == "b" else (k % 7 != 0))
        line = F.concat_ws(",", k.cast("string"), name, F.array_join(F.transform(
            F.split(F.lit(",".join(some)), ","), lambda x: F.coalesce(F.col("m")[x].cast("string"), F.lit(""))), ","))
        files.write_text_files(own.select((k % 3).alias("g"), line.alias("value"), k.alias("k")), "g", ",".join(["codigo", "lugar", *some]), f"{root}/{part}", "k")
    out, _ = landing.land_wide(spark, root, 2, ["codigo", "lugar"], "MSPAS_COVID", scratch_path(spark, "landed"), "fallecidos", "fecha_fallecimiento")
    return _stamped(out, F.col("codigo").cast("bigint").alias("codigo"), "lugar", "fecha_fallecimiento", "fallecidos")


PANAMA = landing.Layout(T.StructType([
    T.StructField("anio", T.IntegerType()), T.StructField("cliente", T.LongType()), T.StructField("defunciones_general", T.LongType()),
    T.StructField("defunciones_materna", T.LongType())]), name="Panama")
COSTA_RICA = landing.Layout(T.StructType([
    T.StructField("anio", T.IntegerType()), T.StructField("cliente", T.LongType()), T.StructField("defunciones", T.LongType()),
    T.StructField("poblacion_total", T.LongType())]), renames={"poblacion_total_al_30_de_junio": "poblacion_total", "año": "anio"}, name="Costa Rica")


@query("land_regional")
def q_land_regional(spark, d):
    """Files of two countries told apart by their headers, one of them drifted, and a
    file that is none of them; one layout with typed structural NULLs."""
    root = scratch_path(spark, "regional")
    o = A.read(spark, d, "orders").groupBy("o_orderstatus", F.year("o_orderdate").cast("int").alias("anio"), F.col("o_custkey").alias("cliente")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"))
    o.where("o_orderstatus = 'F'").select("anio", "cliente", F.col("n").alias("defunciones_general"), F.col("low").alias("defunciones_materna")).write.option("header", True).csv(f"{root}/x")
    (o.where("o_orderstatus = 'P'").select("cliente", F.lit("n").alias("nota"), F.col("n").alias("defunciones_general"), "anio")
     .write.option("header", True).csv(f"{root}/y"))  # drifted: no defunciones_materna
    o.where("o_orderstatus = 'O'").select(F.col("anio").alias("año"), "cliente", F.col("n").alias("defunciones"), F.col("low").alias("poblacion_total_al_30_de_junio")).write.option("header", True).csv(f"{root}/z")
    A.read(spark, d, "pages").select(F.col("html").alias("value")).write.text(f"{root}/w")
    landed = landing.read_files(spark, root, [PANAMA, COSTA_RICA], least=0.3)
    if landed.foreign.isEmpty():
        raise AssertionError("the HTML payload should have been rejected")
    out, _ = landing.land(landing.homologated(landed, {"Costa Rica": {"defunciones": "defunciones_general"}}), "CENTROAMERICA", scratch_path(spark, "landed"))
    return _stamped(out, "pais", "anio", "cliente", "defunciones_general", "defunciones_materna", "poblacion_total")
