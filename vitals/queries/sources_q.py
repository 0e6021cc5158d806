"""Source and sink queries: driver tables round-tripped through each landing format.

Each query writes the table(s) it needs into a fresh folder below the shared
root, then returns the lazy read of the landing operator under test.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals import adapter as A
from vitals.sources import files, layers
from vitals.queries import query
from vitals.session import scratch_path

ORDERS_CSV = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType())])
NATION = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                       T.StructField("n_regionkey", T.IntegerType())])
SUPPLIER = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                         T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())])

#: lines of one wide file, some 5 kB each
WIDE_FILE_ROWS = 20_000


@query("scan_csv_typed")
def q_scan_csv_typed(spark, d):
    path = scratch_path(spark, "csv-typed")
    (A.read(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
     .write.option("header", True).csv(path))
    return files.read_csv_typed(spark, path, ORDERS_CSV)


@query("scan_csv_semicolon")
def q_scan_csv_semicolon(spark, d):
    path = scratch_path(spark, "csv-semicolon")
    k = F.col("c_custkey")
    seg = (F.when(k % 9 == 0, F.lit(None).cast("string")).when(k % 11 == 0, F.lit("no especificada"))
           .otherwise(F.col("c_mktsegment")))
    (A.read(spark, d, "customer").withColumn("c_mktsegment", seg)
     .write.option("header", True).option("sep", ";").csv(path))
    raw = files.read_csv_text(spark, path, sep=";")
    return raw.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                      F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                      F.col("c_acctbal").try_cast("double").alias("c_acctbal"), "c_mktsegment")


@query("scan_json_array")
def q_scan_json_array(spark, d):
    path = scratch_path(spark, "json-array")
    files.write_json_arrays(A.read(spark, d, "customer"), path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()),
                           T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType())])
    return files.read_json_array(spark, path, schema)


@query("scan_mixed_formats")
def q_scan_mixed_formats(spark, d):
    folder = scratch_path(spark, "mixed")
    o = A.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    o.where(F.col("o_orderkey") % 2 == 0).write.mode("append").json(folder)
    o.where(F.col("o_orderkey") % 2 == 1).write.mode("append").option("header", True).csv(folder)
    o.select(F.col("o_orderpriority").alias("value")).write.mode("append").text(folder)  # rejected (.txt)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_orderpriority", T.StringType())])
    out, rejected = files.read_mixed(spark, folder, schema)
    if not rejected:
        raise AssertionError("the unsupported .txt part should have been rejected")
    return out


@query("scan_parquet_parts")
def q_scan_parquet_parts(spark, d):
    folder = scratch_path(spark, "parts")
    A.read(spark, d, "orders").repartition(6).write.parquet(folder)
    parts = [p for p in files.data_files(spark, folder) if p.endswith(".parquet")]
    return files.read_parquet_parts(spark, parts)


@query("read_layer_table")
def q_read_layer_table(spark, d):
    root = scratch_path(spark, "layers")
    layers.write_replace(A.read(spark, d, "supplier"), root, "sandbox", "supplier")
    return layers.read_table(spark, root, "sandbox", "supplier")


@query("land_multi_file")
def q_land_multi_file(spark, d):
    folder = scratch_path(spark, "multi")
    A.read(spark, d, "customer").write.partitionBy("c_mktsegment").option("header", True).csv(folder)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_mktsegment", T.StringType())])
    df = spark.read.schema(schema).option("header", True).csv(folder)
    return files.with_file_name(df, "archivo_origen", level="folder")


@query("land_tolerant")
def q_land_tolerant(spark, d):
    root = scratch_path(spark, "tolerant")
    s = A.read(spark, d, "supplier")
    for g in range(3):
        s.where(F.col("s_nationkey") % 3 == g).write.option("header", True).csv(f"{root}/grupo{g}")
    A.read(spark, d, "pages").select(F.col("html").alias("value")).write.text(f"{root}/pagina")  # not data
    good, bad = files.read_tolerant(spark, root, [f.name for f in SUPPLIER.fields], SUPPLIER)
    if not bad:
        raise AssertionError("the HTML payload should have been rejected")
    return good


def _registry(d):
    def customers(spark):
        return A.read(spark, d, "customer")

    def nations(spark):
        return A.read(spark, d, "nation")

    def missing(spark):
        return spark.read.parquet(f"{d}/no_such_table.parquet")

    return layers.Registry([layers.Source("customer", customers), layers.Source("nation", nations),
                            layers.Source("missing", missing)])


@query("land_source")
def q_land_source(spark, d):
    reg = _registry(d)
    try:
        reg.land(spark, "not_allowed")
    except ValueError:
        pass
    else:
        raise AssertionError("an unknown source must be rejected")
    return reg.land(spark, "customer")


@query("run_report")
def q_run_report(spark, d):
    report = _registry(d).run(spark, scratch_path(spark, "run"))
    return report.select("fuente", "estado", "filas", "columnas", "error")  # times differ between runs


@query("quarantine_html")
def q_quarantine_html(spark, d):
    pages = A.read(spark, d, "pages").select(F.lit("pages").alias("origen"), F.col("page_id").alias("id"),
                                             F.col("html").alias("contenido"))
    docs = A.read(spark, d, "documents").select(F.lit("documents").alias("origen"), F.col("doc_id").alias("id"),
                                                F.col("text").alias("contenido"))
    u = pages.unionByName(docs)
    return u.select("origen", "id", F.coalesce(files.looks_like_html(F.col("contenido")), F.lit(False))
                    .alias("es_html"))


@query("dictionary_sheet")
def q_dictionary_sheet(spark, d):
    """A dictionary sheet (title row, header row, merged first column, blank rows) from nation ⋈ region."""
    nation, region = A.read(spark, d, "nation"), A.read(spark, d, "region")
    g = nation.join(region, nation.n_regionkey == region.r_regionkey)
    first = F.row_number().over(Window.partitionBy("r_regionkey").orderBy("n_nationkey")) == 1
    rows = g.select((F.col("r_regionkey") * 1000 + F.col("n_nationkey") + 10).alias("_k"),
                    F.when(first, F.col("r_name")).alias("c0"), F.col("n_nationkey").cast("string").alias("c1"),
                    F.col("n_name").alias("c2"))
    blanks = region.select((F.col("r_regionkey") * 1000 + 999).alias("_k"), F.lit(None).cast("string").alias("c0"),
                           F.lit(None).cast("string").alias("c1"), F.lit(None).cast("string").alias("c2"))
    head = region.agg(F.lit(0).cast("long").alias("_k"), F.lit("Diccionario de variables").alias("c0"),
                      F.lit(None).cast("string").alias("c1"), F.lit(None).cast("string").alias("c2")).unionByName(
        region.agg(F.lit(1).cast("long").alias("_k"), F.lit("variable").alias("c0"), F.lit("codigo").alias("c1"),
                   F.lit("etiqueta").alias("c2")))
    sheet = head.unionByName(rows.withColumn("_k", F.col("_k").cast("long"))).unionByName(
        blanks.withColumn("_k", F.col("_k").cast("long")))
    path = scratch_path(spark, "sheet")
    # a dictionary sheet is small by nature (nation × region): one ordered file
    sheet.orderBy("_k").drop("_k").coalesce(1).write.csv(path)
    out = files.read_sheet(spark, path, ["variable", "codigo", "etiqueta"], skip=2, fill_down=["variable"])
    return out.where(F.col("codigo").isNotNull()).select(
        F.trim("variable").alias("variable"), F.trim("codigo").alias("codigo"), F.trim("etiqueta").alias("etiqueta"))


@query("load_replace")
def q_load_replace(spark, d):
    root = scratch_path(spark, "replace")
    o = A.read(spark, d, "orders")
    layers.write_replace(o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("date")), root, "dw", "orders")
    layers.write_replace(o, root, "dw", "orders")  # full replace
    return layers.read_table(spark, root, "dw", "orders")


@query("load_verify_count")
def q_load_verify_count(spark, d):
    return layers.write_verified(A.read(spark, d, "orders"), scratch_path(spark, "verify"), "dw", "orders")


@query("replicate_table")
def q_replicate_table(spark, d):
    src, dst = scratch_path(spark, "cloud"), scratch_path(spark, "local")
    for name in ("region", "nation", "orders"):
        layers.write_replace(A.read(spark, d, name), src, "dw", name)
    return layers.replicate(spark, src, dst, "dw", dims=["region", "nation", "dim_missing"], facts=["orders"])


CUSTOMER_TARGET = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])
RENAMES = {"CUSTKEY": "c_custkey"}


def _drifted_files(spark, d) -> str:
    """customer written as three yearly-style files with drifting layouts."""
    root = scratch_path(spark, "drift")
    c = A.read(spark, d, "customer")
    g = F.col("c_custkey") % 3
    c.where(g == 0).write.option("header", True).csv(f"{root}/grupo0")
    (c.where(g == 1).select(F.col("c_custkey").alias("CUSTKEY"), F.col("c_nationkey").alias("c_nation\nkey"),
                            "c_acctbal", "c_mktsegment")
     .write.option("header", True).csv(f"{root}/grupo1"))
    (c.where(g == 2).select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                            F.lit(1).alias("Cantidad"), F.col("c_mktsegment").alias("extra"))
     .write.option("header", True).csv(f"{root}/grupo2"))
    return root


def _read_group(spark, root, g):
    return spark.read.option("header", True).option("multiLine", True).csv(f"{root}/grupo{g}")


@query("align_schema")
def q_align_schema(spark, d):
    from vitals.operators.align import align
    root = _drifted_files(spark, d)
    parts = [align(_read_group(spark, root, g), CUSTOMER_TARGET, renames=RENAMES, drop=["Cantidad"],
                   copy_if_absent={"c_name": "c_custkey"}) for g in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("schema_drift_report")
def q_schema_drift_report(spark, d):
    from vitals.operators.align import drift, drift_report
    root = _drifted_files(spark, d)
    rows = []
    for g in range(3):
        rows += drift(_read_group(spark, root, g).columns, CUSTOMER_TARGET, f"grupo{g}", RENAMES)
    # the report carries header names only; row counts per file come from the data
    counts = {f"grupo{g}": _read_group(spark, root, g).count() for g in range(3)}
    return drift_report(spark, rows).withColumn(
        "filas", F.element_at(F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]), F.col("archivo"))
        .cast("bigint"))


@query("land_parquet_parts")
def q_land_parquet_parts(spark, d):
    """Multi-part Parquet landing: a part that is really an HTML page is rejected,
    source columns are renamed to the standard layout (P3), the name column is copied
    from the code when absent (P17), measures are coerced with NULL → 0 (F18) and the
    provenance columns are added (P6)."""
    from vitals.functions import rules as R
    from vitals.operators.align import align
    folder = scratch_path(spark, "who-parts")
    # the source layout: Country, Year, Sex, List, Deaths1 (one part per year group)
    src = A.read(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("Country"), F.year("o_orderdate").alias("Year"),
        F.col("o_orderstatus").alias("Sex"), F.col("o_orderpriority").alias("List"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("Deaths1"))
    src.repartition(6, "Year").write.parquet(f"{folder}/partes")
    A.read(spark, d, "pages").select(F.col("html").alias("value")).write.text(f"{folder}/partes/login")
    good, bad = files.read_parquet_parts_tolerant(spark, f"{folder}/partes")
    if not any(why == "html" for _, why in bad):
        raise AssertionError("the HTML payload should have been rejected")
    target = T.StructType([T.StructField("iso3c", T.StringType()), T.StructField("country_name", T.StringType()),
                           T.StructField("year", T.LongType()), T.StructField("time", T.StringType()),
                           T.StructField("time_unit", T.StringType()), T.StructField("deaths", T.DoubleType()),
                           T.StructField("archivo_origen", T.StringType())])
    good = files.with_file_name(good, "archivo_origen", level="folder")
    aligned = align(good, target, renames={"Country": "iso3c", "Year": "year", "Sex": "time", "List": "time_unit",
                                           "Deaths1": "deaths"}, copy_if_absent={"country_name": "iso3c"})
    return (aligned.withColumn("year", R.to_long_or_zero(F.col("year")))
            .withColumn("deaths", R.to_long_or_zero(F.col("deaths")))
            .withColumn("fuente_origen", F.lit("OMS_PARQUET")))


@query("wide_csv_to_long")
def q_wide_csv_to_long(spark, d):
    """L3: a wide daily file (one column per calendar day, ~2,400 columns) from orders
    per customer, landed back to one row per customer × day with deaths > 0."""
    import datetime as _dt
    from vitals.operators.reshape import wide_csv_to_long
    first, last, customers = A.read(spark, d, "orders").agg(
        F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate")), F.approx_count_distinct("o_custkey")).first()
    days = [(first + _dt.timedelta(k)).isoformat() for k in range((last - first).days + 1)]
    o = A.read(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("dia"))
    per_day = o.groupBy("o_custkey", "dia").agg(F.count(F.lit(1)).alias("n"))
    # one line per customer: its days in order (≤ one per calendar day), each after the zeros since the one before
    at = F.coalesce(F.datediff("dia", F.lit(first)), F.raise_error(F.lit("an order without a day")).cast("int"))
    by_cust = per_day.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(at.alias("at"), "n"))).alias("m"))
    zeros = lambda n: F.repeat(F.lit("0,"), n)
    before = F.concat(F.array(F.lit(-1)), F.col("m.at"))
    cells = F.zip_with("m", F.slice(before, 1, F.size("m")), lambda x, b: F.concat(zeros(x["at"] - b - 1), x["n"].cast("string"), F.lit(",")))
    row = F.concat(F.array_join(cells, ""), zeros(F.lit(len(days) - 1) - F.element_at("m", -1)["at"]))
    line = F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit('"cliente, grupo"'), F.expr("left(fila, length(fila) - 1)"))
    folder = scratch_path(spark, "wide")
    header = ",".join(["codigo", "nombre", *days])
    rows = by_cust.select("o_custkey", row.alias("fila")).select((F.col("o_custkey") % 8).alias("grupo"), line.alias("value"))
    files.write_text_files(rows, "grupo", header, folder, parts=-(-customers // (8 * WIDE_FILE_ROWS)) or 1)
    return wide_csv_to_long(spark, folder, 2, ["codigo", "nombre"]).select(
        F.col("codigo").cast("bigint").alias("o_custkey"), "fecha", "n")
