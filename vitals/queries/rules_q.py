"""Rule, filter, lookup and reshape queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitals import adapter as A
from vitals import catalogues as C
from vitals.functions import rules as R
from vitals.operators import dedup, lookup, reshape
from vitals.plans import stage as S
from vitals.queries import query


def _li(spark, d):
    return A.read(spark, d, "lineitem")


def _age_text(ln, qty):
    q = qty.cast("int").cast("string")
    return (F.when(ln % 4 == 0, F.lit("< 1 año"))
            .when(ln % 4 == 1, F.concat(q, F.lit(" a "), (qty.cast("int") + 4).cast("string"), F.lit(" años")))
            .when(ln % 4 == 2, F.concat(q, F.lit("+")))
            .otherwise(F.lit("sin dato")))


def _noisy_code(ln, causa):
    return (F.when(ln == 7, F.lit(None).cast("string"))
            .when(ln == 6, F.lit("   "))
            .when(ln == 5, F.concat(F.lit("9"), causa))
            .when(ln % 4 == 0, F.lower(causa))
            .when(ln % 4 == 1, F.concat(F.lit(" "), causa, F.lit(" ")))
            .when(ln % 4 == 2, F.concat(F.substring(causa, 1, 2), F.lit(":"), F.substring(causa, 3, 2)))
            .otherwise(causa))


@query("period_classify")
def q_period_classify(spark, d):
    o = A.read(spark, d, "orders")
    y = F.year("o_orderdate")
    return o.select("o_orderkey", y.cast("int").alias("anio"),
                    R.classify_period(y, A.TEST_COVID_START, A.TEST_COVID_END).alias("periodo"),
                    R.classify_period_covid(y, A.TEST_COVID_END).alias("periodo_covid"),
                    R.classify_period(F.col("o_orderpriority")).alias("periodo_texto"))


@query("age_to_years")
def q_age_to_years(spark, d):
    li = _li(spark, d)
    unit = ((F.col("l_linenumber") - 1) % 4 + 1).cast("int")
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("edad"), unit.alias("unidad"),
                     R.age_in_years(F.col("l_quantity"), unit).alias("edad_anios"))


@query("age_group")
def q_age_group(spark, d):
    li = _li(spark, d)
    unit = ((F.col("l_linenumber") - 1) % 4 + 1).cast("int")
    grupo = R.age_group(R.age_in_years(F.col("l_quantity"), unit))
    return li.select("l_orderkey", "l_linenumber", grupo.alias("grupo_etario"),
                     R.age_label_to_dim(grupo).alias("grupo_dim"),
                     R.age_group_from_text(_age_text(F.col("l_linenumber"), F.col("l_quantity"))).alias("grupo_texto"))


@query("dictionary_decode")
def q_dictionary_decode(spark, d):
    c = A.read(spark, d, "customer")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    code = (F.when(k % 50 == 0, F.lit(None).cast("string"))
            .when(k % 7 == 0, (nk + 30).cast("string"))
            .when(k % 3 == 0, F.concat(nk.cast("string"), F.lit(".0")))
            .otherwise(nk.cast("string")))
    dic = lookup.normalised_dictionary(A.ine_dictionary(spark, d))
    out = lookup.decode(c.select("c_custkey", code.alias("codigo")), dic,
                        {"municipio": ("codigo", "Municipio de ocurrencia")})
    return out.select("c_custkey", "codigo", "municipio")


@query("cause_describe")
def q_cause_describe(spark, d):
    li = _li(spark, d).select("l_orderkey", "l_linenumber",
                              R.icd_upper(A.cause_code("l_partkey", "l_suppkey")).alias("codigo_cie10"))
    cat = S.icd_catalogue(A.icd_catalogue_raw(spark, d))
    return lookup.describe(li, cat, "codigo_cie10", "descripcion_causa", C.CAUSE_MISS)


@query("icd_normalise")
def q_icd_normalise(spark, d):
    li = _li(spark, d)
    raw = _noisy_code(F.col("l_linenumber"), A.cause_code("l_partkey", "l_suppkey"))
    code = R.icd_normalise(raw)
    return li.select("l_orderkey", "l_linenumber", raw.alias("codigo_raw"), code.alias("codigo_cie10"),
                     R.icd_upper(raw).alias("codigo_upper"),
                     R.icd_chapter_stage(code).alias("capitulo_cie10"),
                     R.icd_chapter_dim(code).alias("capitulo_dim"),
                     R.icd_category(code).alias("categoria"),
                     R.icd_valid(raw).alias("valido"))


@query("icd_valid")
def q_icd_valid(spark, d):
    li = _li(spark, d)
    raw = _noisy_code(F.col("l_linenumber"), A.cause_code("l_partkey", "l_suppkey"))
    return li.where(R.icd_valid(raw)).select("l_orderkey", "l_linenumber", R.icd_upper(raw).alias("codigo"))


@query("sex_normalise")
def q_sex_normalise(spark, d):
    li = _li(spark, d)
    raw = (F.when(F.col("l_returnflag") == "A", F.lit(" f "))
           .when(F.col("l_returnflag") == "R", F.lit("M")).otherwise(F.col("l_returnflag")))
    label = R.sex_normalise(raw)
    return (li.select(raw.alias("sexo_raw"), label.alias("sexo"), R.sex_id(label).alias("id_sexo"))
            .groupBy("sexo_raw", "sexo", "id_sexo").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def _names(spark, d):
    p = A.read(spark, d, "part").select(F.lit("part").alias("origen"), F.col("p_partkey").alias("clave"),
                                        F.col("p_name").alias("nombre"))
    c = A.read(spark, d, "customer").select(F.lit("customer").alias("origen"), F.col("c_custkey").alias("clave"),
                                            F.col("c_name").alias("nombre"))
    u = p.unionByName(c)
    k = F.col("clave")
    raw = (F.when(k % 4 == 0, F.concat(F.upper("nombre"), F.lit("  ")))
           .when(k % 9 == 1, F.lit(" "))
           .when(k % 4 == 2, F.concat(F.lit("\t"), F.lower("nombre")))
           .otherwise(F.col("nombre")))
    return u.select("origen", "clave", raw.alias("raw"))


@query("text_normalise")
def q_text_normalise(spark, d):
    u = _names(spark, d)
    return u.select("origen", "clave", R.title_case(F.col("raw")).alias("titulo"),
                    R.strip(F.col("raw")).alias("limpio"),
                    R.blank_to_null(F.col("raw")).alias("nulo"))


@query("rate_per_100k")
def q_rate_per_100k(spark, d):
    cust = A.read(spark, d, "customer")
    pop = cust.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        (F.count_if(F.col("c_acctbal") < 0) * 100).cast("bigint").alias("poblacion"))
    o = A.read(spark, d, "orders").join(cust.select("c_custkey", "c_nationkey"),
                                        F.col("o_custkey") == F.col("c_custkey"))
    deaths = o.groupBy(F.col("c_nationkey").alias("nationkey"), F.year("o_orderdate").cast("int").alias("anio")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("fallecidos"))
    return (deaths.join(pop, "nationkey")  # shuffle join; AQE splits a hot nation
            .select("nationkey", "anio", "fallecidos", "poblacion",
                    R.rate_per_100k(F.col("fallecidos"), F.col("poblacion")).alias("tasa_por_100k")))


@query("numeric_coerce")
def q_numeric_coerce(spark, d):
    e = A.read(spark, d, "events")
    k = F.regexp_extract(F.col("props"), r'"k":\s*([^},]+)', 1)
    return e.select("event_id", R.to_double(k).alias("valor"), R.to_long_or_zero(k).alias("entero"),
                    R.to_double(F.col("event_type")).alias("texto"),
                    R.to_long_or_zero(F.col("event_type")).alias("relleno"))


@query("date_coerce")
def q_date_coerce(spark, d):
    o = A.read(spark, d, "orders")
    txt = F.when(F.col("o_orderkey") % 10 == 0, F.lit("2021-02-30")).otherwise(
        F.to_date("o_orderdate").cast("string"))
    fecha = F.try_to_date(txt, "yyyy-MM-dd")
    m = F.month(fecha)
    return o.select("o_orderkey", fecha.alias("fecha"), F.year(fecha).cast("int").alias("anio"),
                    m.cast("int").alias("mes"), R.quarter_of(m).alias("trimestre"),
                    F.make_date(F.year(fecha), m, F.lit(1)).alias("fecha_mes"))


@query("time_unit_split")
def q_time_unit_split(spark, d):
    o = A.read(spark, d, "orders")
    k = F.col("o_orderkey") % 3
    unit = F.when(k == 0, F.lit("monthly")).when(k == 1, F.lit("weekly")).otherwise(F.lit("annual"))
    time = (F.when(k == 0, F.month("o_orderdate")).when(k == 1, F.weekofyear("o_orderdate"))
            .otherwise(F.year("o_orderdate"))).cast("int")
    mes, semana = R.split_time_unit(time, unit)
    return o.select("o_orderkey", unit.alias("time_unit"), time.alias("time"), mes.alias("mes"),
                    semana.alias("semana"))


def _event_type_noisy(spark, d):
    e = A.read(spark, d, "events")
    k = F.col("event_id")
    tipo = (F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 13 == 0, F.lit("  "))
            .otherwise(F.col("event_type")))
    return e.select("event_id", tipo.alias("tipo"), "value")


@query("drop_critical_nulls")
def q_drop_critical_nulls(spark, d):
    e = _event_type_noisy(spark, d)
    return e.where(F.col("tipo").isNotNull() & (R.strip(F.col("tipo")) != "")).select("event_id", "tipo")


@query("filter_year_range")
def q_filter_year_range(spark, d):
    o = A.read(spark, d, "orders")
    return o.where(R.within_years("o_orderdate", 1996, 1999)).select(
        "o_orderkey", F.year("o_orderdate").cast("int").alias("anio"))


@query("filter_positive")
def q_filter_positive(spark, d):
    e = A.read(spark, d, "events")
    v = (F.col("value") - 5).cast("string")
    return e.where(R.to_double(v) > 0).select("event_id", R.to_double(v).alias("valor"))


def _selected(spark):
    return C.countries_df(spark)


@query("select_countries")
def q_select_countries(spark, d):
    oc = A.order_countries(spark, d)
    sel = F.broadcast(_selected(spark).select("iso2"))  # 32 rows fixed by the catalogue
    return oc.join(sel, "iso2", "left_semi").select("o_orderkey", "iso2", "country")


@query("missing_members")
def q_missing_members(spark, d):
    present = A.order_countries(spark, d).select("iso2").distinct()
    return _selected(spark).join(present, "iso2", "left_anti").select("iso2", "country")


@query("map_name_to_iso")
def q_map_name_to_iso(spark, d):
    oc = A.order_countries(spark, d)
    names = F.broadcast(_selected(spark).select(F.col("country").alias("nombre"),
                                                F.col("iso3").alias("iso3_mapeado")))
    return oc.join(names, oc.country == names.nombre).select("o_orderkey", "country", "iso3_mapeado")


@query("map_region")
def q_map_region(spark, d):
    oc = A.order_countries(spark, d)
    iso2_to_iso3 = R.literal_map([(r[0], r[1]) for r in C.SELECTED_COUNTRIES])
    iso3 = F.element_at(iso2_to_iso3, F.col("iso2"))
    region_dim = F.coalesce(F.element_at(R.literal_map(C.DIM_REGION_BY_ISO3), iso3), F.lit("Otro"))
    region_stage = F.element_at(R.literal_map([(r[0], r[3]) for r in C.SELECTED_COUNTRIES]), F.col("iso2"))
    return oc.select("o_orderkey", "iso2", iso3.alias("iso3_desde_iso2"), region_dim.alias("region"),
                     F.coalesce(region_stage, F.lit(C.REGION_MISS)).alias("region_stage"))


@query("map_who_region")
def q_map_who_region(spark, d):
    oc = A.order_countries(spark, d)
    code = F.when(F.col("o_orderkey") % 17 == 0, F.lit("XYZ")).otherwise(F.col("who_region"))
    return oc.select("o_orderkey", code.alias("who_region"), R.who_region_name(code).alias("who_region_desc"))


@query("dedup_keep_first")
def q_dedup_keep_first(spark, d):
    li = _li(spark, d)
    keys = ["l_orderkey", "l_linenumber"]
    return dedup.keep_first(li, keys, [c for c in li.columns if c not in keys])


@query("weekly_to_monthly")
def q_weekly_to_monthly(spark, d):
    cw = A.covid_world_weekly(spark, d)
    m = reshape.weekly_to_monthly(cw, ["Country_code"], "Date_reported", ["New_cases", "New_deaths"],
                                  ["Cumulative_cases", "Cumulative_deaths"])
    return m


def _calendar(spark, d) -> list[str]:
    """Every month from the first to the last order (two scalars)."""
    lo, hi = A.read(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    if lo is None:
        return []
    out, (y, m) = [], (lo.year, lo.month)
    while (y, m) <= (hi.year, hi.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


@query("wide_to_long")
def q_wide_to_long(spark, d):
    oc = A.order_countries(spark, d).withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    # pivot values are the data's own calendar, not a distinct job over its months
    wide = oc.groupBy("nationkey").pivot("ym", _calendar(spark, d)).agg(F.count(F.lit(1)))
    return reshape.wide_to_long(wide, ["nationkey"], value_name="n", date_name="fecha")


@query("homologate_union")
def q_homologate_union(spark, d):
    return S.homologate_regional(A.regional_panama(spark, d), A.regional_costa_rica(spark, d))


@query("overlap_entities")
def q_overlap_entities(spark, d):
    c = A.read(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = A.read(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return c.intersect(s)


@query("add_provenance")
def q_add_provenance(spark, d):
    c = A.read(spark, d, "customer")
    return c.select("*", F.lit("TPCH_CUSTOMER").alias("fuente_origen"),
                    F.col("_metadata.file_name").alias("archivo_origen"))

