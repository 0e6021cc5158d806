"""Warehouse queries: dimensions, upsert, SCD2, facts, FK/uniqueness/contract reports, drill-across."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitals import adapter as A
from vitals import catalogues as C
from vitals.functions import rules as R
from vitals.operators import quality
from vitals.operators.keys import sequential_ids
from vitals.operators.upsert import scd2_merge, upsert_ignore
from vitals.plans import dims as D
from vitals.plans import facts as H
from vitals.queries import query
from vitals.queries import stage_q as SQ
from vitals.session import materialize

FACT_CASES_MIN_YEAR = 1997
GEO_MOVED = "A"  # first letter of the departments that change


#: what dimensions and facts read of each stage table
READ = {
    "deaths": ["anio_ocurrencia", "mes_ocurrencia", "nombre_depto_ocurrencia", "nombre_muni_ocurrencia", "sexo", "grupo_etario",
               "codigo_cie10", "descripcion_causa", "periodo"],
    "cases": ["anio", "departamento", "municipio", "codigo_cie10", "diagnostico", "grupo_etario", "sexo", "casos", "periodo"],
    "covid_local": None, "world": None, "covid_world": None,
}
BUILD = {"deaths": SQ.stage_deaths_df, "cases": SQ.stage_cases_df, "covid_local": SQ.stage_covid_local_df,
         "world": SQ.stage_mortality_world_df, "covid_world": SQ.stage_covid_world_df}


def _lazy(spark, d, *names, read=READ):
    """Stage frames that a query reads once: nothing is written, and the columns it
    does not read are never computed."""
    return {n: SQ.stage_deaths_df(spark, d, read[n]) if n == "deaths" else BUILD[n](spark, d) for n in names}


def _stages(spark, d, *names, **own):
    """Stage tables read by several plans of a query, each written once with the columns
    that are read (``own``: by this query), so dimensions and facts do not recompute the stage jobs."""
    read = READ | own
    return {n: materialize(f.select(*(read[n] or f.columns)), f"stage-{n}")
            for n, f in _lazy(spark, d, *names, read=read).items()}


def _causes(spark, d):
    """The causes (code, text) of the cases and the deaths, each written once: a condition on a code
    that is computed goes down to the scan, where it repeats the rule behind each mention for every row."""
    read = {"cases": ["codigo_cie10", "diagnostico"], "deaths": ["codigo_cie10", "descripcion_causa"]}
    return {n: materialize(f.select(*read[n]).distinct(), f"causes-{n}") for n, f in _lazy(spark, d, *read, read=read).items()}


def _dim_time(st, numbered=True):
    return D.dim_time(D.time_members(**st), A.TEST_COVID_START, A.TEST_COVID_END, numbered=numbered)


@query("dim_time")
def q_dim_time(spark, d):
    return _dim_time(_lazy(spark, d, "deaths", "cases", "covid_local", "world", "covid_world"))


@query("dim_geo")
def q_dim_geo(spark, d):
    st = _lazy(spark, d, "deaths", "cases", "covid_local")
    return D.dim_geo(D.geo_members(**st))


@query("dim_country")
def q_dim_country(spark, d):
    return D.dim_country(**_lazy(spark, d, "world", "covid_world"))


@query("dim_cause")
def q_dim_cause(spark, d):
    return D.dim_cause(spark, **_causes(spark, d))


@query("dim_static")
def q_dim_static(spark, d):
    """Static catalogues with the number of stage rows that use each member."""
    st = _stages(spark, d, "deaths", "cases", deaths=["sexo", "grupo_etario"], cases=["anio"])
    sd, sc = st["deaths"], st["cases"]
    s = D.dim_static(spark)
    sex_use = sd.groupBy(R.sex_id(F.col("sexo")).alias("id")).agg(F.count(F.lit(1)).alias("filas"))
    age_use = (sd.withColumn("rango", R.age_label_to_dim(F.col("grupo_etario")))
               .join(s["dim_grupo_etario"].select("rango", F.col("id_grupo_etario").alias("id")), "rango")
               .groupBy("id").agg(F.count(F.lit(1)).alias("filas")))
    src_use = (sd.select(F.lit(1).alias("id")).unionByName(sc.select(F.lit(2).alias("id")))
               .groupBy("id").agg(F.count(F.lit(1)).alias("filas")))

    def report(dim, id_col, label, name, use):
        return (dim.select(F.lit(name).alias("dimension"), F.col(id_col).alias("id"), F.col(label).alias("etiqueta"))
                .join(F.broadcast(use), "id", "left")  # keyed by dimension ids: ≤ 8 rows
                .select("dimension", "id", "etiqueta", F.coalesce("filas", F.lit(0)).cast("bigint").alias("filas")))

    return (report(s["dim_sexo"], "id_sexo", "descripcion", "dim_sexo", sex_use)
            .unionByName(report(s["dim_grupo_etario"], "id_grupo_etario", "rango", "dim_grupo_etario", age_use))
            .unionByName(report(s["dim_fuente"], "id_fuente", "nombre", "dim_fuente", src_use)))


def _month_members(spark, d, before=None):
    o = A.read(spark, d, "orders")
    if before:
        o = o.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    return o.select(F.year("o_orderdate").cast("int").alias("anio"),
                    F.month("o_orderdate").cast("int").alias("mes")).distinct()


@query("dim_upsert_ignore")
def q_dim_upsert_ignore(spark, d):
    first = upsert_ignore(None, _month_members(spark, d, "1998-01-01"), ["anio", "mes"], "id_tiempo")
    full = _month_members(spark, d)
    second = upsert_ignore(first, full, ["anio", "mes"], "id_tiempo")
    return upsert_ignore(second, full, ["anio", "mes"], "id_tiempo")  # idempotent re-load


@query("scd2_merge")
def q_scd2_merge(spark, d):
    c = A.read(spark, d, "customer")
    base = c.where(F.col("c_custkey") % 7 != 3).select(
        "c_custkey", F.col("c_mktsegment").alias("segmento"), F.col("c_nationkey").alias("nacion"),
        F.lit(dt.date(2015, 1, 1)).alias("fecha_inicio_vigencia"),
        F.lit(None).cast("date").alias("fecha_fin_vigencia"),
        F.lit(True).alias("es_version_actual"), F.lit(1).alias("version"))
    current = sequential_ids(base, "id_cliente", ["c_custkey"])
    incoming = c.select("c_custkey",
                        F.when(F.col("c_custkey") % 10 == 0, F.concat(F.col("c_mktsegment"), F.lit("_2")))
                        .otherwise(F.col("c_mktsegment")).alias("segmento"),
                        F.col("c_nationkey").alias("nacion"))
    return scd2_merge(current, incoming, ["c_custkey"], ["segmento", "nacion"], dt.date(2020, 1, 1), "id_cliente")


def _time_nat(dim_time):
    return (dim_time, "id_tiempo", ["anio", "mes"])


def _geo_nat(dim_geo):
    return (dim_geo, "id_geografia", ["nombre_departamento", "nombre_municipio"])


def _cause_nat(dim_cause):
    return (dim_cause, "id_causa", ["codigo_cie10"])


def fact_deaths_build(spark, d):
    sd = _stages(spark, d, "deaths")["deaths"]
    dt_, dg, dc = _dim_time({"deaths": sd}), D.dim_geo(D.geo_members(deaths=sd)), D.dim_cause(spark, deaths=sd)
    fb = H.fact_deaths(sd, dt_, dg, dc, C.age_group_df(spark), C.source_df(spark))
    return fb, dt_, dg, dc


@query("fact_deaths")
def q_fact_deaths(spark, d):
    fb, dt_, dg, dc = fact_deaths_build(spark, d)
    return H.denormalise(fb.fact, {"t": _time_nat(dt_), "g": _geo_nat(dg), "c": _cause_nat(dc)})


@query("fact_cases")
def q_fact_cases(spark, d):
    sc = _stages(spark, d, "cases")["cases"]
    dt_, dg, dc = _dim_time({"cases": sc}), D.dim_geo(D.geo_members(cases=sc)), D.dim_cause(spark, cases=sc)
    fb = H.fact_cases(sc, dt_, dg, dc, C.age_group_df(spark), min_year=FACT_CASES_MIN_YEAR)
    return H.denormalise(fb.fact, {"t": _time_nat(dt_), "g": _geo_nat(dg), "c": _cause_nat(dc)})


@query("fact_covid_local")
def q_fact_covid_local(spark, d):
    cl = _stages(spark, d, "covid_local")["covid_local"]
    dt_, dg, dc = (_dim_time({"covid_local": cl}), D.dim_geo(D.geo_members(covid_local=cl)),
                   D.dim_cause(spark))
    fb = H.fact_covid_local(cl, dt_, dg, dc, C.source_df(spark))
    return H.denormalise(fb.fact, {"t": _time_nat(dt_), "g": _geo_nat(dg), "c": _cause_nat(dc)})


@query("fact_mortality_world")
def q_fact_mortality_world(spark, d):
    mw = _stages(spark, d, "world")["world"]
    dt_, dp = _dim_time({"world": mw}), D.dim_country(world=mw)
    fb = H.fact_mortality_world(mw, dt_, dp)
    return H.denormalise(fb.fact, {"t": _time_nat(dt_), "p": (dp.withColumnRenamed("id_pais", "id_geografia_mundial"),
                                                              "id_geografia_mundial", ["iso3c"])})


@query("fact_covid_world")
def q_fact_covid_world(spark, d):
    cw = _stages(spark, d, "covid_world")["covid_world"]
    dt_, dp = _dim_time({"covid_world": cw}), D.dim_country(covid_world=cw)
    fb = H.fact_covid_world(cw, dt_, dp)
    return H.denormalise(fb.fact, {"t": _time_nat(dt_), "p": (dp.withColumnRenamed("id_pais", "id_geografia_mundial"),
                                                              "id_geografia_mundial", ["iso3c"])})


@query("fk_null_report")
def q_fk_null_report(spark, d):
    """NULL FKs of the deaths fact when the dimensions come from other sources."""
    st = _stages(spark, d, "deaths", "cases", "covid_local", cases=["anio", "codigo_cie10", "diagnostico"],
                 deaths=[c for c in READ["deaths"] if c != "descripcion_causa"])
    dt_ = _dim_time({"cases": st["cases"]})
    dg = D.dim_geo(D.geo_members(covid_local=st["covid_local"]))
    dc = D.dim_cause(spark, cases=st["cases"])
    fb = H.fact_deaths(st["deaths"], dt_, dg, dc, C.age_group_df(spark), C.source_df(spark))
    return fb.null_report()


@query("fk_violations")
def q_fk_violations(spark, d):
    """Cases-fact rows whose cause is missing from a dimension loaded with chapters A–M only."""
    sc = _stages(spark, d, "cases")["cases"]
    dt_, dg, dc = _dim_time({"cases": sc}), D.dim_geo(D.geo_members(cases=sc)), D.dim_cause(spark, cases=sc)
    fact = H.fact_cases(sc, dt_, dg, dc, C.age_group_df(spark), min_year=FACT_CASES_MIN_YEAR).fact
    loaded = dc.where(F.substring("codigo_cie10", 1, 1) <= "M")
    bad = quality.fk_violations(fact, loaded, "id_causa", "id_causa")
    return bad.agg(F.lit("id_causa").alias("fk"), F.count(F.lit(1)).cast("bigint").alias("violaciones"))


@query("unique_violations")
def q_unique_violations(spark, d):
    """Country candidates (both sources, before the one-per-ISO3 rule) sharing a key."""
    st = _lazy(spark, d, "world", "covid_world")
    iso2_to_iso3 = R.literal_map([(r[0], r[1]) for r in C.SELECTED_COUNTRIES])
    a = st["world"].select("iso3c", "country_name").distinct()
    b = (st["covid_world"].select(F.element_at(iso2_to_iso3, F.col("country_code")).alias("iso3c"), "country_name")
         .distinct())
    return quality.unique_violations(a.unionByName(b).where(F.col("iso3c").isNotNull()), ["iso3c"])


CONTRACT_COVID_LOCAL = [
    ("fecha_fallecimiento", "date", False, None),
    ("anio", "int", False, None),
    ("departamento", "string", True, 6),
    ("municipio", "string", True, 8),
    ("poblacion", "bigint", False, None),
    ("fallecidos", "int", False, None),
    ("tasa_por_100k", "double", True, None),
    ("region", "string", True, None),
]


@query("contract_check")
def q_contract_check(spark, d):
    return quality.contract_report(_lazy(spark, d, "covid_local")["covid_local"], CONTRACT_COVID_LOCAL)


@query("drill_across")
def q_drill_across(spark, d):
    st = _stages(spark, d, "deaths", "covid_local")
    dt_ = _dim_time({"deaths": st["deaths"], "covid_local": st["covid_local"]})
    dg = D.dim_geo(D.geo_members(deaths=st["deaths"], covid_local=st["covid_local"]))
    dc = D.dim_cause(spark, deaths=st["deaths"])
    deaths = H.fact_deaths(st["deaths"], dt_, dg, dc, C.age_group_df(spark), C.source_df(spark)).fact
    covid = H.fact_covid_local(st["covid_local"], dt_, dg, dc, C.source_df(spark)).fact
    ids = {"dim_tiempo": "id_tiempo", "dim_geografia_gt": "id_geografia"}
    keys = [ids[x] for x in H.shared_dimensions("fact_defunciones_gt", "fact_mortalidad_covid_gt") if x in ids]  # cause and source are constants of one of them
    both = H.drill_across(deaths, "total_casos", covid, "fallecidos", keys)
    return H.denormalise(both, {"t": _time_nat(dt_), "g": _geo_nat(dg)})


@query("star_observed")
def q_star_observed(spark, d):
    """The monthly series read back from the star (fact ⋈ time ⋈ geography)."""
    from vitals.plans import marts as M
    fb, dt_, dg, _ = fact_deaths_build(spark, d)
    fact = materialize(fb.fact, "fact-deaths")  # the loaded fact table
    return M.star_observed(fact, dt_, dg, years=A.TEST_YEARS)


def _built_dimensions(spark, d):
    return _built_from(spark, _stages(spark, d, "deaths", "cases", "covid_local", "world", "covid_world"))


def _built_from(spark, st):
    static = D.dim_static(spark)
    return {
        "dim_tiempo": (_dim_time(st, numbered=False), ["anio", "mes"], "id_tiempo", False),
        "dim_geografia_gt": (D.dim_geo(D.geo_members(deaths=st["deaths"], cases=st["cases"],
                                                     covid_local=st["covid_local"]), numbered=False),
                             ["nombre_departamento", "nombre_municipio"], "id_geografia", False),
        "dim_geografia_mundial": (D.dim_country(world=st["world"], covid_world=st["covid_world"], numbered=False),
                                  ["iso3c"], "id_pais", False),
        "dim_causa_cie10": (D.dim_cause(spark, cases=st["cases"], deaths=st["deaths"], numbered=False), ["codigo_cie10"],
                            "id_causa", False),
        "dim_sexo": (static["dim_sexo"], ["codigo"], "id_sexo", True),
        "dim_grupo_etario": (static["dim_grupo_etario"], ["rango"], "id_grupo_etario", True),
        "dim_fuente": (static["dim_fuente"], ["nombre"], "id_fuente", True),
    }


@query("load_dimensions")
def q_load_dimensions(spark, d):
    """The dimension load run twice into one warehouse: the second run adds nothing
    and changes no id (report of the second run)."""
    from vitals.plans.load import load_dimensions
    from vitals.session import scratch_path
    root = scratch_path(spark, "dw")
    built = _built_dimensions(spark, d)
    load_dimensions(spark, root, built)
    return load_dimensions(spark, root, built)


@query("load_fact")
def q_load_fact(spark, d):
    """The deaths fact loaded twice (truncate + append): dense ids 1..n each
    time, one load timestamp per run."""
    from vitals.plans.load import FACT_DEATHS_CONTRACT, load_fact
    from vitals.session import scratch_path
    root = scratch_path(spark, "dw")
    fb, _, _, _ = fact_deaths_build(spark, d)
    fact = materialize(fb.fact, "fact-deaths")  # built once, loaded twice
    load_fact(fact, root, "fact_defunciones_gt", "id_defuncion", FACT_DEATHS_CONTRACT)
    loaded = load_fact(fact, root, "fact_defunciones_gt", "id_defuncion", FACT_DEATHS_CONTRACT)
    # two distinct counts in one aggregate would shuffle every row once for each: loads are counted from
    # one row per load, ids by themselves
    by_load = loaded.groupBy("fecha_carga").agg(
        F.count(F.lit(1)).alias("filas"), F.min("id_defuncion").alias("id_min"), F.max("id_defuncion").alias("id_max"),
        F.sum("total_casos").alias("total_casos"))
    whole = by_load.agg(F.coalesce(F.sum("filas"), F.lit(0)).cast("bigint").alias("filas"), F.min("id_min").alias("id_min"),
                        F.max("id_max").alias("id_max"), F.sum("total_casos").cast("bigint").alias("total_casos"),
                        F.count("fecha_carga").cast("bigint").alias("cargas"))
    ids = loaded.agg(F.countDistinct("id_defuncion").cast("bigint").alias("ids_distintos"))
    return whole.crossJoin(F.broadcast(ids)).select("filas", "id_min", "id_max", "ids_distintos", "total_casos", "cargas")


def _facts(st, dim):
    t, g, c, p = dim("dim_tiempo"), dim("dim_geografia_gt"), dim("dim_causa_cie10"), dim("dim_geografia_mundial")
    age, src = dim("dim_grupo_etario"), dim("dim_fuente")
    return {"fact_defunciones_gt": H.fact_deaths(st["deaths"], t, g, c, age, src),
            "fact_morbimortalidad_mec": H.fact_cases(st["cases"], t, g, c, age, min_year=FACT_CASES_MIN_YEAR),
            "fact_mortalidad_covid_gt": H.fact_covid_local(st["covid_local"], t, g, c, src),
            "fact_mortalidad_mundial": H.fact_mortality_world(st["world"], t, p),
            "fact_covid_mundial": H.fact_covid_world(st["covid_world"], t, p)}


@query("contract_tables")
def q_contract_tables(spark, d):
    """K6/K2: the twelve tables loaded through their contracts, then one bad load of each
    fact (a row of an unknown time), which must leave the version that is current. Per
    table: rows, violations, violations that the bad load names."""
    from vitals.plans.contracts import CONTRACTS, ContractError, check
    from vitals.plans.load import load_dimensions, load_fact
    from vitals.session import scratch_path
    from vitals.sources import layers
    root = scratch_path(spark, "dw")
    st = _stages(spark, d, "deaths", "cases", "covid_local", "world", "covid_world")
    load_dimensions(spark, root, _built_from(spark, st))
    held = {name: layers.read_table(spark, root, "dw", name) for name in CONTRACTS if name.startswith("dim_")}
    rows = []
    for name, fb in _facts(st, held.get).items():
        loaded = load_fact(fb.fact, root, name, CONTRACTS[name].id_col)
        lost = fb.fact.unionByName(fb.fact.limit(1).withColumn("id_tiempo", F.lit(-1)))
        named = 0
        try:
            load_fact(lost, root, name, CONTRACTS[name].id_col)
        except ContractError as e:
            named = sum(n for _, _, n in e.violations)
        held[name] = layers.read_table(spark, root, "dw", name)
        if held[name].inputFiles() != loaded.inputFiles():
            raise AssertionError("a bad load must leave the current version")
        rows.append((name, named))
    named = dict(rows)
    out = None
    for name, table in held.items():
        one = check(table, CONTRACTS[name], held).agg(
            F.lit(name).alias("tabla"), F.sum("infracciones").cast("bigint").alias("infracciones"))
        one = one.crossJoin(table.agg(F.count(F.lit(1)).cast("bigint").alias("filas"))).withColumn("avisos", F.lit(named.get(name, 0)).cast("bigint"))
        out = one if out is None else out.unionByName(one)
    return out


@query("geo_versions")
def q_geo_versions(spark, d):
    """The geography loaded twice, the second time some departments are
    of another region from 1998 on; a fact loaded afterwards keeps its rows and takes
    the version of its date. Deaths per year and region as the fact sees them."""
    from vitals.plans.load import load_dimensions, load_fact
    from vitals.session import scratch_path
    from vitals.sources import layers
    root = scratch_path(spark, "dw")
    sd = _stages(spark, d, "deaths")["deaths"]
    # the places are written: the loads' aggregates over them would otherwise read (and sort) all stage rows again
    places = materialize(D.geo_members(deaths=sd), "places")
    members = D.dim_geo(places, dt.date(1990, 1, 1), numbered=False)
    key = ["nombre_departamento", "nombre_municipio"]
    load_dimensions(spark, root, {"dim_geografia_gt": (members, key, "id_geografia", False)})
    moved = members.withColumn("region", F.when(F.col("nombre_departamento").startswith(GEO_MOVED), F.lit("Otra")).otherwise(F.col("region")))
    load_dimensions(spark, root, {"dim_geografia_gt": (moved, key, "id_geografia", False)}, as_of=dt.date(1998, 1, 1))
    geo = layers.read_table(spark, root, "dw", "dim_geografia_gt")
    t, c = _dim_time({"deaths": sd}), D.dim_cause(spark, deaths=sd)
    fact = load_fact(H.fact_deaths(sd, t, geo, c, C.age_group_df(spark), C.source_df(spark)).fact, root, "fact_defunciones_gt", "id_defuncion")
    return (fact.join(geo.select("id_geografia", "region", "version"), "id_geografia").join(t.select("id_tiempo", "anio"), "id_tiempo")
            .groupBy("anio", "region", "version").agg(F.sum("total_casos").cast("bigint").alias("total_casos")))


@query("replicate_verify")
def q_replicate_verify(spark, d):
    """Three tables copied, one row of the copied orders altered and the regions
    of the copy short of one: digests and keys tell which tables differ."""
    from vitals.session import scratch_path
    from vitals.sources import layers
    src, dst = scratch_path(spark, "cloud"), scratch_path(spark, "local")
    names = ["region", "nation", "orders", "customer"]
    for name in names:
        layers.write_replace(A.read(spark, d, name), src, "dw", name)
    layers.replicate(spark, src, dst, "dw", dims=names[:2], facts=names[2:])
    o = layers.read_table(spark, dst, "dw", "orders")
    one = o.agg(F.max("o_orderkey")).first()[0]
    layers.write_replace(o.withColumn("o_totalprice", F.when(F.col("o_orderkey") == one, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))), dst, "dw", "orders")
    layers.write_replace(layers.read_table(spark, dst, "dw", "region").where("r_regionkey <> 1"), dst, "dw", "region")
    report = layers.verify_replica(spark, src, dst, "dw", {"region": ["r_regionkey"], "nation": ["n_nationkey"], "orders": ["o_orderkey"], "customer": ["c_custkey"]},
                                   {"nation": [("n_regionkey", "region", "r_regionkey")], "customer": [("c_nationkey", "nation", "n_nationkey")]})
    return report.select("tabla", "filas_origen", "filas_destino", F.size("cubetas_distintas").cast("bigint").alias("cubetas_distintas"), "claves_rotas", "estado")
