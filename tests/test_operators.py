"""Operator invariants: dedup, ids, upsert, SCD2, reshape, quality, sources."""

import datetime as dt

from pyspark.sql import functions as F

from vitals.operators import dedup, quality, reshape
from vitals.operators.keys import sequential_ids
from vitals.operators.upsert import scd2_merge, upsert_ignore
from vitals.session import scratch_path
from vitals.sources import files


def test_keep_first(spark):
    df = spark.createDataFrame([("Guatemala", "2021-05-10", 2, 1), ("Guatemala", "2021-05-10", 2, 0),
                                ("Mixco", "2021-05-10", 1, 2)], "m string, f string, n int, pos int")
    out = dedup.keep_first(df, ["m", "f"], ["pos"]).orderBy("m").collect()
    assert [(r.m, r.pos) for r in out] == [("Guatemala", 0), ("Mixco", 2)]


def test_sequential_ids_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    out = sequential_ids(df, "sk", ["k"]).collect()
    pairs = sorted((r.k, r.sk) for r in out)
    assert [sk for _, sk in pairs] == list(range(1, 1001))


def test_upsert_idempotent(spark):
    first = upsert_ignore(None, spark.createDataFrame([(2020, 1), (2020, 2)], "anio int, mes int"),
                          ["anio", "mes"], "id")
    full = spark.createDataFrame([(2019, 12), (2020, 1), (2020, 2), (2020, 3)], "anio int, mes int")
    once = upsert_ignore(first, full, ["anio", "mes"], "id")
    twice = upsert_ignore(once, full, ["anio", "mes"], "id")
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in twice.collect())
    assert a == b
    ids = {(r.anio, r.mes): r.id for r in once.collect()}
    assert ids[(2020, 1)] == 1 and ids[(2020, 2)] == 2 and ids[(2019, 12)] == 3 and ids[(2020, 3)] == 4


def test_scd2(spark):
    cur = spark.createDataFrame(
        [(1, "a", "x", dt.date(2015, 1, 1), None, True, 1), (2, "b", "y", dt.date(2015, 1, 1), None, True, 1)],
        "id long, k string, v string, fecha_inicio_vigencia date, fecha_fin_vigencia date, "
        "es_version_actual boolean, version int")
    inc = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "w")], "k string, v string")
    out = scd2_merge(cur, inc, ["k"], ["v"], dt.date(2020, 1, 1), "id").collect()
    rows = sorted((r.k, r.v, r.version, r.es_version_actual, r.fecha_fin_vigencia) for r in out)
    assert rows == [("a", "x", 1, True, None), ("b", "y", 1, False, dt.date(2019, 12, 31)),
                    ("b", "z", 2, True, None), ("c", "w", 1, True, None)]
    assert sorted(r.id for r in out) == [1, 2, 3, 4]


def test_weekly_to_monthly_golden(spark):
    rows = [(dt.date(2021, 1, d), "GT", n, c, dd, cd) for d, n, c, dd, cd in
            [(3, 100, 10000, 5, 300), (10, 150, 10150, 7, 307), (17, 120, 10270, 6, 313), (24, 130, 10400, 4, 317)]]
    df = spark.createDataFrame(rows, "fecha date, pais string, nc long, cc long, nd long, cd long")
    out = reshape.weekly_to_monthly(df, ["pais"], "fecha", ["nc", "nd"], ["cc", "cd"]).first()
    assert (out.nc_mes, out.nd_mes, out.cc_fin, out.cd_fin, out.semanas_reporte) == (500, 22, 10400, 317, 4)


def test_unpivot_golden(spark):
    df = spark.createDataFrame([("GUATEMALA", 1205668, 2, 1, 0)],
                               "municipio string, poblacion long, `2020-03-15` long, `2020-03-21` long, `2020-03-22` long")
    out = reshape.wide_to_long(df, ["municipio", "poblacion"]).orderBy("fecha").collect()
    assert [(str(r.fecha), r.n) for r in out] == [("2020-03-15", 2), ("2020-03-21", 1)]


def test_discard_report(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", 0), ("c", 3)], "c string, n int")
    rep = quality.discard_report(df, [("c", F.col("c").isNotNull()), ("n", F.col("n") > 0)]).collect()
    assert [(r.paso, r.filas_antes, r.descartadas, r.filas_despues) for r in rep] == [(1, 4, 1, 3), (2, 3, 2, 1)]


def test_json_array_roundtrip(spark):
    df = spark.range(0, 100).repartition(3).select(F.col("id"), (F.col("id") * 2).alias("y"))
    path = scratch_path(spark, "t-json")
    files.write_json_arrays(df, path)
    for p in files.data_files(spark, path):
        text = open(p.replace("file:", "")).read()
        assert text.startswith("[") and text.rstrip().endswith("]")
    back = files.read_json_array(spark, path, df.schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_bom_and_html(spark):
    assert files.strip_bom(spark.createDataFrame([(1,)], "`﻿Año` int")).columns == ["Año"]
    df = spark.createDataFrame([("<!DOCTYPE html><p>",), ("  <HTML>",), ("plain",)], "t string")
    ok, bad = files.quarantine(df, "t")
    assert ok.count() == 1 and bad.count() == 2


def test_contract_report(spark):
    df = spark.createDataFrame([(None, "abcdefgh"), (1, "ab")], "a int, b string")
    rep = {(r.columna, r.regla): r.infracciones for r in quality.contract_report(
        df, [("a", "int", False, None), ("b", "string", True, 3), ("z", "int", True, None)]).collect()}
    assert rep == {("a", "tipo"): 0, ("a", "nulos"): 1, ("b", "tipo"): 0, ("b", "longitud"): 1, ("z", "faltante"): 1}


def test_fact_options(spark):
    from vitals import catalogues as C
    from vitals.plans import dims as D
    from vitals.plans import facts as H
    st = spark.createDataFrame(
        [(dt.date(2021, 3, 1), 2021, 3, "Guatemala", "Mixco", 100000, 2, 2.0, "COVID"),
         (dt.date(2021, 3, 2), 2021, 3, "Guatemala", "Mixco", 100000, 3, 3.0, "COVID")],
        "fecha_fallecimiento date, anio int, mes int, departamento string, municipio string, poblacion long, "
        "fallecidos long, tasa_por_100k double, periodo string")
    dt_ = D.dim_time(D.time_members(covid_local=st))
    dg = D.dim_geo(D.geo_members(covid_local=st))
    dc = D.dim_cause(spark)
    pub = H.fact_covid_local(st, dt_, dg, dc, C.source_df(spark)).fact.first()
    mon = H.fact_covid_local(st, dt_, dg, dc, C.source_df(spark), rate="monthly").fact.first()
    assert float(pub.tasa_por_100k) == 3.0 and float(mon.tasa_por_100k) == 5.0
    w = spark.createDataFrame([("GTM", 2020, None, 10, 5.0, "weekly", "WORLD_MORTALITY", "COVID")],
                              "iso3c string, anio int, mes int, semana int, deaths double, time_unit string, "
                              "fuente string, periodo string")
    members = spark.createDataFrame([(2020, 3), (2020, 0)], "anio int, mes int")
    dtw = D.dim_time(members)
    dp = D.dim_country(world=w.withColumn("country_name", F.lit("Guatemala")))
    default = H.fact_mortality_world(w, dtw, dp).fact.join(dtw, "id_tiempo").first()
    mapped = H.fact_mortality_world(w, dtw, dp, weeks_to_month=True).fact.join(dtw, "id_tiempo").first()
    assert default.mes == 0 and mapped.mes == 3


def _write_wide(spark, n_dates):
    import datetime as _dt
    days = [(_dt.date(2020, 1, 1) + _dt.timedelta(k)).isoformat() for k in range(n_dates)]
    header = ",".join(["codigo", "municipio", *days])
    vals = ["2" if k % 3 == 0 else ("" if k % 3 == 1 else "0") for k in range(n_dates)]
    lines = [header, "1,\"San Juan, Sac.\"," + ",".join(vals), "2,Mixco," + ",".join(vals)]
    path = scratch_path(spark, "t-wide")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path, days


def test_wide_csv_to_long(spark):
    path, days = _write_wide(spark, 10)
    out = reshape.wide_csv_to_long(spark, path, 2).orderBy("codigo", "fecha").collect()
    assert [(r.codigo, r.municipio, str(r.fecha), r.n) for r in out][:2] == [
        ("1", "San Juan, Sac.", days[0], 2), ("1", "San Juan, Sac.", days[3], 2)]
    assert len(out) == 2 * 4  # cells 0, 3, 6, 9 of each line


def test_wide_csv_plan_does_not_grow(spark):
    import io
    from contextlib import redirect_stdout
    sizes = []
    for n in (10, 1000):
        path, _ = _write_wide(spark, n)
        buf = io.StringIO()
        with redirect_stdout(buf):
            reshape.wide_csv_to_long(spark, path, 2).explain()
        sizes.append(len(buf.getvalue()))
    assert sizes[1] < sizes[0] * 1.5


def test_age_text_flags(spark):
    df = spark.createDataFrame([("menor de 15",), ("< 1 año",), ("< 10",), ("45 a 49 años",), ("menor de 15",)], "g string")
    got = {r.texto: r.n for r in quality.age_text_flags(df, "g").collect()}
    assert got == {"menor de 15": 2, "< 10": 1}


def test_version_log(spark):
    import os

    from vitals.sources import layers
    root = scratch_path(spark, "t-layers")
    assert not layers.table_exists(spark, root, "dw", "t")
    v1 = layers.write_replace(spark.range(3), root, "dw", "t")
    v2 = layers.write_replace(spark.range(5), root, "dw", "t")
    assert v1 < v2 and layers.table_exists(spark, root, "dw", "t")
    assert layers.current_version(spark, root, "dw", "t") == v2
    assert layers.read_table(spark, root, "dw", "t").count() == 5
    assert os.path.isdir(f"{root}/dw/t/{v1}")  # history kept, nothing overwritten


def test_parquet_parts_tolerant(spark):
    root = scratch_path(spark, "t-parts")
    spark.range(7).write.parquet(f"{root}/ok")
    spark.createDataFrame([("<!DOCTYPE html><html><body>login</body></html>",)], "value string").write.text(f"{root}/html")
    spark.createDataFrame([("not parquet at all",)], "value string").write.text(f"{root}/junk")
    parts = files.data_files(spark, root)
    good, bad = files.read_parquet_parts_tolerant(spark, parts)
    assert good.count() == 7
    reasons = sorted(why for _, why in bad)
    assert "html" in reasons and "ilegible" in reasons
