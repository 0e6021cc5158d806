"""Scale behaviour: a key holding a third of the rows is split (joins) or
reduced map-side (aggregates); broadcasts follow the size checks."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from vitals.operators import dedup, lookup


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_join_is_split(spark, skew_conf):
    n = 300_000
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                F.col("id").alias("v"))
    small = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = big.join(small, "k")
    assert len(joined.collect()) == n  # runs this plan, so explain() shows AQE's final plan
    assert "skew=true" in plan_text(joined)


def test_hot_key_dedup_reduced_map_side(spark):
    n = 90_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("pos"), (F.col("id") * 10).alias("x"))
    out = dedup.keep_first(df, ["k"], ["pos"])
    rows = {r.k: (r.pos, r.x) for r in out.collect()}
    assert rows[0] == (0, 0) and len(rows) == 1 + (n - n // 3)
    text = plan_text(out)
    assert "partial_min" in text  # combined before the exchange


def test_broadcast_only_after_size_check(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan_text(big.join(lookup.bounded(small, max_rows=100), "k"))
    assert "BroadcastHashJoin" not in plan_text(small.join(lookup.bounded(big, max_rows=100), "k"))


def test_stage_jobs_are_compiled(spark, sf_small, capsys):
    """A generated method above 8000 bytes is interpreted by a JVM without further options
    (F4 to F15): no method of the stage jobs, as the warehouse reads them, is that long."""
    import re

    from vitals.queries import warehouse_q as W
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("deaths", "cases"):
            stage = W._lazy(spark, sf_small, name)[name].select(*W.READ[name])
            capsys.readouterr()
            stage.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 8000, (name, max(sizes))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_stage_deaths_looks_up_only_what_is_read(spark, sf_small):
    """Columns of the stage table asked for are those of the whole one, with one join per label read."""
    from vitals.queries import stage_q as SQ
    from vitals.queries import warehouse_q as W
    whole, some = SQ.stage_deaths_df(spark, sf_small), SQ.stage_deaths_df(spark, sf_small, W.READ["deaths"])
    assert some.columns == W.READ["deaths"]
    assert some.exceptAll(whole.select(*some.columns)).count() == 0 == whole.select(*some.columns).exceptAll(some).count()
    joins = [f._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") for f in (some, whole)]
    assert joins == [4, 9]


def test_stage_tables_hold_only_what_their_query_reads(spark, sf_small, monkeypatch):
    """A stage table written for a query has no column that none of its plans reads."""
    from vitals.queries import load_all
    from vitals.queries import warehouse_q as W
    written, materialize = {}, W.materialize
    monkeypatch.setattr(W, "materialize", lambda df, name: written.update({name: df.columns}) or materialize(df, name))
    load_all()["fk_null_report"](spark, sf_small)
    assert written["stage-cases"] == ["anio", "codigo_cie10", "diagnostico"]
    assert "descripcion_causa" not in written["stage-deaths"] and len(written["stage-deaths"]) == 8
    written.clear()
    load_all()["dim_static"](spark, sf_small)
    assert written == {"stage-deaths": ["sexo", "grupo_etario"], "stage-cases": ["anio"]}


def test_code_rule_of_the_cases_is_computed_once(spark, sf_small):
    """The chapter reads the code as a column: the rule behind it is not repeated at each mention."""
    from vitals.queries import stage_q as SQ
    plan = SQ.stage_cases_df(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS _codigo") == 1


def test_causes_are_written_before_they_are_tested(spark, sf_small, monkeypatch):
    """the dimension reads distinct (code, text) pairs, so its test for NULL codes does not
    go down to the scans, where it repeats the rule behind the code for every row."""
    from vitals.queries import load_all
    from vitals.queries import warehouse_q as W
    written, materialize = {}, W.materialize
    monkeypatch.setattr(W, "materialize", lambda df, name: written.setdefault(name, materialize(df, name)))
    assert load_all()["dim_cause"](spark, sf_small).count() > 0
    assert {n: f.columns for n, f in written.items()} == {"causes-cases": ["codigo_cie10", "diagnostico"],
                                                          "causes-deaths": ["codigo_cie10", "descripcion_causa"]}
    assert all(f.count() == f.distinct().count() for f in written.values())


def test_a_fact_loaded_twice_is_built_once(spark, sf_small, monkeypatch):
    """both loads read the written fact, and no row is shuffled once per distinct count."""
    from vitals.plans import load as L
    from vitals.queries import load_all
    plans, load_fact = [], L.load_fact
    monkeypatch.setattr(L, "load_fact", lambda fact, *a, **k: plans.append(
        fact._jdf.queryExecution().optimizedPlan().toString()) or load_fact(fact, *a, **k))
    out = load_all()["load_fact"](spark, sf_small)
    assert len(plans) == 2 and not any("Aggregate" in p or "Join" in p for p in plans)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    row = out.first()
    assert row.filas == row.ids_distintos == row.id_max and row.id_min == 1 == row.cargas and out.count() == 1


def test_places_are_written_before_they_are_loaded(spark, sf_small, monkeypatch):
    """the loads of the geography read its places, not the stage rows: an aggregate over the
    members would replace their distinct and sort every stage row."""
    from vitals.plans import load as L
    from vitals.queries import load_all
    read, load_dimensions = [], L.load_dimensions
    monkeypatch.setattr(L, "load_dimensions", lambda s, root, built, *a, **k: read.extend(
        f for frame, *_ in built.values() for f in frame.inputFiles()) or load_dimensions(s, root, built, *a, **k))
    load_all()["geo_versions"](spark, sf_small).count()
    assert read and all("/places-" in f for f in read)
