"""Loads, landing and rules on the awkward inputs of real sources."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions import rules as R
from vitals.operators.upsert import scd2_merge, upsert_ignore
from vitals.plans import facts
from vitals.plans import model as ML
from vitals.sources import files, layers

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_one_member_per_natural_key(spark):
    rows = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "z")], "k string, v string")
    assert sorted(tuple(r) for r in upsert_ignore(None, rows, ["k"], "id").select("id", "k", "v").collect()) == [(1, "A", "x"), (2, "B", "z")]


def test_scd2_repeated_key_opens_one_version(spark):
    now = spark.createDataFrame([(1, "A", "x", dt.date(2020, 1, 1), None, True, 1)],
                                "id bigint, k string, v string, fecha_inicio_vigencia date, fecha_fin_vigencia date, es_version_actual boolean, version int")
    new = spark.createDataFrame([("A", "y"), ("A", "y"), ("A", "z"), ("C", "c")], "k string, v string")
    out = scd2_merge(now, new, ["k"], ["v"], dt.date(2021, 1, 1), "id").collect()
    assert sorted((r.k, r.v, r.es_version_actual, r.version) for r in out) == [("A", "x", False, 1), ("A", "y", True, 2), ("C", "c", True, 1)]
    geo = spark.createDataFrame([(r.id, r.k, r.v, r.es_version_actual) for r in out], "id_geografia bigint, nombre_departamento string, v string, es_version_actual boolean")
    fact = spark.createDataFrame([("A", "m")], "departamento string, municipio string")
    assert facts._geo_fk(fact, geo.withColumn("nombre_municipio", F.lit("m"))).count() == 1


def test_spreadsheet_white_space_and_suffixes(spark):
    d = spark.createDataFrame([(" Guatemala ",), ("3d",), ("45F",), ("0x1p3",), (" 7.5 ",), ("1e3",), ("-.5",), ("",), (None,)], "s string")
    got = [tuple(r) for r in d.select(R.strip("s"), R.to_double("s")).collect()]
    assert got == [("Guatemala", None), ("3d", None), ("45F", None), ("0x1p3", None), ("7.5", 7.5), ("1e3", 1000.0), ("-.5", -0.5), ("", None), (None, None)]


def test_rate_rounds_ties_to_even(spark):
    assert spark.range(1).select(R.rate_per_100k(F.lit(1), F.lit(640000))).first()[0] == 0.1562


def test_drifted_headers_are_aligned(spark, tmp_path):
    texts = {"good.csv": "a,b\n1,x\n", "extra.csv": "a,b,extra\n2,y,q\n", "short.csv": "a\n3\n", "order.csv": "b,a\nz,4\n", "page.csv": "<!DOCTYPE html>\n<p>no\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    out, bad = files.read_tolerant(spark, [str(tmp_path / n) for n in texts], ["a", "b"], AB)
    assert sorted((tuple(r) for r in out.collect())) == [(1, "x"), (2, "y"), (3, None), (4, "z")]
    assert [os.path.basename(p) for p, _ in bad] == ["page.csv"]


def test_mixed_folder_with_a_pretty_printed_array(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], indent=2))
    (tmp_path / "lines.json").write_text('{"a": 3, "b": "z"}\n{"a": 4, "b": "w"}\n')
    (tmp_path / "t.csv").write_text("a,b\n5,v\n")
    (tmp_path / "t.xml").write_text("<a/>")
    out, rejected = files.read_mixed(spark, str(tmp_path), AB)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x"), (2, "y"), (3, "z"), (4, "w"), (5, "v")]
    assert [os.path.basename(p) for p in rejected] == ["t.xml"]


def test_unreadable_root_is_not_an_absent_table(spark, tmp_path):
    assert layers.table_exists(spark, str(tmp_path), "dw", "t") is False
    with pytest.raises((AnalysisException, Exception)):
        layers.table_exists(spark, "nosuchscheme://bucket", "dw", "t")


def test_run_report_tells_a_mismatch(spark, tmp_path, monkeypatch):
    def short(df, root, layer, name):
        return df.sparkSession.createDataFrame([(name, 5, 1, False)], "tabla string, filas_escritas bigint, filas_leidas bigint, coincide boolean")
    monkeypatch.setattr(layers, "write_verified", short)
    row = layers.Registry([layers.Source("s", lambda spark: spark.range(5))]).run(spark, str(tmp_path)).first()
    assert (row.estado, row.mensaje) == ("diferencia", "5 escritas, 1 leidas") and row.fin >= row.inicio


def test_saved_model_scores_requests(spark, tmp_path):
    rows = [(c, float(i), i % 3, int(i % 3 == 0)) for i, c in enumerate("ab" * 40)]
    d = spark.createDataFrame(rows, "c string, x double, m int, y int")
    ML.save(ML.fit_logreg(d, ["c"], ["x"], label="y"), str(tmp_path / "m"))
    base = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "c string, x double")
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "unseen")], "n int, c string")
    got = {r.n: (r.probabilidad_exceso, r.pred_exceso) for r in ML.score(asked, ML.load(str(tmp_path / "m")), base, ["c"]).collect()}
    assert 0 < got[1][0] < 1 and got[2][1] in (0, 1) and got[3] == (None, None)
