"""Profiles of any table: exact counts, sketches within their stated error, parts merged."""

import numpy as np
from pyspark.sql import functions as F

from vitals.operators import quality


def test_sketches_are_within_their_error(spark):
    n = 60_000
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).cast("double").alias("x"), (F.col("id") % 20_000).cast("string").alias("t"),
        F.when(F.col("id") % 3 > 0, F.lit(5)).alias("hot"), F.array("id").alias("a"), F.lit(None).cast("int").alias("none"))
    whole = {r.columna: r for r in quality.profile(df).collect()}
    parts = quality.profile_sketches(df.where("x < 1000"))
    for low in (1000, 20_000):
        parts = parts.unionByName(quality.profile_sketches(df.where(f"x >= {low}" + (" and x < 20000" if low == 1000 else ""))))
    merged = {r.columna: r for r in quality.finished(quality.merge_profiles(parts)).collect()}
    for got in (whole, merged):
        assert [got[c].filas for c in df.columns] == [n] * 5
        assert [got[c].nulos for c in df.columns] == [0, 0, n // 3, 0, n]
        for c, exact in {"x": n, "t": 20_000, "hot": 1, "a": n, "none": 0}.items():
            assert abs(got[c].distintos - exact) <= 0.06 * exact
        assert (got["x"].minimo, got["x"].maximo, got["hot"].minimo) == (0.0, n - 1.0, 5.0)
        assert np.abs(np.array(got["x"].cuantiles) / n - quality.PROFILE_QUANTILES).max() < 0.03
        assert got["hot"].cuantiles == [5.0] * 5 and got["t"].cuantiles is None and got["none"].cuantiles is None


def test_profile_of_an_empty_table(spark):
    got = quality.profile(spark.createDataFrame([], "a int, b string, c double")).collect()
    assert [(r.columna, r.filas, r.nulos, r.distintos, r.cuantiles) for r in got] == [(c, 0, 0, 0, None) for c in "abc"]
