"""The Spark logistic regression solves the same problem as the published sklearn setup."""

import numpy as np
from pyspark.sql import functions as F

from vitals.plans import model as ML


def test_logreg_matches_sklearn_objective(spark):
    rng = np.random.default_rng(7)
    n = 400
    x1, x2 = rng.normal(size=n), rng.normal(size=n) * 3 + 1
    cat = rng.choice(["a", "b", "c"], size=n)
    logit = 0.8 * x1 - 0.5 * x2 + (cat == "b") * 1.2 - 0.3
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    rows = [(str(c), float(a), float(b), int(t)) for c, a, b, t in zip(cat, x1, x2, y)]
    df = spark.createDataFrame(rows, "c string, x1 double, x2 double, y int")
    fm = ML.fit_logreg(df, ["c"], ["x1", "x2"], label="y")
    lr = fm.pipeline.stages[-1]
    beta, b0 = lr.coefficients.toArray(), lr.intercept
    # design matrix as sklearn builds it: one-hot (alphabetical) + population-std scaling
    labels = fm.pipeline.stages[0].labels
    onehot = np.array([[1.0 if c == lab else 0.0 for lab in labels] for c in cat])
    z = np.column_stack([(x1 - x1.mean()) / x1.std(), (x2 - x2.mean()) / x2.std()])
    X = np.column_stack([onehot, z])
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    p = 1 / (1 + np.exp(-(X @ beta + b0)))
    # gradient of C·Σ wᵢ·lossᵢ + ½‖β‖² (C = 1) must vanish at the optimum
    g_beta = X.T @ (w * (p - y)) + beta
    g_b0 = np.sum(w * (p - y))
    assert np.max(np.abs(g_beta)) < 1e-2 and abs(g_b0) < 1e-2
    assert np.max(np.abs(g_beta)) / np.max(np.abs(X.T @ (w * y))) < 1e-3
    # and closely: the same gradient from the engine, feature by feature, far below the loose bounds above
    told = {r.caracteristica: (r.filas, r.gradiente) for r in ML.optimality(fm, df, "y").collect()}
    want = dict(zip([*fm.feature_names(), "intercepto"], [*g_beta, g_b0]))
    assert set(told) == set(want) and all(abs(told[k][1] - want[k]) < 1e-9 for k in want)
    assert max(abs(v) for v in want.values()) < 1e-5
    assert told["c=a"][0] == int((cat == "a").sum()) and told["x1"][0] == n


def test_sweep_and_report(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.45), (0, 0.5), (0, 0.1)], "y int, s double")
    sweep = {r.umbral: r for r in ML.threshold_sweep(df, "y", "s", [0.4, 0.5, 0.95]).collect()}
    assert (sweep[0.5].verdaderos_positivos, sweep[0.5].falsos_positivos) == (1, 1)
    assert sweep[0.95].precision == 0.0  # zero_division = 0
    best = ML.best_threshold(ML.threshold_sweep(df, "y", "s", [0.4, 0.5, 0.95])).first()
    assert best.umbral == 0.4
    rep = {r.clase: r for r in ML.classification_report(df, "y", "s", 0.5).collect()}
    assert rep["1"].soporte == 2 and rep["accuracy"].f1 == 0.5


def test_stratified_split_exact(spark):
    df = spark.range(0, 103).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = ML.stratified_split(df, "y", F.md5(F.col("id").cast("string")), 0.25)
    counts = {(r.y, r.conjunto): r["count"] for r in out.groupBy("y", "conjunto").count().collect()}
    assert counts[(1, "test")] == 9 and counts[(0, "test")] == 17
