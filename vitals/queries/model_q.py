"""Model queries: features, split, training, scoring, evaluation marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitals import adapter as A
from vitals import catalogues as C
from vitals.plans import marts as M
from vitals.plans import model as ML
from vitals.queries import query
from vitals.queries.marts import labelled_by_nation
from vitals.session import scratch_path

FEATURES = ["municipio", "region", "anio", "mes", "promedio_pre_covid", "desviacion_pre_covid"]
CATEGORICAL = ["municipio", "region"]
NUMERIC = ["anio", "mes", "promedio_pre_covid", "desviacion_pre_covid"]


def _features(spark, d):
    return ML.feature_table(labelled_by_nation(spark, d), FEATURES)


def _split(spark, d):
    key = F.md5(F.concat_ws("|", F.col("municipio"), F.col("anio").cast("string"), F.col("mes").cast("string")))
    return ML.stratified_split(_features(spark, d), "exceso_mortalidad", key, 0.25)


def _trained(spark, d):
    split = _split(spark, d)
    fm = ML.fit_logreg(split.where(F.col("conjunto") == "train"), CATEGORICAL, NUMERIC)
    return fm, split


def _scored_documents(spark, d):
    """Labelled documents with a score derived from their length (for the evaluation marts)."""
    docs = A.read(spark, d, "documents").select("doc_id", "lang", "n_chars")
    lab = A.read(spark, d, "labels").select("doc_id", "quality")
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("lang").alias("region"), F.col("quality").alias("real"),
        ((F.col("n_chars") % 100) / 100.0).alias("probabilidad_exceso"))


@query("feature_table")
def q_feature_table(spark, d):
    return M.round_doubles(_features(spark, d))


@query("stratified_split")
def q_stratified_split(spark, d):
    return _split(spark, d).select("municipio", "anio", "mes", "exceso_mortalidad", "conjunto")


@query("train_logreg")
def q_train_logreg(spark, d):
    fm, split = _trained(spark, d)
    test = fm.transform(split.where(F.col("conjunto") == "test"))
    return M.round_doubles(test.select(
        "municipio", "anio", "mes", "exceso_mortalidad", "probabilidad_exceso",
        (F.col("probabilidad_exceso") >= 0.5).cast("int").alias("pred_exceso")))


@query("coefficients")
def q_coefficients(spark, d):
    fm, _ = _trained(spark, d)
    return ML.coefficients(spark, fm)


@query("model_optimality")
def q_model_optimality(spark, d):
    """Every feature of the fitted model with its training rows, and whether
    the gradient of the objective vanishes there."""
    fm, split = _trained(spark, d)
    found = ML.optimality(fm, split.where(F.col("conjunto") == "train"))
    return found.select("caracteristica", "filas", (F.abs("gradiente") < 1e-4).alias("optimo"))


@query("score_scenario")
def q_score_scenario(spark, d):
    """Scenario rows for the last data year: entity attributes + baseline looked up +
    the actual count when present, scored by the trained model."""
    fm, _ = _trained(spark, d)
    lab = labelled_by_nation(spark, d)
    year = A.TEST_YEARS[1]
    requests = lab.select("municipio", "region", "mes", "promedio_pre_covid", "desviacion_pre_covid").distinct() \
        .withColumn("anio", F.lit(year))
    actual = lab.where(F.col("anio") == year).select("municipio", "mes", "muertes_observadas")
    base = requests.select("municipio", "region", "mes", "promedio_pre_covid", "desviacion_pre_covid")
    asked = requests.select("municipio", "region", "mes", "anio").join(actual, ["municipio", "mes"], "left")
    scored = ML.score(asked, fm.pipeline, base, ["municipio", "region", "mes"])
    return M.round_doubles(scored.select(
        "municipio", "anio", "mes", "promedio_pre_covid", "muertes_observadas", "probabilidad_exceso", "pred_exceso"))


@query("model_artifacts")
def q_model_artifacts(spark, d):
    fm, split = _trained(spark, d)
    root = scratch_path(spark, "model")
    test = fm.transform(split.where(F.col("conjunto") == "test"))
    sweep = ML.threshold_sweep(test, "exceso_mortalidad", "probabilidad_exceso", C.SWEEP_THRESHOLDS)
    sweep.write.option("header", True).csv(f"{root}/umbrales")
    ML.coefficients(spark, fm).write.json(f"{root}/coeficientes")
    base = labelled_by_nation(spark, d).select("municipio", "mes", "promedio_pre_covid",
                                               "desviacion_pre_covid").distinct()
    base.write.parquet(f"{root}/linea_base")
    ML.save(fm, f"{root}/modelo")
    ML.confusion_counts(test, "exceso_mortalidad", "probabilidad_exceso", C.SWEEP_THRESHOLDS).write.option(
        "header", True).csv(f"{root}/confusion")
    spark.createDataFrame([(CATEGORICAL, NUMERIC, "exceso_mortalidad", fm.means, fm.stds)],
                          "categoricas array<string>, numericas array<string>, objetivo string, medias map<string,double>, "
                          "desviaciones map<string,double>").coalesce(1).write.json(f"{root}/configuracion")
    # the reloaded model scores the test rows on its own
    again = ML.predict(ML.load(f"{root}/modelo"), split.where(F.col("conjunto") == "test"))
    scored = again.where(F.col("probabilidad_exceso").between(0, 1)).count()
    counts = [("umbrales", "csv", spark.read.option("header", True).csv(f"{root}/umbrales").count()),
              ("coeficientes", "json", spark.read.json(f"{root}/coeficientes").count()),
              ("linea_base", "parquet", spark.read.parquet(f"{root}/linea_base").count()),
              ("confusion", "csv", spark.read.option("header", True).csv(f"{root}/confusion").count()),
              ("configuracion", "json", spark.read.json(f"{root}/configuracion").count()),
              ("modelo", "pipeline", scored)]
    return spark.createDataFrame(counts, "artefacto string, formato string, filas bigint")


@query("threshold_sweep")
def q_threshold_sweep(spark, d):
    sweep = ML.threshold_sweep(_scored_documents(spark, d), "real", "probabilidad_exceso", C.SWEEP_THRESHOLDS)
    return M.round_doubles(sweep)


@query("best_threshold")
def q_best_threshold(spark, d):
    sweep = ML.threshold_sweep(_scored_documents(spark, d), "real", "probabilidad_exceso", C.SWEEP_THRESHOLDS)
    return M.round_doubles(ML.best_threshold(sweep))


@query("classification_report")
def q_classification_report(spark, d):
    return M.round_doubles(ML.classification_report(_scored_documents(spark, d), "real", "probabilidad_exceso", 0.5))


@query("predicted_by_region")
def q_predicted_by_region(spark, d):
    scored = _scored_documents(spark, d).withColumn(
        "pred_exceso", (F.col("probabilidad_exceso") >= 0.5).cast("int"))
    return M.round_doubles(M.predicted_by_region(scored))
