"""Excess-mortality classifier (M4–M12) with pyspark.ml, plus evaluation marts.

The training set is entity × month rows (bounded by geography × calendar).
Only model parameters, per-feature scaling constants and a handful of metric
rows reach the driver. Evaluation is one aggregate of confusion counters for
all thresholds at once (no join, no per-threshold pass).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitals.functions import rules as R
from vitals.operators.keys import sequential_ids
from vitals.session import scratch_path


def feature_table(labelled: DataFrame, features: list[str], target: str = "exceso_mortalidad") -> DataFrame:
    """M4: the feature columns and the label, rows with any NULL dropped."""
    return labelled.select(*features, target).dropna()


def stratified_split(df: DataFrame, label: str, order: Column, test_fraction: float = 0.25,
                     name: str = "conjunto") -> DataFrame:
    """M5: exact per-class split: ceil(fraction · n) rows go to test, each class
    giving its proportional share rounded down, the largest remainders (then the
    smallest label) giving one more. Within a class rows are ranked by
    ``order`` (a deterministic pseudo-random key) and the first ones go to test. Ranking is a range-partitioned sort with partition offsets
    (``sequential_ids``), not a window holding a whole class in one task."""
    keyed = df.withColumn("_ord", order)
    pos = sequential_ids(keyed, "_pos", [label, "_ord"])
    stats = pos.groupBy(label).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per class from here on
    every = Window.partitionBy()
    share = F.ceil(F.sum("_n").over(every) * F.lit(test_fraction)) * F.col("_n") / F.sum("_n").over(every)
    stats = stats.withColumn("_down", F.floor(share)).withColumn("_part", share - F.floor(share))
    wanted = F.ceil(F.sum("_n").over(every) * F.lit(test_fraction))
    stats = (stats.withColumn("_left", wanted - F.sum("_down").over(every))
             .withColumn("_test", F.col("_down") + (F.row_number().over(Window.partitionBy().orderBy(F.desc("_part"), label))
                                                    <= F.col("_left")).cast("int")))
    out = pos.join(F.broadcast(stats), label)
    rank = F.col("_pos") - F.col("_first") + 1
    test = rank <= F.col("_test")
    return out.withColumn(name, F.when(test, F.lit("test")).otherwise(F.lit("train"))).select(*df.columns, name)


def with_balanced_weights(train: DataFrame, label: str, weight: str = "w") -> DataFrame:
    """sklearn class_weight='balanced': w_c = n / (n_classes · n_c).

    The window runs over the per-class count frame (one row per class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    every = Window.partitionBy()
    stats = (counts.withColumn("_n", F.sum("_nc").over(every))
             .withColumn("_k", F.count(F.lit(1)).over(every)))
    return (train.join(F.broadcast(stats), label)
            .withColumn(weight, F.col("_n") / (F.col("_k") * F.col("_nc"))).drop("_nc", "_n", "_k"))


def predict(pipeline: PipelineModel, df: DataFrame, proba: str = "probabilidad_exceso") -> DataFrame:
    """``df`` scored by a fitted or loaded pipeline."""
    return pipeline.transform(df).withColumn(proba, vector_to_array(F.col("probability"))[1])


@dataclass
class FittedModel:
    pipeline: PipelineModel
    means: dict[str, float]
    stds: dict[str, float]
    categorical: list[str]
    numeric: list[str]

    def scaling(self) -> SQLTransformer:
        """Population-std scaling (sklearn StandardScaler) with the training
        constants, as a stage, so that a saved pipeline holds them."""
        terms = [f"(CAST(`{c}` AS DOUBLE) - ({self.means[c]!r}D)) / ({self.stds[c] or 1.0!r}D) AS `_z_{c}`" for c in self.numeric]
        return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")

    def transform(self, df: DataFrame, proba: str = "probabilidad_exceso") -> DataFrame:
        return predict(self.pipeline, df, proba)

    def feature_names(self) -> list[str]:
        names = []
        for stage, c in zip(self.pipeline.stages[:len(self.categorical)], self.categorical):
            names += [f"{c}={lab}" for lab in stage.labels]  # unknown bucket dropped (dropLast)
        return names + self.numeric


def fit_logreg(train: DataFrame, categorical: list[str], numeric: list[str], label: str = "exceso_mortalidad",
               c_reg: float = 1.0, max_iter: int = 1000, tol: float = 1e-10) -> FittedModel:
    """M6/M7: one-hot (unknown → zeros) + standard scaling + L2 logistic regression,
    balanced class weights. sklearn minimises C·Σ wᵢ·lossᵢ + ½‖β‖²; Spark minimises
    (Σ wᵢ·lossᵢ)/Σw + ½·λ‖β‖², so λ = 1 / (C·Σw)."""
    weighted = with_balanced_weights(train, label)
    row = weighted.agg(*[F.avg(c).alias(f"m_{c}") for c in numeric],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric],
                       F.sum("w").alias("_sw")).first()
    means = {c: float(row[f"m_{c}"]) for c in numeric}
    stds = {c: float(row[f"s_{c}"] or 0.0) for c in numeric}
    indexers = [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc")
                for c in categorical]
    encoder = OneHotEncoder(inputCols=[f"_i_{c}" for c in categorical], outputCols=[f"_o_{c}" for c in categorical],
                            dropLast=True)  # the unknown bucket (last index) is dropped → zeros
    assembler = VectorAssembler(inputCols=[f"_o_{c}" for c in categorical] + [f"_z_{c}" for c in numeric],
                                outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="w", maxIter=max_iter, tol=tol,
                            regParam=1.0 / (c_reg * float(row["_sw"])), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True)
    fm = FittedModel(None, means, stds, categorical, numeric)  # type: ignore[arg-type]
    model = Pipeline(stages=[*indexers, encoder, fm.scaling(), assembler, lr]).fit(
        weighted.withColumn(label, F.col(label).cast("double")))
    # persist and reload: the reloaded model is what scoring ships to executors
    # (a freshly fitted one drags its training summary and session along)
    path = scratch_path(train.sparkSession, "logreg")
    model.write().save(path)
    fm.pipeline = PipelineModel.load(path)
    return fm


def optimality(fm: FittedModel, train: DataFrame, label: str = "exceso_mortalidad", c_reg: float = 1.0) -> DataFrame:
    """Per feature and for the intercept, the training rows in which it is not
    zero and the gradient of C·Σ wᵢ·lossᵢ + ½‖β‖² at the fitted coefficients, which is
    zero at the optimum; one pass, summed per feature in the engine."""
    lr = fm.pipeline.stages[-1]
    scored = fm.transform(with_balanced_weights(train, label), "_p")
    pull = F.col("w") * (F.col("_p") - F.col(label).cast("double"))
    parts = scored.select(pull.alias("_r"), F.posexplode(F.concat(vector_to_array("features"), F.array(F.lit(1.0)))).alias("_j", "_x"))
    names = [*fm.feature_names(), "intercepto"]
    known = train.sparkSession.createDataFrame(
        [(j, n, float(b) / c_reg) for j, (n, b) in enumerate(zip(names, [*lr.coefficients.toArray(), 0.0], strict=True))], "_j int, caracteristica string, _b double")
    sums = parts.groupBy("_j").agg(F.count_if(F.col("_x") != 0).cast("bigint").alias("filas"), F.sum(F.col("_r") * F.col("_x")).alias("_s"))
    return sums.join(F.broadcast(known), "_j").select("caracteristica", "filas", (F.col("_s") + F.col("_b")).alias("gradiente"))


def coefficients(spark, fm: FittedModel) -> DataFrame:
    """One row per model feature plus the intercept."""
    lr = fm.pipeline.stages[-1]
    rows = [(n, float(v)) for n, v in zip(fm.feature_names(), lr.coefficients.toArray())]
    rows.append(("intercepto", float(lr.intercept)))
    return spark.createDataFrame(rows, "caracteristica string, coeficiente double")


def confusion_counts(scored: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """tn/fp/fn/tp for every threshold in one aggregate, then one row per threshold."""
    y = F.col(label) == 1
    aggs = []
    for i, t in enumerate(thresholds):
        p = F.col(score) >= t
        aggs += [F.count_if(~y & ~p).alias(f"tn{i}"), F.count_if(~y & p).alias(f"fp{i}"),
                 F.count_if(y & ~p).alias(f"fn{i}"), F.count_if(y & p).alias(f"tp{i}")]
    row = scored.agg(*aggs)
    parts = [F.struct(F.lit(t).alias("umbral"), F.col(f"tn{i}").cast("bigint").alias("verdaderos_negativos"),
                      F.col(f"fp{i}").cast("bigint").alias("falsos_positivos"),
                      F.col(f"fn{i}").cast("bigint").alias("falsos_negativos"),
                      F.col(f"tp{i}").cast("bigint").alias("verdaderos_positivos"))
             for i, t in enumerate(thresholds)]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def threshold_sweep(scored: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero_division = 0) per threshold."""
    c = confusion_counts(scored, label, score, thresholds)
    tn, fp, fn, tp = (F.col(x) for x in ("verdaderos_negativos", "falsos_positivos",
                                         "falsos_negativos", "verdaderos_positivos"))
    return c.select("umbral",
                    R.safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    R.safe_ratio(tp, tp + fp).alias("precision"),
                    R.safe_ratio(tp, tp + fn).alias("recall"),
                    R.safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    "verdaderos_negativos", "falsos_positivos", "falsos_negativos", "verdaderos_positivos")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest F1; the first (lowest) wins ties."""
    return sweep.orderBy(F.desc("f1"), F.asc("umbral")).limit(1)


def classification_report(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """M8: per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion_counts(scored, label, score, [threshold])
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("verdaderos_negativos", "falsos_positivos",
                                                        "falsos_negativos", "verdaderos_positivos"))
    p0, r0, f0 = R.safe_ratio(tn, tn + fn), R.safe_ratio(tn, tn + fp), R.safe_ratio(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = R.safe_ratio(tp, tp + fp), R.safe_ratio(tp, tp + fn), R.safe_ratio(2 * tp, 2 * tp + fp + fn)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    acc = R.safe_ratio(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("clase"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("bigint").alias("soporte"))

    rows = [row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
            row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
            row("weighted avg", R.safe_ratio(p0 * s0 + p1 * s1, n), R.safe_ratio(r0 * s0 + r1 * s1, n),
                R.safe_ratio(f0 * s0 + f1 * s1, n), n)]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def save(fm: FittedModel, path: str) -> None:
    """K7: the whole pipeline, scaling constants included."""
    fm.pipeline.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(requests: DataFrame, pipeline: PipelineModel, baseline: DataFrame, keys: list[str],
          threshold: float = 0.5) -> DataFrame:
    """Request rows, the baseline of their ``keys`` looked up, scored by a
    saved model; requests without a baseline keep NULL scores."""
    looked = requests.join(baseline, keys, "left")
    numeric = [c for c in baseline.columns if c not in keys]
    known = looked.dropna(subset=numeric)
    scored = predict(pipeline, known).withColumn("pred_exceso", (F.col("probabilidad_exceso") >= threshold).cast("int"))
    out = scored.select(*looked.columns, "probabilidad_exceso", "pred_exceso")
    missing = None
    for c in numeric:
        missing = F.col(c).isNull() if missing is None else missing | F.col(c).isNull()
    return out.unionByName(looked.where(missing), allowMissingColumns=True)
