"""Analytical marts over the warehouse: observed series, baselines, excess.

All operators are DataFrame → DataFrame. The only wide work is the first
aggregation (partial + final hash aggregate); everything after it runs on
entity × month rows, which are bounded by geography × calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitals.functions import rules as R


def monthly_observed(counts: DataFrame, entity: str = "departamento", member: str = "municipio",
                     years: tuple[int, int] = (2018, 2024), measure: str = "total_casos",
                     months: tuple[int, int] = (1, 12), approximate: bool = False) -> DataFrame:
    """Observed deaths per entity-month and members with data.

    ``months=(0, 12)`` reproduces the world notebook, which also sums the annual
    member (month 0) into the series; the default keeps calendar months only.
    ``approximate`` counts members with HyperLogLog++ (fixed-size sketches,
    no distinct-expansion shuffle) instead of the exact distinct count."""
    members = (F.approx_count_distinct(member) if approximate else F.countDistinct(member))
    return (counts
            .where(F.col("anio").between(*years) & F.col("mes").between(*months)
                   & F.col(measure).isNotNull() & F.col(entity).isNotNull())
            .groupBy(entity, "anio", "mes")
            .agg(F.sum(measure).cast("bigint").alias("muertes_observadas"),
                 members.cast("bigint").alias("municipios_con_datos")))


def star_observed(fact: DataFrame, dim_time: DataFrame, dim_geo: DataFrame,
                  years: tuple[int, int] = (2018, 2024)) -> DataFrame:
    """The same series read from the star (fact ⋈ time ⋈ geography).

    Both dimensions are bounded by calendar and geography; they are broadcast
    after a size check and the predicates reach the dimension scans.
    """
    t = dim_time.where(F.col("anio").between(*years) & F.col("mes").between(1, 12)) \
        .select("id_tiempo", "anio", "mes")
    g = dim_geo.where(F.col("nombre_departamento").isNotNull()) \
        .select("id_geografia", "nombre_departamento", "nombre_municipio")
    from vitals.operators.lookup import bounded
    return (fact.where(F.col("total_casos").isNotNull())
            .join(bounded(t, proof=dim_time), "id_tiempo")
            .join(bounded(g, proof=dim_geo), "id_geografia")
            .groupBy(F.col("nombre_departamento").alias("departamento"), "anio", "mes")
            .agg(F.sum("total_casos").cast("bigint").alias("muertes_observadas"),
                 F.countDistinct("nombre_municipio").cast("bigint").alias("municipios_con_datos")))


def baseline(observed: DataFrame, entity: str = "departamento",
             years: tuple[int, int] = (2018, 2019)) -> DataFrame:
    """Mean and sample std per entity-month over the reference years; std of one value → 0."""
    return (observed.where(F.col("anio").between(*years))
            .groupBy(entity, "mes")
            .agg(F.avg("muertes_observadas").alias("promedio_pre_covid"),
                 F.coalesce(F.stddev_samp("muertes_observadas"), F.lit(0.0)).alias("desviacion_pre_covid")))


def excess(observed: DataFrame, base: DataFrame, entity: str = "departamento",
           threshold: float = 0.15) -> DataFrame:
    """Rows without a baseline are dropped; label = excess ≥ threshold."""
    pct = R.excess_pct("muertes_observadas", "promedio_pre_covid")
    return (observed.join(base, [entity, "mes"], "inner")
            .withColumn("exceso_pct", pct)
            .withColumn("exceso_mortalidad", R.excess_label("exceso_pct", threshold))
            .withColumn("exceso_pct_display", F.col("exceso_pct") * 100))


def excess_one_pass(observed: DataFrame, entity: str = "departamento",
                    years: tuple[int, int] = (2018, 2019), threshold: float = 0.15) -> DataFrame:
    """M2+M3 without a self-join: the baseline is a window over (entity, month).

    ``observed`` is read once, so the wide scan/join/aggregate below it runs a
    single time; the window partitions hold one entity-month's years only.
    """
    w = Window.partitionBy(entity, "mes")
    ref = F.when(F.col("anio").between(*years), F.col("muertes_observadas"))
    pct = R.excess_pct("muertes_observadas", "promedio_pre_covid")
    return (observed
            .withColumn("promedio_pre_covid", F.avg(ref).over(w))
            .withColumn("desviacion_pre_covid", F.coalesce(F.stddev_samp(ref).over(w), F.lit(0.0)))
            .where(F.col("promedio_pre_covid").isNotNull())
            .withColumn("exceso_pct", pct)
            .withColumn("exceso_mortalidad", R.excess_label("exceso_pct", threshold))
            .withColumn("exceso_pct_display", F.col("exceso_pct") * 100))


def class_distribution(labelled: DataFrame, label: str = "exceso_mortalidad") -> DataFrame:
    """Class counts and share of total (window over the 2-row result)."""
    counts = labelled.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts.withColumn("porcentaje", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def excess_by_region(labelled: DataFrame, region: str = "region") -> DataFrame:
    """Share of entity-months in excess per region; NULL region → "Sin región"."""
    return (labelled.withColumn(region, F.coalesce(F.col(region), F.lit("Sin región")))
            .groupBy(region)
            .agg(F.count("exceso_mortalidad").cast("bigint").alias("total_observaciones"),
                 F.sum("exceso_mortalidad").cast("bigint").alias("casos_exceso"),
                 (F.avg("exceso_pct") * 100).alias("promedio_exceso_pct"))
            .withColumn("porcentaje_con_exceso",
                        F.col("casos_exceso") * 100.0 / F.col("total_observaciones")))


def predicted_by_region(scored: DataFrame, region: str = "region", pred: str = "pred_exceso",
                        proba: str = "probabilidad_exceso") -> DataFrame:
    """Predicted share and mean probability per region."""
    return (scored.withColumn(region, F.coalesce(F.col(region), F.lit("Sin región")))
            .groupBy(region)
            .agg(F.count(pred).cast("bigint").alias("total_registros"),
                 F.sum(pred).cast("bigint").alias("predicciones_exceso"),
                 (F.avg(proba) * 100).alias("probabilidad_promedio"))
            .withColumn("porcentaje_predicho_exceso",
                        F.col("predicciones_exceso") * 100.0 / F.col("total_registros")))


def annual_excess(labelled: DataFrame, keys=("departamento",)) -> DataFrame:
    """A10: yearly observed total against the summed monthly baseline."""
    out = (labelled.groupBy(*keys, "anio")
           .agg(F.sum("muertes_observadas").cast("bigint").alias("total_muertes_observadas"),
                F.sum("promedio_pre_covid").alias("promedio_historico_pre_covid")))
    return (out.withColumn("exceso_pct_anual",
                           R.excess_pct("total_muertes_observadas", "promedio_historico_pre_covid"))
            .withColumn("supera_promedio",
                        F.col("total_muertes_observadas") > F.col("promedio_historico_pre_covid")))


def year_profile(observed: DataFrame, entity: str = "departamento") -> DataFrame:
    """Per year: total, distinct entities, distinct months."""
    return (observed.groupBy("anio")
            .agg(F.sum("muertes_observadas").cast("bigint").alias("total_muertes"),
                 F.countDistinct(entity).cast("bigint").alias("departamentos"),
                 F.countDistinct("mes").cast("bigint").alias("meses")))


def entity_series(labelled: DataFrame, name: str, entity: str = "departamento") -> DataFrame:
    """One entity's monthly series with baseline and +15% line."""
    return (labelled.where(F.upper(F.col(entity)) == F.upper(F.lit(name)))
            .select(entity, "anio", "mes",
                    F.make_date("anio", "mes", F.lit(1)).alias("fecha"),
                    "muertes_observadas", "promedio_pre_covid",
                    (F.col("promedio_pre_covid") * 1.15).alias("umbral_exceso"),
                    "exceso_mortalidad")
            .orderBy("fecha"))


def available_entities(entities: DataFrame, cols=("departamento",)) -> DataFrame:
    """Sorted distinct entity list."""
    return entities.select(*cols).where(F.col(cols[0]).isNotNull()).distinct().orderBy(*cols)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Report floating measures to a fixed number of decimals."""
    return df.select([F.round(F.col(f.name), digits).alias(f.name)
                      if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                      for f in df.schema.fields])
