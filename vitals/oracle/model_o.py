"""Oracle SQL for feature, split and evaluation queries (fitted-model outputs are rows-only)."""

from __future__ import annotations

from vitals import catalogues as C
from vitals.oracle.common import LABELLED_NATION

ORACLE: dict[str, str] = {}

FEATURES = f"""WITH {LABELLED_NATION},
f AS (SELECT municipio, region, anio, mes, promedio_pre_covid, desviacion_pre_covid, exceso_mortalidad
      FROM nlabelled
      WHERE municipio IS NOT NULL AND region IS NOT NULL AND anio IS NOT NULL AND mes IS NOT NULL
        AND promedio_pre_covid IS NOT NULL AND desviacion_pre_covid IS NOT NULL AND exceso_mortalidad IS NOT NULL)"""

ORACLE["feature_table"] = f"""{FEATURES}
SELECT municipio, region, anio, mes, ROUND(promedio_pre_covid, 6) AS promedio_pre_covid,
       ROUND(desviacion_pre_covid, 6) AS desviacion_pre_covid, exceso_mortalidad FROM f"""

ORACLE["stratified_split"] = f"""{FEATURES},
r AS (SELECT *, row_number() OVER (PARTITION BY exceso_mortalidad
                                   ORDER BY md5(municipio || '|' || CAST(anio AS VARCHAR) || '|' || CAST(mes AS VARCHAR))) AS rk,
             COUNT(*) OVER (PARTITION BY exceso_mortalidad) AS n
      FROM f),
q AS (SELECT exceso_mortalidad, ceil((SELECT COUNT(*) FROM f) * 0.25) * COUNT(*) / (SELECT COUNT(*) FROM f) AS share
      FROM f GROUP BY exceso_mortalidad),
t AS (SELECT exceso_mortalidad, floor(share)
             + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, exceso_mortalidad)
                         <= ceil((SELECT COUNT(*) FROM f) * 0.25) - (SELECT SUM(floor(share)) FROM q) THEN 1 ELSE 0 END AS n_test
      FROM q),
split AS (SELECT municipio, region, anio, mes, r.exceso_mortalidad,
                 CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS conjunto
          FROM r JOIN t ON r.exceso_mortalidad = t.exceso_mortalidad)
SELECT municipio, anio, mes, exceso_mortalidad, conjunto FROM split"""

# one row per feature: the rows of its one-hot column, or those with another value than the mean
ORACLE["model_optimality"] = f"""{ORACLE["stratified_split"].rsplit("SELECT", 1)[0].replace(
    "SELECT municipio, anio, mes, r.exceso_mortalidad,", "SELECT municipio, region, anio, mes, promedio_pre_covid, desviacion_pre_covid, r.exceso_mortalidad,")},
train AS (SELECT * FROM split WHERE conjunto = 'train')
SELECT 'municipio=' || municipio AS caracteristica, CAST(COUNT(*) AS BIGINT) AS filas, true AS optimo FROM train GROUP BY municipio
UNION ALL SELECT 'region=' || region, COUNT(*), true FROM train GROUP BY region
UNION ALL SELECT 'anio', COUNT(*) FILTER (WHERE anio <> (SELECT AVG(anio) FROM train)), true FROM train
UNION ALL SELECT 'mes', COUNT(*) FILTER (WHERE mes <> (SELECT AVG(mes) FROM train)), true FROM train
UNION ALL SELECT 'promedio_pre_covid', COUNT(*), true FROM train
UNION ALL SELECT 'desviacion_pre_covid', COUNT(*), true FROM train
UNION ALL SELECT 'intercepto', COUNT(*), true FROM train"""

ORACLE["model_artifacts"] = f"""{ORACLE["stratified_split"].rsplit("SELECT", 1)[0]}
SELECT 'umbrales' AS artefacto, 'csv' AS formato, CAST({len(C.SWEEP_THRESHOLDS)} AS BIGINT) AS filas
UNION ALL SELECT 'confusion', 'csv', CAST({len(C.SWEEP_THRESHOLDS)} AS BIGINT)
UNION ALL SELECT 'configuracion', 'json', CAST(1 AS BIGINT)
UNION ALL SELECT 'coeficientes', 'json', CAST(COUNT(DISTINCT municipio) + COUNT(DISTINCT region) + 4 + 1 AS BIGINT)
          FROM split WHERE conjunto = 'train'
UNION ALL SELECT 'linea_base', 'parquet', CAST(COUNT(*) AS BIGINT)
          FROM (SELECT DISTINCT municipio, mes, promedio_pre_covid, desviacion_pre_covid FROM nlabelled)
UNION ALL SELECT 'modelo', 'pipeline', CAST(COUNT(*) AS BIGINT) FROM split WHERE conjunto = 'test'"""

THRESHOLDS = ", ".join(f"({t})" for t in C.SWEEP_THRESHOLDS)
SCORED = """s AS (SELECT d.lang AS region, l.quality AS real, CAST(d.n_chars % 100 AS DOUBLE) / 100 AS score
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
COUNTS = f"""WITH {SCORED},
t AS (SELECT CAST(umbral AS DOUBLE) AS umbral FROM (VALUES {THRESHOLDS}) v(umbral)),
c AS (SELECT t.umbral,
             CAST(COUNT(*) FILTER (WHERE s.real <> 1 AND s.score < t.umbral) AS DOUBLE) AS tn,
             CAST(COUNT(*) FILTER (WHERE s.real <> 1 AND s.score >= t.umbral) AS DOUBLE) AS fp,
             CAST(COUNT(*) FILTER (WHERE s.real = 1 AND s.score < t.umbral) AS DOUBLE) AS fn,
             CAST(COUNT(*) FILTER (WHERE s.real = 1 AND s.score >= t.umbral) AS DOUBLE) AS tp
      FROM t CROSS JOIN s GROUP BY t.umbral),
m AS (SELECT umbral,
             COALESCE((tp + tn) / NULLIF(tp + tn + fp + fn, 0), 0) AS accuracy,
             COALESCE(tp / NULLIF(tp + fp, 0), 0) AS precision,
             COALESCE(tp / NULLIF(tp + fn, 0), 0) AS recall,
             COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1,
             CAST(tn AS BIGINT) AS verdaderos_negativos, CAST(fp AS BIGINT) AS falsos_positivos,
             CAST(fn AS BIGINT) AS falsos_negativos, CAST(tp AS BIGINT) AS verdaderos_positivos
      FROM c)"""
ROUNDED = """SELECT umbral, ROUND(accuracy, 6) AS accuracy, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
       ROUND(f1, 6) AS f1, verdaderos_negativos, falsos_positivos, falsos_negativos, verdaderos_positivos FROM m"""

ORACLE["threshold_sweep"] = f"""{COUNTS}
{ROUNDED}"""

ORACLE["best_threshold"] = f"""{COUNTS}
{ROUNDED} ORDER BY f1 DESC, umbral ASC LIMIT 1"""

ORACLE["classification_report"] = f"""WITH {SCORED},
c AS (SELECT CAST(COUNT(*) FILTER (WHERE real <> 1 AND score < 0.5) AS DOUBLE) AS tn,
             CAST(COUNT(*) FILTER (WHERE real <> 1 AND score >= 0.5) AS DOUBLE) AS fp,
             CAST(COUNT(*) FILTER (WHERE real = 1 AND score < 0.5) AS DOUBLE) AS fn,
             CAST(COUNT(*) FILTER (WHERE real = 1 AND score >= 0.5) AS DOUBLE) AS tp FROM s),
k AS (SELECT *, COALESCE(tn / NULLIF(tn + fn, 0), 0) AS p0, COALESCE(tn / NULLIF(tn + fp, 0), 0) AS r0,
             COALESCE(2 * tn / NULLIF(2 * tn + fn + fp, 0), 0) AS f0,
             COALESCE(tp / NULLIF(tp + fp, 0), 0) AS p1, COALESCE(tp / NULLIF(tp + fn, 0), 0) AS r1,
             COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1, tn + fp AS s0, tp + fn AS s1 FROM c)
SELECT '0' AS clase, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1, CAST(s0 AS BIGINT) AS soporte FROM k
UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), CAST(s1 AS BIGINT) FROM k
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(COALESCE((tp + tn) / NULLIF(s0 + s1, 0), 0), 6), CAST(s0 + s1 AS BIGINT) FROM k
UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6),
                 CAST(s0 + s1 AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', ROUND(COALESCE((p0 * s0 + p1 * s1) / NULLIF(s0 + s1, 0), 0), 6),
                 ROUND(COALESCE((r0 * s0 + r1 * s1) / NULLIF(s0 + s1, 0), 0), 6),
                 ROUND(COALESCE((f0 * s0 + f1 * s1) / NULLIF(s0 + s1, 0), 0), 6), CAST(s0 + s1 AS BIGINT) FROM k"""

ORACLE["predicted_by_region"] = f"""WITH {SCORED}
SELECT COALESCE(region, 'Sin región') AS region, CAST(COUNT(*) AS BIGINT) AS total_registros,
       CAST(SUM(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS predicciones_exceso,
       ROUND(AVG(score) * 100, 6) AS probabilidad_promedio,
       ROUND(SUM(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 6) AS porcentaje_predicho_exceso
FROM s GROUP BY COALESCE(region, 'Sin región')"""
