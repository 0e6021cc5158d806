"""Oracle SQL for the mart queries."""

from __future__ import annotations

from vitals.oracle.common import GEO, LABELLED, LABELLED_NATION, OBSERVED

ORACLE: dict[str, str] = {}

ORACLE["monthly_observed"] = f"""WITH {OBSERVED}
SELECT * FROM observed ORDER BY departamento, anio, mes"""

ORACLE["baseline"] = f"""WITH {OBSERVED}
SELECT departamento, mes, ROUND(AVG(muertes_observadas), 6) AS promedio_pre_covid,
       ROUND(COALESCE(STDDEV_SAMP(muertes_observadas), 0), 6) AS desviacion_pre_covid
FROM observed WHERE anio BETWEEN 1995 AND 1998 GROUP BY departamento, mes"""

ORACLE["excess_label"] = f"""WITH {LABELLED}
SELECT departamento, mes, anio, muertes_observadas, municipios_con_datos,
       ROUND(promedio_pre_covid, 6) AS promedio_pre_covid, ROUND(desviacion_pre_covid, 6) AS desviacion_pre_covid,
       ROUND(exceso_pct, 6) AS exceso_pct, exceso_mortalidad, ROUND(exceso_pct_display, 6) AS exceso_pct_display
FROM labelled"""

ORACLE["class_distribution"] = f"""WITH {LABELLED}
SELECT exceso_mortalidad, CAST(COUNT(*) AS BIGINT) AS n,
       ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS porcentaje
FROM labelled GROUP BY exceso_mortalidad"""

ORACLE["excess_by_region"] = f"""WITH {LABELLED_NATION}
SELECT COALESCE(region, 'Sin región') AS region,
       CAST(COUNT(exceso_mortalidad) AS BIGINT) AS total_observaciones,
       CAST(SUM(exceso_mortalidad) AS BIGINT) AS casos_exceso,
       ROUND(AVG(exceso_pct) * 100, 6) AS promedio_exceso_pct,
       ROUND(SUM(exceso_mortalidad) * 100.0 / COUNT(exceso_mortalidad), 6) AS porcentaje_con_exceso
FROM nlabelled GROUP BY COALESCE(region, 'Sin región')
ORDER BY porcentaje_con_exceso DESC, region"""

ORACLE["annual_excess"] = f"""WITH {LABELLED},
yr AS (
  SELECT departamento, anio, CAST(SUM(muertes_observadas) AS BIGINT) AS total_muertes_observadas,
         SUM(promedio_pre_covid) AS promedio_historico_pre_covid
  FROM labelled GROUP BY departamento, anio)
SELECT departamento, anio, total_muertes_observadas,
       ROUND(promedio_historico_pre_covid, 6) AS promedio_historico_pre_covid,
       ROUND((total_muertes_observadas - promedio_historico_pre_covid) / NULLIF(promedio_historico_pre_covid, 0), 6)
         AS exceso_pct_anual,
       total_muertes_observadas > promedio_historico_pre_covid AS supera_promedio
FROM yr"""

ORACLE["year_profile"] = f"""WITH {OBSERVED}
SELECT anio, CAST(SUM(muertes_observadas) AS BIGINT) AS total_muertes,
       CAST(COUNT(DISTINCT departamento) AS BIGINT) AS departamentos,
       CAST(COUNT(DISTINCT mes) AS BIGINT) AS meses
FROM observed GROUP BY anio"""

ORACLE["entity_series"] = f"""WITH {LABELLED}
SELECT departamento, anio, mes, make_date(anio, mes, 1) AS fecha, muertes_observadas,
       ROUND(promedio_pre_covid, 6) AS promedio_pre_covid,
       ROUND(promedio_pre_covid * 1.15, 6) AS umbral_exceso, exceso_mortalidad
FROM labelled WHERE upper(departamento) = upper('america') ORDER BY fecha"""

ORACLE["available_entities"] = f"""WITH {GEO}
SELECT DISTINCT departamento, municipio FROM geo WHERE departamento IS NOT NULL
ORDER BY departamento, municipio"""
