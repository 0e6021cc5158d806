"""Oracle SQL for stage pipeline queries and the discard report."""

from __future__ import annotations

from vitals import catalogues as C
from vitals.oracle.common import (CASES_RAW, CHAPTERS_STAGE, COVID_LOCAL, COVID_WEEKLY, DEATHS_RAW,
                                  ICD_CATALOGUE, INE_DICTIONARY, REGIONAL, WORLD_MORTALITY, age_group_sql,
                                  age_years_sql, period_sql, strip_sql, title_sql, values_table)

ORACLE: dict[str, str] = {}


def norm_code(x: str) -> str:
    return f"COALESCE(CAST(CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT) AS VARCHAR), trim({x}))"


def decoded(col: str, key: str, alias: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN 'Ignorado / No especificado' "
            f"ELSE COALESCE({alias}.etiqueta, 'Código no encontrado: ' || {key}) END")


ORACLE["stage_deaths"] = f"""
WITH {DEATHS_RAW}, {INE_DICTIONARY}, {ICD_CATALOGUE},
f AS (SELECT * FROM deaths_raw
      WHERE Caudef IS NOT NULL AND regexp_matches(upper({strip_sql('Caudef')}), '^[A-Z][0-9]{{2,4}}')),
k AS (SELECT f.*, {norm_code('Depocu')} AS kd, {norm_code('Mupocu')} AS km, {norm_code('Sexo')} AS ks,
             {norm_code('Depreg')} AS kdr, {norm_code('Mupreg')} AS kmr, {norm_code('Asist')} AS ka,
             {norm_code('Ocur')} AS ko, {norm_code('Puedif')} AS kp,
             {age_years_sql('Edadif', 'Perdif')} AS edad_anios, upper({strip_sql('Caudef')}) AS code
      FROM f)
SELECT k.l_orderkey, k.l_linenumber, CAST(k."Añoocu" AS INTEGER) AS anio_ocurrencia,
       CAST(k.Mesocu AS INTEGER) AS mes_ocurrencia,
       {decoded('k.Depocu', 'k.kd', 'd1')} AS nombre_depto_ocurrencia,
       {decoded('k.Mupocu', 'k.km', 'd2')} AS nombre_muni_ocurrencia,
       {decoded('k.Sexo', 'k.ks', 'd3')} AS sexo,
       {decoded('k.Depreg', 'k.kdr', 'd4')} AS nombre_depto_registro,
       {decoded('k.Mupreg', 'k.kmr', 'd5')} AS nombre_muni_registro,
       {decoded('k.Asist', 'k.ka', 'd6')} AS asistencia_medica,
       {decoded('k.Ocur', 'k.ko', 'd7')} AS lugar_ocurrencia,
       {decoded('k.Puedif', 'k.kp', 'd8')} AS pueblo_pertenencia,
       k.edad_anios, {age_group_sql('k.edad_anios')} AS grupo_etario, k.code AS codigo_cie10,
       COALESCE(icd.descripcion, 'Sin descripción en catálogo') AS descripcion_causa,
       {period_sql('k."Añoocu"', 1999, 2000)} AS periodo, 'INE_STAGE' AS fuente_origen
FROM k
LEFT JOIN dict d1 ON d1.variable = 'Departamento de ocurrencia' AND d1.codigo = k.kd
LEFT JOIN dict d2 ON d2.variable = 'Municipio de ocurrencia' AND d2.codigo = k.km
LEFT JOIN dict d3 ON d3.variable = 'Sexo del difunto(a)' AND d3.codigo = k.ks
LEFT JOIN dict d4 ON d4.variable = 'Departamento de registro' AND d4.codigo = k.kdr
LEFT JOIN dict d5 ON d5.variable = 'Municipio de registro' AND d5.codigo = k.kmr
LEFT JOIN dict d6 ON d6.variable = 'Asistencia recibida' AND d6.codigo = k.ka
LEFT JOIN dict d7 ON d7.variable = 'Sitio de ocurrencia' AND d7.codigo = k.ko
LEFT JOIN dict d8 ON d8.variable = 'Pueblo de pertenencia del difunto(a)' AND d8.codigo = k.kp
LEFT JOIN icd ON icd.codigo = k.code"""

CASES_FILTERED = f"""f AS (
  SELECT * FROM cases_raw
  WHERE "CIE-10" IS NOT NULL AND {strip_sql('"CIE-10"')} <> '' AND "Año" IS NOT NULL AND "Casos" IS NOT NULL
    AND TRY_CAST(CAST("Año" AS VARCHAR) AS DOUBLE) BETWEEN 1996 AND 2001),
d AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Año", "Departamento", "Municipio", "CIE-10", "Grupo Etario", "Sexo"
                                 ORDER BY l_orderkey, l_linenumber) AS rn FROM f)
  WHERE rn = 1)"""

ICD9 = f"(CASE WHEN {strip_sql('d.\"CIE-10\"')} = '' THEN NULL ELSE replace(upper({strip_sql('d.\"CIE-10\"')}), ':', '') END)"

ORACLE["stage_cases"] = f"""
WITH {CASES_RAW}, {CHAPTERS_STAGE}, {CASES_FILTERED}
SELECT CAST(trunc(TRY_CAST(CAST(d."Año" AS VARCHAR) AS DOUBLE)) AS INTEGER) AS anio,
       {title_sql('d."Departamento"')} AS departamento, {title_sql('d."Municipio"')} AS municipio,
       {ICD9} AS codigo_cie10, {title_sql('d."Diagnóstico"')} AS diagnostico,
       CASE WHEN {ICD9} IS NULL OR length({ICD9}) = 0 THEN 'No especificado'
            ELSE COALESCE(s.capitulo, 'Capítulo no identificado') END AS capitulo_cie10,
       {strip_sql('d."Grupo Etario"')} AS grupo_etario,
       CASE upper({strip_sql('d."Sexo"')}) WHEN 'F' THEN 'Femenino' WHEN 'M' THEN 'Masculino'
            ELSE 'No especificado' END AS sexo,
       CAST(trunc(TRY_CAST(CAST(d."Casos" AS VARCHAR) AS DOUBLE)) AS BIGINT) AS casos,
       {period_sql('d."Año"', 1999, 2000)} AS periodo, 'MSPAS_MEC_STAGE' AS fuente_origen
FROM d LEFT JOIN ch_stage s ON upper(substr({ICD9}, 1, 1)) = s.letter"""

ORACLE["stage_covid_local"] = f"""
WITH {COVID_LOCAL},
c AS (SELECT * EXCLUDE (fecha_fallecimiento), CAST(fecha_fallecimiento AS DATE) AS fecha_fallecimiento FROM cl),
f AS (SELECT * FROM c WHERE fecha_fallecimiento IS NOT NULL AND fallecidos IS NOT NULL
        AND TRY_CAST(CAST(fallecidos AS VARCHAR) AS DOUBLE) > 0 AND year(fecha_fallecimiento) BETWEEN 1996 AND 2001),
d AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY municipio, fecha_fallecimiento ORDER BY pos) AS rn FROM f)
      WHERE rn = 1)
SELECT fecha_fallecimiento, CAST(year(fecha_fallecimiento) AS INTEGER) AS anio,
       CAST(month(fecha_fallecimiento) AS INTEGER) AS mes, {title_sql('departamento')} AS departamento,
       codigo_departamento, {title_sql('municipio')} AS municipio, codigo_municipio, poblacion, fallecidos,
       CASE WHEN poblacion > 0 THEN round_even(CAST(fallecidos AS DOUBLE) / poblacion * 100000, 4) END AS tasa_por_100k,
       CASE WHEN year(fecha_fallecimiento) <= 2000 THEN 'COVID' ELSE 'post-COVID' END AS periodo,
       'MSPAS_COVID_STAGE' AS fuente_origen
FROM d"""

REGIONAL_UNION = REGIONAL + """,
reg AS (
  SELECT 'Panama' AS pais, anio, defunciones_general, 'CONTRALORIA_PANAMA' AS fuente_origen FROM pa
  UNION ALL SELECT 'Costa Rica', anio, defunciones, 'INEC_COSTA_RICA' FROM cr)"""

ORACLE["stage_mortality_world"] = f"""
WITH {WORLD_MORTALITY}, {REGIONAL_UNION},
{values_table('n2i', 'pais, iso3', C.REGIONAL_NAME_TO_ISO3)}
SELECT wm.iso3c, wm.country_name, s.region, CAST(wm.year AS INTEGER) AS anio,
       CASE WHEN wm.time_unit = 'monthly' THEN CAST(wm.time AS INTEGER) END AS mes,
       CASE WHEN wm.time_unit = 'weekly' THEN CAST(wm.time AS INTEGER) END AS semana,
       wm.deaths, wm.time_unit, {period_sql('wm.year', 1999, 2000)} AS periodo, 'WORLD_MORTALITY' AS fuente
FROM wm JOIN sel s ON wm.iso3c = s.iso3 WHERE wm.year >= 1996
UNION ALL
SELECT n2i.iso3, reg.pais, 'Centroamérica', CAST(reg.anio AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
       CAST(reg.defunciones_general AS DOUBLE), 'annual', {period_sql('reg.anio', 1999, 2000)}, reg.fuente_origen
FROM reg JOIN n2i ON reg.pais = n2i.pais
WHERE reg.anio >= 1996 AND reg.defunciones_general IS NOT NULL"""

ORACLE["stage_covid_world"] = f"""
WITH {COVID_WEEKLY}, {values_table('who', 'code, name', C.WHO_REGIONS)},
f AS (SELECT * FROM cw WHERE Date_reported IS NOT NULL AND Country_code IN (SELECT iso2 FROM sel)),
m AS (SELECT Country_code, Country, WHO_region, CAST(year(Date_reported) AS INTEGER) AS anio,
             CAST(month(Date_reported) AS INTEGER) AS mes,
             COALESCE(SUM(CAST(New_cases AS DOUBLE)), 0) AS new_cases_mes,
             COALESCE(SUM(CAST(New_deaths AS DOUBLE)), 0) AS new_deaths_mes,
             arg_max(CAST(Cumulative_cases AS DOUBLE), Date_reported) FILTER (WHERE Cumulative_cases IS NOT NULL) AS cum_cases_fin,
             arg_max(CAST(Cumulative_deaths AS DOUBLE), Date_reported) FILTER (WHERE Cumulative_deaths IS NOT NULL) AS cum_deaths_fin,
             CAST(COUNT(Date_reported) AS BIGINT) AS semanas_reporte
      FROM f WHERE Country IS NOT NULL AND WHO_region IS NOT NULL GROUP BY 1, 2, 3, 4, 5)
SELECT m.anio, m.mes, m.Country_code AS country_code, m.Country AS country_name, m.WHO_region AS who_region,
       COALESCE(who.name, 'Otro') AS who_region_desc, s.region, m.new_cases_mes, m.new_deaths_mes,
       m.cum_cases_fin, m.cum_deaths_fin, m.semanas_reporte, {period_sql('m.anio', 1999, 2000)} AS periodo,
       'OMS_COVID_MUNDIAL_STAGE' AS fuente_origen
FROM m LEFT JOIN who ON m.WHO_region = who.code LEFT JOIN sel s ON m.Country_code = s.iso2"""

ORACLE["discard_report"] = f"""
WITH {CASES_RAW},
r AS (SELECT COALESCE("CIE-10" IS NOT NULL AND {strip_sql('"CIE-10"')} <> '', false) AS r1,
             COALESCE("Año" IS NOT NULL, false) AS r2, COALESCE("Casos" IS NOT NULL, false) AS r3,
             COALESCE(TRY_CAST(CAST("Año" AS VARCHAR) AS DOUBLE) BETWEEN 1996 AND 2001, false) AS r4
      FROM cases_raw),
t AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE NOT r1) AS d1,
             COUNT(*) FILTER (WHERE r1 AND NOT r2) AS d2, COUNT(*) FILTER (WHERE r1 AND r2 AND NOT r3) AS d3,
             COUNT(*) FILTER (WHERE r1 AND r2 AND r3 AND NOT r4) AS d4 FROM r)
SELECT 1 AS paso, 'cie10_no_nulo' AS regla, total AS filas_antes, d1 AS descartadas, total - d1 AS filas_despues FROM t
UNION ALL SELECT 2, 'anio_no_nulo', total - d1, d2, total - d1 - d2 FROM t
UNION ALL SELECT 3, 'casos_no_nulos', total - d1 - d2, d3, total - d1 - d2 - d3 FROM t
UNION ALL SELECT 4, 'anio_en_rango', total - d1 - d2 - d3, d4, total - d1 - d2 - d3 - d4 FROM t"""
