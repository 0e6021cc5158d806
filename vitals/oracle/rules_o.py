"""Oracle SQL for rule, filter, lookup and reshape queries."""

from __future__ import annotations

from vitals import catalogues as C
from vitals.oracle.common import (CATEGORIES, CHAPTERS_DIM, CHAPTERS_STAGE, COVID_WEEKLY, ICD_CATALOGUE,
                                  INE_DICTIONARY, NATION_COUNTRIES, REGIONAL, age_group_sql, age_years_sql,
                                  period_sql, strip_sql, title_sql, values_table)

ORACLE: dict[str, str] = {}

UNIT = "((l_linenumber - 1) % 4 + 1)"
CAUSA = "(chr(CAST(65 + l_partkey % 26 AS INTEGER)) || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0'))"
AGE_TEXT = """(CASE WHEN l_linenumber % 4 = 0 THEN '< 1 año'
      WHEN l_linenumber % 4 = 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' a '
                                     || CAST(CAST(l_quantity AS INTEGER) + 4 AS VARCHAR) || ' años'
      WHEN l_linenumber % 4 = 2 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '+'
      ELSE 'sin dato' END)"""
NOISY = f"""(CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN '   '
      WHEN l_linenumber = 5 THEN '9' || {CAUSA}
      WHEN l_linenumber % 4 = 0 THEN lower({CAUSA})
      WHEN l_linenumber % 4 = 1 THEN ' ' || {CAUSA} || ' '
      WHEN l_linenumber % 4 = 2 THEN substr({CAUSA}, 1, 2) || ':' || substr({CAUSA}, 3, 2)
      ELSE {CAUSA} END)"""


def dim_band_sql(n: str) -> str:
    return (f"(CASE WHEN {n} IS NULL THEN 'No especificado' WHEN {n} < 1 THEN '< 1 anio' WHEN {n} < 5 THEN '1-4' "
            f"WHEN {n} < 15 THEN '5-14' WHEN {n} < 30 THEN '15-29' WHEN {n} < 45 THEN '30-44' "
            f"WHEN {n} < 60 THEN '45-59' ELSE '60 o mas' END)")


def age_text_sql(t: str) -> str:
    s = f"lower({strip_sql(t)})"
    n = f"TRY_CAST(NULLIF(regexp_extract({s}, '(\\d+)', 1), '') AS BIGINT)"
    return (f"(CASE WHEN {s} IS NULL THEN 'No especificado' "
            f"WHEN contains({s}, '< 1') OR contains({s}, 'menor') THEN '< 1 anio' ELSE {dim_band_sql(n)} END)")


def age_label_dim_sql(g: str) -> str:
    return f"(CASE {g} WHEN '< 1 año' THEN '< 1 anio' WHEN '60+' THEN '60 o mas' ELSE {g} END)"


ORACLE["period_classify"] = f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio,
       {period_sql('year(o_orderdate)', 1999, 2000)} AS periodo,
       CASE WHEN year(o_orderdate) <= 2000 THEN 'COVID' ELSE 'post-COVID' END AS periodo_covid,
       {period_sql('o_orderpriority', 2020, 2021)} AS periodo_texto
FROM orders"""

ORACLE["age_to_years"] = f"""
SELECT l_orderkey, l_linenumber, l_quantity AS edad, CAST({UNIT} AS INTEGER) AS unidad,
       {age_years_sql('l_quantity', UNIT)} AS edad_anios
FROM lineitem"""

ORACLE["age_group"] = f"""
WITH a AS (SELECT l_orderkey, l_linenumber, {age_group_sql(age_years_sql('l_quantity', UNIT))} AS g,
                  {AGE_TEXT} AS txt FROM lineitem)
SELECT l_orderkey, l_linenumber, g AS grupo_etario, {age_label_dim_sql('g')} AS grupo_dim,
       {age_text_sql('txt')} AS grupo_texto
FROM a"""

ORACLE["dictionary_decode"] = f"""
WITH {INE_DICTIONARY},
c AS (SELECT c_custkey,
             CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN CAST(c_nationkey + 30 AS VARCHAR)
                  WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) || '.0'
                  ELSE CAST(c_nationkey AS VARCHAR) END AS codigo
      FROM customer),
k AS (SELECT c_custkey, codigo,
             COALESCE(CAST(CAST(trunc(TRY_CAST(codigo AS DOUBLE)) AS BIGINT) AS VARCHAR), trim(codigo)) AS clave
      FROM c)
SELECT k.c_custkey, k.codigo,
       CASE WHEN k.codigo IS NULL THEN 'Ignorado / No especificado'
            ELSE COALESCE(d.etiqueta, 'Código no encontrado: ' || k.clave) END AS municipio
FROM k LEFT JOIN dict d ON d.variable = 'Municipio de ocurrencia' AND d.codigo = k.clave"""

ORACLE["cause_describe"] = f"""
WITH {ICD_CATALOGUE},
li AS (SELECT l_orderkey, l_linenumber, upper(trim({CAUSA})) AS codigo_cie10 FROM lineitem)
SELECT li.l_orderkey, li.l_linenumber, li.codigo_cie10,
       COALESCE(icd.descripcion, 'Sin descripción en catálogo') AS descripcion_causa
FROM li LEFT JOIN icd ON li.codigo_cie10 = icd.codigo"""

ICD_NORM = f"(CASE WHEN {strip_sql('raw')} = '' THEN NULL ELSE replace(upper({strip_sql('raw')}), ':', '') END)"

ORACLE["icd_normalise"] = f"""
WITH {CHAPTERS_STAGE}, {CHAPTERS_DIM}, {CATEGORIES},
r AS (SELECT l_orderkey, l_linenumber, {NOISY} AS raw FROM lineitem),
n AS (SELECT *, {ICD_NORM} AS code FROM r)
SELECT n.l_orderkey, n.l_linenumber, n.raw AS codigo_raw, n.code AS codigo_cie10,
       upper({strip_sql('n.raw')}) AS codigo_upper,
       CASE WHEN n.code IS NULL OR length(n.code) = 0 THEN 'No especificado'
            ELSE COALESCE(s.capitulo, 'Capítulo no identificado') END AS capitulo_cie10,
       COALESCE(d.capitulo, 'No especificado') AS capitulo_dim,
       COALESCE(c.categoria, 'Otra') AS categoria,
       COALESCE(regexp_matches(upper({strip_sql('n.raw')}), '^[A-Z][0-9]{{2,4}}'), false) AS valido
FROM n
LEFT JOIN ch_stage s ON upper(substr(n.code, 1, 1)) = s.letter
LEFT JOIN ch_dim d ON upper(substr(n.code, 1, 1)) = d.letter
LEFT JOIN cat c ON upper(substr(n.code, 1, 1)) = c.letter"""

ORACLE["icd_valid"] = f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {NOISY} AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, upper({strip_sql('raw')}) AS codigo FROM r
WHERE regexp_matches(upper({strip_sql('raw')}), '^[A-Z][0-9]{{2,4}}')"""

ORACLE["sex_normalise"] = f"""
WITH s AS (SELECT CASE WHEN l_returnflag = 'A' THEN ' f ' WHEN l_returnflag = 'R' THEN 'M'
                       ELSE l_returnflag END AS sexo_raw FROM lineitem),
t AS (SELECT sexo_raw, CASE upper({strip_sql('sexo_raw')}) WHEN 'F' THEN 'Femenino' WHEN 'M' THEN 'Masculino'
                            ELSE 'No especificado' END AS sexo FROM s)
SELECT sexo_raw, sexo,
       CASE sexo WHEN 'Mujer' THEN 1 WHEN 'Femenino' THEN 1 WHEN 'Hombre' THEN 2 WHEN 'Masculino' THEN 2
                 ELSE 3 END AS id_sexo,
       CAST(COUNT(*) AS BIGINT) AS n
FROM t GROUP BY 1, 2, 3"""

ORACLE["text_normalise"] = f"""
WITH u AS (SELECT 'part' AS origen, p_partkey AS clave, p_name AS nombre FROM part
           UNION ALL SELECT 'customer', c_custkey, c_name FROM customer),
r AS (SELECT origen, clave,
             CASE WHEN clave % 4 = 0 THEN upper(nombre) || '  ' WHEN clave % 9 = 1 THEN ' '
                  WHEN clave % 4 = 2 THEN chr(9) || lower(nombre) ELSE nombre END AS raw FROM u)
SELECT origen, clave, {title_sql('raw')} AS titulo, {strip_sql('raw')} AS limpio,
       CASE WHEN {strip_sql('raw')} = '' THEN NULL ELSE raw END AS nulo
FROM r"""

ORACLE["rate_per_100k"] = """
WITH pop AS (SELECT c_nationkey AS nationkey, CAST(COUNT(*) FILTER (WHERE c_acctbal < 0) * 100 AS BIGINT) AS poblacion
             FROM customer GROUP BY 1),
d AS (SELECT c.c_nationkey AS nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS anio, CAST(COUNT(*) AS BIGINT) AS fallecidos
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT d.nationkey, d.anio, d.fallecidos, p.poblacion,
       CASE WHEN p.poblacion > 0 THEN round_even(CAST(d.fallecidos AS DOUBLE) / p.poblacion * 100000, 4) END AS tasa_por_100k
FROM d JOIN pop p ON d.nationkey = p.nationkey"""

ORACLE["numeric_coerce"] = """
WITH e AS (SELECT event_id, event_type, regexp_extract(props, '"k":\\s*([^},]+)', 1) AS k FROM events)
SELECT event_id, TRY_CAST(k AS DOUBLE) AS valor,
       COALESCE(CAST(trunc(TRY_CAST(k AS DOUBLE)) AS BIGINT), 0) AS entero,
       TRY_CAST(event_type AS DOUBLE) AS texto,
       COALESCE(CAST(trunc(TRY_CAST(event_type AS DOUBLE)) AS BIGINT), 0) AS relleno
FROM e"""

ORACLE["date_coerce"] = """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '2021-02-30'
                                   ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS txt FROM orders),
f AS (SELECT o_orderkey, TRY_CAST(txt AS DATE) AS fecha FROM t)
SELECT o_orderkey, fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
       CASE WHEN month(fecha) > 0 THEN CAST(floor((month(fecha) - 1) / 3) + 1 AS INTEGER) END AS trimestre,
       make_date(year(fecha), month(fecha), 1) AS fecha_mes
FROM f"""

ORACLE["time_unit_split"] = """
SELECT o_orderkey,
       CASE o_orderkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'weekly' ELSE 'annual' END AS time_unit,
       CAST(CASE o_orderkey % 3 WHEN 0 THEN month(o_orderdate) WHEN 1 THEN weekofyear(o_orderdate)
                 ELSE year(o_orderdate) END AS INTEGER) AS time,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS mes,
       CASE WHEN o_orderkey % 3 = 1 THEN CAST(weekofyear(o_orderdate) AS INTEGER) END AS semana
FROM orders"""

ORACLE["drop_critical_nulls"] = f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '  '
                                 ELSE event_type END AS tipo FROM events)
SELECT event_id, tipo FROM e WHERE tipo IS NOT NULL AND {strip_sql('tipo')} <> ''"""

ORACLE["filter_year_range"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1999"""

ORACLE["filter_positive"] = """
SELECT event_id, value - 5 AS valor FROM events WHERE value - 5 > 0"""

ORACLE["select_countries"] = f"""
WITH {NATION_COUNTRIES}
SELECT o_orderkey, iso2, country FROM oc WHERE iso2 IN (SELECT iso2 FROM sel)"""

ORACLE["missing_members"] = f"""
WITH {NATION_COUNTRIES}
SELECT iso2, country FROM sel WHERE iso2 NOT IN (SELECT DISTINCT iso2 FROM oc)"""

ORACLE["map_name_to_iso"] = f"""
WITH {NATION_COUNTRIES}
SELECT oc.o_orderkey, oc.country, s.iso3 AS iso3_mapeado FROM oc JOIN sel s ON oc.country = s.country"""

ORACLE["map_region"] = f"""
WITH {NATION_COUNTRIES}, {values_table('dreg', 'iso3, region', C.DIM_REGION_BY_ISO3)}
SELECT oc.o_orderkey, oc.iso2, s.iso3 AS iso3_desde_iso2, COALESCE(dreg.region, 'Otro') AS region,
       COALESCE(s.region, 'Sin región') AS region_stage
FROM oc LEFT JOIN sel s ON oc.iso2 = s.iso2 LEFT JOIN dreg ON s.iso3 = dreg.iso3"""

ORACLE["map_who_region"] = f"""
WITH {NATION_COUNTRIES}, {values_table('who', 'code, name', C.WHO_REGIONS)},
x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'XYZ' ELSE who_region END AS who_region FROM oc)
SELECT x.o_orderkey, x.who_region, COALESCE(who.name, 'Otro') AS who_region_desc
FROM x LEFT JOIN who ON x.who_region = who.code"""

ORACLE["dedup_keep_first"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                        l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem)
WHERE rn = 1"""

ORACLE["weekly_to_monthly"] = f"""
WITH {COVID_WEEKLY}
SELECT Country_code, CAST(year(Date_reported) AS INTEGER) AS anio, CAST(month(Date_reported) AS INTEGER) AS mes,
       CAST(COALESCE(SUM(New_cases), 0) AS BIGINT) AS New_cases_mes,
       CAST(COALESCE(SUM(New_deaths), 0) AS BIGINT) AS New_deaths_mes,
       arg_max(Cumulative_cases, Date_reported) FILTER (WHERE Cumulative_cases IS NOT NULL) AS Cumulative_cases_fin,
       arg_max(Cumulative_deaths, Date_reported) FILTER (WHERE Cumulative_deaths IS NOT NULL) AS Cumulative_deaths_fin,
       CAST(COUNT(Date_reported) AS BIGINT) AS semanas_reporte
FROM cw WHERE Date_reported IS NOT NULL AND Country_code IS NOT NULL
GROUP BY 1, 2, 3"""

ORACLE["wide_to_long"] = f"""
WITH {NATION_COUNTRIES}
SELECT nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha, CAST(COUNT(*) AS BIGINT) AS n
FROM oc WHERE o_orderdate IS NOT NULL GROUP BY 1, 2"""

ORACLE["homologate_union"] = f"""
WITH {REGIONAL}
SELECT 'Panama' AS pais, anio, defunciones_general, defunciones_infantil_menores_de_un_anio,
       defunciones_menores_de_5_anios, defunciones_materna, defunciones_de_mujeres_en_edad_fertil,
       CAST(NULL AS BIGINT) AS poblacion_total, CAST(NULL AS DOUBLE) AS tasa_bruta_mortalidad_por_mil,
       'CONTRALORIA_PANAMA' AS fuente_origen
FROM pa
UNION ALL
SELECT 'Costa Rica', anio, defunciones, NULL, NULL, NULL, NULL, poblacion_total_al_30_de_junio,
       tasa_bruta_de_mortalidad_por_mil_habitantes, 'INEC_COSTA_RICA'
FROM cr"""

ORACLE["overlap_entities"] = """
SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier"""

ORACLE["add_provenance"] = """
SELECT *, 'TPCH_CUSTOMER' AS fuente_origen, 'customer.parquet' AS archivo_origen FROM customer"""
