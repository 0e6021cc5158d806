"""Oracle SQL of the landing jobs."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["land_deaths_years"] = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN year(CAST(o_orderdate AS DATE)) % 2 = 0 THEN o_orderpriority END AS o_orderpriority,
       CAST(o_orderdate AS DATE) AS dia, 'INE' AS fuente_origen, true AS con_origen
FROM orders WHERE o_orderdate IS NOT NULL"""

ORACLE["land_chronic_years"] = """
SELECT c_custkey AS codigo, c_name AS nombre, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segmento,
       'MSPAS' AS fuente_origen, true AS con_origen
FROM customer"""

ORACLE["land_world_mortality"] = """
SELECT n_nationkey, n_name, n_regionkey, 'WMD' AS fuente_origen, true AS con_origen FROM nation"""

_COVID = """
WITH o AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS dia, 'C' || (o_custkey % 30) AS code, o_orderstatus FROM orders),
r AS (
  SELECT k, dia, code,
         CASE WHEN k % 29 = 0 THEN 'Norte' || chr(10) || 'Sur ' || code WHEN k % 31 = 0 THEN 'dijo "' || code || '", luego'
              ELSE 'Pais ' || code END AS name,
         CASE WHEN k % 11 <> 0 THEN o_orderstatus END AS region, CAST(k % 500 AS BIGINT) AS cases,
         CASE WHEN k % 13 <> 0 THEN CAST(k % 7 AS BIGINT) END AS deaths,
         CASE WHEN k % 4 = 0 THEN NULL WHEN k % 37 = 0 THEN 'columnas' WHEN k % 41 = 0 THEN 'tipo:New_cases'
              WHEN k % 43 = 0 THEN 'vacia' END AS motivo FROM o)
"""

ORACLE["land_world_covid"] = _COVID + """
SELECT dia AS Date_reported, code AS Country_code, name AS Country, region AS WHO_region, cases AS New_cases, deaths AS New_deaths,
       'OMS_COVID_MUNDIAL' AS fuente_origen, true AS con_origen FROM r WHERE motivo IS NULL"""

ORACLE["land_world_covid_rejected"] = _COVID + """
SELECT motivo, CAST(COUNT(*) AS BIGINT) AS filas, true AS con_linea, 'OMS_COVID_MUNDIAL' AS fuente_origen
FROM r WHERE motivo IS NOT NULL GROUP BY motivo
UNION ALL SELECT 'html', 1, true, 'OMS_COVID_MUNDIAL' FROM pages HAVING COUNT(*) > 0"""

ORACLE["land_dictionary"] = """
SELECT p_brand AS variable, CAST(p_partkey AS VARCHAR) AS codigo, p_name || ', x' AS etiqueta, 'INE_DICCIONARIO' AS fuente_origen,
       true AS con_origen FROM part
UNION ALL SELECT NULL, 'A' || p_partkey, p_name || ', x', 'INE_DICCIONARIO_CIE10', true FROM part"""

ORACLE["land_covid_local"] = """
SELECT CAST(l_suppkey AS BIGINT) AS codigo,
       CASE WHEN l_suppkey % 5 = 0 THEN 'Lugar' || chr(10) ELSE 'Lugar, ' END || l_suppkey AS lugar,
       CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS fecha_fallecimiento, CAST(COUNT(*) AS BIGINT) AS fallecidos,
       'MSPAS_COVID' AS fuente_origen, true AS con_origen
FROM lineitem
WHERE year(CAST(l_shipdate AS DATE)) BETWEEN 1992 AND 1998
  AND (l_suppkey % 7 <> 0 OR CAST(l_shipdate AS DATE) < DATE '1995-05-01')
GROUP BY 1, 2, 3, l_suppkey"""

ORACLE["land_regional"] = """
WITH o AS (
  SELECT o_orderstatus AS s, CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS anio, o_custkey AS cliente, CAST(COUNT(*) AS BIGINT) AS n,
         CAST(COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS low FROM orders GROUP BY 1, 2, 3)
SELECT CASE s WHEN 'O' THEN 'Costa Rica' ELSE 'Panama' END AS pais, anio, cliente, n AS defunciones_general,
       CASE s WHEN 'F' THEN low END AS defunciones_materna, CASE s WHEN 'O' THEN low END AS poblacion_total,
       'CENTROAMERICA' AS fuente_origen, true AS con_origen
FROM o WHERE s IN ('F', 'P', 'O')"""
