"""Oracle SQL for source and sink queries (the round trip must give back the table)."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["scan_csv_typed"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders"""

ORACLE["scan_csv_semicolon"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'no especificada'
            ELSE c_mktsegment END AS c_mktsegment
FROM customer"""

ORACLE["scan_json_array"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

ORACLE["scan_mixed_formats"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"

ORACLE["scan_parquet_parts"] = "SELECT * FROM orders"

ORACLE["read_layer_table"] = "SELECT * FROM supplier"

ORACLE["land_multi_file"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'c_mktsegment=' || c_mktsegment AS archivo_origen
FROM customer"""

ORACLE["land_tolerant"] = "SELECT * FROM supplier"

ORACLE["land_source"] = "SELECT *, 'customer' AS fuente_origen FROM customer"

ORACLE["run_report"] = """
SELECT 'customer' AS fuente, 'ok' AS estado, CAST(COUNT(*) AS BIGINT) AS filas, 6 AS columnas,
       CAST(NULL AS VARCHAR) AS error FROM customer
UNION ALL SELECT 'nation', 'ok', CAST(COUNT(*) AS BIGINT), 4, NULL FROM nation
UNION ALL SELECT 'missing', 'error', CAST(0 AS BIGINT), 0, 'AnalysisException'"""

ORACLE["quarantine_html"] = """
SELECT 'pages' AS origen, page_id AS id,
       COALESCE(starts_with(html, '<!DOCTYPE') OR contains(lower(substr(html, 1, 200)), '<html'), false) AS es_html
FROM pages
UNION ALL
SELECT 'documents', doc_id,
       COALESCE(starts_with(text, '<!DOCTYPE') OR contains(lower(substr(text, 1, 200)), '<html'), false)
FROM documents"""

ORACLE["dictionary_sheet"] = """
SELECT r_name AS variable, CAST(n_nationkey AS VARCHAR) AS codigo, n_name AS etiqueta
FROM nation JOIN region ON n_regionkey = r_regionkey"""

ORACLE["load_replace"] = "SELECT * FROM orders"

ORACLE["load_verify_count"] = """
SELECT 'orders' AS tabla, CAST(COUNT(*) AS BIGINT) AS filas_escritas, CAST(COUNT(*) AS BIGINT) AS filas_leidas,
       true AS coincide FROM orders"""

ORACLE["replicate_table"] = """
SELECT 'region' AS tabla, 1 AS orden, CAST(COUNT(*) AS BIGINT) AS filas_origen, CAST(COUNT(*) AS BIGINT) AS filas_destino,
       'ok' AS estado FROM region
UNION ALL SELECT 'nation', 2, CAST(COUNT(*) AS BIGINT), CAST(COUNT(*) AS BIGINT), 'ok' FROM nation
UNION ALL SELECT 'dim_missing', 3, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'error:AnalysisException'
UNION ALL SELECT 'orders', 4, CAST(COUNT(*) AS BIGINT), CAST(COUNT(*) AS BIGINT), 'ok' FROM orders"""

ORACLE["align_schema"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT c_custkey, CAST(c_custkey AS VARCHAR), c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 = 1
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) FROM customer WHERE c_custkey % 3 = 2"""

ORACLE["schema_drift_report"] = """
WITH n AS (SELECT c_custkey % 3 AS g, CAST(COUNT(*) AS BIGINT) AS filas FROM customer GROUP BY 1),
r AS (SELECT * FROM (VALUES ('grupo1', 1, 'faltante', 'c_name'), ('grupo2', 2, 'faltante', 'c_mktsegment'),
                            ('grupo2', 2, 'extra', 'Cantidad'), ('grupo2', 2, 'extra', 'extra')) v(archivo, g, tipo, columna))
SELECT r.archivo, r.tipo, r.columna, n.filas FROM r JOIN n ON r.g = n.g"""

ORACLE["land_parquet_parts"] = """
SELECT CAST(o_custkey AS VARCHAR) AS iso3c, CAST(o_custkey AS VARCHAR) AS country_name,
       CAST(year(o_orderdate) AS BIGINT) AS year, o_orderstatus AS time, o_orderpriority AS time_unit,
       CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS deaths,
       'partes' AS archivo_origen, 'OMS_PARQUET' AS fuente_origen
FROM orders"""

ORACLE["wide_csv_to_long"] = """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS fecha, CAST(COUNT(*) AS BIGINT) AS n
FROM orders WHERE o_orderdate IS NOT NULL
GROUP BY 1, 2"""
