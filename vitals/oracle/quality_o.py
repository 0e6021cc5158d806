"""Oracle SQL for profiling queries."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["profile_table"] = """
SELECT CAST(COUNT(*) AS BIGINT) AS filas, CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS clientes_distintos,
       MIN(o_orderdate) AS fecha_min, MAX(o_orderdate) AS fecha_max, ROUND(SUM(o_totalprice), 2) AS total,
       CAST(COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS BIGINT) AS nulos_prioridad,
       list_sort(list_distinct(list(o_orderstatus))) AS estados
FROM orders"""

ORACLE["value_counts"] = "SELECT lang, CAST(COUNT(*) AS BIGINT) AS n FROM documents GROUP BY lang"

ORACLE["null_counts"] = """
WITH j AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS columna, CAST(COUNT(*) FILTER (WHERE doc_id IS NULL) AS BIGINT) AS nulos FROM j
UNION ALL SELECT 'lang', CAST(COUNT(*) FILTER (WHERE lang IS NULL) AS BIGINT) FROM j
UNION ALL SELECT 'n_chars', CAST(COUNT(*) FILTER (WHERE n_chars IS NULL) AS BIGINT) FROM j
UNION ALL SELECT 'quality', CAST(COUNT(*) FILTER (WHERE quality IS NULL) AS BIGINT) FROM j
UNION ALL SELECT 'toxic', CAST(COUNT(*) FILTER (WHERE toxic IS NULL) AS BIGINT) FROM j"""

ORACLE["top_k_groups"] = """
SELECT source, CAST(SUM(n_chars) AS BIGINT) AS total FROM documents GROUP BY source
ORDER BY total DESC, source LIMIT 5"""

from vitals.oracle.common import CASES_RAW  # noqa: E402

ORACLE["age_text_flags"] = f"""
WITH {CASES_RAW},
t AS (SELECT CASE WHEN l_linenumber % 5 = 0 THEN 'menor de ' || CAST("Casos" AS VARCHAR)
                  WHEN l_linenumber % 5 = 1 THEN '< ' || CAST("Casos" AS VARCHAR)
                  ELSE "Grupo Etario" END AS grupo FROM cases_raw),
s AS (SELECT grupo, lower(trim(grupo)) AS s FROM t)
SELECT grupo AS texto, CAST(COUNT(*) AS BIGINT) AS n FROM s
WHERE (contains(s, '< 1') OR contains(s, 'menor'))
  AND list_max(list_transform(regexp_extract_all(s, '(\\d+)', 1), lambda x: TRY_CAST(x AS BIGINT))) > 1
GROUP BY grupo"""


def _profile(table: str, source: str, numbers: list[str], texts: list[str]) -> str:
    rows = [f"SELECT '{table}' AS tabla, '{c}' AS columna, CAST(COUNT(*) AS BIGINT) AS filas, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulos, "
            f"CAST(MIN({c}) AS DOUBLE) AS minimo, CAST(MAX({c}) AS DOUBLE) AS maximo, CAST(NULL AS VARCHAR) AS primero, CAST(NULL AS VARCHAR) AS ultimo FROM {source}"
            for c in numbers]
    rows += [f"SELECT '{table}', '{c}', COUNT(*), COUNT(*) - COUNT({c}), NULL, NULL, MIN(CAST({c} AS VARCHAR)), MAX(CAST({c} AS VARCHAR)) FROM {source}" for c in texts]
    return " UNION ALL ".join(rows)


ORACLE["profile_columns"] = " UNION ALL ".join([
    _profile("orders", "(SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS nota FROM orders) o",
             ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderdate", "o_orderpriority", "nota"]),
    _profile("customer", "customer", ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"])])
