"""Oracle SQL for warehouse queries (dimensions, facts, reports).

Stage inputs are the stage oracle statements used as subqueries; ids are
``row_number()`` over the natural key, as in the Spark builders.
"""

from __future__ import annotations

from vitals import catalogues as C
from vitals.oracle.common import CATEGORIES, CHAPTERS_DIM, period_sql, strip_sql, values_table
from vitals.oracle.rules_o import age_label_dim_sql, age_text_sql
from vitals.oracle.stage_o import ORACLE as STAGE

ORACLE: dict[str, str] = {}

ST = {"sd": STAGE["stage_deaths"], "sc": STAGE["stage_cases"], "cl": STAGE["stage_covid_local"],
      "mw": STAGE["stage_mortality_world"], "cw": STAGE["stage_covid_world"]}


def stages(*names: str) -> str:
    return ",\n".join(f"st_{n} AS ({ST[n]}\n)" for n in names)


SEL = values_table("sel", "idx, iso2, iso3, country, region", [(i, *r) for i, r in enumerate(C.SELECTED_COUNTRIES)])
DREG = values_table("dreg", "iso3, region", C.DIM_REGION_BY_ISO3)
AGE_IDS = values_table("grupo", "id_grupo_etario, rango, edad_min, edad_max", C.DIM_AGE_GROUP)


def sex_id_sql(x: str) -> str:
    return f"(CASE {x} WHEN 'Mujer' THEN 1 WHEN 'Femenino' THEN 1 WHEN 'Hombre' THEN 2 WHEN 'Masculino' THEN 2 ELSE 3 END)"


def age_id_sql(label: str) -> str:
    cases = " ".join(f"WHEN '{r[1]}' THEN {r[0]}" for r in C.DIM_AGE_GROUP)
    return f"(CASE {label} {cases} ELSE 8 END)"


def geo(x: str) -> str:
    return strip_sql(f"COALESCE({x}, 'Ignorado')")


ORACLE["dim_time"] = f"""
WITH {stages('sd', 'sc', 'cl', 'mw', 'cw')},
m AS (SELECT DISTINCT CAST(anio AS INTEGER) AS anio, CAST(COALESCE(mes, 0) AS INTEGER) AS mes FROM (
        SELECT anio, 0 AS mes FROM st_sc WHERE anio IS NOT NULL
        UNION ALL SELECT anio, mes FROM st_cl WHERE anio IS NOT NULL
        UNION ALL SELECT anio_ocurrencia, mes_ocurrencia FROM st_sd WHERE anio_ocurrencia IS NOT NULL
        UNION ALL SELECT anio, mes FROM st_mw WHERE anio IS NOT NULL AND mes IS NOT NULL
        UNION ALL SELECT anio, 0 FROM st_mw WHERE anio IS NOT NULL AND time_unit = 'annual'
        UNION ALL SELECT anio, mes FROM st_cw WHERE anio IS NOT NULL))
SELECT CAST(row_number() OVER (ORDER BY anio, mes) AS INTEGER) AS id_tiempo, anio, mes,
       CASE WHEN mes > 0 THEN CAST(floor((mes - 1) / 3) + 1 AS INTEGER) END AS trimestre,
       {period_sql('anio', 1999, 2000)} AS periodo
FROM m"""

ORACLE["dim_geo"] = f"""
WITH {stages('sd', 'sc', 'cl')},
u AS (SELECT nombre_depto_ocurrencia AS d, nombre_muni_ocurrencia AS m FROM st_sd WHERE nombre_depto_ocurrencia IS NOT NULL
      UNION SELECT departamento, municipio FROM st_sc WHERE departamento IS NOT NULL
      UNION SELECT departamento, municipio FROM st_cl WHERE departamento IS NOT NULL),
g AS (SELECT DISTINCT {geo('d')} AS nombre_departamento, {geo('m')} AS nombre_municipio FROM u)
SELECT CAST(row_number() OVER (ORDER BY nombre_departamento, nombre_municipio) AS INTEGER) AS id_geografia,
       nombre_departamento, nombre_municipio, 'Guatemala' AS region, 'Guatemala' AS pais, 'GTM' AS iso3c,
       DATE '2015-01-01' AS fecha_inicio_vigencia, CAST(NULL AS DATE) AS fecha_fin_vigencia,
       true AS es_version_actual, 1 AS version
FROM g"""

ORACLE["dim_country"] = f"""
WITH {stages('mw', 'cw')}, {SEL}, {DREG},
m AS (SELECT DISTINCT country_name AS nombre_pais, iso3c FROM st_mw WHERE iso3c IS NOT NULL),
c AS (SELECT DISTINCT country_name AS nombre_pais, country_code AS iso2 FROM st_cw WHERE country_code IS NOT NULL),
u AS (SELECT 0 AS prio, m.nombre_pais, upper(trim(m.iso3c)) AS iso3c, s.iso2
      FROM m LEFT JOIN sel s ON upper(trim(m.iso3c)) = s.iso3
      UNION ALL
      SELECT 1, c.nombre_pais, upper(trim(s.iso3)), c.iso2 FROM c LEFT JOIN sel s ON upper(trim(c.iso2)) = s.iso2),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iso3c
                                                    ORDER BY prio, nombre_pais NULLS FIRST, iso2 NULLS FIRST) AS rn
                       FROM u WHERE iso3c IS NOT NULL) WHERE rn = 1)
SELECT CAST(row_number() OVER (ORDER BY one.iso3c) AS INTEGER) AS id_pais, one.nombre_pais, one.iso3c, one.iso2,
       COALESCE(dreg.region, 'Otro') AS region
FROM one LEFT JOIN dreg ON one.iso3c = dreg.iso3"""

ORACLE["dim_cause"] = f"""
WITH {stages('sc', 'sd')}, {CHAPTERS_DIM}, {CATEGORIES},
{values_table('seeds', 'codigo, descripcion', C.SEED_CAUSES)},
u AS (SELECT 0 AS prio, upper({strip_sql('codigo_cie10')}) AS codigo_cie10,
             COALESCE(diagnostico, 'Sin descripcion') AS descripcion
      FROM (SELECT DISTINCT codigo_cie10, diagnostico FROM st_sc WHERE codigo_cie10 IS NOT NULL)
      UNION ALL
      SELECT 1, upper({strip_sql('codigo_cie10')}), COALESCE(descripcion_causa, 'Sin descripcion')
      FROM (SELECT DISTINCT codigo_cie10, descripcion_causa FROM st_sd WHERE codigo_cie10 IS NOT NULL)
      UNION ALL
      SELECT 2, upper({strip_sql('codigo')}), COALESCE(descripcion, 'Sin descripcion') FROM seeds),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo_cie10 ORDER BY prio, descripcion) AS rn
                       FROM u) WHERE rn = 1)
SELECT CAST(row_number() OVER (ORDER BY one.codigo_cie10) AS INTEGER) AS id_causa, one.codigo_cie10, one.descripcion,
       COALESCE(ch.capitulo, 'No especificado') AS capitulo_cie10, COALESCE(cat.categoria, 'Otra') AS categoria
FROM one LEFT JOIN ch_dim ch ON upper(substr(one.codigo_cie10, 1, 1)) = ch.letter
LEFT JOIN cat ON upper(substr(one.codigo_cie10, 1, 1)) = cat.letter"""

ORACLE["dim_static"] = f"""
WITH {stages('sd', 'sc')},
{values_table('sexo', 'id_sexo, codigo, descripcion', C.DIM_SEX)}, {AGE_IDS},
{values_table('fuente', 'id_fuente, nombre, tipo, pais_cobertura, cobertura_temporal', C.DIM_SOURCE)},
sex_use AS (SELECT {sex_id_sql('sexo')} AS id, COUNT(*) AS filas FROM st_sd GROUP BY 1),
age_use AS (SELECT g.id_grupo_etario AS id, COUNT(*) AS filas FROM st_sd
            JOIN grupo g ON {age_label_dim_sql('st_sd.grupo_etario')} = g.rango GROUP BY 1),
src_use AS (SELECT 1 AS id, COUNT(*) AS filas FROM st_sd UNION ALL SELECT 2, COUNT(*) FROM st_sc)
SELECT 'dim_sexo' AS dimension, s.id_sexo AS id, s.descripcion AS etiqueta,
       CAST(COALESCE(u.filas, 0) AS BIGINT) AS filas FROM sexo s LEFT JOIN sex_use u ON s.id_sexo = u.id
UNION ALL
SELECT 'dim_grupo_etario', g.id_grupo_etario, g.rango, CAST(COALESCE(u.filas, 0) AS BIGINT)
FROM grupo g LEFT JOIN age_use u ON g.id_grupo_etario = u.id
UNION ALL
SELECT 'dim_fuente', f.id_fuente, f.nombre, CAST(COALESCE(u.filas, 0) AS BIGINT)
FROM fuente f LEFT JOIN src_use u ON f.id_fuente = u.id"""

ORACLE["dim_upsert_ignore"] = """
WITH b1 AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes
            FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'),
i1 AS (SELECT CAST(row_number() OVER (ORDER BY anio, mes) AS BIGINT) AS id_tiempo, anio, mes FROM b1),
b2 AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders),
n2 AS (SELECT b2.* FROM b2 LEFT JOIN i1 ON b2.anio = i1.anio AND b2.mes = i1.mes WHERE i1.id_tiempo IS NULL),
i2 AS (SELECT CAST((SELECT max(id_tiempo) FROM i1) + row_number() OVER (ORDER BY anio, mes) AS BIGINT) AS id_tiempo,
              anio, mes FROM n2)
SELECT * FROM i1 UNION ALL SELECT * FROM i2"""

SAME = "(j.segmento IS NOT DISTINCT FROM j.nseg AND j.nacion IS NOT DISTINCT FROM j.nnac)"
ORACLE["scd2_merge"] = f"""
WITH cur AS (SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id_cliente, c_custkey,
                    c_mktsegment AS segmento, c_nationkey AS nacion, DATE '2015-01-01' AS fecha_inicio_vigencia,
                    CAST(NULL AS DATE) AS fecha_fin_vigencia, true AS es_version_actual, 1 AS version
             FROM customer WHERE c_custkey % 7 <> 3),
inc AS (SELECT c_custkey AS ik, CASE WHEN c_custkey % 10 = 0 THEN c_mktsegment || '_2' ELSE c_mktsegment END AS nseg,
               c_nationkey AS nnac FROM customer),
j AS (SELECT * FROM cur FULL OUTER JOIN inc ON cur.c_custkey = inc.ik),
kept AS (SELECT id_cliente, c_custkey, segmento, nacion, fecha_inicio_vigencia, fecha_fin_vigencia, es_version_actual,
                version FROM j WHERE id_cliente IS NOT NULL AND (ik IS NULL OR {SAME})),
closed AS (SELECT id_cliente, c_custkey, segmento, nacion, fecha_inicio_vigencia, DATE '2019-12-31', false, version
           FROM j WHERE id_cliente IS NOT NULL AND ik IS NOT NULL AND NOT {SAME}),
opened AS (SELECT COALESCE(c_custkey, ik) AS c_custkey, nseg AS segmento, nnac AS nacion, COALESCE(version, 0) + 1 AS version
           FROM j WHERE ik IS NOT NULL AND (id_cliente IS NULL OR NOT {SAME})),
added AS (SELECT CAST((SELECT max(id_cliente) FROM cur) + row_number() OVER (ORDER BY c_custkey, version) AS BIGINT)
                   AS id_cliente, c_custkey, segmento, nacion, DATE '2020-01-01' AS fecha_inicio_vigencia,
                 CAST(NULL AS DATE) AS fecha_fin_vigencia, true AS es_version_actual, version
          FROM opened)
SELECT * FROM kept UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM added"""

ORACLE["fact_deaths"] = f"""
WITH {stages('sd')},
a AS (SELECT anio_ocurrencia AS anio, mes_ocurrencia AS mes, nombre_depto_ocurrencia AS departamento,
             nombre_muni_ocurrencia AS municipio, sexo, grupo_etario, codigo_cie10, periodo, COUNT(*) AS total_casos
      FROM st_sd WHERE anio_ocurrencia IS NOT NULL GROUP BY ALL)
SELECT CAST(anio AS INTEGER) AS anio, CAST(COALESCE(mes, 0) AS INTEGER) AS mes,
       {geo('departamento')} AS nombre_departamento, {geo('municipio')} AS nombre_municipio,
       upper({strip_sql('codigo_cie10')}) AS codigo_cie10, {sex_id_sql('sexo')} AS id_sexo,
       {age_id_sql(age_label_dim_sql('grupo_etario'))} AS id_grupo_etario, 1 AS id_fuente,
       CAST(total_casos AS BIGINT) AS total_casos, periodo
FROM a"""

ORACLE["fact_cases"] = f"""
WITH {stages('sc')},
a AS (SELECT anio, departamento, municipio, codigo_cie10, grupo_etario, sexo, periodo, SUM(casos) AS casos
      FROM st_sc WHERE anio IS NOT NULL AND anio >= 1997 GROUP BY ALL)
SELECT CAST(anio AS INTEGER) AS anio, 0 AS mes, {geo('departamento')} AS nombre_departamento,
       {geo('municipio')} AS nombre_municipio, upper({strip_sql('codigo_cie10')}) AS codigo_cie10,
       {age_id_sql(age_text_sql('grupo_etario'))} AS id_grupo_etario, {sex_id_sql('sexo')} AS id_sexo,
       2 AS id_fuente, CAST(COALESCE(casos, 0) AS BIGINT) AS casos, periodo
FROM a"""

ORACLE["fact_covid_local"] = f"""
WITH {stages('cl')},
a AS (SELECT anio, mes, departamento, municipio, periodo, SUM(fallecidos) AS fallecidos, MAX(tasa_por_100k) AS tasa
      FROM st_cl GROUP BY ALL)
SELECT CAST(anio AS INTEGER) AS anio, CAST(COALESCE(mes, 0) AS INTEGER) AS mes,
       {geo('departamento')} AS nombre_departamento, {geo('municipio')} AS nombre_municipio,
       'U071' AS codigo_cie10, 3 AS id_fuente, CAST(COALESCE(fallecidos, 0) AS BIGINT) AS fallecidos,
       CAST(tasa AS DECIMAL(10, 4)) AS tasa_por_100k, periodo
FROM a"""

ORACLE["fact_mortality_world"] = f"""
WITH {stages('mw')},
mem AS (SELECT DISTINCT anio, mes FROM st_mw WHERE anio IS NOT NULL AND mes IS NOT NULL
        UNION SELECT DISTINCT anio, 0 FROM st_mw WHERE anio IS NOT NULL AND time_unit = 'annual'),
a AS (SELECT iso3c, anio, mes, semana, time_unit, fuente, periodo, SUM(deaths) AS deaths FROM st_mw GROUP BY ALL)
SELECT CAST(a.anio AS INTEGER) AS anio, CAST(COALESCE(a.mes, 0) AS INTEGER) AS mes, a.iso3c,
       CASE a.fuente WHEN 'WORLD_MORTALITY' THEN 4 WHEN 'CENTROAMERICA_RDS' THEN 5 ELSE 4 END AS id_fuente,
       CAST(COALESCE(a.deaths, 0) AS BIGINT) AS deaths, a.time_unit, a.semana, a.periodo
FROM a JOIN mem ON a.anio = mem.anio AND COALESCE(a.mes, 0) = mem.mes
WHERE a.iso3c IS NOT NULL"""


def long_or_zero(x: str) -> str:
    return f"COALESCE(CAST(trunc({x}) AS BIGINT), 0)"


ORACLE["fact_covid_world"] = f"""
WITH {stages('cw')}, {SEL}
SELECT CAST(w.anio AS INTEGER) AS anio, CAST(w.mes AS INTEGER) AS mes, s.iso3 AS iso3c, 6 AS id_fuente,
       {long_or_zero('w.new_cases_mes')} AS new_cases_mes, {long_or_zero('w.new_deaths_mes')} AS new_deaths_mes,
       {long_or_zero('w.cum_cases_fin')} AS cum_cases_fin, {long_or_zero('w.cum_deaths_fin')} AS cum_deaths_fin,
       CAST(w.semanas_reporte AS INTEGER) AS semanas_reporte, w.periodo
FROM st_cw w JOIN sel s ON upper(trim(w.country_code)) = s.iso2"""

ORACLE["fk_null_report"] = f"""
WITH {stages('sd', 'sc', 'cl')},
a AS (SELECT anio_ocurrencia AS anio, COALESCE(mes_ocurrencia, 0) AS mes, {geo('nombre_depto_ocurrencia')} AS dep,
             {geo('nombre_muni_ocurrencia')} AS mun, upper({strip_sql('codigo_cie10')}) AS code
      FROM st_sd WHERE anio_ocurrencia IS NOT NULL
      GROUP BY anio_ocurrencia, mes_ocurrencia, nombre_depto_ocurrencia, nombre_muni_ocurrencia, sexo, grupo_etario,
               codigo_cie10, periodo),
tm AS (SELECT DISTINCT anio, 0 AS mes FROM st_sc WHERE anio IS NOT NULL),
gm AS (SELECT DISTINCT {geo('departamento')} AS dep, {geo('municipio')} AS mun FROM st_cl WHERE departamento IS NOT NULL),
cm AS (SELECT DISTINCT upper({strip_sql('codigo_cie10')}) AS code FROM st_sc WHERE codigo_cie10 IS NOT NULL
       UNION SELECT 'U071' UNION SELECT 'ZGEN'),
r AS (SELECT a.*, tm.anio AS t_ok, gm.dep AS g_ok, cm.code AS c_ok FROM a
      LEFT JOIN tm ON a.anio = tm.anio AND a.mes = tm.mes
      LEFT JOIN gm ON a.dep = gm.dep AND a.mun = gm.mun
      LEFT JOIN cm ON a.code = cm.code)
SELECT 'id_tiempo' AS fk, CAST(COUNT(*) FILTER (WHERE t_ok IS NULL) AS BIGINT) AS nulos FROM r
UNION ALL SELECT 'id_geografia', CAST(COUNT(*) FILTER (WHERE g_ok IS NULL) AS BIGINT) FROM r
UNION ALL SELECT 'id_causa', CAST(COUNT(*) FILTER (WHERE c_ok IS NULL) AS BIGINT) FROM r
UNION ALL SELECT 'id_sexo', CAST(0 AS BIGINT)
UNION ALL SELECT 'id_grupo_etario', CAST(0 AS BIGINT)"""

ORACLE["fk_violations"] = f"""
WITH {stages('sc')},
a AS (SELECT upper({strip_sql('codigo_cie10')}) AS code FROM st_sc WHERE anio IS NOT NULL AND anio >= 1997
      GROUP BY anio, departamento, municipio, codigo_cie10, grupo_etario, sexo, periodo)
SELECT 'id_causa' AS fk, CAST(COUNT(*) FILTER (WHERE substr(code, 1, 1) > 'M') AS BIGINT) AS violaciones FROM a"""

ORACLE["unique_violations"] = f"""
WITH {stages('mw', 'cw')}, {SEL},
a AS (SELECT DISTINCT iso3c, country_name FROM st_mw),
b AS (SELECT DISTINCT s.iso3 AS iso3c, w.country_name FROM st_cw w LEFT JOIN sel s ON w.country_code = s.iso2),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT iso3c, CAST(COUNT(*) AS BIGINT) AS n FROM u WHERE iso3c IS NOT NULL GROUP BY iso3c HAVING COUNT(*) > 1"""

ORACLE["contract_check"] = f"""
WITH {stages('cl')},
c AS (SELECT COUNT(*) FILTER (WHERE fecha_fallecimiento IS NULL) AS n1, COUNT(*) FILTER (WHERE anio IS NULL) AS n2,
             COUNT(*) FILTER (WHERE length(departamento) > 6) AS l3, COUNT(*) FILTER (WHERE length(municipio) > 8) AS l4,
             COUNT(*) FILTER (WHERE poblacion IS NULL) AS n5, COUNT(*) FILTER (WHERE fallecidos IS NULL) AS n6
      FROM st_cl)
SELECT 'fecha_fallecimiento' AS columna, 'tipo' AS regla, CAST(0 AS BIGINT) AS infracciones FROM c
UNION ALL SELECT 'fecha_fallecimiento', 'nulos', n1 FROM c
UNION ALL SELECT 'anio', 'tipo', 0 FROM c
UNION ALL SELECT 'anio', 'nulos', n2 FROM c
UNION ALL SELECT 'departamento', 'tipo', 0 FROM c
UNION ALL SELECT 'departamento', 'longitud', l3 FROM c
UNION ALL SELECT 'municipio', 'tipo', 0 FROM c
UNION ALL SELECT 'municipio', 'longitud', l4 FROM c
UNION ALL SELECT 'poblacion', 'tipo', 0 FROM c
UNION ALL SELECT 'poblacion', 'nulos', n5 FROM c
UNION ALL SELECT 'fallecidos', 'tipo', 1 FROM c
UNION ALL SELECT 'fallecidos', 'nulos', n6 FROM c
UNION ALL SELECT 'tasa_por_100k', 'tipo', 0 FROM c
UNION ALL SELECT 'region', 'faltante', 1 FROM c"""

ORACLE["drill_across"] = f"""
WITH {stages('sd', 'cl')},
d AS (SELECT CAST(anio_ocurrencia AS INTEGER) AS anio, CAST(COALESCE(mes_ocurrencia, 0) AS INTEGER) AS mes,
             {geo('nombre_depto_ocurrencia')} AS nombre_departamento, {geo('nombre_muni_ocurrencia')} AS nombre_municipio,
             COUNT(*) AS n
      FROM st_sd WHERE anio_ocurrencia IS NOT NULL GROUP BY ALL),
c AS (SELECT CAST(anio AS INTEGER) AS anio, CAST(COALESCE(mes, 0) AS INTEGER) AS mes,
             {geo('departamento')} AS nombre_departamento, {geo('municipio')} AS nombre_municipio, SUM(fallecidos) AS f
      FROM st_cl GROUP BY ALL)
SELECT COALESCE(d.anio, c.anio) AS anio, COALESCE(d.mes, c.mes) AS mes,
       COALESCE(d.nombre_departamento, c.nombre_departamento) AS nombre_departamento,
       COALESCE(d.nombre_municipio, c.nombre_municipio) AS nombre_municipio,
       CAST(d.n AS BIGINT) AS total_casos, CAST(c.f AS BIGINT) AS fallecidos
FROM d FULL OUTER JOIN c ON d.anio = c.anio AND d.mes = c.mes AND d.nombre_departamento = c.nombre_departamento
     AND d.nombre_municipio = c.nombre_municipio"""

ORACLE["star_observed"] = f"""
WITH {stages('sd')},
a AS (SELECT CAST(anio_ocurrencia AS INTEGER) AS anio, CAST(COALESCE(mes_ocurrencia, 0) AS INTEGER) AS mes,
             {geo('nombre_depto_ocurrencia')} AS d, {geo('nombre_muni_ocurrencia')} AS m, COUNT(*) AS n
      FROM st_sd WHERE anio_ocurrencia IS NOT NULL GROUP BY ALL)
SELECT d AS departamento, anio, mes, CAST(SUM(n) AS BIGINT) AS muertes_observadas,
       CAST(COUNT(DISTINCT m) AS BIGINT) AS municipios_con_datos
FROM a WHERE anio BETWEEN 1995 AND 2001 AND mes BETWEEN 1 AND 12 AND d IS NOT NULL
GROUP BY d, anio, mes"""


def _count(sql: str) -> str:
    return f"(SELECT COUNT(*) FROM ({sql}))"


ORACLE["load_dimensions"] = f"""
SELECT 'dim_tiempo' AS dimension, CAST({_count(ORACLE['dim_time'])} AS BIGINT) AS filas_antes,
       CAST({_count(ORACLE['dim_time'])} AS BIGINT) AS filas_despues, CAST(0 AS BIGINT) AS ids_cambiados
UNION ALL SELECT 'dim_geografia_gt', {_count(ORACLE['dim_geo'])}, {_count(ORACLE['dim_geo'])}, 0
UNION ALL SELECT 'dim_geografia_mundial', {_count(ORACLE['dim_country'])}, {_count(ORACLE['dim_country'])}, 0
UNION ALL SELECT 'dim_causa_cie10', {_count(ORACLE['dim_cause'])}, {_count(ORACLE['dim_cause'])}, 0
UNION ALL SELECT 'dim_sexo', 3, 3, 0
UNION ALL SELECT 'dim_grupo_etario', 8, 8, 0
UNION ALL SELECT 'dim_fuente', 6, 6, 0"""

ORACLE["load_fact"] = f"""
WITH f AS ({ORACLE['fact_deaths']})
SELECT CAST(COUNT(*) AS BIGINT) AS filas, CAST(1 AS BIGINT) AS id_min, CAST(COUNT(*) AS BIGINT) AS id_max,
       CAST(COUNT(*) AS BIGINT) AS ids_distintos, CAST(SUM(total_casos) AS BIGINT) AS total_casos,
       CAST(1 AS BIGINT) AS cargas
FROM f"""


def _contract_row(table: str, sql: str, named: int) -> str:
    return f"SELECT '{table}' AS tabla, CAST(0 AS BIGINT) AS infracciones, CAST({_count(sql)} AS BIGINT) AS filas, CAST({named} AS BIGINT) AS avisos"


_STATIC = "(SELECT COUNT(*) FROM ({}) s WHERE dimension = '{}')"

ORACLE["contract_tables"] = " UNION ALL ".join([
    _contract_row("dim_tiempo", ORACLE["dim_time"], 0), _contract_row("dim_geografia_gt", ORACLE["dim_geo"], 0),
    _contract_row("dim_geografia_mundial", ORACLE["dim_country"], 0), _contract_row("dim_causa_cie10", ORACLE["dim_cause"], 0),
    *[f"SELECT '{t}', 0, " + _STATIC.format(ORACLE["dim_static"], t) + ", 0" for t in ("dim_sexo", "dim_grupo_etario", "dim_fuente")],
    _contract_row("fact_defunciones_gt", ORACLE["fact_deaths"], 1), _contract_row("fact_morbimortalidad_mec", ORACLE["fact_cases"], 1),
    _contract_row("fact_mortalidad_covid_gt", ORACLE["fact_covid_local"], 1), _contract_row("fact_mortalidad_mundial", ORACLE["fact_mortality_world"], 1),
    _contract_row("fact_covid_mundial", ORACLE["fact_covid_world"], 1)])

ORACLE["geo_versions"] = f"""
WITH f AS ({ORACLE['fact_deaths']})
SELECT anio, CASE WHEN nombre_departamento LIKE 'A%' AND anio >= 1998 THEN 'Otra' ELSE 'Guatemala' END AS region,
       CASE WHEN nombre_departamento LIKE 'A%' AND anio >= 1998 THEN 2 ELSE 1 END AS version,
       CAST(SUM(total_casos) AS BIGINT) AS total_casos
FROM f GROUP BY ALL"""

ORACLE["replicate_verify"] = """
SELECT 'region' AS tabla, CAST(COUNT(*) AS BIGINT) AS filas_origen, CAST(COUNT(*) - 1 AS BIGINT) AS filas_destino,
       CAST(1 AS BIGINT) AS cubetas_distintas, CAST(0 AS BIGINT) AS claves_rotas, 'diferencia' AS estado FROM region
UNION ALL SELECT 'nation', COUNT(*), COUNT(*), 0, COUNT(*) FILTER (WHERE n_regionkey = 1), 'diferencia' FROM nation
UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 1, 0, 'diferencia' FROM orders
UNION ALL SELECT 'customer', COUNT(*), COUNT(*), 0, 0, 'ok' FROM customer"""
