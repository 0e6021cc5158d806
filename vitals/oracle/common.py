"""Shared CTEs: the adapter spelled in SQL (see vitals/adapter.py)."""

GEO = """geo AS (
  SELECT n.n_nationkey AS nationkey, r.r_regionkey AS regionkey, r.r_name AS departamento, n.n_name AS municipio
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

ORDER_GEO = GEO + """,
og AS (
  SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS INTEGER) AS anio,
         CAST(month(o.o_orderdate) AS INTEGER) AS mes, g.nationkey, g.regionkey, g.departamento, g.municipio
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.nationkey)"""

DEATHS = ORDER_GEO + """,
deaths AS (
  SELECT l.l_orderkey, l.l_linenumber, og.anio, og.mes, og.departamento, og.municipio,
         l.l_returnflag AS sexo, l.l_quantity AS edad,
         CAST((l.l_linenumber - 1) % 4 + 1 AS INTEGER) AS unidad,
         chr(CAST(65 + l.l_partkey % 26 AS INTEGER)) || lpad(CAST(l.l_suppkey % 100 AS VARCHAR), 2, '0') AS causa,
         l.l_quantity AS casos
  FROM lineitem l JOIN og ON l.l_orderkey = og.o_orderkey)"""

COUNTS = DEATHS + """,
counts AS (
  SELECT departamento, municipio, anio, mes, CAST(COUNT(*) AS BIGINT) AS total_casos
  FROM deaths GROUP BY departamento, municipio, anio, mes)"""

OBSERVED = COUNTS + """,
observed AS (
  SELECT departamento, anio, mes,
         CAST(SUM(total_casos) AS BIGINT) AS muertes_observadas,
         CAST(COUNT(DISTINCT municipio) AS BIGINT) AS municipios_con_datos
  FROM counts
  WHERE anio BETWEEN 1995 AND 2001 AND mes BETWEEN 1 AND 12
    AND total_casos IS NOT NULL AND departamento IS NOT NULL
  GROUP BY departamento, anio, mes)"""

LABELLED = OBSERVED + """,
base AS (
  SELECT departamento, mes, AVG(muertes_observadas) AS promedio_pre_covid,
         COALESCE(STDDEV_SAMP(muertes_observadas), 0) AS desviacion_pre_covid
  FROM observed WHERE anio BETWEEN 1995 AND 1998 GROUP BY departamento, mes),
labelled AS (
  SELECT o.*, b.promedio_pre_covid, b.desviacion_pre_covid,
         (o.muertes_observadas - b.promedio_pre_covid) / NULLIF(b.promedio_pre_covid, 0) AS exceso_pct,
         CASE WHEN (o.muertes_observadas - b.promedio_pre_covid) / NULLIF(b.promedio_pre_covid, 0) >= 0.15
              THEN 1 ELSE 0 END AS exceso_mortalidad,
         (o.muertes_observadas - b.promedio_pre_covid) / NULLIF(b.promedio_pre_covid, 0) * 100 AS exceso_pct_display
  FROM observed o JOIN base b ON o.departamento = b.departamento AND o.mes = b.mes)"""

LABELLED_NATION = COUNTS + """,
nobs AS (
  SELECT municipio, anio, mes, CAST(SUM(total_casos) AS BIGINT) AS muertes_observadas,
         CAST(COUNT(DISTINCT municipio) AS BIGINT) AS municipios_con_datos
  FROM counts
  WHERE anio BETWEEN 1995 AND 2001 AND mes BETWEEN 1 AND 12 AND total_casos IS NOT NULL AND municipio IS NOT NULL
  GROUP BY municipio, anio, mes),
nbase AS (
  SELECT municipio, mes, AVG(muertes_observadas) AS promedio_pre_covid,
         COALESCE(STDDEV_SAMP(muertes_observadas), 0) AS desviacion_pre_covid
  FROM nobs WHERE anio BETWEEN 1995 AND 1998 GROUP BY municipio, mes),
nregion AS (SELECT DISTINCT municipio, departamento AS region FROM counts),
nlabelled AS (
  SELECT o.municipio, r.region, o.anio, o.mes, b.promedio_pre_covid, b.desviacion_pre_covid,
         (o.muertes_observadas - b.promedio_pre_covid) / NULLIF(b.promedio_pre_covid, 0) AS exceso_pct,
         CASE WHEN (o.muertes_observadas - b.promedio_pre_covid) / NULLIF(b.promedio_pre_covid, 0) >= 0.15
              THEN 1 ELSE 0 END AS exceso_mortalidad
  FROM nobs o JOIN nbase b ON o.municipio = b.municipio AND o.mes = b.mes
  LEFT JOIN nregion r ON o.municipio = r.municipio)"""




def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    out = []
    for r in rows:
        out.append("(" + ", ".join("NULL" if v is None else (_q(v) if isinstance(v, str) else str(v))
                                   for v in r) + ")")
    return ",\n    ".join(out)


def values_table(name: str, cols: str, rows) -> str:
    """A catalogue as an inline VALUES relation (data only)."""
    return f"{name}({cols}) AS (VALUES\n    {_values(rows)})"


from vitals import catalogues as _C  # noqa: E402

NATION_COUNTRIES = values_table("sel", "idx, iso2, iso3, country, region",
                                [(i, *r) for i, r in enumerate(_C.SELECTED_COUNTRIES)]) + """,
nc AS (
  SELECT n.n_nationkey AS nationkey,
         COALESCE(s.iso2, 'Z' || chr(65 + n.n_nationkey)) AS iso2,
         COALESCE(s.iso3, 'ZZ' || chr(65 + n.n_nationkey)) AS iso3,
         COALESCE(s.country, n.n_name) AS country,
         CASE r.r_name WHEN 'AFRICA' THEN 'AFRO' WHEN 'AMERICA' THEN 'AMRO' WHEN 'ASIA' THEN 'SEARO'
                       WHEN 'EUROPE' THEN 'EURO' WHEN 'MIDDLE EAST' THEN 'EMRO' END AS who_region,
         r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN sel s ON n.n_nationkey + 10 = s.idx),
oc AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority, c.c_nationkey,
         nc.nationkey, nc.iso2, nc.iso3, nc.country, nc.who_region, nc.r_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nc ON c.c_nationkey = nc.nationkey)"""

WORLD_MORTALITY = NATION_COUNTRIES + """,
wm AS (
  SELECT iso3 AS iso3c, country AS country_name, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(CASE WHEN nationkey % 3 = 0 THEN weekofyear(o_orderdate) ELSE month(o_orderdate) END AS INTEGER) AS time,
         CASE WHEN nationkey % 3 = 0 THEN 'weekly' ELSE 'monthly' END AS time_unit,
         CAST(COUNT(*) AS DOUBLE) AS deaths
  FROM oc GROUP BY 1, 2, 3, 4, 5)"""

REGIONAL = """pa AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anio,
         CAST(COUNT(*) AS BIGINT) AS defunciones_general,
         CAST(COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS defunciones_infantil_menores_de_un_anio,
         CAST(COUNT(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS defunciones_menores_de_5_anios,
         CAST(COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS defunciones_materna,
         CAST(COUNT(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS BIGINT) AS defunciones_de_mujeres_en_edad_fertil
  FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O' GROUP BY 1),
cr AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anio,
         CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS poblacion_total_al_30_de_junio,
         CAST(COUNT(*) AS BIGINT) AS defunciones,
         ROUND(CAST(COUNT(*) AS DOUBLE) * 1000 / COUNT(DISTINCT o_custkey), 4) AS tasa_bruta_de_mortalidad_por_mil_habitantes
  FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)"""

COVID_WEEKLY = NATION_COUNTRIES + """,
wk AS (
  SELECT iso2 AS Country_code, country AS Country, who_region AS WHO_region,
         CAST(date_trunc('week', o_orderdate) AS DATE) AS Date_reported,
         CAST(COUNT(*) AS BIGINT) AS New_cases,
         CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS New_deaths
  FROM oc GROUP BY 1, 2, 3, 4),
cw AS (
  SELECT Date_reported, Country_code, Country, WHO_region, New_cases,
         CAST(SUM(New_cases) OVER (PARTITION BY Country_code ORDER BY Date_reported
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS Cumulative_cases,
         New_deaths,
         CASE WHEN weekofyear(Date_reported) % 6 = 0 THEN NULL
              ELSE CAST(SUM(New_deaths) OVER (PARTITION BY Country_code ORDER BY Date_reported
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END
           AS Cumulative_deaths
  FROM wk)"""

COVID_LOCAL = """cl AS (
  SELECT upper(r.r_name) AS departamento, CAST(r.r_regionkey AS BIGINT) AS codigo_departamento,
         CASE WHEN g.o_orderstatus = 'F' THEN lower(n.n_name) || ' ' ELSE lower(n.n_name) END AS municipio,
         CAST(n.n_nationkey AS BIGINT) AS codigo_municipio, p.poblacion,
         g.o_orderdate AS fecha_fallecimiento,
         CAST(CASE WHEN g.o_orderstatus = 'P' THEN g.n - 1 ELSE g.n END AS BIGINT) AS fallecidos,
         g.o_orderstatus AS pos
  FROM (SELECT c.c_nationkey, o.o_orderdate, o.o_orderstatus, COUNT(*) AS n
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3) g
  JOIN nation n ON g.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN (SELECT c_nationkey AS pk, CAST(COUNT(*) * 1000 AS BIGINT) AS poblacion FROM customer GROUP BY 1) p
    ON g.c_nationkey = p.pk)"""

CASES_RAW = DEATHS + """,
cases_raw AS (
  SELECT l_orderkey, l_linenumber, anio AS "Año",
         CASE WHEN l_linenumber % 2 = 0 THEN upper(departamento) || ' ' ELSE lower(departamento) END AS "Departamento",
         lower(municipio) AS "Municipio",
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_linenumber % 4 = 0 THEN lower(causa)
              WHEN l_linenumber % 4 = 1 THEN ' ' || causa || ' '
              WHEN l_linenumber % 4 = 2 THEN substr(causa, 1, 2) || ':' || substr(causa, 3, 2)
              ELSE causa END AS "CIE-10",
         'diagnostico ' || lower(causa) AS "Diagnóstico",
         CASE WHEN l_linenumber % 4 = 0 THEN '< 1 año'
              WHEN l_linenumber % 4 = 1 THEN CAST(CAST(edad AS INTEGER) AS VARCHAR) || ' a '
                                             || CAST(CAST(edad AS INTEGER) + 4 AS VARCHAR) || ' años'
              WHEN l_linenumber % 4 = 2 THEN CAST(CAST(edad AS INTEGER) AS VARCHAR) || '+'
              ELSE 'sin dato' END AS "Grupo Etario",
         CASE WHEN sexo = 'A' THEN ' f ' WHEN sexo = 'R' THEN 'M' ELSE 'X' END AS "Sexo",
         CAST(edad AS BIGINT) AS "Casos"
  FROM deaths)"""

DEATHS_RAW = ORDER_GEO + """,
deaths_raw AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CAST((og.regionkey + 1) % 5 AS VARCHAR) AS Depreg,
         CAST((og.nationkey + 3) % 25 AS VARCHAR) AS Mupreg,
         CAST(og.regionkey AS VARCHAR) AS Depocu,
         CAST(CASE WHEN l.l_linenumber = 6 THEN NULL WHEN l.l_linenumber = 5 THEN og.nationkey + 30
                   ELSE og.nationkey END AS VARCHAR) AS Mupocu,
         CASE WHEN l.l_returnflag = 'A' THEN '1' WHEN l.l_returnflag = 'R' THEN '2' ELSE '9' END AS Sexo,
         CASE WHEN l.l_linestatus = 'O' THEN '1' ELSE '2' END AS Asist,
         CAST(l.l_linenumber % 3 + 1 AS VARCHAR) AS Ocur,
         CAST(l.l_partkey % 5 AS VARCHAR) AS Puedif,
         og.anio AS "Añoocu", og.mes AS Mesocu, l.l_quantity AS Edadif,
         CAST((l.l_linenumber - 1) % 4 + 1 AS INTEGER) AS Perdif,
         CASE WHEN l.l_linenumber = 7 THEN '9' || {c}
              WHEN l.l_linenumber = 3 THEN ' ' || lower({c})
              ELSE {c} END AS Caudef
  FROM lineitem l JOIN og ON l.l_orderkey = og.o_orderkey)""".format(
    c="(chr(CAST(65 + l.l_partkey % 26 AS INTEGER)) || lpad(CAST(l.l_suppkey % 100 AS VARCHAR), 2, '0'))")

INE_DICTIONARY = """dict_raw AS (
  SELECT 'Departamento de ocurrencia' AS variable, CAST(r_regionkey AS VARCHAR) || '.0' AS codigo,
         r_name AS etiqueta, CAST(r_regionkey AS BIGINT) AS pos FROM region
  UNION ALL
  SELECT 'Municipio de ocurrencia', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_nationkey + 100 AS BIGINT) FROM nation
  UNION ALL
  SELECT 'Municipio de ocurrencia', ' ' || CAST(n_nationkey AS VARCHAR) || ' ', lower(n_name),
         CAST(n_nationkey + 200 AS BIGINT) FROM nation WHERE n_nationkey % 5 = 0
  UNION ALL
  SELECT 'Sexo del difunto(a)', CAST(r_regionkey + 1 AS VARCHAR),
         CASE WHEN r_regionkey = 0 THEN 'Hombre' ELSE 'Mujer' END, CAST(r_regionkey + 300 AS BIGINT)
  FROM region WHERE r_regionkey < 2
  UNION ALL
  SELECT 'Departamento de registro', CAST(r_regionkey AS VARCHAR), r_name, CAST(r_regionkey + 400 AS BIGINT) FROM region
  UNION ALL
  SELECT 'Municipio de registro', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_nationkey + 500 AS BIGINT) FROM nation
  UNION ALL
  SELECT 'Asistencia recibida', CAST(r_regionkey + 1 AS VARCHAR),
         CASE WHEN r_regionkey = 0 THEN 'Con asistencia' ELSE 'Sin asistencia' END, CAST(r_regionkey + 600 AS BIGINT)
  FROM region WHERE r_regionkey < 2
  UNION ALL
  SELECT 'Sitio de ocurrencia', CAST(r_regionkey + 1 AS VARCHAR), 'Sitio ' || r_name, CAST(r_regionkey + 700 AS BIGINT)
  FROM region WHERE r_regionkey < 3
  UNION ALL
  SELECT 'Pueblo de pertenencia del difunto(a)', CAST(r_regionkey AS VARCHAR), 'Pueblo ' || lower(r_name),
         CAST(r_regionkey + 800 AS BIGINT) FROM region WHERE r_regionkey < 4),
dict AS (
  SELECT trim(variable) AS variable,
         COALESCE(CAST(CAST(trunc(TRY_CAST(codigo AS DOUBLE)) AS BIGINT) AS VARCHAR), trim(codigo)) AS codigo,
         arg_max(trim(etiqueta), pos) AS etiqueta
  FROM dict_raw GROUP BY 1, 2)"""

ICD_CATALOGUE = """icd_raw AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN lower({c}) ELSE {c} END AS codigo_cie10,
         p_name AS descripcion, p_partkey AS pos FROM part),
icd AS (SELECT upper(trim(codigo_cie10)) AS codigo, arg_max(descripcion, pos) AS descripcion
        FROM icd_raw GROUP BY 1)""".format(
    c="(chr(CAST(65 + p_partkey % 26 AS INTEGER)) || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0'))")


def title_sql(s: str) -> str:
    """Python-style title case spelled with DuckDB list functions (blank → NULL)."""
    t = f"trim({s}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
    body = (f"array_to_string(list_transform(range(1, length({t}) + 1), lambda i: "
            f"CASE WHEN i = 1 OR NOT regexp_matches(substr({t}, i - 1, 1), '\\p{{L}}') "
            f"THEN upper(substr({t}, i, 1)) ELSE lower(substr({t}, i, 1)) END), '')")
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN NULL ELSE {body} END)"


def strip_sql(s: str) -> str:
    return f"trim({s}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


def period_sql(x: str, start: int = 1999, end: int = 2000) -> str:
    y = f"CAST(trunc(TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)) AS BIGINT)"
    return (f"(CASE WHEN {y} IS NULL THEN 'Ignorado' WHEN {y} < {start} THEN 'pre-COVID' "
            f"WHEN {y} <= {end} THEN 'COVID' ELSE 'post-COVID' END)")


def age_years_sql(e: str, u: str) -> str:
    return (f"(CASE WHEN {u} = 1 THEN round({e} / 365, 2) WHEN {u} = 2 THEN round({e} / 12, 2) "
            f"WHEN {u} = 3 THEN CAST({e} AS DOUBLE) END)")


def age_group_sql(a: str) -> str:
    return (f"(CASE WHEN {a} IS NULL THEN 'No especificado' WHEN {a} < 1 THEN '< 1 año' "
            f"WHEN {a} < 5 THEN '1-4' WHEN {a} < 15 THEN '5-14' WHEN {a} < 30 THEN '15-29' "
            f"WHEN {a} < 45 THEN '30-44' WHEN {a} < 60 THEN '45-59' ELSE '60+' END)")


CHAPTERS_STAGE = values_table("ch_stage", "letter, capitulo", _C.ICD_CHAPTERS_STAGE)
CHAPTERS_DIM = values_table("ch_dim", "letter, capitulo", _C.ICD_CHAPTERS_DIM)
CATEGORIES = values_table("cat", "letter, categoria", _C.ICD_CATEGORIES)
