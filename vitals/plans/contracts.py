"""Typed contracts of the warehouse tables (K6) and the gate of their loads (K2).

A load writes a version, which nobody reads yet; what rows can tell one by one (NULLs,
lengths, values a cast loses) is counted while they are written, what needs the
whole table (unique keys, foreign keys) is checked on the version; only a version
without violations is committed. A bad load leaves the current version as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitals.sources import layers


@dataclass(frozen=True)
class Contract:
    """columns: (name, type, nullable, most characters); unique: natural keys; foreign:
    column → (dimension, its key); id_col: a key given by the load (see ``numbered``)."""
    columns: tuple[tuple[str, str, bool, int | None], ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, str, str], ...] = ()
    id_col: str | None = None


_TIME = ("id_tiempo", "dim_tiempo", "id_tiempo")
_GEO = ("id_geografia", "dim_geografia_gt", "id_geografia")
_CAUSE = ("id_causa", "dim_causa_cie10", "id_causa")
_SEX = ("id_sexo", "dim_sexo", "id_sexo")
_AGE = ("id_grupo_etario", "dim_grupo_etario", "id_grupo_etario")
_SOURCE = ("id_fuente", "dim_fuente", "id_fuente")
_WORLD = ("id_geografia_mundial", "dim_geografia_mundial", "id_pais")


def _ids(*names: str) -> tuple[tuple[str, str, bool, None], ...]:
    return tuple((n, "int", False, None) for n in names)


# Types, lengths and keys of the published warehouse tables.
CONTRACTS: dict[str, Contract] = {
    "dim_tiempo": Contract((*_ids("id_tiempo"), ("anio", "int", False, None), ("mes", "int", False, None), ("trimestre", "int", True, None),
                            ("periodo", "string", True, 50)), (("id_tiempo",), ("anio", "mes"))),
    "dim_geografia_gt": Contract((*_ids("id_geografia"), ("nombre_departamento", "string", False, 150), ("nombre_municipio", "string", False, 150),
                                  ("region", "string", True, 100), ("pais", "string", True, 100), ("iso3c", "string", True, 3),
                                  ("fecha_inicio_vigencia", "date", False, None), ("fecha_fin_vigencia", "date", True, None),
                                  ("es_version_actual", "boolean", False, None), ("version", "int", False, None)),
                                 (("id_geografia",), ("nombre_departamento", "nombre_municipio", "version"))),
    "dim_geografia_mundial": Contract((*_ids("id_pais"), ("nombre_pais", "string", True, 150), ("iso3c", "string", False, 3),
                                       ("iso2", "string", True, 2), ("region", "string", True, 100)), (("id_pais",), ("iso3c",))),
    "dim_causa_cie10": Contract((*_ids("id_causa"), ("codigo_cie10", "string", False, 10), ("descripcion", "string", True, None),
                                 ("capitulo_cie10", "string", True, 255), ("categoria", "string", True, 100)), (("id_causa",), ("codigo_cie10",))),
    "dim_sexo": Contract((*_ids("id_sexo"), ("codigo", "string", False, 5), ("descripcion", "string", True, 50)), (("id_sexo",), ("codigo",))),
    "dim_grupo_etario": Contract((*_ids("id_grupo_etario"), ("rango", "string", False, 50), ("edad_min", "int", True, None), ("edad_max", "int", True, None)),
                                 (("id_grupo_etario",), ("rango",))),
    "dim_fuente": Contract((*_ids("id_fuente"), ("nombre", "string", False, 100), ("tipo", "string", True, 50), ("pais_cobertura", "string", True, 100),
                            ("cobertura_temporal", "string", True, 50)), (("id_fuente",), ("nombre",))),
    "fact_defunciones_gt": Contract((*_ids("id_tiempo", "id_geografia", "id_causa", "id_sexo", "id_grupo_etario", "id_fuente"),
                                     ("total_casos", "bigint", False, None), ("periodo", "string", True, 50)),
                                    (), (_TIME, _GEO, _CAUSE, _SEX, _AGE, _SOURCE), "id_defuncion"),
    "fact_morbimortalidad_mec": Contract((*_ids("id_tiempo", "id_geografia", "id_causa", "id_grupo_etario", "id_sexo", "id_fuente"),
                                          ("casos", "bigint", False, None), ("periodo", "string", True, 50)),
                                         (), (_TIME, _GEO, _CAUSE, _AGE, _SEX, _SOURCE), "id_fact"),
    "fact_mortalidad_covid_gt": Contract((*_ids("id_tiempo", "id_geografia", "id_causa", "id_fuente"), ("fallecidos", "bigint", False, None),
                                          ("tasa_por_100k", "decimal(10,4)", True, None), ("periodo", "string", True, 50)),
                                         (), (_TIME, _GEO, _CAUSE, _SOURCE), "id_fact"),
    "fact_mortalidad_mundial": Contract((*_ids("id_tiempo", "id_geografia_mundial", "id_fuente"), ("deaths", "bigint", False, None),
                                         ("time_unit", "string", True, 50), ("semana", "int", True, None), ("periodo", "string", True, 50)),
                                        (), (_TIME, _WORLD, _SOURCE), "id_fact"),
    "fact_covid_mundial": Contract((*_ids("id_tiempo", "id_geografia_mundial", "id_fuente"), ("new_cases_mes", "bigint", False, None),
                                    ("new_deaths_mes", "bigint", False, None), ("cum_cases_fin", "bigint", False, None), ("cum_deaths_fin", "bigint", False, None),
                                    ("semanas_reporte", "int", True, None), ("periodo", "string", True, 50)),
                                   (), (_TIME, _WORLD, _SOURCE), "id_fact"),
}


class ContractError(ValueError):
    """``violations``: (rule, column, count)."""

    def __init__(self, table: str, violations: list[tuple[str, str, int]]):
        super().__init__(f"{table}: " + ", ".join(f"{rule} {column}: {n}" for rule, column, n in violations))
        self.violations = violations


def conform(df: DataFrame, contract: Contract) -> tuple[DataFrame, list[tuple[str, str, Column]]]:
    """The contract's columns with their types, and a count for each row rule; a cast
    that loses a value counts as a violation of the type."""
    have = set(df.columns)
    rules: list[tuple[str, str, Column]] = []
    raw = df.select(*[F.col(c).alias(f"_r{i}") if c in have else F.lit(None).alias(f"_r{i}") for i, (c, *_) in enumerate(contract.columns)])
    out = raw.select("*", *[F.col(f"_r{i}").try_cast(kind).alias(f"_t{i}") for i, (_, kind, *_) in enumerate(contract.columns)])
    for i, (c, _, nullable, most) in enumerate(contract.columns):
        if c not in have:
            rules.append(("faltante", c, F.lit(1)))
            continue
        rules.append(("tipo", c, F.count_if(F.col(f"_r{i}").isNotNull() & F.col(f"_t{i}").isNull())))
        if not nullable:
            rules.append(("nulos", c, F.count_if(F.col(f"_r{i}").isNull())))
        if most is not None:
            rules.append(("longitud", c, F.count_if(F.length(f"_t{i}") > most)))
    return out, rules


def audit(table: DataFrame, contract: Contract, dimensions: dict[str, DataFrame]) -> list[tuple[str, str, int]]:
    """(rule, column, count) of what only the whole table can tell: repeated keys
    (keys with more than one row) and foreign keys without a member (rows)."""
    out = []
    for key in contract.unique:
        n = table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
        out.append(("unica", ",".join(key), n))
    for column, dim, key in contract.foreign:
        if dim in dimensions:  # one row per distinct key meets the dimension
            used = table.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
            lost = used.join(dimensions[dim].select(F.col(key).alias("_k")), "_k", "left_anti")
            out.append(("foranea", column, lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]))
    return out


def check(df: DataFrame, contract: Contract, dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """K6: (columna, regla, infracciones) of a frame, nothing written."""
    typed, rules = conform(df, contract)
    row = typed.agg(*[n.alias(f"c{i}") for i, (*_, n) in enumerate(rules)]).first()
    found = [(c, rule, row[f"c{i}"]) for i, (rule, c, _) in enumerate(rules)]
    held = audit(df, contract, dimensions or {})
    return df.sparkSession.createDataFrame([*found, *[(c, rule, n) for rule, c, n in held]], "columna string, regla string, infracciones bigint")


def publish(df: DataFrame, root: str, layer: str, name: str, contract: Contract, extra: dict[str, Column] | None = None,
            dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """Write, audit, publish: one write, committed only if the contract holds; else
    ``ContractError`` and the current version stays. ``extra`` columns follow the contract's."""
    spark: SparkSession = df.sparkSession
    typed, rules = conform(df, contract)
    seen = Observation(f"contract_{name}")
    rows = typed.observe(seen, F.count(F.lit(1)).alias("rows"), *[n.cast("bigint").alias(f"c{i}") for i, (*_, n) in enumerate(rules)])
    rows = rows.select(*[F.col(f"_t{i}").alias(c) for i, (c, *_) in enumerate(contract.columns)],
                       *[v.alias(c) for c, v in (extra or {}).items()])
    version = layers.write_version(rows, root, layer, name, contract.id_col)
    found = [(rule, c, seen.get[f"c{i}"]) for i, (rule, c, _) in enumerate(rules) if seen.get[f"c{i}"]]
    if not found:
        written = layers.read_version(spark, root, layer, name, version)
        if written.count() != seen.get["rows"]:
            found = [("filas", name, seen.get["rows"])]
        found += [x for x in audit(written, contract, dimensions or {}) if x[2]]
    if found:
        raise ContractError(name, found)
    layers.commit(spark, root, layer, name, version)
    return layers.read_table(spark, root, layer, name)
