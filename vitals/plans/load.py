"""Warehouse loads: dimension driver (D6, D7) and typed fact loads.

Dimensions are loaded in a fixed order, each with insert-if-absent against the table
already in the layer, so running the load twice keeps rows and ids; the geography
keeps its history (a changed attribute closes a version and opens the next). Facts
are replaced as a whole (truncate + append) in one write, with a dense surrogate id
and one load timestamp per run. Every table is published through its contract.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.operators.upsert import scd2_merge, upsert_ignore
from vitals.plans.contracts import CONTRACTS, Contract, publish
from vitals.sources import layers

DIMENSION_ORDER = ["dim_tiempo", "dim_geografia_gt", "dim_geografia_mundial", "dim_causa_cie10",
                   "dim_sexo", "dim_grupo_etario", "dim_fuente"]


def run_timestamp() -> str:
    """the load timestamp text, one literal per run."""
    return time.strftime("%Y-%m-%d %H:%M:%S")


def _existing(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    if not layers.table_exists(spark, root, "dw", name):  # first load
        return None
    return layers.read_table(spark, root, "dw", name)


#: dimensions with history: attributes whose change opens a version
HISTORY = {"dim_geografia_gt": ["region", "pais", "iso3c"]}


def load_dimensions(spark: SparkSession, root: str,
                    built: dict[str, tuple[DataFrame, list[str], str, bool]], as_of: dt.date | None = None) -> DataFrame:
    """Load every built dimension, name → (members, natural key, id column,
    ids fixed by the catalogue?), in DIMENSION_ORDER: insert-if-absent, or for one with
    HISTORY a version merge valid from ``as_of`` (default: today). Ids are given here
    and nowhere else. Report rows before/after and how many existing ids changed (always 0)."""
    rows = []
    for name in DIMENSION_ORDER:
        if name not in built:
            continue
        frame, key, id_col, fixed_ids = built[name]
        before = _existing(spark, root, name)
        if fixed_ids:  # static catalogue: its own ids, absent members appended
            merged = frame if before is None else before.unionByName(
                frame.join(before.select(*key), key, "left_anti"))
        elif name in HISTORY and before is not None:
            merged = scd2_merge(before, frame, key, HISTORY[name], as_of or dt.date.today(), id_col)
        else:
            merged = upsert_ignore(before, frame.drop(id_col) if id_col in frame.columns else frame, key, id_col)
        contract = CONTRACTS[name]
        after = publish(merged, root, "dw", name, contract)
        changed = 0
        if before is not None:
            whole = list(contract.unique[-1])
            changed = (before.select(*whole, F.col(id_col).alias("_old"))
                       .join(after.select(*whole, F.col(id_col).alias("_new")), whole)
                       .where(F.col("_old") != F.col("_new")).count())
        rows.append((name, before.count() if before is not None else 0, after.count(), changed))
    return spark.createDataFrame(rows, "dimension string, filas_antes bigint, filas_despues bigint, "
                                       "ids_cambiados bigint")


def load_fact(fact: DataFrame, root: str, name: str, id_col: str, contract: T.StructType | None = None,
              loaded_at: str | None = None) -> DataFrame:
    """K2: cast to the contract of the table (``contract``: only these columns and types),
    dense ids 1..n (identity restarted), load timestamp, replaced as a whole in one write;
    returns the loaded table. Rows that break the contract, or a foreign key without
    its member in a loaded dimension, leave the current version as it is."""
    rules = CONTRACTS[name]
    if contract is not None:
        rules = Contract(tuple((f.name, f.dataType.simpleString(), next((n for c, _, n, _ in rules.columns if c == f.name), True),
                                next((m for c, _, _, m in rules.columns if c == f.name), None)) for f in contract.fields),
                         foreign=rules.foreign)
    rules = Contract(rules.columns, rules.unique, rules.foreign, id_col)
    spark = fact.sparkSession
    dimensions = {d: layers.read_table(spark, root, "dw", d) for _, d, _ in rules.foreign if layers.table_exists(spark, root, "dw", d)}
    return publish(fact, root, "dw", name, rules, {"fecha_carga": F.lit(loaded_at or run_timestamp())}, dimensions)


FACT_DEATHS_CONTRACT = T.StructType([
    T.StructField("id_tiempo", T.IntegerType()), T.StructField("id_geografia", T.IntegerType()),
    T.StructField("id_causa", T.IntegerType()), T.StructField("id_sexo", T.IntegerType()),
    T.StructField("id_grupo_etario", T.IntegerType()), T.StructField("id_fuente", T.IntegerType()),
    T.StructField("total_casos", T.LongType()), T.StructField("periodo", T.StringType())])
