"""Lookup joins: code dictionaries, catalogues and dimension foreign keys.

Broadcast is used only behind a size check in bytes: ``bounded`` takes the exact
size a frame carries from being built (surrogate-key dimensions know theirs) or else
measures the lookup side in one aggregate, and hints a broadcast when the side fits;
otherwise the join is a shuffle join (the session's threshold is -1, so no estimate
broadcasts anything; skewed keys are split by adaptive execution).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals import catalogues as C
from vitals.functions import rules as R

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20
#: exact (rows, bytes) attached to frames whose building counted them
SIZE_ATTR = "_vitals_size"


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as a hash relation holds it: text by its length, the rest by 16 a field."""
    total = F.lit(32 + 16 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    return total


_SIZES: dict[tuple, tuple[int, int]] = {}


def size_of(df: DataFrame) -> tuple[int, int]:
    """Exact (rows, bytes) of a frame, in one aggregate; kept per plan and input files,
    so that new files are measured anew."""
    try:
        key = (df.semanticHash(), tuple(sorted(df.inputFiles())))
    except Exception:  # noqa: BLE001 - a plan without a stable form is measured each time
        key = None
    if key is None or not key[1] or key not in _SIZES:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
        if key is None or not key[1]:
            return row["n"], row["b"]
        if len(_SIZES) > 1000:
            _SIZES.clear()
        _SIZES[key] = row["n"], row["b"]
    return _SIZES[key]


def bounded(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, proof: DataFrame | None = None,
            max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the side — or ``proof``, a frame it is a filter or
    projection of — is proven to hold ≤ max_rows rows and ≤ max_bytes bytes."""
    p = proof if proof is not None else side
    rows, size = getattr(p, SIZE_ATTR, None) or size_of(p)
    return F.broadcast(side) if rows <= max_rows and size <= max_bytes else side


def last_definition_wins(dictionary: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """One row per key, the value of the highest position.

    A ``max_by`` aggregate: partial aggregation collapses repeated keys on
    the map side, so a key defined millions of times never gathers in one task.
    """
    return dictionary.groupBy(*keys).agg(F.max_by(value, position).alias(value))


def normalised_dictionary(dictionary: DataFrame, variable: str = "variable", code: str = "codigo",
                          label: str = "etiqueta", position: str = "pos") -> DataFrame:
    """Dictionary rows (variable, code, label, pos) → unique (variable, code) → label."""
    d = dictionary.select(R.strip(F.col(variable)).alias("variable"),
                          R.normalise_code(F.col(code)).alias("codigo"),
                          R.strip(F.col(label)).alias("etiqueta"),
                          F.col(position).alias("pos"))
    return last_definition_wins(d, ["variable", "codigo"], "etiqueta", "pos")


def decode(df: DataFrame, dictionary: DataFrame, mapping: dict[str, tuple[str, str]],
           max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """For each output → (input column, dictionary variable) a left lookup.

    NULL input → "Ignorado / No especificado"; a code absent from the
    dictionary → "Código no encontrado: <code>". ``dictionary`` must already
    be unique per (variable, codigo) (see ``normalised_dictionary``).
    """
    # the same side for every output: the dictionary is built and broadcast once and reused
    side = bounded(dictionary.select(F.col("variable").alias("_variable"), F.col("codigo").alias("_codigo"), F.col("etiqueta").alias("_etiqueta")),
                   max_rows)
    out = df
    for target, (source, variable) in mapping.items():
        key, d = f"_c_{target}", f"_d_{target}"
        out = out.withColumn(key, R.normalise_code(F.col(source)))
        rest = [c for c in out.columns if c.lower() not in (key.lower(), target.lower())]
        out = out.join(side.alias(d), (F.lit(variable) == F.col(f"{d}._variable")) & (F.col(key) == F.col(f"{d}._codigo")), "left")
        out = out.select(*[F.col(f"`{c}`") for c in rest], _decoded(F.col(source), F.col(key), F.col(f"{d}._etiqueta")).alias(target))
    return out


def _decoded(source: Column, code: Column, label: Column) -> Column:
    return (F.when(source.isNull(), F.lit(C.NULL_CODE_LABEL))
            .otherwise(F.coalesce(label, F.concat(F.lit(C.MISSING_CODE_PREFIX), code))))


def describe(df: DataFrame, catalogue: DataFrame, code_col: str, out_col: str,
             default: str, key: str = "codigo", value: str = "descripcion",
             max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left lookup of a description with a default for misses."""
    cat = catalogue.select(F.col(key).alias("_key"), F.col(value).alias("_val"))
    return (df.join(bounded(cat, max_rows), F.col(code_col) == F.col("_key"), "left")
            .withColumn(out_col, F.coalesce(F.col("_val"), F.lit(default)))
            .drop("_key", "_val"))


def foreign_key(df: DataFrame, dim: DataFrame, on: list[tuple[Column | str, str]], id_col: str,
                max_rows: int = BROADCAST_MAX_ROWS, valid: tuple[Column, str, str] | None = None) -> DataFrame:
    """Attach a dimension id by a left join on (fact expr, dim column) pairs.
    ``valid``: (date of the fact, first day, last day of a version; NULL: open) for a
    dimension with history, whose versions of a key do not overlap."""
    cols = [dc for _, dc in on] + ([valid[1], valid[2]] if valid else [])
    d = dim.select(id_col, *[F.col(dc).alias(f"_fk_{i}") for i, dc in enumerate(cols)])
    cond = None
    for i, (fe, _) in enumerate(on):
        c = (F.col(fe) if isinstance(fe, str) else fe) == F.col(f"_fk_{i}")
        cond = c if cond is None else cond & c
    if valid:
        first, last = F.col(f"_fk_{len(on)}"), F.col(f"_fk_{len(on) + 1}")
        cond = cond & (first.isNull() | (valid[0] >= first)) & (last.isNull() | (valid[0] <= last))
    out = df.join(bounded(d, max_rows, proof=dim), cond, "left")
    return out.drop(*[f"_fk_{i}" for i in range(len(cols))])
