"""Data-quality reports.

Each report is one aggregate over the table (``count_if`` per rule), so a
table is read once however many rules are checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def discard_report(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Q1: rows before/after each sequential filter step, in one pass.

    ``rules`` are (name, keep-predicate) applied in order; a row is
    discarded by the first rule it fails. Output: step, rule, before, discarded, after.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    alive = F.lit(True)
    for i, (_, keep) in enumerate(rules):
        k = F.coalesce(keep, F.lit(False))
        aggs.append(F.count_if(alive & ~k).alias(f"_d{i}"))
        alive = alive & k
    row = df.agg(*aggs)
    parts = []
    for i, (name, _) in enumerate(rules):
        before = F.col("_total")
        for j in range(i):
            before = before - F.col(f"_d{j}")
        parts.append(F.struct(F.lit(i + 1).alias("paso"), F.lit(name).alias("regla"),
                              before.cast("bigint").alias("filas_antes"),
                              F.col(f"_d{i}").cast("bigint").alias("descartadas"),
                              (before - F.col(f"_d{i}")).cast("bigint").alias("filas_despues")))
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q2: NULL count per column, one pass, returned long (columna, nulos)."""
    cols = cols or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("columna"), F.col(c).cast("bigint").alias("nulos")) for c in cols]
    return row.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Q2: frequency of each value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def top_k_groups(df: DataFrame, key: str, measure: str, k: int = 5) -> DataFrame:
    """O2: top-k groups by sum, name as tie-break (TakeOrderedAndProject, no global sort)."""
    return (df.groupBy(key).agg(F.sum(measure).alias("total"))
            .orderBy(F.desc("total"), F.asc(key)).limit(k))


def fk_null_report(df: DataFrame, fks: list[str]) -> DataFrame:
    """NULL foreign keys per FK column after the lookups."""
    return null_counts(df, fks).withColumnRenamed("columna", "fk")


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q5: natural keys present more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .where(F.col("n") > 1))


def fk_violations(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Q6: fact rows whose FK has no dimension row (anti join)."""
    return fact.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")



def contract_report(df: DataFrame, contract: list[tuple[str, str, bool, int | None]]) -> DataFrame:
    """K6: check a frame against (column, type, nullable, max length) rules.

    Schema rules (missing column, wrong type) come from the schema; data rules
    (NULL in a non-nullable column, text longer than allowed) are counted in
    one aggregate. Output: columna, regla, infracciones (one row per rule).
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, rows = [], []
    for i, (col, typ, nullable, max_len) in enumerate(contract):
        if col not in types:
            rows.append((col, "faltante", F.lit(1).cast("bigint")))
            continue
        rows.append((col, "tipo", F.lit(0 if types[col] == typ else 1).cast("bigint")))
        if not nullable:
            aggs.append(F.count_if(F.col(col).isNull()).alias(f"_n{i}"))
            rows.append((col, "nulos", F.col(f"_n{i}")))
        if max_len is not None:
            aggs.append(F.count_if(F.length(F.col(col)) > max_len).alias(f"_l{i}"))
            rows.append((col, "longitud", F.col(f"_l{i}")))
    base = df.agg(*(aggs or [F.count(F.lit(1)).alias("_rows")]))
    parts = [F.struct(F.lit(c).alias("columna"), F.lit(r).alias("regla"), v.cast("bigint").alias("infracciones"))
             for c, r, v in rows]
    return base.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def age_text_flags(df: DataFrame, col: str) -> DataFrame:
    """SURVEY quirk #9: age texts sent to "< 1" by the "< 1"/"menor" rule although they
    name a number above 1 (e.g. "menor de 15", "< 10"); the rule is kept, the rows are
    counted per text so the source can be corrected. Output: texto, n."""
    s = F.lower(F.btrim(F.col(col).cast("string"), F.lit(" \t\r\n\f\v")))
    infant = s.contains("< 1") | s.contains("menor")
    nums = F.regexp_extract_all(s, F.lit(r"(\d+)"), 1)
    big = F.exists(nums, lambda x: x.try_cast("bigint") > 1)
    return (df.where(infant & big).groupBy(F.col(col).alias("texto"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


PROFILE_QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def profile_sketches(df: DataFrame) -> DataFrame:
    """Q2: one mergeable row per column of any table, in one pass: exact rows, NULLs,
    least and greatest value, a HyperLogLog sketch of the distinct values and, of
    numbers, a quantile sketch (KLL). Rows of several parts (days, files) are put
    together by ``merge_profiles`` without reading the data again."""
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        c, kind = F.col(f"`{f.name}`"), f.dataType
        number = isinstance(kind, T.NumericType)
        text = c.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(c))
        value = F.when(~F.isnan(c.cast("double")), c.cast("double")) if number else F.lit(None).cast("double")
        aggs += [F.count(F.lit(1)).alias(f"n{i}"), F.count_if(c.isNull()).alias(f"z{i}"), F.hll_sketch_agg(text).alias(f"h{i}"),
                 *([F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}"), F.kll_sketch_agg_double(value).alias(f"k{i}")] if number
                   else [F.min(text).alias(f"a{i}"), F.max(text).alias(f"b{i}")])]
        none, blank = F.lit(None).cast("double"), F.lit(None).cast("string")
        rows.append(F.struct(F.lit(i).alias("posicion"), F.lit(f.name).alias("columna"), F.lit(kind.simpleString()).alias("tipo"),
                             F.col(f"n{i}").alias("filas"), F.col(f"z{i}").alias("nulos"),
                             (F.col(f"a{i}") if number else none).alias("minimo"), (F.col(f"b{i}") if number else none).alias("maximo"),
                             (blank if number else F.col(f"a{i}")).alias("primero"), (blank if number else F.col(f"b{i}")).alias("ultimo"),
                             F.col(f"h{i}").alias("distintos_hll"), (F.col(f"k{i}") if number else F.lit(None).cast("binary")).alias("cuantiles_kll")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Sketch rows of several parts of a table as one row per column."""
    return parts.groupBy("columna").agg(
        F.min("posicion").alias("posicion"), F.first("tipo").alias("tipo"), F.sum("filas").alias("filas"), F.sum("nulos").alias("nulos"),
        F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"), F.min("primero").alias("primero"), F.max("ultimo").alias("ultimo"),
        F.hll_union_agg("distintos_hll").alias("distintos_hll"), F.kll_merge_agg_double("cuantiles_kll").alias("cuantiles_kll"))


def profile(df: DataFrame, quantiles: tuple[float, ...] = PROFILE_QUANTILES) -> DataFrame:
    """Q2: the profile of any table: exact counts and bounds, estimated distinct values
    (about 1.6 % standard error) and quantiles (rank within about 1.7 %)."""
    return finished(profile_sketches(df), quantiles)


def finished(sketches: DataFrame, quantiles: tuple[float, ...] = PROFILE_QUANTILES) -> DataFrame:
    some = F.col("cuantiles_kll").isNotNull() & (F.col("filas") > F.col("nulos")) & F.col("minimo").isNotNull()
    return sketches.select("posicion", "columna", "tipo", "filas", "nulos", "minimo", "maximo", "primero", "ultimo",
                           F.hll_sketch_estimate("distintos_hll").alias("distintos"),
                           F.when(some, F.array(*[F.kll_sketch_get_quantile_double("cuantiles_kll", F.lit(q)) for q in quantiles])).alias("cuantiles"))
