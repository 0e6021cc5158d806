"""Landing jobs (L1-L5, L7, L8): files of one source, whatever their drift, as one
sandbox table with provenance.

A job is: stage the lines of the folder once and number them → recognise each
file's header (S11; ``sources.lines``) → parse every record by its file's layout in
one plan (P1-P5, P17) → blank text to NULL (F26) → provenance triple (P6) → verified
load (K1, K4). Records that do not fit go to ``<source>_rechazos`` with file, line,
reason and text: every record that is not a header is either landed or rejected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions import rules as R
from vitals.operators.align import align, clean_header
from vitals.operators.lookup import bounded
from vitals.operators.reshape import wide_csv_to_long
from vitals.sources import files, layers, lines

ORIGIN, FILE, LOADED = "fuente_origen", "archivo_origen", "fecha_carga"


@dataclass(frozen=True)
class Layout:
    """What the files of a source are aligned to. ``strict``: records with another
    number of cells than the header, an open quote, or a cell that is not of its type
    are rejected instead of filled with NULL; ``strip``: text is trimmed."""
    schema: T.StructType
    renames: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    copy_if_absent: dict[str, str] = field(default_factory=dict)
    sep: str = ","
    name: str = ""
    strict: bool = False
    strip: bool = False

    @property
    def fields(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def places(self, header: list[str]) -> dict[str, int]:
        """Cell of each field in files with this header."""
        names = [clean_header(c) for c in header]
        names = [self.renames[c] if c in self.renames and self.renames[c] not in names else c for c in names]
        at = {c: i for i, c in reversed(list(enumerate(names))) if c not in self.drop}
        at = {c: i for c, i in at.items() if c in self.fields} | {
            t: at[c] for t, c in self.copy_if_absent.items() if t not in at and c in at}
        return at

    def similarity(self, header: list[str]) -> float:
        """Shared names over all names (Jaccard), 0 for a header of another source."""
        names = {clean_header(c) for c in header} - set(self.drop)
        return len(self.places(header)) / max(1, len(names | set(self.fields)) - sum(self.renames.get(c) in self.fields for c in names))


REASON, LINE, RAW = "motivo", "linea", "registro"


@dataclass
class Landed:
    """``rows``: the parsed records of each layout by its name, with file, line,
    reason (NULL: good) and text; ``foreign``: records of files without a known header;
    ``files``: (file, head, layout)."""
    layouts: dict[str, Layout]
    rows: dict[str, DataFrame]
    foreign: DataFrame
    files: DataFrame

    def good(self, name: str = "") -> DataFrame:
        return self.rows[name].where(F.col(REASON).isNull()).select(*self.layouts[name].fields, FILE)

    def rejected(self) -> DataFrame:
        """(file name, line, reason, text) of every record that is not landed."""
        out = self.foreign
        for own in self.rows.values():
            out = out.unionByName(own.where(F.col(REASON).isNotNull()).select(FILE, LINE, REASON, RAW))
        return out


def with_provenance(df: DataFrame, source: str, file_col: str | None = None) -> DataFrame:
    """Source name (rows that name their own keep it), file of the row, load time
    (one instant per job)."""
    name = F.col(file_col) if file_col else F.lit(None).cast("string")
    origin = F.col(ORIGIN) if ORIGIN in df.columns else F.lit(source)
    return df.withColumns({ORIGIN: origin, FILE: name, LOADED: F.current_timestamp()})


def _aligned(df: DataFrame, layout: Layout) -> DataFrame:
    target = T.StructType([*layout.schema.fields, T.StructField(FILE, T.StringType())])
    out = align(df, target, layout.renames, list(layout.drop), layout.copy_if_absent)
    return out.withColumns({f.name: R.blank_to_null(F.col(f"`{f.name}`")) for f in layout.schema.fields
                            if isinstance(f.dataType, T.StringType)})


def file_name(path: Column) -> Column:
    return F.url_decode(F.regexp_extract(path, r"([^/]+)$", 1))


def _parsed(rows: DataFrame, layout: Layout, headers: dict[int, list[str]]) -> DataFrame:
    """Records of one layout: its fields, and why a record is rejected (NULL: it is not)."""
    number = F.col("layout")
    rows = rows.where(number.isin(list(headers)))
    rows = rows.withColumns({f"_p{k}": F.when(number == k, lines.cells_of(F.col("value"), len(h), layout.sep)) for k, h in headers.items()})
    places = {k: layout.places(h) for k, h in headers.items()}

    def cell(name: str) -> Column:
        held = [F.when(number == k, F.col(f"_p{k}._{at[name]}")) for k, at in places.items() if name in at]
        return F.coalesce(*held) if held else F.lit(None).cast("string")

    # step by step, so that each expression is evaluated once and the generated code stays short
    own = layout.schema.fields
    rows = rows.select("file", "line", "value", F.coalesce(*[F.col(f"_p{k}._bad") for k in headers]).isNotNull().alias("_bad"),
                       *[cell(f.name).alias(f"_t{i}") for i, f in enumerate(own)])
    rows = rows.withColumns({f"_t{i}": R.blank_to_null(f"_t{i}") for i in range(len(own))})
    text = [isinstance(f.dataType, T.StringType) for f in own]
    rows = rows.withColumns({f"_v{i}": (R.strip(f"_t{i}") if layout.strip else F.col(f"_t{i}")) if text[i]
                             else R.strip(f"_t{i}").try_cast(f.dataType) for i, f in enumerate(own)})
    reason = F.when(F.coalesce(*[F.col(f"_t{i}") for i in range(len(own))]).isNull(), F.lit("vacia"))
    if layout.strict:
        wrong = [F.when(F.col(f"_t{i}").isNotNull() & F.col(f"_v{i}").isNull(), F.lit(f"tipo:{f.name}")) for i, f in enumerate(own) if not text[i]]
        reason = (F.when(lines.odd_quotes(F.col("value")), F.lit("comillas")).when(F.col("_bad"), F.lit("columnas"))
                  .otherwise(F.coalesce(reason, *wrong)))
    rows = rows.withColumn("_reason", reason)
    # as one struct through a generator: a filter on the outcome stays above the parsing
    return rows.select(F.inline_outer(F.array(F.struct(
        *[F.col(f"_v{i}").alias(f.name) for i, f in enumerate(own)], file_name(F.col("file")).alias(FILE), F.col("line").alias(LINE),
        F.col("_reason").alias(REASON), F.col("value").alias(RAW)))))


def read_files(spark: SparkSession, paths, layouts: Layout | list[Layout], least: float = 0.0, glob: str | None = None) -> Landed:
    """The files below ``paths``, each by the layout its header resembles most
    (similarity above ``least``), in a fixed number of jobs."""
    layouts = [layouts] if isinstance(layouts, Layout) else layouts
    if len({x.sep for x in layouts}) != 1:
        raise ValueError("the layouts of one folder share a separator")
    names = sorted({c.lower() for x in layouts for c in (*x.fields, *x.renames, *x.copy_if_absent.values())})

    def best(header: list[str]) -> Layout | None:
        found = max(layouts, key=lambda x: x.similarity(header))
        return found if found.similarity(header) > least else None

    def hopeful(head: Column) -> Column:
        flat = F.lower(F.regexp_replace(head, r"[\r\n]", ""))
        return F.exists(F.array(*[F.lit(n) for n in names]), lambda n: flat.contains(n))

    found = lines.recognise(spark, paths, layouts[0].sep, hopeful, lambda cells: best(cells) is not None, glob)
    rows = {x.name: _parsed(found.rows, x, {k: h for k, h in found.headers.items() if best(h) is x})
            for x in layouts if any(best(h) is x for h in found.headers.values())}
    if not rows:
        raise ValueError("no readable file")
    head = found.files.select("file", files.looks_like_html(F.col("head")).alias("_html"))
    foreign = (found.rows.where(F.col("layout").isNull()).join(bounded(head), "file")
               .select(file_name(F.col("file")).alias(FILE), F.col("line").alias(LINE),
                       F.when(F.col("_html"), F.lit("html")).otherwise(F.lit("cabecera")).alias(REASON), F.col("value").alias(RAW)))
    return Landed({x.name: x for x in layouts}, rows, foreign, found.files)


def read_json_folder(spark: SparkSession, folder: str, layout: Layout, json_end: str = ".json") -> tuple[DataFrame, list[tuple[str, str]]]:
    """JSON arrays, JSON lines and CSV files of one folder aligned to the layout."""
    arrays, lines = files.split_json(spark, folder, f"*{json_end}")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in layout.schema.fields]
                        + [T.StructField(k, T.StringType()) for k in layout.renames])
    parts = [spark.read.schema(text).option("multiLine", many).json(paths) for many, paths in ((True, arrays), (False, lines)) if paths]
    found = [_aligned(p.withColumn(FILE, F.col("_metadata.file_name")).drop(*[k for k in layout.renames if k in p.columns and layout.renames[k] in p.columns]),
                      layout) for p in parts]
    listed = files.data_files(spark, folder)
    rejected = [(p, "extension") for p in listed if not p.endswith((".csv", json_end))]
    if any(p.endswith(".csv") for p in listed):
        found.append(read_files(spark, folder, layout, glob="*.csv").good(layout.name))
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out, rejected


def land(df: DataFrame, source: str, root: str, layer: str = "sandbox") -> tuple[DataFrame, DataFrame]:
    """The landed table and its load report; a count mismatch raises."""
    loaded = with_provenance(df, source, FILE)
    report = layers.write_verified(loaded, root, layer, source)
    if not report.first().coincide:
        raise RuntimeError(f"{source}: rows read back differ from rows written")
    return layers.read_table(df.sparkSession, root, layer, source), report


def land_files(landed: Landed, source: str, root: str, name: str = "", layer: str = "sandbox") -> tuple[DataFrame, DataFrame]:
    """Lands one layout's records and, where there are any, the rejected ones as
    ``<source>_rechazos``. The good rows and the rejects are counted while the good ones
    are written; a table read back with another count raises. Report: fuente,
    filas_entrada, filas_buenas, filas_rechazadas."""
    spark = landed.foreign.sparkSession
    seen = Observation(f"records_{source}")
    rows = landed.rows[name].observe(seen, F.count(F.lit(1)).alias("all"), F.count(REASON).alias("rejected"))
    good = rows.where(F.col(REASON).isNull()).select(*landed.layouts[name].fields, FILE)
    out, loaded = land(good, source, root, layer)
    rejected = with_provenance(landed.rejected(), source, FILE)
    report = layers.write_verified(rejected, root, layer, f"{source}_rechazos").first()
    written = loaded.first()["filas_escritas"]
    if written + seen.get["rejected"] != seen.get["all"] or not report["coincide"]:
        raise RuntimeError(f"{source}: records landed and rejected are not those read")
    return out, spark.createDataFrame([(source, written + report["filas_escritas"], written, report["filas_escritas"])],
                                      "fuente string, filas_entrada bigint, filas_buenas bigint, filas_rechazadas bigint")


def land_dictionary(spark: SparkSession, paths, root: str, source: str = "INE_DICCIONARIO") -> tuple[DataFrame, DataFrame]:
    """The sheet of codes: merged variable cells filled down, rows without code
    or label (a variable's own header) left out, text trimmed. ``pos``: the row's place,
    by file and line."""
    names = ["variable", "codigo", "etiqueta"]
    rows = files.read_sheet(spark, paths, names, skip=2, fill_down=["variable"]).dropna(subset=["codigo", "etiqueta"])
    return land(rows.select(*[R.strip(c).alias(c) for c in names], F.struct("file", "line").alias("pos"), file_name(F.col("file")).alias(FILE)),
                source, root)


def land_cause_sheet(spark: SparkSession, paths, root: str, source: str = "INE_DICCIONARIO_CIE10") -> tuple[DataFrame, DataFrame]:
    """The sheet of causes: code in upper case, description, place (``pos``)."""
    rows = files.read_sheet(spark, paths, ["codigo_cie10", "descripcion"], skip=2).dropna(subset=["codigo_cie10"])
    return land(rows.select(F.upper(R.strip("codigo_cie10")).alias("codigo_cie10"), R.strip("descripcion").alias("descripcion"),
                            F.struct("file", "line").alias("pos"), file_name(F.col("file")).alias(FILE)), source, root)


def land_wide(spark: SparkSession, paths, n_ids: int, ids: list[str], source: str, root: str,
              value_name: str, date_name: str) -> tuple[DataFrame, DataFrame]:
    """L3: wide files (one column per date) as one row per place and date."""
    rows = wide_csv_to_long(spark, paths, n_ids, ids, value_name, date_name, keep=["file"])
    return land(rows.withColumn(FILE, file_name(F.col("file"))).drop("file"), source, root)


def homologated(landed: Landed, renames: dict[str, dict[str, str]]) -> DataFrame:
    """The good rows of every layout under one set of columns, with the
    layout's name as ``pais`` and typed NULLs where a layout has no such column."""
    out = None
    for name in landed.rows:
        one = landed.good(name).withColumnsRenamed(renames.get(name, {})).withColumn("pais", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
