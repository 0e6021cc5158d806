"""Line de-duplication over a sharded minimal perfect hash.

A line's key is the line without ASCII white space at both ends and with A-Z in
lower case. Keys of at least ``min_chars`` code points that occur in two or more
documents lose their lines everywhere but in the smallest ``doc_id`` that holds
them.

How it runs. (1) Every line gives two independent hashes of its key (two
64-bit hashes, so 128 bits name a key); one aggregation with map-side combine
keeps, per hash pair, the number of lines and the smallest ``doc_id``. Only
pairs held by two documents go on. (2) The pairs are dealt into shards by hash;
one task per shard builds a minimal perfect hash over its hash pairs and, in its order, a fingerprint array (the second hash), a count array and an owner
array, written as one row of a table in the shared folder. (3) Documents send
(hash pairs, line positions) to the shards, not their lines; a probe task loads
the arrays of the shards it was dealt and answers with the positions to drop.
(4) The positions of a document meet its text again, and the kept lines are
joined. A key that no index holds lands on some slot whose fingerprint differs.

Scale. A shard holds about ``shard_keys`` keys, whatever the input; the number of
shards grows with the number of repeated keys. A very common line is one key of
its shard: its probes are rows that are dealt out by shard and by a salt of the
document, so many tasks share them, each with its own copy of the arrays. Lines
themselves are never shuffled on their own.

Defined results: null and empty texts are one empty line; copies of a row (same
``doc_id``) count as one document and lose the same lines; a null ``doc_id`` counts as
larger than any other; an empty table gives no row; other columns of the table
are ignored. Two texts under one ``doc_id`` are two parts of one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import ASCII_SPACE, only, read, release, written

MIN_CHARS = 10
SHARD_KEYS = 1 << 18
#: lines that ask one copy of a shard
ASKED = 1 << 17
_LAST = (1 << 63) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------- minimal perfect hash

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer of x ^ seed-dependent constant (uint64 arithmetic)."""
    with np.errstate(over="ignore"):
        z = x ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash by levels of collision-free bits: a key sits at the
    first level where it meets no other; its slot is the rank of its bit. About
    four bits a key; ``levels`` is all there is to store. A key is one 64-bit value
    or a pair of them; pairs that share a first value part at some level."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.starts, self.ranks, at = [], [], 0
        for bits in levels:
            ones = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(ones - bits)
            self.starts.append(at)
            at += int(ones[-1]) if len(ones) else 0
        self.size = at

    @staticmethod
    def _at(keys: np.ndarray, seconds: np.ndarray | None, level: int, m: int) -> np.ndarray:
        if seconds is not None:
            with np.errstate(over="ignore"):  # of one first value, different seconds stay different
                keys = keys + seconds * np.uint64(2 * level + 1)
        return (_mix(keys, level) % np.uint64(m)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, load: float = 1.5, seconds: np.ndarray | None = None) -> PerfectHash:
        """keys: distinct unsigned 64-bit values, or with ``seconds`` distinct pairs."""
        left, levels = keys.astype(np.uint64), []
        while len(left):
            m = max(8, int(len(left) * load))
            at = cls._at(left, seconds, len(levels), m)
            hit = np.bincount(at, minlength=m)
            levels.append((hit == 1).astype(np.uint8))
            met = hit[at] > 1
            left, seconds = left[met], None if seconds is None else seconds[met]
        return cls(levels)

    def slots(self, keys: np.ndarray, seconds: np.ndarray | None = None) -> np.ndarray:
        """The slot of each key; -1 or any slot for a key that is not in the set."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for k, bits in enumerate(self.levels):
            at = self._at(keys[todo], None if seconds is None else seconds[todo], k, len(bits))
            found = bits[at] == 1
            out[todo[found]] = self.starts[k] + self.ranks[k][at[found]]
            todo = todo[~found]
        return out

    def to_bytes(self) -> tuple[bytes, list[int]]:
        return b"".join(np.packbits(b).tobytes() for b in self.levels), [len(b) for b in self.levels]

    @classmethod
    def from_bytes(cls, data: bytes, sizes: list[int]) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            width = (n + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at))[:n])
            at += width
        return cls(levels)


# -------------------------------------------------------------------- Spark parts

def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lowered; ``lower`` does that for
    lines of ASCII, other letters must stay as they are."""
    bare = F.btrim(line, F.lit(ASCII_SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, body, at, h1, h2): the lines whose keys are long enough. ``body``
    tells texts under one doc_id apart."""
    keys = F.transform(F.split("text", "\n"), lambda x: line_key(x))
    return (docs.select("doc", F.xxhash64("text").alias("body"), F.posexplode(keys).alias("at", "key"))
            .where(F.length("key") >= min_chars)
            .select("doc", "body", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))


def _shard(h1: Column, shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h1, 17), F.lit(shards)).cast("int")


_INDEX = "shard int, bits binary, sizes array<int>, prints binary, counts binary, owners binary"


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys, seconds = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    mph = PerfectHash.build(keys, seconds=seconds)
    at = mph.slots(keys, seconds)

    def placed(column: str, kind: str) -> bytes:
        values = np.empty(len(keys), dtype=kind)
        values[at] = rows[column].to_numpy()
        return values.tobytes()
    bits, sizes = mph.to_bytes()
    return pd.DataFrame([{"shard": key[0], "bits": bits, "sizes": sizes, "prints": placed("h2", "<i8"),
                          "counts": placed("n", "<i8"), "owners": placed("owner", "<i8")}])


def build_index(lines: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The index table (a row per shard) and its number of shards."""
    spread = (lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("owner"), F.max("doc").alias("last"))
              .where("owner < last").drop("last"))
    repeated = written(spread, "line-keys")
    shards = max(1, -(-repeated.count() // shard_keys))
    built = (repeated.withColumn("shard", _shard(F.col("h1"), shards)).groupBy("shard").applyInPandas(_build, _INDEX))
    return written(built, "line-index"), shards


_PROBED = "doc long, body long, drop array<int>"


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, the index row of a shard before its probes."""
    release()
    shard, mph = None, None
    prints = owners = counts = np.zeros(0, "<i8")
    for b in batches:
        docs, bodies, drop = [], [], []
        shards, sizes, own, body = (b.column(c).to_pylist() for c in ("shard", "sizes", "doc", "body"))
        for i in range(b.num_rows):
            if sizes[i] is not None:
                shard, mph = shards[i], PerfectHash.from_bytes(b.column("bits")[i].as_py(), sizes[i])
                prints = np.frombuffer(b.column("prints")[i].as_py(), "<i8")
                owners = np.frombuffer(b.column("owners")[i].as_py(), "<i8")
                counts = np.frombuffer(b.column("counts")[i].as_py(), "<i8")
            elif shard == shards[i] and len(prints):
                h1, h2, at = (b.column(c)[i].values.to_numpy() for c in ("h1", "h2", "at"))
                slot = mph.slots(h1.view(np.uint64), h2.view(np.uint64))
                hit = (slot >= 0) & (prints[slot] == h2) & (counts[slot] > 1) & (owners[slot] != own[i])
                if hit.any():
                    docs.append(own[i])
                    bodies.append(body[i])
                    drop.append(at[hit])
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(bodies, pa.int64()),
                                          pa.array(drop, pa.list_(pa.int32()))], names=["doc", "body", "drop"])


def drops(lines: DataFrame, index: DataFrame, shards: int, asked: int = ASKED) -> DataFrame:
    """(doc, body, drop): the positions of the lines that go. A shard is copied to as
    many tasks as its share of the lines needs, so that no task is asked for more than
    about ``asked`` of them, however few shards there are."""
    salts = max(1, -(-lines.count() // (shards * asked)))  # the count comes from the footers
    ask = (lines.withColumn("shard", _shard(F.col("h1"), shards))
           .groupBy("doc", "body", "shard").agg(F.collect_set(F.struct("at", "h1", "h2")).alias("x"))
           .select("shard", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int").alias("salt"), "doc", "body",
                   F.col("x.at").alias("at"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2")))
    arrays = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = arrays.unionByName(ask, allowMissingColumns=True)
    return (both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("sizes").isNull())
            .select("shard", "bits", "sizes", "prints", "owners", "counts", "doc", "body", "at", "h1", "h2")
            .mapInArrow(_probe, _PROBED)
            .groupBy("doc", "body").agg(F.array_distinct(F.flatten(F.collect_list("drop"))).alias("drop")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with its columns, the text without the lines
    that go, and ``n_lines`` and ``n_dropped`` beside it (in the place of columns
    of these names)."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    lines = written(_lines(docs.select(doc, text), min_chars), "line-hashes")
    index, shards = build_index(lines, shard_keys)
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    rows = docs.select(doc, text, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")).withColumn("body", F.xxhash64("text"))
    out = (rows.join(drops(lines, index, shards), ["doc", "body"], "left")
           .withColumn("lines", F.split("text", "\n"))
           .withColumn("n_dropped", F.coalesce(F.size("drop"), F.lit(0)).cast("long")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    text = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    return out.select(*[text.alias(c) if c == "text" else F.col("rest").getField(c).alias(c)
                        for c in docs.columns if c in rest or c == "text"],
                      F.size("lines").cast("long").alias("n_lines"), "n_dropped")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(read(spark, sf_dir, "documents"), doc_id="long", text="string")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The rule in SQL, without the index.
LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line,
         translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, i, line, (r.owner IS NOT NULL AND r.owner <> doc_id) AS gone
  FROM lines l LEFT JOIN repeated r ON r.k = l.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
