"""Fill-in-the-middle texts, cut with a piecewise-linear learned rank index.

A text's units (a word with the white space before it, or trailing white space)
have boundaries at ranks 0 to n; the index says at which code point a rank lies.
It is learned per text: one pass over all boundary offsets fits line segments
through their first point whose error stays below ``ERROR`` (the cone of slopes
that keep every boundary within the bound shrinks until it is empty, then a new
segment starts), and stores what is left over per rank in one byte. A cut is
predicted from the segment of its rank and set right by that byte. Slopes are
integers over 2^SHIFT, so the fit in Python and the prediction in the JVM agree
to the code point. Cuts come from a hash of seed and id; other seeds (epochs)
use the same index.

Scale. One pass without a shuffle: Python fits the index and sees the text once,
cutting, joining and digests are Column expressions. A long text has more
segments, and its index takes one byte a unit.

Defined results: a null or empty text is plain, with n = 0; a text that holds a
sentinel is plain; repeated rows give equal rows; a null id hashes as empty
text and stays; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import only, read

#: a prediction is at most this many code points off; with rounding it fits a byte
ERROR = 120
SHIFT = 20
#: ranks of a segment, so that rounding a slope moves no prediction by one code point
LONGEST = 1 << (SHIFT - 1)
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

INDEX = "struct<n:bigint,start:array<int>,offset:array<int>,slope:array<bigint>,rest:array<tinyint>>"


def boundaries(text: str) -> np.ndarray:
    """Offsets in code points of the boundaries 0 to n of a text's units."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    space = (points == 32) | (points - np.uint32(9) <= 4)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.concatenate([[0], ends, [len(points)]] if len(points) else [[0]]).astype(np.int64)


def fit(bounds: np.ndarray) -> tuple[list[int], list[int], list[int], np.ndarray]:
    """Segments (first rank, its offset, slope) and the residual of every rank."""
    starts, offsets, slopes, rest, size, at = [], [], [], [], len(bounds), 0
    while at < size:
        low, high, end, width, most = -np.inf, np.inf, at + 1, 256, min(size, at + LONGEST)
        while end < most:
            upto = min(most, end + width)
            x, y = np.arange(end - at, upto - at), bounds[end:upto] - bounds[at]
            lows = np.maximum(low, np.maximum.accumulate((y - ERROR) / x))
            highs = np.minimum(high, np.minimum.accumulate((y + ERROR) / x))
            empty = np.flatnonzero(lows > highs)
            good = int(empty[0]) if empty.size else upto - end
            if good:
                low, high, end = lows[good - 1], highs[good - 1], end + good
            if empty.size:
                break
            width *= 2
        slope = int((low + high) / 2 * (1 << SHIFT)) if end > at + 1 else 0
        starts.append(at)
        offsets.append(int(bounds[at]))
        slopes.append(slope)
        rest.append(bounds[at:end] - bounds[at] - ((slope * np.arange(end - at)) >> SHIFT))
        at = end
    return starts, offsets, slopes, np.concatenate(rest).astype(np.int8)


def _index(texts: pa.Array) -> pa.Array:
    found = [fit(boundaries(t.as_py() or "")) for t in texts]

    def lists(values: list, kind: pa.DataType) -> pa.Array:
        at = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
        flat = np.concatenate(values) if values else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))

    return pa.StructArray.from_arrays(
        [pa.array([len(f[3]) - 1 for f in found], pa.int64()), lists([f[0] for f in found], pa.int32()),
         lists([f[1] for f in found], pa.int32()), lists([f[2] for f in found], pa.int64()),
         lists([f[3] for f in found], pa.int8())], ["n", "start", "offset", "slope", "rest"])


def with_index(docs: DataFrame, name: str = "index") -> DataFrame:
    """``docs`` with the rank index of ``text`` as a column."""
    return docs.withColumn(name, F.arrow_udf(_index, INDEX)(F.col("text")))


def offset_of(index: Column, rank: Column) -> Column:
    """The code point at which a boundary lies: predicted, then set right."""
    segment = F.size(F.filter(index["start"], lambda s: s <= rank)) - 1
    of = partial(lambda part, k: F.get(index[part], k), k=segment)
    steps = F.shiftright(of("slope") * (rank - of("start")), SHIFT)
    return (of("offset") + steps + F.get(index["rest"], rank.cast("int"))).cast("int")


def _hash(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) of ``docs`` (doc_id, text)."""
    own = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    held = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.col("text").contains(sentinel)
    ranked = (with_index(own).withColumn("_digest", digest)
              .withColumns({"_a": F.pmod(_hash(F.col("_digest"), 0), F.col("index.n") + 1),
                            "_b": F.pmod(_hash(F.col("_digest"), 1), F.col("index.n") + 1),
                            "form": F.when((F.col("text") == "") | held | (F.pmod(_hash(F.col("_digest"), 2), F.lit(100)) >= percent), "plain")
                            .when(F.pmod(_hash(F.col("_digest"), 3), F.lit(100)) < spm_percent, "spm").otherwise("psm")}))
    cut = ranked.select("doc_id", "text", F.col("index.n").alias("n"), "form",
                        *[F.when(F.col("form") != "plain", offset_of(F.col("index"), rank)).alias(name)
                          for name, rank in (("_first", F.least("_a", "_b")), ("_last", F.greatest("_a", "_b")))])
    text = F.col("text")
    prefix, middle = text.substr(F.lit(1), F.col("_first")), text.substr(F.col("_first") + 1, F.col("_last") - F.col("_first"))
    suffix = text.substr(F.col("_last") + 1, F.length("text"))
    parts = cut.select("doc_id", "text", "n", "form", F.length(prefix).cast("long").alias("prefix_chars"),
                       F.length(middle).cast("long").alias("middle_chars"),
                       F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
                       .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
                       .otherwise(text).alias("output"))
    return parts


def restored(output: Column, form: Column) -> Column:
    """The text read back from an output: no sentinel occurs in its parts, and none
    can begin in a part and end in a sentinel."""
    second = F.locate(SUFFIX, output), F.locate(PREFIX, output)
    last = F.locate(MIDDLE, output)
    width = len(PREFIX)

    def halves(at: Column) -> tuple[Column, Column]:
        return output.substr(F.lit(width + 1), at - 1 - width), output.substr(at + width, last - at - width)

    middle = output.substr(last + width, F.length(output))
    (prefix, suffix), (other_suffix, other_prefix) = halves(second[0]), halves(second[1])
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(other_prefix, middle, other_suffix)).otherwise(output))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms of every document, with digests of output and restored text."""
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: The rule in SQL, without the index.
FILL_MIDDLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
hashed AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM units),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:n], '') AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
