"""Near-duplicate documents by an exact prefix-filtered similarity join.

A document is the set of its distinct word shingles; without words it is the
empty set and linked with nothing. Documents with Jaccard similarity of at least
``percent`` / 100 are linked; linked documents, taken transitively, are a group,
named after its smallest ``doc_id``. No link is lost.

Prefixes. Linked sets share at least ``need`` = ceil(percent * n / 100) shingles of
either (n its size). So in any one order of all shingles both hold a common
shingle among their first n - need + 1: their first common one. More generally
the first n - need + l shingles of one of them hold l common ones, which the
other has in its own first.

Signature, for speed alone. ``CHUNKS`` x ``WIDTH`` minhashes, of each the lowest
16 bits, filed under ``CHUNKS * WIDTH`` keys: a chunk, the component left out, the
rest. Two signatures at a distance below 2 * CHUNKS share a key, so most linked sets
meet there; those that do not are found by their prefixes.

Steps. (1) Equal sets are one class, represented by its smallest ``doc_id``; only
representatives go on. (2) By the order of the hashes, with l = n / ``SPARE``: a set
of whose first shingles too few are among the first of another set links with
nothing and leaves. (3) The sets that stay are counted out shingle by shingle and
ordered by rarity; each is filed under the shingles of its prefix that others
hold too. (4) Every one is compared with one leader of its buckets of signatures
(the one with the smallest share of shingles of its own, which is the least edited of a
group of copies; in later rounds among a quarter drawn by hash), on the full sets;
links make components. Members of one component need no further comparison, so
a bucket of n alike documents costs n comparisons, not n * n. (5) Rounds repeat
on the buckets that still hold several components, as long as they merge
components (at most ``ROUNDS``; this saves work and decides nothing). (6) All
pairs of different components that are left under a shingle are compared: by sizes,
by what can follow their first common shingle and by parity sketches (sets that
differ in d shingles differ in at most d bits) within the join's condition, then
on the full sets. (7) Components are closed by label propagation with
pointer jumping.

Scale. Buckets are never gathered: leaders come from an aggregation, comparisons
are rows of a join. Sets are 64-bit hashes of shingles, written once for the
representatives that step 2 leaves, and travel as arrays. Labels and
links stay in tables. Every round is written to the shared folder.

Defined results: a null or empty text gives an empty set; rows of one ``doc_id``
are one document, whose largest set counts; rows without a ``doc_id`` are left
out, having no name for a class; an empty table gives no row; other columns are
ignored. ``drop_near``, the pipeline's stage, compares rows instead: every row is a
document of its own, also one without a ``doc_id`` or one of several texts of a
``doc_id``; the row with the smallest ``doc_id`` of a group stays, rows without one
last; repeated rows are one group, and rows without words all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import once, only, read, release, written

SHINGLE_WORDS = 5
PERCENT = 80
CHUNKS, WIDTH = 8, 5
#: a tenth of a set more than its prefix tells which sets can have a link at all
SPARE = 10
#: words of 64 bits of a parity sketch
SKETCH = 16
ROUNDS = 8
#: words whose hashes a worker keeps, some 200 bytes each
MOST_WORDS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------- sets of a text

def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash
    table = once(("words",), dict)
    if len(table) > MOST_WORDS:
        table.clear()
    try:
        return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in set(words):
            if w not in table:
                table[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes. ASCII letters are lower-cased and words
    split at ASCII white space, both by the byte methods of that meaning."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = _word_hashes(words)
    n = max(1, len(h) - width + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, min(len(h), width), np.uint64)
        for k in range(min(width, len(h))):
            out = _mixed(out * _ODD + h[k:k + n])
    return np.unique(out)


def least_shared(n: int, percent: int) -> int:
    """What a set of n shingles shares at least with any set it is linked to."""
    return -(-percent * n // 100)


def first_items(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The prefix by the order of hashes that step 2 compares."""
    n = len(shingles)
    return shingles[:min(n, n - least_shared(n, percent) + -(-n // SPARE))]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Of each of 64 * SKETCH classes of shingles, whether the set holds an odd number."""
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 2**63, CHUNKS * WIDTH, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, CHUNKS * WIDTH, np.uint64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Lowest 16 bits of each minhash (top bits of multiply-add permutations)."""
    a, b = once(("seeds",), _seeds)
    low = np.empty(len(a), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(len(a)):
            low[k] = (shingles * a[k] + b[k]).min()
    return (_mixed(low) & np.uint64(0xFFFF)).astype(np.int32)


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """The 64-bit keys of a signature: each chunk with each component left out."""
    rows = sig.astype(np.uint64).reshape(CHUNKS, 1, WIDTH).repeat(WIDTH, axis=1)
    rows[:, range(WIDTH), range(WIDTH)] = 0xFFFFF  # no component has this value
    out = np.arange(CHUNKS, dtype=np.uint64).reshape(CHUNKS, 1).repeat(WIDTH, axis=1)
    with np.errstate(over="ignore"):
        for k in range(WIDTH):
            out = _mixed(out * _ODD + rows[:, :, k] + np.uint64(1))
    return out.ravel().view(np.int64)


_SETS = "doc long, n int, set1 long, set2 long, first array<long>"


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    """An array column of long; made from one buffer, not value by value."""
    at = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(at, pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64()))


def _summaries(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        release("words")
        for b in batches:
            n, one, two, first = [], [], [], []
            for text in b.column(1):
                s = shingle_set(text.as_py(), width)
                data = s.tobytes()
                n.append(len(s))
                one.append(xxhash.xxh64_intdigest(data, 1) - 2**63)
                two.append(xxhash.xxh64_intdigest(data, 2) - 2**63)
                first.append(first_items(s, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), _lists(first)],
                names=["doc", "n", "set1", "set2", "first"])
    return run


def _full_sets(width: int):
    """Sets of (doc, text, set1), of rows whose set is the one looked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        release("words", "seeds")
        for b in batches:
            docs, sets, bits, keys = [], [], [], []
            for doc, text, name in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                s = shingle_set(text.as_py(), width)
                if xxhash.xxh64_intdigest(s.tobytes(), 1) - 2**63 == name:
                    docs.append(doc)
                    sets.append(np.sort(s.view(np.int64)))
                    bits.append(sketch(s))
                    keys.append(bucket_keys(signature(s)))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), _lists(sets), _lists(bits), _lists(keys)],
                                             names=["doc", "items", "bits", "keys"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i in range(b.num_rows):
                x, y = (b.column(c)[i].values.to_numpy() for c in ("items_a", "items_b"))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(keep, pa.int64())),
                                              b.column("b").take(pa.array(keep, pa.int64()))], names=["a", "b"])
    return run


# ------------------------------------------------------------------------ Spark parts

def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("doc").alias(k), F.col("items").alias(f"items_{k}")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b").mapInArrow(_linked(percent), "a long, b long")


def closed(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components: (doc, comp) with ``comp`` the smallest label reachable over
    the links, starting from ``labels``. A round hands every component the
    smallest label next to it and then jumps along labels of labels."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    while True:
        of = labels.select(F.col("doc").alias("a"), F.col("comp").alias("x"))
        to = labels.select(F.col("doc").alias("b"), F.col("comp").alias("y"))
        # components next to one another; a component adopts the smallest one
        down = (both.join(of, "a").join(to, "b").where("y < x").groupBy("x").agg(F.min("y").alias("y")))
        down = written(down, "component-steps")
        if down.isEmpty():
            return labels
        for _ in range(2):  # x -> y -> where y itself goes
            on = down.select(F.col("x").alias("y"), F.col("y").alias("z"))
            down = down.join(on, "y", "left").select("x", F.coalesce("z", "y").alias("y"))
        labels = written(labels.join(down, labels["comp"] == down["x"], "left")
                         .select("doc", F.coalesce("y", "comp").alias("comp")), "components")


def _leader_pairs(filed: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b): each document with one leader of its buckets that lies in another
    component: the first by the share of shingles of its own (copies of one text
    meet in the least edited), in later rounds among a quarter drawn by hash."""
    rank = F.struct(F.lit(turn > 0) & (F.pmod(F.xxhash64(F.lit(turn), "doc"), F.lit(4)) > 0), F.col("own") / F.col("n"))
    known = filed.join(labels, "doc")
    lead = (known.groupBy("key").agg(F.min(F.struct(rank.alias("r"), "doc", "comp")).alias("lead"),
                                     F.min("comp").alias("low"), F.max("comp").alias("high"))
            .where("low < high").select("key", "lead"))
    return (known.join(lead, "key").where("comp <> lead.comp")
            .groupBy("doc").agg(F.min("lead").alias("lead")).select(F.col("doc").alias("a"), F.col("lead.doc").alias("b")))


def _rest_links(filed: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among all pairs that share a key and lie in different components.
    Under the key that is their first common shingle, what both share is at most the
    shorter of their rests; so a linked pair comes out under one key at least."""
    known = filed.join(labels, "doc")
    open_keys = known.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    words = sets.select("doc", *[F.col("bits")[k].alias(f"w{k}") for k in range(SKETCH)])
    left = known.join(open_keys, "key").join(words, "doc")
    a, b = (left.select("key", *[F.col(c).alias(f"{c}_{k}") for c in ("doc", "comp", "n", "rest", *words.columns[1:])]) for k in "ab")
    both = F.col("n_a") + F.col("n_b")
    apart = sum((F.bit_count(F.col(f"w{k}_a").bitwiseXOR(F.col(f"w{k}_b"))) for k in range(1, SKETCH)),
                F.bit_count(F.col("w0_a").bitwiseXOR(F.col("w0_b"))))
    near = ((F.col("doc_a") < F.col("doc_b")) & (F.col("comp_a") != F.col("comp_b"))
            & ((100 + percent) * F.least("n_a", "n_b", "rest_a", "rest_b") >= percent * both)
            & ((100 + percent) * apart <= (100 - percent) * both))
    pairs = (a.join(b.withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & near)
             .select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).distinct())
    return verified(pairs, sets, percent)


def _able(summary: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The representatives (doc, n, set1) that can have a link: enough of their first
    shingles are among the first of another set. summary: (set1, first)."""
    names = (summary.where("n > 0").select("set1", F.explode("first").alias("item"))
             .groupBy("item").agg(F.min("set1").alias("set1"), F.max("set1").alias("last")))
    own = names.where("set1 = last").groupBy("set1").agg(F.count(F.lit(1)).alias("own"))
    need = f"(({percent} * n + 99) div 100)"
    held = f"least(n, n - {need} + (n + {SPARE - 1}) div {SPARE})"
    # the other set has ``need`` shingles at least, and a prefix that long
    return reps.join(own, "set1", "left").where(F.expr(f"{held} - coalesce(own, 0) >= ({need} + {SPARE - 1}) div {SPARE}")).drop("own")


def _shared(filed: DataFrame) -> DataFrame:
    """The keys that several documents are filed under."""
    return filed.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key")


def _filed(sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(key, doc, n, own, rest): sets under the shingles of their prefixes that several
    prefixes hold. Shingles are ordered by rarity, so those of one set alone
    (``own`` of them) come first; ``rest`` counts the shingles from the key on."""
    items = sets.select("doc", F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    of_doc = Window.partitionBy("doc")
    prefix = (items.join(often, "item").join(reps.select("doc", "n"), "doc")
              .select("doc", "n", F.col("item").alias("key"), (F.col("n") - F.count(F.lit(1)).over(of_doc)).alias("own"),
                      F.row_number().over(of_doc.orderBy(F.col("c").desc(), F.col("item").desc())).alias("rest"))
              .where(F.expr(f"100 * rest >= {percent} * n")))
    prefix = written(prefix, "near-prefixes")
    return written(prefix.join(_shared(prefix), "key"), "near-buckets")


def components(docs: DataFrame, summary: DataFrame, reps: DataFrame, shingle_words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc, comp) of the representatives that share a key, and the links found.
    docs: (doc, text)."""
    able = written(_able(summary, reps, percent), "near-able")
    sets = written(docs.join(able.select("doc", "set1"), "doc").select("doc", "text", "set1")
                   .mapInArrow(_full_sets(shingle_words), "doc long, items array<long>, bits array<long>, keys array<long>")
                   .dropDuplicates(["doc"]), "near-sets")
    filed = _filed(sets, able, percent)
    members = written(filed.select("doc", "n", "own").distinct(), "near-members")
    every = sets.join(members, "doc").select(F.explode("keys").alias("key"), "doc", "n", "own")
    alike = written(every.join(_shared(every), "key"), "near-signatures")
    labels = written(members.select("doc").withColumn("comp", F.col("doc")), "components")
    found = []
    for turn in range(ROUNDS):
        links = written(verified(_leader_pairs(alike, labels, turn), sets, percent), "near-links")
        if links.isEmpty():
            break
        found.append(links)
        labels = closed(labels, links)
    links = written(_rest_links(filed, labels, sets, percent), "near-links")
    found.append(links)
    labels = closed(labels, links)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return labels, every


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per ``doc_id`` of ``docs`` (doc_id, text): doc_id, n_shingles,
    class_id (smallest document with the same set), component_id, kept. Of
    several texts under one ``doc_id`` the one with the largest set counts."""
    own = only(docs, doc_id="long", text="string").where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "doc")
    every = written(own.mapInArrow(_summaries(shingle_words, percent), _SETS), "near-summaries")
    summary = written(every.groupBy("doc").agg(F.max(F.struct("n", "set1", "set2")).alias("s")).select("doc", "s.*"), "near-sets-of")
    classes = written(summary.where("n > 0").groupBy("n", "set1", "set2").agg(F.min("doc").alias("rep")), "near-classes")
    reps = classes.select(F.col("rep").alias("doc"), "n", "set1")
    labels, _ = components(own, every, reps, shingle_words, percent)
    named = (classes.join(labels, classes["rep"] == labels["doc"], "left")
             .select("n", "set1", "set2", "rep", F.coalesce("comp", "rep").alias("comp")))
    return (summary.join(named, ["n", "set1", "set2"], "left")
            .select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("rep", "doc").alias("class_id"),
                    F.coalesce("comp", "doc").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def drop_near(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The first row of each group of ``docs``, with its columns, by ``doc_id``
    (null last), then by text."""
    # numbers of rows, which hold because the rows are written with them
    rows = written(docs.select("*", F.monotonically_increasing_id().alias("_near_row")), "near-rows")
    groups = near_groups(rows.select(F.col("_near_row").alias("doc_id"), "text"), shingle_words, percent)
    names = rows.select("_near_row", F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
    first = (groups.select(F.col("doc_id").alias("_near_row"), "component_id").join(names, "_near_row")
             .groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_text", "_near_row")).alias("first")))
    return rows.join(first.select(F.col("first._near_row").alias("_near_row")), "_near_row", "left_semi").select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"), shingle_words=4).select("doc_id", "n_shingles", "component_id", "kept")
