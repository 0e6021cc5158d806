"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``K`` Gaussian projections cut into bins of width
``W``; its bucket is the tuple of bins. Every row is filed in every table. A query
visits perturbed buckets in the order of their estimated success: a neighbour at
distance r lies in bin h + d of a projection with the probability that a Gaussian
of deviation r moves the query's place there; the product over the projections is
a bucket's chance, and buckets are taken best first until their chances sum to
``TARGET``. Two tables of 0.8 each find a neighbour with probability 0.96. Each
bucket returns its nearest rows for each query that visits it; the tables'
candidates are merged and ranked by exact distance.

``r`` is a matter of each query. At first it is estimated from a random sample of
``SAMPLE`` rows (the query's k-th distance in the sample, drawn in by the local
dimension where the table is larger than the sample). A query whose k-th result
lies beyond that r visits again with r at its k-th result, which no true neighbour
exceeds. A query whose chances stay below ``TARGET`` after ``MAX_PROBES`` visits,
or that finds too few rows, searches all rows, in blocks. ``W`` comes from the
median r of the sample's rows; ``K`` grows with the logarithm of the number of
rows up to ``MAX_K``, beyond which ``MAX_PROBES`` visits would not reach the target
for an r a tenth above the median. All rows are indexed.

Scale. Copies of a vector: only the k + 1 smallest ids of each can be among any
answer, so the others leave early, with map-side combine. Visits are (bucket, query)
pairs without vectors until those of empty buckets are gone. Buckets of more than
``BLOCK`` rows are split into parts and visitors of more than ``BLOCK`` queries into
sides; every part meets every side in a task of its own, which streams the part's
rows after the side's queries. The search of all rows is cut the same way, and the
column ``exact`` names the queries that took it.

Defined results: vectors that are null or zero, hold a null or non-finite
component, or differ in size from the most frequent size take no part, nor do
rows without a ``vec_id``; repeated rows count once; ties go to the smaller
``vec_id``; with fewer candidates than k, all are returned; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import only, read, written
from vitals.operators.lookup import bounded

TOP = 10
TABLES = 2
TARGET = 0.8
SAMPLE = 2_000
BLOCK = 4_096
MAX_PROBES = 4_096
MAX_K = 8


class Hashing:
    """The projections of all tables, and the order in which buckets are tried."""

    def __init__(self, size: int, rows: int, r: float, tables: int = TABLES, target: float = TARGET, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.k = min(MAX_K, max(3, round(math.log2(max(2, rows)) / 3)))
        self.width, self.tables, self.target = 1.8 * r, tables, target
        self.a = rng.standard_normal((tables, size, self.k))
        self.b = rng.uniform(0, self.width, (tables, self.k))

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        return (x @ self.a[table] + self.b[table]) / self.width

    @staticmethod
    def keys(bins: np.ndarray) -> np.ndarray:
        """A 64-bit key of each row of bins."""
        out = np.full(len(bins), 0x51ED270B, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(bins.shape[1]):
                out = (out ^ bins[:, j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                out = out ^ (out >> np.uint64(29))
        return out.view(np.int64)

    def probes(self, place: np.ndarray, r: float) -> np.ndarray:
        """Bins to visit from a place, best first, until a neighbour at distance r
        is met with the chance of the target; none if that takes too many."""
        r = max(r, 1e-6 * self.width)
        home, options = np.floor(place), []
        for x in place - home:
            edge = [0.5 * math.erf((d - x) * self.width / r / math.sqrt(2)) for d in range(-3, 5)]
            options.append(sorted(((hi - lo, d) for lo, hi, d in zip(edge, edge[1:], range(-3, 4), strict=False)), reverse=True))
        start = (0,) * len(place)
        heap, seen, out, sum_ = [(-math.prod(o[0][0] for o in options), start)], {start}, [], 0.0
        while heap and sum_ < self.target and len(out) < MAX_PROBES:
            p, at = heapq.heappop(heap)
            out.append([options[j][i][1] for j, i in enumerate(at)])
            sum_ -= p
            for j, i in enumerate(at):
                if i + 1 < len(options[j]) and options[j][i][0] > 0:
                    nxt = (*at[:j], i + 1, *at[j + 1:])
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(heap, (p * options[j][i + 1][0] / options[j][i][0], nxt))
        return home + np.asarray(out) if sum_ >= self.target else np.zeros((0, len(place)))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stack(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)


_FILED = "table int, key long, id long, vector array<double>"
_VISITS = "table int, key long, id long"
_CELL = ["table", "key", "part", "side"]


def _radius(distances: np.ndarray, rows: int, top: int) -> float:
    """The distance of the top-th neighbour among ``rows`` rows, estimated from the
    distances to a sample of them."""
    m = len(distances)
    if not m:
        return 1.0
    near = np.sort(np.partition(distances, min(2 * top, m) - 1)[:2 * top])
    r, apart = float(near[min(top, m) - 1]), near[near > 1e-9]
    spread = float(np.mean(np.log(near[-1] / apart))) if len(apart) else 0.0  # one over the local dimension
    return r * min(1.0, m / rows) ** min(1.0, spread)


def _file(hashing: Hashing, size: int):
    """Rows (id, vector) under their buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _stack(b.column(1), size)
            for t in range(hashing.tables if len(x) else 0):
                keys = Hashing.keys(np.floor(hashing.places(x, t)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), t, np.int32)), pa.array(keys), b.column(0), b.column(1)],
                                                 names=["table", "key", "id", "vector"])
    return run


def _visit(hashing: Hashing, size: int):
    """The buckets that queries (id, vector, radius) visit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, radii = _stack(b.column(1), size), b.column(2).to_numpy()
            for t in range(hashing.tables):
                places = hashing.places(x, t)
                for i in range(0, len(x), 64):
                    bins = [hashing.probes(p, r) for p, r in zip(places[i:i + 64], radii[i:i + 64], strict=True)]
                    who = pa.array(np.repeat(np.arange(i, i + len(bins)), [len(p) for p in bins]))
                    keys = Hashing.keys(np.concatenate(bins))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), t, np.int32)), pa.array(keys), b.column(0).take(who)],
                                                     names=["table", "key", "id"])
    return run


def _estimated(ids: np.ndarray, sample: np.ndarray, size: int, rows: int, top: int):
    """Queries (id, vector) with their first radius, a little widened."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            radii = [1.05 * _radius(np.sqrt(((sample[ids != i] - v) ** 2).sum(1)), rows, top)
                     for i, v in zip(b.column(0).to_pylist(), _stack(b.column(1), size), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(radii, pa.float64())], names=["id", "vector", "radius"])
    return run


def _search(size: int, top: int):
    """Rows sorted by cell (part and side of a bucket), its queries first: each query's
    nearest rows there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, queries, held, n_held = None, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n_held
            if held and queries:
                ids = np.concatenate([i for i, _ in held])
                x = np.concatenate([v for _, v in held])
                q_ids, found, scores = [], [], []
                several = len(np.unique(ids)) < len(ids)  # an id with several vectors counts by its nearest
                for q_id, q in queries:
                    d = x - q
                    d = np.sqrt(np.einsum("ij,ij->i", d, d))
                    d[ids == q_id] = np.inf
                    some = np.arange(len(d))
                    if several:
                        some = np.lexsort((ids, d))
                        some = some[np.unique(ids[some], return_index=True)[1]]
                    elif len(d) > top:
                        some = np.flatnonzero(d <= np.partition(d, top - 1)[top - 1])
                    some = some[np.lexsort((ids[some], d[some]))][:top]
                    some = some[np.isfinite(d[some])]
                    q_ids.append(np.full(len(some), q_id))
                    found.append(ids[some])
                    scores.append(d[some])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q_ids), pa.int64()), pa.array(np.concatenate(found), pa.int64()),
                                                  pa.array(np.concatenate(scores), pa.float64())], names=["query_id", "vec_id", "score"])
            held, n_held = [], 0

        for b in batches:
            if not b.num_rows:
                continue
            *cell, kind, ids = (b.column(c).to_numpy() for c in (*_CELL, "kind", "id"))
            x = _stack(b.column("vector"), size)
            new = np.flatnonzero(np.any([np.diff(c) != 0 for c in (*cell, kind)], axis=0)) + 1
            for lo, hi in zip([0, *new], [*new, len(ids)], strict=True):
                here = tuple(c[lo] for c in cell)
                if here != part:
                    yield from flush()
                    part, queries = here, []
                if kind[lo] == 0:
                    queries.extend(zip(ids[lo:hi].tolist(), x[lo:hi], strict=True))
                elif queries:
                    held.append((ids[lo:hi], x[lo:hi]))
                    n_held += hi - lo
                    if n_held >= BLOCK:
                        yield from flush()
        yield from flush()
    return run


def _parts() -> Column:
    """Blocks that the rows of a group fill."""
    return F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")


def _one_of(blocks: str) -> Column:
    return F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")


def _all(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def _meet(probes: DataFrame, index: DataFrame, size: int, top: int) -> DataFrame:
    """(query_id, vec_id, score): per visit, the nearest rows. probes and index:
    (table, key, part, side, id, vector)."""
    columns = [*_CELL, "id", "vector"]
    both = probes.select(F.lit(0).alias("kind"), *columns).unionByName(index.select(F.lit(1).alias("kind"), *columns))
    return (both.repartition(*_CELL).sortWithinPartitions(*_CELL, "kind")
            .mapInArrow(_search(size, top), "query_id long, vec_id long, score double"))


def nearest(rows: DataFrame, is_query: Column, top: int = TOP, tables: int = TABLES, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score, exact) for the rows of ``rows`` (vec_id,
    embedding) on which ``is_query`` holds, among all rows; of several vectors of an id
    the smallest asks. ``exact``: the query searched all rows."""
    spark = rows.sparkSession
    own = only(rows, vec_id="long", embedding="array<double>").withColumnRenamed("vec_id", "id").withColumnRenamed("embedding", "vector")
    own = own.where(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = own.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, exact boolean")
    size, n = sizes
    own = own.where(F.size("vector") == size)
    # repeated rows are merged first, with map-side combine: a row repeated often is one row from here on
    copies = Window.partitionBy(F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector")).orderBy("id")
    stored = written(own.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("_count"))
                     .withColumn("_rank", F.dense_rank().over(copies)).where(F.col("_rank") <= top + 1).select("id", "vector"), "vectors")
    n = stored.count()
    queries = written(own.where(is_query).groupBy("id").agg(F.min("vector").alias("vector")), "vector-queries")

    drawn = stored.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    ids, sample = np.array([r["id"] for r in drawn]), np.array([r["vector"] for r in drawn], dtype=float)
    square = (sample ** 2).sum(1)
    pairs = np.sqrt(np.maximum(0, square[:, None] + square - 2 * sample @ sample.T))
    radii = [_radius(d[ids != i], n, top) for i, d in zip(ids, pairs, strict=True)]
    radii = [r for r in radii if r > 1e-6]
    hashing = Hashing(size, n, float(np.median(radii)) if radii else 1.0, tables, target)

    index = written(stored.mapInArrow(_file(hashing, size), _FILED), "vector-index")
    buckets = written(index.groupBy("table", "key").agg(_parts().alias("parts")), "vector-buckets")

    def visited(asked: DataFrame) -> DataFrame:
        """What queries (id, vector, radius) find in the buckets they visit."""
        visits = written(asked.select("id", "vector", "radius").mapInArrow(_visit(hashing, size), _VISITS)
                         .join(bounded(buckets), ["table", "key"]), "vector-visits")
        sides = bounded(written(visits.groupBy("table", "key").agg(F.max("parts").alias("parts"), _parts().alias("sides")), "vector-sides"))
        probes = (visits.drop("parts").join(sides, ["table", "key"])
                  .select("table", "key", _all("parts").alias("part"), _one_of("sides").alias("side"), "id").join(asked.select("id", "vector"), "id"))
        rows = (index.join(sides, ["table", "key"])
                .select("table", "key", _one_of("parts").alias("part"), _all("sides").alias("side"), "id", "vector"))
        return written(merged(_meet(probes, rows, size, top)), "vector-found")

    def merged(some: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return (some.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
                .withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= top).drop("_rank"))

    queries = written(queries.select("id", "vector").mapInArrow(_estimated(ids, sample, size, n, top), "id long, vector array<double>, radius double"),
                      "vector-radii")
    found, short = visited(queries), None
    # queries whose last result lies beyond the radius they covered (or that found too few: null)
    reached = found.groupBy("query_id").agg(F.max("score").alias("last"), F.count(F.lit(1)).alias("c")).where(F.col("c") >= top)
    beyond = written(queries.join(reached, queries["id"] == reached["query_id"], "left").where("last IS NULL OR last > radius")
                     .select("id", "vector", F.col("last").alias("radius")), "vector-beyond")
    if not beyond.isEmpty():
        wider = visited(beyond.where("radius IS NOT NULL"))
        found = found.unionByName(wider)
        # those that no number of visits covers search all rows, in blocks
        enough = wider.groupBy("query_id").count().where(F.col("count") >= top)
        short = written(beyond.join(enough, beyond["id"] == enough["query_id"], "left_anti").select("id", "vector"), "vector-short")
        if not short.isEmpty():
            whole = [F.lit(0).alias("table"), F.lit(0).cast("long").alias("key")]
            blocks = {"parts": F.lit(max(1, -(-n // BLOCK))), "sides": F.lit(max(1, -(-short.count() // BLOCK)))}
            every = stored.withColumns(blocks).select(*whole, _one_of("parts").alias("part"), _all("sides").alias("side"), "id", "vector")
            asked = short.withColumns(blocks).select(*whole, _all("parts").alias("part"), _one_of("sides").alias("side"), "id", "vector")
            found = found.unionByName(_meet(asked, every, size, top))
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    if short is None:
        ranked = ranked.withColumn("exact", F.lit(False))
    else:
        ranked = ranked.join(short.select(F.col("id").alias("query_id"), F.lit(True).alias("exact")), "query_id", "left")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.coalesce("exact", F.lit(False)).alias("exact"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
