"""N-best segmentation into pieces, encoding and decoding.

The lattice of a pre-token has an edge for every piece that occurs in it. A
forward Viterbi pass gives each position the score of its best way from the
start. The backward search starts at the end and expands partial paths in the
order of (score to the end + Viterbi score of the position): as that forward
score is exactly what the rest of the path can reach, the A* search pops complete
paths best first and touches little else. Equal totals go to the path nearest the
start, and a position that n paths have left needs no further ones, so a run of one
letter costs n expansions a position at most. No piece crosses pre-tokens, so a text's lattice is the
chain of theirs and its n best segmentations combine their lists: a combination among the
n best changes only some of the n - 1 pre-tokens whose second choice costs least.

Scale. One pass without a shuffle; each distinct pre-token of a worker is searched
once while it stays in a bounded table.

Defined results: a null or empty text has one segmentation, the empty one; ties
go to the path found first, which depends on the text alone; repeated rows give
equal rows; null ids stay; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vitals.llm.common import once, only, read
from vitals.llm.pieces import Pieces

N_BEST = 3


def forward(unit: str, pieces: Pieces) -> tuple[list[float], list[float], list[tuple[int, int]]]:
    """Viterbi scores, scores of the second best ways, and the last edge (start,
    id) of the best way, for each position of a pre-token."""
    size, missing, trie = len(unit), pieces.missing, pieces.trie
    best, second, last = [-1e300] * (size + 1), [-1e300] * (size + 1), [(0, -1)] * (size + 1)
    best[0] = 0.0
    for i in range(size):
        level, at, other, j, single = trie, best[i], second[i], i, False
        while j < size:
            node = level.get(unit[j])
            if node is None:
                break
            j += 1
            level, k, score = node
            if k >= 0:
                single = single or j == i + 1
                value = at + score
                if value > best[j]:
                    second[j] = max(best[j], other + score)
                    best[j], last[j] = value, (i, k)
                elif value > second[j]:
                    second[j] = value
        if not single:
            j, value = i + 1, at + missing
            if value > best[j]:
                second[j] = max(best[j], other + missing)
                best[j], last[j] = value, (i, -1)
            elif value > second[j]:
                second[j] = value
    return best, second, last


def n_best(unit: str, pieces: Pieces, n: int) -> list[tuple[float, list[int]]]:
    """The n best (score, ids) of a pre-token, best first: backward A* search
    over its lattice with the forward scores as heuristic."""
    best = forward(unit, pieces)[0]
    size = len(unit)
    ends: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
    for i in range(size):
        level, j, single = pieces.trie, i, False
        while j < size and (node := level.get(unit[j])) is not None:
            j += 1
            level, k, score = node
            if k >= 0:
                single = single or j == i + 1
                ends[j].append((i, score, k))
        if not single:
            ends[i + 1].append((i, pieces.missing, -1))
    out: list[tuple[float, list[int]]] = []
    heap = [(-best[size], size, 0, 0.0, None)]
    made, left = 0, [n] * (size + 1)
    while heap and len(out) < n:
        total, j, _, after, path = heapq.heappop(heap)
        if j == 0:
            ids: list[int] = []
            while path is not None:
                k, at, path = path
                ids.extend([k] if k >= 0 else pieces.bytes_of(unit[at]))
            out.append((-total, ids))
            continue
        if not left[j]:
            continue
        left[j] -= 1
        for i, score, k in ends[j]:
            made += 1
            heapq.heappush(heap, (-(best[i] + score + after), i, made, after + score, (k, i, path)))
    return out


class _Entries(dict):
    """Pre-token -> (score, ids, loss of the second choice), made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, unit: str) -> tuple[float, bytes, float]:
        entry = self[unit] = self.make(unit)
        return entry


class Segmenter:
    """Keeps, per pre-token, its best score and ids and the loss of its second
    choice; the lists of those few that a text's n best change are searched."""

    def __init__(self, pieces: Pieces, n: int = N_BEST, most: int = 400_000):
        self.pieces, self.n, self.most = pieces, n, most
        self.table = _Entries(self._entry)
        self.lists: dict[str, list[tuple[float, bytes]]] = {}

    def _entry(self, unit: str) -> tuple[float, bytes, float]:
        best, second, last = forward(unit, self.pieces)
        j, ids = len(unit), []
        while j:
            i, k = last[j]
            ids.extend([k] if k >= 0 else reversed(self.pieces.bytes_of(unit[i])))
            j = i
        ids.reverse()
        return best[-1], array("I", ids).tobytes(), best[-1] - second[-1]

    def _list(self, unit: str) -> list[tuple[float, bytes]]:
        if unit not in self.lists:
            if len(self.lists) > self.most // 8:
                self.lists.clear()
            found = n_best(unit, self.pieces, self.n)
            self.lists[unit] = [(found[0][0] - s, array("I", x).tobytes()) for s, x in found]
        return self.lists[unit]

    def segment(self, text: str) -> list[tuple[float, bytes]]:
        """The n best (score, ids as unsigned 32-bit integers) of a whole text."""
        units, table = self.pieces.units(text), self.table
        if len(table) > self.most:
            table.clear()
        if not units:
            return [(0.0, b"")]
        scores, parts, losses = zip(*map(table.__getitem__, units), strict=True)
        score, losses, open_ = sum(scores), list(losses), []
        for _ in range(min(self.n - 1, len(units))):  # those whose second choice costs least
            if (loss := min(losses)) >= 1e200:
                break
            open_.append(losses.index(loss))
            losses[open_[-1]] = 1e300
        ways = [[(d, k, a) for a, (d, _) in enumerate(self._list(units[k]))] for k in open_]
        choices = heapq.nsmallest(self.n, ((sum(x[0] for x in c), c) for c in itertools.product(*ways)))
        out = []
        for loss, choice in choices:
            own = list(parts)
            for _, k, a in choice:
                own[k] = self.lists[units[k]][a][1] if a else parts[k]
            out.append((score - loss, b"".join(own)))
        return out


_ROWS = ("doc_id long, best array<struct<score:double,n_pieces:int,ids:binary>>, decoded string")


def segment(docs: DataFrame, model_file: str, n: int = N_BEST) -> DataFrame:
    """(doc_id, best, decoded) of ``docs`` (doc_id, text): the n best
    segmentations with their ids as little-endian unsigned 32-bit binary, and the
    text read back from the ids of the first."""
    kind = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int32()), ("ids", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = once(("pieces", model_file), lambda: Pieces(model_file))
        segmenter = once(("segmenter", model_file, n), lambda: Segmenter(pieces, n))
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                best, texts = [], []
                for text in part.column(1):
                    found = segmenter.segment(text.as_py() or "")
                    best.append([{"score": s, "n_pieces": len(x) // 4, "ids": x} for s, x in found])
                    texts.append(pieces.decode(array("I", found[0][1])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, kind), pa.array(texts, pa.string())],
                                                 names=["doc_id", "best", "decoded"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, _ROWS)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces and checksum of the best segmentation, whether its
    ids read back as the text, scores and piece counts of the n best."""
    import public_tokenizers as public
    from pyspark.sql import functions as F
    found = segment(read(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"))
    return found.select("doc_id", F.col("best")[0]["n_pieces"].cast("long").alias("n_pieces"), F.crc32(F.col("best")[0]["ids"]).alias("ids_crc32"),
                        F.length("decoded").cast("long").alias("n_chars"), F.sha2("decoded", 256).alias("decoded_sha256"),
                        F.transform("best", lambda x: F.round(x["score"], 6)).alias("scores"),
                        F.transform("best", lambda x: F.crc32(x["ids"])).alias("crcs"))


def checksum(ids: list[int]) -> int:
    return zlib.crc32(array("I", ids).tobytes())
