"""Sequence packing by non-negative least squares over length combinations.

A document is its token ids followed by an end id. Whole windows are cut from
the front; what is left of it (its tail, 1..window-1 ids) is what packing has to
place. The tails of a block of documents form a histogram over lengths. Shallow
combinations (one to three lengths whose sum is the window) are the columns of a
non-negative least squares problem whose right-hand side is that histogram; the
solved repeat counts are rounded down to what the histogram still holds, and
what remains is packed greedily: the largest piece first, then the largest that
fits; when nothing fits, a piece is cut so that the sequence is full. Only the
last sequence of a block can therefore be shorter than the window.

Scale. A block is ``block_tokens`` ids of consecutive documents of one input
split, so the work is one pass without any shuffle, a task holds one block, and
nothing reaches the driver. The plan of a block depends only on its documents:
a task that runs again after a lost executor makes the same rows. Hot sources or
copies do not matter: documents are packed where they are read.

Defined results: a null text is an empty one (its document is the end id alone);
repeated rows are packed as often as they occur; a null ``doc_id`` stays null;
an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import once, only, read

WINDOW = 1024
BLOCK_TOKENS = 2_000_000
#: blocks a task can number; the task number stands above these bits
_TASK_BITS = 36

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")

#: characters on which both tokenizer libraries surely split alike: ASCII, Latin
#: letters, general punctuation
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")
#: FIXED VALUE: the published pre-token pattern of this kind of byte-level BPE, in
#: the form that never backtracks
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class Ids:
    """Token ids of a text under a byte-level BPE file of ``tokenizers``.

    ``ranks`` names the same vocabulary as ranks. With it, texts of plain
    characters without a special token's string take the faster library, which
    gives the same ids there (tested); all other texts take ``tokenizers``.
    """

    def __init__(self, file: str, ranks: str | None = None):
        import json

        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", ())]
        self.fast = None
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                pairs = (line.split() for line in f if line.strip())
                table = {base64.b64decode(a): int(b) for a, b in pairs}
            self.fast = tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


# -------------------------------------------------------------- the plan of a block

def combinations(hist: np.ndarray, window: int, widest: int = 48) -> np.ndarray:
    """Columns of the problem: the pairs that fill the window, and triples of
    the ``widest`` most frequent lengths with the one length that completes
    them. Rows of (a, b, c) with c = 0 in a pair."""
    have = np.flatnonzero(hist)
    have = have[(have > 0) & (have < window)]
    pairs = [(a, window - a, 0) for a in have if 2 * a <= window and hist[window - a]]
    often = np.sort(have[np.argsort(-hist[have], kind="stable")][:widest])
    triples = [(a, b, window - a - b) for i, a in enumerate(often) for b in often[i:]
               if window - a - b >= b and hist[window - a - b]]
    return np.asarray(pairs + triples, dtype=np.int64).reshape(-1, 3)


def nnls(columns: np.ndarray, hist: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """min ||A x - h|| over x >= 0, where column j of A counts the lengths of
    combination j: projected coordinate descent on the residual, which is exact
    in the limit; the sparse columns make a sweep linear in their number."""
    x = np.zeros(len(columns))
    left = hist.astype(float).copy()
    left[0] = 0.0
    parts = [np.unique(c[c > 0], return_counts=True) for c in columns]
    norm = [float((n * n).sum()) for _, n in parts]
    for _ in range(sweeps):
        moved = 0.0
        for j, (at, n) in enumerate(parts):
            new = max(0.0, x[j] + float((left[at] * n).sum()) / norm[j])
            if new != x[j]:
                left[at] -= n * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved < 0.05:
            break
    return x


def plan(hist: np.ndarray, window: int) -> list[tuple[int, list[int], int]]:
    """Patterns (repeats, lengths, cut) for a histogram of tails. ``cut`` > 0:
    the pattern's last length is cut from a longer piece of that many ids, whose
    rest goes back to the histogram (only with one repeat)."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[int, list[int], int]] = []
    columns = combinations(left, window)
    if len(columns):
        x = nnls(columns, left)
        for j in np.argsort(-x, kind="stable"):
            parts = [int(v) for v in columns[j] if v]
            at, n = np.unique(parts, return_counts=True)
            times = int(min(np.floor(x[j] + 1e-9), (left[at] // n).min()))
            if times > 0:
                left[at] -= n * times
                out.append((times, parts, 0))
    while (some := np.flatnonzero(left)).size:
        parts, room = [], window
        while room:
            fits = some[(some <= room) & (left[some] > 0)]
            if not fits.size:
                break
            parts.append(int(fits[-1]))
            left[fits[-1]] -= 1
            room -= int(fits[-1])
        rest = some[left[some] > 0]
        cut = 0
        if room and rest.size:  # all that remain are longer than the room: cut the shortest
            cut = int(rest[0])
            left[cut] -= 1
            left[cut - room] += 1
            parts.append(room)
        out.append((1, parts, cut))
    return out


def pack_block(lengths: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces of a block.
    lengths: ids of each document, the end id included (so at least 1)."""
    sequence = 0
    pool: dict[int, list[tuple[int, int]]] = {}
    for d, n in enumerate(lengths.tolist()):
        whole = n // window
        for k in range(whole):
            yield d, k * window, window, sequence, 0
            sequence += 1
        if n % window:
            pool.setdefault(n % window, []).append((d, whole * window))
    hist = np.zeros(window, dtype=np.int64)
    for n, at in pool.items():
        hist[n] = len(at)
        at.reverse()
    for times, parts, cut in plan(hist, window):
        for _ in range(times):
            offset = 0
            for k, n in enumerate(parts):
                if cut and k == len(parts) - 1:
                    d, start = pool[cut].pop()
                    pool.setdefault(cut - n, []).append((d, start + n))
                else:
                    d, start = pool[n].pop()
                yield d, start, n, sequence, offset
                offset += n
            sequence += 1


# ------------------------------------------------------------------------ operator

def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None,
         end_id: int = 0, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Packs ``docs`` (doc_id, text). One row per piece: its document, its place
    there (``start``, ``length``), the ids as little-endian unsigned 32-bit
    binary, and its place in a sequence (``sequence_id``, ``offset``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = once(("ids", tokenizer, ranks), lambda: Ids(tokenizer, ranks))
        end = np.asarray([end_id], dtype="<u4")
        first = TaskContext.get().partitionId() << _TASK_BITS
        held: list[tuple[int | None, np.ndarray]] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, tokens
            lengths = np.asarray([len(x) for _, x in held], dtype=np.int64)
            rows, top = [], -1
            for d, start, n, sequence, offset in pack_block(lengths, window):
                rows.append((held[d][0], start, n, held[d][1][start:start + n].tobytes(),
                             int(lengths[d]), first + sequence, offset))
                top = max(top, sequence)
                if len(rows) >= 4096:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)
            first, held, tokens = first + top + 1, [], 0

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.concatenate([ids_of(text.as_py() or ""), end])
                held.append((doc_id, ids))
                tokens += len(ids)
                if tokens >= block_tokens:
                    yield from flush()
        if held:
            yield from flush()

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in PIECES.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return only(docs, doc_id="long", text="string").mapInArrow(run, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in the place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def production(docs: DataFrame) -> DataFrame:
    import public_tokenizers as public
    return digest(pack(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production(read(spark, sf_dir, "documents"))


def checksum(ids: np.ndarray) -> int:
    """What ``ids_crc32`` of these ids is."""
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
