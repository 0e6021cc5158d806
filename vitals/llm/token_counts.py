"""Token counts by dynamic programming on a trie of pre-tokens.

The distinct pre-tokens of a worker go into a trie. Every node is a prefix; when
it is made it gets the best unigram score of the prefix, the number of tokens of
that segmentation, and the piece walks that are still open there, all from its
parent, so a prefix that many pre-tokens share is computed once. The node where a
pre-token ends holds its count; a text's count is the sum over its pre-tokens.

Scale. One pass without a shuffle; the trie is emptied when it reaches
``MOST_NODES`` (about 400 MB) and the table of counts at ``MOST_ENDED``, which costs
time and changes nothing; 25 MB of the test texts make 0.7 million nodes.

Defined results: a null or empty text has no tokens; of equally good
segmentations the one with fewer tokens counts; repeated rows give equal rows;
null ids stay; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vitals.llm.common import once, only, read
from vitals.llm.pieces import Pieces

MOST_NODES = 1_500_000
MOST_ENDED = 700_000
#: a child's key is its parent's number and the character
_BITS = 21


class PrefixCounts:
    """The trie. Per node: score, tokens, and open piece walks as (node where the
    walk began, node of the piece trie) one after another. Children are in one
    dictionary and walks hold integers only, so that the collector has nothing to
    traverse."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        #: the pieces' trie by numbers: children, score of a piece that ends here
        self.below: list[dict[str, int]] = [{}]
        self.value: list[float | None] = [None]
        self._number(pieces.trie, 0)
        self.ended: dict[str, int] = {}
        self.clear()

    def _number(self, level: dict, at: int) -> None:
        for c, (below, k, value) in level.items():
            self.below[at][c] = new = len(self.below)
            self.below.append({})
            self.value.append(value if k >= 0 else None)
            self._number(below, new)

    def clear(self) -> None:
        self.score, self.tokens, self.open = array("d", [0.0]), array("i", [0]), [()]
        self.child: dict[int, int] = {}

    def _grow(self, node: int, c: str) -> int:
        below, value, scores, counts = self.below, self.value, self.score, self.tokens
        best, tokens, walks, single = -1e300, 0, [], False
        open_ = self.open[node]
        for i in range(0, len(open_), 2):
            step = below[open_[i + 1]].get(c)
            if step is None:
                continue
            start, piece = open_[i], value[step]
            if piece is not None:
                total = scores[start] + piece
                if total > best or (total == best and counts[start] + 1 < tokens):
                    best, tokens = total, counts[start] + 1
            if below[step]:
                walks += (start, step)
        step = below[0].get(c)
        if step is not None:
            piece = value[step]
            if piece is not None:
                single = True
                total = scores[node] + piece
                if total > best or (total == best and counts[node] + 1 < tokens):
                    best, tokens = total, counts[node] + 1
            if below[step]:
                walks += (node, step)
        if not single and scores[node] + self.pieces.missing > best:
            best, tokens = scores[node] + self.pieces.missing, counts[node] + len(self.pieces.bytes_of(c))
        new = self.child[node << _BITS | ord(c)] = len(scores)
        scores.append(best)
        counts.append(tokens)
        self.open.append(tuple(walks))
        return new

    def count(self, unit: str) -> int:
        node, child = 0, self.child
        for c in unit:
            node = child.get(node << _BITS | ord(c)) or self._grow(node, c)
        return self.tokens[node]

    def of_text(self, text: str) -> tuple[int, int]:
        """(pre-tokens, tokens) of a text."""
        if len(self.score) > MOST_NODES:
            self.clear()
        if len(self.ended) > MOST_ENDED:
            self.ended.clear()
        units, ended, total = self.pieces.units(text), self.ended, 0
        for u in units:
            n = ended.get(u)
            if n is None:
                n = ended[u] = self.count(u)
            total += n
        return len(units), total


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = once(("pieces", model_file), lambda: Pieces(model_file))
        counts = once(("counts", model_file), lambda: PrefixCounts(pieces))
        for b in batches:
            found = [counts.of_text(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))],
                                             names=["doc_id", "n_pretokens", "n_tokens"])
    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    return count_tokens(read(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"))
