"""Toxicity scores from a learned lexicon with tolerant matching.

Learning. From a bounded sample of labelled training documents, every word start
(3 letters and more) and whole word is counted by the toxic and the clean
documents that hold it. Entries that toxic documents hold far more often than
clean ones become the lexicon: of a family of starts, the longest that keeps
nearly all its toxic documents, as a whole word if the documents hold it as such,
else as a stem, with the bare word beside it where that is strong by itself.

Matching. The lexicon is a trie. A Levenshtein automaton (one edit for entries of
five letters and more, two for ten and more; insertion, deletion, substitution, so
that two letters changed about are two edits) runs over the trie and over the word at once; its product is made deterministic
state by state when first needed, so that a word is read once, letter by letter,
and most words die after two or three. A stem allows its edits between its first and
its last letter, which have to be there: a changed end would be another, shorter stem.
One or two digits or signs between letters belong to the word; where such a word is no
hit, its pieces are tried.

Context. A hit counts as quoted or as abuse by a score of the window of words
around it: quotation marks, reporting verbs and words about words speak for
quotation; second-person words and repeated hits for abuse.

Score. A logistic model over the counts of exact, stem, misspelled and quoted
hits, fitted on the same sample by Newton steps with a Gaussian prior around hand
weights (a misspelled or a quoted hit counts less until the labels say otherwise).

Scale. Scoring is one pass without a shuffle. The sample holds at most
``max_train`` labelled rows, taken by hash of ``doc_id``; the lexicon at most
``max_terms`` entries; both are parameters. Only lexicon candidates and the
sample's feature rows reach the driver.

Defined results: a null text scores as an empty one; repeated rows score alike;
null ids are scored and are never trained on; labels without a document or with
a null label are left out; without any usable label the hand weights and
``SEED_TERMS`` score; an empty table gives no row. Labels, language, source and
ids are never inputs of a score.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import once, only, read, written

MAX_TRAIN = 30_000
MAX_TERMS = 1_000
MIN_DOCS = 5
#: FIXED VALUES: words for a start without labels
SEED_TERMS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
#: FIXED VALUES: words that report speech or speak about words
QUOTING = frozenset("called calling quote quoted quotes said say says term word words wrote writes dit mot sagte wort nannte dijo palabra".split())
#: FIXED VALUES: words that address somebody
ADDRESSING = frozenset("you your youre u du dich dein tu toi ton te eres usted".split())
_QUOTES = "\"'`«»“”„‘’‹›"
_WORD = re.compile(r"[^\W\d_]+(?:[\d@$!*#]{1,2}[^\W\d_]+)*")
_PIECE = re.compile(r"[^\W\d_]+")
FEATURES = ("exact", "stem", "misspelled", "quoted", "hits", "density")
#: bias first; prior means of the weights
PRIOR = np.array([-4.0, 3.0, 3.0, 1.0, -1.5, 1.0, 0.5])
WINDOW_WORDS = 5
MAX_STATES = 120_000


# --------------------------------------------------------------------- the automaton

class Lexicon:
    """Tries of the words (root 0) and of the stems (root 1) with the product
    automaton over them."""

    def __init__(self, words: Iterable[str], stems: Iterable[str]):
        self.child: list[dict[str, int]] = [{}, {}]
        self.edits: list[int] = [-1, -1]  # edits an entry ending here allows
        self.stem: list[bool] = [False, True]
        for root, entries in enumerate((words, stems)):
            for w in sorted(set(entries)):
                node = root
                for c in w:
                    if c not in self.child[node]:
                        self.child[node][c] = len(self.child)
                        self.child.append({})
                        self.edits.append(-1)
                        self.stem.append(root == 1)
                    node = self.child[node][c]
                self.edits[node] = 0 if len(w) < 5 else 1 if len(w) < 10 else 2
        below = [0] * len(self.child)  # most edits any entry further down allows
        for node in range(len(self.child) - 1, -1, -1):
            below[node] = max([0, *(max(self.edits[k], below[k]) for k in self.child[node].values())])
        #: most edits with which a node can be of use, and with which an edit may lead there
        self.reach = [max(e, d) for e, d in zip(self.edits, below, strict=True)]
        self.bent = [d if stem else r for d, r, stem in zip(below, self.reach, self.stem, strict=True)]
        self._forget()

    def _forget(self) -> None:
        #: a state's (node, edits) as sorted 32-bit numbers: some 100 bytes in the place of sets of pairs
        self.states: dict[bytes, int] = {}
        self.sets: list[bytes] = []
        self.steps: list[dict[str, int]] = []
        self.kinds: list[int] = []  # of a word that ends here
        self.begun: list[int] = []  # of a word that goes on from here in any way
        self.begin = self._state(self._with_deletions({0: 0, 1: 0}))

    def _with_deletions(self, at: dict[int, int]) -> dict[int, int]:
        """Letters of an entry that the word leaves out."""
        todo = list(at.items())
        while todo:
            node, e = todo.pop()
            if node == 1:
                continue
            for k in self.child[node].values():
                if e + 1 <= self.bent[k] and at.get(k, 99) > e + 1:
                    at[k] = e + 1
                    todo.append((k, e + 1))
        return at

    def _state(self, at: dict[int, int]) -> int:
        key = array("I", sorted(node << 3 | e for node, e in at.items())).tobytes()
        if key not in self.states:
            kind = begun = 0
            for node, e in at.items():
                if self.edits[node] >= e:
                    if self.stem[node]:
                        begun = max(begun, 2 if e == 0 else 1)
                    else:
                        kind = max(kind, 3 if e == 0 else 1)
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.kinds.append(max(kind, begun))
            self.begun.append(begun)
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}

        def put(node: int, e: int, most: int) -> None:
            if e <= most and out.get(node, 99) > e:
                out[node] = e
        for pair in array("I", self.sets[state]):
            node, e = pair >> 3, pair & 7
            for letter, k in self.child[node].items():
                if letter == c:
                    put(k, e, self.reach[k])
                elif node != 1:
                    put(k, e + 1, self.bent[k])  # another letter
            if node != 1:
                put(node, e + 1, self.bent[node])  # a letter too many
        self.steps[state][c] = nxt = self._state(self._with_deletions(out)) if out else -1
        return nxt

    def kind(self, word: str) -> int:
        """3 exact, 2 begins with a stem, 1 misspelled, 0 none."""
        if len(self.sets) > MAX_STATES:  # bounded: made again when needed
            self._forget()
        state, found = self.begin, 0
        for c in word:
            try:
                state = self.steps[state][c]
            except KeyError:
                state = self._step(state, c)
            if state < 0:
                return found
            if self.begun[state] > found:
                found = self.begun[state]
        return max(found, self.kinds[state])


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The model's inputs for a whole text; hits weigh by logarithm."""
    lower = text.lower()
    spans = [m.span() for m in _WORD.finditer(lower)]
    known = {}
    hits = []
    for i, (a, b) in enumerate(spans):
        w = lower[a:b]
        k = known.get(w)
        if k is None:
            k = lexicon.kind(w)
            if not k and not w.isalpha():
                k = max(map(lexicon.kind, _PIECE.findall(w)))
            known[w] = k
        if k:
            hits.append((i, k))
    count = {1: 0, 2: 0, 3: 0}
    quoted = 0
    for i, k in hits:
        count[k] += 1
        quoted += _quotation(lower, spans, i) > 0
    return [np.log1p(count[3]), np.log1p(count[2]), np.log1p(count[1]), np.log1p(quoted), np.log1p(len(hits)),
            np.log1p(100.0 * len(hits) / len(spans)) if spans else 0.0]


def _quotation(lower: str, spans: list[tuple[int, int]], i: int) -> float:
    """Positive if the window around word i speaks for quotation."""
    near = spans[max(0, i - WINDOW_WORDS):i + WINDOW_WORDS + 1]
    words = [lower[a:b] for a, b in near]
    a, b = spans[i]
    before, after = lower[near[0][0]:a], lower[b:near[-1][1] + 1]
    marks = any(c in _QUOTES for c in before) and any(c in _QUOTES for c in after)
    tight = a > 0 and lower[a - 1] in _QUOTES and b < len(lower) and lower[b] in _QUOTES
    return 1.5 * tight + 1.0 * marks + 1.0 * any(w in QUOTING for w in words) - 1.5 * any(w in ADDRESSING for w in words) - 0.5


# -------------------------------------------------------------------------- learning

def _starts(text: Column) -> Column:
    """Distinct (start or "word|" entries) of a text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}{3,})"), 1))
    starts = F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(3), F.least(F.length(w), F.lit(12))), lambda k: F.substring(w, F.lit(1), k))))
    return F.concat(F.array_distinct(starts), F.transform(words, lambda w: F.concat(w, F.lit("|"))))


def choose_terms(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, max_terms: int = MAX_TERMS) -> tuple[list[str], list[str]]:
    """(words, stems) of the lexicon from entry -> (toxic, clean) documents."""
    def strong(t: int, c: int) -> bool:
        return t >= MIN_DOCS and (t + 0.5) / (n_toxic + 1) > 30 * (c + 0.5) / (n_clean + 1)

    good = {k: v for k, v in counts.items() if strong(*v)}
    starts = {k: v for k, v in good.items() if not k.endswith("|")}
    words, stems, done = [], [], set()
    for k in sorted(starts, key=lambda k: (len(k), k)):
        if any(k[:i] in done for i in range(3, len(k))):
            continue
        done.add(k)
        full = starts[k][0]
        # down the family while it keeps its documents
        best, at = k, k
        while True:
            below = [x for x in starts if len(x) == len(at) + 1 and x.startswith(at) and starts[x][0] >= 0.95 * full]
            if not below:
                break
            at = best = max(below, key=lambda x: starts[x])
        whole = good.get(best + "|", (0, 0))[0]
        (words if whole >= 0.95 * full else stems).append((full, best))
        if whole < 0.95 * full and whole and len(best) >= 5:
            words.append((whole, best))  # the stem's bare form, with edits anywhere
    # whole words whose starts are shared with clean words
    taken = {w for _, w in words}
    for k, v in good.items():
        w = k[:-1]
        if k.endswith("|") and w not in taken and not any(w.startswith(s) for _, s in stems):
            words.append((v[0], w))
    words, stems = ([w for _, w in sorted(x, reverse=True)[:max_terms]] for x in (words, stems))
    return words, stems


def fit(x: np.ndarray, y: np.ndarray, strength: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic weights (bias first) with a Gaussian prior around PRIOR."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + strength * (w - PRIOR)
        hess = (a * (p * (1 - p))[:, None]).T @ a + strength * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, words: list[str], stems: list[str], weights: np.ndarray):
        self.words, self.stems, self.weights = words, stems, weights

    def score(self, lexicon: Lexicon, text: str) -> float:
        z = float(self.weights[0] + np.dot(self.weights[1:], features(text, lexicon)))
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Lexicon and weights from the labelled rows that are not held out."""
    known = (only(labels, doc_id="long", toxic="int").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # at most max_train ids: small enough to send to the documents
    sample = written(only(docs, doc_id="long", text="string").join(F.broadcast(known), "doc_id")
                     .groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "toxicity-sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model(list(SEED_TERMS), [], PRIOR)
    entries = sample.select("toxic", F.explode(_starts(F.coalesce("text", F.lit("")))).alias("k"))
    counts = (entries.groupBy("k").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
              .where((F.col("t") >= MIN_DOCS) & ((F.col("t") + 0.5) / (sizes[1] + 1) > 30 * (F.col("c") + 0.5) / (sizes[0] + 1)))
              .orderBy(F.desc("t"), "k").limit(50 * MAX_TERMS))
    words, stems = choose_terms({r["k"]: (r["t"], r["c"]) for r in counts.collect()}, sizes[1], sizes[0])
    lexicon_key = (tuple(words), tuple(stems))

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = once(("lexicon", lexicon_key), lambda: Lexicon(*lexicon_key))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features(t.as_py() or "", lexicon) for t in b.column(1)], pa.list_(pa.float64()))],
                                             names=["toxic", "x"])

    rows = sample.select("toxic", "text").mapInArrow(inputs, "toxic int, x array<double>").collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    return Model(words, stems, fit(x, y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with its columns and ``score`` (which takes the place of a column
    of that name)."""
    key = (tuple(model.words), tuple(model.stems), model.weights.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = once(("lexicon", key[:2]), lambda: Lexicon(*key[:2]))
        for b in batches:
            scores = [model.score(lexicon, t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = own.schema["row"].dataType.simpleString()
    return own.mapInArrow(run, f"row {kind}, score double").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c != "score"], F.col("score"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score(only(docs, doc_id="long", text="string"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_own"), F.col("text").cast("string").alias("text"))
    return (score(row, train(docs, labels)).where(F.col("score") < threshold)
            .select(*[F.col("_own").getField(c).alias(c) for c in docs.columns]))
