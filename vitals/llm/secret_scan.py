"""Secrets found with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
parts that must occur are expanded to the strings they can be (a choice gives
several), and a match needs, for every part, all trigrams of one of its strings.
The texts are indexed in shards of about ``SHARD`` bytes: the postings of a
trigram are the sorted rows of the shard that hold it, ASCII letters folded to
lower case; only trigrams that a query names are posted. Postings are intersected
and united as the query says, and the rule's expression verifies the rows that
are left, over the whole text. A rule without mandatory trigrams (a run of hex
digits) scans every text.

Scale. Index and texts stay in one task: one pass without a shuffle. A shard holds
``SHARD`` bytes or one longer text, whose trigrams are read ``SHARD`` bytes at a
time. Every expression is linear in the text.

Defined results: a null or empty text holds nothing and has a row; matches of a
rule go left to right without overlap and those that fail its length are dropped;
matches of different rules may overlap; repeated rows give equal rows; null ids
stay; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from re import _constants as K
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import once, only, read

SHARD = 4 << 20
#: strings that a part of an expression is expanded to at most; members of a class likewise
MOST, MOST_IN_CLASS = 64, 8


@dataclass(frozen=True)
class Rule:
    """``least`` is the length that group ``group`` of a match needs."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Published formats of credentials, in the order of kinds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login", r"(?:https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9_.%-]{1,64}:[A-Za-z0-9_.%!*+-]{3,64}@"),
)
BASE = ("assign", "access", "hex")

#: all clauses must hold; a clause is a choice of trigram sets, one of which must be present
Query = list[set[frozenset[bytes]]]


def _clause(strings: set[str]) -> Query:
    """One of the strings occurs; nothing is known if one is too short."""
    data = [s.encode("utf-8", "surrogatepass") for s in strings]
    if not data or any(len(d) < 3 for d in data):
        return []
    sets = {frozenset(d[i:i + 3] for i in range(len(d) - 2)) for d in data}
    return [{s for s in sets if not any(o < s for o in sets)}]


def _fold(code: int) -> str:
    return chr(code + 32 if 65 <= code <= 90 else code)


def _members(items: list) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is K.LITERAL:
            found.add(_fold(value))
        elif op is K.RANGE and value[1] - value[0] < 64:
            found.update(map(_fold, range(value[0], value[1] + 1)))
        else:
            return None
    return found if len(found) <= MOST_IN_CLASS else None


def _either(ways: list[tuple[set[str] | None, Query]]) -> tuple[set[str] | None, Query]:
    exact = [e for e, _ in ways if e is not None]
    if len(exact) == len(ways) and len(whole := set().union(*exact)) <= MOST:
        return whole, []
    clauses = [_clause(e) if e is not None else q for e, q in ways]
    if any(len(c) != 1 for c in clauses):  # a way without trigrams, or with several clauses: too much to say
        return None, []
    return None, [set().union(*[c[0] for c in clauses])]


def _item(op, value) -> tuple[set[str] | None, Query]:
    """(all strings it can be, or None; what any match of it needs)."""
    if op is K.LITERAL:
        return {_fold(value)}, []
    if op is K.IN:
        return _members(value), []
    if op is K.AT or op in (K.ASSERT, K.ASSERT_NOT):
        return {""}, []
    if op is K.SUBPATTERN:
        return _sequence(value[3])
    if op is K.BRANCH:
        return _either([_sequence(way) for way in value[1]])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        least, most, body = value
        exact, query = _sequence(body)
        if exact is not None and (least, most) == (0, 1):
            return exact | {""}, []
        if exact is not None and len(exact) ** min(least, 30) <= MOST:
            strings = reduce(lambda a, b: {x + y for x in a for y in b}, [exact] * min(least, 30), {""})
            return (strings, []) if least == most <= 30 else (None, _clause(strings))
        return None, query if least else []
    return None, []


def _sequence(items) -> tuple[set[str] | None, Query]:
    run, query, whole = {""}, [], True
    for op, value in items:
        exact, own = _item(op, value)
        if exact is not None and len(run) * len(exact) <= MOST:
            run = {a + b for a in run for b in exact}
            continue
        query += _clause(run) + own
        run, whole = exact if exact is not None else {""}, False
    return (run, []) if whole else (None, query + _clause(run))


def trigram_query(pattern: str) -> Query:
    """What any text with a match of ``pattern`` holds; empty: nothing is known."""
    exact, query = _sequence(_parser.parse(pattern, re.ASCII))
    return _clause(exact) if exact is not None else query


class Scanner:
    """Rules compiled, with their queries and the table that finds their trigrams."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for r in rules]
        self.names = sorted({t for *_, q in self.rules for c in q for s in c for t in s})
        letters = sorted({b for t in self.names for b in t})
        self.width = len(letters) + 1
        self.letter = np.zeros(256, np.int32)  # 0: in no trigram
        for k, b in enumerate(letters):
            self.letter[b] = k + 1
        for b in range(65, 91):
            self.letter[b] = self.letter[b + 32]
        self.at = np.full(self.width ** 3, -1, np.int16)
        for k, t in enumerate(self.names):
            a, b, c = (self.letter[x] for x in t)
            self.at[(a * self.width + b) * self.width + c] = k

    def postings(self, data: np.ndarray, ends: np.ndarray) -> dict[bytes, np.ndarray]:
        """trigram -> rows that hold it, of texts laid end to end in ``data``."""
        pairs = []
        for start in range(0, len(data), SHARD):
            x = self.letter[data[start:start + SHARD + 2]]
            code = self.at[(x[:-2] * self.width + x[1:-1]) * self.width + x[2:]] if len(x) > 2 else np.zeros(0, np.int16)
            place = np.flatnonzero(code >= 0)
            row = np.searchsorted(ends, place + start, side="right")
            inside = place + start + 3 <= ends[row]  # not across two texts
            pairs.append(np.unique(code[place[inside]].astype(np.int64) * len(ends) + row[inside]))
        keys = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        which, rows = np.divmod(keys, max(1, len(ends)))
        cuts = np.searchsorted(which, np.arange(len(self.names) + 1))
        return {t: rows[cuts[k]:cuts[k + 1]] for k, t in enumerate(self.names)}

    def candidates(self, query: Query, postings: dict[bytes, np.ndarray], size: int) -> np.ndarray:
        """Rows that the query leaves; all of them if it asks for nothing."""
        left = np.arange(size)
        for clause in query:
            some = [reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted((postings[t] for t in s), key=len)) for s in clause]
            left = np.intersect1d(left, reduce(np.union1d, some), assume_unique=True)
        return left

    def shard(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, kind's number, end) of every find, in order, for each text."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        postings = self.postings(data, ends[1:] - ends[0])
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for k, (rule, pattern, query) in enumerate(self.rules):
            for row in self.candidates(query, postings, len(texts)):
                for m in pattern.finditer(texts[row].as_py()):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[row].append((m.start(), k, m.end()))
        for spans in found:
            spans.sort()
        return found

    def scan(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        texts = texts.fill_null("")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        out, at = [], 0
        while at < len(texts):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), SHARD, side="right")))
            out += self.shard(texts.slice(at, n))
            at += n
        return out


_FOUND = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of ``docs`` (doc_id, text): finds by start, then by the
    order of the rules, in code points, ends exclusive."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = once(("secrets", rules), lambda: Scanner(rules))
        for b in batches:
            found = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in spans]
                     for spans in scanner.scan(b.column(1).cast(pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, _FOUND)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of the finds in every document."""
    found = scan_secrets(read(spark, sf_dir, "documents"))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(text(of(*BASE)), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def _secrets_sql(rules: tuple[Rule, ...]) -> str:
    """The rules in SQL, without the index: a match starts after the texts between
    the matches up to it and the matches before it."""
    finds = []
    for k, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        finds.append(f"""
  SELECT rid, '{r.kind}' AS kind, {k} AS k, i, own, value, gaps, owns FROM (
    SELECT rid, unnest(range(1, len(owns) + 1)) AS i, unnest(owns) AS own, unnest(vals) AS value, gaps, owns FROM (
      SELECT rid, regexp_extract_all(t, '{pattern}') AS owns, regexp_extract_all(t, '{pattern}', {r.group}) AS vals,
             string_split_regex(t, '{pattern}') AS gaps FROM texts)) WHERE length(value) >= {r.least}""")
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(finds)}),
placed AS (
  SELECT rid, kind, k, length(array_to_string(gaps[1:i], '')) + length(array_to_string(owns[1:i - 1], '')) AS s, length(own) AS n
  FROM found),
joined AS (
  SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS c,
         count(*) FILTER (WHERE kind = 'hex') AS h,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, k) FILTER (WHERE k < {len(BASE)}) AS base,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, k) AS spans FROM placed GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (rid)
"""


SECRET_SCAN_SQL = _secrets_sql(RULES)
