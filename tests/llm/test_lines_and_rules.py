"""Line de-duplication and quality rules against brute force."""

import collections
import hashlib
import re
import string

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from vitals.llm import line_dedup as L
from vitals.llm import quality_rules as Q

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows):
    held = collections.defaultdict(set)
    last = 2**63 - 1
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(k := x.strip(SPACE).translate(LOWER)) >= 10:
                held[k].add(last if i is None else i)
    out = []
    for i, t in rows:
        lines, me = (t or "").split("\n"), last if i is None else i
        keep = [x for x in lines if not (len(held.get(k := x.strip(SPACE).translate(LOWER), ())) > 1 and min(held[k]) != me)]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("clash", [False, True])
def test_lines(spark, clash):
    got = L.dedup_lines(frames.docs(spark, clash=clash), shard_keys=2)
    rows = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str)
    assert rows == brute_lines(frames.TEXTS)
    if clash:
        assert {"doc", "body", "key"} <= set(got.columns)


def test_lines_empty(spark):
    assert L.dedup_lines(frames.empty(spark)).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**64, 50_000, np.uint64))
    mph = L.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    again = L.PerfectHash.from_bytes(*mph.to_bytes())
    assert (again.slots(keys) == mph.slots(keys)).all()
    assert sum(map(len, mph.levels)) < 6 * len(keys)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), dup, len(covered), failed


@pytest.mark.parametrize("clash", [False, True])
def test_rules(spark, clash):
    rows = [*frames.TEXTS, (20, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w1 w2 w3 w4 w5 w6 z1 z2 z3"), (21, " ".join(f"word{i}x" for i in range(60)) + " A!! B!!")]
    got = Q.judge(frames.docs(spark, rows, clash)).collect()
    want = sorted(((i, *brute_counts(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert all(r.kept == (r.reason is None) and not (r.kept and r.base_failed) for r in got)
    kept = Q.keep_good(frames.docs(spark, rows, clash))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_rule_order_moves_no_verdict(spark):
    rows = [(i, " ".join(["word"] * 3 + [f"alpha{k}" for k in range(i)])) for i in range(10, 30)] + [(50, "SHOUT!! " + " ".join(f"LOUD{k}!!" for k in range(30)))]
    own = Q.with_counts(frames.docs(spark, rows))
    names = list(Q.rules())
    for order in (names, names[::-1]):
        reason = F.when(F.col("base_failed"), "base")
        for k in order:
            reason = reason.when(Q.rules()[k], k)
        assert {r.doc_id for r in own.select("doc_id", reason.isNull().alias("k")).collect() if r.k} == \
            {r.doc_id for r in Q.judge(frames.docs(spark, rows)).collect() if r.kept}


def test_rules_empty_and_native(spark):
    assert Q.judge(frames.empty(spark)).collect() == []
    plan = Q.judge(frames.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_keys_that_share_a_first_hash():
    """All of them are in the index, each with its own owner."""
    rng = np.random.default_rng(4)
    h1 = np.repeat(rng.integers(-2**63, 2**63 - 1, 40), 25)
    h2 = rng.integers(-2**63, 2**63 - 1, len(h1))
    rows = pd.DataFrame({"h1": h1, "h2": h2, "n": 2, "owner": np.arange(len(h1))})
    row = L._build((0,), rows).iloc[0]
    mph = L.PerfectHash.from_bytes(row["bits"], row["sizes"])
    slot = mph.slots(h1.view(np.uint64), h2.view(np.uint64))
    assert sorted(slot) == list(range(len(h1)))
    assert (np.frombuffer(row["prints"], "<i8")[slot] == h2).all() and (np.frombuffer(row["owners"], "<i8")[slot] == rows["owner"]).all()
