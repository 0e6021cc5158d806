"""Fill-in-the-middle, secret scans and whitening against brute force."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import frames
from vitals.llm import fill_middle as M
from vitals.llm import secret_scan as S
from vitals.llm import whitening as W
from vitals.llm.common import read

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle ----

@given(st.lists(st.one_of(st.integers(1, 12), st.integers(1, 5000)), max_size=900), st.text(" \t", max_size=3))
@settings(max_examples=80, deadline=None)
def test_index_gives_every_boundary(lengths, end):
    text = "".join(" " * (k % 3 == 0) + ("é" if k % 2 else "y") * n + " " for k, n in enumerate(lengths)) + end
    bounds = M.boundaries(text)
    assert bounds.tolist() == [0] + np.cumsum([len(u) for u in UNIT.findall(text)], dtype=int).tolist()
    start, offset, slope, rest = M.fit(bounds)
    for rank, want in enumerate(bounds):
        k = int(np.searchsorted(start, rank, side="right")) - 1
        assert offset[k] + ((slope[k] * (rank - start[k])) >> M.SHIFT) + int(rest[rank]) == want
        assert abs(int(rest[rank])) <= M.ERROR + 2


def test_index_is_small_on_prose():
    text = " ".join("w" * random.Random(k).randint(1, 12) for k in range(20_000))
    assert len(M.fit(M.boundaries(text))[0]) < 200


def brute_middle(i, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if i is None else i}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return i, n, form, len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("clash", [False, True])
def test_fill_middle(spark, clash):
    draw = random.Random(5)
    rows = frames.TEXTS + [(100 + k, "".join(draw.choice(["a ", "漢字", "\n\t", "word ", "<", "S>", "<S", "P>x ", "😀"]) for _ in range(60)))
                           for k in range(80)] + [(300 + k, f"holds <{x}> itself") for k, x in enumerate("PSM" * 4)]
    rows += [(400, "b" * 300_000), (401, "ab  c " * 50_000), (402, " " * 70_000)]
    made = M.fill_in_middle(frames.docs(spark, rows, clash).repartition(3))
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256),
                      F.sha2(M.restored(F.col("output"), F.col("form")), 256)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(brute_middle(i, t)) for i, t in rows)
    assert {"plain", "spm", "psm"} == {r["form"] for r in got}
    assert M.fill_in_middle(frames.empty(spark)).count() == 0


def test_index_is_fitted_once(spark, sf_small):
    plan = M.fill_in_middle(read(spark, sf_small, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "Exchange" not in plan


# ---- secrets ----

def brute_secrets(text, rules=S.RULES):
    found = [(m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer(r.pattern, text or "", re.ASCII)
             if len(m.group(r.group)) >= r.least]
    return [(rules[k].kind, s, e) for s, k, e in sorted(found)]


WORDS = ["password", "PassWD", "secret", "tOKen", "api_key", "APIkey", "=", ": ", "'", '"', "hunter22", "abc", "AKIA", "ABCDEFGHIJKL0123", "deadbeef" * 4,
         "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "ghp_", "x" * 36, "xoxb-", "1234567890-ab", "AIza", "y" * 35, "sk_live_", "eyJ", "abcdefgh.", "https://",
         "user:", "pass@", "é", "\n", " ", "Kelvin K", "ſecret=longenough"]


def secret_rows(n=300):
    draw = random.Random(9)
    return [(k, "".join(draw.choice(WORDS) for _ in range(draw.choice([1, 4, 30])))) for k in range(n)]


@given(st.lists(st.sampled_from(WORDS), max_size=14).map("".join))
@settings(max_examples=300, deadline=None)
def test_a_match_satisfies_its_query(text):
    folded = text.encode().lower()
    for r in S.RULES:
        if re.search(r.pattern, text, re.ASCII):
            assert all(any(all(t in folded for t in s) for s in clause) for clause in S.trigram_query(r.pattern))


@pytest.mark.parametrize("pattern,clauses", [("[0-9a-f]+", 0), ("ab", 0), ("abc|xy", 0), ("(?:abc|xyz)d?", 1), ("x*hello.+wor(?:ld|th)", 2), ("(?:ab){3}", 1),
                                             ("a{2,}b", 0), ("(?:longer){2,}", 1), ("(abc)?", 0)])
def test_queries(pattern, clauses):
    assert len(S.trigram_query(pattern)) == clauses


@pytest.mark.parametrize("shard", [1, 37, 4 << 20])
def test_secret_index(monkeypatch, shard):
    import pyarrow as pa
    monkeypatch.setattr(S, "SHARD", shard)
    rows = [t for _, t in secret_rows(120)] + [None, ""]
    got = S.Scanner(S.RULES).scan(pa.array(rows).slice(3))
    assert [[(S.RULES[k].kind, s, e) for s, k, e in x] for x in got] == [brute_secrets(t) for t in rows[3:]]


def test_rows_without_the_trigrams_are_not_verified():
    import pyarrow as pa
    texts = pa.array(["plain words only"] * 50 + ["my token = abcdefgh1"] + ["to ken"] * 50)
    scanner = S.Scanner(S.RULES)
    ends = np.cumsum([len(t.as_py()) for t in texts])
    held = scanner.postings(np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8), ends)
    left = {r.kind: len(scanner.candidates(q, held, len(texts))) for r, _, q in scanner.rules}
    assert left["assign"] == 1 and left["hex"] == len(texts) and left["jwt"] == 0


@pytest.mark.parametrize("clash", [False, True])
def test_secret_scan(spark, clash):
    rows = secret_rows() + frames.TEXTS + [(900, "token" + " " * 200_000 + "=" + "a" * 100_000), (901, "f" * 300_000), (902, "secret:token:abcdefgh token=token=abcdefgh")]
    got = S.scan_secrets(frames.docs(spark, rows, clash).repartition(3)).collect()
    assert sorted(str((r["doc_id"], [tuple(x) for x in r["spans"]])) for r in got) == sorted(str((i, brute_secrets(t))) for i, t in rows)
    assert S.scan_secrets(frames.empty(spark)).count() == 0


# ---- whitening ----

def newton_polynomial(matrix):
    """Faddeev and LeVerrier, in fractions."""
    size = len(matrix)
    a = [[Fraction(v) for v in r] for r in matrix]
    m = [[Fraction(0)] * size for _ in a]
    c = [Fraction(0)] * size + [Fraction(1)]
    for k in range(1, size + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(size)) + (c[size - k + 1] if i == j else 0) for j in range(size)] for i in range(size)]
        c[size - k] = -sum(a[i][t] * m[t][i] for i in range(size) for t in range(size)) / k
    return [int(v) for v in c]


def gram(size, seed, most=50):
    x = np.random.default_rng(seed).integers(-most, most, (size + 3, size)).astype(object)
    return (x.T @ x).tolist()


@pytest.mark.parametrize("matrix", [gram(1, 0), gram(5, 1), gram(8, 2, 10 ** 9), [[0, 0], [0, 0]], [[5, 0, 0], [0, 5, 0], [0, 0, 2]],
                                    [[2, 0, 0, 2], [0, 3, 0, 0], [0, 0, 3, 0], [2, 0, 0, 2]], np.full((6, 6), 7).tolist()])
def test_polynomial_roots_and_components(spark, matrix):
    poly = W.characteristic_polynomial(spark, matrix)
    assert poly == newton_polynomial(matrix)
    size = len(matrix)
    roots = W.leading_roots(poly, 4, sum(matrix[i][i] for i in range(size)))
    want = np.linalg.eigvalsh(np.array(matrix, dtype=float))[::-1][:4]
    assert np.allclose([float(r) for r in roots], want, rtol=1e-12, atol=1e-12 * max(1, want[0]))
    v, a = np.array(W.components(matrix, roots)), np.array(matrix, dtype=float)
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-14
    assert np.abs(v @ a - np.array([[float(r)] for r in roots]) * v).max() <= 1e-14 * max(1.0, np.abs(a).max()) * size


def test_close_roots_are_told_apart():
    big = 10 ** 20
    matrix = [[2 * big + 1, 1, 0], [1, 2 * big + 1, 0], [0, 0, 2 * big + 1]]  # big apart by 1
    poly = newton_polynomial(matrix)
    roots = W.leading_roots(poly, 3, sum(matrix[i][i] for i in range(3)))
    assert [round(r - 2 * big) for r in roots] == [2, 1, 0]
    v = np.abs(np.array(W.components(matrix, roots)))
    assert np.abs(v - np.array([[0.5 ** 0.5, 0.5 ** 0.5, 0], [0, 0, 1], [0.5 ** 0.5, 0.5 ** 0.5, 0]])).max() < 1e-15


def test_limbs_and_sums():
    for v in (0, 1, -1, 2 ** 30, -(2 ** 30), 2 ** 130 + 12345, -(2 ** 130) - 77, 2 ** 30 - 1):
        assert sum(x << (W.LIMB * k) for k, x in enumerate(W.limbs(v))) == v
    x = np.array([[2 ** 62, -(2 ** 63)], [3, 5]], np.int64)
    assert W.outer_sums(x)[1][2] == -(2 ** 125) + 15 and W.outer_sums(x)[0][0] == 2
    assert all((W.unpack(__import__("pyarrow").array([W.pack(r)]), 2)[0] == r).all() for r in x)


def check_whitening(rows, got, top=4):
    usable = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * np.float64(c))) for c in v] for _, v in usable], dtype=object)
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    f = (fit * n - s).astype(float) / n
    cov = f.T @ f / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == len(usable) * min(top, x.shape[1])
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], set()).add(tuple(r)[1:])
    signs = {}
    for (i, _), own in zip(usable, x):
        deviation = sum((n * own - s) ** 2)
        for k in range(min(top, x.shape[1])):
            want = float(((own * n - s).astype(float) / n) @ vectors[:, k] / np.sqrt(values[k]))
            r = min((q for q in by[i] if q[0] == k + 1), key=lambda q: abs(abs(q[3]) - abs(want)))
            assert r[1] == n and r[2] == deviation
            assert abs(abs(r[3]) - abs(want)) < 1e-8 * max(1, abs(want)) and r[5] <= 1e-9
            assert abs(r[4] - values[k] / values.sum()) < 1e-9
            if abs(want) > 1e-3:
                assert signs.setdefault(k, np.sign(r[3] * want)) == np.sign(r[3] * want)


def test_query_whitens_the_table(spark, sf_small):
    table = read(spark, sf_small, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = W.op12_embedding_whitening(spark, sf_small)
    assert got.schema.simpleString() == ("struct<vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,"
                                         "explained:double,identity_error:double>")
    check_whitening(rows, got.collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], "vec_id long, embedding array<double>, x int, n double")


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=5) * [3, 2, 1, 0.5, 0.2]).tolist()) for k in range(60)]
    rows += [(500, rows[0][1])] * 30 + [(None, rows[1][1]), (501, [c + 1e-6 for c in rows[2][1]])]  # copies, and one equal in integers
    bad = [(600, None), (601, [1.0, None, 1.0, 1.0, 1.0]), (602, [float("nan")] * 5), (603, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (604, []), (605, [1.0, 2.0])]
    check_whitening(rows, W.whiten(vectors(spark, rows + bad).repartition(5)).collect())


def test_whitening_defined_results(spark):
    assert W.whiten(vectors(spark, [])).count() == 0
    assert W.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    one = W.whiten(vectors(spark, [(1, [0.5, -0.25]), (2, [0.5, -0.25])])).collect()  # a single distinct vector
    assert len(one) == 4 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 and r["n"] == 1 for r in one)
    line = W.whiten(vectors(spark, [(k, [k * 0.5, k * 0.5]) for k in range(4)])).collect()  # rank one
    assert all((r["whitened"] is None and r["explained"] == 0.0) if r["component"] == 2 else abs(r["explained"] - 1) < 1e-15 for r in line)
    tie = W.whiten(vectors(spark, [(k, [float(k == j) for j in range(4)]) for k in range(4)])).collect()  # equal roots
    assert len(tie) == 16 and all(r["identity_error"] < 1e-9 for r in tie if r["component"] < 4)
    huge = W.whiten(vectors(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3.5e16, 2.0])])).collect()
    assert len(huge) == 6 and all(r["deviation"] is None and (r["whitened"] is None or np.isfinite(r["whitened"])) for r in huge)  # beyond a long
