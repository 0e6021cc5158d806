"""Near duplicates, neighbours, toxicity, pages and the registered queries."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tests.llm import frames
from vitals.llm import near_dedup as N
from vitals.llm import neighbours as V
from vitals.llm import toxicity as T
from vitals.llm.html_text import extract, main_text
from vitals.llm.queries import ORACLE, QUERIES
from vitals.oracle.compare import compare, duck_with_views


def word_sets(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_groups(rows, width):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = max(sets.get(i, set()), word_sets(t, width), key=len)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_rows():
    rng = random.Random(3)
    rows = list(frames.TEXTS)
    for base in range(12):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([12, 60, 150]))]
        for copy in range(rng.choice([1, 3, 25])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
            rows.append((1000 + 100 * base + copy, " ".join(own)))
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups(spark, width):
    rows = near_rows()
    got = N.near_groups(frames.docs(spark, rows, clash=width == 5).repartition(3), shingle_words=width).collect()
    want = brute_groups(rows, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_keeps_links_at_the_limit(spark):
    """A text within one a quarter longer (exactly four fifths alike), chains of those, and
    many pairs of the least similarity that links."""
    rng = random.Random(11)

    def words(n):
        return [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    rows = []
    for k in range(30):
        base = words(83)  # 80 shingles of four words
        rows += [(100 * k + 7, " ".join(base)), (100 * k + 3, " ".join(base + words(20))), (100 * k + 9, " ".join(base + words(21)))]
        chain = words(53)
        for step in range(4):
            rows.append((100 * k + 50 + step, " ".join(chain)))
            chain = chain[5:] + words(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(frames.docs(spark, rows), shingle_words=4).collect()}
    assert got == brute_groups(rows, 4)
    assert all(got[100 * k + 7][1] == 100 * k + 3 and got[100 * k + 9][1] == 100 * k + 9 for k in range(30))


def test_near_prefixes_find_what_signatures_miss(spark, monkeypatch):
    """Without any bucket of signatures, the prefixes alone give all links."""
    monkeypatch.setattr(N, "ROUNDS", 0)
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(frames.docs(spark, rows), shingle_words=4).collect()}
    assert got == brute_groups(rows, 4)


def test_near_empty_and_drop(spark):
    assert N.near_groups(frames.empty(spark)).collect() == []
    rows = near_rows()
    kept = N.drop_near(frames.docs(spark, rows, clash=True), 4)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in brute_groups(rows, 4).items() if i == c}


def test_drop_near_keeps_rows_without_id(spark):
    """Rows without an id and several texts under one id are documents of their own."""
    a, b, c, e = (" ".join(f"{x}{k}" for k in range(60)) for x in "abce")
    rows = [(None, a), (None, b), (None, b), (5, b + " more"), (7, c), (7, e + " and some more words here"), (9, c + " again"), (None, None), (8, c)]
    kept = N.drop_near(frames.docs(spark, rows, clash=True).repartition(3))
    assert kept.columns == frames.docs(spark, clash=True).columns
    want = [(None, a), (5, b + " more"), (7, c), (7, e + " and some more words here"), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_signature_distance_guarantee():
    """Signatures that differ in fewer than 2 * CHUNKS components share a key."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 2**16, N.CHUNKS * N.WIDTH).astype(np.int32)
        b = a.copy()
        at = rng.choice(len(a), 2 * N.CHUNKS - 1, replace=False)
        b[at] = rng.integers(0, 2**16, len(at))
        assert set(N.bucket_keys(a).tolist()) & set(N.bucket_keys(b).tolist())


def test_neighbours(spark, sf_small):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 16))
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    rows += [(1000 + k, rows[0][1]) for k in range(30)]  # many copies of one vector
    bad = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0]), (None, rows[1][1]), (2005, [float("inf")] * 16)]
    d = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>").withColumn("key", F.lit(1))
    got = collections.defaultdict(list)
    for r in V.nearest(d, F.col("id") % 100 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ids, y = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    hits = []
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    for q, found in got.items():
        dist = np.sqrt(((y - y[ids == q][0]) ** 2).sum(1))
        dist[ids == q] = np.inf
        best = ids[np.lexsort((ids, dist))[:10]].tolist()
        found.sort()
        assert [k for k, *_ in found] == list(range(1, 11))
        assert all(abs(dist[ids == v][0] - s) < 1e-12 for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits.append(len(set(best) & {v for _, v, _ in found}) / 10)
    assert np.mean(hits) >= 0.9
    assert [v for _, v, _ in got[1000]][:9] == [0, *range(1001, 1009)]


@pytest.mark.parametrize("n", [40, 600])
def test_neighbours_beside_repeated_rows(spark, n):
    """The nearest row stands twelve times in the table, and one id has twelve vectors."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((n, 8))
    x[1] = x[0] + 0.01
    rows = [(i, x[i].tolist()) for i in range(n)]
    rows += rows[1:2] * 11 + [(2, (x[0] + 0.02 + 0.001 * k).tolist()) for k in range(12)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r.vec_id for r in V.nearest(d, F.col("id") == 0).orderBy("rank").collect()]
    best = {}
    for i, v in rows[1:]:
        best[i] = min(best.get(i, np.inf), np.sqrt(((np.array(v) - x[0]) ** 2).sum()))
    want = sorted(best, key=lambda i: (best[i], i))[:10]
    assert len(got) == 10 and got[:2] == [1, 2] and len(set(got) & set(want)) >= 9


def test_neighbours_of_a_hot_bucket(spark, monkeypatch):
    """Many queries and rows of one bucket: parts meet sides, and no pair is lost."""
    monkeypatch.setattr(V, "BLOCK", 16)
    rng = np.random.default_rng(11)
    x = np.concatenate([1e-3 * rng.standard_normal((120, 6)) + 1, rng.standard_normal((180, 6))])
    d = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in V.nearest(d, F.col("id") % 2 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert sorted(got) == list(range(0, 300, 2)) and all(len(v) == 10 for v in got.values())
    share = [len(set(v) & set(exact_neighbours(np.arange(300), x, q)[1])) / 10 for q, v in got.items()]
    assert np.mean(share) >= 0.9


def test_the_vector_that_asks_is_the_smallest(spark):
    rows = [(0, [5.0, 5.0]), (0, [1.0, 1.0]), (1, [1.0, 1.1]), (2, [5.0, 5.1])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for part in (1, 3):
        assert [r.vec_id for r in V.nearest(d.repartition(part), F.col("id") == 0, top=1).collect()] == [1]


def test_neighbours_few_and_none(spark):
    d = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in V.nearest(d, F.col("id") == 0).orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]
    assert V.nearest(d.limit(0), F.col("id") == 0).collect() == []


def test_neighbours_recall_on_the_table(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = collections.defaultdict(set)
    for r in QUERIES["op10_nearest_neighbours"](spark, sf_small).collect():
        got[r.query_id].add(r.vec_id)
    share = []
    for q in ids[ids % 100 == 0]:
        dist = ((x - x[ids == q][0]) ** 2).sum(1)
        dist[ids == q] = np.inf
        share.append(len(got[q] & set(ids[np.argsort(dist)[:10]].tolist())) / 10)
    assert np.mean(share) >= 0.9


def exact_neighbours(ids, x, q):
    dist = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    dist[ids == q] = np.inf
    return dist, ids[np.lexsort((ids, dist))[:10]].tolist()


@pytest.mark.parametrize("noise", [0.3, 0.5])
def test_neighbours_beside_a_loose_group(spark, noise):
    """A third of the rows, the first ones, lie around one vector: the others' neighbours are farther."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2400, 64))
    x[:800] = x[0] + noise * rng.standard_normal((800, 64))
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    ids = np.arange(2400)
    d = spark.createDataFrame([(int(i), x[i].tolist()) for i in ids], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in V.nearest(d, F.col("id") % 40 == 0).collect():
        got[r.query_id].add(r.vec_id)
    share = {q: len(got[q] & set(exact_neighbours(ids, x, q)[1])) / 10 for q in range(0, 2400, 40)}
    assert np.mean([s for q, s in share.items() if q >= 800]) >= 0.9
    assert np.mean([s for q, s in share.items() if q < 800]) >= 0.9


@pytest.mark.parametrize("rows", [2**20, 2**28, 2**40])
def test_probes_reach_the_target(rows):
    """At any number of rows the visits reach the target, also a little beyond the median radius."""
    h, rng = V.Hashing(4, rows, 1.0), np.random.default_rng(6)
    for _ in range(5):
        place = rng.uniform(0, 1, h.k)
        assert all(0 < len(h.probes(place, r)) <= V.MAX_PROBES for r in (0.5, 1.0, 1.1))
    assert len(h.probes(np.full(h.k, 0.5), 50.0)) == 0  # out of reach: left to the exact search


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, cur = row, [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        row = cur
    return row[-1]


def test_automaton_against_edit_distance():
    words, rng = ["idiot", "moron", "scum", "worthlessness"], random.Random(4)
    lexicon = T.Lexicon(words, ["lowei"])
    for _ in range(3000):
        w = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            at, what = rng.randrange(len(w) + 1), rng.randint(0, 2)
            w[at:at + (what > 0)] = [] if what == 1 else [rng.choice("idotmrscuwhle")]
        w = "".join(w)
        allowed = {x: 0 if len(x) < 5 else 1 if len(x) < 10 else 2 for x in words}
        want = 3 if w in words else 1 if any(edits(w, x) <= allowed[x] for x in words) else 0
        assert lexicon.kind(w) == want, w
    assert [lexicon.kind(w) for w in ("loweixyz", "lowei", "lowe", "", "alowei")] == [2, 2, 0, 0, 0]


def test_misspelled_stems_and_signs():
    n = 100
    counts = {"idiot"[:k]: (60, 0) for k in range(3, 6)} | {"idiots": (25, 0), "idioti": (15, 0), "idiot|": (30, 0)}
    words, stems = T.choose_terms(counts, n, n)
    assert "idiot" in words and stems == ["idiot"]
    lexicon = T.Lexicon(words, stems)
    kinds = {w: lexicon.kind(w) for w in ("idiot", "idiots", "idiotic", "iddiots", "id1ots", "idots", "idit", "adiot", "idiosyncratic", "idiom", "patriots")}
    assert kinds == {"idiot": 3, "idiots": 2, "idiotic": 2, "iddiots": 1, "id1ots": 1, "idots": 1, "idit": 1, "adiot": 1,
                     "idiosyncratic": 0, "idiom": 1, "patriots": 0}
    lexicon = T.Lexicon(["stupid"], ["idiot"])
    for text, hits in (("a st*pid id1ot", 2), ("ID!OTS", 1), ("x1stupid you@idiots", 2), ("id1ots, st$pid", 2), ("st-pid id ot", 0)):
        assert abs(T.features(text, lexicon)[4] - np.log1p(hits)) < 1e-9, text


def test_quotation_window():
    text = 'he said the word "idiot" is a word'
    spans = [m.span() for m in T._WORD.finditer(text)]
    assert T._quotation(text, spans, 4) > 0
    text = "you are an idiot and you know it"
    spans = [m.span() for m in T._WORD.finditer(text)]
    assert T._quotation(text, spans, 3) < 0


def test_toxicity(spark, sf_small):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    right = [rows[i].predicted == y for i, y in labels.items() if rows[i].held_out]
    assert len(rows) == 1000 and np.mean(right) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(1, 0), (2, None), (99, 1)], "doc_id long, toxic int")
    model = T.train(frames.docs(spark, clash=True), labels)
    assert model.words == list(T.SEED_TERMS)
    rows = [*frames.TEXTS, (50, "you idiot, you utter moron, scum"), (51, None)]
    got = {r.doc_id: r.score for r in T.score(frames.docs(spark, rows, clash=True), model).collect()}
    assert got[50] > 0.5 > got[51] and got[1] < 0.5
    assert T.score(frames.empty(spark), model).collect() == []
    kept = T.drop_toxic(frames.docs(spark, rows, clash=True), labels)
    assert 50 not in {r.doc_id for r in kept.collect()} and set(kept.columns) == set(frames.docs(spark, clash=True).columns)


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Menu, one, two, three, four, five</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, many of them, for you, and you, and you.</p></div>
<div id=wrap><div class="content"><h1>Title &amp; more</h1><p>First <b>bold, long<br>line</b> of the article, with commas, and some more of it all.
<p>Short.<ul><li>item one<li>item two</ul><blockquote>Quoted &lt;text&gt;&nbsp;here</blockquote><!-- <p>comment, no</p> -->
<p>Last paragraph of this article, which is long enough, too, to count as prose.</div>
<div class="comments"><p>A reader says, at some length, that this is wrong, wrong, wrong.</p></div></div>
<aside><p>Read also, this and that, and that, and that too, please do.</p></aside><form><p>Name, please, and your address, thanks</p></form>
<footer>&copy; all, of, us, here</footer>"""


def test_main_text():
    assert main_text(PAGE) == ("Title & more First bold, long line of the article, with commas, and some more of it all. Short. item one item two "
                               "Quoted <text> here Last paragraph of this article, which is long enough, too, to count as prose.")
    assert main_text("plain  text\n here") == "plain text here"
    assert main_text(None) == main_text("") == main_text("<script>x") == ""
    assert main_text("<article><p>Is.</p><p>" + "long " * 30_000 + "</p></article>").count("long") == 30_000


@pytest.mark.parametrize("n", [2, 60])
def test_main_text_keeps_a_layout_at_any_length(n):
    prose = [f"Paragraph {k} of the text, with a comma, and enough words to count as prose." for k in range(n)]
    body = "".join(f"<p>{p}</p>" for p in prose)
    want = ["The title", *prose, "A short note at the end of it all."]
    links = "".join(f"<li><a href=x>Somewhere else entirely {k}</a></li>" for k in range(9))
    for tag in ("article", "main"):
        page = f"<body><nav>Menu</nav><{tag}><h1>The title</h1><div>{body}</div><section><p>{want[-1]}</p></section></{tag}><footer>End</footer>"
        assert main_text(page) == " ".join(want)
    # without article or main: short sections beside a long one, and a heading beside the wrapper
    page = f"<body><h1>The title</h1><div><div><section>{body}</section><section><p>{want[-1]}</p></section></div></div><ul>{links}</ul>"
    assert main_text(page) == " ".join(want)


def test_main_text_of_a_page_inside_a_form():
    long = "A long paragraph of the text, with a comma, and enough words to count as prose."
    page = (f"<body><form id=aspnetForm><div><p>{long}</p><p>{long}</p></div><select><option>One</select><button>Send it now</button>"
            f"<textarea>Your words</textarea></form></body>")
    assert main_text(page) == f"{long} {long}"
    small = f"<body><div><p>{long}</p><p>{long}</p></div><form><p>Write to us, please, with your name and your address.</p></form></body>"
    assert main_text(small) == f"{long} {long}"


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text) for r in extract(d).collect()), key=str)
    assert got == sorted(((i, u, main_text(h)) for i, u, h in rows), key=str)
    assert extract(d.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, sf_small, name):
    assert not compare(QUERIES[name](spark, sf_small), duck_with_views(sf_small), ORACLE[name])


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline(spark, sf_small):
    """Each stage against brute force on its own input."""
    from vitals.llm.common import written
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, sf_small), f"test-{name}")
        assert out.columns == columns
        before, after = ({r.doc_id: r.text for r in x.collect()} for x in (docs, out))
        assert set(after) <= set(before)
        if name == "line_dedup":
            from tests.llm.test_lines_and_rules import brute_lines
            assert sorted(after.items(), key=str) == [(i, t) for i, t, *_ in brute_lines(list(before.items()))]
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "near_dedup":
            assert set(after) == {i for i, (_, c) in brute_groups(list(before.items()), 5).items() if i == c}
        else:
            assert after.items() <= before.items()
        kept.append(len(after))
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).collect()
    assert {r.doc_id for r in pieces} == set(after)
    assert 0 < kept[0] and corpus_pipeline.run(spark, sf_small).count() == len(pieces)
