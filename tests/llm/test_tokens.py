"""Packing, segmentation, token counts and chat formatting."""

import hashlib
import itertools
import random
from array import array

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import frames
from vitals.llm import chat_format as C
from vitals.llm import packing as P
from vitals.llm.pieces import META, Pieces
from vitals.llm.segmentation import Segmenter, n_best, segment
from vitals.llm.token_counts import PrefixCounts, count_tokens

FILE, RANKS, MODEL = (public.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
EXACT = Tokenizer.from_file(FILE)
IDS = P.Ids(FILE, RANKS)
PIECES = Pieces(MODEL)


def ids_of(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet="aZé_ 9'\t\n\xa0st're.,×÷ªºµ¼ßƻ—漢<|endoftext|>", max_size=20))
@settings(max_examples=400, deadline=None)
def test_fast_ids_equal_tokenizers(text):
    assert IDS(text).tolist() == ids_of(text)


@given(st.lists(st.integers(1, 5000), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_pack_block(lengths):
    pieces = list(P.pack_block(np.array(lengths), 1024))
    own, rows = {}, {}
    for d, start, n, s, o in pieces:
        own.setdefault(d, []).append((start, n))
        rows.setdefault(s, []).append((o, n))
    for d, parts in own.items():
        assert sum(n for _, n in parts) == lengths[d]
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:]))
    assert set(own) == set(range(len(lengths)))
    for parts in rows.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    full = [sum(n for _, n in p) for p in rows.values()]
    assert max(full) <= 1024 and sum(x < 1024 for x in full) <= 1


def test_nnls_solves_a_feasible_histogram():
    hist = np.zeros(1024, dtype=int)
    hist[[300, 724]] = 40
    hist[[100, 924]] = 7
    hist[[200, 400, 424]] = 11
    plan = P.plan(hist, 1024)
    assert all(sum(parts) == 1024 and not cut for _, parts, cut in plan) and sum(t for t, *_ in plan) == 58


@pytest.mark.parametrize("clash", [False, True])
def test_pack(spark, clash):
    rows = P.pack(frames.docs(spark, clash=clash).repartition(3), FILE, RANKS, block_tokens=900).collect()
    texts = {}
    for i, t in frames.TEXTS:
        texts.setdefault(i, []).append([*ids_of(t), 0])
    for i in texts:
        mine = [r for r in rows if r.doc_id == i]
        assert sum(r.length for r in mine) == sum(map(len, texts[i]))
        for r in mine:
            assert r.doc_tokens == len(texts[i][0])
            assert np.frombuffer(r.ids, "<u4").tolist() == texts[i][0][r.start:r.start + r.length]
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 1024
    assert P.pack(frames.empty(spark), FILE, RANKS).collect() == []
    assert {r.ids_crc32 for r in P.digest(spark.createDataFrame([r for r in rows])).collect()} == {P.checksum(np.frombuffer(r.ids, "<u4")) for r in rows}


def brute_segmentations(unit):
    out = []

    def go(i, score, ids):
        if i == len(unit):
            out.append((score, ids))
            return
        level, single = PIECES.trie, False
        for j in range(i, len(unit)):
            if (node := level.get(unit[j])) is None:
                break
            level, k, s = node
            if k >= 0:
                single |= j == i
                go(j + 1, score + s, [*ids, k])
        if not single:
            go(i + 1, score + PIECES.missing, ids + PIECES.bytes_of(unit[i]))
    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_and_counts_against_all_segmentations():
    rng = random.Random(5)
    for _ in range(300):
        unit = META + "".join(rng.choice("therandiç漢\n▁") for _ in range(rng.randint(1, 8))).replace(META, "")
        every, found = brute_segmentations(unit), n_best(unit, PIECES, 4)
        assert [round(s, 9) for s, _ in found] == [round(s, 9) for s, _ in every[:4]]
        assert len({tuple(x) for _, x in found}) == len(found)
        counts = PrefixCounts(PIECES)
        n = counts.count(unit)
        assert n in {len(x) for s, x in every if abs(s - every[0][0]) < 1e-9}


def test_ties_of_one_letter():
    """Equal ways by the thousand: as brute force on short runs, quick on long ones."""
    import time
    for letter in "a=-":
        for k in range(1, 14):
            every, found = brute_segmentations(letter * k), n_best(letter * k, PIECES, 5)
            assert [round(s, 9) for s, _ in found] == [round(s, 9) for s, _ in every[:5]]
            assert len({tuple(x) for _, x in found}) == len(found) == min(5, len(every))
    start = time.perf_counter()
    found = n_best("a" * 20_000, PIECES, 3)
    assert time.perf_counter() - start < 5 and len(found) == 3
    assert all(PIECES.decode(array("I", ids)).count("a") == 20_000 for _, ids in found)


def test_cuts_lie_where_no_piece_holds_both_characters():
    text = "the end.\n  of (all) things — 漢字 x_y"
    units = PIECES.units(text)
    assert "".join(units) == META + text.replace(" ", META)
    pieces = [x for x in PIECES.text_of if isinstance(x, str)]
    for a, b in zip(units, units[1:]):
        assert not any(a[-1] + b[0] in x for x in pieces)


def test_text_n_best_against_all_combinations():
    text = "the red cat"
    lists = [brute_segmentations(u) for u in PIECES.units(text)]
    every = sorted(sum(x[0] for x in way) for way in itertools.product(*lists))[::-1]
    got = Segmenter(PIECES, 4).segment(text)
    assert [round(s, 9) for s, _ in got] == [round(s, 9) for s in every[:4]]


@given(st.text(alphabet="ab c▁\n\t é漢.,12’ ", max_size=25))
@settings(max_examples=200, deadline=None)
def test_round_trip(text):
    for _, ids in Segmenter(PIECES, 3).segment(text):
        assert PIECES.decode(array("I", ids)) == text


def test_segment_and_counts_on_frames(spark):
    for clash in (False, True):
        d = frames.docs(spark, clash=clash)
        rows = segment(d, MODEL).collect()
        assert sorted(((r.doc_id, r.decoded) for r in rows), key=str) == sorted(((i, t or "") for i, t in frames.TEXTS), key=str)
        n = {(r.doc_id, r.n_tokens) for r in count_tokens(d, MODEL).collect()}
        assert n == {(r.doc_id, r.best[0].n_pieces) for r in rows}
    assert segment(frames.empty(spark), MODEL).collect() == [] == count_tokens(frames.empty(spark), MODEL).collect()


@given(st.lists(st.sampled_from(["</s>", "<s>", "[INST]", "[\\INST]", "<", "[", "\\", "/s>", "s>", "<|end|>", "<<SYS>>", "x"]), max_size=8))
def test_escape_is_reversible(parts):
    text = "".join(parts)
    assert C.unescape(C.escape(text)) == text
    assert not any(x in C.escape(text) for x in ("</s>", "<s>", "[INST]", "<<SYS>>", "<|end|>"))


TURNS = [(1, 0, "user", "hi <|end|> </s>"), (1, 1, "assistant", "yes [INST]"), (1, 1, "assistant", "yes [INST]"), (1, 2, None, None), (2, None, "assistant", ""),
         (None, 0, "assistant", "nobody"), (3, 5, "tool\nx", "漢 ü"), (3, 4, "assistant", frames.LONG), *[(4, k, "user" if k % 2 == 0 else "assistant", f"turn {k} \\ <s>") for k in range(200)]]


def test_chat(spark):
    for schema, extra in (("conv_id long, turn long, role string, text string", ()),
                          ("conv_id long, turn long, role string, text string, ids int, part int, start int", (1, 2, 3))):
        d = spark.createDataFrame([(*t, *extra) for t in TURNS], schema).repartition(4)
        formatted = C.format_turns(d, FILE, RANKS)
        got = {r.conv_id: r for r in C.read_back(formatted, FILE, RANKS).collect()}
        for conv in {t[0] for t in TURNS}:
            rows = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
            rows = [(r or "", x or "") for _, _, r, x in rows]
            learned = "".join(x for r, x in rows if r == "assistant")
            r = got[conv]
            assert r.n_turns == len(rows) and r.loss_chars == len(learned)
            assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
            assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        places = sorted((r.turn_index, r.start, r.n_ids) for r in formatted.collect() if r.conv_id == 4)
        assert [p[0] for p in places] == list(range(200))
        assert all(s + n == t for (_, s, n), (_, t, _) in zip(places, places[1:]))
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_back(C.format_turns(none, FILE, RANKS), FILE, RANKS).collect() == []
