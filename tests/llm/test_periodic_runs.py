"""Runs against a quadratic search over all lags."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.llm import periodic_runs as R
from paddock.llm.shingles import words

from llm.conftest_llm import ODD


def plain_runs(tokens, shortest=6, repeats=4):
    """Every maximal stretch at every lag, then the least lag of each stretch."""
    n, least = len(tokens), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and tokens[j] == tokens[j + q]:
                j += 1
            if j - i + q >= max(shortest, repeats * q):
                least.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in least.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(tokens, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(tokens) if i not in gone)


def found(texts, **k):
    hashes, _, _, first = words([t.encode() for t in texts])
    return R.runs_of(hashes, first, **k)


def looped(draw, n, alphabet):
    """Words with periodic parts of any period, some of them nested."""
    out = []
    while len(out) < n:
        block = [draw.choice(alphabet) for _ in range(draw.choice([1, 2, 3, 7, 9, 16, 17, 40, 65, 130]))]
        if draw.random() < 0.3:
            block = block[:5] * 5 + block[5:]
        times = draw.choice([1, 1, 2, 3.9, 4, 4.1, 5, 9])
        out += (block * 9)[:int(len(block) * times)]
        if out and draw.random() < 0.3:
            out[draw.randrange(len(out))] = "odd"
    return out[:n]


@pytest.mark.parametrize("letters", ["ab", "abcdef", None])
def test_against_all_lags(letters):
    draw = random.Random(letters)
    texts = [looped(draw, draw.choice([0, 1, 5, 6, 30, 200, 700, 1500]),
                    letters or [f"w{i}" for i in range(300)]) for _ in range(60)]
    want = [plain_runs(t) for t in texts]
    assert sum(map(len, want)) > 40 and any(q > 64 for x in want for _, _, q in x)
    assert found([" ".join(t) for t in texts]) == want


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=120), min_size=1, max_size=6))
def test_any_words(texts):
    assert found([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("q", [1, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100])
@pytest.mark.parametrize("repeats", [3, 4, 6])
def test_every_period_at_its_least_length(q, repeats):
    draw = random.Random(q)
    block = [f"w{draw.random()}" for _ in range(q)]
    for length in (repeats * q - 1, repeats * q, repeats * q + 1):
        text = ["x", "y"] + (block * (repeats + 1))[:length] + ["z"]
        want = [(2, length, q)] if length >= repeats * q else []
        if length >= 3:
            assert found([" ".join(text)] * 2, shortest=1, repeats=repeats) == [want] * 2


def test_thue_morse_words_and_equal_texts_side_by_side():
    word = "a"
    for _ in range(9):
        word += word.translate({97: "b", 98: "a"})
    text = " ".join(word * 4)
    assert found([text, text, "a", "a"]) == [plain_runs(list(word * 4))] * 2 + [[], []]


def test_one_word_many_times():
    assert found(["w " * 200_000, "v " * 5]) == [[(0, 200_000, 1)], []]


def test_minimizers_of_windows():
    draw = np.random.default_rng(3)
    for width in (1, 2, 3, 8, 13):
        x = draw.integers(0, 9, 60).astype(np.uint64)
        want = sorted({i for s in range(60 - width + 1) for i in range(s, s + width)
                       if x[i] == x[s:s + width].min()})
        assert R.minimizers(x, width).tolist() == want


def test_rows(docs):
    pairs = [(i, t) for i, t in enumerate(ODD)] + [(None, "a " * 9), (7, "a b\n" * 6), (7, "a b\n" * 6)]
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed)
                  for r in R.find_runs(docs(pairs)).collect())
    want = Counter()
    for i, t in pairs:
        tokens = [w.decode() for w in (t or "").encode().split()]
        runs = plain_runs(tokens)
        want[i, len(tokens), tuple(runs), plain_collapse(tokens, runs)] += 1
    assert got == want
    assert R.find_runs(docs([], "none")).count() == 0


def contract(doc_id, text):
    """The query's row, straight from its definition."""
    tokens = [w.decode() for w in (text or "").encode().split()]
    n, h = len(tokens), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tokens = [w if i < a else tokens[a + (i - a) % p] for i, w in enumerate(tokens)]
    runs = plain_runs(tokens)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            sha256(plain_collapse(tokens, runs).encode()).hexdigest())


def test_query(spark):
    from paddock.llm.queries import op11_periodic_runs
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
            "collapsed_sha256"]
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {contract(*r) for r in texts}
    got = {tuple(r) for r in op11_periodic_runs(spark, sf).select(*cols).collect()}
    assert got == want and sum(r[1] > 0 for r in want) > 15


def test_query_on_odd_rows(docs):
    from paddock.llm.queries import periodic
    pairs = [(i, t) for i in range(40) for t in ("", None, "a", "a b c d e f g h", " ".join(f"w{k}" for k in range(50)))]
    got = Counter(tuple(r) for r in periodic(docs(pairs)).collect())
    assert got == Counter(contract(i, t) for i, t in pairs)
    alone = periodic(docs([(None, "a b"), (None, None)], "alone")).collect()
    assert [r.n_runs for r in alone] == [0, 0]
