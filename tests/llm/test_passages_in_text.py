"""Passages in running text, paragraphs with one edit, runs of a word that ends sentences."""

import random
import re

import pytest

from paddock.llm import substring_dedup as S

PASSAGE = 50


def text_of(draw, n, stops=0.15):
    return " ".join("".join(draw.choice("bcdfgaeiou") for _ in range(draw.randint(2, 7)))
                    + ("." if draw.random() < stops else "") for _ in range(n))


@pytest.fixture(scope="module")
def pairs():
    draw = random.Random(31)
    out = []
    for stops, size in ((0, 50), (0.03, 50), (0.08, 52), (0.08, 75), (0.3, 50), (0.5, 90)):
        shared = text_of(draw, size, stops)
        for _ in range(3):        # in the middle of other words, without a break
            out.append(" ".join((text_of(draw, draw.randint(20, 60), 0.1), f"x{len(out)}", shared,
                                 f"y{len(out)}", text_of(draw, draw.randint(20, 60), 0.1))))
    for n in (126, 61):
        out += [text_of(draw, 20) + " " + "of. " * n + text_of(draw, 20) for _ in range(2)]
    lines = [text_of(draw, 18, 0) + "." for _ in range(3)]
    edited = lines[1].split()
    edited[9] = "changed"
    out += [text_of(draw, 20) + "\n" + " ".join(x) + "\n" + text_of(draw, 20)
            for x in (lines, [lines[0], " ".join(edited), lines[2]])]
    out += [text_of(draw, 80) for _ in range(5)]
    return list(enumerate(out))


def word_spans(text):
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]


def covered(rows, i, a, z):
    return any(r.doc_id == i and r.start <= a and z <= r.end for r in rows)


def test_every_shared_window_is_in_a_passage(docs, pairs):
    table = docs(pairs)
    rows = S.passages(table).collect()
    seen = {}
    for i, t in pairs:
        w = word_spans(t)
        for j in range(len(w) - PASSAGE + 1):
            seen.setdefault(tuple(x[0] for x in w[j:j + PASSAGE]), []).append(
                (i, w[j][1], w[j + PASSAGE - 1][2]))
    shared = [p for p in seen.values() if len({i for i, _, _ in p}) > 1]
    assert len(shared) > 60
    words = {i: word_spans(t) for i, t in pairs}
    marked = {i: [any(r.doc_id == i and r.start <= a and z <= r.end for r in rows)
                  for _, a, z in words[i]] for i, _ in pairs}
    for places in shared:
        for i, a, z in places:
            assert all(m for m, (_, s, e) in zip(marked[i], words[i]) if a <= s and e <= z)
    # nothing of the documents that share nothing
    assert not {r.doc_id for r in rows} & {i for i, _ in pairs[-5:]}
    # the first document keeps all; the shared words leave the others
    left = {r.doc_id: r.text for r in S.remove_passages(table).collect()}
    for i, t in pairs[:18]:
        shared = t[t.index(f" x{i} ") + len(f" x{i} "):t.rindex(f" y{i} ")]
        assert (shared in left[i]) == (i % 3 == 0)
        assert left[i].split()[:3] == t.split()[:3] and left[i].split()[-3:] == t.split()[-3:]


def test_runs_of_a_word_that_ends_sentences(docs, pairs):
    rows = [r for r in S.passages(docs(pairs)).collect() if 18 <= r.doc_id < 22]
    n = {i: sum(r.n_words for r in rows if r.doc_id == i) for i in range(18, 22)}
    assert n[18] == n[19] == 126 and n[20] == n[21] == 61


def test_paragraph_with_one_edit(docs, pairs):
    texts = dict(pairs)
    rows = [r for r in S.passages(docs(pairs)).collect() if r.doc_id in (22, 23)]
    lines = {i: texts[i].split("\n")[1] for i in (22, 23)}
    assert [(r.doc_id, texts[r.doc_id][r.start:r.end], r.n_words, r.removed) for r in sorted(
        rows, key=lambda r: r.doc_id)] == [(22, lines[22], 54, False), (23, lines[23], 54, True)]


def test_equal_windows_have_equal_seeds():
    from paddock.llm.shingles import words
    draw = random.Random(1)
    own = text_of(draw, 30)
    hashes = [words([(text_of(draw, n) + " " + own + " " + text_of(draw, 40)).encode()])[0]
              for n in (7, 33)]
    assert S.least_seeds(hashes[0], 30)[7] == S.least_seeds(hashes[1], 30)[33]
    assert S.windows(hashes[0], 30)[7] == S.windows(hashes[1], 30)[33]
    assert len(set(S.windows(hashes[0], 30).tolist())) == len(hashes[0]) - 29


def test_minima_of_neighbours():
    import numpy as np
    hashes = np.random.default_rng(2).integers(0, 2**64, 90, np.uint64)
    for n in (1, 2, 3, 29, 30, 64, 90, 91):
        short = S.windows(hashes, max(1, n // 3))
        width = n - max(1, n // 3) + 1
        want = [min(short[i:i + width]) for i in range(len(hashes) - n + 1)]
        assert S.least_seeds(hashes, n).tolist() == want


def test_segments_hold_every_wanted_window_once():
    import numpy as np
    draw = np.random.default_rng(4)
    marks = draw.integers(0, 2**64, 300, np.uint64)
    marks[100:250] = marks[7]                                     # a run of equal windows
    seeds = np.repeat(draw.integers(0, 2**64, 5, np.uint64), 60)  # none longer than SEGMENT
    seeds[100:250] = seeds[100]
    wanted = np.unique(seeds)[1:]
    at, size, mark, plain = S.segments(marks, seeds, wanted)
    held = np.concatenate([np.arange(a, a + n) for a, n in zip(at, size)])
    assert held.tolist() == np.flatnonzero(np.isin(seeds, wanted)).tolist()
    for a, n, p in zip(at.tolist(), size.tolist(), plain):
        assert n <= S.SEGMENT and len(set(seeds[a:a + n].tolist())) == 1
        assert p == (len(set(marks[a:a + n].tolist())) == n)
    # equal segments have equal marks, wherever they are
    again = S.segments(np.concatenate((marks[:9], marks)), np.concatenate((seeds[:9] + np.uint64(1),
                                                                           seeds)), wanted)
    assert again[2].tolist() == mark.tolist() and (again[0] - 9).tolist() == at.tolist()
    assert len(S.segments(marks, seeds, marks[:0])[0]) == 0


def test_periodic_and_overlapping_repeats_against_brute_force(docs):
    draw = random.Random(12)
    unit = {p: text_of(draw, p, 0) for p in (1, 3, 15, 25, 70)}
    long = text_of(draw, 200, 0)
    w = long.split()
    texts = [" ".join([text_of(draw, 9, 0), *[unit[p]] * (200 // p), f"z{i}", text_of(draw, 9, 0)])
             for i, p in enumerate([p for p in unit for _ in range(2)])]
    # several owners of one text's windows, and a text that repeats itself
    texts += [" ".join(w[:90]), " ".join(w[60:150]), long, " ".join(w[100:] + ["x"] + w[100:])]
    table = docs(list(enumerate(texts)))
    spans = [word_spans(t) for t in texts]
    place = {}
    for i, s in enumerate(spans):
        for j in range(len(s) - S.MIN_WORDS + 1):
            place.setdefault(tuple(x[0] for x in s[j:j + S.MIN_WORDS]), []).append((i, j))
    want = [[None] * len(s) for s in spans]
    for at in place.values():
        if len({i for i, _ in at}) > 1:
            (i0, j0) = min(at)
            for i, j in at:
                gone = i != i0 or j >= j0 + S.MIN_WORDS
                for x in range(j, j + S.MIN_WORDS):
                    want[i][x] = gone or bool(want[i][x])
    got = [[None] * len(s) for s in spans]
    for r in S.passages(table).collect():
        for x, (_, a, z) in enumerate(spans[r.doc_id]):
            if r.start <= a and z <= r.end:
                got[r.doc_id][x] = r.removed
    # no sentence ends here, so only whole texts are units besides
    assert [[x is not None for x in g] for g in got] == [[x is not None for x in v] for v in want]
    assert got == want
