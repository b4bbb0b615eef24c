import random

import numpy as np
import pytest

from paddock.llm import substring_dedup as S
from paddock.llm.shingles import lowered

from llm.conftest_llm import ODD


def sentence(draw, n):
    return " ".join("".join(draw.choice("bcdfgaeiou") for _ in range(draw.randint(2, 7)))
                    for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(21)
    prose = lambda n: " ".join(sentence(draw, draw.randint(4, 14)) for _ in range(n))
    passage = prose(9)
    line = sentence(draw, 60)
    near = line.replace(line.split()[30], "changed")
    footer = "All of this is licensed under the same terms as before."
    pairs = [(i, prose(12) + "\n" + footer) for i in range(40)]
    pairs += [(100, prose(5) + " half a sentence then " + passage + " " + prose(4)),
              (101, passage + "\n" + prose(5)), (102, prose(3) + "\n" + passage),
              (103, prose(4) + "\n" + line + "\n" + prose(2)), (104, near + "\n" + prose(3)),
              (105, prose(2) + "\n" + line + "\n" + line),
              (106, "spam " * 50 + prose(3)), (107, prose(2) + "\n" + "spam " * 80)]
    pairs += [(200 + i, t) for i, t in enumerate(ODD)]
    pairs += [(None, prose(2) + "\n" + passage), (300, pairs[7][1]), (300, pairs[7][1])]
    return pairs, passage, line


def test_planted_passages(docs, corpus):
    pairs, passage, line = corpus
    table = docs(pairs)
    text = dict(reversed(pairs))
    rows = S.passages(table).collect()
    planted = {100, 101, 102, 103, 104, 105, 106, 107, 7, 300, None}
    odd = {205, 206}    # one long word, one word repeated: alone, so no repeat
    assert {r.doc_id for r in rows} == planted and not odd & {r.doc_id for r in rows}
    for r in rows:
        if r.doc_id == 102:
            assert text[102][r.start:r.end] == passage and r.removed
        if r.doc_id == 101:    # its first sentence is whole here for the first time
            assert passage.endswith(text[101][r.start:r.end]) == r.removed
        if r.doc_id == 104:
            assert r.removed and r.first_doc_id == 103
    assert sum(r.n_words for r in rows if r.doc_id == 100) >= S.MIN_WORDS
    left = {r.doc_id: r.text for r in S.remove_passages(table).collect()}
    rest = passage[passage.index('. ') + 2:]
    assert rest not in left[101] and passage not in left[102] and passage not in left[None] and passage in left[100]
    assert line in left[103] and line not in left[105] and left[104].startswith("\n")
    assert sum(r.doc_id == 300 for r in rows) == 2 and left[3] == text[3] and left[200] is None
    assert S.remove_passages(table).columns == table.columns


def test_no_rows(docs):
    assert S.passages(docs([])).count() == 0


def test_units_against_a_plain_cut():
    draw = random.Random(8)
    texts = [" ".join(draw.choice(["ab", "ab.", "c!", "d!!", "é?", "x\n", "\n", "ab ab ab ab ab ab",
                                   "of. of. of. of.", "no!\nno!\nno!"])
                      for _ in range(40)) for _ in range(60)] + [t or "" for t in ODD]
    got = S.Units([lowered(t) for t in texts], 3)
    want = []
    for i, t in enumerate(texts):
        words, at = [], 0
        import re
        for m in re.finditer(r"[^\x20\x09-\x0D]+", t):
            words.append((m.group().lower() if m.group().isascii() else m.group(), m.start(), m.end()))
        ends = set()
        for j, (w, a, b) in enumerate(words):
            if w[-1] in ".!?" and (len(w) == 1 or w[-2] not in ".!?"):
                ends.add(j)
            if j + 1 == len(words) or "\n" in t[b:words[j + 1][1]]:
                ends.add(j)
        j = 0
        while j < len(words):
            z = j
            while z + 1 < len(words) and words[z + 1][0] == words[j][0]:
                z += 1
            if z - j + 1 >= 3:     # one unit, though its words end sentences or lines
                ends.difference_update(range(j, z))
                ends.add(z)
                if j:
                    ends.add(j - 1)
            j = z + 1
        for z in sorted(ends):
            if z - at + 1 >= 3:
                want.append((i, words[at][1], words[z][2], at, z - at + 1))
            at = z + 1
    assert list(zip(got.text.tolist(), got.start.tolist(), got.end.tolist(), got.word.tolist(),
                    got.n_words.tolist())) == want


def test_a_run_of_a_word_that_ends_sentences_is_one_unit():
    u = S.Units([("x " + "of. " * 12 + "y z").encode()], 5)
    assert list(zip(u.word.tolist(), u.n_words.tolist())) == [(1, 12)]


def test_bands_reach_the_recall():
    bands, rows = S.tuned(0.8)
    assert 1 - (1 - 0.8 ** rows) ** bands >= S.RECALL
    draw = np.random.default_rng(3)
    hit = 0
    for _ in range(300):     # units whose shingle sets have similarity 0.8 (80 of 100)
        base = [str(x) for x in draw.integers(0, 10**9, 94)]
        a, b = " ".join(base), " ".join(base[:84] + [str(x) for x in draw.integers(0, 10**9, 10)])
        u = S.Units([a.encode(), b.encode()], 5)
        keys = u.keys(bands, rows)
        hit += bool((keys[0] == keys[1]).any())
    assert hit >= 0.95 * 300


def test_sizes_count_distinct_shingles():
    draw = random.Random(12)
    texts = [" ".join(draw.choice(["ab", "c", "d", "e."]) for _ in range(draw.randint(0, 90))).encode()
             for _ in range(80)] + [b"spam " * 50, b""]
    for lines in (False, True):
        u = S.Units(texts, 5, lines)
        assert u.sizes().tolist() == [len(set(u.shingles[a:z].tolist()))
                                      for a, z in zip(u.edge[:-1].tolist(), u.edge[1:].tolist())]
    assert not len(S.Units([b""], 5).sizes())


def test_near_paragraphs_of_one_key_stay_together_and_their_sentences_apart(spark):
    """Rows that share a key and could be linked over sizes share a cell; a gap divides."""
    from paddock.llm.ngram_join import cells, size_codes
    draw = random.Random(6)
    sizes = sorted({draw.randint(4, 400) for _ in range(70)} | {5000, 9000})
    codes = size_codes(np.array(sizes), 0.8)
    for i, a in enumerate(sizes):     # no pair that may be linked is further apart
        for j, b in enumerate(sizes):
            if a <= b and 5 * a >= 4 * b:
                assert int(codes[j]) - int(codes[i]) <= 4
    keyed = spark.createDataFrame(
        [(np.array([i, i], np.int64).tobytes(), np.array([key, 77], np.uint64).tobytes(),
          np.array([c, c], np.uint8).tobytes())
         for key, own in ((5, range(0, 40, 9)), (6, range(1, 40, 9)))
         for i, c in ((i, codes[i]) for i in own)],
        "ids binary, keys binary, sizes binary")
    own = {r.node: r.root for r in cells(keyed).collect()}
    used = sorted([*range(0, 40, 9), *range(1, 40, 9)])
    up = {i: i for i in used}         # one key: rows in order of size, cut at gaps
    for a, b in zip(used[:-1], used[1:]):
        if int(codes[b]) - int(codes[a]) <= 4:
            up[b] = up[a]
    held = {r: [i for i in used if up[i] == r] for r in set(up.values())}
    got = {}
    for node, root in own.items():
        got.setdefault(root, []).append(node)
    assert sorted(map(sorted, got.values())) == sorted(x for x in held.values() if len(x) > 1)
    assert len(held) > 1


def test_narrow_numbers():
    for top in (0, 255, 256, 65535, 65536, 2**31 - 1):
        x = np.array([0, top, 7], np.int32)
        assert S._widened(S._narrow(x)).tolist() == x.tolist()
    assert not len(S._widened(S._narrow(np.empty(0, np.int32))))


def test_sets_are_cut_by_place_alone(monkeypatch):
    import pyarrow as pa
    texts = ["a b c d e f. g h i j k l m\nn o", "é b c d e f g h i. x"]
    u = S.Units([lowered(t) for t in texts], 3)
    want = {int(m): np.unique(u.shingles[a:z]).tobytes()
            for m, a, z in zip(u.marks.view(np.int64), u.edge[:-1], u.edge[1:])}
    wanted = [[{"mark": int(m), "word": int(w), "n_words": int(n)} for m, t, w, n in zip(
        u.marks.view(np.int64), u.text, u.word, u.n_words) if t == i] for i in (0, 1)]
    monkeypatch.setattr(S, "Units", None)      # the units are not cut again
    kind = pa.list_(pa.struct([("mark", pa.int64()), ("word", pa.int32()), ("n_words", pa.int32())]))
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "wanted": pa.array(wanted, kind)})
    got = [r for b in S._sets(3)(iter([batch])) for r in b.to_pylist()]
    assert len(want) > 2 and {r["mark"]: r["shingles"] for r in got} == want


def test_firsts_of_marks_with_null_ids_and_repeats():
    draw = random.Random(5)
    rows = [(draw.randrange(4), draw.choice([None, 1, 2]), draw.randrange(3), draw.randrange(3), 7)
            for _ in range(200)]
    entries = np.zeros(len(rows), S.FIRST)
    for i, (mark, doc, row, word, n) in enumerate(rows):
        entries[i] = (mark, doc is None, doc or 0, row, word, n, row, row)
    halves = np.concatenate([S._combined(entries[:90]), S._combined(entries[90:])])
    got = [tuple(x) for x in S._combined(halves).tolist()]
    for mark, last, doc, row, word, n, low, high in got:
        own = [(d is None, d or 0, r, w, n) for m, d, r, w, n in rows if m == mark]
        assert (last, doc, row, word, n) == min(own)
        assert (low, high) == (min(x[2] for x in own), max(x[2] for x in own))
    assert len(got) == len({r[0] for r in rows}) and not len(S._combined(entries[:0]))


def test_wanted_windows_against_a_plain_search():
    draw = np.random.default_rng(6)
    text = np.sort(draw.integers(0, 5, 300))
    seeds = draw.integers(0, 9, 300).astype(np.uint64)
    wanted = [[1, 8, 12], [], [0], [3, 4], [12]]
    edge = np.concatenate(([0], np.cumsum([len(w) for w in wanted])))
    got = S.wanted_windows(text, seeds, edge, np.array([x for w in wanted for x in w], np.uint64))
    assert got.tolist() == [int(s) in wanted[t] for t, s in zip(text.tolist(), seeds.tolist())]
    own, kept = S.distinct_seeds(text, seeds)
    assert list(zip(own.tolist(), kept.tolist())) == sorted({*zip(text.tolist(), seeds.tolist())})
