"""Places against a plain comparison at every start."""

import math
import random
import re
from collections import Counter

import pytest

from paddock.llm import licence_scan as L

from llm.conftest_llm import ODD

ROWS = [L.phrase("ab", "a b", True), L.phrase("aba", "A-B a"), L.phrase("c", "c", True),
        L.notice("long", ["d e"], "a d e f g h a b i j k", 0.7, 2),
        L.notice("loose", [], "d e a f", 0.5, 1)]


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain_scan(texts, rows):
    """(n_words, matches) of every text, trying every start."""
    cut = [plain_words(t) for t in texts]
    has = Counter(w for c in cut for w in set(c))
    idf = lambda w: math.log(1 + max(1, len(cut)) / (1 + has[w]))
    out = []
    for c in cut:
        matches = []
        for t in rows:
            total, places, size = sum(map(idf, t.words)), [], len(t.words)
            near = lambda w, i, s=t.slack: w in c[max(0, i - s):max(0, i + s + 1)]
            for o in range(-size - t.slack, len(c) + t.slack + 1):
                held = [near(w, o + j) for j, w in enumerate(t.words)]
                if not any(held):
                    continue
                score = sum(idf(w) for w, h in zip(t.words, held) if h) / total
                spots = [[p for a in range(size) if t.words[a:a + len(r)] == r
                          for p in range(max(0, o + a - t.slack), o + a + t.slack + 1)
                          if tuple(c[p:p + len(r)]) == r] for r in t.required]
                if score >= t.share - 1e-9 and all(spots):
                    exact = sum(c[o + j:o + j + 1] == [w] for j, w in enumerate(t.words) if o + j >= 0)
                    places.append((o, score, exact))
            if t.share < 1 and places:
                places = [min(places, key=lambda p: (-round(p[1], 9), -p[2], p[0]))]
            kind = "base" if t.base else "phrase" if t.share >= 1 else "notice"
            matches += [(t.label, kind, o, size, round(s, 6)) for o, s, _ in places]
        out.append((len(c), sorted(matches)))
    return out


def got(df):
    return Counter((r.doc_id, r.n_words, tuple(sorted(
        (m.label, m.kind, m.start, m.length, round(m.score, 6)) for m in r.matches)))
        for r in df.collect())


@pytest.mark.parametrize("letters", ["ab", "abcdef", "abcdefghijkxyz"])
def test_against_every_start(docs, letters):
    draw = random.Random(letters)
    texts = []
    for _ in range(250):
        w = [draw.choice(letters) for _ in range(draw.randint(0, 25))]
        if draw.random() < 0.6:
            part = list(draw.choice(ROWS).words)
            for _ in range(draw.randint(0, 3)):
                i = draw.randrange(len(part))
                part[i:i + draw.randint(0, 1)] = draw.choice([[], ["q"], [draw.choice(letters)]])
                part = part or ["q"]
            w[draw.randint(0, len(w)):0] = part
        texts.append(draw.choice([" ", ", ", "-"]).join(draw.choice([x, x.upper()]) for x in w))
    want = plain_scan(texts, ROWS)
    found = got(L.scan(docs(list(enumerate(texts))), ROWS))
    assert found == Counter((i, n, tuple(m)) for i, (n, m) in enumerate(want))
    if letters == "abcdefghijkxyz":
        assert {m[0] for _, x in want for m in x} == {"ab", "aba", "c", "long", "loose"}


def test_notices_with_edits(docs):
    label, required, text = L.NOTICES[0]
    w = text.split()
    edited = w[:30] + ["new"] + w[30:60] + w[62:]
    no_phrase = [x for x in w if x != "KIND,"]
    pairs = [(1, text), (2, " ".join(edited)), (3, " ".join(no_phrase)), (4, " ".join(w[:40])),
             (5, " ".join(random.Random(1).sample(w, len(w)))), (6, "x " * 50 + text.upper() + " y" * 9)]
    rows = {r.doc_id: r.matches for r in L.scan(docs(pairs)).collect()}
    assert [(m.label, m.kind, m.start) for m in rows[1]] == [("mit", "notice", 0)]
    assert [m.label for m in rows[2]] == ["mit"] and 0.8 <= rows[2][0].score < 1
    assert [rows[k] for k in (3, 4, 5)] == [[], [], []]
    assert [(m.start, round(m.score, 9)) for m in rows[6]] == [(50, 1)]


def test_every_template_finds_itself(docs):
    rows = L.templates()
    found = {r.doc_id: {m.label for m in r.matches if m.score > 1 - 1e-9} for r in L.scan(
        docs([(i, " ".join(t.words)) for i, t in enumerate(rows)])).collect()}
    assert all(t.label in found[i] for i, t in enumerate(rows))


def test_odd_rows(docs):
    pairs = list(enumerate(ODD)) + [(None, "MIT license"), (7, "mit-license " * 3000),
                                    (8, "éa b"), (8, "éa b"), (9, "a b")]
    want = plain_scan([t for _, t in pairs], ROWS)
    assert got(L.scan(docs(pairs), ROWS)) == Counter(
        (i, n, tuple(m)) for (i, _), (n, m) in zip(pairs, want))
    assert L.scan(docs([], "none")).count() == 0
    many = L.scan(docs(pairs, "again")).filter("doc_id = 7").first()
    assert [m.start for m in many.matches] == list(range(0, 6000, 2)) or len(many.matches) == 0


def test_counts(docs):
    table = docs([(1, "a a b"), (2, "B"), (3, None)])
    assert {r.word: r.texts for r in L.word_counts(table, ["a", "b", "c"]).collect()} == {
        "a": 1, "b": 2, "c": 0, None: 3}
    counts = {(r.label, r.kind): r.texts for r in L.label_counts(L.scan(table, ROWS)).collect()}
    assert counts == {("ab", "base"): 1}


def test_query(spark):
    from paddock.llm.queries import op12_licence_scan
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    base = [t for t in L.templates() if t.base]
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    want = set()
    for i, text in rows:
        c = plain_words(text)
        at = [(p, t.label) for t in base for p in range(len(c))
              if tuple(c[p:p + len(t.words)]) == t.words]
        want.add((i, len(c), len(at), min(at)[0] if at else None, max(at)[0] if at else None,
                  ",".join(sorted({x for _, x in at}))))
    out = op12_licence_scan(spark, sf).collect()
    assert {tuple(r[c] for c in cols) for r in out} == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in out)
