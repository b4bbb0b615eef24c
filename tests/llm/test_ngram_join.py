import random
import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest

from paddock.llm import ngram_join as J
from paddock.llm.components import components

from llm.conftest_llm import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def expected(pairs, k, t):
    sets = [shingles(x, k) for _, x in pairs]
    up = list(range(len(pairs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in combinations(range(len(pairs)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and both >= t * (len(sets[i]) + len(sets[j]) - both):
            up[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(pairs):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(pairs)), key=str)


def family(draw, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            at = draw.randrange(len(w))
            w[at:at + draw.randint(0, 1)] = [f"e{draw.randint(0, 999)}"]
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcde") for _ in range(draw.randint(1, 4)))
    texts = []
    for size in (5, 7, 9, 14, 30, 33, 60, 130, 400):
        base = [word() for _ in range(size)]
        texts += family(draw, base, 14, max(1, size // 15))
    line = [word() for _ in range(12)]
    texts += [" ".join(line + [word() for _ in range(draw.randint(1, 40))]) for _ in range(60)]
    texts += [texts[3], texts[40], texts[40].upper(), "A b", "a B", "one", "one two three four"]
    pairs = list(enumerate(texts)) + [(900 + i, t) for i, t in enumerate(ODD)]
    return pairs + [(None, texts[20]), (None, "only null ids here now"), (5, texts[5]), (-1, texts[60])]


@pytest.mark.parametrize("k,t", [(4, Fraction(85, 100)), (5, Fraction(4, 5)), (3, Fraction(1, 2))])
def test_classes_against_all_pairs(docs, corpus, k, t):
    got = J.classes(docs(corpus), k, t).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected(corpus, k, t)


def test_frequent_keys_and_large_cells(docs, corpus, monkeypatch):
    """The paths of hot blocks (broadcast hubs) and of cells cut into blocks give the same."""
    draw = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    pairs = list(enumerate(family(draw, base, 260, 5)))
    monkeypatch.setattr(J, "BLOCK", 40)
    monkeypatch.setattr(J.blocked, "__defaults__", (40,))
    monkeypatch.setattr(J.cell_links, "__defaults__", (J.SIMILARITY, 40))
    table = docs(pairs)
    keyed = J.signatures(table)
    assert J.frequent_keys(keyed)
    got = J.classes(table).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected(
        pairs, 4, Fraction(85, 100))


def test_texts_stay_in_place_however_many_are_verified(spark, docs, corpus, monkeypatch):
    """Beyond the rows that are broadcast, neither texts nor sets are shuffled by row."""
    plans, write, most = [], J.staged, 50

    def seen(df, name, *more):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, name, *more)

    monkeypatch.setattr(J, "staged", seen)
    monkeypatch.setattr(J, "BROADCAST_ROWS", most, raising=False)
    monkeypatch.setitem(J.small.__globals__, "BROADCAST_ROWS", most)
    table = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(table)
    spark.conf.set(table, "-1")
    try:
        got = J.classes(docs(corpus)).collect()
    finally:
        spark.conf.set(table, before)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected(
        corpus, 4, Fraction(85, 100))
    heavy = [p for name, p in plans if name in ("ngram_join_sets", "ngram_join_links")]
    assert heavy and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in heavy)
    assert sum(name == "ngram_join_sets" for name, _ in plans) > 1      # several parts


def test_one_document_of_each_class_stays(docs, corpus):
    table = docs(corpus)
    left = J.keep_one(table)
    assert left.columns == table.columns
    want = expected(corpus, 4, Fraction(85, 100))
    classes = {c for _, n, c in want if n}
    empty = sum(1 for _, n, _ in want if not n)
    assert left.count() == len(classes) + empty
    assert {r.doc_id for r in left.select("doc_id").collect()} >= classes - {None}


def test_no_rows(docs):
    assert J.classes(docs([])).count() == 0


def test_linked_sets_share_a_key():
    draw = np.random.default_rng(4)
    for t in (Fraction(85, 100), Fraction(4, 5), Fraction(1, 2)):
        bounds = J.Bounds(t)
        for _ in range(400):
            n = int(draw.integers(1, 90))
            a = draw.integers(0, 2**64, n, np.uint64)
            gone, new = int(draw.integers(0, n // 3 + 1)), int(draw.integers(0, n // 3 + 1))
            b = np.concatenate((a[gone:], draw.integers(0, 2**64, new, np.uint64)))
            if len(b) and bounds.linked(len(a) - gone, len(a), len(b)) and (gone or new):
                assert np.intersect1d(J.block_keys(np.unique(a), bounds),
                                      J.block_keys(np.unique(b), bounds)).size


def test_tree_loses_no_candidate():
    draw = np.random.default_rng(5)
    bounds = J.Bounds(J.SIMILARITY)
    sets = [np.unique(draw.integers(0, 400, draw.integers(1, 200)).astype(np.uint64)) for _ in range(300)]
    points = np.stack([J.point(s, 32) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = J.RTree(points, sizes)
    for i in range(0, 300, 7):
        found = set(tree.order[tree.candidates(points[i], int(sizes[i]), bounds)].tolist())
        for j, s in enumerate(sets):
            if bounds.linked(J.common(sets[i], s), len(sets[i]), len(s)):
                assert j in found


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [
        (200, 201), (201, 202), (202, 200), (300, 300), (-5, -9), (40, 0)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {
        200: 200, 201: 200, 202: 200, 300: 300, -5: -9, -9: -9}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pairs_of_small_cells_link_as_by_the_tree():
    import pyarrow as pa
    draw = np.random.default_rng(8)
    sim, sets, cell, side = Fraction(4, 5), [], [], []
    for c in range(120):
        base, two = draw.integers(0, 2**63, 30).astype(np.uint64), c % 3 == 0
        for i in range(2 + c % 5):
            own = base.copy()
            own[:draw.integers(0, 7)] += np.uint64(1 + i)
            sets.append(np.unique(own))
            cell.append(c)
            side.append(i % 2 if two else 0)
    table = pa.table({"cell": cell, "pair": [0] * len(cell), "row": list(range(len(cell))),
                      "side": side, "shingles": [s.tobytes() for s in sets]})

    def classes(direct):
        forest = J.Forest(len(cell))
        for r in J._verified(sim, direct)(table).to_pylist():
            assert cell[r["u"]] == cell[r["v"]]
            forest.join(r["u"], r["v"])
        return [forest.find(i) for i in range(len(cell))]
    assert classes(4) == classes(0) != list(range(len(cell)))
