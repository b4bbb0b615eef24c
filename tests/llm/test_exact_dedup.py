import random
from collections import Counter

import duckdb
import pytest

from paddock.llm import exact_dedup as D

from llm.conftest_llm import ODD


def expected(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    out = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = 0
        for i in ids:
            first = i == keep and not kept
            kept += first
            out[(i, keep, len(ids), first)] += 1
    return out


@pytest.mark.parametrize("counters", [2, 1024])
def test_against_groups(docs, counters):
    draw = random.Random(5)
    pairs = [(i, draw.choice(["hot", "hot", "warm", f"t{draw.randint(0, 60)}", f"u{i}"]))
             for i in range(300)]
    pairs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "hot"), (None, None), (None, "alone"),
                                                           (299, pairs[299][1]), (7000, "x"), (7000, "x")]
    table = docs(pairs)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept)
                  for r in D.exact_duplicates(table, counters=counters).collect())
    assert got == expected(pairs)
    left = D.drop_copies(table, counters=counters)
    assert left.columns == table.columns
    assert Counter(left.select("text").toPandas().text.fillna("")) == Counter(
        {(t or ""): 1 for _, t in pairs})


def test_no_rows(docs):
    assert D.exact_duplicates(docs([])).count() == 0


def test_summary_keeps_frequent_digests():
    draw = random.Random(1)
    stream = ["a"] * 400 + ["b"] * 300 + [f"x{i}" for i in range(900)]
    draw.shuffle(stream)
    counts = Counter()
    for i in range(0, len(stream), 64):
        counts = D.merge_counts(counts, Counter(stream[i:i + 64]), 8)
        assert len(counts) <= 8
    assert counts["a"] >= 400 - len(stream) / 9 and counts["b"] >= 300 - len(stream) / 9


def test_frequent_digests_never_shuffle_by_digest(docs):
    table = docs([(i, "hot" if i % 3 else f"t{i}") for i in range(90)])
    heavy = D.frequent_digests(D.digest_table(table)).collect()
    assert [(r.group_size, r.winner.doc_id) for r in heavy] == [(60, 89)]


def test_oracle(spark):
    from paddock.llm.queries import ORACLES, op2_exact_dedup
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = {tuple(r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES['op2_exact_dedup']})").fetchall()}
    got = {tuple(r) for r in op2_exact_dedup(spark, "/root/testdata/sf0.001").select(*cols).collect()}
    assert got == want
