import random

import pytest
from pyspark.sql import types as T

import corpus_pipeline as C
from llm.conftest_llm import ODD


ENGLISH = "the of and to in house man dog day sun red big"
GERMAN = "der und nicht von zwischen haus mensch hund tag sonne rot groß"


def prose(draw, n, words=ENGLISH):
    return " ".join(draw.choice(words.split())
                    + draw.choice(["", "s", "ly", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    texts = [prose(draw, 60) for _ in range(30)]
    near = texts[2] + " one more end"
    pairs = [(i, t) for i, t in enumerate(texts)] + [
        (40, texts[0]), (41, texts[0]), (42, near), (43, texts[3] + " mail a.b@c.example.org now"),
        (44, "call +1 (988) 555-2485 " + prose(draw, 50))]
    pairs += [(200 + i, prose(draw, 60, GERMAN)) for i in range(12)]
    return pairs + [(100 + i, t) for i, t in enumerate(ODD)] + [(None, prose(draw, 40)), (5, texts[5])]


WRONG = {3, 44}


def table(stored, rows, name="documents"):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    lang = lambda i: None if not i or i % 7 == 0 else "de" if i >= 200 or i in WRONG else "en"
    return stored([(i, t, lang(i), "s", len(t or "")) for i, t in rows],
                  schema, f"{name}.parquet")


def test_stages(spark, stored, rows, tmp):
    docs = table(stored, rows)
    names = docs.columns
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, tmp)
        if name != "packing":
            assert out.columns == names
        path = f"{tmp}/stage_{name}"
        out.write.parquet(path)
        docs = seen[name] = spark.read.parquet(path)
    told = {(r.doc_id, r.text): r.lang for r in seen["language_id"].collect()}
    assert set(told) == {(i, t) for i, t in rows if any(c.isalpha() for c in t or "")}
    # stated or not, right or wrong: the language is the predicted one
    prose_of = {i: t for i, t in rows if i is None or i < 100 or i >= 200}
    assert all(told[i, t] == ("de" if i and i >= 200 else "en") for i, t in prose_of.items())
    exact = sorted((r.doc_id is None, r.doc_id or 0) for r in seen["exact_dedup"].collect())
    groups = {}
    for i, t in told:
        groups.setdefault(t, []).append(i)
    keep = [max((i for i in g if i is not None), default=None) for g in groups.values()]
    assert exact == sorted((i is None, i or 0) for i in keep)
    left = {r.doc_id for r in seen["ngram_join"].collect()}
    assert set(keep) - left == {42, 43}    # near copies of 2 and 3
    clean = {r.doc_id: r for r in seen["pii"].collect()}
    assert set(clean) == left and clean[44].text.startswith("call <PHONE> ")
    assert all(r.n_chars == len(r.text) for r in clean.values())
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == left
    held = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048


def test_run_equals_the_stages_and_takes_no_rows(spark, stored, rows, tmp):
    table(stored, rows)
    assert {r.doc_id for r in C.run(spark, tmp).collect()} >= {2, 3, 41, 44}
    empty = f"{tmp}/none"
    spark.read.parquet(f"{tmp}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    assert C.run(spark, empty).count() == 0
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "ngram_join", "pii", "packing"]


def test_registered_queries():
    import __spark_entry__ as e
    names = {n.split("_")[0] for n in e.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in e.queries()
    assert {"op2_exact_dedup", "op9_warc", "op10_chat_formatting"} <= set(e.oracle_sql())
