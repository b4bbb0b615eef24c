"""File splits differ from job to job (as when executors come and go): rows keep their numbers."""

import random

import pytest
from pyspark.sql import types as T

from paddock.llm import _common
from paddock.llm import exact_dedup as D
from paddock.llm import ngram_join as J
from paddock.llm import substring_dedup as S
from paddock.llm import warc as W

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def moving_splits(spark, monkeypatch):
    """From the call on, files are split otherwise before each table that is stored."""
    before = spark.conf.get(SPLIT)

    def start():
        plain, seen = _common.work_dir, []

        def moved(session, name):
            seen.append(name)
            session.conf.set(SPLIT, str(1500 * (1 + 7 * len(seen) % 5)))
            return plain(session, name)
        monkeypatch.setattr(_common, "work_dir", moved)
    yield start
    spark.conf.set(SPLIT, before)


def texts():
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("bcdaeiou") for _ in range(draw.randint(2, 7)))
    own = [" ".join(word() for _ in range(draw.randint(40, 160))) + "." for _ in range(60)]
    near = [t + " " + word() for t in own[:20]]
    copies = own[10:30]
    return own + near + copies + [word() + ". " + t for t in own[40:50]]


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


OPERATORS = {
    "op2": lambda t: D.drop_copies(t).select("doc_id", "text"),
    "op3": lambda t: J.classes(t).select("doc_id", "n_shingles", "component_id"),
    "op3 keep": lambda t: J.keep_one(t).select("doc_id", "text"),
    "op8": lambda t: S.passages(t).drop("row"),
    "op8 remove": lambda t: S.remove_passages(t).select("doc_id", "text"),
    "op9": lambda t: W.read_archives(W.normalise(W.write_archives(t, min_bytes=10))).select(
        "page_id", "payload_digest", "record_type", "refers_to"),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_same_result_whatever_the_splits(stored, moving_splits, name):
    ident, text = ("page_id", "html") if name == "op9" else ("doc_id", "text")
    schema = T.StructType([T.StructField(ident, T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField(text, T.StringType())])
    table = stored([(i, f"http://h/{i}", t) for i, t in enumerate(texts())], schema, files=5)
    want = ordered(OPERATORS[name](table))
    moving_splits()
    assert ordered(OPERATORS[name](table)) == want
