import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from paddock.llm import language_id as L

from llm.conftest_llm import ODD


def brute_ngrams(text):
    """Counts of 1- to 3-grams of letters, a run of other characters being one blank."""
    s = "_" + re.sub(r"[^a-z]+", "_", text.lower()).strip("_") + "_"
    out = Counter(c for c in s if c != "_")
    out.update(s[i:i + 2] for i in range(len(s) - 1))
    out.update(s[i:i + 3] for i in range(len(s) - 2) if s[i + 1] != "_")
    return out


def test_ngrams_against_strings():
    for text in ("Ab, ab!", "a", "the cat; the hat.", "  xy  z", "...q"):
        _, counts = L.ngrams(text)
        assert sorted(counts.tolist()) == sorted(brute_ngrams(text).values())


def test_out_of_place_distance():
    keys = {c: int(L.ngrams(c)[0][0]) for c in "abcd"}
    p = L.Profiles.of({"x": [keys["a"], keys["b"], keys["c"]], "y": [keys["c"], keys["a"]]}, 3)
    # by hand: own profile of "a" alone is _a_ (3 grams + letter) of which x and y know a
    own = L.ranked(*L.ngrams("a"), 3)
    places = {name: sum(abs(i - prof.index(k)) if k in prof else 3 for i, k in enumerate(own.tolist()))
              for name, prof in (("x", [keys["a"], keys["b"], keys["c"]]), ("y", [keys["c"], keys["a"]]))}
    lang, score = p.predict("a")
    best = min(places, key=lambda n: (places[n], n))
    other = max(places.values())
    assert lang == best and abs(score - (other - places[best]) / other) < 1e-12


def test_odd_texts_and_rows(docs):
    pairs = [(i, ["the house of the man and the dog", "das haus und der hund von dem mann"][i % 2])
             for i in range(40)]
    table = docs(pairs, lang="en").withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") < 30, "de"))
    got = {r.doc_id: r for r in L.identify(table).collect()}
    for i, _ in pairs:
        assert got[i].lang_pred == ("en" if i % 2 == 0 else "de") and 0 < got[i].score <= 1
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    odd = docs([(i, t) for i, t in enumerate(ODD)] + [(None, "der hund"), (None, "der hund")], "odd")
    answers = L.predict(odd, L.learn(table)).collect()
    for r in answers:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    null_id = [r for r in L.identify(odd).collect() if r.doc_id is None]
    assert len(null_id) == 2 and not null_id[0].held_out


def test_no_rows_and_no_labels(docs):
    assert L.identify(docs([])).count() == 0
    unlabelled = docs([(1, "hello there")], "plain").withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang_pred for r in L.identify(unlabelled).collect()] == ["und"]


def test_held_out_rows_are_never_learnt_from(docs):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    table = docs([(i, "zzz qqq" if i in held else "abc abd") for i in range(60)])
    profile = L.learn(table)
    assert set(profile.keys.tolist()) == set(L.ngrams("abc abd")[0].tolist())


def test_held_out_accuracy(spark):
    from paddock.llm.queries import op5_language_id
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op5_language_id(spark, sf).join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert random.Random(1).choice(rows).lang_pred in {"de", "en", "es", "fr"}
