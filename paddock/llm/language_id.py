"""Language identification by rank-order profiles.

A profile is the ``size`` most frequent 1- to 3-grams of lower-cased letters in
order of frequency (runs of other characters are one blank; n-grams may begin or
end, but not continue, with it). A document is compared with every language's
profile by the out-of-place distance: per n-gram of the document's own profile the
difference of ranks, ``size`` if the language's profile lacks it. The nearest
language wins (ties: the smaller name); the score is its lead over the second,
(d2 - d1) / d2.

Profiles are learnt from about ``sample`` labelled documents a language, chosen by
a hash of doc_id, never from held-out documents (crc32(doc_id as text) mod
``folds`` = 0). Only the text is an input of a prediction.

Defined cases: null text, empty text and text without a letter give `und` with
score 0; a null doc_id is neither learnt from nor held out; with no labelled
document everything is `und`; with one language the score is its nearness; repeated
rows get the same answer; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import staged

SIZE = 300          # n-grams of a profile
SAMPLE = 3000       # expected number of labelled documents a language to learn from
FOLDS = 5
UNKNOWN = "und"


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (up to three 21-bit code points, 0 for a blank) and counts.

    Letters lie under 2**18, so the bits above three of them tell the orders apart.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = letters()[code]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # one blank for each run of other characters, one at both ends
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    c = np.where(is_letter, code, 0)[keep]
    c = np.concatenate(([0], c, [0] if c[-1] else []))[(0 if c[0] else 1):].astype(np.int64)
    a, b = c[:-1], c[1:]
    one = c[c > 0]
    two = ((a << 21) | b) | (np.int64(1) << 42)
    two = two[(a > 0) | (b > 0)]
    x, y, z = c[:-2], c[1:-1], c[2:]
    three = ((x << 42) | (y << 21) | z) | (np.int64(1) << 61)
    three = three[y > 0]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams in order; ties by n-gram."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    """All languages' profiles: n-grams in order, and each one's rank per language."""
    names: list[str]
    keys: np.ndarray
    ranks: np.ndarray   # (n-gram, language); ``size`` where the language lacks it
    size: int

    @classmethod
    def of(cls, profiles: dict[str, list[int]], size: int) -> Profiles:
        names = sorted(profiles)
        keys = np.unique(np.array([k for p in profiles.values() for k in p], np.int64))
        ranks = np.full((len(keys) + 1, len(names)), size, np.int64)
        for j, name in enumerate(names):
            own = np.array(profiles[name], np.int64)
            ranks[np.searchsorted(keys, own), j] = np.arange(len(own))
        return cls(names, keys, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = ngrams(text or "")
        if not keys.size or not self.names:
            return UNKNOWN, 0.0
        own = ranked(keys, counts, self.size)
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        at = np.where(self.keys[at] == own, at, len(self.keys))
        rank = self.ranks[at]
        place = np.abs(rank - np.arange(len(own))[:, None])
        place[rank == self.size] = self.size
        distance = place.sum(axis=0)
        best = int(distance.argmin())
        if len(self.names) == 1:
            return self.names[0], float(1 - distance[0] / (self.size * len(own)))
        second = np.partition(distance, 1)[1]
        return self.names[best], float((second - distance[best]) / second) if second else 0.0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        by: dict[str, list] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            by.setdefault(lang, []).append(ngrams(text))
        for lang, parts in by.items():
            keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()),
                                              "ngram": pa.array(keys, pa.int64()),
                                              "n": pa.array(n, pa.int64())})


def fold(id_col: str, folds: int = FOLDS):
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", size: int = SIZE, sample: int = SAMPLE,
          folds: int = FOLDS) -> Profiles:
    """Profiles of the languages named in ``lang_col`` of documents not held out."""
    labelled = (docs.select(fold(id_col, folds).alias("fold"),
                            F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 30)).alias("draw"),
                            F.col(f"`{text_col}`").alias("text"),
                            F.col(f"`{lang_col}`").alias("lang"))
                .filter("fold <> 0 AND lang IS NOT NULL AND text IS NOT NULL"))
    # one row a language
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Profiles.of({}, size)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, int((1 << 30) * min(1.0, sample / n)))])
    chosen = labelled.filter(F.col("draw") < F.element_at(share, F.col("lang"))).select("text", "lang")
    counts = staged(chosen.mapInArrow(_count, "lang string, ngram long, n long")
                    .groupBy("lang", "ngram").agg(F.sum("n").alias("n")), "language_counts")
    top = None
    for lang in sorted(sizes):   # size rows a language
        own = (counts.filter(F.col("lang") == lang).orderBy(F.desc("n"), "ngram").limit(size))
        top = own if top is None else top.unionByName(own)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in top.collect():
        profiles.setdefault(r["lang"], []).append((-r["n"], r["ngram"]))
    return Profiles.of({k: [g for _, g in sorted(v)] for k, v in profiles.items()}, size)


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text",
            lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang string, score double")
    def guess(texts):
        import pandas as pd
        return pd.DataFrame([model.value.predict(t) for t in texts], columns=["lang", "score"])

    # evaluated once, even if a later filter asks for the language
    once = guess.asNondeterministic()(F.col(f"`{text_col}`"))
    both = docs.select(F.struct("*").alias("row"), once.alias("guess"))
    return both.select("row.*", F.col("guess.lang").alias(lang_pred),
                       F.col("guess.score").alias(score))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", size: int = SIZE, sample: int = SAMPLE,
             folds: int = FOLDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    profiles = learn(docs, id_col, text_col, lang_col, size, sample, folds)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.coalesce(fold(id_col, folds) == 0, F.lit(False)).alias("held_out"),
                         F.col(f"`{text_col}`").alias("text"))
    return predict(source, profiles).select("doc_id", "held_out", "lang_pred", "score")
