"""Exact deduplication by a heavy-hitter split.

1. One pass over the texts writes a narrow table (row, doc_id, SHA-256 digest).
2. Misra-Gries summaries with ``counters`` entries per partition are merged; the
   ``counters`` largest are candidates for frequent digests.
3. The candidates' exact group sizes and winners are counted (verified), and this
   table of at most ``counters`` rows is broadcast: rows of frequent digests are
   decided map-side and never shuffled by digest.
4. The remaining digests, none of which can hold more than about 2/counters of
   all rows, are grouped by an ordinary shuffle.

Defined cases: null text counts as empty; equality is of whole texts without any
normalisation; of equal texts the largest doc_id stays (a null doc_id is smaller
than any other); of repeated rows with that same doc_id exactly one stays. An
empty table gives an empty result. Extra columns are never read; ``drop_copies``
returns them unchanged. Rows are numbered once: the numbers are stored with the
digests. ``drop_copies`` knows rows by doc_id and digest, which any scan gives alike,
and so stores no texts; of rows alike in both, the one with the least hash of all
columns stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paddock.llm._common import fresh, id_and_text, small, staged

COUNTERS = 1024


def merge_counts(counts: Counter, more: Counter, k: int) -> Counter:
    """Misra-Gries merge: add, then take the (k+1)-th largest count off all."""
    counts.update(more)
    if len(counts) > k:
        cut = sorted(counts.values(), reverse=True)[k]
        counts = Counter({d: n - cut for d, n in counts.items() if n > cut})
    return counts


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            counts = merge_counts(counts, Counter(b.column(0).to_pylist()), k)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(counts), pa.binary()),
             "at_least": pa.array(list(counts.values()), pa.int64())})
    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` rows (digest, group_size, winner): every digest held
    by 2/counters of the rows or more, with exact sizes and winners."""
    parts = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, at_least long")
    candidates = (parts.groupBy("digest").agg(F.sum("at_least").alias("at_least"))
                  .orderBy(F.desc("at_least"), "digest").limit(counters).select("digest"))
    return (digests.join(F.broadcast(candidates), "digest")
            .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"),
                                   F.max(F.struct("doc_id", "row")).alias("winner"))
            .filter("group_size > 1"))


def decide(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(row, doc_id, digest) -> the same with keep_id, group_size, kept."""
    heavy = staged(frequent_digests(digests, counters), "exact_dedup_heavy")
    by_map = digests.join(F.broadcast(heavy), "digest")
    same = Window.partitionBy("digest")
    by_shuffle = (digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
                  .select("*", F.count(F.lit(1)).over(same).alias("group_size"),
                          F.max(F.struct("doc_id", "row")).over(same).alias("winner")))
    return by_map.unionByName(by_shuffle).select(
        "row", "doc_id", "digest", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"))


def digest_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return id_and_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _digest("text").alias("digest"))


def _digest(text_col: str):
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return F.unhex(F.sha2(text.cast("binary"), 256))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: row, doc_id, digest, keep_id, group_size, kept."""
    return decide(staged(digest_table(docs, id_col, text_col), "exact_dedup_digests"), counters)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    ident, digest, out_id, out_digest = (fresh(docs, c) for c in (
        "ident", "digest", "out_ident", "out_digest"))
    copies = exact_duplicates(docs, id_col, text_col, counters).filter("group_size > 1")
    # by doc_id and digest: how many rows there are, and whether one of them stays
    gone = staged(copies.groupBy(F.col("doc_id").alias(out_id), F.col("digest").alias(out_digest))
                  .agg(F.count(F.lit(1)).alias("held"), F.max("kept").alias("kept"))
                  .filter("held > 1 OR NOT kept"), "exact_dedup_gone")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, F.col(f"`{id_col}`").cast("long").alias(ident),
                        _digest(text_col).alias(digest))
    same = F.col(ident).eqNullSafe(F.col(out_id)) & (F.col(digest) == F.col(out_digest))
    stay = keyed.join(small(gone.select(out_id, out_digest)), same, "left_anti").select(*columns)
    alike = gone.filter("kept").select(out_id, out_digest)
    if alike.isEmpty():
        return stay
    one = (keyed.join(alike, same, "left_semi").groupBy(ident, digest)
           .agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("one")))
    return stay.unionByName(one.select("one.*"))
