"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio, all in
DataFrame functions.

Words are maximal runs without blank or \\t \\n \\v \\f \\r. Their hashed 1- and
2-grams fall into ``buckets`` buckets. Two multinomials over the buckets are counted:
the raw corpus (every document, whole texts) and the trusted target (every labelled
document with quality 1 and no toxic mark). A bucket's weight is the log ratio of its smoothed shares in
millionths, rounded to an integer, so that a document's sum does not depend on the
order of addition. score = sum of weights / number of n-grams: length-normalised.
Every document is held against one threshold, the higher of two: ``spread`` standard
deviations under the mean score of the trusted documents, and the score that parts the
trusted documents from those labelled poor (quality 0) with the fewest errors. The first
alone lets poor documents pass where the trusted scores are spread widely, as by short texts
or many copies of one text; the second alone says nothing where no poor one is labelled.
For the second, a document is scored by the ratio to a target without the trusted documents
of its fold (one of ``FOLDS``, by a hash of the id): trusted documents would else part better
from poor ones than good documents do that nobody labelled.

Windows, lines and n-grams stay inside a document's row as arrays, so nothing is
shuffled but bucket counts (and, where there are too many trusted ids to send to every
executor, the hashes or scores that are joined with them) and counts of labelled scores.

Defined cases: null text has no words; a document without words has score null, fails
the base rules and is not kept; a null doc_id is no trusted document; repeated rows
get the same answer; a document labelled both trusted and poor counts as trusted; without
any trusted document the verdict is the base rules'; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import small, staged

BUCKETS = 10_000
SPREAD = 6.0
UNIT = 1_000_000          # weights are integers in millionths
FOLDS = 8
GRID = 1_000              # steps of the parting threshold in an interval of scores of 1
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def _next(values: str, by: int) -> Column:
    """The array from its (by+1)-th element on."""
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _joined(values: str, by: int) -> Column:
    """Hashes of every element with the one ``by`` places on."""
    return F.zip_with(F.slice(values, 1, F.greatest(F.size(values) - by, F.lit(0))), _next(values, by),
                      lambda a, b: F.xxhash64(a, b))


def hashed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, words, h1 (hash of every word), h2 (of every pair of neighbours)."""
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
            .withColumn("words", F.filter(F.split("text", BLANK), lambda w: w != ""))
            .withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("h2", _joined("h1", 1)))


def repeated_words(hashed: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in WINDOW-word windows found twice or more."""
    windows = (hashed.withColumn("h4", _joined("h2", 2)).withColumn("h8", _joined("h4", 4))
               .withColumn("repeats", F.size(F.array_distinct("h8")) < F.size("h8")))
    # for texts with repeats: windows by hash, those equal to a neighbour, by place
    by_hash = (windows
               .withColumn("by_hash", F.when(F.col("repeats"), F.sort_array(F.transform(
                   "h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
               .withColumn("twin", F.zip_with("by_hash", _next("by_hash", 1),
                                              lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))))
    marked = F.arrays_zip(F.col("by_hash.i").alias("i"), F.col("twin").alias("after"),
                          F.concat(F.array(F.lit(False)), F.col("twin")).alias("before"))
    starts = F.sort_array(F.transform(F.filter(marked, lambda m: m["i"].isNotNull()
                                               & (m["after"] | m["before"])), lambda m: m["i"]))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"),
                                i.alias("last")))["n"]
    return (by_hash.withColumn("starts", F.when(F.col("repeats"), starts))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("h4", "h8", "repeats", "by_hash", "twin", "starts"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all trusted documents."""
    return (labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
            .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())


def poor_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled as of poor quality, trusted ones perhaps among them."""
    return (labels.filter("quality = 0 AND doc_id IS NOT NULL")
            .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())


def _fold() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")


def bucket_counts(hashed: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n_raw, n_target over all n-grams of all documents; n_fold: of the target's,
    those of each fold."""
    marked = (hashed.select("doc_id", "h1", "h2")
              .join(trusted.withColumn("trusted", F.lit(1)), "doc_id", "left")
              .withColumn("fold", F.when(F.col("trusted") == 1, _fold())))
    folds = [F.count_if(F.col("fold") == f).alias(f"n_{f}") for f in range(FOLDS)]
    return (marked.select("trusted", "fold", F.explode(F.concat("h1", "h2")).alias("h"))
            .groupBy(F.pmod("h", F.lit(buckets)).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_raw"), F.count("trusted").alias("n_target"), *folds)
            .select("bucket", "n_raw", "n_target", F.array(*[f"n_{f}" for f in range(FOLDS)])
                    .alias("n_fold")))


def weights(counts: DataFrame, buckets: int = BUCKETS) -> tuple[list[int], list[int]] | None:
    """Log ratio of every bucket in units; the same by a target without one fold, fold after
    fold. ``buckets`` rows come to the driver."""
    import math
    rows = {r["bucket"]: r for r in counts.collect()}
    none = {"n_raw": 0, "n_target": 0, "n_fold": [0] * FOLDS}
    rows = [rows.get(b, none) for b in range(buckets)]
    raw = sum(r["n_raw"] for r in rows)
    if not any(r["n_target"] for r in rows):
        return None

    def ratios(own):
        target = sum(own)
        return [round(UNIT * math.log(((n + 1) / (target + buckets)) / ((r["n_raw"] + 1) / (raw + buckets))))
                for n, r in zip(own, rows)]

    return (ratios([r["n_target"] for r in rows]),
            [w for f in range(FOLDS) for w in ratios([r["n_target"] - r["n_fold"][f] for r in rows])])


def scored(hashed: DataFrame, weight: tuple[list[int], list[int]] | None,
           buckets: int = BUCKETS) -> DataFrame:
    """Adds ``score`` and ``held`` (by the target without the document's fold)."""
    if weight is None:
        none = F.lit(None).cast("double")
        return hashed.withColumns({"score": none, "held": none})
    n = F.size("h1") + F.size("h2")

    def mean(own, first):
        table = F.split(F.lit(",".join(map(str, own))), ",").cast("array<bigint>")
        total = lambda col: F.aggregate(
            col, F.lit(0).cast("long"),
            lambda acc, h: acc + F.get(table, (first + F.pmod(h, F.lit(buckets))).cast("int")))
        return F.when(n > 0, (total("h1") + total("h2")) / n / UNIT)

    full, left_out = weight
    return (hashed.withColumn("first", _fold() * buckets)
            .withColumns({"score": mean(full, F.lit(0)), "held": mean(left_out, F.col("first"))}))


def threshold(scores: DataFrame, trusted: DataFrame, spread: float = SPREAD) -> float | None:
    """``spread`` standard deviations under the trusted documents' mean score."""
    # scores in whole units, so that the sums are exact
    unit = F.round(F.col("score") * UNIT).cast("decimal(20,0)")
    n, s, q = (scores.join(trusted, "doc_id", "left_semi").filter("score IS NOT NULL")
               .agg(F.count("score"), F.sum(unit), F.sum((unit * unit).cast("decimal(30,0)"))).first())
    if not n:
        return None
    mean = float(s) / n
    return (mean - spread * max(0.0, float(q) / n - mean * mean) ** 0.5) / UNIT


def parting(scores: DataFrame, trusted: DataFrame, poor: DataFrame) -> float | None:
    """The least score, in steps of 1/GRID, under which rejecting makes the fewest errors:
    trusted documents under it and poor ones from it on. ``scores`` (doc_id, held) are of
    documents that the score decides on; None without both kinds. The counts that come to the
    driver are as many as steps between the least and the greatest log ratio."""
    own = scores.filter("held IS NOT NULL")
    at = F.floor(F.col("held") * GRID)
    marked = own.join(trusted, "doc_id", "left_semi").select(at.alias("at"), F.lit(1).alias("good"))
    others = (own.join(poor, "doc_id", "left_semi").join(trusted, "doc_id", "left_anti")
              .select(at.alias("at"), F.lit(0).alias("good")))
    steps = sorted(marked.unionByName(others).groupBy("at").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("poor")).collect())
    if not any(good for _, good, _ in steps) or not any(bad for _, _, bad in steps):
        return None
    least, errors = steps[0][0], sum(bad for _, _, bad in steps)
    fewest = errors
    for step, good, bad in steps:       # from here on, this step is rejected too
        errors += good - bad
        if errors < fewest:
            least, fewest = step + 1, errors
    return least / GRID


def rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, spread: float = SPREAD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, score."""
    hashed = hashed_words(docs, id_col, text_col)
    trusted = small(staged(trusted_ids(labels), "quality_trusted"))
    weight = weights(bucket_counts(hashed, trusted, buckets), buckets)
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stats = (scored(repeated_words(hashed), weight, buckets)
             .withColumn("lines", lines)
             .select("doc_id", F.size("words").cast("long").alias("n_words"),
                     F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                     (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, "")))
                     .cast("long").alias("n_symbols"),
                     (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
                     .alias("n_dup_lines"),
                     "n_repeat_words", "score", "held"))
    stats = staged(stats, "quality_stats")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    least = threshold(stats, trusted, spread)
    if least is not None:
        poor = small(staged(poor_ids(labels), "quality_poor"))
        parted = parting(stats.filter(~failed).select("doc_id", "held"), trusted, poor)
        least = least if parted is None else max(least, parted)
    good = F.lit(True) if least is None else F.coalesce(F.col("score") >= least, F.lit(False))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", failed.alias("base_failed"),
                        (~failed & good).alias("kept"), "score")
