"""Best-fit packing of documents into token sequences by exact-complement hashing.

A document is its token ids and one closing id 0; only documents longer than the
capacity are cut, into capacity-long pieces. How many pieces there are of every
length is a table of at most ``capacity`` counts, whatever the input, and so is
the plan made from it on the driver:

* index of single, pair and triple sums of lengths under their availability
  counts; from the longest length down, a gap is looked up in it and every
  combination that exactly fills the gap is consumed as often as counts allow;
* lengths left without an exact complement go best-fit, longest first, into the
  smallest gap that takes them, also by counts.

A plan row says: of the pieces of one length, those numbered lo..hi-1 stand at one
offset of consecutive sequences. Pieces are numbered within (length, salt), so
that a frequent length is spread over tasks, and the counts of each (length, salt)
give the numbers' offsets.

Defined cases: null or empty text is one id, the closing 0; repeated rows are
pieces of their own; an empty table gives an empty result; extra columns are not
read. Sequence numbers are 0.. in plan order.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paddock.llm._common import id_and_text, staged

CAPACITY = 2048
SALTS = 64
CLOSING_ID = 0
BATCH_CHARS = 6_000_000

PIECE = ("row long, salt int, doc_id long, piece int, start long, length long, ids_crc32 long")


def _pieces(vocabulary: str, capacity: int, with_ids: bool):
    closing = np.uint32(CLOSING_ID).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from paddock.llm.bpe import _spans
        from paddock.llm.word_ids import codec
        own = codec(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            for lo, hi in _spans(texts, BATCH_CHARS):
                out: list[tuple] = []
                for row, doc, enc in zip(rows[lo:hi], ids[lo:hi], own.encode(texts[lo:hi])):
                    enc += closing
                    for piece, at in enumerate(range(0, len(enc), 4 * capacity)):
                        part = enc[at:at + 4 * capacity]
                        out.append((row, (row + piece) % SALTS, doc, piece, at // 4,
                                    len(part) // 4, zlib.crc32(part), part))
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                         pa.int64(), pa.binary())
                names = [x.split()[0] for x in PIECE.split(", ")] + ["ids"]
                use = len(names) if with_ids else len(names) - 1
                yield pa.RecordBatch.from_pydict(
                    {n: pa.array(c, k) for n, c, k in zip(names[:use], cols, kinds)})
        own.forget()
    return run


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; with ``with_ids`` also their ids (binary)."""
    source = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return source.mapInArrow(_pieces(vocabulary, capacity, with_ids),
                             PIECE + (", ids binary" if with_ids else ""))


class Complements:
    """Counts of available lengths with their index of single, pair and triple sums."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def _pair(self, gap: int, less: np.ndarray) -> tuple[int, int] | None:
        """Longest-first a >= b with a + b = gap, both available beside ``less``."""
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        have = self.counts - less
        ok = (have[a] > 0) & (have[gap - a] > 0) & ((a * 2 != gap) | (have[a] > 1))
        hit = int(ok.argmax()) if ok.size else 0
        return (int(a[hit]), gap - int(a[hit])) if ok.size and ok[hit] else None

    def fill(self, length: int, gap: int, most: int) -> tuple[int, ...] | None:
        """One to ``most`` (at most three) lengths that exactly fill ``gap`` beside
        one ``length``."""
        less = np.zeros_like(self.counts)
        less[length] = 1
        if most >= 1 and self.counts[gap] - less[gap] > 0:
            return (gap,)
        pair = self._pair(gap, less) if most >= 2 else None
        if pair or most < 3:
            return pair
        have = self.counts - less
        for a in np.flatnonzero(have[:gap - 1] > 0)[::-1].tolist():
            if 3 * a < gap:
                break
            less[a] += 1
            rest = self._pair(gap - a, less)
            less[a] -= 1
            if rest:
                return (a, *rest)
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many sequences are packed so) for the counts of
    all lengths; every piece is in exactly one. Few pieces can be short of small
    lengths when triples take them early, so the plans with complements of up to
    three, two and one lengths are compared and the shortest is taken."""
    return min((complement_plan(counts, capacity, most) for most in (3, 2, 1)),
               key=lambda p: sum(times for _, times in p))


def complement_plan(counts: dict[int, int], capacity: int,
                    most: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact complements of up to ``most`` lengths, then best-fit for the rest."""
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] += n
    index = Complements(have)
    out: list[tuple[tuple[int, ...], int]] = []
    left: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while have[length]:
            gap = capacity - length
            fill = index.fill(length, gap, most) if gap else ()
            if fill is None:
                left[length] = int(have[length])
                have[length] = 0
                break
            used = (length, *fill)
            times = min(int(have[x]) // used.count(x) for x in set(used))
            for x in used:
                have[x] -= times
            out.append((used, times))
    return out + best_fit(left, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, by counts."""
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        n = counts[length]
        for gap in range(length, capacity + 1):       # the smallest gap that takes it
            while n and gaps.get(gap):
                used, times = gaps[gap].pop()
                each = gap // length                  # the same length fits best again
                full = min(times, n // each)
                if full:
                    gaps[gap - each * length].append(((*used, *[length] * each), full))
                    n -= full * each
                rest = times - full
                if rest and n and n < each:
                    gaps[gap - n * length].append(((*used, *[length] * n), 1))
                    n, rest = 0, rest - 1
                if rest:
                    gaps[gap].append((used, rest))
                    if not full:
                        break
            if not n:
                break
        each = capacity // length
        if n // each:
            gaps[capacity - each * length].append((tuple([length] * each), n // each))
        if n % each:
            gaps[capacity - (n % each) * length].append((tuple([length] * (n % each)), 1))
    return [x for group in gaps.values() for x in group]


def slots(packed: list[tuple[tuple[int, ...], int]], capacity: int) -> np.ndarray:
    """Rows (length, lo, first sequence, offset), ordered by length and lo."""
    rows, taken, sequence = [], defaultdict(int), 0
    for used, times in packed:
        offset = 0
        for length in used:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(piece_table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces."""
    spark = piece_table.sparkSession
    # at most capacity x SALTS rows, whatever the input
    counted = sorted(tuple(r) for r in piece_table.groupBy("length", "salt").count().collect())
    totals: dict[int, int] = defaultdict(int)
    before = []
    for length, salt, n in counted:
        before.append((length, salt, totals[length]))
        totals[length] += n
    table = spark.sparkContext.broadcast(slots(plan(totals, capacity), capacity))
    base = np.zeros((capacity + 1) * SALTS, np.int64)
    for length, salt, n in before:
        base[length * SALTS + salt] = n
    bases = spark.sparkContext.broadcast(base)
    numbered = piece_table.withColumn("number", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("row", "piece")) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, first = table.value, bases.value
        shift = np.int64(1) << 50
        keys = rows[:, 0] * shift + rows[:, 1]
        for b in batches:
            length = b.column("length").to_numpy()
            rank = first[length * SALTS + b.column("salt").to_numpy()] + b.column("number").to_numpy()
            at = np.searchsorted(keys, length * shift + rank, "right") - 1
            cols = {c: b.column(c) for c in b.schema.names if c not in ("row", "salt", "number")}
            cols["sequence_id"] = pa.array(rows[at, 2] + rank - rows[at, 1], pa.int64())
            cols["offset"] = pa.array(rows[at, 3], pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    kept = [f"{c} {t}" for c, t in piece_table.dtypes if c not in ("row", "salt")]
    return (numbered.withColumn("number", F.col("number").cast("long"))
            .mapInArrow(place, ", ".join([*kept, "sequence_id long", "offset long"])
                        .replace("bigint", "long")))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset."""
    return pack(staged(pieces(docs, vocabulary, capacity, id_col, text_col, with_ids), "packing"),
                capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the token sequences of a result with ids; a
    group holds at most ``capacity`` ids."""
    return (packed.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"),
                 F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b"").cast("binary"),
                                lambda acc, p: F.concat(acc, p["ids"])).alias("ids")))
