"""N-gram Jaccard join by a count-vector R-tree.

A document is the set of its distinct ``k``-word shingles. Hashing shingles into
groups makes it a point whose coordinates are the groups' counts; the overlap of two
sets is at most the sum of the coordinates' minima, and the least coordinates' maxima
of an R-tree node bound it for all points below.

1. Equal sets are collapsed to one row.
2. Cells (no link is lost): sets linked at similarity t differ in at most
   D(n) = floor(n (1 - t) / t) shingles, n being either one's size. A
   set's shingles are dealt by hash into P blocks, P a power of two by size class; a
   linked pair agrees in all but D blocks, so by prefix filtering the D+1 first of both
   sets' blocks (larger blocks first, then by content) have one in common. Sets that
   share a block are connected to a hub; components of this graph are the cells.
   Sets near the upper end of their class also enter the next class.
   Blocks that very many sets hold are found by Misra-Gries summaries and connected
   map-side to a broadcast hub instead of being gathered.
3. In each cell, an R-tree over the points is joined with itself: node pairs, then
   pairs of points, are cut by the bound; surviving pairs not yet connected are verified
   on their sets. A cell of more than ``BLOCK`` points is cut into blocks by size and
   hash, and pairs of blocks whose sizes allow a link go to separate tasks.
4. The verified links' components (a spanning forest per task is enough) are the
   result; only edges are ever gathered, in Spark.

Defined cases: null or empty text, and text without a word, has an empty set, which
is linked with nothing (component_id is its doc_id); repeated rows are linked by their
equal sets; a null doc_id is smaller than none: a component of null ids only has a
null id; an empty table gives an empty result; extra columns are not read. Rows are
numbered once, and the numbers stored with what later steps read of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import (
    BROADCAST_ROWS,
    discard,
    fresh,
    id_and_text,
    numbered,
    shuffle_partitions,
    small,
    staged,
)
from paddock.llm.components import components
from paddock.llm.shingles import chunks, lowered, mix, shingle_hashes, words

K = 4
SIMILARITY = Fraction(85, 100)
GROUPS = 256              # coordinates of a point
BLOCK = 1024              # points of a cell that one task indexes
LEAF = 16                 # points of an R-tree leaf, and children of a node
COUNTERS = 1 << 15        # entries of a Misra-Gries summary
PAIRS = 10_000            # pairs verified at once
STEPS = 4                 # by which size codes of linked sets differ at most


class Bounds:
    """The integer arithmetic of a similarity threshold p/q."""

    def __init__(self, similarity: Fraction):
        self.p, self.q = similarity.numerator, similarity.denominator

    def linked(self, common, n, m):
        return self.q * common >= self.p * (n + m - common)

    def least_common(self, n, m):
        """The least overlap of linked sets of these sizes."""
        return -(-self.p * (n + m) // (self.p + self.q))

    def differing(self, n):
        """The most shingles in which a set of size n differs from a linked one."""
        return n * (self.q - self.p) // self.p

    def spare(self) -> int:
        """By how many powers of two a class needs more blocks than n/4, so that sets
        differ in three quarters of the blocks at most."""
        return max(0, (-(-16 * (self.q - self.p) // (3 * self.p)) - 1).bit_length())

    def reaches(self, n: int, m: int) -> bool:
        """Whether a set of size n may be linked with one of size m >= n."""
        return self.q * n >= self.p * m


def size_codes(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Sizes on a scale of logarithms: codes of sets that are linked at ``similarity`` differ
    by ``STEPS`` at most (very large sets share the last code)."""
    step = math.log(1 / similarity) * (1 + 1e-9) / STEPS
    return np.minimum(np.log(np.maximum(sizes, 1)) / step, 255).astype(np.uint8)


def block_keys(shingles: np.ndarray, bounds: Bounds) -> np.ndarray:
    """The cell keys of a set (distinct shingles)."""
    n = len(shingles)
    most = bounds.differing(n)
    if most == 0:
        return np.empty(0, np.uint64)    # linked with equal sets only
    level = (n // 4).bit_length()           # the class of 2**level <= n/2 < 2**(level+1)
    out = []
    for c in (level, level + 1):
        if c > level and not bounds.reaches(n, 4 << level):
            break
        c += bounds.spare()
        blocks = 1 << c
        block = (shingles >> np.uint64(64 - c)).astype(np.int64) if c else np.zeros(n, np.int64)
        size = np.bincount(block, minlength=blocks)
        content = np.zeros(blocks, np.uint64)
        np.add.at(content, block, mix(shingles))
        key = mix(content + np.uint64(0x9E3779B97F4A7C15) * np.arange(1, blocks + 1, dtype=np.uint64)
                  + np.uint64(c << 56))
        order = np.lexsort((key, -size))
        out.append(key[order[:most + 1]])
    return np.concatenate(out)


def point(shingles: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts of the shingles by group (bits that the blocks do not use)."""
    return np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64),
                       minlength=groups).astype(np.int32)


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    raw = [lowered(t) for t in texts]
    for lo, hi in chunks(raw):
        hashes, _, _, first = words(raw[lo:hi])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(shingle_hashes(hashes[a:b], k))


def _signatures(k: int, similarity: Fraction):
    bounds = Bounds(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, marks, keys = [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), k):
                sizes.append(len(s))
                marks.append(np.array([mix(s).sum(), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()])
                             .tobytes() if len(s) else None)
                keys.append(block_keys(s, bounds).tobytes())
            yield pa.RecordBatch.from_pydict(
                {"row": b.column("row"), "doc_id": b.column("doc_id"),
                 "n": pa.array(sizes, pa.int64()), "mark": pa.array(marks, pa.binary()),
                 "keys": pa.array(keys, pa.binary())})
    return run


def _summary(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Misra-Gries: sums by key, less the (k+1)-th largest."""
    keys, back = np.unique(keys, return_inverse=True)
    counts = np.bincount(back, counts, len(keys)).astype(np.int64)
    if len(keys) > k:
        counts = counts - np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _frequent(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, total = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for b in batches:
            new = np.frombuffer(b"".join(b.column("keys").to_pylist()), np.int64)
            total += len(new)
            keys, counts = _summary(np.concatenate((keys, new)),
                                    np.concatenate((counts, np.ones(len(new), np.int64))), k)
        yield pa.RecordBatch.from_pydict({"key": pa.array([None, *keys.tolist()], pa.int64()),
                                          "n": pa.array([total, *counts.tolist()], pa.int64())})
    return run


def frequent_keys(keyed: DataFrame, counters: int = COUNTERS) -> list[int]:
    """At most ``counters`` keys: all that hold over 3/counters of all entries, and none
    seen under 100 times."""
    found = staged(keyed.select("keys").mapInArrow(_frequent(counters), "key long, n long")
                   .groupBy("key").agg(F.sum("n").alias("n")), "ngram_join_frequent")
    total = found.filter("key IS NULL").first()
    least = max(100, (total["n"] if total else 0) // counters)
    rows = (found.filter((F.col("key").isNotNull()) & (F.col("n") >= least))
            .orderBy(F.desc("n"), "key").limit(counters).collect())
    return sorted(r["key"] for r in rows)


def _entries(b: pa.RecordBatch, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, rows and whether the key is frequent, of a batch that holds the packed keys
    of one ``row``, or of the packed ``ids`` beside them (as many keys each), per line."""
    blobs = b.column("keys").to_pylist()
    keys = np.frombuffer(b"".join(blobs), np.uint64)
    if "ids" in b.schema.names:
        rows = np.frombuffer(b"".join(b.column("ids").to_pylist()), np.int64)
        rows = np.repeat(rows, len(keys) // max(1, len(rows)))
    else:
        rows = np.repeat(b.column("row").to_numpy(), [len(x) // 8 for x in blobs])
    if not len(frequent):
        return keys, rows, np.zeros(len(keys), bool)
    signed = keys.view(np.int64)
    at = np.minimum(np.searchsorted(frequent, signed), len(frequent) - 1)
    return keys, rows, frequent[at] == signed


def _dealt(n_buckets: int, frequent: np.ndarray):
    """Packs the entries of other than frequent keys by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows, hot = _entries(b, frequent)
            sizes = None
            if "sizes" in b.schema.names:
                sizes = np.frombuffer(b"".join(b.column("sizes").to_pylist()), np.uint8)
                sizes = np.repeat(sizes, len(keys) // max(1, len(sizes)))[~hot]
            keys, rows = keys[~hot], rows[~hot]
            bucket = (keys >> np.uint64(32)).astype(np.int64) % n_buckets
            order = np.argsort(bucket, kind="stable")
            keys, rows, bucket = keys[order].astype(np.uint32), rows[order], bucket[order]
            sizes = b"" if sizes is None else sizes[order].tobytes()
            used, first = np.unique(bucket, return_index=True)
            edges = [*first.tolist(), len(bucket)]
            parts = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(used, pa.int64()),
                 "keys": pa.array([keys[i:j].tobytes() for i, j in parts], pa.binary()),
                 "rows": pa.array([rows[i:j].tobytes() for i, j in parts], pa.binary()),
                 "sizes": pa.array([sizes[i:j] for i, j in parts], pa.binary())})
    return run


def _hot(frequent: np.ndarray):
    """Packs the entries of frequent keys by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows, hot = _entries(b, frequent)
            if hot.any():
                yield pa.RecordBatch.from_pydict({"keys": pa.array([keys[hot].tobytes()], pa.binary()),
                                                  "rows": pa.array([rows[hot].tobytes()], pa.binary())})
    return run


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(b.column(c).to_pylist()), np.int64) for c in ("keys", "rows"))


def _least_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, hub): every frequent key's least row in each batch."""
    for b in batches:
        keys, rows = _unpacked(b)
        order = np.lexsort((rows, keys))
        own, first = np.unique(keys[order], return_index=True)
        yield pa.RecordBatch.from_pydict({"key": pa.array(own, pa.int64()),
                                          "hub": pa.array(rows[order][first], pa.int64())})


def _hub_edges(hubs):
    """Edges that connect each row with the hubs of its frequent keys: the row with the
    least of them, and that one with the others, each once in a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hub = hubs.value
        for b in batches:
            keys, rows = _unpacked(b)
            own = hub[np.searchsorted(known, keys)]
            order = np.lexsort((own, rows))
            rows, own = rows[order], own[order]
            first = np.concatenate(([True], rows[1:] != rows[:-1]))
            least = own[np.flatnonzero(first)][np.cumsum(first) - 1]
            edges = np.unique(np.concatenate((np.stack((rows[first], own[first]), axis=1),
                                              np.stack((own, least), axis=1))), axis=0)
            edges = edges[edges[:, 0] != edges[:, 1]]
            yield pa.RecordBatch.from_pydict({"u": pa.array(edges[:, 0], pa.int64()),
                                              "v": pa.array(edges[:, 1], pa.int64())})
    return run


def _stars(table: pa.Table) -> pa.Table:
    """Edges (u, v) from each row of a bucket to one row with the same key, if sizes are
    given one that no gap in size divides it from that links cannot cross. Two keys of a
    bucket may agree in their lower half: cells then grow, no more."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint32)
    rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), np.int64)
    sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), np.uint8)
    order = np.lexsort((rows, sizes, keys) if len(sizes) else (rows, keys))
    keys, rows = keys[order], rows[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.empty(0, bool)
    if len(sizes):
        new[1:] |= np.diff(sizes[order].astype(np.int16)) > STEPS
    hub = rows[np.flatnonzero(new)][np.cumsum(new) - 1] if len(keys) else rows
    edges = np.unique(np.stack((rows, hub), axis=1)[rows != hub], axis=0)
    return pa.table({"u": pa.array(edges[:, 0], pa.int64()), "v": pa.array(edges[:, 1], pa.int64())})


def cells(keyed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(node, root): rows that share keys, directly or by others; ``keyed`` has (row,
    keys) or (ids, keys), and may have ``sizes``, the packed size codes of the ids: rows of
    one key are then connected only if links could lead from size to size between them
    (rows of frequent keys in any case)."""
    spark = keyed.sparkSession
    frequent = np.array(frequent_keys(keyed, counters), np.int64)
    own = keyed.select("ids" if "ids" in keyed.columns else "row", "keys",
                       *[c for c in keyed.columns if c == "sizes"])
    edges = (own.mapInArrow(_dealt(shuffle_partitions(spark), frequent),
                            "bucket long, keys binary, rows binary, sizes binary")
             .groupBy("bucket").applyInArrow(_stars, "u long, v long"))
    if len(frequent):
        hot = staged(own.mapInArrow(_hot(frequent), "keys binary, rows binary"), "ngram_join_frequent")
        # at most ``counters`` rows
        hubs = sorted((r["key"], r["hub"]) for r in hot.mapInArrow(_least_rows, "key long, hub long")
                      .groupBy("key").agg(F.min("hub").alias("hub")).collect())
        shipped = spark.sparkContext.broadcast(tuple(np.array(hubs, np.int64).reshape(-1, 2).T.copy()))
        edges = edges.unionByName(hot.mapInArrow(_hub_edges(shipped), "u long, v long"))
    return components(staged(edges, "ngram_join_edges"), "ngram_join_cells")


class RTree:
    """Points packed into nodes of ``LEAF``, level by level, along the coordinates of
    widest spread; a node keeps its points' coordinate maxima and least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = self._packed(points, np.arange(len(points)))
        high, low = points[self.order], sizes[self.order]
        self.levels = []
        while len(high) > 1:
            cut = np.arange(0, len(high), LEAF)
            high, low = np.maximum.reduceat(high, cut), np.minimum.reduceat(low, cut)
            self.levels.append((high, low))

    def _packed(self, points: np.ndarray, index: np.ndarray) -> np.ndarray:
        if len(index) <= LEAF:
            return index
        own = points[index]
        axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
        by = index[np.argsort(own[:, axis], kind="stable")]
        half = -(-len(by) // (2 * LEAF)) * LEAF
        return np.concatenate((self._packed(points, by[:half]), self._packed(points, by[half:])))

    def candidates(self, p: np.ndarray, n: int, bounds: Bounds) -> np.ndarray:
        """Points of leaves that no bound excludes, as places in the tree's order."""
        at = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low = self.levels[depth]
            at = at[at < len(high)]
            most = np.minimum(high[at], p).sum(axis=1, dtype=np.int64)
            at = at[most >= bounds.least_common(n, low[at])]
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
        return at[at < len(self.order)]


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def common(a: np.ndarray, b: np.ndarray) -> int:
    """The overlap of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def forest_links(points: np.ndarray, sets: list[np.ndarray], side: np.ndarray,
                 bounds: Bounds) -> list[tuple[int, int]]:
    """A spanning forest of the links among the points of one block (``side`` all 0), or
    between two blocks (0 and 1)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    two = bool(side.any())
    indexed = np.flatnonzero(side == 1) if two else np.arange(len(sets))
    tree = RTree(points[indexed], sizes[indexed])
    place = indexed[tree.order]
    pts, own_sizes = points[place], sizes[place]
    forest, links = Forest(len(sets)), []
    for i in (np.flatnonzero(side == 0) if two else indexed).tolist():
        n = int(sizes[i])
        at = tree.candidates(points[i], n, bounds)
        if not two:
            at = at[place[at] > i]
        need = bounds.least_common(n, own_sizes[at])
        most = np.minimum(pts[at], points[i]).sum(axis=1, dtype=np.int64)
        at = at[(most >= need) & (np.minimum(own_sizes[at], n) >= need)]
        for j in place[at].tolist():
            if forest.find(i) != forest.find(j):
                if bounds.linked(common(sets[i], sets[j]), n, int(sizes[j])):
                    forest.join(i, j)
                    links.append((i, j))
    return links


def pair_links(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray,
               bounds: Bounds) -> np.ndarray:
    """Which of the pairs (i, j) of sets are linked."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    pair = np.repeat(np.arange(len(i)), sizes[i] + sizes[j])
    both = np.stack((i, j), axis=1).ravel()
    start, size = (np.cumsum(sizes) - sizes)[both], sizes[both]
    held = flat[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]
    order = np.lexsort((held, pair))
    held, pair = held[order], pair[order]
    twice = (held[1:] == held[:-1]) & (pair[1:] == pair[:-1])
    found = np.bincount(pair[1:][twice], minlength=len(i))
    return bounds.linked(found, sizes[i], sizes[j])


def _verified(similarity: Fraction, direct: int):
    bounds = Bounds(similarity)

    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell").to_numpy()
        pair = table.column("pair").to_numpy()
        rows = table.column("row").to_numpy()
        side = table.column("side").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        order = np.lexsort((rows, side, pair, cell))
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(cell[order]) != 0)
                                             | (np.diff(pair[order]) != 0)))).tolist()
        u, v = [], []
        edge = np.array([*cut, len(order)])
        size = np.diff(edge)
        for n in range(2, direct + 1):     # all pairs of cells this small at once
            own = order[edge[:-1][size == n][:, None] + np.arange(n)]
            i, j = (own[:, x].ravel() for x in np.triu_indices(n, 1))
            use = (side[i] != side[j]) | (side[own].max(axis=1) == 0).repeat(n * (n - 1) // 2)
            for lo in range(0, len(i), PAIRS):
                x, y = i[use][lo:lo + PAIRS], j[use][lo:lo + PAIRS]
                if len(x):
                    linked = pair_links(sets, x, y, bounds)
                    u += rows[x[linked]].tolist()
                    v += rows[y[linked]].tolist()
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            own = order[a:b]
            if b - a < 2 or b - a <= direct:
                continue
            mine = [sets[i] for i in own.tolist()]
            found = forest_links(np.stack([point(s) for s in mine]), mine, side[own], bounds)
            u += [int(rows[own[i]]) for i, _ in found]
            v += [int(rows[own[j]]) for _, j in found]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def _with_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for s in shingle_sets(b.column("text").to_pylist(), k)]
            cols = {c: b.column(c) for c in b.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict(cols | {"shingles": pa.array(sets, pa.binary())})
    return run


def blocked(members: DataFrame, similarity: Fraction, block: int = BLOCK) -> DataFrame:
    """(cell, row, n) -> (cell, pair, side, row): the tasks in which a member meets the
    others. A small cell is one task. A large one is cut by size into bands such that
    links stay in a band or cross to the next, and each band by hash into blocks; any
    two blocks that links may cross are one task."""
    members = staged(members, "ngram_join_members")
    big = staged(members.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
                 .filter(F.col("size") > block).select("cell"), "ngram_join_big")
    small = (members.join(big, "cell", "left_anti")
             .select("cell", F.lit(0).cast("long").alias("pair"), F.lit(0).alias("side"), "row"))
    ratio = float(similarity)
    large = staged(members.join(big, "cell")
                   .withColumn("band", F.floor(F.log("n") / (math.log(1 / ratio) * (1 + 1e-9)))),
                   "ngram_join_large")
    bands = (large.groupBy("cell", "band").agg(F.count(F.lit(1)).alias("held"))
             .withColumn("blocks", F.ceil(F.col("held") / block)))
    around = bands.select("cell", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = bands.select("cell", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    dealt = (large.join(bands, ["cell", "band"]).join(around, ["cell", "band"], "left")
             .join(below, ["cell", "band"], "left")
             .withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("long")))
    none = F.array().cast("array<struct<band:bigint,i:bigint,j:bigint,side:int>>")

    def meet(count, make):
        return F.when(F.coalesce(count, F.lit(0)) > 0, F.transform(
            F.sequence(F.lit(0).cast("long"), (F.coalesce(count, F.lit(1)) - 1).cast("long")), make)
        ).otherwise(none)

    def task(band, i, j, side):
        return F.struct(band.cast("long").alias("band"), i.cast("long").alias("i"),
                        j.cast("long").alias("j"), side.cast("int").alias("side"))

    band, own = F.col("band"), F.col("own")
    tasks = F.concat(
        # the own band's blocks: (i, j) with i <= j
        meet(F.col("blocks"), lambda x: task(2 * band, F.least(own, x), F.greatest(own, x),
                                             F.when(x < own, 1).otherwise(0))),
        meet(F.col("above"), lambda x: task(2 * band + 1, own, x, F.lit(0))),
        meet(F.col("below"), lambda x: task(2 * band - 1, x, own, F.lit(1))))
    spread = (dealt.select("cell", "row", F.explode(tasks).alias("t"))
              .select("cell", F.xxhash64("t.band", "t.i", "t.j").alias("pair"),
                      F.col("t.side").alias("side"), "row"))
    return small.unionByName(spread)


def text_sets(rows: DataFrame, tasks: DataFrame, k: int, most: int | None = None
              ) -> tuple[DataFrame, list[DataFrame]]:
    """(row, shingles, tasks: array of cell, pair, side) of every row of the stored ``tasks``,
    and the stored tables that it reads. ``rows`` (row, text) is a stored table in order of its
    numbers, and its texts stay in place: the tasks are broadcast, beyond ``most`` of them in
    parts by ranges of row numbers, of which each reads the files with its own rows. The sets
    of the parts are stored, each once however many tasks it has."""
    most = BROADCAST_ROWS if most is None else most
    packed = staged(tasks.groupBy("row").agg(F.collect_list(F.struct("cell", "pair", "side")).alias("tasks")),
                    "ngram_join_packed")
    held = F.col("row")

    def made(within) -> DataFrame:
        return (rows.select("row", "text").filter(within)
                .join(F.broadcast(packed.filter(within)), "row")
                .mapInArrow(_with_sets(k), "row long, tasks array<struct<cell:bigint,pair:bigint,side:int>>,"
                                           " shingles binary"))

    parts = -(-tasks.count() // most)
    if parts <= 1:
        return made(F.lit(True)), [packed]
    cuts = tasks.approxQuantile("row", [i / parts for i in range(1, parts)], 0.1 / parts)
    cuts = sorted({int(c) for c in cuts})
    within = ([held <= cuts[0]] + [(held > a) & (held <= b) for a, b in zip(cuts, cuts[1:])]
              + [held > cuts[-1]])
    stored = [staged(made(w), "ngram_join_sets") for w in within]
    discard(packed)
    return reduce(DataFrame.unionByName, stored), stored


def cell_links(members: DataFrame, sets: DataFrame, similarity: Fraction = SIMILARITY,
               block: int = BLOCK, *, direct: int = 0, k: int | None = None) -> DataFrame:
    """(u, v): verified links within cells, enough to connect all that links connect.
    ``members``: (cell, row, n); ``sets``: (row, shingles: packed sorted hashes), or with ``k``
    (row, text), a stored table, and then the result is stored, in as many passes over the
    tasks as a row has tasks on average: no more is shuffled at once than every set one time.
    In cells of up to ``direct`` rows all pairs are verified, without a tree."""
    n = shuffle_partitions(members.sparkSession)
    tasks = staged(blocked(members, similarity, block), "ngram_join_tasks")

    def verified(dealt: DataFrame) -> DataFrame:
        return (dealt.withColumn("bucket", F.pmod(F.xxhash64("cell", "pair"), F.lit(8 * n)))
                .groupBy("bucket").applyInArrow(_verified(similarity, direct), "u long, v long"))

    if k is None:
        return verified(sets.join(small(tasks), "row"))
    dealt, held = tasks.agg(F.count(F.lit(1)), F.countDistinct("row")).first()
    passes = -(-dealt // max(1, held))
    made, read = text_sets(sets, tasks, k)
    if passes > 1 and len(read) == 1:
        made = staged(made, "ngram_join_sets")
        read.append(made)
    spread = (made.select("row", "shingles", F.explode("tasks").alias("t"))
              .select("row", "shingles", "t.cell", "t.pair", "t.side"))
    turn = F.pmod(F.xxhash64("pair", "cell"), F.lit(max(1, passes)))
    found = [staged(verified(spread.filter(turn == p)), "ngram_join_links") for p in range(max(1, passes))]
    discard(*read)
    return reduce(DataFrame.unionByName, found)


def links(rows: DataFrame, keyed: DataFrame, k: int = K,
          similarity: Fraction = SIMILARITY) -> DataFrame:
    """Links between ``rows`` (row, text: a stored table), stored; ``keyed`` (row, n, keys) reads
    a stored table that nothing else reads; it is deleted before the sets are made."""
    sized = cells(keyed).join(keyed.select(F.col("row").alias("node"), "n"), "node")
    members = staged(sized.select(F.col("root").alias("cell"), F.col("node").alias("row"), "n"),
                     "ngram_join_members")
    discard(keyed)
    return cell_links(members, rows, similarity, k=k)


def signatures(docs: DataFrame, k: int = K, similarity: Fraction = SIMILARITY,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, n, mark (of the set; null if empty), keys (packed) of every row."""
    return row_signatures(numbered(id_and_text(docs, id_col, text_col), "ngram_join_rows"),
                          k, similarity)


def row_signatures(rows: DataFrame, k: int, similarity: Fraction) -> DataFrame:
    """``signatures`` of (row, doc_id, text), a stored table."""
    return staged(rows.mapInArrow(_signatures(k, similarity),
                                    "row long, doc_id long, n long, mark binary, keys binary"),
                  "ngram_join_signatures")


def classes(docs: DataFrame, k: int = K, similarity: Fraction = SIMILARITY,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_shingles, component_id."""
    return row_classes(numbered(id_and_text(docs, id_col, text_col), "ngram_join_rows"),
                       k, similarity)


def row_classes(rows: DataFrame, k: int, similarity: Fraction) -> DataFrame:
    """``classes`` of (row, doc_id, text), a stored table."""
    signed = row_signatures(rows, k, similarity)
    equal = staged(signed.filter("mark IS NOT NULL").groupBy("mark", "n")
                   .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("held"),
                        F.min("doc_id").alias("least")), "ngram_join_equal")
    # rows beside the first of their equal sets: a narrow table
    again = (signed.filter("mark IS NOT NULL").select("row", "mark", "n")
             .join(equal.filter("held > 1").select("mark", "n", "first"), ["mark", "n"])
             .filter("row <> first").select("row", "first"))
    again = staged(again, "ngram_join_copies")
    # the keys are read where they were stored, the other columns go on in a narrow table
    keyed = (signed.filter("length(keys) > 0").select("row", "n", "keys")
             .join(small(again.select("row")), "row", "left_anti"))
    keyed._stored_at = signed._stored_at
    signed = staged(signed.select("row", "doc_id", "n"), "ngram_join_sizes")
    found = links(rows, keyed, k, similarity)
    roots = staged(components(found, "ngram_join_components"), "ngram_join_roots")
    # the least doc_id of every component, over its distinct sets
    firsts = equal.select(F.col("first").alias("node"), "least").join(roots, "node")
    least = firsts.groupBy("root").agg(F.min("least").alias("component"))
    labels = roots.join(least, "root").select(F.col("node").alias("first"), "component")
    named = (signed.select("row", "doc_id", "n").join(again, "row", "left")
             .withColumn("first", F.coalesce("first", "row")))
    own = equal.select("first", "least")
    return (named.join(own, "first", "left").join(labels, "first", "left")
            .select("row", "doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "least", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, k: int = K, similarity: Fraction = SIMILARITY,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when of every component only the smallest doc_id
    does (of repeated rows the first), with all their columns; empty sets all stay."""
    row = fresh(docs, "row")
    rows = numbered(docs, "ngram_join_rows", row)
    found = staged(row_classes(id_and_text(rows, id_col, text_col, row), k, similarity),
                   "ngram_join_classes")
    linked = found.filter("n_shingles > 0")
    first = (linked.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("held")).filter("held > 1")
        .select("component_id", F.col("first.row").alias("first")))
    gone = staged(linked.join(first, "component_id").filter("row <> first")
                  .select(F.col("row").alias(row)), "ngram_join_gone")
    return rows.join(small(gone), row, "left_anti").select(*[f"`{c}`" for c in docs.columns])
