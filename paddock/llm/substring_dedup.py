"""Substring deduplication by paragraph MinHash banding.

A text is cut into units: at line breaks, after sentence ends (a word that ends in
one . ! or ?) and around runs of one word, so that a passage copied into the middle of other
text shares whole units with its other places. Units of ``k`` words or more, and
paragraphs (lines of several units), are compared:

1. every unit's word shingles give a mark (equal units, equal marks) and ``bands`` band
   keys of ``rows`` MinHash values each, tuned for recall at the similarity;
2. units of different marks that collide in a band form cells, in which the exact
   Jaccard similarity of shingle sets is verified (the join of ``ngram_join``). Those of a
   key whose numbers of distinct shingles rule every link out, such as a paragraph and one
   of its sentences, are kept apart before any set is made;
3. components of the verified links are classes; a class found in two documents or more
   is repeated, and all but its first occurrence (by doc_id, then place) are removals;
4. every window of ``min_words`` words, wherever sentences end, that is found in two
   documents or more is repeated as well: an exact match thus reaches word by word as
   far as it goes. Windows are compared only where the least hash of their shorter windows
   (``least_seeds``) is found in two documents, which loses none. Neighbours of one seed
   travel together as a segment; only where a seed's segments differ (at the ends of
   matches) are their windows compared one by one. All of a seed is dealt to one bucket,
   once for each batch that holds a segment;
5. repeated spans of a document that touch (units shorter than ``k`` between repeated
   units included) form a passage; passages of at least ``min_words`` words count, so that
   stock phrases and licence lines stay.

Marks have 64 bits: of u distinct units about u*u / 2**65 pairs are taken for equal
that are not.

Defined cases: null or empty text has no unit; a null doc_id comes after all others as
first occurrence; repeated rows repeat their passages; repeats within one document
alone are no removals; an empty table gives an empty result; extra columns are not
read by ``passages`` and kept by ``remove_passages``. Rows are numbered once, and the
numbers stored with what later steps read of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import discard, fresh, id_and_text, numbered, shuffle_partitions, staged
from paddock.llm.components import components
from paddock.llm.ngram_join import cell_links, cells, size_codes
from paddock.llm.shingles import _PLACE, _powers, chunks, lowered, mix, shingle_hashes, words

K = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.98
MAX_BANDS = 6
MIN_WORDS = 30
LEAST_NEAR = 4     # shingles; smaller sets at 0.8 or more are equal
NO_ID = np.iinfo(np.int64).min
DIRECT = 4         # units of a cell whose pairs are all verified, at most
SEGMENT = 64       # windows of a segment at most: a long marks those that repeat

_SEED = np.random.default_rng(20_240_301)
_FACTOR = _SEED.integers(1, 2**64, 64, np.uint64) | np.uint64(1)
_SHIFT = _SEED.integers(1, 2**64, 64, np.uint64)


def tuned(similarity: float, recall: float = RECALL, max_bands: int = MAX_BANDS) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence fewest chance collisions, for which
    ``max_bands`` bands still reach ``recall`` at ``similarity``."""
    best = (max_bands, 1)
    for rows in range(1, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))
        if bands <= max_bands:
            best = (bands, rows)
    return best


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (``size`` numbers) of every range."""
    size = size.astype(np.int64)
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


class Cut:
    """What the units and paragraphs of several texts share: words, their shingles, and the
    words that end a line and a unit."""

    def __init__(self, texts: list[bytes], k: int):
        self.hashes, self.start, self.end, self.first = words(texts)
        n = len(self.hashes)
        raw = b"\n".join(texts) + b"\n"
        joined = np.frombuffer(raw, np.uint8)
        base = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.text = text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        lo, hi = self.start + base[text], self.end + base[text]
        if not raw.isascii():    # bytes to code points
            chars = np.concatenate(([0], np.cumsum((joined & 0xC0) != 0x80)))
            origin = chars[base[text]]
            self.start, self.end = chars[lo] - origin, chars[hi] - origin
        stop = np.zeros(256, bool)
        stop[[0x2E, 0x21, 0x3F]] = True
        self.last = last = stop[joined[hi - 1]] & ~stop[joined[np.maximum(hi - 2, 0)]]
        # the last word before every line feed
        self.line = line = np.zeros(n, bool)
        ends = np.searchsorted(lo, np.flatnonzero(joined == 10))
        line[ends[ends > 0] - 1] = True
        if n:
            last |= line
            # a run of one word, however long, is a unit
            opens = _groups(self.hashes, text)
            run = np.diff(np.append(opens, n))
            last[np.repeat(run >= k, run)] = False
            last[opens[(run >= k) & (opens > 0)] - 1] = True
            last[(opens + run - 1)[run >= k]] = True
        self.shingles = shingle_hashes(self.hashes, k)


class Units:
    """The units of several texts: arrays over units of ``k`` words or more; with ``lines``
    the paragraphs instead, lines that several units begin in."""

    def __init__(self, texts: list[bytes], k: int, lines: bool = False, cut: Cut | None = None):
        cut = cut or Cut(texts, k)
        close = np.flatnonzero(cut.line if lines else cut.last)
        open_ = np.concatenate(([0], close[:-1] + 1)) if len(close) else close
        size = close - open_ + 1
        strong = size >= k
        if lines:
            ends = np.concatenate(([0], np.cumsum(cut.last)))
            strong &= ends[close] > ends[open_]
        open_, close, size = open_[strong], close[strong], size[strong]
        self.text = cut.text[open_]
        self.hashes, self.first = cut.hashes, cut.first
        self.start, self.end = cut.start[open_], cut.end[close]
        self.word, self.n_words = open_ - cut.first[self.text], size
        # the shingles of all units, one unit after another
        per = size - k + 1
        self.shingles = cut.shingles[_ranges(open_, per)]
        self.edge = np.concatenate(([0], np.cumsum(per)))
        self.marks = (mix(np.add.reduceat(mix(self.shingles), self.edge[:-1])
                          + size.astype(np.uint64)) if len(size) else np.empty(0, np.uint64))

    def sizes(self) -> np.ndarray:
        """Distinct shingles of every unit."""
        out = np.diff(self.edge)
        bits = np.uint64(max(1, len(out).bit_length()))
        unit = np.repeat(np.arange(len(out), dtype=np.uint64), out)
        near = np.sort((unit << (np.uint64(64) - bits)) | (self.shingles >> bits))
        # only units with two shingles that agree in their upper bits may repeat one
        for u in np.unique(near[1:][near[1:] == near[:-1]] >> (np.uint64(64) - bits)).tolist():
            out[u] = len(np.unique(self.shingles[self.edge[u]:self.edge[u + 1]]))
        return out

    def keys(self, bands: int, rows: int) -> np.ndarray:
        """(unit, band) keys."""
        out = np.empty((len(self.marks), bands), np.uint64)
        for b in range(bands if len(self.marks) else 0):
            key = np.full(len(self.marks), np.uint64(b))
            for r in range(b * rows, (b + 1) * rows):
                key = mix(key + np.minimum.reduceat(self.shingles * _FACTOR[r] + _SHIFT[r],
                                                    self.edge[:-1]))
            out[:, b] = key
        return out


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row."""
    size = len(hashes)
    power, inverse = _powers(1 << max(12, size.bit_length()))
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(hashes * power[:size], out=total[1:])
    return mix((total[n:] - total[:-n]) * inverse[:size - n + 1]) if size >= n else total[:0]


def least_seeds(hashes: np.ndarray, min_words: int) -> np.ndarray:
    """For every window of ``min_words`` words of a text the least hash of the shorter
    windows in it (winnowing): equal windows have equal seeds, and neighbours mostly
    share theirs."""
    if len(hashes) < min_words:
        return np.empty(0, np.uint64)
    short = max(1, min_words // 3)
    least, wide, width = windows(hashes, short), 1, min_words - short + 1
    while wide < width:       # minima of 1, 2, 4, ... neighbours, and of the width at last
        more = min(wide, width - wide)
        least, wide = np.minimum(least[:-more], least[more:]), wide + more
    return least


def window_seeds(hashes: np.ndarray, first: np.ndarray, min_words: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, text, seed) of every window within one text of several, in order."""
    per = np.maximum(np.diff(first) - min_words + 1, 0)
    at = _ranges(first[:-1], per)
    return at, np.repeat(np.arange(len(per)), per), least_seeds(hashes, min_words)[at]


def distinct_seeds(text: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, seed) of windows in order, each pair once, sorted."""
    opens = _groups(text, seeds)
    text, seeds = text[opens], seeds[opens]
    order = np.lexsort((seeds, text))
    opens = _groups(text[order], seeds[order])
    return text[order][opens], seeds[order][opens]


def wanted_windows(text: np.ndarray, seeds: np.ndarray, edge: np.ndarray,
                   wanted: np.ndarray) -> np.ndarray:
    """Which windows have a seed that is wanted in their text; ``wanted`` holds those of one
    text after another."""
    known = np.unique(wanted)
    if not len(known) or not len(seeds):
        return np.zeros(len(seeds), bool)
    opens = _groups(text, seeds)
    place = np.searchsorted(known, seeds[opens])
    place[place == len(known)] = 0
    pairs = (np.repeat(np.arange(len(edge) - 1), np.diff(edge)) * len(known)
             + np.searchsorted(known, wanted))
    use = (known[place] == seeds[opens]) & np.isin(text[opens] * len(known) + place, pairs)
    return np.repeat(use, np.diff(np.append(opens, len(seeds))))


def segments(marks: np.ndarray, seeds: np.ndarray, wanted: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bool]]:
    """The segments of a text, windows in a row that share a seed in ``wanted``: (first
    window, windows, mark) of each and whether its windows are all different. Segments of
    equal windows have equal marks."""
    at = np.flatnonzero(np.isin(seeds, wanted))
    return _segments(at, marks[at], seeds[at], np.zeros(len(at), np.int64))


def _segments(at: np.ndarray, marks: np.ndarray, seeds: np.ndarray, text: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bool]]:
    """``segments`` of the wanted windows ``at`` of several texts."""
    if not len(at):
        return at, at, marks[:0], []
    opens = _groups(at - np.arange(len(at)), seeds, text)
    offset = np.arange(len(at)) - np.repeat(opens, np.diff(np.append(opens, len(at))))
    opens = np.flatnonzero(offset % SEGMENT == 0)
    size = np.diff(np.append(opens, len(at)))
    power, _ = _powers(1 << 12)
    mark = mix(np.add.reduceat(mix(marks) * power[offset % SEGMENT], opens)
               + size.astype(np.uint64))
    # windows that a segment repeats are next to each other in this order
    number = np.repeat(np.arange(len(opens)), size)
    order = np.lexsort((marks, number))
    twin = (np.diff(marks[order]) == 0) & (np.diff(number[order]) == 0)
    plain = np.ones(len(opens), bool)
    plain[number[order][1:][twin]] = False
    return at[opens], size, mark, plain.tolist()


UNITS = ("row long, doc_id long, level int, marks binary, spans binary, ids binary, keys binary, "
         "sizes binary, seeds array<long>")
SETS = "mark long, n long, shingles binary"
PLACES = ("row long, doc_id long, seed array<long>, segment array<long>, word array<int>, "
          "size array<int>, plain array<boolean>, windows binary, gaps binary, "
          "lengths binary")
EACH = "row long, doc_id long, level int, i int, mark long, span long, words long"
PASSAGE = ("row long, doc_id long, start long, end long, n_words long, n_units long, "
           "removed boolean, first_doc_id long")


_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(schema: str, **cols) -> pa.RecordBatch:
    """A batch of ``schema``; columns that are not given are null."""
    size = len(next(iter(cols.values()))) if cols else 0
    out = {}
    for name, kind in (x.split() for x in schema.split(", ")):
        own = (pa.list_(_KINDS[kind[6:-1]]) if kind.startswith("array<") else _KINDS[kind])
        col = cols.get(name, [None] * size)
        out[name] = col.cast(own) if isinstance(col, pa.Array) else pa.array(col, own)
    return pa.RecordBatch.from_pydict(out)


def _lists(values: np.ndarray, edge: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values, kind))


def _blobs(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """The bytes of values[edge[i]:edge[i + 1]], for every i."""
    values = np.ascontiguousarray(values)
    step = values.itemsize * int(np.prod(values.shape[1:]))
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [
        None, pa.py_buffer((edge * step).astype(np.int32)), pa.py_buffer(values)])


def _narrow(values: np.ndarray) -> bytes:
    """Small numbers (0 or more) as bytes: their width first, then each in that many bytes."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _widened(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def _cut(k: int, similarity: float, min_words: int):
    bands, rows = tuned(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [lowered(t) for t in b.column("text").to_pylist()]
            for lo, hi in chunks(texts):
                cut = Cut(texts[lo:hi], k)
                _, at, seeds = window_seeds(cut.hashes, cut.first, min_words)
                at, seeds = distinct_seeds(at, seeds)
                for level in (0, 1):
                    u = Units(texts[lo:hi], k, bool(level), cut)
                    edge = np.searchsorted(u.text, np.arange(hi - lo + 1))
                    near = np.diff(u.edge) >= LEAST_NEAR
                    banded = np.concatenate(([0], np.cumsum(near)))[edge]
                    spans = np.stack((u.start, u.end, u.word, u.n_words), axis=1).astype(np.int32)
                    held = np.searchsorted(at, np.arange(hi - lo + 1)) * (level == 0)
                    yield pa.RecordBatch.from_pydict({
                        "row": b.column("row").slice(lo, hi - lo),
                        "doc_id": b.column("doc_id").slice(lo, hi - lo),
                        "level": pa.array([level] * (hi - lo), pa.int32()),
                        "marks": _blobs(u.marks, edge), "spans": _blobs(spans, edge),
                        "ids": _blobs(u.marks[near], banded),
                        "keys": _blobs(u.keys(bands, rows)[near], banded),
                        "sizes": _blobs(size_codes(u.sizes(), similarity)[near], banded),
                        "seeds": _lists(seeds.view(np.int64)[:held[-1]], held, pa.int64())})
    return run


FIRST = np.dtype([("mark", "<i8"), ("last", "?"), ("doc_id", "<i8"), ("row", "<i8"),
                  ("word", "<i4"), ("n_words", "<i4"), ("low", "<i8"), ("high", "<i8")])
SEGMENTS = np.dtype([("seed", "<i8"), *((n, FIRST[n]) for n in FIRST.names), ("plain", "?"),
                     ("at", "<i8")])
FIRSTS = "mark long, doc_id long, row long, word int, n_words int, low long, high long"
OWNERS = "mark long, mask long, owner long, own long, at int"


def _entries(kind: np.dtype, b: pa.RecordBatch, size: np.ndarray, **cols) -> np.ndarray:
    """``cols`` of the things in the rows of ``b``, ``size`` of each, as array of ``kind``."""
    out = np.zeros(int(size.sum()), kind)
    ids = b.column("doc_id")
    out["last"] = np.repeat(ids.is_null().to_numpy(zero_copy_only=False), size)
    out["doc_id"] = np.repeat(ids.fill_null(0).to_numpy(), size)
    out["row"] = out["low"] = out["high"] = np.repeat(b.column("row").to_numpy(), size)
    for name, col in cols.items():
        out[name] = col
    return out


def _combined(entries: np.ndarray) -> np.ndarray:
    """Of all entries of a mark the first (by doc_id, nulls last, row and place), with the
    least and the largest row of all."""
    if not len(entries):
        return entries
    entries = entries[np.lexsort([entries[c] for c in ("n_words", "word", "row", "doc_id", "last",
                                                       "mark")])]
    opens = _groups(entries["mark"])
    out = entries[opens]
    out["low"] = np.minimum.reduceat(entries["low"], opens)
    out["high"] = np.maximum.reduceat(entries["high"], opens)
    return out


def _by_bucket(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of the keys of every bucket."""
    bucket = (mix(key.view(np.uint64)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    opens = _groups(bucket[order])
    for own in np.split(order, opens[1:]) if len(order) else ():
        yield int(bucket[own[0]]), own


def _nullable(values: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values), pa.int64(), mask=np.ascontiguousarray(null))


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units of every row, marks, spans: start, end, word, n_words) of a batch of units."""
    blobs = b.column("marks").to_pylist()
    return (np.array([len(x) // 8 for x in blobs], np.int64), np.frombuffer(b"".join(blobs), np.int64),
            np.frombuffer(b"".join(b.column("spans").to_pylist()), np.int32).reshape(-1, 4))


def _unit_firsts(n: int):
    """The entries of a batch's units, one for every mark, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            per, mark, spans = _unpacked(b)
            found = _combined(_entries(FIRST, b, per, mark=mark, word=spans[:, 2],
                                       n_words=spans[:, 3]))
            parts = list(_by_bucket(np.ascontiguousarray(found["mark"]), n))
            yield _batch("bucket long, entries binary", bucket=[x for x, _ in parts],
                         entries=[found[own].tobytes() for _, own in parts])
    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every unit; two words a span travel by mark, not four."""
    for b in batches:
        per, mark, spans = _unpacked(b)
        row = pa.array(np.repeat(np.arange(len(per)), per))
        pairs = np.ascontiguousarray(spans[:, [1, 0, 3, 2]]).view(np.int64)
        yield _batch(EACH, **{c: b.column(c).take(row) for c in ("row", "doc_id", "level")},
                     i=_ranges(np.zeros(len(per), np.int64), per).astype(np.int32), mark=mark,
                     span=pairs[:, 0], words=pairs[:, 1])


def _mark_firsts(table: pa.Table) -> pa.Table:
    found = _combined(np.frombuffer(b"".join(table.column("entries").to_pylist()), FIRST))
    return pa.table({"mark": found["mark"], "doc_id": _nullable(found["doc_id"], found["last"]),
                     **{c: found[c] for c in ("row", "word", "n_words", "low", "high")}})


def _segment_firsts(n: int):
    """The entries of a batch's segments, one for every mark, and their windows, by the
    bucket of the seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {c: b.column(c).flatten().to_numpy(zero_copy_only=False) for c in (
                "seed", "segment", "word", "size", "plain")}
            windows = np.frombuffer(b"".join(b.column("windows").to_pylist()), np.int64)
            per, size = np.diff(b.column("seed").offsets.to_numpy()), cols["size"]
            found = _combined(_entries(
                SEGMENTS, b, per, seed=cols["seed"], mark=cols["segment"], word=cols["word"],
                n_words=size, plain=cols["plain"], at=np.cumsum(size, dtype=np.int64) - size))
            out = []
            for bucket, own in _by_bucket(np.ascontiguousarray(found["seed"]), n):
                part = found[own]
                out.append((bucket, part.tobytes(), windows[_ranges(part["at"], part["n_words"])]
                            .tobytes()))
            yield _batch("bucket long, entries binary, windows binary",
                         bucket=[x[0] for x in out], entries=[x[1] for x in out],
                         windows=[x[2] for x in out])
    return run


def _segment_owners(table: pa.Table) -> pa.Table:
    """The owners of the windows of every mark: all segments of a seed are in one bucket,
    and so are all equal windows."""
    entries = np.frombuffer(b"".join(table.column("entries").to_pylist()), SEGMENTS).copy()
    windows = np.frombuffer(b"".join(table.column("windows").to_pylist()), np.int64)
    size = entries["n_words"].astype(np.int64)
    entries["at"] = np.cumsum(size) - size
    kinds = _combined(entries)
    kinds = kinds[np.argsort(kinds["seed"], kind="stable")]
    opens = _groups(kinds["seed"])
    held = np.diff(np.append(opens, len(kinds)))
    again = np.repeat(np.minimum.reduceat(kinds["low"], opens)
                      < np.maximum.reduceat(kinds["high"], opens), held)
    # all occurrences of the seed are equal: so are their windows, one by one
    alone = np.repeat(held == 1, held) & kinds["plain"]
    even, kinds = kinds[again & alone], kinds[again & ~alone]
    full = (np.uint64(0xFFFFFFFFFFFFFFFF) >> (SEGMENT - even["n_words"]).astype(np.uint64))
    mark, mask, last, owner, own, at = [[even["mark"]], [full.view(np.int64)], [even["last"]],
                                        [even["doc_id"]], [even["row"]], [even["word"]]]
    if len(kinds):
        size = kinds["n_words"].astype(np.int64)
        each = np.repeat(kinds, size)
        each["n_words"] = offset = _ranges(np.zeros(len(kinds), np.int64), size)
        each["word"] += offset.astype(np.int32)
        segment = np.repeat(kinds["mark"], size)
        each["mark"] = window = windows[_ranges(kinds["at"], size)]
        firsts = _combined(each)
        firsts = firsts[firsts["low"] < firsts["high"]]
        place = np.searchsorted(firsts["mark"], window)
        place[place == len(firsts)] = 0
        use = firsts["mark"][place] == window if len(firsts) else np.zeros(len(window), bool)
        segment, offset, first = segment[use], offset[use], firsts[place[use]]
        start = first["word"] - offset.astype(np.int32)
        order = np.lexsort((start, first["row"], segment))
        segment, offset, first, start = (x[order] for x in (segment, offset, first, start))
        if len(segment):
            opens = _groups(segment, first["row"], start)
            bits = np.bitwise_or.reduceat(np.uint64(1) << offset.astype(np.uint64), opens)
            mark.append(segment[opens])
            mask.append(bits.view(np.int64))
            last.append(first["last"][opens])
            owner.append(first["doc_id"][opens])
            own.append(first["row"][opens])
            at.append(start[opens])
    return pa.table({"mark": np.concatenate(mark), "mask": np.concatenate(mask),
                     "owner": _nullable(np.concatenate(owner), np.concatenate(last)),
                     "own": np.concatenate(own), "at": np.concatenate(at)})


def _sets(k: int):
    """Shingle sets of the wanted units (mark, word, n_words) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [lowered(t) for t in b.column("text").to_pylist()]
            wanted = b.column("wanted")
            edge = wanted.offsets.to_numpy()
            mark, word, size = (wanted.values.field(c).to_numpy() for c in ("mark", "word", "n_words"))
            for lo, hi in chunks(texts):
                hashes, _, _, first = words(texts[lo:hi])
                shingles = shingle_hashes(hashes, k)
                own = slice(edge[lo], edge[hi])
                at = word[own] + np.repeat(first[:-1], np.diff(edge[lo:hi + 1]))
                sets = [np.unique(shingles[x:x + n]) for x, n in zip(
                    at.tolist(), (size[own] - k + 1).tolist())]
                yield _batch(SETS, mark=mark[own], n=[len(x) for x in sets],
                             shingles=[x.tobytes() for x in sets])
    return run


def _places(min_words: int):
    """The segments of the wanted seeds of every text, and where its words are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [lowered(t) for t in b.column("text").to_pylist()]
            wanted = b.column("wanted")
            begin = wanted.offsets.to_numpy()
            for lo, hi in chunks(texts):
                hashes, start, end, first = words(texts[lo:hi])
                at, text, seeds = window_seeds(hashes, first, min_words)
                own = begin[lo:hi + 1]
                use = wanted_windows(text, seeds, own - own[0], wanted.values.to_numpy()[
                    own[0]:own[-1]].view(np.uint64))
                at, text, seeds = at[use], text[use], seeds[use]
                marks = windows(hashes, min_words)[at] if len(at) else seeds
                place, size, mark, plain = _segments(at, marks, seeds, text)
                opens = np.cumsum(size) - size
                edge = np.searchsorted(text[opens], np.arange(hi - lo + 1))
                gaps, lengths = [], []
                for t, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    x, y, raw = start[a:z], end[a:z], texts[lo + t]
                    if not raw.isascii():    # bytes to code points
                        data = np.frombuffer(raw, np.uint8)
                        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                        x, y = chars[x], chars[y]
                    gaps.append(_narrow(np.diff(x, prepend=0)))
                    lengths.append(_narrow(y - x))
                yield _batch(
                    PLACES, row=b.column("row").slice(lo, hi - lo),
                    doc_id=b.column("doc_id").slice(lo, hi - lo),
                    seed=_lists(seeds[opens].view(np.int64), edge, pa.int64()),
                    segment=_lists(mark.view(np.int64), edge, pa.int64()),
                    word=_lists(place - first[text[opens]], edge, pa.int32()),
                    size=_lists(size, edge, pa.int32()), plain=_lists(plain, edge, pa.bool_()),
                    windows=_blobs(marks, np.searchsorted(text, np.arange(hi - lo + 1))),
                    gaps=gaps, lengths=lengths)
    return run


def _joined(min_words: int):
    """The passages of every text: its spans, joined where they touch or only units of
    less than k words lie between, if they hold ``min_words`` words, cut into parts that
    are removed and parts that stay."""
    def of_windows(spans: dict, at: np.ndarray, gaps: bytes, lengths: bytes) -> Iterator[dict]:
        # windows of one owner one word apart are one span
        begin = np.cumsum(_widened(gaps))
        stop = begin + _widened(lengths)
        segment, offset = np.nonzero(spans["mask"][at][:, None] >> np.arange(SEGMENT) & 1)
        place = spans["word"][at][segment] + offset
        owner, removed = spans["owner"][at][segment], spans["removed"][at][segment]
        order = np.lexsort((place, removed, owner))
        place, owner, removed = place[order], owner[order], removed[order]
        new = np.ones(len(place), bool)
        new[1:] = ((np.diff(place) != 1) | (owner[1:] != owner[:-1])
                   | (removed[1:] != removed[:-1]))
        opens = np.flatnonzero(new)
        for x, size in zip(opens.tolist(), np.diff(np.append(opens, len(place))).tolist()):
            a, n = int(place[x]), size + min_words - 1
            yield {"level": 2, "start": int(begin[a]), "end": int(stop[a + n - 1]), "word": a,
                   "n_words": n, "removed": bool(removed[x]), "owner": int(owner[x])}

    def of_text(spans: list[dict]) -> Iterator[tuple]:
        spans.sort(key=lambda s: (s["word"], s["level"], s["n_words"]))
        n = max(s["word"] + s["n_words"] for s in spans)
        held, gone = np.zeros(n + 2, bool), np.zeros(n + 2, bool)
        start, end, last = {}, {}, None
        for s in spans:
            a, z = s["word"], s["word"] + s["n_words"]
            start[a], end[z] = s["start"], s["end"]
            held[a + 1:z + 1] = True
            gone[a + 1:z + 1] |= s["removed"]
            if s["level"] == 0:
                if last and last["i"] + 1 == s["i"]:
                    gap = last["word"] + last["n_words"]
                    held[gap + 1:a + 1] = True
                    gone[gap + 1:a + 1] |= s["removed"] and last["removed"]
                last = s
        edge = np.flatnonzero(held[1:] != held[:-1])
        for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if z - a < min_words:
                continue
            cut = [a, *(np.flatnonzero(gone[a + 2:z + 1] != gone[a + 1:z]) + a + 1).tolist(), z]
            for x, y in zip(cut[:-1], cut[1:]):
                own = [s for s in spans if s["word"] < y and s["word"] + s["n_words"] > x
                       and s["removed"] == bool(gone[x + 1])]
                units = sum(s["level"] == 0 for s in own)
                # a part that stays has no edge of its own beside one that goes
                yield (start[x] if x in start else end[x], end[y] if y in end else start[y],
                       y - x, units, bool(gone[x + 1]), own[0]["owner"] if own else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PASSAGE.split(", ")]
        for b in batches:
            edge = b.column("spans").offsets.to_numpy()
            flat = b.column("spans").values
            # a null owner (its documents have no id) is a row number of no document
            cols = {f.name: flat.field(f.name).fill_null(False if f.name == "removed" else
                                                         NO_ID if f.name == "owner" else 0)
                    .to_numpy(zero_copy_only=False) for f in flat.type}
            out = []
            for i, (row, doc, gaps, lengths) in enumerate(zip(*(
                    b.column(c).to_pylist() for c in ("row", "doc_id", "gaps", "lengths")))):
                at = np.arange(edge[i], edge[i + 1])
                of_units = at[cols["level"][at] < 2]
                keys = ("level", "i", "start", "end", "word", "n_words", "removed", "owner")
                spans = [dict(zip(keys, x)) for x in zip(*(cols[c][of_units].tolist()
                                                           for c in keys))]
                if len(of_units) < len(at):
                    spans += of_windows(cols, at[cols["level"][at] == 2], gaps, lengths)
                out += [(row, doc, *p[:-1], None if p[-1] == NO_ID else p[-1])
                        for p in of_text(spans)]
            yield _batch(PASSAGE, **{name: [x[i] for x in out] for i, name in enumerate(names)})
    return run


def unit_table(rows: DataFrame, k: int = K, similarity: Fraction = SIMILARITY,
               min_words: int = MIN_WORDS) -> DataFrame:
    """Two rows per row of ``rows`` (row, doc_id, text), stored: level 0 with the arrays of
    its units and its seeds, level 1 with those of its paragraphs."""
    return staged(rows.mapInArrow(_cut(k, float(similarity), min_words), UNITS),
                  "passages_units", "zstd")


def unit_sets(rows: DataFrame, celled: DataFrame, k: int) -> DataFrame:
    """Shingle sets (mark, n, shingles) of the units in cells, stored; a unit's set is cut
    from the text that holds it first."""
    wanted = (celled.groupBy(F.col("first.row").alias("row"))
              .agg(F.collect_list(F.struct("mark", "first.word", "first.n_words"))
                   .alias("wanted")))   # units of one text
    return staged(rows.join(wanted.hint("shuffle_hash"), "row").mapInArrow(_sets(k), SETS), "passages_sets", "zstd")


def window_places(rows: DataFrame, units: DataFrame, min_words: int) -> DataFrame:
    """Segments of windows whose seed is found in other rows too (row, doc_id, arrays) with
    the places of the text's words, stored."""
    seeds = units.select("row", F.explode("seeds").alias("seed"))    # distinct in a row
    again = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("seed")
    wanted = seeds.join(again.hint("shuffle_hash"), "seed").groupBy("row").agg(F.collect_list("seed").alias("wanted"))
    return staged(rows.join(wanted.hint("shuffle_hash"), "row").mapInArrow(_places(min_words), PLACES),
                  "passages_places", "zstd")


def _each(units: DataFrame) -> DataFrame:
    """A row for every unit."""
    return units.select("row", "doc_id", "level", "marks", "spans").mapInArrow(_exploded, EACH)


def repeated_spans(rows: DataFrame, units: DataFrame, k: int, similarity: Fraction,
                   min_words: int) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, level, i, start, end, word, n_words, owner, removed, mask): units (level
    0), paragraphs (1) and segments of windows (2, see ``repeated_windows``) of classes
    found in two documents or more; and the stored places of the words of texts."""
    occurrences = staged(
        units.select("row", "doc_id", "marks", "spans")
        .mapInArrow(_unit_firsts(shuffle_partitions(rows.sparkSession)), "bucket long, entries binary")
        .groupBy("bucket").applyInArrow(_mark_firsts, FIRSTS)
        .select("mark", F.struct("doc_id", "row", "word", "n_words").alias("first"), "low", "high"),
        "passages_marks")
    cell = staged(cells(units.filter("length(keys) > 0").select("ids", "keys", "sizes")),
                  "passages_cells")
    # from here on without band keys, and occurrences of marks in cells or of two rows only
    full, units = units, staged(units.select("row", "doc_id", "level", "marks", "spans", "seeds"),
                                "passages_spans", "zstd")
    celled = staged(occurrences.join(cell.withColumnRenamed("node", "mark"), "mark"),
                    "passages_celled")
    again = staged(occurrences.filter("low < high"), "passages_again")
    discard(full, occurrences, cell)
    each = _each(units)
    sets = unit_sets(rows, celled, k)
    members = (celled.select("root", "mark").join(sets.select("mark", "n"), "mark")
               .select(F.col("root").alias("cell"), F.col("mark").alias("row"), "n"))
    links = staged(cell_links(members, sets.select(F.col("mark").alias("row"), "shingles"),
                              similarity, direct=DIRECT), "passages_links")
    near = staged(components(links, "passages_components")
                  .select(F.col("node").alias("mark"), F.col("root").alias("class")),
                  "passages_near")
    discard(sets, links)
    # a class of one mark is decided by its own row; only linked marks are grouped
    alone = again.join(near, "mark", "left_anti").select("mark", "first")
    linked = celled.drop("root").join(near, "mark")
    place = F.struct(F.col("first.doc_id").isNull().alias("last"), "first.*")
    groups = (linked.groupBy("class").agg(F.min(place).alias("first"), F.min("low").alias("low"),
                                          F.max("high").alias("high")).filter("low < high"))
    table = alone.unionByName(linked.select("mark", "class").join(
        groups.select("class", F.col("first").dropFields("last").alias("first")),
        "class").drop("class"))
    none = F.lit(None)
    of_units = staged(decided(each, table).withColumn("mask", none.cast("long")),
                      "passages_found", "zstd")
    discard(again, celled, near)
    places = window_places(rows, units, min_words)
    discard(units)
    return (of_units.unionByName(repeated_windows(places, min_words).select(
                "row", "doc_id", F.lit(2).alias("level"), F.lit(0).alias("i"),
                none.cast("int").alias("start"), none.cast("int").alias("end"), "word",
                F.lit(min_words).alias("n_words"), "owner", "removed", "mask")), places)


def repeated_windows(places: DataFrame, min_words: int) -> DataFrame:
    """(row, doc_id, word, mask, owner, removed): segments and which of their windows
    (bits of ``mask``, from window ``word`` on) are found in two rows or more and first
    in ``owner``; a segment whose windows have several owners has a row for each."""
    buckets = shuffle_partitions(places.sparkSession)
    owners = staged(
        places.select("row", "doc_id", "seed", "segment", "word", "size", "plain", "windows")
        .mapInArrow(_segment_firsts(buckets), "bucket long, entries binary, windows binary")
        .groupBy("bucket").applyInArrow(_segment_owners, OWNERS), "passages_owners")
    each = (places.select("row", "doc_id", F.explode(F.arrays_zip("segment", "word")).alias("s"))
            .select("row", "doc_id", F.col("s.segment").alias("mark"), "s.word"))
    return each.join(owners.hint("shuffle_hash"), "mark").select(
        "row", "doc_id", "word", "mask", "owner",
        ((F.col("row") != F.col("own")) | (F.col("word") >= F.col("at") + min_words))
        .alias("removed"))


def decided(each: DataFrame, table: DataFrame) -> DataFrame:
    """The spans of ``each`` whose mark is in ``table`` (mark, first), and whether they are
    removed: not the first occurrence, nor what overlaps it."""
    halves = [F.shiftright(F.col(c), 32).cast("int").alias(h) for c, h in (("span", "start"),
                                                                          ("words", "word"))]
    halves += [F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias(h) for c, h in
               (("span", "end"), ("words", "n_words"))]
    return (each.join(table.hint("shuffle_hash"), "mark").select("*", *halves)
            .select("row", "doc_id", "level", "i", "start", "end", "word", "n_words",
                    F.col("first.doc_id").alias("owner"),
                    ((F.col("first.row") != F.col("row"))
                     | (F.col("word") >= F.col("first.word") + F.col("first.n_words")))
                    .alias("removed")))


def passages(docs: DataFrame, k: int = K, similarity: Fraction = SIMILARITY,
             min_words: int = MIN_WORDS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per passage that repeats across documents: row, doc_id, start, end (code
    points, end exclusive), n_words, n_units (repeated units in it; none if only windows
    repeat), removed (false: the first occurrence), first_doc_id (the smallest doc_id that
    holds its first span's class)."""
    rows = numbered(id_and_text(docs, id_col, text_col), "passages_rows")
    out = row_passages(rows, k, similarity, min_words)
    discard(rows)       # texts are read in the stored steps only
    return out


def row_passages(rows: DataFrame, k: int, similarity: Fraction, min_words: int) -> DataFrame:
    """``passages`` of (row, doc_id, text), a stored table."""
    found, places = repeated_spans(rows, unit_table(rows, k, similarity, min_words), k, similarity,
                                   min_words)
    spans = found.groupBy("row", "doc_id").agg(F.collect_list(F.struct(
        "level", "i", "start", "end", "word", "n_words", "removed", "owner", "mask")).alias("spans"))
    return spans.join(places.select("row", "gaps", "lengths"), "row", "left").mapInArrow(_joined(min_words), PASSAGE)   # of one text


def remove_passages(docs: DataFrame, k: int = K, similarity: Fraction = SIMILARITY,
                    min_words: int = MIN_WORDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` without the passages to be removed; all rows and columns stay."""
    row, cuts = fresh(docs, "row"), fresh(docs, "cuts")
    rows = numbered(docs, "passages_rows", row)
    gone = (row_passages(id_and_text(rows, id_col, text_col, row), k, similarity, min_words)
            .filter("removed").groupBy(F.col("row").alias(row))
            .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts)))  # of one text
    marked = rows.join(gone, row, "left")
    # what stays: from the end of each cut to the start of the next
    text, spans = F.col(f"`{text_col}`"), F.col(cuts)
    size = F.length(text).cast("long")
    edges = F.concat(F.array(F.lit(0).cast("long")),
                     F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"]))),
                     F.array(size))
    parts = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.substring(
        text, (F.get(edges, 2 * i) + 1).cast("int"),
        (F.get(edges, 2 * i + 1) - F.get(edges, 2 * i)).cast("int")))
    rest = F.when(spans.isNull(), text).otherwise(F.array_join(parts, ""))
    return marked.select(*[(rest.alias(c) if c == text_col else F.col(f"`{c}`"))
                           for c in docs.columns])
