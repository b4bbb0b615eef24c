"""Periodic run detection by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that holds at least ``repeats`` periods and ``shortest`` words, and that no
neighbouring word extends keeping the period. Texts are handled in chunks: the words'
hashes of many texts stand in one array, a hash of its own behind each text, so nothing
matches across texts. No row leaves its task; there is no shuffle.

- Periods up to ``SCANNED`` come from direct scans at each lag.
- Scale Q (16, 32, ... doubling) covers periods above Q/2 up to Q. It hashes every
  stretch of Q words and keeps the minima of all windows of such hashes. Inside a run
  of period q <= Q, stretches of Q words are equal only at multiples of q (a smaller
  period would divide q), and windows a period apart hold equal minima; so the next
  equal minimizer follows at distance q exactly. The windows are as wide as ``repeats``
  periods leave room for, so every run has such a pair at its scale. Pairs of
  consecutive equal minimizers number at most the minimizers: nothing is quadratic.
- Pairs of one distance that overlap are merged, extended word by word to both sides,
  and compared exactly (on 64-bit word hashes).
- A stretch found at several distances has the least as its period: by Fine and Wilf
  the others are multiples.

Defined cases: null and empty texts have no words and no runs; words are maximal runs
without blank or \\t \\n \\v \\f \\r; every row gives one row, repeated rows and null ids
included; an empty table gives an empty result; other columns are not read. Two words
with equal 64-bit hashes count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paddock.llm._common import id_and_text
from paddock.llm.shingles import chunks, mix, words

SCANNED = 8
SHORTEST = 6
REPEATS = 4
Run = tuple[int, int, int]           # start, length, period

_LEFT, _RIGHT, _END = np.random.default_rng(20_241_105).integers(1, 2**63, 3, np.uint64) * 2 + 1


def _spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the stretches of consecutive numbers in a rising array."""
    cut = np.flatnonzero(np.diff(places) != 1)
    first = np.concatenate((places[:1], places[cut + 1]))
    return first, np.concatenate((places[cut], places[-1:])) + 1


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that are a minimum of some window of ``width`` neighbours, ties included."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    none = np.zeros(width - 1, np.uint64)
    highest = _sliding(np.concatenate((none, least, none)), width, np.maximum)
    return np.flatnonzero(highest == hashes)


def _equal_ahead(words: np.ndarray, i: int, j: int) -> int:
    """How many words from i on equal those from j on; i < j."""
    done, step = 0, 32
    while j + done < len(words):
        a, b = words[j + done:j + done + step], words[i + done:i + done + step]
        other = np.flatnonzero(a != b[:len(a)])
        if len(other):
            return done + int(other[0])
        done += len(a)
        step *= 2
    return done


def _equal_behind(words: np.ndarray, i: int, j: int) -> int:
    """How many words before i equal those before j; i < j."""
    done, step = 0, 32
    while done < i:
        take = min(step, i - done)
        a, b = words[i - done - take:i - done], words[j - done - take:j - done]
        other = np.flatnonzero(a != b)
        if len(other):
            return done + take - 1 - int(other[-1])
        done += take
        step *= 2
    return done


def _lag_runs(words: np.ndarray, lag: int, lo: int, hi: int, least: int) -> Iterator[Run]:
    """Stretches of ``least`` words or more with period ``lag`` whose equal places lie in
    [lo, hi)."""
    same = np.flatnonzero(words[lo:hi] == words[lo + lag:hi + lag]) + lo
    if len(same):
        first, end = _spans(same)
        for k in np.flatnonzero(end - first + lag >= least):
            yield int(first[k]), int(end[k] - first[k]) + lag, lag


def _seeds(hashes: np.ndarray, width: int, low: int, high: int,
           at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(distance, first, last): merged pairs of consecutive equal minimizers whose distance
    lies above ``low`` and up to ``high``; at: the word at which each hash begins."""
    chosen = minimizers(hashes, width)
    chosen = chosen[np.argsort(hashes[chosen], kind="stable")]
    value, place = hashes[chosen], at[chosen]
    gap = np.diff(place)
    pair = np.flatnonzero((value[1:] == value[:-1]) & (gap > low) & (gap <= high))
    gap, place = gap[pair], place[pair]
    order = np.lexsort((place, gap))
    gap, place = gap[order], place[order]
    if len(gap):
        new = np.flatnonzero((np.diff(gap) != 0) | (np.diff(place) > high)) + 1
        first, last = np.concatenate(([0], new)), np.concatenate((new, [len(gap)])) - 1
        for a, b in zip(first, last):
            yield int(gap[a]), int(place[a]), int(place[b])


def runs_of(hashes: np.ndarray, first: np.ndarray, shortest: int = SHORTEST,
            repeats: int = REPEATS) -> list[list[Run]]:
    """Runs of every text, by start and then period. ``hashes``: those of all texts' words
    in order; ``first``: the number of every text's first word, and the end."""
    if repeats < 3:
        raise ValueError("minimizer windows need three periods or more")
    count = len(first) - 1
    size = np.diff(first)
    text = np.repeat(np.arange(count), size + 1)       # of every word and every end
    base = first[:-1] + np.arange(count)
    ends = first[1:] + np.arange(count)
    word = np.empty(len(hashes) + count, np.uint64)
    is_end = np.zeros(len(word), bool)
    is_end[ends] = True
    word[~is_end] = hashes
    word[ends] = mix(np.arange(count, dtype=np.uint64) + _END)

    found: list[Run] = []
    for lag in range(1, min(SCANNED, len(word) - 1) + 1):
        found += _lag_runs(word, lag, 0, len(word) - lag, max(shortest, repeats * lag))

    at, stretch, span, low = np.arange(len(word)), word, 1, SCANNED
    while True:
        high = 2 * low
        long_enough = size >= repeats * (low + 1)
        if not long_enough.any():
            break
        stay = long_enough[text[at]]
        if not stay.all():
            at, stretch = at[stay], stretch[stay]
        while span < high:
            # a stretch twice as long; those beyond a text's end take in its own end's hash
            ahead = np.concatenate((stretch[span:], np.zeros(min(span, len(stretch)), np.uint64)))
            stretch = mix(stretch * _LEFT + ahead * _RIGHT)
            span *= 2
        width = (repeats - 1) * (low + 1) - high + 1
        for lag, a, b in _seeds(stretch, width, low, high, at):
            lo = a - _equal_behind(word, a, a + lag)
            hi = b + high + _equal_ahead(word, b + high, b + high + lag)
            found += _lag_runs(word, lag, lo, min(hi, len(word) - lag), max(shortest, repeats * lag))
        low = high

    period: dict[tuple[int, int], int] = {}
    for start, length, lag in found:
        period[start, length] = min(lag, period.get((start, length), lag))
    out: list[list[Run]] = [[] for _ in range(count)]
    for (start, length), lag in sorted(period.items(), key=lambda x: (x[0][0], x[1])):
        t = int(text[start])
        out[t].append((start - int(base[t]), length, lag))
    return out


def collapsed(text: bytes, runs: list[Run]) -> bytes:
    """The words joined by one blank, without those that a run holds after its first
    period."""
    kept = text.split()
    if runs:
        change = np.zeros(len(kept) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        kept = [kept[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(kept)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period of each, by
    start and then period), collapsed (the text without the runs' repetitions)."""
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for lo, hi in chunks(texts):
                hashes, _, _, first = words(texts[lo:hi])
                runs = runs_of(hashes, first, shortest, repeats)
                flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in runs])))
                items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)],
                                                   fields=list(run_type))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(lo, hi - lo),
                    "n_words": pa.array(np.diff(first), pa.int64()),
                    "runs": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
                    "collapsed": pa.array(list(map(collapsed, texts[lo:hi], runs)),
                                          pa.binary()).cast(pa.string())})

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, "
             "runs array<struct<start:long,length:long,period:long>>, collapsed string")
