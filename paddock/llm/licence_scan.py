"""Licence scan by a positional index of rare words.

Templates are phrases (every word must be there, side by side) and notices (words
holding ``share`` of the notice's weight must be there, each at most ``slack`` words from
its place, and so must all of the notice's mandatory key phrases). The index lists, for
every word of any template, its templates and positions (postings) and its IDF, which is
counted over all documents.

1. A pass over all texts counts in how many each licence word is; the result has a row
   for each licence word (bounded by the templates) and goes to every task.
2. For each text and template: words that the text lacks are lost. The text's licence
   words of highest IDF are looked up, in falling order, until the others alone could
   not reach the share (for a phrase that is one word). Every true place therefore has
   one of them in place: none is missed.
3. A looked-up word's position in the text less its posting's is where the template
   would start; equal starts coincide. Each is compared with the whole template, a
   notice also at starts up to ``slack`` words away, and its key phrases are verified.

No row leaves its task but for the counts; work is linear in the texts. Long runs of one
rare word give one start per occurrence and posting, compared in blocks.

Defined cases: null and empty texts have no words, no matches, score 0; words are
maximal runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII; every row gives
one row, repeated rows and null ids included; an empty table gives an empty result;
other columns are not read. Equal 64-bit hashes count as equal words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import id_and_text
from paddock.llm.licence_texts import BASE_PHRASES, NOTICES, PHRASES
from paddock.llm.shingles import chunks, lowered, words

SHARE = 0.8
SLACK = 4
BLOCK = 1 << 20              # template words compared at once
_EPS = 1e-9
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(lowered(text).decode("utf-8", "surrogatepass"))


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool = False                # counted by the base columns
    share: float = 1.0                # of the weight that must be in place
    slack: int = 0                    # words by which a place may be off
    required: tuple[tuple[str, ...], ...] = field(default=())


def phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, tuple(tokens(text)), base)


def notice(label: str, required: list[str], text: str, share: float = SHARE,
           slack: int = SLACK) -> Template:
    return Template(label, tuple(tokens(text)), False, share, slack,
                    tuple(tuple(tokens(r)) for r in required))


def templates() -> list[Template]:
    """The templates of ``licence_texts``."""
    return ([phrase(*x, base=True) for x in BASE_PHRASES] + [phrase(*x) for x in PHRASES]
            + [notice(*x) for x in NOTICES])


class _Entry:
    """A template in word numbers."""

    def __init__(self, t: Template, number: dict[str, int], idf: np.ndarray):
        self.template = t
        self.words = np.array([number[w] for w in t.words])
        self.distinct, where, times = np.unique(self.words, return_inverse=True, return_counts=True)
        self.positions = [np.flatnonzero(where == k) for k in range(len(self.distinct))]
        weight = idf[self.words]
        self.weight = weight / weight.sum()
        self.mass = idf[self.distinct] * times / weight.sum()
        self.falling = np.lexsort((self.distinct, -idf[self.distinct]))
        self.required = []
        for r in t.required:
            row = [number[w] for w in r]
            at = [i for i in range(len(self.words)) if self.words[i:i + len(r)].tolist() == row]
            if not at:
                raise ValueError(f"not in its template: {' '.join(r)}")
            self.required.append((at, np.array(row)))

    def lookups(self, present: np.ndarray) -> np.ndarray:
        """Numbers (of ``distinct``) of the words to look up in a text that has the words
        ``present``; none if it cannot hold the template."""
        rest = 1.0 - self.mass[~present].sum()
        order = self.falling[present[self.falling]]
        if self.template.share >= 1:
            return order[:1] if present.all() else order[:0]
        if rest < self.template.share - _EPS:
            return order[:0]
        # the first words whose lack would leave too little
        left = rest - np.cumsum(self.mass[order])
        return order[:1 + np.count_nonzero(left >= self.template.share - _EPS)]

    def places(self, text: np.ndarray, looked: np.ndarray) -> list[tuple[int, float, int]]:
        """(start, share in place, words exactly in place) of the template's places in a
        text of word numbers."""
        slack, size = self.template.slack, len(self.words)
        starts = np.unique(np.concatenate(
            [(np.flatnonzero(text == self.distinct[k])[:, None] - self.positions[k]).ravel()
             for k in looked]))
        if not slack:
            starts = starts[(starts >= 0) & (starts <= len(text) - size)]
        out = []
        step = max(1, BLOCK // size)
        for lo in range(0, len(starts), step):
            block = starts[lo:lo + step]
            if slack:
                block = np.unique((block[:, None] + np.arange(-slack, slack + 1)).ravel())
            hit, exact = self._in_place(text, block)
            if self.template.share >= 1:
                out += [(int(s), 1.0, size) for s in block[hit.all(axis=1)]]
                continue
            for s, c, n in zip(block, hit @ self.weight, exact):
                if c >= self.template.share - _EPS and self._has_required(text, int(s)):
                    out.append((int(s), min(1.0, float(c)), int(n)))
        return out

    def _in_place(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which template words stand in place, and how many exactly, for every start."""
        slack, size = self.template.slack, len(self.words)
        margin = np.full(size + 2 * slack, -1)
        padded = np.concatenate((margin, text, margin))
        at = starts[:, None] + np.arange(size) + len(margin)
        hit = padded[at] == self.words
        exact = hit.sum(axis=1)
        for off in range(1, slack + 1):
            hit |= (padded[at - off] == self.words) | (padded[at + off] == self.words)
        return hit, exact

    def _has_required(self, text: np.ndarray, start: int) -> bool:
        slack = self.template.slack
        return all(any(np.array_equal(text[p:p + len(row)], row)
                       for a in at for p in range(max(0, start + a - slack), start + a + slack + 1))
                   for at, row in self.required)


def vocabulary(rows: list[Template]) -> list[str]:
    return sorted({w for t in rows for w in t.words})


class _Vocabulary:
    """Numbers of licence words in texts."""

    def __init__(self, listed: list[str]):
        hashes, *_ = words([" ".join(listed).encode()], _BETWEEN)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The licence word's number (else -1) of every word of all texts, and the first
        word of every text (and the end)."""
        hashes, _, _, first = words(texts, _BETWEEN)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1), first


def _presence(number: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Which licence words each text has."""
    hit = np.flatnonzero(number >= 0)
    out = np.zeros((len(first) - 1, size), bool)
    out[np.searchsorted(first, hit, "right") - 1, number[hit]] = True
    return out


def _lowered(b: pa.RecordBatch) -> list[bytes]:
    return [t.lower() for t in b.column("text").cast(pa.binary()).to_pylist()]


PART = 4096                  # texts whose word table is held at once


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    for lo, hi in chunks(texts):
        for at in range(lo, hi, PART):
            yield at, min(hi, at + PART)


def word_counts(docs: DataFrame, listed: list[str], id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, texts): in how many rows each of ``listed`` is; word null: all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, total = _Vocabulary(listed), np.zeros(len(listed), np.int64), 0
        for b in batches:
            texts = _lowered(b)
            total += len(texts)
            for lo, hi in _parts(texts):
                count += _presence(*known.numbers(texts[lo:hi]), len(listed)).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"word": pa.array([*listed, None], pa.string()),
                                          "texts": pa.array([*count, total], pa.int64())})

    return (id_and_text(docs, id_col, text_col).mapInArrow(run, "word string, texts long")
            .groupBy("word").agg(F.sum("texts").alias("texts")))


def idf(docs: DataFrame, listed: list[str], id_col: str = "doc_id",
        text_col: str = "text") -> np.ndarray:
    """ln(1 + rows / (1 + rows with the word)) of every listed word; collects one row per
    listed word."""
    counts = {r.word: r.texts for r in word_counts(docs, listed, id_col, text_col).collect()}
    n = counts.get(None, 0)
    return np.array([np.log(1 + max(1, n) / (1 + counts.get(w, 0))) for w in listed])


MATCH = [("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()),
         ("length", pa.int64()), ("score", pa.float64())]


def scan(docs: DataFrame, rows: list[Template] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, matches (label, kind: base, phrase or
    notice, start in words from 0, length in words, score: share in place) by start, then
    template. A phrase has all its places; a notice its best (of equals that with most words
    exactly in place, then the first)."""
    rows = templates() if rows is None else rows
    listed = vocabulary(rows)
    weights = idf(docs, listed, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(listed)}
        known = _Vocabulary(listed)
        entries = [_Entry(t, number, weights) for t in rows]
        for b in batches:
            texts = _lowered(b)
            for lo, hi in _parts(texts):
                found, first = known.numbers(texts[lo:hi])
                present = _presence(found, first, len(listed))
                matches: list[list[dict]] = [[] for _ in range(hi - lo)]
                for e in entries:
                    lost = 1 - present[:, e.distinct] @ e.mass
                    for d in np.flatnonzero(lost <= 1 - e.template.share + _EPS):
                        looked = e.lookups(present[d, e.distinct])
                        if len(looked):
                            matches[d] += _matches(e, found[first[d]:first[d + 1]], looked)
                for m in matches:
                    m.sort(key=lambda x: x["start"])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(lo, hi - lo),
                    "n_words": pa.array(np.diff(first), pa.int64()),
                    "matches": pa.array(matches, pa.list_(pa.struct(MATCH)))})

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, matches array<struct<label:string,kind:string,"
             "start:long,length:long,score:double>>")


def _matches(e: _Entry, text: np.ndarray, looked: np.ndarray) -> list[dict]:
    t, at = e.template, e.places(text, looked)
    if t.share < 1 and at:
        at = [min(at, key=lambda x: (-round(x[1], 9), -x[2], x[0]))]
    kind = "base" if t.base else "phrase" if t.share >= 1 else "notice"
    return [dict(label=t.label, kind=kind, start=s, length=len(e.words), score=c)
            for s, c, _ in at]


def label_counts(scanned: DataFrame) -> DataFrame:
    """(label, kind, texts) of a scan's rows."""
    return (scanned.select(F.explode(F.array_distinct(F.transform(
        "matches", lambda m: F.struct(m.label.alias("label"), m.kind.alias("kind"))))).alias("m"))
        .groupBy("m.label", "m.kind").agg(F.count(F.lit(1)).alias("texts")))
