"""Personal data: fixed patterns, and a linear-chain conditional random field over
word-shape features that adds what the patterns do not describe (an e-mail address
with a written-out sign, a phone number without a country code, a card number with
dots).

The field is trained on the driver from the small labelled table of
``pii_examples``; its few weights are broadcast. A line is a sequence of words
between white space. Words are mapped to types (same features), so scores are table
look-ups; lines in which no word can carry a label by the sound bound of
``crf.quiet_margin`` need no decoding, the others are decoded by Viterbi in batches.

Pattern spans always stay. A predicted span is added if it touches neither a pattern
span nor a place that the patterns examined and rejected (a wrong check digit, a part
over 255). Offsets are code points, ends exclusive.

Defined cases: null text counts as empty: no spans, empty strings; a null doc_id passes
through; repeated rows get the same answer; an empty table gives an empty result; other
columns are not read by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm import crf
from paddock.llm._common import fresh, id_and_text
from paddock.llm.pii_examples import labelled_table

# The kinds in the order in which spans are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"\S+")
EDGE = ".,;:!?\"'()[]<>{}|"
MAX_TYPES = 150_000       # words of a worker's type cache before it starts anew
BATCH_TOKENS = 200_000    # padded places decoded together

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns, and the matches that failed their checks."""
    found: list[Span] = []
    failed: list[Span] = []
    if "@" in text:
        at = 0
        while (sign := text.find("@", at)) >= 0:   # a match lies between white space
            lo = max(text.rfind(c, 0, sign) for c in " \n\t\r\v\f") + 1
            m = EMAIL.search(text, max(lo, at))
            if m is None:
                break
            found.append(("email", m.start(), m.end()))
            at = m.end()
    for m in IP.finditer(text):
        ok = all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))
        (found if ok else failed).append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
        elif len(digits) > 12:
            failed.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            ok = 8 <= sum(map(str.isdigit, m[0])) <= 15
            (found if ok else failed).append(("phone", m.start(), m.end()))
    return found, failed


def listed(spans: list[Span]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in
                    sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


class _Shape(dict):
    def __missing__(self, c: int) -> str:
        ch = chr(c)
        self[c] = "d" if "0" <= ch <= "9" else "X" if ch.isupper() else "x" if ch.isalpha() else ch
        return self[c]


_SHAPE = _Shape()
_RUN = re.compile(r"(.)\1+", re.S)


def word_features(word: str, triggers: frozenset[str] | None) -> tuple[str, ...]:
    """Word-shape features; ``triggers``: the lower-cased words that are features of
    their own (None: all)."""
    if word.isalpha():
        low = word.lower()
        known = triggers is None or low in triggers
        return ("letters", f"w={low}") if known else ("letters",)
    shape = word.translate(_SHAPE)
    digits = shape.count("d")
    brief = _RUN.sub(r"\1", shape)
    core = _RUN.sub(r"\1", shape.strip(EDGE))
    out = [f"core={core}", f"first={brief[0]}", f"last={brief[-1]}", f"digits={min(digits, 20)}"]
    for mark in "@+-.([":
        if mark in word:
            out.append(f"has={mark}{min(word.count(mark), 4)}")
    if not digits:
        out.append("no digit")
        if "@" not in word and "[at]" not in word and "(at)" not in word:
            out.append("plain")
    if "[at]" in word or "(at)" in word:
        out.append("written at")
    if core.count(".") and not digits:
        out.append("dotted letters")
    return tuple(out)


class Tagger:
    """The trained field with its type tables."""

    LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]

    def __init__(self, features: dict[str, int], model: crf.Model):
        self.features, self.model = features, model
        self.triggers = frozenset(f[2:] for f in features if f.startswith("w="))
        self.types: dict[tuple[str, ...], int] = {}
        self.words: dict[str, int] = {}
        self.rows: list[list[int]] = []
        self._type(("border",))
        self._refresh()

    @classmethod
    def train(cls, table: list[str]) -> Tagger:
        parsed = [cls._parse(s) for s in table]
        index: dict[str, int] = {"border": 0}
        type_of: dict[tuple[str, ...], int] = {}
        sequences, labels = [], []
        for words, tags in parsed:
            own = [word_features(w, None) for w in words]
            for f in own:
                for x in f:
                    index.setdefault(x, len(index))
            sequences.append([type_of.setdefault(f, len(type_of)) for f in own])
            labels.append([cls.LABELS.index(t) for t in tags])
        matrix = np.zeros((len(type_of) + 1, len(index)))
        for f, i in type_of.items():
            matrix[i, [index[x] for x in f]] = 1
        matrix[-1, 0] = 1
        n = len(cls.LABELS)
        allowed, first = np.ones((n, n), bool), np.ones(n, bool)
        for j, name in enumerate(cls.LABELS):
            if name[0] == "I":
                first[j] = False
                allowed[:, j] = [x[2:] == name[2:] for x in cls.LABELS]
        return cls(index, crf.train(sequences, labels, matrix, n, allowed, first))

    @staticmethod
    def _parse(sentence: str) -> tuple[list[str], list[str]]:
        """Words and labels of a sentence with [kind:...] marks."""
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[(%s):((?:[^\[\]]|\[at\])*)\]" % "|".join(KINDS), sentence):
            text += sentence[at:m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        text += sentence[at:]
        words, tags = [], []
        for m in WORD.finditer(text):
            words.append(m[0])
            tag = "O"
            for kind, a, b in spans:
                if m.start() < b and m.end() > a:
                    tag = ("B-" if m.start() <= a else "I-") + kind
            tags.append(tag)
        return words, tags

    def _type(self, f: tuple[str, ...]) -> int:
        i = self.types.get(f)
        if i is None:
            i = self.types[f] = len(self.rows)
            self.rows.append([self.features[x] for x in f if x in self.features])
        return i

    def _refresh(self) -> None:
        m = self.model
        tables = []
        for role in (m.own, m.before, m.after):
            t = np.array([role[r].sum(axis=0) for r in self.rows])
            tables.append(np.concatenate([t, t[:1]]))   # the border is type 0 and the last row
        self.tables = tuple(tables)
        self.leads, self.need = crf.quiet_margin(self.tables, m.start, m.step)
        self.fresh = len(self.rows)

    def numbers(self, words: list[str]) -> list[int]:
        known = self.words
        new = set(words).difference(known)
        if new:
            if len(known) > MAX_TYPES:
                known = self.words = {}
                new = set(words)
            for w in new:
                known[w] = self._type(word_features(w, self.triggers))
        return list(map(known.__getitem__, words))

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """Predicted spans of every text."""
        lines, where, flat = [], [], [0]
        for i, text in enumerate(texts):
            at = 0
            for line in text.split("\n"):
                words = line.split()
                if words:
                    lines.append((at, line, len(flat), len(words)))
                    where.append(i)
                    flat += self.numbers(words)
                    flat.append(0)
                at += len(line) + 1
        if self.fresh < len(self.rows):
            self._refresh()
        out: list[list[Span]] = [[] for _ in texts]
        if not lines:
            return out
        types = np.array(flat)
        lead = self.leads[0][types]
        lead[1:] += self.leads[1][types[:-1]]
        lead[:-1] += self.leads[2][types[1:]]
        loud = np.flatnonzero((lead <= self.need) & (types > 0))
        starts = np.array([x[2] for x in lines])
        todo = np.unique(np.searchsorted(starts, loud, "right") - 1).tolist()
        todo.sort(key=lambda j: lines[j][3])
        for group in _batches(todo, lambda j: lines[j][3]):
            n = np.array([lines[j][3] for j in group])
            padded = np.zeros((len(group), int(n.max())), np.int64)
            for r, j in enumerate(group):
                padded[r, :n[r]] = types[lines[j][2]:lines[j][2] + n[r]]
            e = crf.emissions(padded, n, *self.tables)
            best = crf.viterbi(e, n, self.model.start, self.model.step)
            for r, j in enumerate(group):
                if best[r].any():
                    out[where[j]] += self._read(lines[j][0], lines[j][1], best[r])
        return out

    def _read(self, at: int, line: str, labels: np.ndarray) -> list[Span]:
        found: list[Span] = []
        end = None
        for m, label in zip(_words(line), labels.tolist()):
            name = self.LABELS[label]
            if name[0] == "B" or name[0] == "I" and end is None:
                found.append((name[2:], m[0], m[1]))
            elif name[0] == "I":
                found[-1] = (found[-1][0], found[-1][1], m[1])
            end = m[1] if name != "O" else None
        trimmed = []
        for kind, a, b in found:
            while a < b and line[a] in EDGE and not (kind == "phone" and line[a] == "("):
                a += 1
            while b > a and line[b - 1] in EDGE:
                b -= 1
            if a < b:
                trimmed.append((kind, at + a, at + b))
        return trimmed


def _words(line: str) -> list[tuple[int, int]]:
    """Places of the words that ``line.split()`` gives."""
    out, at = [], 0
    for w in line.split():
        at = line.index(w, at)
        out.append((at, at + len(w)))
        at += len(w)
    return out


def _batches(items: list, width) -> Iterator[list]:
    """Items in order of width, as many as fit ``BATCH_TOKENS`` padded places."""
    group: list = []
    for x in items:
        if group and (len(group) + 1) * width(x) > BATCH_TOKENS:
            yield group
            group = []
        group.append(x)
    if group:
        yield group


@lru_cache(1)
def trained() -> tuple[dict[str, int], crf.Model]:
    t = Tagger.train(labelled_table())
    return t.features, t.model


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of every text."""
    out = []
    for text, more in zip(texts, tagger.spans(texts)):
        base, failed = base_spans(text)
        taken = base + failed
        added = [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in taken)]
        out.append((base, base + added))
    return out


_TAGGERS: dict[int, Tagger] = {}


def _tagger(shipped) -> Tagger:
    """One tagger per worker and broadcast, with its caches."""
    if shipped.id not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[shipped.id] = Tagger(*shipped.value)
    return _TAGGERS[shipped.id]


class _Shipped:
    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self):
        return self.broadcast.value


def _parts(texts: list[str], size: int = 1_500_000) -> Iterator[tuple[int, int]]:
    lo = held = 0
    for i, t in enumerate(texts):
        if i > lo and held + len(t) > size:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if texts:
        yield lo, len(texts)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (pattern
    spans), base_sha256, spans."""
    shipped = _Shipped(docs.sparkSession.sparkContext.broadcast(trained()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shipped)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in _parts(texts):
                rows = all_spans(texts[lo:hi], tagger)
                counts = {f"n_{k}": pa.array([sum(s[0] == k for s in base) for base, _ in rows],
                                             pa.int64()) for k in KINDS}
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": b.column("doc_id").slice(lo, hi - lo), **counts,
                     "base_sha256": pa.array([sha256(listed(base).encode()).hexdigest()
                                              for base, _ in rows], pa.string()),
                     "spans": pa.array([listed(every) for _, every in rows], pa.string())})

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
             "base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping
    spans become one, named after the first."""
    out, at, end = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"<{kind.upper()}>"]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` masked; null text stays null."""
    shipped = _Shipped(docs.sparkSession.sparkContext.broadcast(trained()))

    @F.pandas_udf("string")
    def mask(texts):
        import pandas as pd
        tagger = _tagger(shipped)
        values = ["" if t is None else t for t in texts]
        out = []
        for lo, hi in _parts(values):
            out += [masked(t, s) for t, (_, s) in
                    zip(values[lo:hi], all_spans(values[lo:hi], tagger))]
        return pd.Series(out, index=texts.index)

    new = fresh(docs, "masked")
    cols = [F.when(F.col(f"`{c}`").isNotNull(), F.col(new)).alias(c) if c == text_col
            else F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn(new, mask(F.col(f"`{text_col}`"))).select(*cols)
