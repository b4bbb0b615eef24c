"""Token ids of a lower-casing word vocabulary, as the tokenizers library gives
them, many texts at a time.

White space separates words for good in such a vocabulary, and within a word the
pre-splitting pattern cuts contractions, letters, single digits and other characters.
Words of Latin-1 letters are cut so in numpy, for many texts at once, and every
distinct piece is encoded once per worker by the byte-pair automaton of ``bpe``; known
pieces are found by their characters, packed in two integers. Any other word (which
needs Unicode normalisation) goes to the library itself, as does any text with
characters that only one of the two sides treats as white space, or with NUL.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from paddock.llm.bpe import Automaton, byte_alphabet, classes
from paddock.llm.shingles import mix

MAX_PIECES = 500_000      # pieces a worker knows before it starts anew (about 50 bytes each)
MAX_WORDS = 50_000        # entries of its cache of words and long pieces
CHUNK_CHARS = 1_000_000 # characters handled at once
SHORT = 16                # characters of a piece that two integers hold

_WHITE, _LETTER, _NUMBER, _OTHER, _FOREIGN = range(5)
# White space beyond Latin-1.
_WIDE_WHITE = np.array([0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def _kinds() -> np.ndarray:
    """The kind of every Latin-1 character, and of any other at 256."""
    out = np.full(257, _OTHER, np.uint8)
    letter, number = (re.compile(f"[{c}]") for c in classes(256))
    for i in range(256):
        c = chr(i)
        if c.isspace():
            out[i] = _WHITE
        elif letter.match(c):
            out[i] = _LETTER
        elif number.match(c):
            out[i] = _NUMBER
    out[256] = _FOREIGN
    return out


class Known:
    """Ids of known pieces: arrays ordered by a mix of the packed characters."""

    def __init__(self):
        self.mark = np.empty(0, np.uint64)
        self.low, self.high = self.mark, self.mark
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def find(self, mark: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of every piece, -1 where it is not known."""
        if not len(self.mark):
            return np.full(len(mark), -1)
        at = np.minimum(np.searchsorted(self.mark, mark), len(self.mark) - 1)
        return np.where((self.mark[at] == mark) & (self.low[at] == low) & (self.high[at] == high),
                        at, -1)

    def learn(self, mark: np.ndarray, low: np.ndarray, high: np.ndarray, ids: list[bytes]) -> None:
        """Adds pieces, in order of their marks."""
        size = np.array([len(x) // 4 for x in ids], np.int64)
        at = len(self.ids) + np.cumsum(size) - size
        place = np.searchsorted(self.mark, mark)
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(ids), "<u4")))
        self.mark, self.low, self.high, self.at, self.size = (
            np.insert(a, place, b) for a, b in ((self.mark, mark), (self.low, low), (self.high, high),
                                                (self.at, at), (self.size, size)))


class WordCodec:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        special = [x["content"] for x in spec["added_tokens"]]
        alphabet = byte_alphabet()
        # a word's last character stands for itself and the word's end: in the
        # automaton's input the end is one more byte, 0xFF, which UTF-8 never has
        labels: list[bytes | None] = [None] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            if token not in special:
                whole = token.endswith(end) and token != end
                core = token[:-len(end)] if whole else token
                labels[i] = bytes(alphabet[c] for c in core) + (b"\xff" if whole else b"")
        merges = []
        for pair in model["merges"]:
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            merges.append((vocab[u], vocab[v], vocab[u + v]))
        self.automaton = Automaton(labels, merges)
        self.kind = _kinds()
        self.lower = np.array([ord(chr(i).lower()) for i in range(256)] + [0], np.uint8)
        self.odd = re.compile("[\x00\x1c-\x1f]")
        self.forget()

    def forget(self) -> None:
        """Empties the caches: an idle worker holds no words between tasks."""
        self.known, self.words = Known(), {}

    def _by_library(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes()
                for x in self.library.encode_batch(texts, add_special_tokens=False)]

    def _by_automaton(self, pieces: list[str]) -> list[bytes]:
        return self.automaton.encode_words([p.encode() + b"\xff" for p in pieces])

    def _cut(self, kind: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end character of every piece; ``kind`` ends in white space."""
        white = kind == _WHITE
        before = np.concatenate(([np.uint8(_WHITE)], kind[:-1]))
        begin = ~white & ((kind != before) | (kind == _NUMBER))
        stop = begin | (white & (before != _WHITE))
        # a contraction: an apostrophe that begins its piece, with one or two letters after it
        quote = np.flatnonzero(begin & (low == 0x27))
        quote = quote[kind[quote + 1] == _LETTER]
        a, b = low[quote + 1], low[np.minimum(quote + 2, len(low) - 1)]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((b == 0x65) & ((a == 0x72) | (a == 0x76))) | ((a == 0x6C) & (b == 0x6C))
        for at, letters in ((quote[one], 1), (quote[two], 2)):
            begin[at + 1] = stop[at + 1] = False
            more = at + 1 + letters
            begin[more[kind[more] == _LETTER]] = True
            stop[more] = True
        first, ends = np.flatnonzero(begin), np.flatnonzero(stop)
        return first, ends[np.searchsorted(ends, first) + 1]

    def _short(self, low: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The places in ``known`` of short pieces; new ones are learnt."""
        packed = np.zeros((2, len(first)), np.uint64)
        live = np.arange(len(first))
        for j in range(SHORT):
            live = live[size[live] > j]
            packed[j // 8, live] |= low[first[live] + j].astype(np.uint64) << np.uint64(8 * (j % 8))
        mark = mix(packed[0] ^ mix(packed[1]))
        distinct, one, back = np.unique(mark, return_index=True, return_inverse=True)
        a, b = packed[:, one]
        if (a[back] != packed[0]).any() or (b[back] != packed[1]).any():
            raise RuntimeError("two pieces of one mark")     # one mark in 2**64
        new = self.known.find(distinct, a, b) < 0
        if new.any():
            raw = np.ascontiguousarray(packed[:, one[new]].T).tobytes()
            pieces = [raw[i:i + SHORT].rstrip(b"\0").decode("latin-1")
                      for i in range(0, len(raw), SHORT)]
            self.known.learn(distinct[new], a[new], b[new], self._by_automaton(pieces))
        return self.known.find(distinct, a, b)[back]

    def _others(self, words: list[str], plain: bool) -> list[bytes]:
        """Ids of long pieces, or of whole words by the library."""
        new = sorted(set(words) - self.words.keys())
        self.words.update(zip(new, (self._by_automaton if plain else self._by_library)(new)))
        return [self.words[w] for w in words]

    def _chunk(self, texts: list[str]) -> list[bytes]:
        if len(self.known.mark) > MAX_PIECES:
            self.known = Known()
        if len(self.words) > MAX_WORDS:
            self.words = {}
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        latin = np.minimum(points, 256)
        kind, low = self.kind[latin], self.lower[latin]
        foreign = np.flatnonzero(latin == 256)
        kind[foreign[np.isin(points[foreign], _WIDE_WHITE)]] = _WHITE
        # words for the library, whole: blanked out here
        white = kind == _WHITE
        mark = np.flatnonzero((low[:-1] == 0x3C) & (low[1:] == 0x7C))
        held = np.unique(np.concatenate((np.flatnonzero(kind == _FOREIGN), mark)))
        whole = np.empty((2, 0), np.int64)
        if len(held):
            gaps = np.flatnonzero(white)
            after = np.unique(np.searchsorted(gaps, held))
            whole = np.stack((np.where(after > 0, gaps[after - 1] + 1, 0), gaps[after]))
            for a, b in whole.T.tolist():
                kind[a:b] = _WHITE
        first, end = self._cut(kind, low)
        size = end - first
        short = size <= SHORT
        place = self._short(low, first[short], size[short])
        # long pieces and the library's words stand behind the known ones
        cut = lambda spans: [joined[a:b] for a, b in spans]
        long_ = np.stack((first[~short], end[~short]))
        extra = (self._others([p.lower() for p in cut(long_.T.tolist())], True)
                 + self._others(cut(whole.T.tolist()), False))
        extra_size = np.array([len(x) // 4 for x in extra], np.int64)
        pool = np.concatenate((self.known.ids, np.frombuffer(b"".join(extra), "<u4")))
        start = np.concatenate((first[short], long_[0], whole[0]))
        count = np.concatenate((self.known.size[place], extra_size))
        at = np.concatenate((self.known.at[place],
                             len(self.known.ids) + np.cumsum(extra_size) - extra_size))
        order = np.argsort(start, kind="stable")
        start, count, at = start[order], count[order], at[order]
        before = np.concatenate(([0], np.cumsum(count)))
        ids = pool[np.repeat(at - before[:-1], count) + np.arange(before[-1])]
        bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        edge = before[np.searchsorted(start, bounds)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_CHARS):
                size += len(texts[j])
                j += 1
            odd = [k for k in range(i, j) if self.odd.search(texts[k])]
            if odd:
                part = texts[i:j]
                for k in odd:
                    part[k - i] = ""
                done = self._chunk(part)
                for k, ids in zip(odd, self._by_library([texts[k] for k in odd])):
                    done[k - i] = ids
                out += done
            else:
                out += self._chunk(texts[i:j])
            i = j
        return out


@lru_cache(2)
def codec(path: str) -> WordCodec:
    return WordCodec(path)
