"""Byte-pair encoding by a compiled automaton.

The automaton reads tokens. It starts with one state in which every base symbol
loops. Each merge u + v -> w, in rank order, is compiled in by one gadget:

* (only if some state that u reaches still has the arc v: else the merge is dead)
* state split: the state reached by w is the state v reached until then, shared
  copy-on-write (``right`` and ``born`` say which state, as of which gadget);
* cut: the state reached by u loses its arc v (``cut``: rank of the gadget);
* lay: wherever arc u (followed by v) is present, an arc w is laid beside it
  (``left``), except behind u itself when u = v, where the leftmost pair merges.

After the last gadget a token sequence has a path exactly if byte-pair encoding
produces it, and every string has one such sequence. ``arcs`` decides whether an
arc is present by following the copy-on-write and lay references back; decided
arcs are kept in a transition table (open addressing, grows with use, bounded).

Words are encoded many at a time with numpy: a trie table gives, for every start,
the tokens that end at every position, and from left to right the one candidate
whose arc is present in the state at its start is kept. Each distinct word is
encoded once per worker (bounded cache). Decoding emits the arc labels.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paddock.llm._common import id_and_text

WHITE = "\t-\r \x85\xa0  -     　"
MAX_WORDS = 300_000       # entries of a worker's word cache before it starts anew
MAX_ARCS = 1 << 21        # entries of a worker's transition table before it starts anew
CHUNK_CHARS = 1_500_000   # characters whose pieces are held at once
LONG_WORD = 64            # bytes; longer words are encoded in batches of their own


def classes(below: int) -> tuple[str, str]:
    """Regular-expression ranges of the letters and numbers under a code point."""
    out = {"L": [], "N": []}
    for kind, ranges in out.items():
        start = None
        for c in range(below + 1):
            hit = c < below and unicodedata.category(chr(c))[0] == kind
            if hit and start is None:
                start = c
            elif not hit and start is not None:
                ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
                start = None
    return "".join(out["L"]), "".join(out["N"])


@lru_cache(None)
def splitter(below: int = sys.maxunicode + 1) -> re.Pattern:
    """The byte-level vocabulary's pre-splitting pattern, for texts whose code
    points lie under ``below`` (small character classes match much faster).
    Alternatives that cannot start alike stand in order of frequency."""
    letter, number = classes(below)
    return re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:s|t|re|ve|m|ll|d)"
                      f"| ?[^{WHITE}{letter}{number}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def split_words(text: str) -> list[str]:
    try:
        text.encode("latin-1")
        return splitter(256).findall(text)
    except UnicodeEncodeError:
        return splitter().findall(text)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for
    themselves, the others follow from U+0100 in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Table:
    """Open-addressing map from non-negative int64 keys to int32, in numpy."""

    def __init__(self, bits: int):
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, missing: int = -1) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        found = there == keys
        out = np.where(found, self.values[slot], missing).astype(np.int32)
        todo = np.flatnonzero(~found & (there >= 0))
        while todo.size:
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys are distinct and not yet present."""
        if (self.used + keys.size) * 2 > len(self.keys):
            have = self.keys >= 0
            grown = Table(max(self.bits + 1, int((self.used + keys.size) * 2).bit_length()))
            grown.put(self.keys[have], self.values[have])
            self.bits, self.keys, self.values = grown.bits, grown.keys, grown.values
        self.used += keys.size
        slot = self._slot(keys)
        todo = np.arange(keys.size)
        while todo.size:
            empty = self.keys[slot[todo]] < 0
            ready = todo[empty]
            _, first = np.unique(slot[ready], return_index=True)
            won = ready[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)


class Automaton:
    """``labels``: bytes of every token id, or None for ids that no merge makes.
    ``merges``: (u, v, w) ids in rank order. Base symbols have single-byte labels."""

    def __init__(self, labels: list[bytes | None], merges: list[tuple[int, int, int]]):
        n = len(labels)
        self.n = n
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.born = np.zeros(n, np.int64)
        ranks = self._compile(merges)
        made = {w for _, _, w in merges}
        labels = [x if i not in made or self.born[i] else None for i, x in enumerate(labels)]
        self.cut = Table(18)
        self.cut.put(np.fromiter(ranks, np.int64, len(ranks)),
                     np.fromiter(ranks.values(), np.int32, len(ranks)))
        self.known = Table(16)
        lengths = [len(x) if x else 0 for x in labels]
        self.label_len = np.array(lengths, np.int64)
        self.label_at = np.concatenate(([0], np.cumsum(self.label_len)))[:-1]
        self.label_bytes = np.frombuffer(b"".join(x or b"" for x in labels), np.uint8)
        self._trie(labels)

    def _compile(self, merges: list[tuple[int, int, int]]) -> dict[int, int]:
        """One gadget per merge, in rank order; rank of every cut (state, arc). A merge
        whose pair no path has any more makes no token."""
        n, left, right, born = self.n, {}, {}, {}
        ranks: dict[int, int] = {}
        dead: set[int] = set()

        def present(t: int, x: int, upto: int) -> bool:   # ``arcs`` as of gadget ``upto``
            while True:
                cut = ranks.get(t * n + x, 0)
                if cut and cut <= upto:
                    return False
                a, b = born.get(t, 0), born.get(x, 0)
                if not a and not b:
                    return True
                t, x, upto = ((t, left[x], b) if b > a else (right[t], left[x], a - 1) if a == b
                              else (right[t], x, a - 1))

        for rank, (u, v, w) in enumerate(merges, 1):
            if u in dead or v in dead or not present(u, v, rank - 1):
                dead.add(w)
                continue
            left[w], right[w], born[w], ranks[u * n + v] = u, v, rank, rank
        for table, values in ((self.left, left), (self.right, right), (self.born, born)):
            if values:
                table[list(values)] = list(values.values())
        return ranks

    def _trie(self, labels: list[bytes | None]) -> None:
        arcs: dict[int, int] = {}
        token = [-1]
        for i in sorted((i for i, x in enumerate(labels) if x), key=lambda i: len(labels[i])):
            node = 0
            for b in labels[i]:
                key = node * 256 + b
                node = arcs.get(key, 0)
                if not node:
                    node = arcs[key] = len(token)
                    token.append(-1)
            token[node] = i
        self.trie = Table(19)
        self.trie.put(np.fromiter(arcs, np.int64, len(arcs)),
                      np.fromiter(arcs.values(), np.int32, len(arcs)))
        self.ends = np.array(token, np.int64)
        self.root = self.trie.get(np.arange(256, dtype=np.int64))

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the state reached by ``state`` has an arc ``token`` after the last gadget."""
        t, x = state.copy(), token.copy()
        upto = np.full(t.size, np.iinfo(np.int64).max)
        out, live = np.zeros(t.size, bool), np.arange(t.size)
        while live.size:
            a, b, k = t[live], x[live], upto[live]
            cut = self.cut.get(a * self.n + b, 0)
            ok = (cut == 0) | (cut > k)
            base = (self.born[a] == 0) & (self.born[b] == 0)
            out[live[ok & base]] = True
            go = ok & ~base
            live, a, b = live[go], a[go], b[go]
            born_a, born_b = self.born[a], self.born[b]
            laid = born_b > born_a                       # laid beside its left part's arc
            own = (born_a == born_b)                     # the state's own token
            x[live] = np.where(laid | own, self.left[b], b)
            t[live] = np.where(laid, a, self.right[a])
            upto[live] = np.where(laid, born_b, born_a - 1)
        return out

    def _present(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``arcs`` through the transition table."""
        keys = state * self.n + token
        got = self.known.get(keys)
        new = np.flatnonzero(got < 0)
        if new.size:
            fresh, back = np.unique(keys[new], return_inverse=True)
            value = self.arcs(fresh // self.n, fresh % self.n).astype(np.int32)
            if self.known.used > MAX_ARCS:
                self.known = Table(16)
            self.known.put(fresh, value)
            got[new] = value[back]
        return got == 1

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of every word, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        n_short = int(np.searchsorted(lengths[order], LONG_WORD, "right"))
        groups = [order[i:i + 20_000] for i in range(0, n_short, 20_000)]
        i = n_short
        while i < len(order):   # long words: about as many bytes together
            j = i + max(1, 1_000_000 // int(lengths[order[i]]))
            groups.append(order[i:j])
            i = j
        for g in groups:
            for w, ids in zip(g.tolist(), self._group([words[j] for j in g.tolist()], lengths[g])):
                out[w] = ids
        return out

    def _group(self, words: list[bytes], lengths: np.ndarray) -> list[bytes]:
        at = np.concatenate(([0], np.cumsum(lengths)))
        total = int(at[-1])
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        word_end = np.repeat(at[1:], lengths)
        # trie walk from every byte: (start, end, token) of every token that occurs
        starts, ends, tokens = [], [], []
        pos = np.arange(total)
        node = self.root[data].astype(np.int64)
        depth = 1
        while pos.size:
            tok = self.ends[node]
            hit = tok >= 0
            starts.append(pos[hit])
            ends.append(pos[hit] + depth)
            tokens.append(tok[hit])
            more = pos + depth < word_end[pos]
            pos, node = pos[more], node[more]
            node = self.trie.get(node * 256 + data[pos + depth]).astype(np.int64)
            pos, node = pos[node >= 0], node[node >= 0]
            depth += 1
        start, end, token = map(np.concatenate, (starts, ends, tokens))
        # states after every prefix, by distance from the word's start
        origin = np.repeat(at[:-1], lengths)
        reach = end - origin[start]
        by = np.argsort(reach, kind="stable")
        start, end, token = start[by], end[by], token[by]
        first = start == origin[start]
        bounds = np.searchsorted(reach[by], np.arange(1, int(lengths.max()) + 2))
        last = np.full(total + 1, -1, np.int64)   # token that ends at a position
        came = np.zeros(total + 1, np.int64)      # and where it starts
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s, t = start[lo:hi], token[lo:hi]
            ok = first[lo:hi].copy()              # every token may follow the word's start
            inner = np.flatnonzero(~ok)
            if inner.size:
                ok[inner] = self._present(last[s[inner]], t[inner])
            last[end[lo:hi][ok]], came[end[lo:hi][ok]] = t[ok], s[ok]
        # follow the path back from every word's end
        where, word, step = at[1:].copy(), np.arange(len(words)), 0
        got_word, got_token, got_step = [], [], []
        while word.size:
            got_word.append(word)
            got_token.append(last[where])
            got_step.append(np.full(word.size, -step))
            where = came[where]
            left = where > at[word]
            where, word, step = where[left], word[left], step + 1
        word, token, step = map(np.concatenate, (got_word, got_token, got_step))
        flat = token[np.lexsort((step, word))].astype("<u4").tobytes()
        edge = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words))))) * 4
        edge = edge.tolist()
        return [flat[a:b] for a, b in zip(edge[:-1], edge[1:])]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Labels of ``ids`` one after another, and the length of each."""
        n = self.label_len[ids]
        ends = np.cumsum(n)
        shift = self.label_at[ids] - (ends - n)
        return self.label_bytes[np.repeat(shift, n) + np.arange(int(ends[-1]) if n.size else 0)], n


class ByteLevelCodec:
    """Encode and decode whole texts with a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        alphabet = byte_alphabet()
        labels: list[bytes | None] = [None] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            if token not in special:
                labels[i] = bytes(alphabet[c] for c in token)
        merges = []
        for pair in model["merges"]:
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            merges.append((vocab[u], vocab[v], vocab[u + v]))
        self.automaton = Automaton(labels, merges)
        self.special = special
        self.special_label = {i: s.encode() for s, i in special.items()}
        self.special_ids = np.array(sorted(special.values()), np.int64)
        self.special_pattern = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}    # the cache before it started anew

    def _pieces(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            out, at = [], 0
            for m in self.special_pattern.finditer(text):
                out += split_words(text[at:m.start()])
                out.append(m[0])
                at = m.end()
            return out + split_words(text[at:])
        return split_words(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_CHARS):
                size += len(texts[j])
                j += 1
            pieces = [self._pieces(t) for t in texts[i:j]]
            if len(self.words) > MAX_WORDS:
                self.words, self.older = {}, self.words
            new = set()
            for p in pieces:
                new.update(p)
            fresh = unknown(new, self.words, self.older)
            known = self.words
            known.update(zip(fresh, self.automaton.encode_words(
                [w.encode("utf-8", "surrogatepass") for w in fresh])))
            for s, k in self.special.items():
                known[s] = k.to_bytes(4, "little")
            out += [b"".join(map(known.__getitem__, p)) for p in pieces]
            i = j
        return out

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """UTF-8 of every decoded text; special tokens keep their strings, and
        byte sequences that are no UTF-8 become U+FFFD."""
        out = []
        for group in _groups(encoded, 4 * CHUNK_CHARS):
            ids = np.frombuffer(b"".join(group), "<u4").astype(np.int64)
            flat, n = self.automaton.decode(ids)
            flat = flat.tobytes()
            edge = np.concatenate(([0], np.cumsum(n)))
            at = 0
            for e in group:
                to = at + len(e) // 4
                own = ids[at:to]
                if own.size and np.isin(own, self.special_ids).any():
                    raw = b"".join(self.special_label.get(int(i)) or
                                   flat[edge[at + k]:edge[at + k + 1]] for k, i in enumerate(own))
                else:
                    raw = flat[edge[at]:edge[to]]
                out.append(raw.decode("utf-8", "replace").encode())
                at = to
        return out


def _groups(parts: list[bytes], size: int):
    group, held = [], 0
    for p in parts:
        if group and held + len(p) > size:
            yield group
            group, held = [], 0
        group.append(p)
        held += len(p)
    if group:
        yield group


def unknown(keys: set[str], cache: dict, older: dict) -> list[str]:
    """The keys in neither generation of a cache; those in the older move to the newer."""
    keys = keys.difference(cache)
    back = keys.intersection(older)
    for k in back:
        cache[k] = older[k]
    return sorted(keys.difference(back))


@lru_cache(2)
def codec(path: str) -> ByteLevelCodec:
    """The compiled codec of a vocabulary file; one per worker."""
    return ByteLevelCodec(path)


def _records(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _spans(texts):
                encoded = own.encode(texts[lo:hi])
                decoded = own.decode(encoded)
                cols = {
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                    "ids_sha256": pa.array([sha256(e).hexdigest() for e in encoded], pa.string()),
                    "decoded_sha256": pa.array([sha256(d).hexdigest() for d in decoded],
                                               pa.string())}
                if with_ids:
                    cols["ids"] = pa.array(encoded, pa.binary())
                    cols["decoded"] = pa.array([d.decode() for d in decoded], pa.string())
                yield pa.RecordBatch.from_pydict(cols)
    return run


def _spans(texts: list[str], size: int = 4 * CHUNK_CHARS):
    lo = held = 0
    for i, t in enumerate(texts):
        if i > lo and held + len(t) > size:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if texts:
        yield lo, len(texts)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (ids as
    little-endian unsigned 32-bit integers), decoded_sha256; with ``with_ids``
    also ids (binary, as hashed) and decoded (text).

    ``vocabulary``: path of a byte-level vocabulary file, readable on every worker.
    Defined cases: null text counts as empty (no tokens, empty decoded text);
    repeated rows and null ids pass through; an empty table gives an empty result;
    extra columns are not read. A special token's string in a text becomes that
    token, as the tokenizers library does by default.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids binary, decoded string"
    return id_and_text(docs, id_col, text_col).mapInArrow(_records(vocabulary, with_ids), schema)
