import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paddock.llm import bpe, word_ids

from llm.conftest_llm import ODD

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_level():
    return bpe.codec(BYTE), Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_level():
    return word_ids.codec(WORD), Tokenizer.from_file(WORD)


def ids(blobs):
    return [np.frombuffer(b, "<u4").tolist() for b in blobs]


def want(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def odd_texts(seed):
    draw = random.Random(seed)
    letters = "aaab  \n\t'stléßÉÀ漢字🙂́ 1２²_-=..THE in   \x1c\x85 İΣςµªÿ½" + "the and "
    marks = ["<|endoftext|>", "<|startoftext|>"]
    return ["".join(draw.choice(letters) if draw.random() > 0.01 else draw.choice(marks)
                    for _ in range(draw.randint(0, 60))) for _ in range(1500)]


def test_byte_level_ids_and_round_trip(byte_level):
    own, library = byte_level
    texts = [t or "" for t in ODD] + odd_texts(1) + ["a" * 5000, "-" * 700 + "the" * 100, "<|endoftext|>"]
    got = own.encode(texts)
    assert ids(got) == want(library, texts)
    assert [d.decode() for d in own.decode(got)] == [
        library.decode(i, skip_special_tokens=False) for i in ids(got)]


def test_word_level_ids(word_level):
    own, library = word_level
    texts = [t or "" for t in ODD] + odd_texts(2) + ["A'S B'll 'RE", "x<|startoftext|> y"]
    assert ids(own.encode(texts)) == want(library, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_byte_level_any_text(texts):
    own, library = bpe.codec(BYTE), Tokenizer.from_file(BYTE)
    assert ids(own.encode(texts)) == want(library, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("'sStTrReEvVmMlLdD1²!é \0\xa0\u2003漢", max_size=40)),
                max_size=5))
def test_word_level_any_text(texts):
    own, library = word_ids.codec(WORD), Tokenizer.from_file(WORD)
    assert ids(own.encode(texts)) == want(library, texts)


def test_word_caches_start_anew(word_level, monkeypatch):
    own, library = word_level
    monkeypatch.setattr(word_ids, "MAX_PIECES", 50)
    monkeypatch.setattr(word_ids, "MAX_WORDS", 5)
    monkeypatch.setattr(word_ids, "CHUNK_CHARS", 300)
    texts = odd_texts(7)[:200] + ["q" * n for n in range(14, 20)] * 2
    for _ in range(2):
        assert ids(own.encode(texts)) == want(library, texts)
    own.forget()
    assert ids(own.encode(texts)) == want(library, texts) and len(own.words) < 400


def test_decode_of_broken_utf8(byte_level):
    own, library = byte_level
    sequence = np.array([220, 447, 119, 447, 50256, 65], "<u4")
    assert own.decode([sequence.tobytes()])[0].decode() == library.decode(
        sequence.tolist(), skip_special_tokens=False)


def merged(word, ranks):
    """Byte-pair encoding by its definition."""
    parts = list(word)
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not pairs:
            return parts
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_gadgets_on_a_small_vocabulary():
    """All words over a small alphabet, with merges of equal and overlapping parts."""
    from itertools import product
    rules = [("a", "a"), ("b", "a"), ("aa", "aa"), ("a", "b"), ("ab", "ab"), ("ba", "ab"), ("aa", "b")]
    tokens = ["a", "b"] + [u + v for u, v in rules]
    number = {t: i for i, t in enumerate(tokens)}
    machine = bpe.Automaton([t.encode() for t in tokens],
                            [(number[u], number[v], number[u + v]) for u, v in rules])
    ranks = {p: k for k, p in enumerate(rules)}
    words = ["".join(w) for n in range(1, 11) for w in product("ab", repeat=n)]
    got = ids(machine.encode_words([w.encode() for w in words]))
    assert got == [[number[t] for t in merged(w, ranks)] for w in words]


def test_query_rows(docs):
    from hashlib import sha256
    pairs = list(enumerate(ODD)) + [(3, "again"), (3, "again"), (None, "null id")]
    got = {(r.doc_id, r.decoded_sha256): r for r in
           bpe.encode_documents(docs(pairs), BYTE, with_ids=True).collect()}
    library = Tokenizer.from_file(BYTE)
    for i, t in pairs:
        r = got[(i, sha256((t or "").encode()).hexdigest())]
        assert np.frombuffer(r.ids, "<u4").tolist() == want(library, [t or ""])[0]
        assert r.n_tokens == len(r.ids) // 4 and r.ids_sha256 == sha256(r.ids).hexdigest()
    assert bpe.encode_documents(docs([], "none"), BYTE).count() == 0
