import random
import re
from hashlib import sha256

import numpy as np
import pytest

from paddock.llm import crf, pii

from llm.conftest_llm import ODD


def brute(text):
    """The contract's patterns, literally."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 16 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out)


@pytest.fixture(scope="module")
def tagger():
    return pii.Tagger(*pii.trained())


def test_patterns_against_definition():
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab.@-+ 0123456789%()\n") for _ in range(90)) for _ in range(3000)]
    texts += ["4111111111111111, 4111-1111 1111 1111", "a@b@c.d.e@f.g", "é@a.b", "x" * 300 + "@",
              "@@a.b c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "a@b.c@d.e", "+1 (988) 555-2485"]
    texts += [t or "" for t in ODD]
    for t in texts:
        assert sorted(pii.base_spans(t)[0]) == brute(t)


def test_field_adds_what_patterns_miss(tagger):
    text = "write jane[at]mail.example.com or call (988) 555-2485 now"
    assert tagger.spans([text]) == [[("email", 6, 30), ("phone", 39, 53)]]
    plain = ["The order of 1984, 12.5 and v2.", "a b c", "", "password=b7db7aa4a5fcc78305 x"]
    assert tagger.spans(plain) == [[], [], [], []]


def test_skipping_quiet_lines_changes_nothing(tagger):
    """Decoding every line gives the spans that the bound allows to skip."""
    table = [re.sub(r"\[(\w+):((?:[^\[\]]|\[at\])*)\]", r"\2", s) for s in pii.labelled_table()]
    text = "\n".join(table) + "\n" + "nothing here at all\n" * 5
    want = tagger.spans([text])
    need, tagger.need = tagger.need, float("inf")
    try:
        assert tagger.spans([text]) == want
    finally:
        tagger.need = need


def test_held_out_sentences_are_labelled(tagger):
    right = total = 0
    for sentence in pii.labelled_table(4, seed=99):
        words, tags = pii.Tagger._parse(sentence)
        types = np.array([tagger.numbers(words)])
        tagger._refresh()
        e = crf.emissions(types, np.array([len(words)]), *tagger.tables)
        got = crf.viterbi(e, np.array([len(words)]), tagger.model.start, tagger.model.step)[0]
        right += sum(tagger.LABELS[g] == t for g, t in zip(got, tags))
        total += len(tags)
    assert right >= 0.97 * total


def test_viterbi_against_all_paths():
    from itertools import product
    draw = np.random.default_rng(1)
    e, lengths = draw.normal(size=(20, 5, 3)), draw.integers(1, 6, 20)
    start, step = draw.normal(size=3), draw.normal(size=(3, 3))
    got = crf.viterbi(e, lengths, start, step)
    for i, n in enumerate(lengths):
        def score(p):
            return start[p[0]] + sum(e[i, t, p[t]] for t in range(n)) + sum(
                step[a, b] for a, b in zip(p, p[1:]))
        best = max(product(range(3), repeat=int(n)), key=score)
        assert tuple(got[i, :n]) == best


def test_training_gradient_finds_a_separable_rule():
    features = np.array([[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]])
    seqs, tags = [[0, 1, 0], [1, 1], [0], [1]] * 3, [[0, 1, 0], [1, 1], [0], [1]] * 3
    m = crf.train(seqs, tags, features, 2, np.ones((2, 2), bool), np.ones(2, bool))
    tables = [features @ r for r in (m.own, m.before, m.after)]
    for s, t in zip(seqs, tags):
        e = crf.emissions(np.array([s]), np.array([len(s)]), *tables)
        assert crf.viterbi(e, np.array([len(s)]), m.start, m.step)[0].tolist() == t


def test_rows_and_redaction(docs, tagger):
    pairs = list(enumerate(ODD)) + [(50, "a.b@c.example.org 10.0.0.1, +1 (988) 555-2485, 4111 1111 1111 1111"),
                                    (50, "a.b@c.example.org 10.0.0.1, +1 (988) 555-2485, 4111 1111 1111 1111"),
                                    (None, "x@y.zz"), (51, "plain text")]
    table = docs(pairs)
    rows = pii.find(table).collect()
    assert len(rows) == len(pairs)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, r)
    for i, t in pairs:
        own = pii.listed(brute(t or ""))
        assert by[i].base_sha256 == sha256(own.encode()).hexdigest()
        assert set(filter(None, own.split(","))) <= set(by[i].spans.split(","))
    r = by[50]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    clean = {r.doc_id: r.text for r in pii.redact(table).collect()}
    assert clean[50] == "<EMAIL> <IP>, <PHONE>, <CARD>" and clean[None] == "<EMAIL>"
    assert clean[51] == "plain text" and clean[0] is None and clean[1] == ""
    assert pii.redact(table).columns == table.columns
    assert pii.find(docs([], "none")).count() == 0


def test_masking_of_overlapping_spans():
    assert pii.masked("0123456789", [("card", 2, 6), ("phone", 1, 4), ("ip", 8, 9)]) == "0<PHONE>67<IP>9"
