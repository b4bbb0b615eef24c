import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from paddock.llm import packing

from llm.conftest_llm import ODD

WORD = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("capacity,n,longest", [(2048, 5000, 2600), (2048, 300, 2048), (64, 900, 64),
                                                (10, 7, 10), (100, 2000, 30), (5, 0, 5), (7, 50, 1)])
def test_plan_places_every_piece_once(capacity, n, longest):
    draw = random.Random(n)
    lengths = [min(capacity, draw.randint(1, longest)) for _ in range(n)]
    plan = packing.plan(Counter(lengths), capacity)
    placed = Counter()
    for used, times in plan:
        assert times > 0 and 0 < sum(used) <= capacity
        for x in used:
            placed[x] += times
    assert placed == Counter(lengths)
    bound = max(-(-sum(lengths) // capacity), sum(2 * x > capacity for x in lengths))
    assert sum(t for _, t in plan) <= 1.02 * bound + 2


def test_plan_finds_exact_complements():
    plan = packing.plan({60: 3, 40: 3, 50: 2, 25: 4, 30: 1}, 100)
    assert sum(t for _, t in plan) == 6 and sum(sum(u) == 100 for u, _ in plan) >= 3


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_places(docs, capacity):
    draw = random.Random(3)
    words = "the and of Résumé naïve 漢字 12 it's end.".split()
    pairs = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 80)))) for i in range(120)]
    pairs += [(500 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (0, pairs[0][1])]
    library = Tokenizer.from_file(WORD)
    rows = packing.pack_documents(docs(pairs), WORD, capacity, with_ids=True)
    got = rows.toPandas()
    want = Counter()
    for i, t in pairs:
        enc = library.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(enc), capacity)):
            part = np.array(enc[at:at + capacity], "<u4").tobytes()
            want[(i, piece, at, len(part) // 4, zlib.crc32(part))] += 1
    ids = [None if np.isnan(x) else int(x) for x in got.doc_id.astype(float)]
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == want
    held = defaultdict(list)
    for r in got.itertuples():
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    joined = packing.sequences(rows).toPandas()
    assert len(joined) == len(held) and (joined.ids.map(len) == 4 * joined.n_tokens).all()


def test_no_rows(docs):
    assert packing.pack_documents(docs([]), WORD).count() == 0
