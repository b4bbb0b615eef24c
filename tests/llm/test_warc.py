import gzip
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import types as T

from paddock.llm import warc as W

PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                     T.StructField("html", T.StringType()), T.StructField("digest", T.StringType())])


@pytest.fixture(scope="module")
def pages():
    draw = random.Random(4)
    big = ["<p>" + "".join(draw.choice("abé漢\r\n ") for _ in range(1500)) for _ in range(6)]
    rows = [(i, f"http://x.org/{i} a\r\nb", draw.choice([*big, "small", "", None, "<p>%d" % i])) for i in range(80)]
    return [(*r, "extra") for r in rows + [(None, None, big[0]), (None, "u", "tiny"), (7, "again", rows[7][2]),
                                           (7, "again", rows[7][2]), (900, "u", "é" * 600_000)]]


def expected(pages):
    last = {}
    for i, _, h, _ in pages:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            last[b] = max(last.get(b, i), i)
    return last


def test_round_trip_and_revisits(spark, stored, pages):
    table = stored(pages, PAGE, "pages", 3)
    manifest = W.write_archives(table, file_bytes=20_000)
    normal = W.normalise(manifest)
    assert normal.count() == manifest.count() > 3
    rows = W.read_archives(normal, with_payload=True).collect()
    assert len(rows) == len(pages)
    last = expected(pages)
    text = {}
    for i, u, h, _ in pages:
        text.setdefault(i, set()).add((h or "").encode())
    seen = set()
    for r in rows:
        if r.record_type == "response":
            assert r.payload in text[r.page_id]
            assert r.payload_digest == hashlib.sha1(r.payload).hexdigest()
            assert r.payload_bytes == len(r.payload) and r.refers_to is None
            if len(r.payload) >= 1000:
                assert r.payload not in seen and last[bytes(r.payload)] == r.page_id
                seen.add(bytes(r.payload))
        else:
            whole = next(b for b in text[r.page_id] if hashlib.sha1(b).hexdigest() == r.payload_digest)
            assert r.payload is None and r.payload_bytes == len(whole) >= 1000
            assert r.refers_to == last[whole]
    assert seen == set(last)


def test_members_stand_at_their_offsets(spark, stored, pages):
    import json
    for row in W.normalise(W.write_archives(stored(pages, PAGE, "pages", 2))).collect():
        store, at = W._store(row.path)
        data = store.open_input_stream(at, compression=None).read()
        entries = [json.loads(x) for x in
                   store.open_input_stream(W._store(row.index_path)[1], compression=None).read().splitlines()]
        assert len(entries) == row.n_records and sum(e["length"] for e in entries) == len(data)
        for e in entries:
            member = zlib.decompress(data[e["offset"]:e["offset"] + e["length"]], 31)
            assert member.startswith(b"WARC/1.0") and e["id"].encode() in member
        assert gzip.decompress(data).count(b"WARC/1.0\r\n") == row.n_records


def test_monolithic_files_are_one_member(spark, stored, pages):
    for row in W.write_archives(stored(pages, PAGE, "pages", 1)).collect():
        store, at = W._store(row.path)
        data = store.open_input_stream(at, compression=None).read()
        z = zlib.decompressobj(31)
        z.decompress(data)
        assert z.eof and not z.unused_data


def test_streams_in_any_pieces():
    recs = [W.record(i, i, "u", b"x" * n, hashlib.sha1(b"x" * n).hexdigest(), False, None)
            for i, n in enumerate([0, 1, 5000, 70_000])]
    for size in (1, 7, 1000, 1 << 20):
        packed = io.BytesIO(gzip.compress(b"".join(recs[:2])) + gzip.compress(b"".join(recs[2:])))
        assert list(W.split_records(W.inflated(packed, size))) == recs


def test_damage_is_reported():
    rec = W.record(1, 1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), False, None)
    with pytest.raises(ValueError):
        W.parse(rec.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(W.split_records(iter([rec[:-3]])))
    with pytest.raises(ValueError):
        list(W.inflated(io.BytesIO(gzip.compress(rec)[:-5])))


def test_no_rows(spark, stored):
    empty = W.write_archives(stored([], PAGE, "none", 1))
    assert W.read_archives(W.normalise(empty)).count() == 0
