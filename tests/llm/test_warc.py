import base64
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentimill.llm import warc as w
from sentimill.llm.common import folder

SCHEMA = "page_id long, url string, html string, sha string, file string, revisit string"
ODD = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "http://b\r\nWARC-Type: fake", None),
       (5, "", ""), (6, "http://ü/é", "é\r\n\r\nWARC/1.1\r\n\r\n🙂"), (7, "u", "z" * 200_000), (7, "u", "z" * 200_000), (8, "http://%0A", "\x00\x1f"),
       (None, "u", "only null id"), (None, "u", "<p>x</p>")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in ODD], SCHEMA).repartition(3)


def brute(rows):
    top = {}
    for i, _, h in rows:
        ids = top.setdefault(h or "", [])
        ids.append(i)
    out = Counter()
    for i, _, h in rows:
        data, ids = (h or "").encode(), [x for x in top[h or ""] if x is not None]
        first = max(ids, default=None)
        kind = ("response", None) if i == first else ("revisit", first)
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *kind] += 1
    return out


def key(r):
    return r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to


def test_round_trip(pages):
    assert Counter(map(key, w.archive_round_trip(pages).collect())) == brute(ODD)


def test_payloads_and_index(spark, pages):
    to = folder(spark, "warc-test")
    index = w.write_archives(pages, to)
    rows = index.collect()
    assert Counter((r.page_id, r.url) for r in rows) == Counter((i, u) for i, u, _ in ODD)
    store, base = w.filesystem(to)
    for r in rows:                                            # each record is a member of its own, one after the other
        with store.open_input_file(f"{base}/{r.file}") as f:
            headers, payload = w.parse(w.zlib.decompress(f.read_at(r.length, r.offset), 31))
        assert headers["WARC-Payload-Digest"] == "sha1:" + r.payload_digest and headers["WARC-Type"] == r.record_type
    got = Counter((r.page_id, r.payload) for r in w.read_records(index.filter("record_type = 'response'"), to).collect())
    top = {}
    for i, _, h in ODD:
        top[h or ""] = max((x for x in (top.get(h or ""), i) if x is not None), default=None)
    assert got == Counter((i, (h or "").encode()) for i, _, h in ODD if top[h or ""] == i) and (None, b"only null id") in got
    some = w.read_records(index.filter("page_id in (6, 8)"), to).collect()
    assert {r.page_id for r in some} == {6, 8}


def test_damage_is_noticed(spark, pages):
    to = folder(spark, "warc-test")
    index = w.write_archives(pages.filter("page_id = 6"), to)
    row = index.first()
    store, base = w.filesystem(to)
    data = w.record(6, "u", b"payload", None, False).replace(b"payload", b"paylord")
    with store.open_output_stream(f"{base}/{row.file}", compression=None) as f:
        f.write(pack := w.zlib.compress(data, wbits=31))
    with pytest.raises(Exception, match="does not match its digest"):
        w.read_records(index.withColumn("offset", F.lit(0).cast("long")).withColumn("length", F.lit(len(pack)).cast("long")), to).collect()


def test_small_payloads_are_responses(pages):
    rows = w.with_revisits(pages, least_bytes=100).collect()
    assert not any(r.revisit for r in rows)


def test_hot_payload(spark):
    rows = [(i, "u", "hot" if i % 3 == 0 else str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert Counter(map(key, w.archive_round_trip(df).collect())) == brute(rows)


def test_empty_table(spark):
    assert w.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ranges_coalesce_near_records():
    rows = [(1, "a", 0, 10), (2, "a", 10, 10), (3, "a", 50, 10), (4, "a", 500, 10), (5, "b", 510, 10)]
    assert [(f, a, b, len(r)) for f, a, b, r in w.ranges(rows, gap=40, most=1000)] == [("a", 0, 60, 3), ("a", 500, 510, 1), ("b", 510, 520, 1)]
    assert [b - a for _, a, b, _ in w.ranges(rows[:3], gap=40, most=30)] == [20, 10]
