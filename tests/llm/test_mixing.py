import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentimill.llm import mixing as m


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 40))
def test_permutation(n, key):
    assert (np.sort(m.permuted(np.arange(n), n, key)) == np.arange(n)).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
def test_targets(sizes):
    weights = [m.WEIGHTS[i % 3] for i in range(len(sizes))]
    out = m.targets(sizes, weights)
    assert abs(sum(out) - sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert all(t <= 3 * n + 1e-9 for t, n in zip(out, sizes))
    open_ = [t / w for t, n, w in zip(out, sizes, weights) if t < 3 * n - 1e-9]      # all that are not stopped share by weight
    assert not open_ or max(open_) - min(open_) < 1e-6 * max(open_)
    if open_:
        assert all(t / w <= max(open_) * (1 + 1e-9) for t, w in zip(out, weights))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=8), st.integers(1, 20))
def test_shards_add_up(slots, shards):
    drawn = m.draw_shards(slots, shards)
    assert drawn.sum(axis=0).tolist() == slots and np.ptp(drawn.sum(axis=1)) <= 1


def check(docs, near):
    report, rows = m.mix_report(docs).collect(), docs.select("doc_id", "text", "source").collect()
    size = lambda t: len(re.findall(m.WORD, t or ""))
    assert Counter((r.doc_id, r["size"]) for r in report) == Counter((r.doc_id, size(r.text)) for r in rows)
    by_source = defaultdict(int)
    for r in rows:
        by_source[r.source] += size(r.text)
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    want = m.targets([by_source[s] for s in names], [m.WEIGHTS[i % 3] for i in range(len(names))])
    key = Counter((by_source[s], round(t, 6)) for s, t in zip(names, want))
    got = {(r.source_size, round(r.target, 6)) for r in report}
    assert got <= set(key)
    taken = defaultdict(int)
    for r in report:
        assert r.taken <= 3 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    for (n, target), words in taken.items():
        times = key[n, target]
        assert abs(words - times * target) <= times * (near * target + 1)
    return report


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    report = check(docs, 0.01)
    again = m.mix_report(docs.repartition(7)).collect()                       # reruns agree, however rows are dealt
    assert Counter(map(tuple, report)) == Counter(map(tuple, again))


def test_odd_documents(odd_docs, no_docs):
    check(odd_docs, 0.05)
    assert m.mix_report(no_docs).collect() == [] and m.mixed_documents(no_docs).collect() == []


def test_hot_source(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 40).cast("int")).alias("text"),
                                    F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    check(docs, 0.01)


def test_documents_carry_the_words_taken(spark, odd_docs):
    count = lambda t: len(re.findall(m.WORD, t or ""))
    for docs in (spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), odd_docs):
        out = m.mixed_documents(docs)
        assert out.columns == docs.columns
        words, taken = Counter(), Counter()
        for r in out.collect():
            words[r.doc_id] += count(r.text)
            assert r.n_chars is None or r.n_chars == len(r.text)
        for r in m.mix_report(docs).collect():
            taken[r.doc_id] += r.taken
        assert +words == +taken


def test_small_sources_meet_their_targets(spark):
    docs = spark.createDataFrame([(i, "w " * 20, f"s{i % 3}") for i in range(9)] + [(100, "one", "t"), (101, "two words", None)],
                                 "doc_id long, text string, source string")
    report = check(docs, 0.0)
    for own in ({r.doc_id: r.taken for r in report if r.doc_id % 3 == k and r.doc_id < 100} for k in range(3)):
        assert sum(own.values()) > 0
    three = docs.filter("doc_id < 100")
    got = defaultdict(int)
    for r in m.mix_report(three).collect():
        got[r.doc_id % 3] += r.taken
    assert dict(got) == {0: 30, 1: 60, 2: 90}


def image(index, n, key):
    """The permutation, one index at a time, in plain integers."""
    half, mask = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2), (1 << 64) - 1
    while True:
        left, right = index >> half, index & ((1 << half) - 1)
        for turn in range(6):
            x = (right + (key * 6 + turn) * 0x9E3779B97F4A7C15) & mask
            x ^= x >> 30
            x = x * 0xBF58476D1CE4E5B9 & mask
            x ^= x >> 27
            x = x * 0x94D049BB133111EB & mask
            x ^= x >> 31
            left, right = right, left ^ x & ((1 << half) - 1)
        index = left << half | right
        if index < n:
            return index


def test_taken_equals_a_plain_loop_over_slots(spark, odd_docs):
    """Word by word: every slot of every source, its block, and the document that each word of the block is in."""
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    for docs in (some, odd_docs.select("doc_id", "text", "source")):
        mix = m.mix(docs)
        rows, want = mix.rows.collect(), Counter()
        for s in mix.sources.collect():
            stream, at = [], 0
            for r in sorted((r for r in rows if r.source_no == s.source_no and r["size"]), key=lambda r: r["at"]):
                assert r["at"] == at                       # documents follow one another without a gap
                stream += [(r.doc_id, r["at"])] * r["size"]
                at += r["size"]
            assert len(stream) == s.source_size
            for slot in range(s.slots):
                block = image(slot % s.blocks, s.blocks, m.SEED + 1000 * s.source_no + slot // s.blocks)
                for doc_id, _ in stream[block * s.block_words:(block + 1) * s.block_words]:
                    want[doc_id] += 1
        got = Counter()
        for r in m.mix_report(docs).collect():
            got[r.doc_id] += r.taken
        assert +got == +want


def test_slots_are_blocks_by_permutation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mix = m.mix(docs, block_words=32, shards=4)
    slots, sources = mix.slots.collect(), {s.source_no: s for s in mix.sources.collect()}
    per = Counter(s.source_no for s in slots)
    assert all(per[n] == s.slots for n, s in sources.items())
    for no, s in sources.items():
        times = Counter(x.block for x in slots if x.source_no == no)
        assert max(times.values()) - min(times.get(b, 0) for b in range(s.blocks)) <= 1     # every pass takes a block once


def test_taken_texts():
    parts = [{"first": 0, "end": 2, "taken": 1}, {"first": 2, "end": 4, "taken": 2}, {"first": 4, "end": 5, "taken": 2}]
    assert m.taken_texts(" a  b c\nd e ", 5, parts) == [" a  b c\nd e ", "c\nd e"]
    assert m.taken_texts("a b c", 3, [{"first": 0, "end": 1, "taken": 1}, {"first": 2, "end": 3, "taken": 1}]) == ["a c"]
