import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sentimill.llm import exact_dedup as e


def brute(rows):
    """(doc_id, keep_id, group_size, sha) of every row, and the number of groups."""
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    out = Counter()
    for r in rows:
        ids = groups[r.text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out[r.doc_id, keep, len(ids), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    return out, len(groups)


@pytest.mark.parametrize("key,bucket_keys", [(e.text_key, e.BUCKET_KEYS), (lambda c: F.length(c) % 3, 2)],
                         ids=["hash", "every key chained"])
def test_equals_brute_force(odd_docs, odd_rows, key, bucket_keys):
    found = e.exact_dedup(odd_docs, key, bucket_keys).collect()
    want, groups = brute(odd_rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)      # one row of every group stays


def test_stage_keeps_one_row_of_each_text(odd_docs, odd_rows):
    out = e.keep_first_copies(odd_docs)
    assert out.columns == odd_docs.columns
    assert Counter(r.text or "" for r in out.collect()) == Counter({r.text or "" for r in odd_rows})


def test_empty_table(no_docs):
    assert e.exact_dedup(no_docs).collect() == []
    assert e.keep_first_copies(no_docs).collect() == []


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    entries = spark.range(2000).select(F.xxhash64("id").alias("key"))
    table = e.directory(entries, bucket_keys=100)
    rows = table.rows.collect()
    assert [r.cell for r in sorted(rows)] == list(range(1 << table.bits))        # every cell has a bucket
    cells = Counter((r.key >> (64 - table.bits)) & ((1 << table.bits) - 1) for r in entries.collect())
    filled = Counter()
    for r in rows:
        filled[r.bucket] += cells[r.cell]
        # a bucket of local depth d has 2^(bits - d) cells
        assert sum(x.bucket == r.bucket for x in rows) == 1 << (table.bits - r.depth)
    assert max(filled.values()) <= 100


def test_hot_text_and_no_python(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = e.exact_dedup(docs)
    assert out.filter("kept").count() == 2001
    assert out.filter("text_sha256 = sha2('hot', 256)").select("keep_id", "group_size").distinct().collect() == [(2997, 1000)]
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
