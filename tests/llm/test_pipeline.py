from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from sentimill.llm import common, exact_dedup, mixing, pieces, quality, queries, simhash

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_stages_one_by_one(spark):
    """Each stage on its own input, against the operator's report."""
    docs = common.read(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece"]
    good = common.written(stages["quality"](spark, docs, SF), "t")
    labels = common.read(spark, SF, "labels")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
    first = common.written(stages["exact_dedup"](spark, good, SF), "t")
    assert Counter(r.doc_id for r in first.collect()) == Counter(r.doc_id for r in exact_dedup.exact_dedup(good).collect() if r.kept)
    one = common.written(stages["simhash_near_dedup"](spark, first, SF), "t")
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in simhash.near_dedup(first).collect()}
    mixed = common.written(stages["mix_sources"](spark, one, SF), "t")
    for df in (good, first, one, mixed):
        assert df.columns == docs.columns
    words = Counter()
    for r in mixed.select("doc_id", F.regexp_count("text", F.lit(mixing.WORD)).alias("n")).collect():
        words[r.doc_id] += r.n
    assert words == Counter({r.doc_id: r.taken for r in mixing.mix_report(one).collect() if r.taken})
    out = stages["sentencepiece"](spark, mixed, SF)
    decoded = Counter((r.doc_id, r.text) for r in pieces.decode(out).collect())
    assert decoded == Counter((r.doc_id, r.text) for r in mixed.collect())
    whole = corpus_pipeline.run(spark, SF)
    rows = lambda df: Counter((r.doc_id, tuple(r.pieces), r.lossless) for r in df.collect())
    assert rows(whole) == rows(out)                         # the chain gives the same, and so does a rerun


def test_odd_and_empty_documents_go_through_all_stages(spark, odd_docs, no_docs, tmp_path):
    labels = "doc_id long, quality int, toxic int"
    for name, docs, marks in (("odd", odd_docs, [(0, 1, 0), (3, 1, 0), (5, 0, 0), (None, 1, None), (7, None, 1), (3, 1, 0)]), ("none", no_docs, [])):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(marks, labels).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r.lossless for r in rows) and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
        assert bool(rows) == (name == "odd")
    assert spark.read.parquet(f"{tmp_path}/odd/documents.parquet").count() == odd_docs.count()       # what came from outside stays


def test_bitmap_never_misses(spark):
    keys = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("key"))
    seen = common.seen_in(spark.range(3000), F.xxhash64("id"), keys).collect()
    assert all(r.__sm_seen if hasattr(r, "__sm_seen") else r["__sm_seen"] for r in seen if r.id % 3 == 0)
    assert sum(r["__sm_seen"] for r in seen) < 1300
    left = common.without_rows(spark.range(3000), F.xxhash64("id"), keys)
    assert left.columns == ["id"] and sorted(r.id for r in left.collect()) == [i for i in range(3000) if i % 3]


def test_hot_keys_join(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 4000, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = common.hot_keys(left, "k")
    assert 7 in {r.k for r in hot.collect()} and hot.count() <= common.HOT_SHARE
    rows = Counter(map(tuple, common.join_spread(left, right, "k", hot).select("id", "k", "v").collect()))
    assert rows == Counter(map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()))


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    edges = rng.integers(0, 300, (220, 2)).tolist()
    par = list(range(300))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in edges:
        par[max(find(a), find(b))] = min(find(a), find(b))
    nodes = spark.range(300).select(F.col("id").alias("node"), F.col("id").alias("label"))
    links = spark.createDataFrame(edges, "root long, member long")
    assert {r.node: r.label for r in common.components(nodes, links).collect()} == {i: find(i) for i in range(300)}
