"""Broadcast only behind a size bound; spread only when the caller says so."""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from sentimill import session
from sentimill.functions.text import words
from sentimill.operators import counts, model
from sentimill.plans import catalog
from sentimill.sources import lexicon, tables

from tables_of_tests import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_constants_are_broadcast_and_lists_from_files_are_left_to_spark(spark, scratch):
    spark.range(1_500_000).select(F.concat(F.lit("w"), F.col("id")).alias("value")).write.text(f"{scratch}/words")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        words = spark.range(50_000).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
        assert "BroadcastHashJoin" in _plan(counts.drop_words(words, lexicon.stop_words(spark)))
        vocab = lexicon.vocabulary(lexicon.read_common_words(spark, f"{scratch}/words"), lexicon.stop_words_kept(spark))
        docs = spark.range(1_000_000).select(F.col("id").alias("doc_id"), F.lit("w1 w2 w2").alias("text"))
        plan = _plan(model.term_frequency(docs, ["doc_id"], vocab))
        # the terms are not broadcast (only the index's row per partition is), and no single task sorts them
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert model.term_frequency(docs.limit(10), ["doc_id"], vocab).count() == 20
        assert vocab.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first() == (0, 1_500_002, 1_500_003)
        before = vocab.select("term", "idx", F.lag("term").over(
            Window.partitionBy(F.expr("idx div 1000")).orderBy("idx")).alias("prev"))
        assert before.filter("prev >= term").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_only_where_asked(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    held = spark.conf.get(session.SCAN_PARTITIONS, None)
    try:
        spark.conf.unset(session.SCAN_PARTITIONS)
        assert "Exchange" not in _plan(tables.read_table(spark, SF_SMALL, "documents"))
        spark.conf.set(session.SCAN_PARTITIONS, "5")
        assert "hashpartitioning(doc_id" in _plan(tables.read_table(spark, SF_SMALL, "documents"))
    finally:
        spark.conf.unset(session.SCAN_PARTITIONS)
        if held:
            spark.conf.set(session.SCAN_PARTITIONS, held)
    spread = tables.spread(docs, 5, "doc_id")
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in _plan(spread.filter("lang = 'en'").select("text"))


def test_words_are_counted_where_a_group_s_texts_meet(spark):
    """No count of single words is shuffled or held for more than a partition's texts, and hot groups are spread."""
    rows = [(i, f"w{i % 7} the w{i} w{i}") for i in range(0, 400, 5)] + [(7, f"hot w{i % 3}") for i in range(300)]
    rows += [(None, f"nobody w{i % 2}") for i in range(300)] + [(7, None), (8, ""), (9, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id div 20 as batch_id", "text")
    stop = lexicon.stop_words(spark)
    want = counts.drop_words(counts.word_counts(counts.explode_words(docs, words("text"), ["batch_id"]), ["batch_id"]), stop)
    for part_bytes in (1 << 20, 1000, 100):                        # no hot group; two; most
        got = counts.word_counts_by_group(docs, "batch_id", words("text"), stop, part_bytes=part_bytes)
        assert Counter(got.collect()) == Counter(want.collect())
    few = counts.word_counts_by_group(docs.filter("batch_id > 0"), "batch_id", words("text"), stop, part_bytes=1000)
    assert _plan(few).count("Exchange hashpartitioning(batch_id") == 1                 # the texts, once
    for df in (few, catalog.q_word_count_by_batch(spark, SF_SMALL)):
        assert not any("hashpartitioning" in line and "word" in line for line in _plan(df).splitlines())
    assert few.rdd.getNumPartitions() > 1
    none = counts.word_counts_by_group(docs.limit(0), "batch_id", words("text"), stop)
    assert none.columns == ["batch_id", "word", "n"] and none.isEmpty()
