"""Invariants of the operators, independent of any oracle."""

from pyspark.sql import functions as F

from sentimill.operators import counts, history, model
from sentimill.operators.position import with_row_index
from sentimill.plans import catalog
from sentimill.sources import tables

from tables_of_tests import SF_MID, SF_SMALL


def test_positive_plus_negative_is_volume(spark):
    df = catalog.q_sentiment_by_batch(spark, SF_MID)
    assert df.filter(F.col("positive") + F.col("negative") != F.col("volume")).count() == 0


def test_sum_tf_equals_vocabulary_tokens(spark):
    v = catalog.Views(spark, SF_SMALL)
    tf = model.term_frequency(v.english, ["doc_id"], v.vocab).groupBy("doc_id").agg(F.sum("tf").alias("s"))
    sc = v.scored.select("doc_id", "n_tokens")
    joined = sc.join(tf, "doc_id", "left").select("n_tokens", F.coalesce("s", F.lit(0)).alias("s"))
    assert joined.filter(F.col("n_tokens") != F.col("s")).count() == 0


def test_top_words_are_a_subset_of_full_counts(spark):
    top = catalog.q_top_words_by_batch(spark, SF_SMALL).select("batch_id", "word", "n")
    full = catalog.q_word_count_by_batch(spark, SF_SMALL)
    assert top.subtract(full).count() == 0
    # and nothing outside the top beats the 100th word of its batch
    cut = top.groupBy("batch_id").agg(F.min("n").alias("cut"), F.count("*").alias("k"))
    rest = full.join(top, ["batch_id", "word"], "left_anti").join(cut, "batch_id")
    assert rest.filter((F.col("k") == 100) & (F.col("n") > F.col("cut"))).count() == 0


def test_result_unchanged_under_repartitioning(spark):
    docs = tables.read_table(spark, SF_SMALL, "documents")
    eng = tables.keep_english(tables.tweet_view(docs))
    a = counts.word_counts(counts.explode_words(eng, F.split(F.lower("text"), " "), ["batch_id"]),
                           ["batch_id"])
    b = counts.word_counts(counts.explode_words(eng.repartition(17), F.split(F.lower("text"), " "),
                                                ["batch_id"]), ["batch_id"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_index_is_exact_and_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"))  # distinct, scrambled
    idx = with_row_index(df, ["k"])
    rows = idx.orderBy("k").collect()
    assert [r["idx"] for r in rows] == list(range(5000))


def test_row_index_with_skewed_keys(spark):
    # a third of the keys packed into a tiny range, the rest spread far apart
    dense = spark.range(0, 3000).select(F.col("id").alias("k"))
    sparse = spark.range(0, 6000).select((F.col("id") * 1_000_003 + 10_000).alias("k"))
    df = dense.union(sparse)
    rows = with_row_index(df, ["k"]).orderBy("k").select("idx").collect()
    assert [r[0] for r in rows] == list(range(9000))


def test_history_newest_first_and_chronological(spark):
    h = catalog.q_history_short(spark, SF_MID).orderBy("x").collect()
    assert [r["x"] for r in h] == list(range(1, 16))
    starts = [r["batch_start"] for r in h]
    assert starts == sorted(starts)
    allb = catalog.q_sentiment_by_batch(spark, SF_MID)
    newest = [r[0] for r in allb.orderBy(F.desc("batch_start")).limit(15).select("batch_id").collect()]
    assert sorted(newest) == sorted(r["batch_id"] for r in h)


def test_last_per_batch_is_rank_one(spark):
    v = catalog.Views(spark, SF_SMALL)
    last = history.last_per_batch(v.english).select("batch_id", "doc_id")
    first = history.recent_per_batch(v.english).filter("rank = 1").select("batch_id", "doc_id")
    assert last.exceptAll(first).count() == 0 and first.exceptAll(last).count() == 0


def test_zero_vector_is_negative(spark):
    v = catalog.Views(spark, SF_SMALL)
    docs = spark.createDataFrame([(1, "zzzz qqqq"), (2, None)], "doc_id long, text string")
    out = model.score(docs, ["doc_id"], v.weights).collect()
    assert all(r["score"] == 0.0 and r["label"] == 0 and r["n_tokens"] == 0 for r in out)


def test_recent_batches_fall_back_when_newest_has_only_stop_words(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    last = docs.agg(F.max("doc_id")).first()[0]
    extra = spark.createDataFrame(
        [(last + 40, "The and of the.", "en", "srcx", 15)],
        "doc_id long, text string, lang string, source string, n_chars long")
    folder = f"{scratch}/sf"
    docs.unionByName(extra).write.parquet(f"{folder}/documents.parquet")
    v = catalog.Views(spark, folder)
    fast = catalog.q_latest_word_count(spark, folder)
    full = history.latest(v.top_by_batch(v.stop)).select("batch_id", "word", "n", "rank")
    assert fast.exceptAll(full).count() == 0 and full.exceptAll(fast).count() == 0
    # the stop-word-only batch is skipped: the newest non-empty batch is an older one
    assert fast.select("batch_id").distinct().first()[0] < (last + 40) // 20
    # without a stop list the newest batch is the stop-word-only one
    nostop = v.recent_top(None, 1).select("batch_id").distinct().collect()
    assert [r[0] for r in nostop] == [(last + 40) // 20]
    long_fast = catalog.q_long_term_word_count(spark, folder)
    long_full = history.long_term_words(v.top_by_batch(v.stop))
    assert long_fast.exceptAll(long_full).count() == 0 and long_full.exceptAll(long_fast).count() == 0


def test_row_index_splits_a_hot_first_key(spark):
    # a third of the rows share one first-key value; the second key orders them
    hot = spark.range(0, 3000).select(F.lit(5).alias("a"), F.col("id").alias("b"))
    rest = spark.range(0, 6000).select((F.col("id") + 10).alias("a"), F.lit(0).alias("b"))
    df = hot.union(rest)
    idx = with_row_index(df, ["a", "b"])
    rows = idx.orderBy("a", "b").select("idx").collect()
    assert [r[0] for r in rows] == list(range(9000))
    # the ranges go by both columns: the hot value is spread over several tasks
    ranged = df.repartitionByRange(8, "a", "b").groupBy(F.spark_partition_id().alias("p")).count()
    assert ranged.agg(F.max("count")).first()[0] < 2000
