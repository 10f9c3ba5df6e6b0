"""Term frequencies, the linear sentiment score and logistic-regression training.

Scoring is plain SQL: explode the tokens, hash-join the weight table (one
row per vocabulary term, broadcast) on the term, and sum per document.  All tokens of a document sit
in one partition, so the partial aggregate leaves one row per document for the
shuffle.  A document with no vocabulary token keeps its row (outer explode and
left join) and scores 0, which is negative, as the reference's predict does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tweet_tokens

ROW = "_row"


def doc_tokens(docs: DataFrame, keys: list[str] | tuple, text_col: str = "text") -> DataFrame:
    """(keys..., token) for every token of the cleaned text, in order, duplicates kept."""
    return docs.select(*keys, F.explode(tweet_tokens(text_col)).alias("token"))


def vocab_tokens(docs: DataFrame, keys: list[str] | tuple, allowed: DataFrame,
                 text_col: str = "text") -> DataFrame:
    """Tokens kept by set membership in ``allowed`` (common words + placeholders)."""
    allowed = allowed.select(F.col(allowed.columns[0]).alias("token"))
    return doc_tokens(docs, keys, text_col).join(allowed, "token", "left_semi")


def term_frequency(docs: DataFrame, keys: list[str] | tuple, vocab: DataFrame,
                   text_col: str = "text") -> DataFrame:
    """(keys..., term, idx, tf): the sparse term-frequency vector in long form."""
    toks = doc_tokens(docs, keys, text_col).withColumnRenamed("token", "term")
    return (toks.join(vocab.select("term", "idx"), "term")
            .groupBy(*keys, "term", "idx").agg(F.count(F.lit(1)).alias("tf")))


def score(docs: DataFrame, keys: list[str] | tuple, weights: DataFrame,
          text_col: str = "text") -> DataFrame:
    """(keys..., score, n_tokens, label): ``score = w · tf``, ``label = score > 0``.

    One result per input row: rows with equal or null keys are not merged.
    The stored intercept is not used, as in the reference's streaming model.
    """
    numbered = docs.withColumn(ROW, F.monotonically_increasing_id())
    toks = numbered.select(*keys, ROW, F.explode_outer(tweet_tokens(text_col)).alias("term"))
    joined = toks.join(weights.select("term", "weight"), "term", "left")
    agg = joined.groupBy(*keys, ROW).agg(
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("score"),
        F.count("weight").alias("n_tokens"))
    return agg.drop(ROW).withColumn("label", (F.col("score") > 0).cast("int"))


def with_sentiment(scored: DataFrame) -> DataFrame:
    """Mean weight per vocabulary token, in [-1, 1] for weights in [-1, 1]; 0 without tokens."""
    return scored.withColumn(
        "sentiment",
        F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens")).otherwise(F.lit(0.0)))


def label_from_rating(rating) -> F.Column:
    """0 when the rating is 0, else 1 (a missing rating is 1)."""
    r = F.col(rating) if isinstance(rating, str) else rating
    return F.when(r == 0, F.lit(0)).otherwise(F.lit(1))


def training_rows(labelled: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, label, tokens) for the vectoriser.

    The vectoriser counts only vocabulary terms, and the vocabulary is a subset
    of the common words, so filtering the tokens first would not change a
    vector: the row stays whole and narrow, with no join and no shuffle.
    """
    return labelled.select(
        key,
        label_from_rating("sentiment").alias("label"),
        tweet_tokens("text").alias("tokens"))


def fit_logistic(rows: DataFrame, vocab: DataFrame, max_iter: int = 100, reg: float = 0.01,
                 partitions: int | None = None):
    """Binary logistic regression without intercept on term frequencies.

    Same objective as the reference's trainer (L2 0.01, no intercept, 100
    iterations); Spark ML's L-BFGS reaches a lower loss than plain SGD.
    The classifier holds the vocabulary and a weight per term on the driver, as
    any dense linear model does.  ``partitions``: spread the rows anew (else they stay
    as they are).  Returns ``(weights DataFrame(term, idx, weight), intercept)``.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    terms = [r["term"] for r in vocab.orderBy("idx").select("term").collect()]
    vectoriser = CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="features")
    data = vectoriser.transform(rows).select(F.col("label").cast("double").alias("label"), "features")
    # each of the ~100 iterations is a job over every partition: kept in memory, as they are
    data = (data.repartition(partitions) if partitions else data).persist()
    try:
        lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=0.0,
                                fitIntercept=False, standardization=False, family="binomial")
        model = lr.fit(data)
    finally:
        data.unpersist()
    coefficients = model.coefficients.toArray().tolist()
    spark = rows.sparkSession
    weights = spark.createDataFrame(
        [(t, i, float(w)) for i, (t, w) in enumerate(zip(terms, coefficients))],
        "term string, idx int, weight double")  # one row per vocabulary term
    return weights, float(model.intercept)


def save_model(weights: DataFrame, intercept: float, path: str) -> None:
    """Weights by term (Parquet) and the intercept beside them."""
    weights.write.mode("overwrite").parquet(f"{path}/weights")
    weights.sparkSession.createDataFrame([(intercept,)], "intercept double") \
        .write.mode("overwrite").parquet(f"{path}/intercept")


def load_model(spark, path: str):
    weights = spark.read.parquet(f"{path}/weights")
    intercept = spark.read.parquet(f"{path}/intercept").first()["intercept"]
    return weights, intercept


JSON_MODEL = "weights array<double>, intercept double"


def save_json_model(weights: DataFrame, intercept: float, path: str) -> None:
    """One JSON object ``{"weights": [...], "intercept": x}``, the weights in the order of the vocabulary index.

    A dense model is one row by its nature: a double per vocabulary term.
    """
    ordered = weights.agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "weight"))), lambda w: w["weight"]).alias("weights"))
    ordered.select("weights", F.lit(float(intercept)).alias("intercept")).coalesce(1).write.mode("overwrite").json(path)


def load_json_model(spark, path: str, vocab: DataFrame) -> tuple[DataFrame, float]:
    """(weights by term, intercept) of such a file: positions are joined with the vocabulary's index (term, idx).

    The array never passes through the driver.  A model of another vocabulary size raises.
    """
    stored = spark.read.schema(JSON_MODEL).option("multiLine", True).json(path)
    size, intercept = stored.select(F.size("weights"), "intercept").first()
    terms = vocab.count()
    if size != terms:
        raise ValueError(f"the model has {size} weights and the vocabulary {terms} terms")
    at = stored.select(F.posexplode("weights").alias("idx", "weight"))
    return vocab.select("term", "idx").join(at, "idx").select("term", "idx", "weight"), float(intercept or 0.0)
