"""Training: same objective as the reference's trainer; test the loss, not the weights."""

import math

from pyspark.sql import functions as F

from sentimill.operators import model
from sentimill.plans import catalog
from sentimill.sources import tables

from tables_of_tests import SF_MID


def _loss(spark, weights, labelled, reg):
    margins = model.score(labelled.select("doc_id", model.label_from_rating("sentiment").alias("y"), "text"),
                          ["doc_id", "y"], weights)
    data = margins.select(
        F.log1p(F.exp(-F.when(F.col("y") == 1, 1.0).otherwise(-1.0) * F.col("score"))).alias("l"))
    mean = data.agg(F.avg("l")).first()[0]
    l2 = weights.agg(F.sum(F.col("weight") * F.col("weight"))).first()[0] or 0.0
    return mean + reg / 2 * l2


def test_fit_lowers_the_regularised_loss(spark):
    v = catalog.Views(spark, SF_MID)
    labelled = tables.labelled_texts(spark, SF_MID)
    weights, intercept = model.fit_logistic(model.training_rows(labelled), v.vocab)
    assert intercept == 0.0
    assert weights.count() == v.vocab.count()
    assert weights.join(v.vocab, ["term", "idx"], "left_anti").count() == 0
    fitted = _loss(spark, weights, labelled, 0.01)
    zero = _loss(spark, weights.withColumn("weight", F.lit(0.0)), labelled, 0.01)
    assert zero == math.log(2) or abs(zero - math.log(2)) < 1e-9
    assert fitted < zero


def test_model_round_trip(spark, scratch):
    w = spark.createDataFrame([("good", 0, 0.5), ("bad", 1, -0.5)], "term string, idx int, weight double")
    model.save_model(w, 0.0, f"{scratch}/m")
    w2, b = model.load_model(spark, f"{scratch}/m")
    assert b == 0.0 and sorted(map(tuple, w2.collect())) == sorted(map(tuple, w.collect()))


def test_fit_is_no_worse_than_plain_sgd(spark):
    """Same objective as the 100-step SGD trainer: our L-BFGS loss must not be higher."""
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import Vectors as MLlibVectors
    from pyspark.mllib.regression import LabeledPoint

    v = catalog.Views(spark, SF_MID)
    labelled = tables.labelled_texts(spark, SF_MID)
    rows = model.training_rows(labelled)
    weights, _ = model.fit_logistic(rows, v.vocab)

    terms = [r["term"] for r in v.vocab.orderBy("idx").collect()]
    feats = CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="f").transform(rows)
    points = feats.select("label", "f").rdd.map(
        lambda r: LabeledPoint(r["label"], MLlibVectors.fromML(r["f"]))).coalesce(1).cache()
    sgd = LogisticRegressionWithSGD.train(points, iterations=100, step=1.0, regParam=0.01,
                                          regType="l2", intercept=False)
    sgd_w = spark.createDataFrame([(t, float(w)) for t, w in zip(terms, sgd.weights.toArray())],
                                  "term string, weight double")
    ours = _loss(spark, weights, labelled, 0.01)
    theirs = _loss(spark, sgd_w, labelled, 0.01)
    assert ours <= theirs + 1e-9, (ours, theirs)


def test_partitions_change_the_plan_and_not_the_model(spark):
    from tables_of_tests import SF_SMALL
    v = catalog.Views(spark, SF_SMALL)
    rows = model.training_rows(tables.labelled_texts(spark, SF_SMALL))
    fitted = [{(r.term, r.idx): r.weight for r in model.fit_logistic(rows, v.vocab, partitions=n)[0].collect()}
              for n in (None, 1, 3)]
    assert fitted[0].keys() == fitted[1].keys() == fitted[2].keys()
    for other in fitted[1:]:
        assert max(abs(other[k] - w) for k, w in fitted[0].items()) < 1e-3


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    from tables_of_tests import SF_SMALL
    taken = []
    fit = model.fit_logistic
    monkeypatch.setattr(model, "fit_logistic", lambda *a, partitions, **k: taken.append(partitions) or fit(*a, partitions=partitions, **k))
    rows = spark.read.parquet(f"{SF_SMALL}/labels.parquet").count()
    monkeypatch.setattr(catalog, "TRAIN_ROWS", rows // 2)
    assert catalog.q_train_sentiment(spark, SF_SMALL).filter("better_than_zero").count() > 0
    assert taken == [-(-rows // (rows // 2))]


def test_registered_training_query(spark):
    from tables_of_tests import SF_SMALL
    df = catalog.q_train_sentiment(spark, SF_SMALL)
    assert df.columns == ["term", "idx", "better_than_zero"]
    assert df.count() == catalog.Views(spark, SF_SMALL).vocab.count()
