"""The weight table beside Spark ML's naive Bayes, its accuracy, and scoring in batches."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, RegexTokenizer
from pyspark.sql import functions as F

from bindings.queries import held_out
from tagloom.functions.sentiment import TOKEN_SEPARATOR
from tagloom.operators.sentiment_weights import fit_weights, score_by_weights, ship_weights, shipped_sentiment

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def split(spark):
    labelled = spark.read.parquet(f"{FOLDER}/documents.parquet").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").select(
        F.col("doc_id").alias("Id"), F.col("text").alias("Text"), (1 - F.col("toxic")).alias("Label"))
    return labelled.where(~held_out("Id")), labelled.where(held_out("Id"))


def test_weights_equal_the_fitted_pipeline(split):
    learnt, unseen = split
    stages = [RegexTokenizer(inputCol="Text", outputCol="tokens", pattern=TOKEN_SEPARATOR),
              CountVectorizer(inputCol="tokens", outputCol="features", binary=True, minDF=5.0, vocabSize=1 << 20),
              NaiveBayes(labelCol="Label", featuresCol="features", smoothing=1.0)]
    fitted = Pipeline(stages=stages).fit(learnt).transform(unseen)
    want = {r.Id: int(r.prediction) for r in fitted.select("Id", "prediction").collect()}
    scored = score_by_weights(unseen, fit_weights(learnt)).collect()
    assert len(want) > 900 and {r.Id: r.Sentiment for r in scored} == want
    truth = {r.Id: r.Label for r in unseen.collect()}
    right = sum(truth[i] == s for i, s in want.items()) / len(truth)
    assert right > sum(truth.values()) / len(truth) + 0.03


def test_batches_agree_with_joins(split):
    learnt, unseen = split
    weights = fit_weights(learnt)
    score = shipped_sentiment(ship_weights(weights))
    batched = {r.Id: r.s for r in unseen.select("Id", score("Text").alias("s")).collect()}
    assert batched == {r.Id: r.Sentiment for r in score_by_weights(unseen, weights).collect()}


def test_odd_texts(spark):
    labelled = spark.createDataFrame([("good fine", 1), ("good", 1), ("bad", 0), (None, 1), ("x", None), ("é 漢 12", 0)], "Text string, Label int")
    weights = fit_weights(labelled, least_texts=1)
    texts = spark.createDataFrame([(1, "GOOD good fine"), (2, "bad bad"), (3, None), (4, ""), (5, "unknown"), (6, "é漢 12")],
                                  "Id int, Text string")
    got = {r.Id: r.Sentiment for r in score_by_weights(texts, weights).collect()}
    assert (got[1], got[2], got[3]) == (1, 0, None) and got[4] == got[5] == got[6] == 0
    score = shipped_sentiment(ship_weights(weights))
    assert {r.Id: r.s for r in texts.select("Id", score("Text").alias("s")).collect()} == got
    nothing = fit_weights(labelled.limit(0))
    assert [tuple(r) for r in nothing.collect()] == [("", 0.0)]
    assert {r.Sentiment for r in score_by_weights(texts, nothing).collect()} == {0, None}


def test_only_files_are_handed_to_executors(spark, monkeypatch):
    """A cluster refuses folders of a local file system, which local mode takes."""
    handed = []
    add = type(spark.sparkContext).addFile

    def seen(context, path, recursive=False):
        handed.append((path, recursive))
        add(context, path, recursive)

    monkeypatch.setattr(type(spark.sparkContext), "addFile", seen)
    labelled = spark.createDataFrame([("good fine", 1), ("good", 1), ("bad", 0)], "Text string, Label int").repartition(3)
    weights = fit_weights(labelled, least_texts=1).repartition(3, "Token")
    score = shipped_sentiment(ship_weights(weights))
    assert len(handed) > 1 and all(path.endswith(".parquet") and not recursive for path, recursive in handed)
    assert all("/part-" in path for path, _ in handed)
    got = spark.createDataFrame([("good",), ("bad",)], "Text string").select(score("Text").alias("s")).collect()
    assert sorted(r.s for r in got) == [0, 1]
