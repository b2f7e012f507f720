"""Sentiment scorers: each maps text to 1 (positive), 0 (negative) or NULL for NULL text.

``lexicon_sentiment`` is the default: a JVM-side expression, so scoring needs neither a
shuffle nor a Python worker. ``model_sentiment`` hands Arrow batches to a model of the
caller's, loaded once per task. ``fit_classifier`` trains a linear text classifier with
Spark ML from labelled rows.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

# The default English word list.
POSITIVE_WORDS = (
    "amazing", "awesome", "best", "better", "brilliant", "clean", "clear", "correct",
    "elegant", "excellent", "fantastic", "glad", "good", "great", "happy", "helpful",
    "helps", "impressive", "love", "nice", "perfect", "solved", "thank", "thanks",
    "useful", "welcome", "wonderful", "works",
)
NEGATIVE_WORDS = (
    "awful", "bad", "broken", "bug", "confusing", "error", "fail", "fails", "hate",
    "horrible", "idiot", "incorrect", "poor", "sad", "slow", "stupid", "terrible",
    "ugly", "unclear", "unfortunately", "useless", "worse", "worst", "worthless", "wrong",
)

TOKEN_SEPARATOR = "[^a-z]+"

Scorer = Callable[[Column], Column]


def lexicon_sentiment(positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS) -> Scorer:
    """1 where the text has more positive than negative words, else 0."""

    def score(text: Column) -> Column:
        words = F.split(F.lower(text), TOKEN_SEPARATOR)
        # Most words have no opinion; one look-up drops them before votes are added.
        telling = F.filter(words, lambda word: word.isin(*positive, *negative))
        votes = F.aggregate(telling, F.lit(0), lambda total, word:
                            total + F.when(word.isin(*positive), 1).otherwise(-1))
        return (votes > 0).cast("int")

    return score


def model_sentiment(load_model: Callable[[], Callable[[list[str]], list[int]]]) -> Scorer:
    """Score with a Python model. ``load_model`` runs once per task, not once per row or batch.

    The loaded model gets the non-NULL texts of an Arrow batch, whole, and returns 0/1 each.
    """

    @pandas_udf("int")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load_model()
        for texts in batches:
            known = texts.dropna()
            labels = pd.Series(predict(known.tolist()) if len(known) else [], known.index, "Int32")
            yield labels.reindex(texts.index)

    return scored


def fit_classifier(labelled: DataFrame, text: str = "Text", label: str = "Label",
                   features: int = 1 << 14) -> PipelineModel:
    """Train a 0/1 text classifier on rows with a text and a 0/1 label."""
    known = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    stages = [
        RegexTokenizer(inputCol=text, outputCol="tokens", pattern=TOKEN_SEPARATOR),
        HashingTF(inputCol="tokens", outputCol="features", numFeatures=features),
        LogisticRegression(featuresCol="features", labelCol=label, regParam=0.01, maxIter=25),
    ]
    return Pipeline(stages=stages).fit(known)


def classify(texts: DataFrame, model: PipelineModel, text: str = "Text",
             output: str = "Sentiment") -> DataFrame:
    """Add the classifier's 0/1 as a column. Rows without text keep NULL."""
    # The fitted stages reject NULL text, so they see an empty string in its place.
    original = "__original_text"
    shadowed = (texts.withColumnRenamed(text, original)
                .withColumn(text, F.coalesce(original, F.lit(""))))
    scored = model.transform(shadowed)
    value = F.when(F.col(original).isNotNull(), F.col("prediction").cast("int"))
    kept = [F.col(original).alias(c) if c == text else F.col(c) for c in texts.columns]
    return scored.select(*kept, value.alias(output))
