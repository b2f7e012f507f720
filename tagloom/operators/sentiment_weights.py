"""A sentiment classifier made of joins: token weights are fitted by counting and added up per text.

The model is naive Bayes on the tokens that a text has, each counted once. Fitting and scoring are groupings and
joins keyed by token and by text, so neither the vocabulary nor the texts have to fit anywhere. The weights
are a table (Token, Weight); the row of the empty token, which no text has, holds the prior.

For scoring in batches the same table is shipped to the executors as files: ``ship_weights`` and ``shipped_sentiment``.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tagloom.functions.sentiment import TOKEN_SEPARATOR, Scorer
from tagloom.plans.lookups import lookup_join
from tagloom.staging import new_path

PRIOR = ""
LEAST_TEXTS = 5
"""Tokens of fewer labelled texts say more about chance than about sentiment and get no weight."""
SMOOTHING = 1.0
MAX_SHIPPED = 5_000_000
"""Weights that a process may load; larger models are scored by ``score_by_weights``."""


def tokens_of(text) -> Column:
    """The distinct tokens of a text: runs of a to z, in lower case."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), TOKEN_SEPARATOR)), "")


def fit_weights(labelled: DataFrame, text: str = "Text", label: str = "Label",
                least_texts: int = LEAST_TEXTS, smoothing: float = SMOOTHING) -> DataFrame:
    """(Token, Weight) from rows with a text and a 0/1 label; others are left out.

    A weight is the log of how much likelier the token is among the tokens of positive texts; every step folds on the map side.
    """
    known = labelled.where(F.col(text).isNotNull() & F.col(label).isin(0, 1)).select(
        tokens_of(text).alias("tokens"), F.col(label).cast("int").alias("label"))

    def log_odds(positive: Column, negative: Column, of_positive: Column, of_negative: Column) -> Column:
        return (F.log(positive + smoothing) - F.log(of_positive)) - (F.log(negative + smoothing) - F.log(of_negative))

    counted = (known.select(F.explode("tokens").alias("Token"), "label").groupBy("Token")
               .agg(F.sum("label").alias("positive"), F.sum(1 - F.col("label")).alias("negative"))
               .where(F.col("positive") + F.col("negative") >= least_texts))
    size = F.count("*") * smoothing
    totals = counted.agg((F.sum("positive") + size).alias("of_positive"), (F.sum("negative") + size).alias("of_negative"))
    # The totals are one row.
    weights = counted.join(F.broadcast(totals)).select(
        "Token", log_odds(F.col("positive"), F.col("negative"), F.col("of_positive"), F.col("of_negative")).alias("Weight"))
    texts = known.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("p"), F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).alias("n"))
    one = F.lit(1.0)
    return weights.unionByName(texts.select(F.lit(PRIOR).alias("Token"), log_odds(F.col("p"), F.col("n"), one, one).alias("Weight")))


def score_by_weights(texts: DataFrame, weights: DataFrame, key: str = "Id", text: str = "Text") -> DataFrame:
    """(key, Score, Sentiment) of each text: the sum of the weights of its tokens and the prior; 1 where it is above 0.

    Texts are told apart by ``key``, which must be unique; a NULL text has neither score nor sentiment. Texts without a weighted token
    have the prior alone.
    """
    tokens = texts.where(F.col(text).isNotNull()).select(key, F.explode(F.concat(F.array(F.lit(PRIOR)), tokens_of(text))).alias("__token"))
    # Common tokens are in most texts: the weights are broadcast if they are few, else salted.
    found = lookup_join(tokens, weights, "__token", "Token", "inner")
    scores = found.groupBy(F.col(key).alias("__key")).agg(F.sum("Weight").alias("Score"))
    scored = texts.select(key).join(scores, F.col(key) == F.col("__key"), "left")
    return scored.select(key, "Score", (F.col("Score") > 0).cast("int").alias("Sentiment"))


def ship_weights(weights: DataFrame) -> tuple[str, ...]:
    """Write the weights to the shared folder and have Spark hand them to each executor; the names to load them by.

    The files are handed on one by one: outside local mode Spark hands on no folder of a file system that it reads by file:.
    """
    spark = weights.sparkSession
    path = new_path(spark, "weights")
    weights.write.parquet(path)
    written = spark.read.schema(weights.schema).parquet(path)
    rows = written.count()
    if rows > MAX_SHIPPED:
        raise ValueError(f"{rows} weights are too many for one process; use score_by_weights")
    files = sorted(written.inputFiles())  # names that no other write uses
    for file in files:
        spark.sparkContext.addFile(file)
    return tuple(file.rpartition("/")[2] for file in files)


@lru_cache(maxsize=2)
def _loaded(names: tuple[str, ...]) -> tuple[pa.Array, np.ndarray, float]:
    """Tokens, their weights and the prior; read once per process."""
    table = pa.concat_tables([pq.read_table(SparkFiles.get(name)) for name in names]).combine_chunks()
    tokens, weights = table["Token"].combine_chunks(), table["Weight"].to_numpy()
    prior = pc.index(tokens, PRIOR).as_py()
    return tokens, weights, float(weights[prior])


def batch_scores(texts: pd.Series, tokens: pa.Array, weights: np.ndarray, prior: float) -> np.ndarray:
    """Scores of a batch of texts: one look-up of all their distinct tokens and one weighted count."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pa.array(texts, pa.string())), pattern=TOKEN_SEPARATOR)
    owner = pc.list_parent_indices(lists)
    seen = pa.table({"owner": owner, "token": pc.list_flatten(lists)}).group_by(["owner", "token"]).aggregate([])
    seen = seen.filter(pc.not_equal(seen["token"], PRIOR))
    place = pc.index_in(seen["token"], value_set=tokens)
    known = pc.is_valid(place)
    return prior + np.bincount(seen["owner"].filter(known).to_numpy(), weights[place.filter(known).to_numpy()], minlength=len(texts))


def shipped_sentiment(names: tuple[str, ...]) -> Scorer:
    """Score with weights that ``ship_weights`` handed to the executors: each process loads them once, each batch is one look-up."""

    @pandas_udf("int")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _loaded(names)
        for texts in batches:
            known = texts.dropna()
            positive = batch_scores(known, *model) > 0 if len(known) else []
            yield pd.Series(positive, known.index, "Int32").reindex(texts.index)

    return scored
