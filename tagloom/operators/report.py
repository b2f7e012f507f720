"""Tables behind the dashboard, computed from the tag scorecard."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The metrics that have a leaderboard, in display order.
LEADERBOARD_METRICS = (
    "AnswersPerQuestions",
    "PortionsOfAnswered",
    "SelfAnsweredPerQuestions",
    "AvgAcceptedAnswerAppearenceTimeInHours",
    "AvgQuestionViewCount",
    "AvgQuestionWordsCount",
    "AvgAcceptedAnswerWordsCount",
    "CommentsCountPerQuestion",
    "PortionsOfPositiveComments",
)
MOST_QUESTIONED = 50
LEADERBOARD_LENGTH = 10
SELECTABLE_TAGS = 100


def most_questioned(scorecard: DataFrame, limit: int) -> DataFrame:
    return scorecard.orderBy(F.desc("QuestionsCount"), "Tag").limit(limit)


def leaderboards(scorecard: DataFrame, metrics=LEADERBOARD_METRICS, among: int = MOST_QUESTIONED,
                 length: int = LEADERBOARD_LENGTH) -> DataFrame:
    """(Metric, Side, Rank, Tag, Value): best and worst of the most questioned tags.

    Tags without a value rank last on both sides; equal values keep scorecard order. The
    ranking sees at most ``among`` rows per metric.
    """
    contenders = most_questioned(
        scorecard.select("Tag", "QuestionsCount", *[F.col(m).cast("double") for m in metrics]),
        among)
    values = contenders.unpivot(["Tag", "QuestionsCount"], list(metrics), "Metric", "Value")
    by_metric = Window.partitionBy("Metric")
    earlier = (F.desc("QuestionsCount"), F.asc("Tag"))
    ranked = values.select(
        "Metric", "Tag", "Value",
        F.row_number().over(by_metric.orderBy(F.desc_nulls_last("Value"), *earlier)).alias("top"),
        F.row_number().over(by_metric.orderBy(F.asc_nulls_last("Value"), *earlier)).alias("bottom"))
    return (ranked.unpivot(["Metric", "Tag", "Value"], ["top", "bottom"], "Side", "Rank")
            .where(F.col("Rank") <= length)
            .select("Metric", "Side", "Rank", "Tag", "Value"))


def leaderboard(scorecard: DataFrame, metric: str, among: int = MOST_QUESTIONED,
                length: int = LEADERBOARD_LENGTH) -> DataFrame:
    return leaderboards(scorecard, [metric], among, length)


def tag_options(scorecard: DataFrame, limit: int = SELECTABLE_TAGS) -> DataFrame:
    """(Tag): the tags offered for the drill-down."""
    return most_questioned(scorecard.select("Tag", "QuestionsCount"), limit).select("Tag").distinct()


def tag_overview(scorecard: DataFrame, tag: str | None = None) -> DataFrame:
    """(Tag, Chart, Category, Count) of the three drill-down charts, for one tag or all."""
    chosen = scorecard if tag is None else scorecard.where(F.col("Tag") == tag)

    def bar(chart: str, category: str, count) -> F.Column:
        return F.struct(F.lit(chart).alias("Chart"), F.lit(category).alias("Category"),
                        count.cast("long").alias("Count"))

    questions, comments = F.col("QuestionsCount"), F.col("SumCommentsCount")
    accepted, positive = F.col("SumAcceptedAnswerCount"), F.col("SumPositiveComments")
    bars = F.array(
        bar("Publications", "Questions", questions),
        bar("Publications", "Answers", F.col("SumAnswersCount")),
        bar("Publications", "Comments", comments),
        bar("Comments", "negative", comments - positive),
        bar("Comments", "positive", positive),
        bar("Questions", "not_answered", questions - accepted),
        bar("Questions", "answered", accepted),
    )
    return chosen.select("Tag", F.explode(bars).alias("bar")).select("Tag", "bar.*")
