"""Per-tag scorecard over enriched questions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The statistics of a tag, as (name, statistic, question value).
STATISTICS = (
    ("SumAnswersCount", "sum", "AnswersCount"),
    ("SumAcceptedAnswerCount", "sum", "accepted"),
    ("SumSelfAnswered", "sum", "own"),
    ("AnswersPerQuestions", "avg", "AnswersCount"),
    ("AcceptedAnswersPerQuestions", "avg", "accepted"),
    ("SelfAnsweredPerQuestions", "avg", "own"),
    ("AvgAcceptedAnswerAppearenceTimeInHours", "avg", "AcceptedAnswerAppearenceTimeInHours"),
    ("AvgQuestionViewCount", "avg", "ViewCount"),
    ("AvgQuestionWordsCount", "avg", "WordsCount"),
    ("AvgAnswerWordsCount", "avg", "AverageAnswerWordsCount"),
    ("AvgAcceptedAnswerWordsCount", "avg", "AcceptedAnswerWordsCount"),
    ("CommentsCountPerQuestion", "avg", "CommentsCount"),
    ("PositiveCommentsPerQuestion", "avg", "PositiveCommentsCount"),
    ("AvgCommentWordsCount_", "avg", "AvgCommentWordsCount"),
    ("SumCommentsCount", "sum", "CommentsCount"),
    ("SumPositiveComments", "sum", "PositiveCommentsCount"),
)
# What stands for a missing statistic.
MISSING = {"AvgAcceptedAnswerAppearenceTimeInHours": float("inf"), "AvgAnswerWordsCount": 0.0}
# The shares, as (name, part, whole).
SHARES = (
    ("PortionsOfPositiveComments", "SumPositiveComments", "SumCommentsCount"),
    ("PortionsOfAnswered", "SumAcceptedAnswerCount", "QuestionsCount"),
)


def _per_tag(question_info: DataFrame) -> DataFrame:
    return question_info.withColumn("Tag", F.explode("Tags")).drop("Tags")


def _share(part: str, whole: str):
    return F.when(F.col(whole) != 0, F.col(part) / F.col(whole)).otherwise(0.0)


def tag_scorecard(question_info: DataFrame) -> DataFrame:
    """Answer, view, length and comment statistics of every tag, most questions first.

    A question counts as answered when its accepted answer has a score. A tag without any
    accepted answer waits forever: its waiting time is +infinity.
    """
    facts = _per_tag(question_info).withColumns({
        "accepted": F.col("AcceptedAnswerScore").isNotNull().cast("int"),
        "own": F.coalesce("SelfAnswered", F.lit(False)).cast("int"),
    })
    counted = facts.groupBy("Tag").agg(
        F.count("*").alias("QuestionsCount"),
        *[getattr(F, statistic)(value).alias(name) for name, statistic, value in STATISTICS])
    return counted.fillna(MISSING).withColumns(
        {name: _share(part, whole) for name, part, whole in SHARES}
    ).orderBy(F.desc("QuestionsCount"), "Tag")


def tag_averages(question_info: DataFrame) -> DataFrame:
    """Mean question score, views and accepted answer length of every tag."""
    return _per_tag(question_info).groupBy("Tag").agg(
        F.avg("Score").alias("AverageQuestionScore"),
        F.avg("ViewCount").alias("AverageQuestionViewCount"),
        F.avg("AcceptedAnswerWordsCount").alias("AverageAcceptedAnswerWordsCount"))
