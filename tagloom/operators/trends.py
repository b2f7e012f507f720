"""Activity totals and tag frequency over time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.dates import parse_partition_day
from tagloom.schemas import PARTITION_COLUMN

TOP_TAGS_PER_DAY = 7


def general_info(questions: DataFrame, answers: DataFrame, comments: DataFrame) -> DataFrame:
    """(Category, Count) of the three tables."""
    def total(table: DataFrame, category: str) -> DataFrame:
        return table.agg(F.count("*").alias("Count")).select(F.lit(category).alias("Category"), "Count")

    return (total(questions, "Questions").unionByName(total(answers, "Answers"))
            .unionByName(total(comments, "Comments")))


def with_partition_timestamp(table: DataFrame) -> DataFrame:
    """Turn the stored day key into a timestamp, which sorts by time."""
    return table.withColumn(PARTITION_COLUMN, parse_partition_day(PARTITION_COLUMN))


def day_tag_counts(questions: DataFrame) -> DataFrame:
    """(PartitionDate, Tag, Count) of questions per day and tag."""
    return (questions.select(PARTITION_COLUMN, F.explode("Tags").alias("Tag"))
            .groupBy(PARTITION_COLUMN, "Tag").agg(F.count("*").alias("Count")))


def _top_of_each_day(counts: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy(PARTITION_COLUMN).orderBy(F.desc("Count"), "Tag")
    return (counts.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top).drop("rank"))


def top_tags_per_day(questions: DataFrame, top: int = TOP_TAGS_PER_DAY) -> DataFrame:
    """The most used tags of every day; equal counts are ordered by name."""
    return _top_of_each_day(day_tag_counts(questions), top)


def tag_frequency_series(questions: DataFrame, top: int = TOP_TAGS_PER_DAY) -> DataFrame:
    """Daily counts of every tag that was ever among a day's most used, in time order."""
    # Both uses below start from the same aggregate, so its exchange is computed once. The
    # filter keeps them alike: the semi join would add it to one side only.
    counts = day_tag_counts(questions).where(F.col("Tag").isNotNull())
    leaders = _top_of_each_day(counts, top).select("Tag").distinct()
    return counts.join(leaders, "Tag", "left_semi").orderBy(PARTITION_COLUMN, "Tag").select(
        PARTITION_COLUMN, "Tag", "Count")
