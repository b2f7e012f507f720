"""Raw exports -> the cleaned rows of the lake tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import partition_day
from tagloom.functions.sentiment import Scorer, lexicon_sentiment
from tagloom.functions.tags import parse_tags
from tagloom.functions.text import strip_markup, word_count
from tagloom.operators.dedup import drop_repeated_rows
from tagloom.operators.tag_usage import replace_tag_synonyms
from tagloom.schemas import ANSWER_TYPE, PARTITION_COLUMN, QUESTION_TYPE


def is_question():
    """A question has its post type and a tag string."""
    return (F.col("PostTypeId") == QUESTION_TYPE) & F.col("Tags").isNotNull()


def is_answer():
    """An answer has its post type and no tag string."""
    return (F.col("PostTypeId") == ANSWER_TYPE) & F.col("Tags").isNull()


def with_body_digest(posts: DataFrame) -> DataFrame:
    """The body as its SHA-256, for comparing whole rows without shuffling their texts."""
    return posts.withColumn("Body", F.unhex(F.sha2("Body", 256)))


def prepare_posts(posts: DataFrame, separator: str = "") -> DataFrame:
    """Drop repeated rows and posts without an owner; strip the body and count its words.

    A row with an owner is not empty, so the owner filter covers all-NULL rows too. It
    comes first, so that ownerless posts are never shuffled. Rows are compared on every
    column; only those that may have a copy are moved for it.
    """
    return (
        drop_repeated_rows(posts.where(F.col("OwnerUserId").isNotNull()))
        .select("Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "OwnerUserId", "Score",
                "ViewCount", "Title", strip_markup("Body", separator).alias("Body"), "Tags",
                "CreationDate", "ClosedDate")
        .withColumn("WordsCount", word_count("Body"))
    )


def prepare_posts_without_text(posts: DataFrame, separator: str = "") -> DataFrame:
    """``prepare_posts`` without title and body, for loads that keep neither.

    The words are counted where the post is read; from there on the body's digest stands
    for the body, so comparing rows moves 32 bytes per post in place of its text.
    """
    counted = posts.where(F.col("OwnerUserId").isNotNull()).withColumn(
        "WordsCount", word_count(strip_markup("Body", separator)))
    return with_body_digest(counted).dropDuplicates().select(
        "Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "OwnerUserId", "Score", "ViewCount",
        "Tags", "CreationDate", "ClosedDate", "WordsCount")


def questions_from_posts(prepared_posts: DataFrame, synonyms: DataFrame) -> DataFrame:
    """One row per question Id with its sorted, synonym-free tag set; no tags, no row.

    Rows that share an Id are merged: their tags are united and the other values are
    taken together from the greatest row.
    """
    row = ("CreationDate", "ClosedDate", "AcceptedAnswerId", "OwnerUserId", "Score",
           "ViewCount", "WordsCount")
    single_tags = prepared_posts.where(is_question()).select(
        "Id", F.struct(*row).alias("row"), F.explode(parse_tags("Tags")).alias("Tag"))
    return (
        replace_tag_synonyms(single_tags, synonyms)
        .groupBy("Id")
        .agg(F.max("row").alias("row"), F.sort_array(F.collect_set("Tag")).alias("Tags"))
        .select("Id", "row.AcceptedAnswerId", "row.OwnerUserId", "row.Score", "row.ViewCount",
                "row.WordsCount", "row.CreationDate", "row.ClosedDate",
                partition_day("row.CreationDate").alias(PARTITION_COLUMN), "Tags")
    )


def answers_from_posts(prepared_posts: DataFrame) -> DataFrame:
    return prepared_posts.where(is_answer()).select(
        "Id", "ParentId", "OwnerUserId", "Score", "WordsCount", "CreationDate",
        partition_day("CreationDate").alias(PARTITION_COLUMN))


def prepare_comments(comments: DataFrame, sentiment: Scorer | None = None,
                     separator: str = "") -> DataFrame:
    """Dated comments with word count and sentiment; repeated rows are kept."""
    score = sentiment or lexicon_sentiment()
    # The text is stripped in a step of its own, since two columns are made of it.
    stripped = comments.where(F.col("CreationDate").isNotNull()).select(
        "Id", "PostId", "Score", strip_markup("Text", separator).alias("Text"), "CreationDate")
    return stripped.select(
        "Id", "PostId", "Score", word_count("Text").alias("WordsCount"),
        score(F.col("Text")).alias("Sentiment"),
        partition_day("CreationDate").alias(PARTITION_COLUMN))
