"""Daily tag usage over questions, answers and comments."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import report_day
from tagloom.functions.tags import parse_tags
from tagloom.plans.lookups import hot_key_join, lookup_join
from tagloom.schemas import ANSWER_TYPE, QUESTION_TYPE


def _with_parent_tags(children: DataFrame, parent_id: str, parents: DataFrame) -> DataFrame:
    """Inner join of children to the Id and Tags of their parents; a parent with very many children is salted."""
    tagged = parents.select(F.col("Id").alias("__parent"), "Tags")
    return hot_key_join(children, tagged, parent_id, "__parent")


def answers_with_question_tags(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(Id, CreationDate, Tags) of every answer, with the tags of its question."""
    children = answers.select("Id", "ParentId", "CreationDate")
    return _with_parent_tags(children, "ParentId", questions).select("Id", "CreationDate", "Tags")


def comments_with_posts_tags(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """(CreationDate, Tags) of every comment, with the tags of its post."""
    children = comments.select("Id", "PostId", "CreationDate")
    return _with_parent_tags(children, "PostId", posts).select("CreationDate", "Tags")


def explode_tags(dated: DataFrame) -> DataFrame:
    """(CreationDate, Tag): one row per tag of the tag string, repeated tags included."""
    return dated.select("CreationDate", F.explode(parse_tags("Tags")).alias("Tag"))


def replace_tag_synonyms(tagged: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Replace each Tag that is a synonym by its target, in one hop; other columns stay."""
    targets = (synonyms.where(F.col("SourceTagName").isNotNull())
               .select(F.col("SourceTagName").alias("__source"),
                       F.col("TargetTagName").alias("__target")))
    joined = lookup_join(tagged, targets, "Tag", "__source", "left")
    kept = [F.coalesce("__target", "Tag").alias("Tag") if name == "Tag" else F.col(name)
            for name in tagged.columns]
    return joined.select(*kept)


def count_tags_per_day(dated_tags: DataFrame, tags: DataFrame) -> DataFrame:
    """(Date, TagId, Tag, Count) per day and known tag. Undated rows form a NULL day."""
    counts = (dated_tags.select(report_day("CreationDate").alias("Date"), "Tag")
              .groupBy("Date", "Tag").agg(F.count("*").alias("Count")))
    known = tags.select(F.col("Id").alias("TagId"), "TagName")
    return (lookup_join(counts, known, "Tag", "TagName", "inner")
            .select("Date", "TagId", "Tag", "Count"))


def tag_usage_per_day(posts: DataFrame, comments: DataFrame, synonyms: DataFrame,
                      tags: DataFrame) -> DataFrame:
    """Uses of each known tag per day, over raw posts and comments.

    What is counted are distinct (timestamp, tag string) pairs: two publications of one
    moment with the same tag string count once. Posts need no owner, a tag named twice in
    one tag string counts twice, and undated comments form a NULL day.

    Later steps only see the distinct short rows made here, so comparing whole posts
    first would change nothing; it would read and shuffle every body.
    """
    questions = (posts.where((F.col("PostTypeId") == QUESTION_TYPE) & F.col("Tags").isNotNull())
                 .select("Id", "CreationDate", "Tags").distinct())
    answers = (posts.where((F.col("PostTypeId") == ANSWER_TYPE) & F.col("Tags").isNull())
               .select("Id", "ParentId", "CreationDate").distinct())
    tagged_posts = questions.unionByName(answers_with_question_tags(questions, answers)).distinct()
    # Grouping, not distinct(): that would fold the distinct above into this one, and the
    # answers would be joined twice instead of once.
    moments = (tagged_posts.select("CreationDate", "Tags")
               .unionByName(comments_with_posts_tags(tagged_posts, comments))
               .groupBy("CreationDate", "Tags").agg(F.count("*").alias("times"))
               .select("CreationDate", "Tags"))
    return count_tags_per_day(replace_tag_synonyms(explode_tags(moments), synonyms), tags)
