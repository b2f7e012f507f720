"""Plans that must hold when data grows or one key holds a third of it."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tagloom.operators import prepare, questions, scorecard, tag_usage, trends
from tagloom.plans import lookups
from tagloom.plans.lookups import fits_broadcast, hot_keys, lookup_join


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def executed_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 answers, a third of them to question 0, with matching comments."""
    asked = spark.range(3000).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 2 == 0, F.col("id") * 10).alias("AcceptedAnswerId"),
        F.lit(1).cast("long").alias("OwnerUserId"), F.lit(1).alias("Score"), F.lit(2).alias("ViewCount"),
        F.lit(3).alias("WordsCount"), F.timestamp_seconds(F.col("id")).alias("CreationDate"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit("hot"))).otherwise(
            F.array(F.concat(F.lit("t"), F.col("id") % 50))).alias("Tags"))
    answers = spark.range(30000).select(
        F.col("id").alias("Id"), F.when(F.col("id") < 10000, 0).otherwise(F.col("id") % 3000).alias("ParentId"),
        F.lit(7).cast("long").alias("OwnerUserId"), F.lit(1).alias("Score"), F.lit(4).alias("WordsCount"),
        F.timestamp_seconds(F.col("id")).alias("CreationDate"))
    return asked, answers


def test_size_check_measures_rows_and_bytes(spark):
    words = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("word"))
    assert fits_broadcast(words)
    assert not fits_broadcast(words, max_rows=99)
    assert not fits_broadcast(words, max_bytes=50_000)
    assert fits_broadcast(words.limit(0))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_broadcast(spark, how):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 40)).alias("key"))
    dimension = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "name string, v int")
    wide = lookup_join(facts, dimension, "key", "name", how)
    salted = lookup_join(facts, dimension, "key", "name", how, max_rows=1, salts=5)
    assert salted.columns == wide.columns == ["id", "key", "name", "v"]
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, wide.collect()), key=repr)


def test_salts_spread_a_hot_key(spark):
    facts = spark.range(3000).select("id", F.lit("hot").alias("key"))
    dimension = spark.createDataFrame([("hot", 1)], "name string, v int")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1,
                  spark__sql__adaptive__coalescePartitions__enabled="false"):
        joined = lookup_join(facts, dimension, "key", "name", "inner", max_rows=0, salts=32)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) > 4 and max(sizes) < 1500


def test_operators_with_dimensions_too_large_to_broadcast(spark, forum, monkeypatch):
    def results():
        asked = prepare.questions_from_posts(prepare.prepare_posts(forum.posts), forum.synonyms)
        usage = tag_usage.tag_usage_per_day(forum.posts, forum.comments, forum.synonyms, forum.tags)
        return [sorted(map(tuple, df.collect()), key=repr) for df in (asked, usage)]

    broadcast = results()
    monkeypatch.setattr(lookups, "fits_broadcast", lambda *_: False)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert results() == broadcast


def test_hot_question_is_dealt_over_tasks_in_the_tag_join(spark, hot):
    asked, answers = hot
    asked = asked.withColumn("Tags", F.col("Tags")[0])
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__skewJoin__enabled="false",
                  spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions=16):
        joined = tag_usage.answers_with_question_tags(asked, answers.repartition(8))
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain = answers.join(asked.select(F.col("Id").alias("q"), "Tags"), F.col("ParentId") == F.col("q")).select(
            answers["Id"], answers["CreationDate"], "Tags")
        assert joined.count() == 30000 and joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    # A third of all answers are to one question, yet no task has more than three times the median.
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]


def test_hot_keys_are_few_and_complete(spark, hot):
    _, answers = hot
    assert [r.hot for r in hot_keys(answers, "ParentId").collect()] == [0]
    assert hot_keys(answers.where("ParentId IS NULL"), "ParentId").collect() == []
    assert hot_keys(answers.limit(0), "ParentId").collect() == []
    text = answers.select(F.concat(F.lit("k"), F.col("Id") % 7).alias("k"))
    assert sorted(r.hot for r in hot_keys(text, "k").collect()) == [f"k{i}" for i in range(7)]


def test_children_are_reduced_before_they_meet_questions(spark, hot):
    asked, answers = hot
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        info = questions.question_answer_info(asked, answers)
        plan = executed_plan(info)
    assert "Window" not in plan and plan.count("partial_count") == 1
    row = info.where("Id = 0").first()
    # The first 10,000 answers and every 3,000th of the others: 12,000 to 27,000.
    assert row.AnswersCount == 10000 + 6


def test_unanswered_questions_are_not_shuffled_by_their_null_key(spark, hot):
    asked, answers = hot
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = executed_plan(questions.accepted_answers(asked, answers))
    assert "Outer" not in plan and "SortAggregate" not in plan


def test_scorecard_groups_a_hot_tag_before_the_shuffle(spark, hot):
    asked, answers = hot
    comments = spark.createDataFrame([], "Id long, PostId long, WordsCount int, Sentiment int")
    card = scorecard.tag_scorecard(
        questions.question_comment_info(questions.question_answer_info(asked, answers), comments))
    assert "partial_count" in executed_plan(card)
    first = card.first()
    assert (first.Tag, first.QuestionsCount) == ("hot", 1000)


def test_daily_usage_computes_each_part_once(spark, forum, tmp_path):
    forum.posts.write.parquet(f"{tmp_path}/posts")
    forum.comments.write.parquet(f"{tmp_path}/comments")
    posts, comments = spark.read.parquet(f"{tmp_path}/posts"), spark.read.parquet(f"{tmp_path}/comments")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = executed_plan(tag_usage.tag_usage_per_day(posts, comments, forum.synonyms, forum.tags))
    # Questions, answers and comments are read once each, without bodies; one more scan looks for hot posts in one column.
    assert plan.count("FileScan") == 4 and "Body" not in plan and plan.count("ReadSchema: struct<PostId:bigint>") == 1
    assert plan.count("ReusedExchange") >= 2


def test_series_counts_tags_once(spark, hot, tmp_path):
    hot[0].select(F.lit("01_01_2024").alias("PartitionDate"), "Tags").write.parquet(f"{tmp_path}/q")
    asked = spark.read.parquet(f"{tmp_path}/q")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = executed_plan(trends.tag_frequency_series(asked))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan and "WindowGroupLimit" in plan
