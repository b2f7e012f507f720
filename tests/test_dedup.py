"""Repeated rows go as with dropDuplicates, and bodies of single rows stay where they are."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.dedup import drop_repeated_rows
from tagloom.operators.prepare import prepare_posts
from tests.test_scale import settings


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shuffled_bytes(df):
    """Bytes that the exchanges of an executed frame were given, without reused ones."""
    df.collect()
    total, open_plans = 0, [df._jdf.queryExecution().executedPlan()]
    while open_plans:
        plan = open_plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            open_plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec") and "Result" not in kind:
            open_plans.append(plan.plan())
        if kind == "ShuffleExchangeExec":
            total += plan.metrics().apply("dataSize").value()
        children = plan.children()
        open_plans += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("bits", [1, 64, 1 << 15, 1 << 20, 1 << 27])
def test_rows_of_any_kind(spark, bits):
    dice = random.Random(bits)
    made = [(dice.choice([None, *range(40)]), dice.choice([None, "", "a", "b" * 3000]),
             [dice.choice(["x", None])] * dice.randrange(3)) for _ in range(800)]
    df = spark.createDataFrame(made, "digest long, bucket string, bitmap array<string>")
    assert rows(drop_repeated_rows(df, bits)) == rows(df.dropDuplicates())
    assert drop_repeated_rows(df.limit(0), bits).collect() == []


def test_a_third_of_the_rows_alike(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("Id"), F.lit("text").alias("Body"))
    assert drop_repeated_rows(df).count() == 20_001


def test_shuffle_does_not_grow_with_bodies(spark, tmp_path):
    def written(size):
        path = f"{tmp_path}/{size}"
        spark.range(4000).select(F.pmod("id", F.lit(3990)).alias("Id"), F.repeat(F.lit("x"), size).alias("Body")).write.parquet(path)
        return drop_repeated_rows(spark.read.parquet(path))

    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        small, large = shuffled_bytes(written(10)), shuffled_bytes(written(10_000))
    # Ten rows have a copy, and only these twenty move with their text.
    assert large - small < 30 * 10_000 and large < 0.02 * 4000 * 10_000


def test_posts_are_prepared_without_moving_single_bodies(spark, forum):
    twice = forum.posts.unionByName(forum.posts)
    assert rows(prepare_posts(twice)) == rows(prepare_posts(forum.posts))
