"""Column profiles against exact figures; previews; groups of items."""

import random

from pyspark.sql import functions as F

from tagloom.operators.mining import frequent_itemsets, item_groups
from tagloom.operators.profile import profile_columns


def test_profile_of_every_kind_of_column(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 2.5D, 'b', TIMESTAMP '2024-01-01 00:00:01', DATE '2024-02-01', NULL, array(1)),
        (3, NULL, '', TIMESTAMP '2024-01-03 00:00:00', NULL, NULL, NULL), (2, -1.0D, 'a', NULL, DATE '2024-01-01', NULL, array(2))
        AS t(i, `d x`, s, at, day, empty, listed)""").withColumn("empty", F.lit(None).cast("int"))
    got = {r.Column: r for r in profile_columns(df).collect()}
    assert list(got) == ["i", "d x", "s", "at", "day", "empty"]
    assert tuple(got["i"])[1:] == ("int", 3, 2.0, 1.0, "1", "3", ["1", "2", "3"])
    assert (got["d x"].Count, got["d x"].Min, got["d x"].Quantiles) == (2, "-1.0", ["-1.0", "-1.0", "2.5"])
    assert (got["s"].Min, got["s"].Max, got["s"].Mean, got["s"].Quantiles) == ("", "b", None, [None] * 3)
    assert got["at"].Quantiles == ["2024-01-01 00:00:01"] * 2 + ["2024-01-03 00:00:00"]
    assert got["day"].Quantiles == ["2024-01-01", "2024-01-01", "2024-02-01"]
    assert tuple(got["empty"])[2:] == (0, None, None, None, None, [None] * 3)
    assert [r.Count for r in profile_columns(df.limit(0)).collect()] == [0] * 6


def test_ranks_of_quantiles_are_within_the_stated_error(spark):
    n = 400_000
    df = spark.range(n).select(F.pmod(F.col("id") * 2654435761, F.lit(1 << 32)).alias("x"), F.lit("t").alias("s"))
    got = profile_columns(df, (0.01, 0.25, 0.5, 0.9, 0.999)).where("Column = 'x'").first()
    for share, value in zip((0.01, 0.25, 0.5, 0.9, 0.999), got.Quantiles, strict=True):
        assert abs(df.where(F.col("x") <= int(value)).count() / n - share) < 0.001
    assert (got.Min, got.Max) == tuple(str(v) for v in df.agg(F.min("x"), F.max("x")).first())


def test_profile_reads_each_column_in_one_pass(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS b", "cast(id AS string) AS c").write.parquet(f"{tmp_path}/x")
    plan = profile_columns(spark.read.parquet(f"{tmp_path}/x"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Sort [" not in plan


def test_small_files_are_mined_in_several_groups(spark, tmp_path):
    dice = random.Random(1)
    baskets = [([f"t{i}" for i in sorted(dice.sample(range(30), 6))],) for _ in range(2000)]
    df = spark.createDataFrame([*baskets, (None,), ([],)], "Tags array<string>")
    df.coalesce(1).write.parquet(f"{tmp_path}/q")
    one_file = spark.read.parquet(f"{tmp_path}/q")
    assert one_file.rdd.getNumPartitions() == 1
    assert item_groups(one_file) == spark.sparkContext.defaultParallelism
    assert item_groups(one_file, per_group=1000) == 42  # 2000 baskets of 21 prefix tags
    assert item_groups(one_file.limit(0)) == 1
    sets = frequent_itemsets(one_file, 0.02)
    assert sets.rdd.getNumPartitions() > 1
    assert {(tuple(r["items"]), r.freq) for r in sets.collect()} == {
        (tuple(r["items"]), r.freq) for r in frequent_itemsets(df, 0.02, partitions=1).collect()}
