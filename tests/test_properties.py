"""Equivalences between our plans and direct readings of what they compute."""

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings import tables
from tagloom.operators import mining, prepare, questions, report, scorecard, tag_usage, trends

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    # Line ids repeat at this size, so keep one line of each.
    return (tables.lake_questions(spark, FOLDER),
            tables.lake_answers(spark, FOLDER).dropDuplicates(["Id"]),
            tables.lake_comments(spark, FOLDER))


def as_set(df):
    return {tuple(tuple(v) if isinstance(v, list) else v for v in r)
            for r in df.select(*sorted(df.columns)).collect()}


def test_preaggregation_equals_join_and_window(lake):
    asked, answers, comments = lake
    ours = questions.question_comment_info(questions.question_answer_info(asked, answers), comments).select(
        "Id", "AcceptedAnswerScore", "SelfAnswered", "AnswersCount", "CommentsCount", "PositiveCommentsCount",
        F.round("AverageAnswerWordsCount", 9).alias("a"), F.round("AvgCommentWordsCount", 9).alias("c"))
    best = answers.select(F.col("Id").alias("best"), F.col("Score").alias("AcceptedAnswerScore"),
                          F.col("OwnerUserId").alias("by"))
    every = answers.select(F.col("Id").alias("answer"), "ParentId", F.col("WordsCount").alias("aw"))
    said = comments.select(F.col("Id").alias("comment"), "PostId", "Sentiment", F.col("WordsCount").alias("cw"))
    per_question = Window.partitionBy("Id")
    answered = (asked.join(best, asked["AcceptedAnswerId"] == best["best"], "left")
                .withColumn("SelfAnswered", F.col("OwnerUserId") == F.col("by"))
                .join(every, asked["Id"] == every["ParentId"], "left")
                .withColumn("AnswersCount", F.count("answer").over(per_question))
                .withColumn("a", F.round(F.avg("aw").over(per_question), 9))
                .dropDuplicates(["Id"]))
    direct = (answered.join(said, answered["Id"] == said["PostId"], "left")
              .withColumn("CommentsCount", F.count("comment").over(per_question))
              .withColumn("PositiveCommentsCount", F.coalesce(F.sum("Sentiment").over(per_question), F.lit(0)))
              .withColumn("c", F.round(F.avg("cw").over(per_question), 9))
              .dropDuplicates(["Id"]).select(*ours.columns))
    assert as_set(ours) == as_set(direct)


def test_questions_per_tag_add_up(lake):
    asked, answers, comments = lake
    card = scorecard.tag_scorecard(
        questions.question_comment_info(questions.question_answer_info(asked, answers), comments))
    assert (card.agg(F.sum("QuestionsCount")).first()[0]
            == asked.agg(F.sum(F.size("Tags"))).first()[0])


def test_repeated_posts_and_comments_do_not_change_daily_usage(spark, forum):
    once = tag_usage.tag_usage_per_day(forum.posts, forum.comments, forum.synonyms, forum.tags)
    again = tag_usage.tag_usage_per_day(
        forum.posts.union(forum.posts), forum.comments.union(forum.comments), forum.synonyms, forum.tags)
    assert as_set(once) == as_set(again)


def test_daily_usage_without_whole_row_comparison(spark):
    posts, comments = tables.raw_posts(spark, FOLDER), tables.raw_comments(spark, FOLDER)
    dimensions = tables.synonyms(spark), tables.tags(spark, FOLDER)
    assert (as_set(tag_usage.tag_usage_per_day(posts, comments, *dimensions))
            == as_set(tag_usage.tag_usage_per_day(posts.dropDuplicates().dropna("all"), comments, *dimensions)))


def test_post_without_id_still_counts_in_daily_usage(spark, forum):
    nameless = forum.posts.where("Id = 6").withColumn("Id", F.lit(None).cast("long"))
    posts = forum.posts.where("Id <> 6").union(nameless)
    usage = tag_usage.tag_usage_per_day(posts, forum.comments, forum.synonyms, forum.tags)
    assert ("2024-01-04", 2, "spark", 1) in {tuple(r) for r in usage.collect()}


def test_posts_without_text_are_the_prepared_posts(spark, forum):
    bodies = forum.posts.where("Id = 1").withColumn("Body", F.lit("<i>other</i> text"))
    for posts in (forum.posts.union(bodies), tables.raw_posts(spark, FOLDER)):
        assert (as_set(prepare.prepare_posts_without_text(posts))
                == as_set(prepare.prepare_posts(posts).drop("Title", "Body")))
        assert (prepare.prepare_posts_without_text(posts).count() == prepare.prepare_posts(posts).count())


def test_rows_of_one_question_are_merged(spark, forum):
    other = forum.posts.where("Id = 2").withColumn("Tags", F.lit("<sql><postgres>")).withColumn("Score", F.lit(9))
    prepared = prepare.prepare_posts(forum.posts.union(other))
    merged = prepare.questions_from_posts(prepared, forum.synonyms).where("Id = 2").collect()
    assert [(r.Tags, r.Score) for r in merged] == [(["python", "sql"], 9)]


def test_synonym_with_two_targets_gives_both(spark):
    tagged = spark.createDataFrame([("x",), ("y",)], "Tag string")
    twice = spark.createDataFrame([("x", "a"), ("x", "b"), (None, "c")], "SourceTagName string, TargetTagName string")
    replaced = tag_usage.replace_tag_synonyms(tagged, twice)
    assert sorted(r.Tag for r in replaced.collect()) == ["a", "b", "y"]


def test_accepted_answer_stored_twice_does_not_repeat_the_question(lake):
    asked, answers, _ = lake
    info = questions.question_answer_info(asked, answers.union(answers.withColumn("Score", F.lit(-1))))
    assert info.count() == asked.count()


def test_supports_shrink_with_size(lake):
    counts = {tuple(r.items): r.freq for r in mining.frequent_itemsets(lake[0]).collect()}
    for items, freq in counts.items():
        for item in items:
            smaller = tuple(i for i in items if i != item)
            assert not smaller or counts[smaller] >= freq
    limited = mining.frequent_itemsets(lake[0], max_items=1, partitions=3)
    assert as_set(limited.select(F.col("items")[0].alias("i"), "freq")) == {
        (freq, items[0]) for items, freq in counts.items() if len(items) == 1}


def test_rules_are_those_of_the_model(lake):
    model = FPGrowth(itemsCol="Tags", minSupport=0.002, minConfidence=0.2).fit(lake[0])
    itemsets = mining.frequent_itemsets(lake[0], min_support=0.002)
    assert itemsets.agg(F.max(F.size("items"))).first()[0] >= 3
    ours = mining.association_rules(itemsets, lake[0].count(), min_confidence=0.2)
    values = [F.round(c, 9).alias(c) for c in ("confidence", "lift", "support")]
    assert as_set(ours.select("antecedent_list", "consequent_list", *values)) == as_set(
        model.associationRules.select(F.sort_array("antecedent").alias("antecedent_list"),
                                      F.col("consequent").alias("consequent_list"), *values))


def test_leaders_are_among_the_most_questioned(lake):
    asked, answers, comments = lake
    card = scorecard.tag_scorecard(
        questions.question_comment_info(questions.question_answer_info(asked, answers), comments))
    most = {r.Tag for r in report.most_questioned(card, 5).collect()}
    assert {r.Tag for r in report.leaderboards(card, among=5).collect()} == most


def test_series_covers_exactly_the_leading_tags(lake):
    counts, top = trends.day_tag_counts(lake[0]), trends.top_tags_per_day(lake[0], 1)
    leading = {r.Tag for r in top.collect()}
    series = trends.tag_frequency_series(lake[0], 1)
    assert as_set(series) == as_set(counts.where(F.col("Tag").isin(*leading)))
    days = [r.PartitionDate for r in series.collect()]
    assert days == sorted(days)


def test_support_counts_the_baskets_that_were_mined(spark):
    asked = spark.createDataFrame([(["a", "b"],), (["a"],), (None,), (None,)], "Tags array<string>")
    rules = mining.association_rules(mining.frequent_itemsets(asked), mining.count_baskets(asked)).collect()
    assert {(r.antecedent, r.support, r.lift) for r in rules} == {("a", 0.5, 1.0), ("b", 0.5, 1.0)}
