"""The hand-made forum against its expected tables."""

from datetime import datetime
from math import inf

import pytest

from tagloom.operators import mining, prepare, questions, report, scorecard, tag_usage, trends


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def lake(forum):
    posts = prepare.prepare_posts(forum.posts)
    asked = prepare.questions_from_posts(posts, forum.synonyms)
    answers = prepare.answers_from_posts(posts)
    comments = prepare.prepare_comments(forum.comments)
    return asked, answers, comments


@pytest.fixture(scope="module")
def info(lake):
    asked, answers, comments = lake
    return questions.question_comment_info(questions.question_answer_info(asked, answers), comments)


def test_prepare_posts(forum):
    prepared = prepare.prepare_posts(forum.posts)
    assert prepared.columns == [
        "Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "OwnerUserId", "Score", "ViewCount",
        "Title", "Body", "Tags", "CreationDate", "ClosedDate", "WordsCount"]
    assert rows(prepared, "Id", "Body", "WordsCount") == sorted([
        (1, "How to x", 3), (2, "why", 1), (3, "a b c", 3), (5, "untagged", 1), (7, "wiki", 1),
        (11, "use y", 2), (12, "one two three four", 4), (13, "no", 1)], key=repr)


def test_questions(lake):
    assert rows(lake[0], "Id", "WordsCount", "PartitionDate", "Tags", "AcceptedAnswerId") == [
        (1, 3, "01_01_2024", ["python", "spark"], 11),
        (2, 1, "01_01_2024", ["python"], None),
        (3, 3, "02_01_2024", ["python", "sql"], 12)]


def test_answers(lake):
    assert rows(lake[1], "Id", "ParentId", "WordsCount", "PartitionDate") == [
        (11, 1, 2, "01_01_2024"), (12, 3, 4, "02_01_2024"), (13, 1, 1, "03_01_2024")]


def test_comments(lake):
    assert rows(lake[2], "Id", "PostId", "Score", "WordsCount", "Sentiment") == [
        (21, 1, 0, 2, 1), (22, 1, 1, 2, 0), (23, 11, 0, 1, 1), (25, 3, 0, 2, 1)]


def test_question_comment_info(info):
    assert info.columns == [
        "Id", "Score", "ViewCount", "Tags", "WordsCount", "CreationDate", "AcceptedAnswerScore",
        "AcceptedAnswerWordsCount", "SelfAnswered", "AcceptedAnswerAppearenceTimeInHours",
        "AnswersCount", "AverageAnswerWordsCount", "CommentsCount", "PositiveCommentsCount",
        "AvgCommentWordsCount"]
    assert rows(info, "Id", *info.columns[6:]) == [
        (1, 3, 2, False, 2.0, 2, 1.5, 2, 1, 2.0),
        (2, None, None, None, None, 0, None, 0, 0, None),
        (3, 2, 4, True, 12.0, 1, 4.0, 1, 1, 2.0)]


def test_tag_scorecard(info):
    card = scorecard.tag_scorecard(info)
    assert [r.Tag for r in card.collect()] == ["python", "spark", "sql"]
    picked = card.select(
        "Tag", "QuestionsCount", "SumAnswersCount", "SumAcceptedAnswerCount", "SumSelfAnswered",
        "AvgAcceptedAnswerAppearenceTimeInHours", "AvgQuestionViewCount", "AvgQuestionWordsCount",
        "AvgAnswerWordsCount", "AvgAcceptedAnswerWordsCount", "SumCommentsCount",
        "SumPositiveComments", "PortionsOfPositiveComments", "PortionsOfAnswered").collect()
    expected = [
        ("python", 3, 3, 2, 1, 7.0, 160 / 3, 7 / 3, 2.75, 3.0, 3, 2, 2 / 3, 2 / 3),
        ("spark", 1, 2, 1, 0, 2.0, 100.0, 3.0, 1.5, 2.0, 2, 1, 0.5, 1.0),
        ("sql", 1, 1, 1, 1, 12.0, 50.0, 3.0, 4.0, 4.0, 1, 1, 1.0, 1.0)]
    for got, want in zip(picked, expected, strict=True):
        assert got[0] == want[0]
        assert list(got[1:]) == pytest.approx(list(want[1:]))


def test_scorecard_of_an_unanswered_tag(info):
    card = scorecard.tag_scorecard(info.where("Id = 2")).collect()[0]
    assert card.AvgAcceptedAnswerAppearenceTimeInHours == inf
    assert (card.SumSelfAnswered, card.AvgAnswerWordsCount) == (0, 0.0)
    assert card.AvgAcceptedAnswerWordsCount is None and card.AvgCommentWordsCount_ is None
    assert (card.PortionsOfPositiveComments, card.PortionsOfAnswered) == (0.0, 0.0)


def test_day_tag_counts(lake):
    expected = [("01_01_2024", "python", 2), ("01_01_2024", "spark", 1),
                ("02_01_2024", "python", 1), ("02_01_2024", "sql", 1)]
    assert rows(trends.day_tag_counts(lake[0])) == expected
    assert rows(trends.top_tags_per_day(lake[0])) == expected
    assert rows(trends.top_tags_per_day(lake[0], 1)) == [expected[0], expected[2]]
    # spark and sql lead no day when only one tag per day counts.
    assert rows(trends.tag_frequency_series(lake[0], 1)) == [expected[0], expected[2]]


def test_partition_timestamp(lake):
    dated = trends.with_partition_timestamp(lake[0])
    assert rows(dated, "Id", "PartitionDate")[2] == (3, datetime(2024, 1, 2))


def test_tag_usage_per_day(forum):
    usage = tag_usage.tag_usage_per_day(forum.posts, forum.comments, forum.synonyms, forum.tags)
    assert usage.columns == ["Date", "TagId", "Tag", "Count"]
    assert rows(usage) == sorted([
        ("2024-01-01", 1, "python", 11), ("2024-01-01", 2, "spark", 5),
        ("2024-01-02", 1, "python", 3), ("2024-01-03", 1, "python", 2),
        ("2024-01-03", 2, "spark", 1), ("2024-01-04", 2, "spark", 1),
        (None, 1, "python", 1)], key=repr)


def test_general_info(lake):
    assert [tuple(r) for r in trends.general_info(*lake).collect()] == [
        ("Questions", 3), ("Answers", 3), ("Comments", 4)]


def test_mining(lake):
    itemsets = mining.frequent_itemsets(lake[0])
    assert rows(itemsets) == sorted([
        (["python"], 3), (["spark"], 1), (["sql"], 1), (["python", "spark"], 1),
        (["python", "sql"], 1)], key=repr)
    assert len(rows(mining.frequent_itemsets(lake[0], max_items=1))) == 3
    assert [tuple(r) for r in mining.top_itemsets(itemsets, 2).collect()] == [
        ("python", ["python"], 3), ("python-spark", ["python", "spark"], 1)]
    rules = mining.association_rules(itemsets, 3)
    got = rows(rules, "antecedent", "consequent", "confidence", "lift", "support")
    third = pytest.approx(1 / 3)
    assert got == [("python", "spark", third, 1.0, third), ("python", "sql", third, 1.0, third),
                   ("spark", "python", 1.0, 1.0, third), ("sql", "python", 1.0, 1.0, third)]
    assert rows(mining.rule_graph_nodes(rules)) == [("python",), ("spark",), ("sql",)]
    assert rows(mining.rule_graph_edges(rules), "source", "target", "label")[0] == (
        "python", "spark", "0.3333")


def test_buckets_and_averages(lake, info):
    assert rows(questions.answer_count_buckets(lake[0], lake[1])) == [("0", 1), ("1", 1), ("2", 1)]
    averages = {r.Tag: r for r in scorecard.tag_averages(info).collect()}
    assert averages["python"].AverageQuestionScore == 2.0
    assert averages["python"].AverageAcceptedAnswerWordsCount == 3.0


def test_leaderboards(info):
    card = scorecard.tag_scorecard(info)
    board = report.leaderboard(card, "AvgQuestionViewCount", length=2)
    assert rows(board, "Side", "Rank", "Tag") == [
        ("bottom", 1, "sql"), ("bottom", 2, "python"), ("top", 1, "spark"), ("top", 2, "python")]
    # Equal values keep scorecard order on both sides.
    tied = report.leaderboard(card, "PortionsOfAnswered", length=3)
    assert rows(tied, "Side", "Rank", "Tag") == [
        ("bottom", 1, "python"), ("bottom", 2, "spark"), ("bottom", 3, "sql"),
        ("top", 1, "spark"), ("top", 2, "sql"), ("top", 3, "python")]
    assert report.leaderboards(card).select("Metric").distinct().count() == 9


def test_missing_values_rank_last(spark):
    card = spark.createDataFrame(
        [("a", 3, None), ("b", 2, 1.0), ("c", 1, inf)], "Tag string, QuestionsCount long, M double")
    board = report.leaderboard(card, "M")
    assert [(r.Side, r.Tag) for r in board.orderBy("Side", "Rank").collect()] == [
        ("bottom", "b"), ("bottom", "c"), ("bottom", "a"), ("top", "c"), ("top", "b"), ("top", "a")]


def test_tag_overview_and_options(info):
    card = scorecard.tag_scorecard(info)
    assert rows(report.tag_overview(card, "python"), "Chart", "Category", "Count") == sorted([
        ("Publications", "Questions", 3), ("Publications", "Answers", 3),
        ("Publications", "Comments", 3), ("Comments", "negative", 1), ("Comments", "positive", 2),
        ("Questions", "not_answered", 1), ("Questions", "answered", 2)], key=repr)
    assert report.tag_overview(card).count() == 21
    assert rows(report.tag_options(card, 2)) == [("python",), ("spark",)]
