"""The report job: lake tables -> result CSV folders that a dashboard reads."""

from pyspark.sql import DataFrame, SparkSession

from tagloom import schemas
from tagloom.operators import mining, questions, scorecard, trends
from tagloom.sources.csv import read_csv, write_csv
from tagloom.sources.lake import Lake
from tagloom.staging import staged

# Folder and columns of each result.
RESULTS = {
    "general_info": "Category STRING, Count BIGINT",
    "top_most_frequent_tags": "items STRING, freq BIGINT",
    "association_rules_df": ("antecedent STRING, consequent STRING, confidence DOUBLE, "
                             "lift DOUBLE, support DOUBLE"),
    "tags_frequency": "PartitionDate TIMESTAMP, Tag STRING, Count BIGINT",
    "final_df": (
        "Tag STRING, QuestionsCount BIGINT, SumAnswersCount BIGINT, "
        "SumAcceptedAnswerCount BIGINT, SumSelfAnswered BIGINT, AnswersPerQuestions DOUBLE, "
        "AcceptedAnswersPerQuestions DOUBLE, SelfAnsweredPerQuestions DOUBLE, "
        "AvgAcceptedAnswerAppearenceTimeInHours DOUBLE, AvgQuestionViewCount DOUBLE, "
        "AvgQuestionWordsCount DOUBLE, AvgAnswerWordsCount DOUBLE, "
        "AvgAcceptedAnswerWordsCount DOUBLE, CommentsCountPerQuestion DOUBLE, "
        "PositiveCommentsPerQuestion DOUBLE, AvgCommentWordsCount_ DOUBLE, "
        "SumCommentsCount BIGINT, SumPositiveComments BIGINT, "
        "PortionsOfPositiveComments DOUBLE, PortionsOfAnswered DOUBLE"),
}


def run_analysis(lake: Lake, output: str, mode: str = "errorifexists") -> None:
    """Compute every result of a lake and write each to its folder below ``output``."""
    asked, answers, comments = (lake.read(name) for name in (
        schemas.QUESTIONS_TABLE, schemas.ANSWERS_TABLE, schemas.COMMENTS_TABLE))
    info = questions.question_comment_info(
        questions.question_answer_info(asked, answers), comments)
    with staged(mining.frequent_itemsets(asked), "itemsets") as itemsets:
        results = {
            "general_info": trends.general_info(asked, answers, comments),
            "top_most_frequent_tags": mining.top_itemsets(itemsets).drop("item_list"),
            "association_rules_df": mining.association_rules(itemsets, mining.count_baskets(asked)).drop(
                "antecedent_list", "consequent_list"),
            "tags_frequency": trends.tag_frequency_series(trends.with_partition_timestamp(asked)),
            "final_df": scorecard.tag_scorecard(info),
        }
        for name, result in results.items():
            write_csv(result, f"{output}/{name}", mode)


def read_result(spark: SparkSession, output: str, name: str) -> DataFrame:
    """A result table again, from all of its part files."""
    return read_csv(spark, f"{output}/{name}", RESULTS[name], multi_line=False)
