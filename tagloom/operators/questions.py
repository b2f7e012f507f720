"""Questions enriched with what happened to them.

Answers and comments are reduced to one row per question before they are joined, so the
joins never multiply rows and a question with very many answers costs one row.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import hours_between


def accepted_answers(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per question whose accepted answer exists.

    Questions without an accepted answer take no part: their NULL keys would all land
    in one task of an outer join.
    """
    asked = questions.where(F.col("AcceptedAnswerId").isNotNull()).select(
        "Id", "AcceptedAnswerId", F.col("OwnerUserId").alias("AskedBy"),
        F.col("CreationDate").alias("AskedAt"))
    given = answers.select(
        F.col("Id").alias("AcceptedAnswerId"), F.col("Score").alias("AcceptedAnswerScore"),
        F.col("WordsCount").alias("AcceptedAnswerWordsCount"),
        F.col("OwnerUserId").alias("AnsweredBy"), F.col("CreationDate").alias("AnsweredAt"))
    accepted = asked.join(given, "AcceptedAnswerId", "inner").select(
        "Id", "AcceptedAnswerScore", "AcceptedAnswerWordsCount",
        (F.col("AskedBy") == F.col("AnsweredBy")).alias("SelfAnswered"),
        hours_between("AskedAt", "AnsweredAt").alias("AcceptedAnswerAppearenceTimeInHours"))
    # Should an answer be stored twice, its values come from one of the rows, always the
    # same. Fixed-width buffers keep this a hash aggregate, and its exchange by Id also
    # serves the join to the questions.
    facts = accepted.columns[1:]
    chosen = F.xxhash64(*facts)
    return accepted.groupBy("Id").agg(*[F.max_by(f, chosen).alias(f) for f in facts])


def answer_counts(answers: DataFrame) -> DataFrame:
    """Answers and mean answer length per question that has any."""
    return (answers.where(F.col("ParentId").isNotNull())
            .groupBy(F.col("ParentId").alias("Id"))
            .agg(F.count("*").alias("AnswersCount"),
                 F.avg("WordsCount").alias("AverageAnswerWordsCount")))


def comment_counts(comments: DataFrame) -> DataFrame:
    """Comments, positive comments and mean comment length per post that has any."""
    return (comments.where(F.col("PostId").isNotNull())
            .groupBy(F.col("PostId").alias("Id"))
            .agg(F.count("*").alias("CommentsCount"),
                 F.sum("Sentiment").alias("PositiveCommentsCount"),
                 F.avg("WordsCount").alias("AvgCommentWordsCount")))


def question_answer_info(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Each question with its accepted answer's facts and its answer statistics."""
    return (
        questions.select("Id", "Score", "ViewCount", "Tags", "WordsCount", "CreationDate")
        .join(accepted_answers(questions, answers), "Id", "left")
        .join(answer_counts(answers), "Id", "left")
        .withColumn("AnswersCount", F.coalesce("AnswersCount", F.lit(0)))
    )


def question_comment_info(question_info: DataFrame, comments: DataFrame) -> DataFrame:
    """Add the statistics of the comments made on the question itself."""
    return (
        question_info.join(comment_counts(comments), "Id", "left")
        .withColumns({
            "CommentsCount": F.coalesce("CommentsCount", F.lit(0)),
            "PositiveCommentsCount": F.coalesce("PositiveCommentsCount", F.lit(0)),
        })
    )


def answer_count_buckets(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(Answers, Questions): number of questions with 0, 1, 2 and more than 2 answers."""
    counted = questions.select("Id").join(answer_counts(answers), "Id", "left")
    count = F.coalesce("AnswersCount", F.lit(0))
    bucket = F.when(count > 2, "> 2").otherwise(count.cast("string"))
    return counted.groupBy(bucket.alias("Answers")).agg(F.count("*").alias("Questions"))
