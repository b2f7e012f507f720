"""Data-quality profile of the raw exports."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.prepare import is_answer, is_question, with_body_digest
from tagloom.schemas import ANSWER_TYPE, QUESTION_TYPE

SKETCH_SIZE = 16_384
"""Accuracy of the quantile sketches: exact up to about so many rows, beyond that a rank is off by less than 0.1 % of the
rows. A sketch holds some three times as many numbers at most, however many rows it has seen."""
QUARTILES = (0.25, 0.5, 0.75)
PROFILE_PARTS = ("Count", "Mean", "Stddev", "Min", "Max", "Quantiles")
DAY_AND_TIME = "yyyy-MM-dd HH:mm:ss"


def profile_posts(posts: DataFrame) -> DataFrame:
    """(Measure, Count) of raw posts, from one grouping of equal rows.

    Each group is one distinct row and knows how often it came, so raw and deduplicated
    counts need only one pass and one shuffle, which carries a digest for each body.
    """
    posts = with_body_digest(posts)
    some_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in posts.columns])
    post_type = F.col("PostTypeId")
    untagged = (post_type == QUESTION_TYPE) & F.col("Tags").isNull()
    distinct_rows = posts.groupBy(*posts.columns).agg(F.count("*").alias("copies"))
    measures = distinct_rows.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("posts"),
        F.coalesce(F.sum(F.when(untagged, F.col("copies"))), F.lit(0)).alias("untagged_questions"),
        F.count("*").alias("distinct_posts"),
        F.count_if(some_value).alias("non_empty_posts"),
        F.count_if(~post_type.isin(QUESTION_TYPE, ANSWER_TYPE)).alias("other_post_types"),
        F.count_if(is_question()).alias("questions"),
        F.count_if(is_answer()).alias("answers"),
    )
    return measures.unpivot([], measures.columns, "Measure", "Count")


def data_profile(posts: DataFrame, comments: DataFrame, synonyms: DataFrame,
                 tags: DataFrame) -> DataFrame:
    """(Measure, Count) of all four raw tables."""
    def rows(table: DataFrame, name: str) -> DataFrame:
        return table.agg(F.count("*").alias("Count")).select(F.lit(name).alias("Measure"), "Count")

    return (profile_posts(posts).unionByName(rows(comments, "comments"))
            .unionByName(rows(synonyms, "tag_synonyms")).unionByName(rows(tags, "tags")))


def describe(table: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of each column, as text."""
    return table.describe(*columns)


def summarize(table: DataFrame, *statistics: str) -> DataFrame:
    """Like ``describe`` with approximate quartiles, or just the statistics named."""
    return table.summary(*statistics)


def profile_columns(table: DataFrame, quantiles: tuple = QUARTILES, sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """(Column, Type, Count, Mean, Stddev, Min, Max, Quantiles) of every column, one row each, in one pass.

    Count is of values that are not NULL. Counts, means, minima and maxima are exact; quantiles come from sketches that each
    task fills and the last one merges, so no column is sorted and nothing but sketches moves. Texts have no mean and no
    quantiles; of timestamps the quantiles are moments. Values are given as text, a column without values has none.
    """
    fields = [f for f in table.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.TimestampType, T.DateType))]
    described = table.agg(*[_description(f, quantiles, sketch_size).alias(f"c{k}") for k, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f.name).alias("Column"), F.lit(f.dataType.simpleString()).alias("Type"),
                              *[F.col(f"c{k}.{part}").alias(part) for part in PROFILE_PARTS])
                     for k, f in enumerate(fields)])
    return described.select(F.inline(rows))


def _description(field: T.StructField, quantiles: tuple, sketch_size: int) -> Column:
    value, kind = F.col(f"`{field.name}`"), field.dataType
    numeric = isinstance(kind, T.NumericType)

    def shown(c: Column) -> Column:
        return F.date_format(c, DAY_AND_TIME) if isinstance(kind, T.TimestampType) else c.cast("string")

    if isinstance(kind, T.IntegralType):
        sketch, quantile, back = F.kll_sketch_agg_bigint(value.cast("bigint"), F.lit(sketch_size)), F.kll_sketch_get_quantile_bigint, lambda c: c
    elif numeric:
        sketch, quantile, back = F.kll_sketch_agg_double(value.cast("double"), F.lit(sketch_size)), F.kll_sketch_get_quantile_double, lambda c: c
    elif isinstance(kind, (T.TimestampType, T.DateType)):
        moments = F.unix_micros(value.cast("timestamp"))
        sketch, quantile = F.kll_sketch_agg_bigint(moments, F.lit(sketch_size)), F.kll_sketch_get_quantile_bigint
        back = lambda c: F.timestamp_micros(c).cast(kind)
    else:
        sketch = None
    nothing = F.lit(None).cast("string")
    # A sketch without values has no quantile to ask for.
    asked = [nothing if sketch is None else F.when(F.count(value) > 0, shown(back(quantile(sketch, F.lit(float(q))))))
             for q in quantiles]
    no_number = F.lit(None).cast("double")
    return F.struct(F.count(value).alias("Count"), (F.avg(value) if numeric else no_number).cast("double").alias("Mean"),
                    (F.stddev(value) if numeric else no_number).alias("Stddev"), shown(F.min(value)).alias("Min"),
                    shown(F.max(value)).alias("Max"), F.array(*asked).alias("Quantiles"))


def profile_tables(**tables: DataFrame) -> DataFrame:
    """``profile_columns`` of several tables, with the name of the table first."""
    named = [profile_columns(rows).select(F.lit(name).alias("Table"), "*") for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, named)
