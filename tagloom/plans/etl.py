"""The load job: CSV exports -> lake tables."""

from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.functions.sentiment import Scorer
from tagloom.operators.prepare import (
    answers_from_posts, prepare_comments, prepare_posts_without_text, questions_from_posts)
from tagloom.sources.csv_parts import SPLIT_FROM, parsed_csv
from tagloom.sources.lake import Lake
from tagloom.staging import staged

CORRUPT = "_corrupt_record"
ACCOUNTING = "Export string, Read bigint, Loaded bigint, Rejected bigint"


@dataclass(frozen=True)
class Landing:
    """An export as Parquet: its records parsed once, in files that any number of tasks can read."""

    rows: DataFrame      # the records that fit the schema
    rejected: DataFrame  # the others, with their text
    counts: dict[str, int]


def run_etl(spark: SparkSession, lake: Lake, posts_csv: list[str], comments_csv: list[str],
            synonyms_csv: list[str], incremental: bool, sentiment: Scorer | None = None,
            rejects: str | None = None, split_from: int = SPLIT_FROM) -> DataFrame:
    """Clean the exports and load them, by upsert when incremental, else by overwrite.

    A record that does not fit its schema, in any column, fails the load before a table is touched. With ``rejects``,
    a folder, such records are written there instead, as Parquet per export and with their text, and all
    others are loaded. Returns what became of the records: (Export, Read, Loaded, Rejected).

    Files of ``split_from`` bytes or more are read by many tasks each.
    """
    exports = {"posts": (posts_csv, schemas.POSTS), "comments": (comments_csv, schemas.COMMENTS),
               "synonyms": (synonyms_csv, schemas.TAG_SYNONYMS)}
    with ExitStack() as stack:
        landed = {name: _landed(stack, spark, name, paths, schema, split_from)
                  for name, (paths, schema) in exports.items()}
        for name, landing in landed.items():
            if rejects is not None:
                landing.rejected.write.mode("append").parquet(f"{rejects}/{name}")
            elif landing.counts["rejected"]:
                raise ValueError(f"{landing.counts['rejected']} of {landing.counts['read']} records of the "
                                 f"{name} export are malformed; nothing was loaded")
        load_lake(lake, *[landing.rows for landing in landed.values()], incremental, sentiment)
    return spark.createDataFrame(
        [(name, x.counts["read"], x.counts["read"] - x.counts["rejected"], x.counts["rejected"])
         for name, x in landed.items()], ACCOUNTING)


def _landed(stack: ExitStack, spark: SparkSession, name: str, paths: list[str], schema: str,
            split_from: int) -> Landing:
    """Parse an export once; the files go when the stack closes."""
    with parsed_csv(spark, paths, schema, CORRUPT, split_from) as records:
        table = stack.enter_context(staged(records, f"export-{name}"))
    # The counts read one column, which is NULL nearly everywhere. (Spark's observed metrics would save this
    # scan, but a session that has used them can no longer serialize the tasks of some of Spark ML's models.)
    counts = table.agg(F.count(F.lit(1)).alias("read"), F.count(CORRUPT).alias("rejected")).first().asDict()
    return Landing(table.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
                   table.where(F.col(CORRUPT).isNotNull()), counts)


def load_lake(lake: Lake, posts: DataFrame, comments: DataFrame, synonyms: DataFrame,
              incremental: bool, sentiment: Scorer | None = None) -> None:
    # Questions and answers come from the same cleaned posts. These are written once, short
    # and split by type, so the raw posts are read and compared once and each table then
    # scans its own part.
    short = prepare_posts_without_text(posts).where(
        F.col("PostTypeId").isin(schemas.QUESTION_TYPE, schemas.ANSWER_TYPE))
    with staged(short, "posts", partition_by="PostTypeId") as prepared:
        tables = {
            schemas.QUESTIONS_TABLE: questions_from_posts(prepared, synonyms),
            schemas.ANSWERS_TABLE: answers_from_posts(prepared),
            schemas.COMMENTS_TABLE: prepare_comments(comments, sentiment),
        }
        if incremental:
            lake.upsert_all(tables)
        else:
            lake.overwrite_all(tables)
