"""Helpers that several operators share: stored intermediate tables and word expressions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.staging import new_path, remove

BLANK = r"[ \t-\r]"
"""The white space of all contracts here: U+0020 and U+0009 to U+000D."""
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_ID = -(2 ** 63)
"""Stands for a missing document id where ids are compared."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and scan them from there.

    This cuts the lineage: rows survive the loss of any executor and are computed once.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def stored_in_few(df: DataFrame, label: str) -> DataFrame:
    """``stored`` for rows of a few numbers each: in two files per core at most, since many tiny files cost more than the rows.

    Tasks go through their partitions one after the other, so none is held as a whole with another.
    """
    return stored(df.coalesce(max(12, 2 * df.sparkSession.sparkContext.defaultParallelism)), label)


def release(*tables: DataFrame | None) -> None:
    """Delete tables that ``stored`` wrote and that no later step reads."""
    for table in tables:
        if table is not None:
            remove(table.sparkSession, table.stored_path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def digest_of(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))
