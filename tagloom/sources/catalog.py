"""Upsert into a catalog table whose format merges rows itself, such as a Delta table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_by_key(rows: DataFrame, table: str, key: str = "Id") -> None:
    """Update the rows whose key is in the table and insert the others.

    Spark hands the merge to the table's format; one that cannot merge raises
    UnsupportedOperationException. Tables of plain Parquet files use ``Lake.upsert`` instead.
    """
    same_key = F.col(f"{table}.{key}") == F.col(f"incoming.{key}")
    (rows.alias("incoming").mergeInto(table, same_key)
     .whenMatched().updateAll()
     .whenNotMatched().insertAll()
     .merge())
