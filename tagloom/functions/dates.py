"""Day keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two day formats of the stored and the reported tables.
PARTITION_DAY_FORMAT = "dd_MM_yyyy"
REPORT_DAY_FORMAT = "yyyy-MM-dd"


def partition_day(timestamp) -> Column:
    return F.date_format(timestamp, PARTITION_DAY_FORMAT)


def report_day(timestamp) -> Column:
    return F.date_format(timestamp, REPORT_DAY_FORMAT)


def parse_partition_day(day) -> Column:
    """Partition day string -> timestamp of midnight; NULL where the string is no day."""
    return F.try_to_timestamp(day, F.lit(PARTITION_DAY_FORMAT))


def hours_between(start, end) -> Column:
    """Hours from start to end, counted in whole seconds; may be negative."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / 3600
