"""Tag string expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_tags(tag_string) -> Column:
    """``'<a><b>'`` -> ``['a', 'b']``; repeated tags are kept, empty ones dropped."""
    closed = F.replace(F.col(tag_string) if isinstance(tag_string, str) else tag_string,
                       F.lit("<"), F.lit(""))
    return F.array_remove(F.split(closed, ">"), "")


def tag_label(tags) -> Column:
    """Readable label of an itemset. Tags may hold ``-`` themselves, so keep the array too."""
    return F.concat_ws("-", tags)
