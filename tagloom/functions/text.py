"""Text cleaning expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns that decide the result. ``.`` does not match a line
# break, so a tag spread over lines loses the break but stays in the text.
TAG_PATTERN = "<.*?>"
LINE_BREAK = "\n"
WHITESPACE_RUN_PATTERN = r"\s\s+"


def strip_markup(text, separator: str = "") -> Column:
    """Remove HTML tags and line breaks, then shrink whitespace runs to one space.

    By default nothing is put in place of a tag, so ``<p>a</p><p>b</p>`` becomes ``ab``;
    pass ``separator=" "`` to keep such words apart.
    """
    without_tags = F.regexp_replace(text, TAG_PATTERN, separator)
    without_breaks = F.replace(without_tags, F.lit(LINE_BREAK), F.lit(separator))
    return F.regexp_replace(without_breaks, WHITESPACE_RUN_PATTERN, " ")


def word_count(text) -> Column:
    """Number of pieces between single spaces: ``''`` has 1, ``' a b '`` has 4, NULL has NULL."""
    return F.array_size(F.split(text, " "))
