"""Removal of repeated rows without moving wide rows that have no copy."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27
"""Size of the table of repeated digests, 16 MB however large the data are."""
BITMAP_BITS = 1 << 15  # fixed value: bits of one binary that bitmap_construct_agg makes


def _repeated_bits(digests: DataFrame, bits: int) -> DataFrame:
    """(__bucket, __bitmap): a bit set for each digest that several rows have; at most bits / 2^15 rows of 4 kB."""
    repeated = digests.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1")
    place = F.pmod("digest", F.lit(bits))
    return (repeated.select(F.floor(place / BITMAP_BITS).alias("__bucket"), (place % BITMAP_BITS).alias("position"))
            .groupBy("__bucket").agg(F.bitmap_construct_agg("position").alias("__bitmap")))


def _bit_is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(position, F.lit(8)).cast("int"))
    return F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))


def drop_repeated_rows(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """One of each set of rows that are equal in all columns, as ``dropDuplicates`` gives them.

    Rows are compared by a 64-bit digest first, of which only eight bytes a row are shuffled. Rows whose digest no
    other row has stay where they are; the others are moved and compared in full, so digests that meet by chance do no
    harm. Digests of several rows are marked in a table of ``bits`` bits, which is small enough to be
    broadcast whatever the data; a mark met by chance only moves a row for nothing. The rows are read three times.
    """
    digest = F.xxhash64(*rows.columns)
    marks = _repeated_bits(rows.select(digest.alias("digest")), bits)
    place = F.pmod(digest, F.lit(bits))
    marked = (rows.withColumn("__place", place)
              .join(F.broadcast(marks), F.floor(F.col("__place") / BITMAP_BITS) == F.col("__bucket"), "left")
              .withColumn("__meets", _bit_is_set(F.col("__bitmap"), F.col("__place") % BITMAP_BITS)))
    alone = marked.where("NOT __meets").select(*rows.columns)
    return alone.unionByName(marked.where("__meets").select(*rows.columns).dropDuplicates())
