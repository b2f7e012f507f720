"""Exact deduplication that stays even when one text makes up a third of all rows.

Copies are combined three times: inside each task (the map side of the first aggregate), per
(digest, content, salt), and over the salts. The salt follows from the task that read the row, so
a salted group never holds more rows than there are tasks per salt, and the last step sees at most
``salts`` rows of a content. The content itself is a grouping key at each of these stages, so
two texts that share a digest are never merged.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import BLANK, digest_of, stored, text_or_empty

SALTS = 64


def normalised(text: str) -> Column:
    """Every run of white space as one space; NULL as empty text."""
    return F.regexp_replace(text_or_empty(text), BLANK + "+", " ")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 salts: int = SALTS, digest=digest_of) -> DataFrame:
    """Group of equal normalised texts for each row: doc_id, keep_id, group_size, kept, digest.

    * NULL and empty texts are equal; so are texts that differ in white space only.
    * ``keep_id`` is the smallest id of the group. Rows without an id are counted, but stay
      only if nobody in their group has one: then ``keep_id`` is NULL and all of them are kept.
    * Rows repeated in full share one id, and each of them is reported, with the same answer.
    * An empty table gives an empty result; columns other than the two named are ignored.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"),
                       normalised(text_column).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))

    salted = (rows.withColumn("salt", F.spark_partition_id() % salts)
              .groupBy("digest", "content", "salt")
              .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    # Partitioning by digest alone also serves the count of contents below.
    winners = (salted.repartition("digest").groupBy("digest", "content")
               .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    contents = F.count("*").over(Window.partitionBy("digest"))
    winners = stored(
        winners.withColumn("contents", contents)
        .withColumn("content", F.when(F.col("contents") > 1, F.col("content"))).drop("contents"),
        "exact-winners")

    # A digest of one content names its group. Contents that share a digest are joined in full.
    plain = (rows.select("doc_id", "digest")
             .join(winners.where("content IS NULL").drop("content"), "digest"))
    shared = stored(winners.where("content IS NOT NULL"), "exact-shared-digests")
    shared = rows.join(shared, ["digest", "content"]).drop("content")
    return plain.unionByName(shared).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of an id with several texts only the copies go."""
    digest = options.get("digest", digest_of)
    gone = (exact_groups(docs, id_column, text_column, **options).where("NOT kept")
            .select(F.col("doc_id").alias("__gone"), F.col("digest").alias("__digest")).distinct())
    same = docs[id_column].eqNullSafe(gone["__gone"]) & (digest(normalised(docs[text_column])) == gone["__digest"])
    return docs.join(gone, same, "left_anti")
