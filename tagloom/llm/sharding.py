"""Shards balanced in bytes, tokens and rows together, by vector bin packing.

Groups of equal texts stay together. A group is placed where the dot product of its size vector
and the remaining capacity is highest. Only a bounded number of units is placed one by one:

* a group larger than a shard in any measure is first cut into parts by document id; at most
  ``3 * shards`` groups can be that large. Rows of one id that fill a unit by themselves are dealt over the
  parts by their stored place;
* a group or part above ``1 / HEAVY`` of a shard in any measure is a unit of its own; there can be
  at most ``3 * shards * HEAVY`` of them;
* all smaller groups go by hash to ``2 * shards * BUCKETS`` buckets, which are the other units. Every
  eighth group goes to the fine half of the buckets, which are placed last and level the rest.

The unit sizes are the only data that the driver sees, whatever the number of documents.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import BLANK, digest_of, stored, text_or_empty

SHARDS = 24
HEAVY = 64
BUCKETS = 64
MEASURES = ("size", "tokens", "rows")
WEIGHTS = (4.0, 1.0, 1.0)
"""Pull of each measure in the dot product; bytes count most, since shards are read by bytes."""
CUTS = 4
"""Parts per shard that a group larger than a shard is cut into; finer parts level better."""
SLOT_CHUNKS = 1024


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Bytes (UTF-8 and 8 for the id), words, checksum and text digest of each document."""
    text = text_or_empty(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.regexp_count(text, F.lit(BLANK.replace("[", "[^") + "+")).cast("long").alias("tokens"),
        F.crc32(text).alias("text_crc32"), digest_of(text).alias("group"))


def place(vectors: np.ndarray, shards: int, weights=WEIGHTS) -> np.ndarray:
    """Shard of each unit, the units taken in the order given.

    ``vectors`` has one row per unit, each measure as a share of one shard's capacity.
    """
    pull = np.asarray(weights)
    left = np.ones((shards, vectors.shape[1]))
    chosen = np.zeros(len(vectors), dtype=np.int64)
    for unit, vector in enumerate(vectors):
        chosen[unit] = shard = int(np.argmax(left @ (vector * pull)))
        left[shard] -= vector
    return chosen


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))


def shard(docs: DataFrame, shards: int = SHARDS, heavy: int = HEAVY, buckets: int = BUCKETS,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shard and slot of each document: doc_id, size, text_crc32, shard, slot.

    * A missing text has 8 bytes and no words. Equal texts share a shard, unless their group is
      larger than a shard; then its parts do.
    * Rows repeated in full are one group, of any size, and each get a slot of their own; a missing id is
      treated as any other id. Slots count from 0 without gaps in each shard.
    * An empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    # The place is written with the row, so all later steps see the same one.
    rows = stored(measured(docs, id_column, text_column).withColumn("place", F.monotonically_increasing_id()), "shard-sizes")
    total = rows.agg(*[F.sum(m).alias(m) for m in MEASURES[:2]], F.count("*").alias("rows")).first()
    capacity = [max((total[m] or 0) / shards, 1e-9) for m in MEASURES]

    def share() -> Column:
        return F.greatest(*[F.col(m) / F.lit(c) for m, c in zip(MEASURES, capacity, strict=True)])

    groups = _sums(rows, "group")
    cut = groups.where(share() > 1).select("group", F.ceil(share() * CUTS).alias("parts"))
    # Rows that repeat one id of a group to be cut; like heavy units, at most 3 * shards * heavy ids can be such.
    repeated = (_sums(rows.join(F.broadcast(cut.select("group")), "group"), "group", "doc_id").where("rows > 1")
                .where(share() > 1 / heavy).select(F.col("group").alias("in_group"), F.col("doc_id").alias("of_id")))
    rows = (rows.join(F.broadcast(cut), "group", "left")
            .join(F.broadcast(repeated), (F.col("group") == F.col("in_group")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left")
            .withColumn("dealt", F.when(F.col("in_group").isNull(), F.xxhash64("doc_id")).otherwise(F.col("place")))
            .withColumn("part", F.coalesce(F.pmod("dealt", "parts"), F.lit(0).cast("long"))))
    units = stored(_sums(rows, "group", "part"), "shard-units")

    spread = F.xxhash64("group", "part")
    in_fine = F.pmod(spread, F.lit(8)) == 7
    bucket = F.pmod(F.xxhash64("part", "group"), F.lit(shards * buckets)) * 2 + in_fine.cast("int")
    is_heavy = share() > 1 / heavy
    large = units.where(is_heavy).orderBy("group", "part").toPandas()
    small = (units.where(~is_heavy).groupBy(bucket.alias("bucket"))
             .agg(*[F.sum(m).alias(m) for m in MEASURES]).orderBy("bucket").toPandas())

    vectors = np.concatenate([frame[list(MEASURES)].to_numpy(dtype=float) / capacity
                              for frame in (large, small)])
    order = np.argsort(-vectors.max(axis=1), kind="stable") if len(vectors) else np.zeros(0, int)
    shard_of = np.zeros(len(vectors), dtype=np.int64)
    shard_of[order] = place(vectors[order], shards)
    heavy_shards = spark.createDataFrame(
        [(bytes(g), int(p), int(s)) for g, p, s in zip(large["group"], large["part"], shard_of)],
        "group binary, part bigint, heavy_shard int")
    bucket_shards = spark.createDataFrame(
        [(int(b), int(s)) for b, s in zip(small["bucket"], shard_of[len(large):])],
        "bucket bigint, bucket_shard int")

    placed = (rows.join(F.broadcast(heavy_shards), ["group", "part"], "left")
              .withColumn("bucket", bucket)
              .join(F.broadcast(bucket_shards), "bucket", "left")
              .select("doc_id", "size", "text_crc32", "dealt",
                      F.coalesce("heavy_shard", "bucket_shard").alias("shard")))
    return with_slots(placed)


def with_slots(placed: DataFrame, chunks: int = SLOT_CHUNKS) -> DataFrame:
    """Number the rows of each shard from 0, in chunks by ``dealt``, so that no task orders a whole shard."""
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("dealt"), F.lit(chunks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "chunk").count()
              .select("shard", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")
    # One row per shard and chunk: at most shards * chunks rows.
    return (placed.withColumn("place", F.row_number().over(within) - 1)
            .join(F.broadcast(starts), ["shard", "chunk"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("start") + F.col("place")).cast("long").alias("slot")))
