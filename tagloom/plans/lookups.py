"""Joins to dimension tables whose size is checked before they are broadcast."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
HOT_KEYS, TRACKED_KEYS = 200, 10_000
"""A key with at least one in so many rows is hot; sketches track so many keys to find them."""


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure rows and bytes of a table with one distributed aggregate."""
    width = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            width = width + F.lit(8)
    seen = df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def lookup_join(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str,
                how: str, max_rows: int = MAX_BROADCAST_ROWS,
                max_bytes: int = MAX_BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """Join facts to a dimension on one key each; ``how`` is ``inner`` or ``left``.

    A dimension of proven small size is broadcast, so the facts stay where they are
    however uneven their keys. A larger one is repeated once per salt and joined by
    shuffle on (key, salt), which spreads a hot fact key over ``salts`` tasks.
    """
    if fits_broadcast(dimension, max_rows, max_bytes):
        return facts.join(F.broadcast(dimension),
                          facts[fact_key] == dimension[dimension_key], how)
    salted_facts = facts.withColumn(
        "__fact_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    salted_dimension = dimension.withColumn("__dimension_salt", F.explode(every_salt))
    same = ((salted_facts[fact_key] == salted_dimension[dimension_key])
            & (salted_facts["__fact_salt"] == salted_dimension["__dimension_salt"]))
    return (salted_facts.join(salted_dimension, same, how)
            .drop("__fact_salt", "__dimension_salt"))


def hot_keys(df: DataFrame, key: str, share: int = HOT_KEYS) -> DataFrame:
    """(hot): the keys that hold one in ``share`` rows or more, so ``share`` keys at most.

    One pass with a sketch of frequent items per task; only the sketches meet. A key that is counted too high by
    the sketch's error is salted without need, which changes no result.
    """
    most = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {share}, {TRACKED_KEYS})").alias("top"), F.count("*").alias("rows"))
    return (most.select(F.explode("top").alias("seen"), "rows")
            .where(F.col("seen.count") * share >= F.col("rows")).select(F.col("seen.item").alias("hot")).limit(share))


def hot_key_join(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str,
                 salts: int = SALTS) -> DataFrame:
    """Inner join of facts, whose keys may be hot, to a dimension of any size. NULL keys match nothing.

    Rows of hot keys are dealt over ``salts`` tasks, and the dimension rows of these keys, few by the
    bound on hot keys, are repeated as often; all others are joined as they are. Facts that are equal in all columns share a salt.

    The facts are freed of NULL keys here, so null-safe equality finds the same pairs as plain equality. It keeps the
    optimizer from filtering the dimension, and one that the caller also uses as it is stays the same plan, computed once.
    """
    facts = facts.where(F.col(fact_key).isNotNull())
    hot = hot_keys(facts, fact_key)
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    dealt = facts.join(F.broadcast(hot), facts[fact_key] == hot["hot"], "left").select(
        *[facts[c] for c in facts.columns], F.when(F.col("hot").isNotNull(), salt).otherwise(0).alias("__fact_salt"))
    every = F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = dimension.join(F.broadcast(hot), dimension[dimension_key] == hot["hot"], "left").select(
        *[dimension[c] for c in dimension.columns], F.explode(every).alias("__dimension_salt"))
    same = (dealt[fact_key].eqNullSafe(repeated[dimension_key])
            & dealt["__fact_salt"].eqNullSafe(repeated["__dimension_salt"]))
    return dealt.join(repeated, same).drop("__fact_salt", "__dimension_salt")
