"""Audit of how filters interact: what each one removes, in every order in which they can be applied.

A document is known by the set of filters that it fails, one of 2^n masks. Documents are counted by part and mask;
from there on the data are small. In an order that puts filter f at place P[f], the step at which a document with
mask M goes is the least P[f] over the filters f in M: a product of the mask matrix with the position
matrix in which addition becomes minimum and 0 and infinity stand for failing and passing. Counts are then scattered to
these steps, with weights for good and for toxic documents.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import text_or_empty

# The letters of the five filters, whose bits are 1, 2, 4, 8 and 16 in this order.
FILTERS = "ABCDE"
COPIED = 16
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5  # words, percent, percent
SYMBOLS = b"#$%&*|"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_LABEL_SALTS = 64


def failures_of(text: bytes, characters: int) -> int:
    """The filters A to D that a text fails, as bits; ``characters`` is its number of code points."""
    words = text.split()  # bytes split at the six ASCII blanks only
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS * characters) << 2
            | (len(text) != len(text.translate(None, SYMBOLS))) << 3)


def judged(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           part_column: str = "source") -> DataFrame:
    """doc, part, mask (filters A to D) and the text's SHA-256 of each row; short rows in place of texts."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            texts = batch.column("text").cast(pa.binary())
            for text, characters in zip(texts, batch.column("characters"), strict=True):
                value = text.as_py()
                masks.append(failures_of(value, characters.as_py()))
                digests.append(hashlib.sha256(value).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                names=["doc", "part", "mask", "digest"])

    text = text_or_empty(text_column)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc"),
                       F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.char_length(text).alias("characters"))
    return rows.mapInArrow(judge, "doc bigint, part string, mask int, digest binary")


def _with_labels(rows: DataFrame, labels: DataFrame, id_column: str) -> DataFrame:
    """Adds good and toxic (0 or 1). An id labelled more than once counts if any of its labels says so."""
    known = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("bigint").alias("known")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
        F.lit(0).alias("known_salt"))
    # Rows without an id match nothing; the salt keeps them from meeting in one task.
    salted = rows.withColumn("salt", F.when(F.col("doc").isNull(), F.pmod(F.xxhash64("digest"), F.lit(_NO_LABEL_SALTS)))
                             .otherwise(0).cast("int"))
    same = (salted["doc"] == known["known"]) & (salted["salt"] == known["known_salt"])
    return salted.join(known, same, "left").select(
        "doc", "part", "mask", "digest", "n", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"))


def counted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            part_column: str = "source") -> DataFrame:
    """part, mask (all five filters), n, good and toxic: documents by part and set of filters that they fail.

    Filter E fails a row whose text a row with a smaller id has, anywhere in the table. All rows of one text
    share their mask, so rows are counted by text, part and label before those of one text meet: a text that
    a third of all rows have comes down to a few rows per part.
    """
    each = judged(docs, id_column, text_column, part_column).groupBy("doc", "part", "mask", "digest").agg(
        F.count("*").alias("n"))
    # One row per id, so the least (id, count) of a group says how many rows have its least id.
    groups = (_with_labels(each, labels, id_column).groupBy("digest", "mask", "part", "good", "toxic", "doc")
              .agg(F.sum("n").alias("n")).groupBy("digest", "mask", "part", "good", "toxic").agg(
                  F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
                  F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n"))).alias("first")))
    least = groups.groupBy("digest").agg(F.min("first.doc").alias("least"))
    rows = groups.join(least, "digest")
    originals = F.col("unnamed") + F.when(F.col("first.doc") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(COPIED)).alias("mask"), (F.col("n") - originals).alias("n"))))
    return (rows.select("part", "good", "toxic", split.alias("s")).groupBy("part", "s.mask").agg(
        F.sum("s.n").alias("n"), F.sum(F.col("s.n") * F.col("good")).alias("good"),
        F.sum(F.col("s.n") * F.col("toxic")).alias("toxic")))


@dataclass(frozen=True)
class RemovalSteps:
    """When each mask goes in each order of the filters."""

    names: str
    orders: tuple  # all permutations, as strings
    step: np.ndarray  # orders x masks; len(names) where nothing is failed

    @classmethod
    def of(cls, names: str) -> "RemovalSteps":
        n = len(names)
        places = np.array(list(permutations(range(n))))  # the filter at each place
        position = np.argsort(places, axis=1)  # inverse permutation: the place of each filter
        failed = (np.arange(2 ** n)[:, None] >> np.arange(n)) & 1
        masks = np.where(failed == 1, 0.0, np.inf)
        # Min-plus product of orders x filters and filters x masks.
        step = (position[:, :, None] + masks.T[None, :, :]).min(axis=1)
        return cls(names, tuple("".join(names[i] for i in p) for p in places),
                   np.where(np.isinf(step), n, step).astype(np.int64))


def _audit_of(part: str, counts: dict[str, np.ndarray], steps: RemovalSteps) -> dict[str, list]:
    """The rows of one part: a number for each order and step; ``counts`` holds a weight per mask."""
    n, orders = len(steps.names), len(steps.orders)
    order_of = np.repeat(np.arange(orders), steps.step.shape[1])
    cell = order_of * (n + 1) + steps.step.ravel()

    def scattered(weights: np.ndarray) -> np.ndarray:
        """Weight that goes at each step of each order; the last column is what stays."""
        made = np.zeros(orders * (n + 1), np.int64)
        np.add.at(made, cell, np.tile(weights, orders))
        return made.reshape(orders, n + 1)

    removed, good, toxic = (scattered(counts[k]) for k in ("n", "good", "toxic"))
    place = np.array([[steps.names.index(c) for c in order] for order in steps.orders])
    masks = np.arange(2 ** n)
    failing = np.array([counts["n"][masks >> f & 1 == 1].sum() for f in range(n)])
    alone = np.array([counts["n"][1 << f] for f in range(n)])
    over_orders = np.zeros(n, np.int64)
    np.add.at(over_orders, place.ravel(), removed[:, :n].ravel())
    kept = counts["n"].sum() - removed[:, :n].cumsum(axis=1)
    # What fails a filter has gone at its step or before, since the filter itself would remove it.
    redundant = failing[place] - removed[:, :n]
    return {"part": [part] * (orders * n), "filter_order": [o for o in steps.orders for _ in range(n)],
            "step": list(range(1, n + 1)) * orders, "kept": kept.ravel(), "removed": removed[:, :n].ravel(),
            "redundant": redundant.ravel(), "unique_fails": alone[place].ravel(), "good_lost": good[:, :n].ravel(),
            "toxic_lost": toxic[:, :n].ravel(), "shapley": over_orders[place].ravel()}


AUDIT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
         "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every order of the filters and every step of it, for each part.

    ``counts`` has part, mask, n, good and toxic, each part and mask once; the bit of filter ``names[k]`` is 2^k. The result has
    kept and removed rows, those that the step's filter fails but an earlier one had removed (redundant), those that fail it
    alone (unique_fails), the good and the toxic among the removed, and what the filter removes in all orders together (shapley).
    """
    if len(names) > 6 or len(set(names)) != len(names):
        raise ValueError("up to six filters with different letters, since all their orders are returned")
    steps, size = RemovalSteps.of(names), 2 ** len(names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = {k: np.zeros(size, np.int64) for k in ("n", "good", "toxic")}
                for x in row["cells"]:
                    for k, weights in own.items():
                        weights[x["mask"]] += x[k]
                yield pa.RecordBatch.from_pydict(_audit_of(row["part"], own, steps), schema=_AUDIT_ARROW)

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(rows, AUDIT)


_AUDIT_ARROW = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [
    (k, pa.int64()) for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def audit_filters(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  part_column: str = "source") -> DataFrame:
    """``audit`` of the five filters over documents, by source.

    * A NULL text counts as empty, a NULL source is the part "". Rows repeated in full count each.
    * Filter E: a row goes if a row with a smaller id has its text; rows that share the least id stay, and so does a row
      without id. Rows without an id have no labels.
    * A label that is NULL, or a document without one, is neither good nor toxic.
    * Each part has a row for each order and step, zeros included; an empty table has no part and gives no row.
    * Columns other than id, text, part and the labels' id, quality and toxic are ignored.
    """
    return audit(counted(docs, labels, id_column, text_column, part_column))
