"""Incremental line deduplication that can be taken back.

A line's key is the line without white space at its ends and with A-Z in lower case. The index
keeps three sharded tables in the shared folder:

* ``refs``: one row per (key, document), the ground truth;
* ``counts``: per key the exact number of documents and the largest document id;
* ``filters``: per shard a cuckoo filter of the keys that at least ``min_docs`` documents hold.

``insert`` and ``delete`` move keys over that limit in both directions, and only the changed keys of
a shard are added to its filter or deleted from it. ``apply`` asks the filter about every line, so
that only lines that may repeat, about one other in 8,000 among them, go on to the exact table, which decides.
Deleting what was inserted leads back to the same results.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.cuckoo import CuckooFilter, CuckooFull
from tagloom.llm.shared import BLANKS, NO_ID, lower_ascii, stored, text_or_empty

SHARDS = 256
SALTS = 8
MIN_DOCS = 3
MIN_CHARS = 20

REFS = "shard int, digest binary, doc bigint"
COUNTS = "shard int, digest binary, n_docs bigint, keeper bigint"
FILTERS = "shard int, buckets int, filter binary"
PROBES = "shard int, salt int, buckets int, filter binary, row_key bigint, doc bigint, line int, digest binary"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


class LineIndex:
    """Keys of the lines of all documents inserted and not deleted since."""

    def __init__(self, spark: SparkSession, shards: int = SHARDS, min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS, salts: int = SALTS):
        self.spark, self.shards, self.salts = spark, shards, salts
        self.min_docs, self.min_chars = min_docs, min_chars
        self.refs = spark.createDataFrame([], REFS)
        self.counts = spark.createDataFrame([], COUNTS)
        self.filters = spark.createDataFrame([], FILTERS)

    # Rows of lines and keys

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int")

    def _line_rows(self, docs: DataFrame) -> DataFrame:
        """One row per line whose key is long enough: row_key, doc, line, digest, shard."""
        rows = docs.select("row_key", "doc", F.posexplode(lines_of(F.col("text"))).alias("line", "raw"))
        key = line_key(F.col("raw"))
        return (rows.where(F.char_length("raw") >= self.min_chars)
                .select("row_key", "doc", "line", key.alias("key"))
                .where(F.char_length("key") >= self.min_chars)
                .withColumn("digest", F.substring(F.unhex(F.sha2("key", 256)), 1, 16))
                .select("row_key", "doc", "line", "digest").withColumn("shard", self._shard()))

    @staticmethod
    def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
        """Documents by internal names; rows are told apart by id and text."""
        return docs.select(F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("doc"),
                           text_or_empty(text_column).alias("text")).withColumn(
            "row_key", F.xxhash64("doc", "text"))

    # Changes

    def insert(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> None:
        """Add documents; a document that is in the index already gets no second reference."""
        new = (self._line_rows(self._named(docs, id_column, text_column))
               .select("shard", "digest", "doc").distinct())
        if self.refs.isEmpty():
            self.refs = stored(new, "line-refs")
            changed = self._counted(self.refs)
            before = changed.limit(0)
        else:
            new = stored(new.join(self.refs, ["shard", "digest", "doc"], "left_anti"), "line-new")
            self.refs = self.refs.unionByName(new)
            touched = self._counted(new)
            before = self.counts.join(touched.select("shard", "digest"), ["shard", "digest"], "left_semi")
            changed = (before.unionByName(touched).groupBy("shard", "digest")
                       .agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper")))
        self._update(before, changed)

    def delete(self, ids: DataFrame, id_column: str = "doc_id") -> None:
        """Take documents out again, as if they had never been inserted."""
        gone = ids.select(F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("doc")).distinct()
        lost = stored(self.refs.join(gone, "doc", "left_semi").select("shard", "digest").distinct(),
                      "line-lost")
        self.refs = stored(self.refs.join(gone, "doc", "left_anti").select("shard", "digest", "doc"),
                           "line-refs")
        before = self.counts.join(lost, ["shard", "digest"], "left_semi")
        left = self._counted(self.refs.join(lost, ["shard", "digest"], "left_semi"))
        none_left = (lost.join(left, ["shard", "digest"], "left_anti")
                     .select("shard", "digest", F.lit(0).cast("bigint").alias("n_docs"),
                             F.lit(None).cast("bigint").alias("keeper")))
        self._update(before, left.unionByName(none_left))

    @staticmethod
    def _counted(refs: DataFrame) -> DataFrame:
        return refs.groupBy("shard", "digest").agg(
            F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))

    def _update(self, before: DataFrame, changed: DataFrame) -> None:
        """Put changed counts in the place of those before, and move keys in and out of the filters."""
        key = ["shard", "digest"]
        changed = stored(changed, "line-changes")
        untouched = self.counts.join(changed.select(*key), key, "left_anti")
        counts = stored(untouched.unionByName(changed.where("n_docs > 0")), "line-counts")

        was = before.where(F.col("n_docs") >= self.min_docs).select(*key)
        now = changed.where(F.col("n_docs") >= self.min_docs).select(*key)
        moves = (now.join(was, key, "left_anti").withColumn("into", F.lit(True))
                 .unionByName(was.join(now, key, "left_anti").withColumn("into", F.lit(False))))
        self.filters = stored(self._moved(moves, counts), "line-filters")
        self.counts = counts

    def _moved(self, moves: DataFrame, counts: DataFrame) -> DataFrame:
        """Filters of all shards after the moves; a full one is built anew from the exact counts."""
        def change(filters: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
            shard = int((filters if len(filters) else moved)["shard"].iloc[0])
            out, into = moved.loc[~moved["into"], "digest"], moved.loc[moved["into"], "digest"]
            if not len(filters):
                made = CuckooFilter.build(list(into))
            else:
                made = CuckooFilter(int(filters["buckets"].iloc[0]), filters["filter"].iloc[0])
                try:
                    made.remove(list(out)).add(list(into))
                except CuckooFull:
                    made = None
            return pd.DataFrame({
                "shard": [shard], "buckets": [made.buckets if made else None],
                "filter": [made.to_bytes() if made else None]}).astype({"buckets": "Int32"})

        moved = stored(self.filters.groupBy("shard").cogroup(moves.groupBy("shard"))
                       .applyInPandas(change, FILTERS), "line-moved")
        full = moved.where("filter IS NULL").select("shard")

        def build(held: pd.DataFrame) -> pd.DataFrame:
            made = CuckooFilter.build(list(held["digest"]))
            return pd.DataFrame({"shard": [held["shard"].iloc[0]], "buckets": [made.buckets],
                                 "filter": [made.to_bytes()]})

        again = (counts.where(F.col("n_docs") >= self.min_docs)
                 .join(full, "shard", "left_semi").select("shard", "digest")
                 .groupBy("shard").applyInPandas(build, FILTERS))
        return moved.where("filter IS NOT NULL").unionByName(again)

    # Use

    def _probe(self, lines: DataFrame) -> DataFrame:
        """Lines whose key their shard's filter may hold.

        Filter and lines of a shard meet in sorted order, the filter first, so a task holds one
        filter and one batch. A shard is spread over ``salts`` tasks by document.
        """
        salts = F.sequence(F.lit(0), F.lit(self.salts - 1))
        # No NULL numbers: pandas would turn the whole column into floats and round the ids.
        filters = (self.filters.withColumn("salt", F.explode(salts))
                   .withColumn("row_key", F.lit(0).cast("bigint"))
                   .withColumn("doc", F.lit(0).cast("bigint")).withColumn("line", F.lit(0)))
        lines = lines.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(self.salts)).cast("int"))
        lines = lines.withColumn("buckets", F.lit(0))
        both = filters.unionByName(lines, allowMissingColumns=True)
        names = [part.strip().split(" ")[0] for part in PROBES.split(",")]
        both = (both.select(*names).repartition("shard", "salt")
                .sortWithinPartitions("shard", "salt", F.col("filter").isNull()))

        def ask(batches):
            at, held = None, None
            for batch in batches:
                rows = batch
                starts = (rows[["shard", "salt"]].diff().ne(0).any(axis=1)
                          | rows["filter"].notna()).cumsum()
                for _, run in rows.groupby(starts, sort=False):
                    place = (run["shard"].iloc[0], run["salt"].iloc[0])
                    if run["filter"].iloc[0] is not None:
                        at = place
                        held = CuckooFilter(int(run["buckets"].iloc[0]), run["filter"].iloc[0])
                        run = run.iloc[1:]
                    if place == at and len(run):
                        yield run[held.may_hold(list(run["digest"]))].drop(columns=["filter", "buckets"])

        kept = "shard int, salt int, row_key bigint, doc bigint, line int, digest binary"
        return both.mapInPandas(ask, kept)

    def dropped_lines(self, docs: DataFrame) -> DataFrame:
        """Line numbers to drop, for documents named by ``_named``: row_key, dropped."""
        exact = (self.counts.where(F.col("n_docs") >= self.min_docs)
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1)))))
        return (self._probe(self._line_rows(docs))
                .join(exact, ["shard", "digest", "salt"])
                .where("doc <> keeper")
                .groupBy("row_key").agg(F.collect_set("line").alias("dropped")))

    def apply(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """``docs`` with the columns ``n_lines``, ``n_dropped`` and ``kept_text`` beside its own.

        * Every repeated line goes, except in the largest document id that holds it, where all
          its lines stay. Lines with short keys always stay.
        * NULL and empty text are one empty line, which stays.
        * Rows with the same id count as one document; a missing id counts as the smallest one.
          Rows repeated in full get the same answer. An empty table gives an empty result.
        * Columns of ``docs`` named like one of the three are replaced.
        """
        names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
        named = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("given"),
            F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("doc"),
            text_or_empty(text_column).alias("text")).withColumn("row_key", F.xxhash64("doc", "text"))
        # The lines are split below the join, so that the lambda above it does not split again.
        split = named.select("given", "row_key", lines_of(F.col("text")).alias("lines"))
        dropped = self.dropped_lines(named.select("row_key", "doc", "text"))
        rows = split.join(dropped, "row_key", "left").select("given", "lines", F.coalesce(
            "dropped", F.array().cast("array<int>")).alias("dropped"))
        n_lines = F.size("lines")
        left = F.array_except(F.sequence(F.lit(0), n_lines - 1), "dropped")
        kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
        return rows.select("given.*", n_lines.cast("bigint").alias("n_lines"),
                           F.size("dropped").cast("bigint").alias("n_dropped"),
                           F.when(F.size("dropped") == 0, F.array_join("lines", "\n"))
                           .otherwise(kept).alias("kept_text"))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                **options) -> DataFrame:
    """Index all documents and apply the index to them."""
    index = LineIndex(docs.sparkSession, **options)
    index.insert(docs, id_column, text_column)
    return index.apply(docs, id_column, text_column)
