"""Large multi-line CSV files, read by many tasks.

Spark reads a file whose fields hold line breaks with one task. Here a large file is read as lines, in
splits. A line begins a record where the quotes before it in the file are even in number, so one
aggregate of quotes per split tells each split in which state it begins. Records that
lie in one split are cut there; the ends of records that cross splits are few and are put together by a group.

That holds for files whose quotes stand where RFC 4180 has them. Each quote is checked while records are cut; a
file with any other quote is read by Spark's own reader, as a whole, so results never depend on the way.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.plans.lookups import fits_broadcast
from tagloom.sources.csv import QUOTE, read_csv
from tagloom.staging import staged

SPLIT_FROM = 128 * 1024 * 1024
"""Bytes from which a file is worth more than one task."""
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
# How a row of cut text relates to its split.
HEADER, WHOLE, HEAD, MIDDLE, TAIL = "header", "whole", "head", "middle", "tail"
# What a row says about its file: it needs Spark's own reader, or its lines end in two characters.
IRREGULAR, TWO_ENDS = "irregular", "two_ends"
_CUT_SCHEMA = "file string, start bigint, kind string, record string"
_QUOTE_BYTE, _BEFORE_OPEN, _AFTER_CLOSE = ord(QUOTE), np.frombuffer(b',\n"', np.uint8), np.frombuffer(b',\n\r"', np.uint8)


class _Split:
    """The records of one split, whose lines come in order and in pieces."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.held: list[bytes] = []  # an open record
        self.from_before = inside    # the open record began in an earlier split
        self.header_due = start == 0
        self.first_line_due = start == 0
        self.irregular = self.two_ends = False

    def rows(self, kinds: list[str], records: pa.Array) -> pa.RecordBatch:
        n = len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file] * n, pa.string()), pa.array([self.start] * n, pa.int64()),
             pa.array(kinds, pa.string()), records.cast(pa.string())], names=["file", "start", "kind", "record"])

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        ended = pc.binary_join_element_wise(lines.cast(pa.binary()), b"", b"\n")
        n = len(ended)
        offsets = np.frombuffer(ended.buffers()[1], np.int32)[ended.offset:ended.offset + n + 1]
        data = np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if self.first_line_due:
            self._see_line_end(data[:offsets[1]].tobytes())
        quotes = np.flatnonzero(data == _QUOTE_BYTE)
        self._check(data, quotes)
        begins = offsets[:-1][(np.searchsorted(quotes, offsets[:-1]) + self.inside) % 2 == 0]
        if self.inside:
            self.held.append(data[:begins[0] if len(begins) else len(data)].tobytes())
        open_at_end = bool((len(quotes) + self.inside) % 2)
        if self.held and (len(begins) or not open_at_end):
            yield self._close(HEAD if self.from_before else WHOLE)
        if len(begins):
            yield from self._cut(data, begins, open_at_end)
        self.inside = open_at_end

    def _cut(self, data: np.ndarray, begins: np.ndarray, open_at_end: bool) -> Iterator[pa.RecordBatch]:
        ends = np.append(begins[1:], len(data))
        if open_at_end:
            self.held, begins, ends = [data[begins[-1]:].tobytes()], begins[:-1], ends[:-1]
        # Blank lines between records are no records.
        filled = (ends - begins > 2) | ((ends - begins == 2) & (data[begins] != 13))
        if not len(begins):
            return
        offsets = pa.py_buffer(np.append(begins, ends[-1]).astype(np.int32).tobytes())
        records = pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(data.tobytes())])
        records = records.filter(pa.array(filled))
        if len(records):
            kinds = [WHOLE] * len(records)
            if self.header_due:
                kinds[0], self.header_due = HEADER, False
            yield self.rows(kinds, records)

    def _close(self, kind: str) -> pa.RecordBatch:
        record, self.held, self.from_before = b"".join(self.held), [], False
        if self.header_due:
            kind, self.header_due = HEADER, False
        return self.rows([kind], pa.array([record], pa.binary()))

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.inside:
            if self.header_due:
                self.irregular = True  # a header that is longer than a split
            yield self._close(MIDDLE if self.from_before else TAIL)
        for kind, holds in ((IRREGULAR, self.irregular), (TWO_ENDS, self.two_ends)):
            if holds:
                yield self.rows([kind], pa.array([b""], pa.binary()))

    def _see_line_end(self, line: bytes) -> None:
        """The first line break of a file tells how its lines end: the parser turns two characters into one."""
        self.first_line_due = False
        self.two_ends = line.endswith(b"\r\n")
        self.irregular = b"\r" in line.removesuffix(b"\r\n")

    def _check(self, data: np.ndarray, quotes: np.ndarray) -> None:
        first = 1 if self.inside else 0
        opening, closing = quotes[first::2], quotes[1 - first::2]
        before = np.where(opening > 0, data[opening - 1], 10)
        if not (np.isin(before, _BEFORE_OPEN).all() and np.isin(data[closing + 1], _AFTER_CLOSE).all()):
            self.irregular = True


def _cut_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = batch.column("start").to_numpy()
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            key = batch.column("file")[low].as_py(), int(starts[low])
            if split is None or key != (split.file, split.start):
                if split is not None:
                    yield from split.finish()
                split = _Split(*key, batch.column("inside")[low].as_py())
            yield from split.add(batch.column("value").slice(low, high - low))
    if split is not None:
        yield from split.finish()


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _split_states(lines: DataFrame) -> DataFrame:
    """file, start, whether the split begins inside quotes, and whether the file ends so."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.lit(1)
    return counted.select("file", "start",
                          (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == odd).alias("inside"),
                          (F.sum("quotes").over(of_file) % 2 == odd).alias("unbalanced"))


def _stitched(fragments: DataFrame) -> DataFrame:
    """file and record of the records that cross splits; a tail begins one, the next head ends it."""
    order = F.when(F.col("kind") == TAIL, 1).otherwise(0)
    ordered = fragments.select("file", "start", order.alias("place"), "record", (F.col("kind") == TAIL).cast("int").alias("opens"))
    chain = F.sum("opens").over(Window.partitionBy("file").orderBy("start", "place"))
    pieces = F.sort_array(F.collect_list(F.struct("start", "place", "record")))
    return (ordered.withColumn("chain", chain).groupBy("file", "chain")
            .agg(F.array_join(F.transform(pieces, lambda p: p["record"]), "").alias("record")).select("file", "record"))


def _files_of(records: DataFrame, kind: str) -> set[str]:
    """Names of files that have such a row: at most the files of the load."""
    return {r.file for r in records.where(F.col("kind") == kind).select("file").distinct().collect()}


def _parsed(records: DataFrame, schema: T.StructType, corrupt_column: str) -> DataFrame:
    unended = F.when(F.endswith("record", F.lit("\r\n")), F.expr("left(record, length(record) - 2)")).when(
        F.endswith("record", F.lit("\n")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "multiLine": "true",
               "columnNameOfCorruptRecord": corrupt_column}
    return records.select(F.from_csv(unended, schema.simpleString(), options).alias("row")).select("row.*")


def _large_files(spark: SparkSession, paths: list[str], split_from: int) -> tuple[list[str], list[str]]:
    """The files below the paths that are smaller, or compressed, and those worth splitting; sizes come from a listing."""
    listed = spark.read.format("binaryFile").load(paths).select("path", "length").collect()
    large = [f.path for f in listed if f.length >= split_from and not f.path.endswith(COMPRESSED)]
    return sorted({f.path for f in listed} - set(large)), sorted(large)


@contextmanager
def parsed_csv(spark: SparkSession, paths: list[str], schema: str, corrupt_column: str, split_from: int = SPLIT_FROM):
    """Rows of multi-line CSV files with a header line, as ``read_csv`` gives them, large files in many tasks.

    ``corrupt_column`` receives the text of a record that does not fit. The rows are to be used within the
    block, as the cut records lie in the shared folder until it ends.
    """
    wanted = T.StructType.fromDDL(schema)
    small, large = _large_files(spark, paths, split_from)
    if not large:
        yield read_csv(spark, paths, schema, corrupt_column=corrupt_column)
        return
    lines = _lines(spark, large)
    with staged(_split_states(lines), "csv-splits") as states:
        if not fits_broadcast(states):
            raise ValueError("too many splits for one load; hand in the files in several loads")
        unbalanced = [r.file for r in states.where("unbalanced").select("file").distinct().collect()]
        with_state = lines.join(F.broadcast(states.select("file", "start", "inside")), ["file", "start"])
        cut = with_state.select("file", "start", "inside", "value").mapInArrow(_cut_splits, _CUT_SCHEMA)
        with staged(cut, "csv-records", partition_by="kind") as records:
            whole_files = sorted(_files_of(records, IRREGULAR) | set(unbalanced))
            two_ends = sorted(_files_of(records, TWO_ENDS))
            regular = records.where(~F.col("file").isin(whole_files)) if whole_files else records
            full = T.StructType([*wanted.fields, T.StructField(corrupt_column, T.StringType())])
            texts = (regular.where(F.col("kind") == WHOLE).select("file", "record")
                     .unionByName(_stitched(regular.where(F.col("kind").isin(HEAD, MIDDLE, TAIL)))))
            if two_ends:
                one_end = F.replace("record", F.lit("\r\n"), F.lit("\n"))
                texts = texts.withColumn("record", F.when(F.col("file").isin(two_ends), one_end).otherwise(F.col("record")))
            rows = _parsed(texts, full, corrupt_column)
            others = small + whole_files
            if others:
                rows = rows.unionByName(read_csv(spark, others, schema, corrupt_column=corrupt_column))
            yield rows
