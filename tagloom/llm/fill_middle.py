"""Fill-in-the-middle transformation: documents cut at two unit borders and put in another order.

A unit is a run of blanks with the run of other characters after it; blanks that end a text are a unit of their
own. Borders are found in bulk: many texts lie padded in one buffer that is read as 64-bit words of
eight bytes. Arithmetic on whole words marks the last byte of each unit, population counts are added up along the buffer, and the
k-th border of a text is found by a search in these sums and a selection among the marks of one word.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import text_or_empty

# The markers of prefix, suffix and middle, and the names of the three forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
CHUNK_BYTES = 4 * 1024 * 1024
"""Texts are cut in chunks of this size, or alone if longer, which bounds the arrays held at once."""


@dataclass(frozen=True)
class Rates:
    """How often a document is transformed, how often suffix first, and the seed of the draws."""

    seed: int = 42
    transformed: int = 50  # percent of all documents
    suffix_first: int = 80  # percent of the transformed


def _every_byte(value: int) -> np.uint64:
    return np.uint64(value * 0x0101010101010101)


_HIGH, _LOW = _every_byte(0x80), _every_byte(0x7F)


def _blank_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is U+0020 or U+0009 to U+000D; no sum carries over to the next byte."""
    low = words & _LOW
    other_than_space = ((low ^ _every_byte(0x20)) + _LOW) | words
    from_tab = low + _every_byte(0x80 - 0x09)
    beyond_return = low + _every_byte(0x80 - 0x0E)
    return (~other_than_space | (from_tab & ~beyond_return & ~words)) & _HIGH


class UnitBorders:
    """The ends of the units of several texts, for counting and selecting."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        spans = sizes // 8 + 1  # words of a text; at least one byte of padding, which is blank
        self.first = np.concatenate([[0], np.cumsum(spans)]).astype(np.int64)
        buffer = b"".join(t.ljust(8 * int(n), b" ") for t, n in zip(texts, spans, strict=True))
        words = np.frombuffer(buffer, "<u8")
        blank = _blank_bytes(words)
        following = np.empty_like(blank)
        following[:-1], following[-1:] = blank[1:], _HIGH
        next_blank = (blank >> np.uint64(8)) | (following << np.uint64(56))
        self.marks = ~blank & next_blank & _HIGH
        # Blanks at the end of a text are a unit whose last byte has no mark yet.
        closing = np.array([len(t) > 0 and t[-1] in b" \t\n\x0b\x0c\r" for t in texts], bool)
        place = (sizes - 1)[closing]
        self.marks[self.first[:-1][closing] + place // 8] |= (
            np.uint64(0x80) << (8 * (place % 8)).astype(np.uint64))
        self.until = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.counts = self.until[self.first[1:]] - self.until[self.first[:-1]]

    def offsets(self, units: np.ndarray) -> np.ndarray:
        """Byte offset after so many units of each text."""
        wanted = self.until[self.first[:-1]] + units
        # The word that holds the wanted mark is the last one with fewer marks before it.
        at = np.searchsorted(self.until, wanted, side="left") - 1
        at = np.maximum(at, self.first[:-1])
        before = wanted - self.until[at]
        left = self.marks[at] if len(self.marks) else np.zeros(len(units), np.uint64)
        for n in range(1, 8):
            left = np.where(before > n, left & (left - np.uint64(1)), left)
        lowest = left & (~left + np.uint64(1))
        byte = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 8
        return np.where(units > 0, 8 * (at - self.first[:-1]) + byte + 1, 0)


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def _chunks(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[list, list[bytes]]]:
    held_ids, held, size = [], [], 0
    for doc, text in zip(ids, texts, strict=True):
        value = text.as_py()
        if held and size + len(value) > CHUNK_BYTES:
            yield held_ids, held
            held_ids, held, size = [], [], 0
        held_ids.append(doc.as_py())
        held.append(value)
        size += len(value)
    if held:
        yield held_ids, held


def _characters(part: bytes) -> int:
    return len(part) if part.isascii() else len(part.decode("utf-8", "replace"))


def _transformed(ids: list, texts: list[bytes], rates: Rates) -> pa.RecordBatch:
    borders = UnitBorders(texts)
    drawn = np.array([draws(doc, rates.seed) for doc in ids], np.int64)
    cuts = drawn[:, :2] % (borders.counts + 1)[:, None]
    starts, ends = borders.offsets(cuts.min(axis=1)), borders.offsets(cuts.max(axis=1))
    forms, outputs, sizes = [], [], []
    for text, (_, _, h3, h4), start, end in zip(texts, drawn.tolist(), starts.tolist(), ends.tolist(), strict=True):
        if not text or h3 % 100 >= rates.transformed or any(m in text for m in MARKERS):
            forms.append(PLAIN)
            outputs.append(text)
            sizes.append((None, None))
            continue
        prefix, middle, suffix = text[:start], text[start:end], text[end:]
        sizes.append((_characters(prefix), _characters(middle)))
        p, s, m = MARKERS
        if h4 % 100 < rates.suffix_first:
            forms.append(SPM)
            outputs.append(b"".join((s, suffix, p, prefix, m, middle)))
        else:
            forms.append(PSM)
            outputs.append(b"".join((p, prefix, s, suffix, m, middle)))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(borders.counts, pa.int64()), pa.array(forms, pa.string()),
         pa.array([a for a, _ in sizes], pa.int64()), pa.array([b for _, b in sizes], pa.int64()),
         pa.array(outputs, pa.binary()).cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, rates: Rates = Rates(), id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of each row.

    The draws depend on seed and id only, so a task that runs again gives the same rows, and rows repeated
    in full get equal outputs.

    * NULL and empty texts have no unit, stay plain and give an empty output.
    * A text that holds a marker stays plain, so that every output can be turned back.
    * A missing id is drawn for as the empty string and stays NULL; two texts of one id are cut by the same draws.
    * A text of any length is cut as a whole; other columns are ignored; an empty table gives an empty result.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _chunks(batch.column("doc_id"), batch.column("text").cast(pa.binary())):
                yield _transformed(ids, texts, rates)

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(cut, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                "output string")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def after(mark: str) -> Column:
        """What follows the only such marker, up to the next one or the end."""
        return F.substring_index(output, mark, -1)

    def until(part: Column, mark: str) -> Column:
        return F.substring_index(part, mark, 1)

    psm = F.concat(until(after(PREFIX), SUFFIX), after(MIDDLE), until(after(SUFFIX), MIDDLE))
    spm = F.concat(until(after(PREFIX), MIDDLE), after(MIDDLE), until(after(SUFFIX), PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
