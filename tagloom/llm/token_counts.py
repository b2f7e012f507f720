"""Tokens of fields or sections, counted from one encoding of the whole document.

A text is encoded once, as a whole; each token's span of characters is mapped back, and an interval join
of the spans with the sections' spans finds where it belongs. Tokens that lie in several sections
follow a rule: ``start`` (the section of their first character), ``end`` (that of their last character) or
``majority`` (the one with most of their characters, the earlier one of equals).
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import text_or_empty

RULES = ("start", "end", "majority")


class Tokenizer:
    """A byte-level BPE vocabulary, bounded in size; sent to the tasks and built once in each process."""

    _built: dict = {}

    def __init__(self, vocabulary: bytes, pattern: str):
        self.vocabulary, self.pattern = vocabulary, pattern

    @classmethod
    def load(cls, path: str | None = None, pattern: str | None = None) -> "Tokenizer":
        import public_tokenizers
        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            return cls(file.read(), pattern or public_tokenizers.PATTERN)

    def build(self):
        """The encoding, and the number of bytes of each token id."""
        import tiktoken
        key = hash((self.vocabulary, self.pattern))
        if key not in self._built:
            ranks = {base64.b64decode(token): int(rank)
                     for token, rank in (line.split() for line in self.vocabulary.splitlines() if line)}
            widths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for token, rank in ranks.items():
                widths[rank] = len(token)
            self._built[key] = tiktoken.Encoding(
                "own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}), widths
        return self._built[key]


def token_spans(text: str, tokenizer: Tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token; a token of a part of a character spans that character."""
    encoding, widths = tokenizer.build()
    ids = np.array(encoding.encode_ordinary(text), dtype=np.int64)
    ends = np.cumsum(widths[ids])
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    if not len(ids):
        return ids, ids
    return character[ends - widths[ids]], character[ends - 1] + 1


def attribute(first: np.ndarray, end: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span, and whether the token crosses into another section.

    ``starts`` has the first character of each section, in order; sections leave no gap.
    """
    low = np.searchsorted(starts, first, side="right") - 1
    high = np.searchsorted(starts, end - 1, side="right") - 1
    crossing = low != high
    if rule == "start":
        return low, crossing
    if rule == "end":
        return high, crossing
    section = low.copy()
    for token in np.flatnonzero(crossing):
        borders = np.concatenate(([first[token]], starts[low[token] + 1:high[token] + 1], [end[token]]))
        section[token] += int(np.argmax(np.diff(borders)))
    return section, crossing


def line_starts(text: str) -> np.ndarray:
    """First character of each line; a line ends with its line break."""
    data = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate(([0], np.flatnonzero(data == 10) + 1))
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(data) else starts


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, fields: list[str] | None = None, rule: str = "start",
                 id_column: str = "doc_id", joiner: str = "\n") -> DataFrame:
    """Tokens per section: doc_id, section, field, first_char, end_char, n_tokens, n_crossing.

    With one field (``text`` by default) the sections are its lines; with several, the fields are joined
    by ``joiner``, encoded as one text, and are the sections. A joiner belongs to the field before it.

    * The sections' ``n_tokens`` add up to the tokens of the whole text.
    * Missing and empty texts are one section without tokens; missing fields are empty sections.
    * A section that an earlier token covers altogether has no tokens. Rows repeated in full are
      counted each. An empty table gives an empty result; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    fields = fields or ["text"]
    rows = docs.select(F.col(id_column).alias("doc_id"),
                       *[text_or_empty(name).alias(f"f{k}") for k, name in enumerate(fields)])
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, columns = batch.column("doc_id"), [batch.column(f"f{k}").to_pylist() for k in range(len(fields))]
            at, out = [], []
            for row, parts in enumerate(zip(*columns, strict=True)):
                text = joiner.join(parts)
                if len(parts) == 1:
                    starts = line_starts(text)
                else:
                    sizes = [len(p) + len(joiner) for p in parts[:-1]]
                    starts = np.concatenate(([0], np.cumsum(sizes)))
                first, end = token_spans(text, shared.value)
                section, crossing = attribute(first, end, starts, rule)
                n = len(starts)
                at.append(np.full(n, row))
                out.append(np.stack([
                    np.arange(n), starts, np.concatenate((starts[1:], [len(text)])),
                    np.bincount(section, minlength=n), np.bincount(section[crossing], minlength=n)]))
            if out:
                numbers = np.concatenate(out, axis=1)
                names = pa.array(np.array(fields, dtype=object)[numbers[0] if len(fields) > 1 else numbers[0] * 0])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.concatenate(at))), pa.array(numbers[0], pa.int64()), names.cast(pa.string()),
                     *[pa.array(x, pa.int64()) for x in numbers[1:]]],
                    names=["doc_id", "section", "field", "first_char", "end_char", "n_tokens", "n_crossing"])

    return rows.mapInArrow(count, "doc_id bigint, section bigint, field string, first_char bigint, "
                                  "end_char bigint, n_tokens bigint, n_crossing bigint")
