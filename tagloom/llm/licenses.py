"""License scan: winnowed fingerprints find candidates, a banded alignment measures them.

Word pairs of the license templates are hashed and winnowed into an inverted index, which is bounded by the
list of templates. Each document is fingerprinted in the same way; where it meets the index, the
template is aligned with the words around that place, within a band of a few words.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.near_dedup import _WordHashes
from tagloom.llm.shared import text_or_empty

# The short notices by which documents state their license.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "reserved": "All rights reserved.",
}
GRAM, SPAN = 2, 2
"""Every match of at least ``GRAM + SPAN - 1`` words shares a fingerprint with its template."""
BAND = 3
LEAST_COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def winnowed(words: list[str], known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and their places: of each ``SPAN`` neighbours the least, the last of equals."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.fromiter((known[w.encode()] for w in words), np.uint64, len(words))
    width = min(GRAM, len(hashes))
    grams = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(grams) + k]
    span = min(SPAN, len(grams))
    around = np.lib.stride_tricks.sliding_window_view(grams, span)
    places = np.unique(np.arange(len(around)) + span - 1 - np.argmin(around[:, ::-1], axis=1))
    return grams[places], places


def aligned(template: list[str], words: list[str], start: int, band: int = BAND) -> tuple[int, int, int]:
    """Best alignment near a diagonal: matched words, and the first and end word in the document.

    Word ``t`` of the template may meet words ``start + t - band`` to ``start + t + band``.
    """
    least = (0, 0, 0)
    before = [least] * (2 * band + 1)  # best with the template so far, by offset from the diagonal
    for t, word in enumerate(template):
        now = []
        for offset in range(2 * band + 1):
            at = start + t + offset - band
            skip_template = before[offset + 1] if offset < 2 * band else least
            skip_word = now[-1] if now else least
            best = max(skip_template, skip_word, key=lambda x: x[0])
            if 0 <= at < len(words) and words[at] == word:
                matched, first, _ = before[offset]
                met = (matched + 1, first if matched else at, at + 1)
                best = max(met, best, key=lambda x: (x[0], x[1] - x[2]))
            now.append(best)
        before = now
    return max(before, key=lambda x: (x[0], x[1] - x[2]))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least_coverage: float = LEAST_COVERAGE,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """License statements: doc_id, license, first_char, end_char, coverage, matched_words.

    Of statements that overlap, the one with most matched words is reported, then the one with the
    higher coverage, then the first by place and name.

    * Missing and empty texts have no statement. Rows repeated in full are reported each.
    * A missing id stays NULL; an empty table gives an empty result; other columns are ignored.
    """
    words_of = {name: _words(text) for name, text in (templates or TEMPLATES).items()}
    index: dict[int, list] = {}
    for name, words in words_of.items():
        for mark, place in zip(*winnowed(words, _WordHashes()), strict=True):
            index.setdefault(int(mark), []).append((name, int(place)))
    marks = np.array(sorted(index), dtype=np.uint64)

    def statements(text: str, known: dict) -> list[tuple]:
        words = _words(text)
        found, places = winnowed(words, known)
        hits = np.flatnonzero(np.isin(found, marks))
        if not len(hits):
            return []
        starts = {(name, int(places[h]) - at) for h in hits for name, at in index[int(found[h])]}
        made = []
        for name, start in sorted(starts):
            matched, first, end = aligned(words_of[name], words, start)
            if matched >= least_coverage * len(words_of[name]):
                made.append((-matched, -matched / len(words_of[name]), first, name, end))
        spans = [m.span() for m in WORD.finditer(text)] if made else []
        taken, out = [], []
        for matched, coverage, first, name, end in sorted(set(made)):
            if all(end <= a or first >= b for a, b in taken):
                taken.append((first, end))
                out.append((name, spans[first][0], spans[end - 1][1], -coverage, -matched))
        return sorted(out, key=lambda x: x[1])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, rows = _WordHashes(), []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows.extend((doc, *found) for found in statements(text, known))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "license", "first_char", "end_char", "coverage", "matched_words"])

    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, license string, first_char bigint, end_char bigint, "
                                 "coverage double, matched_words bigint")
