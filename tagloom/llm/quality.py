"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn over the features, each tree on one feature's bins, and summed into
one lookup table per feature; then the pairs of features that explain most of what is left get tables
of two dimensions in the same way. A score is the sum of the tables' entries at a document's bins.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import text_or_empty

MAX_TRAINING_ROWS = 20_000
"""Bound of the labelled sample that the model is fitted on, taken in the order of a hash of the id."""
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 6
RATE = 0.2
LEAF_WEIGHT = 5.0

FEATURES = ("log_words", "word_length", "distinct_words", "distinct_pairs", "top_word", "upper", "digits",
            "exclaims", "symbols", "pipes", "stops", "line_words", "distinct_lines", "blanks")

_SYMBOLS = np.frombuffer(b"#$%&*@~^<>\\{}=+_[]/", np.uint8)
_STOPS = np.frombuffer(b".,;:?", np.uint8)


def features_of(text: bytes) -> list[float]:
    """Lexical shape of a text. An empty one has zeros, except for shares, which are 1 where that is normal."""
    words = text.split()
    if not words:
        return [0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, size = len(words), len(text)
    visible = max(1, size - int(counts[32]) - int(counts[9:14].sum()))
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    lines = text.split(b"\n")
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    return [float(np.log1p(n)), visible / n, len(seen) / n, len(set(zip(words, words[1:]))) / max(1, n - 1),
            max(seen.values()) / n, upper / max(1, upper + lower), counts[48:58].sum() / visible,
            counts[33] / visible, counts[_SYMBOLS].sum() / visible, counts[124] / visible,
            counts[_STOPS].sum() / n, n / len(lines), len(set(lines)) / len(lines), 1 - visible / size]


def with_features(rows: DataFrame, keep: str) -> DataFrame:
    """``keep`` columns of rows with a ``text``, and the array ``features``."""
    names = [part.strip().split(" ")[0] for part in keep.split(",")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            made = pa.array([features_of(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [made],
                                             names=[*names, "features"])
    return rows.mapInArrow(make, keep + ", features array<double>")


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; a few kilobytes, whatever the training data."""

    base: float
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_edges: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (i, j, table)

    def scores(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.base)
        for k, (edges, own) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += own[np.searchsorted(edges, values[:, k], side="right")]
        for i, j, own in self.pairs:
            total += own[np.searchsorted(self.pair_edges[i], values[:, i], side="right"),
                         np.searchsorted(self.pair_edges[j], values[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g, h):
    return g * g / (h + LEAF_WEIGHT)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of ``depth`` on ordered bins with gradients g and weights h."""
    value = np.full(len(g), g.sum() / (h.sum() + LEAF_WEIGHT))
    if depth == 0 or len(g) < 2:
        return value
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains)) + 1
    if gains[at - 1] <= 1e-9:
        return value
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Best cut of a grid into quadrants: values per cell, and the gain over one value for all."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    rows, columns = np.meshgrid(np.arange(g.shape[0] - 1), np.arange(g.shape[1] - 1), indexing="ij")
    best, place, whole = 0.0, None, _gain(g.sum(), h.sum())
    if rows.size:
        def parts(c):
            a, top, left = c[rows, columns], c[rows, -1], c[-1, columns]
            return a, top - a, left - a, c[-1, -1] - top - left + a
        gains = sum(_gain(x, y) for x, y in zip(parts(cg), parts(ch), strict=True)) - whole
        at = int(np.argmax(gains))
        best, place = float(gains.flat[at]), (rows.flat[at] + 1, columns.flat[at] + 1)
    values = np.full(g.shape, g.sum() / (h.sum() + LEAF_WEIGHT))
    if place and best > 1e-9:
        for r in (slice(None, place[0]), slice(place[0], None)):
            for c in (slice(None, place[1]), slice(place[1], None)):
                values[r, c] = g[r, c].sum() / (h[r, c].sum() + LEAF_WEIGHT)
    return values, best


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(values: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Boost the tables; without both labels in the data the model is their smoothed share."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    width = values.shape[1]
    model.edges = [_edges(values[:, k], BINS) for k in range(width)]
    bins = [np.searchsorted(model.edges[k], values[:, k], side="right") for k in range(width)]
    model.tables = [np.zeros(len(model.edges[k]) + 1) for k in range(width)]
    total = np.full(len(labels), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            g, h = slopes()
            own = RATE * _tree(*(np.bincount(bins[k], x, len(model.tables[k])) for x in (g, h)))
            model.tables[k] += own
            total += own[bins[k]]

    model.pair_edges = [_edges(values[:, k], PAIR_BINS) for k in range(width)]
    coarse = [np.searchsorted(model.pair_edges[k], values[:, k], side="right") for k in range(width)]
    shape = [len(model.pair_edges[k]) + 1 for k in range(width)]

    def grid(i, j):
        cell = coarse[i] * shape[j] + coarse[j]
        return tuple(np.bincount(cell, x, shape[i] * shape[j]).reshape(shape[i], shape[j]) for x in slopes())

    gains = {(i, j): _pair_tree(*grid(i, j))[1] for i in range(width) for j in range(i)}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    own = {pair: np.zeros((shape[pair[0]], shape[pair[1]])) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            step = RATE * _pair_tree(*grid(i, j))[0]
            own[i, j] += step
            total += step[coarse[i], coarse[j]]
    model.pairs = [(i, j, own[i, j]) for i, j in chosen]
    return model


def held_out(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, id_column: str = "doc_id",
          text_column: str = "text", label_column: str = "quality") -> AdditiveModel:
    """Fit on labelled documents that are not held out; of an id labelled twice the mean counts.

    Only texts and labels are used. Rows without id or label are left out.
    """
    known = (labels.select(F.col(id_column).alias("doc"), F.col(label_column).alias("label"))
             .where("doc IS NOT NULL AND label IS NOT NULL").where(~held_out("doc"))
             .groupBy("doc").agg(F.round(F.avg("label")).cast("double").alias("label")))
    texts = docs.select(F.col(id_column).alias("doc"), text_or_empty(text_column).alias("text"))
    # The sample is bounded by ``max_rows``, so it may be broadcast.
    sample = known.orderBy(F.xxhash64("doc"), "doc").limit(max_rows)
    rows = with_features(texts.join(F.broadcast(sample), "doc").dropDuplicates(["doc"]),
                         "doc bigint, label double").toPandas().sort_values("doc")
    values = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return fit(values, rows["label"].to_numpy(dtype=float))


def score(docs: DataFrame, model: AdditiveModel, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of each row.

    Missing and empty texts are scored as text without words. Each row is judged by its text
    alone, so rows repeated in full get the same score. A missing id is not held out.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))

    @F.pandas_udf("double")
    def scored(column):
        import pandas as pd
        if not len(column):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.array(column.tolist(), dtype=float)))

    return (with_features(texts, "doc_id bigint").withColumn("score", scored("features"))
            .select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: AdditiveModel, text_column: str = "text") -> DataFrame:
    """The rows whose text is predicted to be good, with all their columns."""
    @F.pandas_udf("double")
    def scored(column):
        import pandas as pd
        values = [features_of((t or "").encode()) for t in column]
        return pd.Series(model.scores(np.array(values, dtype=float).reshape(len(values), len(FEATURES))))

    return docs.where(scored(text_or_empty(text_column)) >= 0.5)
