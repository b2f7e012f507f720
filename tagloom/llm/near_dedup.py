"""Near-duplicate documents by bands of minwise tokens, with exhaustive comparison inside the nodes that stay open.

Each document is a set of word shingles, sketched by ``TOKENS`` minwise tokens. Documents with equal
sets are first reduced to one. The tokens are cut into bands, and documents that agree in a whole band meet in a node.
Each document is compared with the pivots of its nodes, the least of their documents, as long as it shares enough nodes with them.
Every candidate that the sketches cannot rule out is confirmed on full sets.

The links found are turned into components, and a node of one component has nothing left to find and ends. So a group of
thousands of near copies is found once, around few pivots. The documents of an open node of at most ``NODE_LIMIT`` are all compared
across components; a larger one branches by further marks of the sketch, several times, and its children are nodes again.
Nodes that are still large and of several components at the last level are compared block by block, each minor component with
all others.

Bands are as wide as lets a pair at the threshold meet in one of them but once in 10 million times: two documents of
similarity 0.8 agree in a band of 4 tokens with probability 0.41, and there are 32 bands.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.shared import NO_ID, release, stored, stored_in_few, text_or_empty
from tagloom.plans.lookups import hot_key_join

SHINGLE = 5
PERCENT = 80
TOKENS = 128
MISSED = 1e-7
"""How often a pair at the threshold may share no band."""
LEVELS = 3
BRANCHES, BRANCH_MARKS = 3, 2
"""A large node branches so many times, each time by so many marks; a pair has its chance in each band that it shares."""
NODE_LIMIT = 1024
MAX_WANTED = 2_500_000
"""Ids of documents whose full sets are wanted are sent to all tasks, up to so many; beyond, texts move to them."""
SLACK = 4.0
"""Candidates may lie this many standard deviations of the sketch below the threshold."""
SURE = 0.92
"""Sketches this alike are taken as linked when a node's candidates are thinned to a forest."""

_RANDOM = np.random.default_rng(20240817)
_FACTORS = _RANDOM.integers(1, 2 ** 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2 ** 63, TOKENS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


KNOWN_WORDS = 100_000
"""Word hashes that a task keeps, at most about."""


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made


def shingle_hashes(text: bytes, width: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text; shorter texts are one shingle.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is what the contract asks for.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))
    width = min(width, len(hashes))
    rolled = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k in range(width):
        rolled = (rolled ^ (rolled >> np.uint64(31))) * _STEP + hashes[k:len(hashes) - width + 1 + k]
    rolled ^= rolled >> np.uint64(32)
    return np.unique(rolled * _STEP)


def minwise_tokens(hashes: np.ndarray) -> np.ndarray:
    tokens = np.full(TOKENS, 2 ** 32 - 1, dtype=np.uint32)
    for start in range(0, len(hashes), 4096):
        part = hashes[start:start + 4096, None] * _FACTORS + _SHIFTS
        tokens = np.minimum(tokens, (part.min(axis=0) >> np.uint64(32)).astype(np.uint32))
    return tokens


def band_width(percent: int) -> int:
    """The widest bands in which a pair at the threshold meets but for a share of ``MISSED``."""
    share = percent / 100
    return next((width for width in range(8, 1, -1) if (1 - share ** width) ** (TOKENS // width) <= MISSED), 1)


def band_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """A number for each band and its tokens."""
    bands = TOKENS // width
    rows = tokens[:bands * width].reshape(bands, width).astype(np.uint64)
    mixed = np.arange(bands, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _STEP + rows[:, k]
    mixed ^= mixed >> np.uint64(32)
    return (mixed * _STEP).view(np.int64)


def _few_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts, few at a time, since a batch of long texts is held twice while it is read."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield part.column("doc"), part.column("text").cast(pa.binary()).to_pylist()


def _sketches(width: int, band: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for docs, texts in _few_texts(batches):
            known = known if len(known) < KNOWN_WORDS else _WordHashes()
            sizes, digests, bands, marks = [], [], [], []
            for text in texts:
                hashes = shingle_hashes(text, width, known)
                sizes.append(len(hashes))
                made = minwise_tokens(hashes) if len(hashes) else None
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(band_hashes(made, band) if len(hashes) else None)
                marks.append(made.astype(np.uint8).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["doc", "n_shingles", "digest", "bands", "marks"])
    return make


def _shingle_sets(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for docs, texts in _few_texts(batches):
            known = known if len(known) < KNOWN_WORDS else _WordHashes()
            sets = [shingle_hashes(text, width, known).view(np.int64) for text in texts]
            yield pa.RecordBatch.from_arrays([docs, pa.array(sets, pa.list_(pa.int64()))], names=["doc", "shingles"])
    return make


def _least_alike(percent: int) -> float:
    """Share of equal marks below which a pair is not a candidate; marks agree by chance once in 256."""
    share = percent / 100
    return share - SLACK * (share * (1 - share) / TOKENS) ** 0.5


def _candidates(docs: np.ndarray, labels: np.ndarray, sizes: np.ndarray, marks: np.ndarray,
                percent: int, thin: bool) -> list[tuple[int, int, bool]]:
    """Index pairs of a node that may be linked, and whether they surely are.

    With ``thin``, pairs that surer ones make needless are left out; should one of the sure pairs turn out not to be linked, the
    node is to be compared again without.
    """
    alike = (marks[:, None, :] == marks[None, :, :]).mean(axis=2) if len(docs) < 33 else np.stack(
        [(marks == row).mean(axis=1) for row in marks])
    fits = 100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes)
    wanted = np.triu((alike >= _least_alike(percent)) & fits, 1) & (labels[:, None] != labels[None, :])
    left, right = np.nonzero(wanted)
    if len(left) < 2 or not thin:
        return [(i, j, False) for i, j in zip(left.tolist(), right.tolist(), strict=True)]
    order = np.argsort(-alike[left, right], kind="stable")
    root = list(range(len(docs)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for i, j in zip(left[order].tolist(), right[order].tolist(), strict=True):
        a, b = find(i), find(j)
        if a != b:
            sure = bool(alike[i, j] >= SURE)
            kept.append((i, j, sure))
            if sure:
                root[a] = b
    return kept


def _compare_nodes(percent: int, thin: bool):
    """Candidates of each node; rows come sorted by node, and a node fits into memory."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            nodes = held.column("node").to_numpy()
            done = int(np.searchsorted(nodes, nodes[-1])) if len(nodes) else 0
            if done:
                yield from pairs(held.slice(0, done))
                held = held.slice(done).combine_chunks()
        if held is not None and held.num_rows:
            yield from pairs(held)

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes, docs, labels, sizes = (rows.column(c).to_numpy() for c in ("node", "rep", "label", "n_shingles"))
        marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint8).reshape(-1, TOKENS)
        edges = [0, *(np.flatnonzero(np.diff(nodes)) + 1).tolist(), len(nodes)]
        found = []
        for start, end in zip(edges, edges[1:]):
            if end - start > 1:
                found += [(docs[start + i], docs[start + j], nodes[start], sure) for i, j, sure in _candidates(
                    docs[start:end], labels[start:end], sizes[start:end], marks[start:end], percent, thin)]
        if found:
            left, right, at, sure = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.array(at, pa.int64()), pa.array(sure, pa.bool_())],
                names=["u", "v", "node", "sure"])
    return compare


def _branch(large: DataFrame, marks: DataFrame) -> DataFrame:
    """Children (node, rep) of large nodes, each of documents that share the marks at positions chosen by the node."""
    def mark(branch: Column, k: int) -> Column:
        return F.substring("marks", F.pmod(F.xxhash64("node", branch, F.lit(k)), F.lit(TOKENS)).cast("int") + 1, F.lit(1))

    children = F.transform(F.sequence(F.lit(0), F.lit(BRANCHES - 1)),
                           lambda branch: F.xxhash64("node", branch, *[mark(branch, k) for k in range(BRANCH_MARKS)]))
    return large.select("node", "rep").join(marks, "rep").select(F.explode(children).alias("node"), "rep")


def _compare(nodes: DataFrame, percent: int, thin: bool = True) -> DataFrame:
    """Candidates (u, v, node, sure) of nodes that fit into memory: rows of node, rep, label, n_shingles and marks."""
    rows = (nodes.select("node", "rep", "label", "n_shingles", "marks").repartition("node")
            .sortWithinPartitions("node", "rep"))
    return rows.mapInArrow(_compare_nodes(percent, thin), "u bigint, v bigint, node bigint, sure boolean")


def _with_labels(rows: DataFrame, stars: DataFrame | None) -> DataFrame:
    """Adds the component of each ``rep``; one without links is its own."""
    if stars is None:
        return rows.withColumn("label", F.col("rep"))
    known = stars.select(F.col("u").alias("__rep"), F.col("v").alias("__label"))
    return (rows.join(known, F.col("rep") == F.col("__rep"), "left")
            .withColumn("label", F.coalesce("__label", "rep")).drop("__rep", "__label"))


class _Links:
    """Confirmed links so far, and the components that they make."""

    def __init__(self, texts: DataFrame, percent: int, width: int):
        self.texts, self.percent, self.width = texts, percent, width
        self.edges: DataFrame | None = None  # stars: one edge per document that is not the least of its component
        self.tried: DataFrame | None = None  # pairs that were tried on full sets
        self.kept: list[DataFrame] = []

    def add(self, candidates: DataFrame) -> DataFrame:
        """Confirm candidates on full sets and join the components they link; returns the pairs that were confirmed."""
        new = (candidates.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
               .where("u <> v").distinct())
        pairs = stored_in_few(new if self.tried is None else new.join(self.tried, ["u", "v"], "left_anti"), "near-candidates")
        if pairs.isEmpty():
            return pairs
        self.kept.append(pairs)
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        wanted = pairs.select(F.explode(F.array("u", "v")).alias("doc"))
        wanted = F.broadcast(wanted) if 2 * pairs.count() <= MAX_WANTED else wanted
        sets = stored(self.texts.join(wanted, "doc", "left_semi").select("doc", "text")
                      .mapInArrow(_shingle_sets(self.width), "doc bigint, shingles array<bigint>"), "near-sets")
        confirmed = stored_in_few(self._similar(pairs, sets), "near-links")
        release(sets)
        before = self.edges
        if not confirmed.isEmpty():
            self.edges = components(confirmed if before is None else confirmed.unionByName(before))
            release(before)
        return confirmed

    def _similar(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """A pivot, which is the lesser of its pairs, is in very many of them, so these are dealt over several tasks."""
        one = sets.select(F.col("doc").alias("du"), F.col("shingles").alias("set_u"))
        two = sets.select(F.col("doc").alias("v"), F.col("shingles").alias("set_v"))
        shared = F.size(F.array_intersect("set_u", "set_v"))
        return (hot_key_join(pairs, one, "u", "du").select("u", "v", "set_u").join(two, "v")
                .select("u", "v", shared.alias("shared"), (F.size("set_u") + F.size("set_v")).alias("both"))
                .where(100 * F.col("shared") >= self.percent * (F.col("both") - F.col("shared")))
                .select("u", "v"))

    def close(self) -> None:
        release(*self.kept)


def _open(rows: DataFrame, links: _Links) -> DataFrame:
    """Of rows (node, rep), those of nodes of several components: node, rep, label, n and the node's least document.

    A document has a row in each band, so no node has more than one in as many rows as there are bands.
    """
    node = Window.partitionBy("node")
    if links.edges is None:  # each document is a component of its own, and has one row in a node
        labelled = rows.select("*", F.count("*").over(node).alias("n"), F.min("rep").over(node).alias("pivot"))
        return stored_in_few(labelled.where("n > 1").withColumn("label", F.col("rep")), "near-open")
    labelled = _with_labels(rows, links.edges).select(
        "*", F.count("*").over(node).alias("n"), F.min("rep").over(node).alias("pivot"),
        F.min("label").over(node).alias("a"), F.max("label").over(node).alias("b"))
    return stored_in_few(labelled.where("a <> b").drop("a", "b"), "near-open")


def _compare_with_pivots(rows: DataFrame, links: _Links, band: int) -> None:
    """Link documents with the pivots of their nodes, where they share so many bands that the sketches do not rule it out."""
    bands = TOKENS // band
    share = (links.percent / 100) ** band
    least = max(1, math.ceil(bands * share - SLACK * (bands * share * (1 - share)) ** 0.5))
    likely = (rows.where("rep <> pivot").groupBy(F.col("pivot").alias("u"), F.col("rep").alias("v"))
              .agg(F.count("*").alias("shared")).where(F.col("shared") >= least))
    release(links.add(likely))


def _compare_all(rows: DataFrame, marks: DataFrame, links: _Links) -> None:
    """Link the documents of small nodes across components."""
    found = stored_in_few(_compare(rows.join(marks, "rep"), links.percent), "near-found")
    confirmed = links.add(found)
    sure = found.where("sure").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "node")
    again = stored_in_few(sure.join(confirmed, ["u", "v"], "left_anti").select("node").distinct(), "near-again")
    if not again.isEmpty():
        # A sure pair was not linked after all, so pairs left out for its sake have to be tried.
        nodes = _with_labels(rows.select("node", "rep").join(again, "node", "left_semi"), links.edges)
        retried = stored_in_few(_compare(nodes.join(marks, "rep"), links.percent, thin=False), "near-found")
        release(links.add(retried), retried)
    release(found, confirmed, again)


def _remaining(large: DataFrame, links: _Links, marks: DataFrame, limit: int) -> DataFrame:
    """Open large nodes in cells of two blocks, so that documents outside the main component of a node meet all others."""
    labelled = stored_in_few(_with_labels(large, links.edges), "tree-labelled")
    counts = labelled.groupBy("node", "label").agg(F.count("*").alias("n"))
    mains = (counts.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main"))
             .where("main.n < n").select(F.col("node").alias("of_node"), F.col("main.label").alias("main"),
                                         F.col("main.n").alias("in_main"), (F.col("n") - F.col("main.n")).alias("in_rest")))
    half = F.lit(max(1, limit // 2))
    main_blocks, rest_blocks = (F.ceil(F.col(c) / half).cast("int") for c in ("in_main", "in_rest"))
    is_main = F.col("label") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(is_main, main_blocks).otherwise(rest_blocks)).cast("int")

    def cells(blocks: Column, key) -> Column:
        return F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.xxhash64("node", *key(other)))

    with_rest = cells(rest_blocks, lambda other: (F.lit("rest"), F.least(other, own), F.greatest(other, own)))
    with_main = cells(main_blocks, lambda other: (F.lit("main"), own, other))
    to_rest = cells(rest_blocks, lambda other: (F.lit("main"), other, own))
    met = F.when(is_main, to_rest).otherwise(F.concat(with_rest, with_main))
    return (hot_key_join(labelled, mains, "node", "of_node").select(F.explode(met).alias("node"), "rep", "label")
            .join(marks, "rep"))


def _linked(reps: DataFrame, links: _Links, levels: int, limit: int) -> None:
    """Search the nodes level by level; the links found are in ``links``."""
    marks = reps.select("rep", "n_shingles", "marks")
    met = _open(reps.select("rep", F.explode("bands").alias("node")), links)
    _compare_with_pivots(met, links, band_width(links.percent))
    left = _open(met.select("node", "rep"), links)
    release(met)
    for level in range(1, levels + 1):
        _compare_all(left.where(F.col("n") <= limit), marks, links)
        large = left.where(F.col("n") > limit).select("node", "rep")
        if large.isEmpty():
            break
        if level == levels:
            retried = stored_in_few(_compare(_remaining(large, links, marks, limit), links.percent, thin=False), "near-found")
            release(links.add(retried), retried)
        else:
            before, left = left, _open(_branch(large, marks), links)
            release(before)
    release(left)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, levels: int = LEVELS,
                    node_limit: int = NODE_LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Component of each document: doc_id, n_shingles, component_id, kept.

    * Documents are linked if ``100 * intersection >= percent * union`` of their shingle sets; a
      component is named by its smallest id, whose document stays.
    * A text of fewer words than a shingle is one shingle. A missing, empty or blank text has none: it
      is linked with nothing and stays.
    * Rows with the same id are one document; each is reported. A missing id counts as the smallest
      possible one and is reported as NULL. An empty table gives an empty result, and other
      columns are ignored.
    """
    found = _classified(docs, shingle, percent, levels, node_limit, id_column, text_column)
    return found.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_shingles",
                        F.nullif("component", F.lit(NO_ID)).alias("component_id"),
                        (F.col("doc") == F.col("component")).alias("kept"))


def _classified(docs: DataFrame, shingle: int, percent: int, levels: int, node_limit: int, id_column: str, text_column: str) -> DataFrame:
    """doc, n_shingles, digest (of the set, NULL without shingles) and component of each row."""
    texts = docs.select(F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("doc"),
                        text_or_empty(text_column).alias("text"))
    sketches = stored(texts.mapInArrow(
        _sketches(shingle, band_width(percent)),
        "doc bigint, n_shingles bigint, digest binary, bands array<bigint>, marks binary"), "near-sketches")
    reps = stored_in_few(sketches.where("digest IS NOT NULL").groupBy("digest", "n_shingles", "bands", "marks")
                  .agg(F.min("doc").alias("rep")), "near-reps")
    links = _Links(texts, percent, shingle)
    _linked(reps, links, levels, node_limit)
    links.close()
    classes = _with_labels(reps, links.edges).select("digest", F.col("label").alias("component"))
    return (sketches.select("doc", "n_shingles", "digest").join(classes, "digest", "left")
            .withColumn("component", F.coalesce("component", "doc")))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, levels: int = LEVELS,
                         node_limit: int = NODE_LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows whose id comes with several different texts stay, since links do not tell which of the texts is the copy.
    """
    found = _classified(docs, shingle, percent, levels, node_limit, id_column, text_column)
    content = F.coalesce("digest", F.lit(bytearray()))
    gone = (found.groupBy("doc").agg(F.min("component").alias("component"), F.min(content).alias("a"), F.max(content).alias("b"))
            .where("a = b AND component <> doc").select(F.nullif("doc", F.lit(NO_ID)).alias("__gone")))
    return docs.join(gone, docs[id_column].eqNullSafe(gone["__gone"]), "left_anti")
