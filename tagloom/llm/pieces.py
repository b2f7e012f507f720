"""SentencePiece encoding as a relational lattice, and decoding.

Texts are cut where no piece can cross, so that each distinct word needs to be segmented once per
block of documents. The words' substrings of bounded length are joined to the piece table, the
edges found are grouped by word, and a fold over them picks the segmentation:

* unigram models: Viterbi, from left to right, keeping the best way to reach each position;
* BPE models: merges in the order of the pieces' scores. A BPE model's scores are merge ranks, not
  log probabilities, and the best sum of them is not what such a model encodes; so here the fold
  runs over the same lattice by rank and removes inner borders. Edges are numbers that sort by word and rank, and
  tasks fold those of many words together in Numpy, so that they need no grouping by word before.

Words that are frequent in a bounded sample of the documents are segmented once and sent to all tasks as a table of
bounded size; blocks segment the others. So the sample decides only where a word is segmented, not how.

The folds take time by the square of a word's length. Words beyond ``LONG_WORD`` characters are segmented by the same
merges, or the same Viterbi steps, with a heap or table in the task that puts the ids of their document together.

Everything up to the last step is keyed by block, so documents move once, to their block, and so do the words that
are not frequent: edges and results of a block stay in its partition.
"""

import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.shared import NO_ID, release, stored, text_or_empty

SPACE = "▁"
BLOCK_BYTES = 8 * 1024 * 1024
FREQUENT_WORDS = 250_000
"""At most this many words are segmented ahead of the blocks; some 40 MB in a Python worker."""
SAMPLE_BYTES = 64 * 1024 * 1024
"""Text in which frequent words are counted."""
MAX_PARTITIONS = 20_000
"""Beyond this many partitions, or the session's number if it is higher, blocks share tasks, which then spill."""
LONG_WORD = 256
"""Longest word that the lattice holds; longer ones, such as encoded data, are segmented in place."""
UNIGRAM, BPE = 1, 2
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u1fff\u2c00-\u2dff\u3005-\ud7ff"
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class PieceModel:
    """What encoding needs of a model file; bounded by the vocabulary."""

    kind: int
    pieces: tuple  # (piece, id, score)
    names: tuple   # bytes of each id, as decoding prints them
    unknown: int
    first_byte: int | None
    chunk: str     # pattern of the parts that no piece crosses

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        """Read a model whose normaliser changes nothing but spaces; raise for any other."""
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if (spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix
                or not spec.escape_whitespaces):
            raise ValueError("only models with an identity normaliser and a leading space are supported")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        rows = [(p.piece, i, p.score, p.type) for i, p in enumerate(model.pieces)]
        return cls.of(model.trainer_spec.model_type, rows)

    @classmethod
    def of(cls, kind: int, rows: list[tuple]) -> "PieceModel":
        """From rows (piece, id, score, type); types: 1 normal, 2 unknown, 3 control, 4 user, 6 byte."""
        pieces = tuple((p, i, s) for p, i, s, t in rows if t in (1, 4))
        of_bytes = [i for _, i, _, t in rows if t == 6]
        if of_bytes and of_bytes != list(range(of_bytes[0], of_bytes[0] + 256)):
            raise ValueError("byte pieces are expected in one run of 256 ids")
        names = tuple(
            bytes([int(p[3:5], 16)]) if t == 6 else " ⁇ ".encode() if t == 2
            else b"" if t == 3 else p.replace(SPACE, " ").encode() for p, _, _, t in rows)
        unknown = next((i for _, i, _, t in rows if t == 2), 0)
        return cls(kind, pieces, names, unknown, of_bytes[0] if of_bytes else None,
                   chunk_pattern([p for p, _, _ in pieces]))


def chunk_pattern(pieces: list[str]) -> str:
    """Pattern of parts of an escaped text that no piece crosses, for Java and Python alike.

    A space mark begins a part if no piece has one inside. Letters are parted from other characters, and
    line breaks from both, if no piece joins them. Few and wide ranges keep the matching fast.
    """
    longer = [p.lstrip(SPACE) for p in pieces]
    if any(SPACE in p for p in longer):
        return r"(?s).+"
    kinds = [f"[{LETTERS}]+", f"[^{LETTERS}{SPACE}\n]+", r"\n+"]
    part = re.compile("|".join(kinds))
    if all(part.fullmatch(p) for p in longer if p):
        return f"{SPACE}*(?:{'|'.join(kinds)})|{SPACE}+"
    return f"{SPACE}*[^{SPACE}]+|{SPACE}+"


def escaped(text: Column) -> Column:
    return F.when(text == "", "").otherwise(F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE))))


# The folds. Borders count code points from 0. Edges of BPE words are numbers; an edge of a unigram word is a
# struct (s, e, score).

PLACE_BITS = 9
"""Bits of a place in a word, up to ``LONG_WORD``."""
BORDER_BITS = 61
"""Words of at most this many characters are folded together, with their borders in the bits of one number."""
TOGETHER = 8192
"""Words that are folded together, which bounds the memory it takes."""


class _EdgeKeys:
    """Rows of a word and of its edges as one number each, which sorts by word, then rank, then start, then end.

    A word's own row has no rank, start and end, so it comes first. Words are numbered within their task.
    """

    def __init__(self, model: PieceModel):
        scores = sorted({s for _, _, s in model.pieces}, reverse=True)
        shared = Counter(s for _, _, s in model.pieces)
        self.rank = {s: r for r, s in enumerate(scores, 1)}
        self.tied = np.array([r for s, r in self.rank.items() if shared[s] > 1], np.int64)
        self.scores = {p: s for p, _, s in model.pieces} if len(self.tied) else {}
        self.number_at = len(scores).bit_length() + 2 * PLACE_BITS
        self.most = 2 ** (63 - self.number_at)

    def folded(self, keys: np.ndarray, words: pa.Array | pa.ChunkedArray) -> tuple[list[str], list[np.ndarray]]:
        """Words that have edges, with the borders left after their merges; ``words`` is null in rows of edges."""
        own = words.is_valid().to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool)
        named = keys[own]
        texts = words.filter(pa.array(own)).take(pa.array(np.argsort(named, kind="stable")))
        keys = np.sort(keys)
        first = np.searchsorted(keys, np.sort(named))
        if len(first) and (first[0] or (np.diff(first) == 0).any()):
            raise ValueError("the words of a group were numbered in several tasks")
        counts = np.diff(np.append(first, len(keys))) - 1
        texts = texts.to_pylist()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        tied = np.zeros(len(first), bool)
        if len(self.tied) and len(first):
            rank = (keys >> 2 * PLACE_BITS) & (2 ** (self.number_at - 2 * PLACE_BITS) - 1)
            tied = np.add.reduceat(np.isin(rank, self.tied), first) > 1
        borders: list = [None] * len(texts)
        together = np.flatnonzero((counts > 0) & (sizes <= BORDER_BITS) & ~tied)
        for some in np.split(together, range(TOGETHER, len(together), TOGETHER)):
            left = _folded_together(keys, first[some] + 1, counts[some], sizes[some])
            for at, kept in zip(some.tolist(), left, strict=True):
                borders[at] = kept
        for at in np.flatnonzero((counts > 0) & ((sizes > BORDER_BITS) | tied)).tolist():
            of_word = keys[first[at] + 1:first[at] + 1 + counts[at]]
            borders[at] = (merged_borders(texts[at], self.scores) if tied[at]
                           else _folded_alone(int(sizes[at]), *map(np.ndarray.tolist, _places(of_word))))
        kept = np.flatnonzero(counts > 0).tolist()
        return [texts[at] for at in kept], [borders[at] for at in kept]


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return keys >> PLACE_BITS & 2 ** PLACE_BITS - 1, keys & 2 ** PLACE_BITS - 1


def _folded_alone(n: int, begin: list[int], end: list[int]) -> list[int]:
    """Borders of one word after the merges by its edges, which come by rank and start."""
    bits = 2 ** (n + 1) - 1
    for s, e in zip(begin, end, strict=True):
        # The neighbours that the piece joins have three borders: at its start, at its end and one between.
        seen = (bits >> s) & ((2 << (e - s)) - 1)
        if seen & 1 and seen >> (e - s) and seen.bit_count() == 3:
            bits -= (seen - 1 - (1 << (e - s))) << s
    return [at for at in range(n + 1) if bits >> at & 1]


def _folded_together(keys: np.ndarray, first: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    """The same for many words of at most ``BORDER_BITS`` characters: the first edge of each, then the second of each, ..."""
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    bits = (np.int64(1) << (sizes[order] + 1)) - 1
    for k, words in enumerate(np.searchsorted(-counts, -np.arange(1, counts[0] + 1), side="right") if len(counts) else ()):
        (s, e), now = _places(keys[first[:words] + k]), bits[:words]
        width = e - s
        seen = now >> s & (np.int64(2) << width) - 1
        inner = seen - 1 - (np.int64(1) << width)
        applies = (seen & 1 == 1) & (seen >> width == 1) & (inner > 0) & (inner & inner - 1 == 0)
        bits[:words] = np.where(applies, now - (inner << s), now)
    left = np.empty_like(bits)
    left[order] = bits
    row, at = np.nonzero(left[:, None] >> np.arange(BORDER_BITS + 1) & 1)
    ends = np.cumsum(np.bincount(row, minlength=len(left))).tolist()
    at = at.tolist()
    return [at[a:b] for a, b in zip([0, *ends], ends)]


def _viterbi(worst: float) -> Column:
    """Borders of the path with the highest sum of scores; the longest last piece wins ties.

    A character without a piece may be passed alone, at a score below that of any piece.
    """
    def best(ways: Column, e: Column) -> Column:
        arriving = F.transform(
            F.filter("edges", lambda edge: edge["e"] == e),
            lambda edge: F.struct((F.get(ways, edge["s"])["score"] + edge["score"]).alias("score"),
                                  (-edge["s"]).alias("back")))
        alone = F.struct((F.get(ways, e - 1)["score"] + F.lit(worst)).alias("score"),
                         (-(e - 1)).alias("back"))
        return F.array_max(F.concat(arriving, F.array(alone)))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back")))
    ways = F.aggregate(F.sequence(F.lit(1), F.col("n")), start,
                       lambda ways, e: F.concat(ways, F.array(best(ways, e))))
    return F.aggregate(
        F.sequence(F.lit(1), F.col("n")), F.struct(F.array("n").alias("path"), ways.alias("ways")),
        lambda state, _: F.when(F.get(state["path"], F.lit(0)) == 0, state).otherwise(F.struct(
            F.concat(F.array(-F.get(state["ways"], F.get(state["path"], F.lit(0)))["back"]),
                     state["path"]).alias("path"), state["ways"].alias("ways"))),
        lambda state: state["path"])


def _spans(words: DataFrame, model: PieceModel, keys: list[str], pieces: DataFrame, least: int) -> DataFrame:
    """Places of the words where a piece of ``pieces`` (of_piece and more) lies, with the columns of that piece.

    Where ``pieces`` has the empty piece, each word has one more row, which begins at -1.
    """
    n = F.char_length("word")
    outside = F.col("s") < 0
    begin = -1 if least > 1 else 0
    spans = (words.where(n >= least).withColumn("number", F.monotonically_increasing_id())
             .select("number", *keys, "word", F.explode(F.sequence(F.lit(begin), n - least)).alias("s"))
             .select("*", F.explode(F.sequence(
                 F.when(outside, 0).otherwise(least),
                 F.when(outside, 0).otherwise(F.least(F.lit(max(model.longest, least)), n - F.col("s"))))).alias("chars"))
             .withColumn("piece", F.substring(F.col("word"), F.col("s") + 1, F.col("chars")))
             .withColumn("code", F.xxhash64("piece")))
    # The piece table is bounded by the vocabulary. Most substrings are no piece, which a number as the key tells soonest;
    # substrings that share the number of a piece are compared with it.
    table = pieces.withColumn("of_code", F.xxhash64("of_piece"))
    same = F.startswith("piece", "of_piece") & (F.octet_length("piece") <= F.octet_length("of_piece"))
    return spans.join(F.broadcast(table), (spans["code"] == table["of_code"]) & same)


def _edges(words: DataFrame, model: PieceModel, keys: list[str]) -> DataFrame:
    """The lattice of a BPE model: the keys, ``key`` (see ``_EdgeKeys``) and ``word``, which is NULL in rows of edges.

    Words are numbered in their task, so the words of a group have to lie in one, and so do their edges.
    """
    made = _EdgeKeys(model)
    pieces = words.sparkSession.createDataFrame(
        [("", 0), *((p, made.rank[s] << 2 * PLACE_BITS) for p, _, s in model.pieces if len(p) > 1)],
        "of_piece string, rank bigint")
    outside = F.col("s") < 0
    place = F.shiftleft(F.col("s").cast("bigint"), PLACE_BITS) + F.col("s") + F.col("chars")
    number = F.shiftleft(F.col("number").bitwiseAND(F.lit(made.most - 1)), made.number_at)
    return _spans(words, model, keys, pieces, 2).select(
        *keys, (number + F.col("rank") + F.when(outside, F.lit(0)).otherwise(place)).alias("key"),
        F.when(outside, F.col("word")).alias("word"))


def segmented(words: DataFrame, model: PieceModel, keys: list[str]) -> DataFrame:
    """``words`` (the keys and ``word``) with the borders of their segments.

    Words that no piece of two or more characters touches are left out: each character stands alone.
    """
    if model.kind == UNIGRAM:
        return _segmented_by_score(words, model, keys)
    by_rank = _EdgeKeys(model)

    def fold(rows: pa.Table) -> pa.Table:
        found, borders = by_rank.folded(rows.column("key").to_numpy(), rows.column("word"))
        of_group = rows.select(keys).take(pa.array(np.zeros(len(found), np.int64)))
        return pa.table({**dict(zip(keys, of_group.columns, strict=True)), "word": pa.array(found, pa.string()),
                         "borders": pa.array(borders, pa.list_(pa.int32()))})

    kinds = dict(words.dtypes)
    return _edges(words.repartition(*keys), model, keys).groupBy(*keys).applyInArrow(
        fold, "".join(f"{key} {kinds[key]}, " for key in keys) + "word string, borders array<int>")


def _segmented_by_score(words: DataFrame, model: PieceModel, keys: list[str]) -> DataFrame:
    """The same for unigram models."""
    pieces = words.sparkSession.createDataFrame([(p, float(s)) for p, _, s in model.pieces], "of_piece string, score double")
    # Words are numbered in the order in which they lie in their task, so that their edges, which stay in
    # that order, are grouped by a number that needs hardly any sorting. The numbers do not leave the task.
    edge = F.struct("s", (F.col("s") + F.col("chars")).alias("e"), "score")
    lattice = (_spans(words, model, keys, pieces, 1).select("number", *keys, "word", edge.alias("edge"))
               .groupBy("number", *keys).agg(F.first("word").alias("word"), F.collect_list("edge").alias("edges"))
               .withColumn("n", F.char_length("word")))
    final = _viterbi(min((s for _, _, s in model.pieces), default=0.0) - UNKNOWN_PENALTY)
    return lattice.select(*keys, "word", final.alias("borders"))


def merged_borders(word: str, scores: dict[str, float]) -> list[int]:
    """Borders after merging, again and again, the neighbours whose piece has the best score, the first of equals."""
    n = len(word)
    ends = [*range(1, n + 1), n]  # end of the segment that starts here; 0 once it was merged away
    begins = [0, *range(n)]       # start of the segment that ends here
    waiting = []

    def offer(s: int) -> None:
        if ends[s] < n:
            e = ends[ends[s]]
            score = scores.get(word[s:e])
            if score is not None:
                heapq.heappush(waiting, (-score, s, e))

    for s in range(n):
        offer(s)
    while waiting:
        _, s, e = heapq.heappop(waiting)
        middle = ends[s]
        if middle == 0 or middle >= e or ends[middle] != e:
            continue
        ends[s], ends[middle], begins[e] = e, 0, s
        offer(s)
        if s:
            offer(begins[s])
    return [s for s in range(n) if ends[s]] + [n]


def best_borders(word: str, scores: dict[str, float], longest: int) -> list[int]:
    """Borders of the path with the highest sum of scores, by the rules of ``_viterbi``."""
    alone = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
    sums, back = [0.0], [0]
    for e in range(1, len(word) + 1):
        ways = [(sums[s] + scores[word[s:e]], -s) for s in range(max(0, e - longest), e) if word[s:e] in scores]
        total, s = max([*ways, (sums[e - 1] + alone, 1 - e)])
        sums.append(total)
        back.append(-s)
    path = [len(word)]
    while path[-1]:
        path.append(back[path[-1]])
    return path[::-1]


class _Spelling(dict):
    """Ids of words, as the bytes of 32-bit numbers.

    A word that was not put in stands by characters if the lattice could hold it, and is segmented here if it could not.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.ids = {p: i for p, i, _ in model.pieces}
        self.scores: dict[str, float] | None = None
        self.first_byte, self.unknown = model.first_byte, model.unknown

    def __missing__(self, word: str) -> bytes:
        made = self.spelled(word, range(len(word) + 1) if len(word) <= LONG_WORD else self.borders(word))
        if len(word) <= LONG_WORD:
            self[word] = made
        return made

    def borders(self, word: str) -> list[int]:
        if self.scores is None:
            self.scores = {p: s for p, _, s in self.model.pieces}
        if self.model.kind == UNIGRAM:
            return best_borders(word, self.scores, self.model.longest)
        return merged_borders(word, self.scores)

    def put(self, batch: pa.RecordBatch) -> None:
        """Take in words with their borders."""
        ends = batch.column("borders").offsets.to_pylist()
        borders = batch.column("borders").values.to_numpy().tolist()
        for word, a, b in zip(batch.column("word").to_pylist(), ends, ends[1:]):
            self[word] = self.spelled(word, borders[a:b])

    def put_folded(self, words: list[str], borders: list[list[int]]) -> None:
        for word, some in zip(words, borders, strict=True):
            self[word] = self.spelled(word, some)

    def spelled(self, word: str, borders) -> bytes:
        out = []
        for s, e in zip(borders, borders[1:]):
            piece = self.ids.get(word[s:e])
            if piece is not None:
                out.append(piece)
            elif self.first_byte is None:
                out.append(self.unknown)
            else:
                out.extend([self.first_byte + b for b in word[s:e].encode()])
        return struct.pack(f"{len(out)}i", *out)


def _units(marked: str) -> list[str]:
    """The parts of a marked text that begin at its space marks, of which no two are neighbours."""
    return marked.replace(SPACE, " " + SPACE).split(" ")[1:]


def _come_back(texts: list[str], ids: np.ndarray, sizes: list[int], names: tuple, held: pa.Array) -> list[bool]:
    """Whether the ids of each text, which end at ``sizes``, are decoded to it; ``held`` has the names as an array."""
    found = held.take(pa.array(ids))
    ends = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)[sizes].tolist() if len(found) else [0] * len(sizes)
    data = found.buffers()[2].to_pybytes() if len(found) else b""
    same = []
    for text, a, b, first, last in zip(texts, ends, ends[1:], sizes, sizes[1:], strict=False):
        # Equal bytes are valid UTF-8, so decoding them gives the text; other bytes are decoded to see.
        same.append(data[a:b] == ((" " + text).encode() if text else b"")
                    or _decoded(ids[first:last], names) == text)
    return same


def _decoded(ids: np.ndarray, names: tuple) -> str:
    text = b"".join(map(names.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _distinct_words(rows: DataFrame, model: PieceModel, *columns: str) -> DataFrame:
    """Each different word of each text once, but for long ones."""
    chunks = F.regexp_extract_all(escaped(F.col("text")), F.lit(model.chunk), F.lit(0))
    return (rows.select(*columns, F.explode(F.array_distinct(chunks)).alias("word"))
            .where(F.char_length("word") <= LONG_WORD))


def _other_words(rows: DataFrame, model: PieceModel, ids_of_frequent) -> DataFrame:
    """(block, word): words of two characters or more that are not among the frequent, each once per batch of texts."""
    pattern, by_units = re.compile(model.chunk), model.chunk.startswith(SPACE)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids_of_frequent.value
        for batch in batches:
            found: dict[int, set] = {}
            for block, text in zip(batch.column("block").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    marked = SPACE + text.replace(" ", SPACE)
                    if by_units and SPACE * 2 not in marked:
                        # A part begins at each space mark, so what is known from mark to mark need not be cut.
                        marked = "".join(set(_units(marked)).difference(known, (SPACE,)))
                    found.setdefault(block, set()).update(
                        w for w in pattern.findall(marked) if w not in known and 1 < len(w) <= LONG_WORD)
            sizes = [len(words) for words in found.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.fromiter(found, np.int64, len(found)), sizes), pa.int64()),
                 pa.array([w for words in found.values() for w in words], pa.string())], names=["block", "word"])

    return rows.select("block", "text").mapInArrow(find, "block bigint, word string")


def frequent_words(rows: DataFrame, model: PieceModel, total: int, most: int = FREQUENT_WORDS,
                   sample_bytes: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """Ids of words of two or more characters in several texts of a sample, ``most`` words at most."""
    classes = max(1, -(-total // sample_bytes))
    sample = rows.where(F.pmod(F.xxhash64("text", "doc"), F.lit(classes)) == 0)
    counted = stored(_distinct_words(sample, model).where(F.char_length("word") > 1).groupBy("word")
                     .agg(F.count("*").alias("texts")).where("texts > 1"), "piece-words")
    # Counts are few different numbers. The least one is chosen that lets no more than ``most`` words in.
    least, room = 2, most
    for texts, words in sorted(map(tuple, counted.groupBy(F.least("texts", F.lit(100_000)).alias("texts"))
                                   .count().collect()), reverse=True):
        room -= words
        if room < 0:
            least = texts + 1
            break
    groups = 64
    chosen = stored(counted.where(F.col("texts") >= least).select(
        "word", F.pmod(F.xxhash64("word"), F.lit(groups)).alias("part"))
        .repartition(groups, "part"), "piece-frequent")
    release(counted)
    ids = _Spelling(model)
    for batch in (segmented(chosen, model, ["part"]).select("word", "borders")
                  .toArrow().to_batches(max_chunksize=10_000)):
        ids.put(batch)
    for word in chosen.select("word").toArrow().column("word").to_pylist():
        ids[word]  # a word that no piece touches stands by characters
    release(chosen)
    return dict(ids)


def encode(docs: DataFrame, model: PieceModel, id_column: str = "doc_id", text_column: str = "text",
           block_bytes: int = BLOCK_BYTES, check: bool = False) -> DataFrame:
    """Piece ids of each whole text: doc_id, ids and, with ``check``, round_trip.

    ``round_trip`` says whether the ids, decoded where they were made, give the text back.

    * NULL and empty texts have no pieces. A space mark in a text is read as a space.
    * Rows repeated in full are encoded each; a missing id stays NULL. Other columns are ignored.
    * An empty table gives an empty result.
    * Words of more than ``LONG_WORD`` characters get the same pieces, in time about in proportion to their length.
    """
    total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    rows = docs.select(
        F.pmod(F.xxhash64(id_column, text_column), F.lit(blocks)).alias("block"),
        F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("doc"),
        text_or_empty(text_column).alias("text"))
    ids = frequent_words(rows.select("doc", "text"), model, total)
    ids_of_frequent = docs.sparkSession.sparkContext.broadcast(ids)  # bounded by FREQUENT_WORDS
    # A stated number of partitions keeps Spark from laying many blocks into one task at any input size.
    wide = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(2 * blocks, max(wide, MAX_PARTITIONS))
    source, rows = rows, rows.repartition(parts, "block")
    words = _other_words(source, model, ids_of_frequent).repartition(parts, "block").distinct()
    by_rank = _EdgeKeys(model) if model.kind == BPE else None
    found = _edges if by_rank else _segmented_by_score
    known = found(words, model, ["block"]).withColumnRenamed("block", "of_block")
    pattern, by_units = re.compile(model.chunk), model.chunk.startswith(SPACE)

    def assemble(docs_of: pa.Table, words_of: pa.Table) -> pa.Table:
        table = _Spelling(model)
        table.update(ids_of_frequent.value)
        if by_rank:
            table.put_folded(*by_rank.folded(words_of.column("key").to_numpy(), words_of.column("word")))
        else:
            for batch in words_of.select(["word", "borders"]).to_batches(max_chunksize=10_000):
                table.put(batch)
        out, sizes, same = [], [0], []
        names = pa.array(model.names, pa.large_binary())
        for batch in docs_of.select(["text"]).to_batches(max_chunksize=100):
            texts, made, ends = batch.column("text").to_pylist(), [], [0]
            for text in texts:
                marked = SPACE + text.replace(" ", SPACE) if text else ""
                if by_units and SPACE * 2 not in marked:
                    # A part begins at each space mark, and most of what lies between two marks is one part.
                    ids = b"".join([known if (known := table.get(unit)) is not None
                                    else b"".join(map(table.__getitem__, pattern.findall(unit)))
                                    for unit in _units(marked)])
                else:
                    ids = b"".join(map(table.__getitem__, pattern.findall(marked)))
                if model.first_byte is None:  # neighbouring unknown characters are one unknown piece
                    held = np.frombuffer(ids, dtype=np.int32)
                    again = (held[1:] == model.unknown) & (held[:-1] == model.unknown)
                    ids = held[np.concatenate(([True] * min(len(held), 1), ~again))].tobytes()
                made.append(ids)
                ends.append(ends[-1] + len(ids) // 4)
            joined = b"".join(made)
            if check:
                same += _come_back(texts, np.frombuffer(joined, dtype=np.int32), ends, model.names, names)
            out.append(joined)
            sizes += [sizes[-1] + end for end in ends[1:]]
        ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(
            np.frombuffer(b"".join(out), dtype=np.int32)))
        checked = {"round_trip": pa.array(same, pa.bool_())} if check else {}
        return pa.table({"doc": docs_of.column("doc"), "ids": ids, **checked})

    checked = ["round_trip"] if check else []
    return (rows.groupBy("block").cogroup(known.groupBy("of_block"))
            .applyInArrow(assemble, "doc bigint, ids array<int>" + ", round_trip boolean" * check)
            .select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "ids", *checked))


def decode(rows: DataFrame, model: PieceModel, ids_column: str = "ids",
           into: str = "decoded") -> DataFrame:
    """Text of each array of piece ids, as a further column; NULL ids give NULL.

    Bytes that are not valid UTF-8 become the replacement character.
    """
    names = model.names

    @F.pandas_udf("string")
    def texts(column):
        return column.map(lambda ids: None if ids is None else _decoded(ids, names), na_action=None)

    return rows.withColumn(into, texts(F.col(ids_column)))


def default_model_path() -> str:
    """The public model installed beside this program."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode_and_check(spark: SparkSession, docs: DataFrame, model_path: str | None = None,
                     **options) -> DataFrame:
    """Ids of each document, and whether decoding them gives its text back."""
    model = PieceModel.load(model_path or default_model_path())
    rows = encode(docs, model, check=True, **options)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "round_trip")
