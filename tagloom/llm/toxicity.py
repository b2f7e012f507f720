"""Toxicity classifier: gradient-boosted trees over dense features, calibrated by isotonic regression.

A text is described by how densely it uses abusive words, plain or disguised, how near these are to words for
the person spoken to, and by its capitals, punctuation and obfuscation. Abuse that no word list knows is learnt from the labels: how
much more often toxic texts have words that begin with the same letters. Trees are boosted on most of a bounded sample of
labelled texts; the rest of the sample, unseen by the trees, maps their margins to probabilities that never fall as margins rise.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.quality import held_out
from tagloom.llm.shared import text_or_empty
from tagloom.staging import staged

MAX_TRAINING_ROWS = 20_000
"""Bound of the labelled sample that the model is fitted on, taken in the order of a hash of the id."""
CALIBRATION_SHARE = 4  # one in so many rows of the sample maps margins to probabilities
TREES, DEPTH, SEED = 20, 3, 17
TOXIC_FROM = 0.7
STEMS = range(4, 9)
"""Lengths of the beginnings of words that are learnt; words of other endings share them."""
MAX_STEMS = 20_000
LEAST_TEXTS, LEAST_SHARE = 5, 0.01
"""A stem must be in so many toxic texts of the sample, and in such a share of them."""
LEAST_ODDS = 2.0
"""Least logarithm of how much more often toxic texts have a stem."""
NEAR, WINDOW = 3, 50  # words around an abusive word, and the stretch in which such words are counted

# Common insults and abuse in English, German, French and Spanish.
LEXICON = frozenset("""
    arse arsehole asshole assholes bastard bastards bitch bitches braindead bullshit clown clowns coward cretin
    creep degenerate despicable dickhead dimwit disgrace disgusting dipshit douche douchebag dumb dumbass
    dunce filth filthy freak fuck fucker fucking garbage goddamn hateful horrible idiot idiotic idiots imbecile
    imbeciles jackass jerk jerks laughable liar liars loser losers lowlife lunatic maggot maggots moron moronic morons
    motherfucker nitwit numbskull parasite parasites pathetic piss prick psycho repulsive retard retarded
    revolting scum scumbag shit shithead shitty slut sucker stupid stupidity subhuman swine tosser trash twat twit ugly
    vermin vile wanker weirdo whore worthless wretch
    abschaum arschloch bescheuert blödmann dreckig dreckskerl drecksau dummkopf hurensohn idioten missgeburt
    penner schlampe schwachkopf schwachsinnig scheiße spinner trottel ungeziefer verdammt vollidiot vollpfosten
    wichser widerlich abruti bouffon connard connasse crétin débile enculé imbécile minable ordure pourriture
    salaud salope stupide merde asqueroso basura cabrón cobarde escoria estúpido gilipollas idiota imbécil
    mierda patético pendejo puta repugnante
""".split())
# Words for the person spoken to, in the same languages.
SECOND_PERSON = frozenset("""
    you your yours yourself yourselves youre you're u ur ya du dich dir dein deine deinen deiner ihr euch euer
    tu te toi ton tes vous votre vos tú ti contigo usted ustedes vosotros os vuestro
""".split())
# Signs and digits used in place of letters.
_LEET = str.maketrans("013457@$!|", "oieastasil")
_EDGES = ".,;:?!\"'()[]{}<>…“”„«»¿¡*_~-#"
_INSIDE = str.maketrans("", "", ".*_-~'")
_RUN = re.compile(r"([^\W\d_])\1\1")
_REPEATED = re.compile(r"(.)\1+")
_SPACED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")
_SHOUT = re.compile(r"(?<![^\W_])[A-Z]{3,}(?![^\W_])")
_BURST = re.compile(r"[!?]{2,}")
_SYMBOLS = np.frombuffer(b"#$%&*@~^<>\\{}=+_|", np.uint8)
_SQUEEZED = frozenset(_REPEATED.sub(r"\1", w) for w in LEXICON)

FEATURES = ("log_words", "density", "log_hits", "densest", "disguised", "near_second", "second", "upper", "shouted",
            "exclaims", "questions", "bursts", "symbols", "digits", "obfuscated", "letters_apart", "told", "told_next", "told_density")


def _disguise(word: str) -> tuple[bool, bool]:
    """Whether a word that is no plain abusive word is one in disguise, and whether it looks disguised at all."""
    core = word.strip(_EDGES)
    if core.isalpha():
        stretched = _RUN.search(core) is not None
        return stretched and _REPEATED.sub(r"\1", core) in _SQUEEZED, stretched
    if not any(c.isalpha() for c in core):
        return False, False
    letters = core.translate(_LEET).translate(_INSIDE)
    return letters in LEXICON or _REPEATED.sub(r"\1", letters) in _SQUEEZED, True


def stems_of(words: set[str]) -> set[str]:
    """The beginnings of lower-case words of letters, cut at the lengths ``STEMS``. Words of the word list have their own features."""
    cores = {word.strip(_EDGES) for word in words} - LEXICON
    return {core[:k] for core in cores if core.isalpha() for k in STEMS if k <= len(core)}


class WordOdds(dict):
    """The greatest odds of a word's stems, 0 without any; kept for the words seen last."""

    MOST = 200_000

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.stems = stems

    def __missing__(self, word: str) -> float:
        core = word.strip(_EDGES)
        odds = max([self.stems.get(core[:k], 0.0) for k in STEMS if k <= len(core)], default=0.0) if core.isalpha() and core not in LEXICON else 0.0
        if len(self) >= self.MOST:
            self.clear()
        if len(word) < 100:
            self[word] = odds
        return odds


def features_of(text: str, word_odds: WordOdds | None = None) -> list[float]:
    """The features of a text, in the order of ``FEATURES``; all zero without words."""
    low = text.lower()
    words = low.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    stretched = _RUN.search(low) is not None
    plain, disguised, obfuscated = set(), set(), 0
    for word in set(words):
        if word in LEXICON:
            plain.add(word)
        elif not word.isalpha():
            if word.strip(_EDGES) in LEXICON:
                plain.add(word)
                continue
            hit, odd = _disguise(word)
            obfuscated += odd
            if hit:
                disguised.add(word)
        elif stretched:
            hit, odd = _disguise(word)
            obfuscated += odd
            if hit:
                disguised.add(word)
    apart = hits_apart = 0
    for run in _SPACED.finditer(low):
        apart += 1
        joined = run.group().replace(" ", "").translate(_LEET)
        hits_apart += any(w in joined for w in LEXICON if len(w) > 3)
    abusive = plain | disguised
    places = [i for i, w in enumerate(words) if w in abusive] if abusive else []
    spoken_to = [i for i, w in enumerate(words) if w in SECOND_PERSON or w.strip(_EDGES) in SECOND_PERSON] if abusive else []
    second = len(spoken_to) if abusive else n - len([w for w in words if w not in SECOND_PERSON])
    near = densest = 0
    if places:
        at, to = np.array(places), np.array(spoken_to or [-10 * NEAR])
        after = np.minimum(np.searchsorted(to, at), len(to) - 1)
        gap = np.minimum(abs(to[after] - at), abs(to[np.maximum(after - 1, 0)] - at))
        near = int((gap <= NEAR).sum())
        densest = int((np.searchsorted(at, at + WINDOW) - np.arange(len(at))).max())
    hidden = sum(w in disguised for w in words) if disguised else 0
    hits = len(places) + hits_apart
    told = [0.0, 0.0, 0.0]
    if word_odds is not None and word_odds.stems:
        different = set(words)
        odds = sorted(filter(None, map(word_odds.__getitem__, different)), reverse=True)
        told = [*odds[:2], 0.0, 0.0][:2] + [sum(odds) / len(different)]
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower, size = int(counts[65:91].sum()), int(counts[97:123].sum()), len(data)
    return [float(np.log1p(n)), hits / n, float(np.log1p(hits)), float(max(densest, hits_apart)), (hidden + hits_apart) / n,
            near / max(1, hits), second / n, upper / max(1, upper + lower), len(_SHOUT.findall(text)) / n,
            counts[33] / n, counts[63] / n, len(_BURST.findall(text)) / n, counts[_SYMBOLS].sum() / size,
            counts[48:58].sum() / size, obfuscated / n, apart / n, *told]


def toxic_stems(rows: DataFrame) -> dict[str, float]:
    """Stems that toxic texts have more often, and the logarithm of how much: from rows with a ``text`` and a 0/1 ``label``.

    At most ``MAX_STEMS``, those in most toxic texts first. Each row counts a stem once.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):  # bounds what is counted at once
                part = batch.slice(start, 500)
                toxic, civil = Counter(), Counter()
                for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                    (toxic if label else civil).update(stems_of(set(text.lower().split())))
                stems = [*toxic, *(stem for stem in civil if stem not in toxic)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(stems, pa.string()), *(pa.array([found[stem] for stem in stems], pa.int64()) for found in (toxic, civil))],
                    names=["stem", "toxic", "civil"])

    n, all_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    odds = (F.log((F.col("toxic") + 0.5) / (all_toxic + 1)) - F.log((F.col("civil") + 0.5) / (n - all_toxic + 1)))
    found = (rows.select("text", "label").mapInArrow(count, "stem string, toxic bigint, civil bigint").groupBy("stem")
             .agg(F.sum("toxic").alias("toxic"), F.sum("civil").alias("civil"))
             .where(F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * all_toxic))
             .withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS))
    return {r.stem: r.odds for r in found.orderBy(F.desc("toxic"), F.desc("odds"), "stem").limit(MAX_STEMS).collect()}


def with_features(rows: DataFrame, keep: str, stems: dict[str, float] | None = None) -> DataFrame:
    """``keep`` columns of rows with a ``text``, and the array ``values``."""
    names = [part.strip().split(" ")[0] for part in keep.split(",")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = WordOdds(stems or {})
        for batch in batches:
            made = np.array([features_of(t.as_py(), odds) for t in batch.column("text")], float).reshape(-1)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.ListArray.from_arrays(offsets, pa.array(made))],
                                             names=[*names, "values"])
    return rows.mapInArrow(make, keep + ", values array<double>")


@dataclass(frozen=True)
class ToxicityModel:
    """Boosted trees and the calibration of their margins; without trees, the share of toxic labels."""

    share: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    stems: dict[str, float] = field(default_factory=dict)

    def with_score(self, rows: DataFrame) -> DataFrame:
        """Adds ``score`` to rows with ``values``."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.share))
        judged = self.trees.transform(rows.withColumn("features", array_to_vector("values")))
        if self.calibration is None:
            return judged.withColumn("score", vector_to_array("probability")[1])
        return self.calibration.transform(judged).withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, id_column: str = "doc_id",
          text_column: str = "text", label_column: str = "toxic") -> ToxicityModel:
    """Fit on labelled documents that are not held out; only texts and labels are used.

    Rows without id or label are left out; of an id labelled twice the mean counts, rounded; of an id with several texts
    the one whose features come first. With one kind of label only, or none, the model is the smoothed share of
    toxic labels; where the calibration part holds one kind only, the trees' own probability stays.
    """
    known = (labels.select(F.col(id_column).alias("doc"), F.col(label_column).alias("label"))
             .where("doc IS NOT NULL AND label IS NOT NULL").where(~held_out("doc"))
             .groupBy("doc").agg(F.round(F.avg("label")).cast("double").alias("label")))
    # The sample is bounded by ``max_rows``, so it may be broadcast, and its features may lie in one task.
    sample = known.orderBy(F.xxhash64("doc"), "doc").limit(max_rows).withColumn(
        "calibrates", F.pmod(F.xxhash64(F.col("doc") + 1), F.lit(CALIBRATION_SHARE)) == 0)
    texts = docs.select(F.col(id_column).alias("doc"), text_or_empty(text_column).alias("text"))
    labelled = texts.join(F.broadcast(sample), "doc")
    stems = toxic_stems(labelled.where("NOT calibrates"))
    rows = (with_features(labelled, "doc bigint, label double, calibrates boolean", stems)
            .groupBy("doc", "label", "calibrates").agg(F.min("values").alias("values"))
            .select("doc", "label", array_to_vector("values").alias("features"), "calibrates")
            .repartition(1).sortWithinPartitions("doc"))
    with staged(rows, "toxicity-sample") as stored:
        kinds = {r.calibrates: r for r in stored.groupBy("calibrates").agg(
            F.count("*").alias("n"), F.sum("label").alias("toxic")).collect()}
        n, toxic = (sum(r[k] for r in kinds.values()) for k in ("n", "toxic"))
        share = (toxic + 0.5) / (n + 1)

        def mixed(part: bool) -> bool:
            return part in kinds and 0 < kinds[part]["toxic"] < kinds[part]["n"]

        if not mixed(False):
            return ToxicityModel(share, stems=stems)
        trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH,
                              minInstancesPerNode=5, seed=SEED).fit(stored.where("NOT calibrates"))
        if not mixed(True):
            return ToxicityModel(share, trees, stems=stems)
        margins = trees.transform(stored.where("calibrates")).select("label", "rawPrediction")
        isotonic = IsotonicRegression(labelCol="label", featuresCol="rawPrediction", featureIndex=1, predictionCol="score")
        return ToxicityModel(share, trees, isotonic.fit(margins), stems)


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.7 on) of each row.

    * NULL and empty texts are scored as texts without words; a text of any length is scored as a whole.
    * Each row is judged by its text alone, so rows repeated in full get the same score.
    * A missing id stays NULL and is not held out; other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return model.with_score(with_features(texts, "doc_id bigint", model.stems)).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The rows whose text is not predicted to be toxic, with all their columns."""
    stems = model.stems

    @F.pandas_udf("array<double>")
    def measured(texts):
        import pandas as pd
        odds = WordOdds(stems)
        return pd.Series([features_of(t, odds) for t in texts])

    columns = [F.col(c).alias(f"kept_{k}") for k, c in enumerate(docs.columns)]
    judged = model.with_score(docs.select(*columns, measured(text_or_empty(text_column)).alias("values")))
    back = [F.col(f"kept_{k}").alias(c) for k, c in enumerate(docs.columns)]
    return judged.where(F.col("score") < TOXIC_FROM).select(*back)
