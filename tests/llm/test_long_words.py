"""Words beyond the lattice, and the Viterbi fold on whole documents, against the sentencepiece library."""

import random
import time

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from tagloom.llm import pieces
from tagloom.llm.pieces import BPE, UNIGRAM, PieceModel, best_borders, decode, default_model_path, encode, merged_borders


def test_unbroken_texts_equal_the_library_in_seconds(spark):
    model = PieceModel.load(default_model_path())
    library = sentencepiece.SentencePieceProcessor(model_file=default_model_path())
    rng = random.Random(6)
    syllables = ["ing", "the", "er", "tion", "a", "qu", "ß", "stra", "z"]
    texts = ["".join(rng.choices(syllables, k=40_000)), "a" * 3000, "漢字仮名" * 800, "=" * 2000 + "x" * 300,
             "short words and " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5000)) + " between them",
             "x" * 255, "x" * 256, "x" * 257, "\U0001f600" * 400]
    assert len(texts[0]) > 90_000
    started = time.monotonic()
    rows = encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model)
    back = {r.doc_id: (r.ids, r.decoded) for r in decode(rows, model).collect()}
    assert [i for i, t in enumerate(texts) if back[i] != (library.encode(t), t)] == []
    assert time.monotonic() - started < 60


def unigram_of_the_vocabulary(seed):
    """The installed vocabulary with scores of a unigram model, for the library and for us."""
    made = proto.ModelProto()
    with open(default_model_path(), "rb") as file:
        made.ParseFromString(file.read())
    rng = random.Random(seed)
    made.trainer_spec.model_type = UNIGRAM
    for piece in made.pieces:
        if piece.type in (1, 4):
            piece.type, piece.score = 1, -rng.uniform(3, 6) - 2 * len(piece.piece) ** 0.5
    rows = [(p.piece, i, p.score, p.type) for i, p in enumerate(made.pieces)]
    library = sentencepiece.SentencePieceProcessor(model_proto=made.SerializeToString())
    return library, PieceModel.of(UNIGRAM, rows)


def test_viterbi_fold_on_whole_documents_equals_the_library(spark):
    library, model = unigram_of_the_vocabulary(1)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.where("text IS NOT NULL")
    want = {r.doc_id: library.encode(r.text) for r in docs.collect()}
    got = {r.doc_id: r.ids for r in encode(docs, model).collect()}
    score = {i: s for _, i, s in model.pieces}

    def total(ids):
        return sum(score.get(i, 0.0) for i in ids)

    other = [d for d in want if got[d] != want[d]]
    # Paths of equal sums may differ by rounding alone: the library sums in single precision.
    assert len(want) >= 150 and len(other) <= len(want) // 20
    assert all(total(got[d]) == pytest.approx(total(want[d]), rel=1e-5) for d in other)


@pytest.mark.parametrize("kind", [UNIGRAM, BPE])
def test_long_and_short_ways_agree(spark, monkeypatch, kind):
    """The same words through the lattice and past it."""
    rng = random.Random(9)
    parts = ["a", "b", "c", "ab", "bc", "abc", "ca", "▁a", "cab", "aa", "▁"]
    rows = [("<unk>", 0, 0.0, 2)] + [(p, i + 1, -float(i // 2 + 1), 1) for i, p in enumerate(parts)]
    model = PieceModel.of(kind, rows)
    texts = ["".join(rng.choices("abcX ", weights=[5, 5, 5, 1, 1], k=rng.randrange(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def ids():
        return {r.doc_id: r.ids for r in encode(docs, model).collect()}

    through = ids()
    scores = {p: s for p, _, s in model.pieces}
    numbers = {p: i for p, i, _ in model.pieces}
    for k, text in enumerate(texts):
        again = []
        marked = "▁" + text.replace(" ", "▁")
        for word in pieces.re.findall(model.chunk, marked):
            borders = best_borders(word, scores, model.longest) if kind == UNIGRAM else merged_borders(word, scores)
            for s, e in zip(borders, borders[1:]):
                one = numbers.get(word[s:e], 0)
                if one or not again or again[-1]:
                    again.append(one)
        assert through[k] == again
