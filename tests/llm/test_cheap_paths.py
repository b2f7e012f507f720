"""Forms that save time give what the plain forms give."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import pieces
from tagloom.llm.pieces import PieceModel, default_model_path


def test_borders_in_bits_are_those_of_the_heap(spark):
    model = PieceModel.load(default_model_path())
    dice = random.Random(3)
    words = sorted({"▁" * dice.randint(0, 1) + "".join(dice.choices("aethinorsßé", k=dice.randint(2, 90))) for _ in range(400)}
                   | {"a" * 61, "a" * 62, "a" * 63, "th" * 31, "th" * 32})
    rows = spark.createDataFrame([(w, 0) for w in words], "word string, block bigint")
    made = {r.word: r.borders for r in pieces.segmented(rows, model, ["block"]).collect()}
    scores = {p: s for p, _, s in model.pieces}
    assert all(made.get(w, list(range(len(w) + 1))) == pieces.merged_borders(w, scores) for w in words)


def test_known_units_are_left_out_and_others_are_cut(spark):
    model = PieceModel.load(default_model_path())
    texts = ["the house, the house;\nthe end", " leading", "two  spaces here", "trailing ", "a▁mark ▁here", "x", "", " "]
    known = {"▁the": b"", "▁house": b"", "▁x": b""}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "block bigint, text string")
    got = {(r.block, r.word) for r in pieces._other_words(rows, model, spark.sparkContext.broadcast(known)).collect()}
    want = {(i, w) for i, t in enumerate(texts) if t for w in re.findall(model.chunk, "▁" + t.replace(" ", "▁"))
            if w not in known and len(w) > 1}
    assert got == want


def test_texts_are_compared_with_what_their_ids_give():
    model = PieceModel.load(default_model_path())
    number = {p: i for p, i, _ in model.pieces}
    ids = [[], [number["▁the"]], [number["▁the"], number["▁the"]], [number["▁the"]], [model.first_byte + 0xff], [number["▁the"]]]
    texts = ["", "the", "the the", "thee", "�", ""]
    sizes = np.cumsum([0, *map(len, ids)]).tolist()
    got = pieces._come_back(texts, np.array(sum(ids, []), np.int32), sizes, model.names, pa.array(model.names, pa.large_binary()))
    assert got == [True, True, True, False, True, False]


@pytest.mark.parametrize("tied", [False, True])
def test_edges_carry_no_words_and_fold_to_the_same_borders(spark, monkeypatch, tied):
    """Only one row of a word holds it, so the edges of a block fill little memory; groups of any size fold alike."""
    monkeypatch.setattr(pieces, "TOGETHER", 7)
    rng = random.Random(31)
    parts = ["ab", "bc", "abc", "ca", "▁a", "cab", "aa", "bb", "aabb"]
    rows = [("<unk>", 0, 0.0, 2)] + [(p, i + 1, -float(i // 2 if tied else i), 1) for i, p in enumerate(["a", "b", "c", "▁", *parts])]
    model = PieceModel.of(pieces.BPE, rows)
    words = list({"▁" * rng.randrange(2) + "".join(rng.choices("abcX", k=n)) for n in [*range(1, 40), 60, 61, 62, 63, 255, 256] for _ in range(3)})
    table = spark.createDataFrame([(i % 3, w) for i, w in enumerate(words)], "block bigint, word string").repartition(2, "block")
    edges = pieces._edges(table, model, ["block"]).collect()
    assert sum(r.word is not None for r in edges) == sum(len(w) > 1 for w in words) < len(edges) / 3
    made = {r.word: r.borders for r in pieces.segmented(table, model, ["block"]).collect()}
    scores = {p: s for p, _, s, t in rows if t == 1}
    assert all(made.get(w, list(range(len(w) + 1))) == pieces.merged_borders(w, scores) for w in words)


def test_words_numbered_in_several_tasks_are_refused():
    model = PieceModel.of(pieces.BPE, [("<unk>", 0, 0.0, 2), ("a", 1, -1.0, 1), ("aa", 2, -2.0, 1)])
    with pytest.raises(ValueError):
        pieces._EdgeKeys(model).folded(np.array([0, 0], np.int64), pa.array(["aa", "aaa"]))


def test_near_duplicates_store_rows_of_shared_nodes_only(spark, monkeypatch):
    """Documents that resemble no other are in no table but the sketches and the distinct documents."""
    from tagloom.llm import near_dedup, shared
    store, rows = shared.stored, {}

    def counting(df, label):
        made = store(df, label)
        rows[label] = max(rows.get(label, 0), made.count())
        return made

    monkeypatch.setattr(shared, "stored", counting)
    monkeypatch.setattr(near_dedup, "stored", counting)
    texts = [" ".join(f"d{i}w{k}" for k in range(60)) for i in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (500, texts[7] + " more")], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, shingle=4).collect()}
    assert got == {i: i for i in range(120)} | {500: 7}
    assert max(n for label, n in rows.items() if label not in ("near-sketches", "near-reps")) <= 64
