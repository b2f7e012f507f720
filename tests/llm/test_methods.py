"""The operators' methods against brute force, the tokenizer libraries and planted cases."""

import random

import numpy as np
import pytest
import sentencepiece

from tagloom.llm.components import components
from tagloom.llm.cuckoo import CuckooFilter
from tagloom.llm.decontaminate import _fingerprints, contaminated
from tagloom.llm.exact_dedup import drop_copies
from tagloom.llm.licenses import scan_licenses
from tagloom.llm.line_dedup import LineIndex
from tagloom.llm.near_dedup import drop_near_duplicates, near_duplicates
from tagloom.llm.pieces import UNIGRAM, PieceModel, decode, default_model_path, encode
from tagloom.llm.quality import fit
from tagloom.llm.sharding import place
from tagloom.llm.token_counts import Tokenizer, attribute, token_spans


def test_cuckoo_filter_holds_and_forgets():
    digests = [random.Random(i).randbytes(16) for i in range(5000)]
    made = CuckooFilter.build(digests[:4000])
    assert made.may_hold(digests[:4000]).all()
    assert made.may_hold(digests[4000:]).mean() < 0.01
    made.remove(digests[:2000])
    assert made.may_hold(digests[2000:4000]).all() and made.may_hold(digests[:2000]).mean() < 0.01


def test_line_index_is_reversible(spark):
    line = "This line is repeated in many documents"
    docs = spark.createDataFrame([(i, f"{line}\nown line of document {i} only") for i in range(4)],
                                 "doc_id bigint, text string")
    more = spark.createDataFrame([(9, f"  {line.upper()} ")], "doc_id bigint, text string")

    def state(index):
        return (sorted((r.doc_id, r.n_dropped) for r in index.apply(docs).collect()),
                sorted(map(str, index.counts.collect())))

    index = LineIndex(spark, shards=4)
    index.insert(docs)
    before = state(index)
    assert before[0] == [(0, 1), (1, 1), (2, 1), (3, 0)]
    index.insert(more)
    index.insert(more)
    assert state(index)[0] == [(0, 1), (1, 1), (2, 1), (3, 1)]
    index.delete(more.select("doc_id"))
    assert state(index) == before
    index.delete(docs.where("doc_id < 2").select("doc_id"))
    assert [n for _, n in state(index)[0]] == [0, 0, 0, 0]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(5, 5)]
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, **{i: 100 for i in range(101, 130)}}


def brute_components(docs, width, percent):
    sets = {}
    for key, text in docs:
        words = text.lower().split()
        sets[key] = {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    root = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


@pytest.mark.parametrize("limit", [3, 128])
def test_near_duplicates_against_brute_force(spark, limit):
    """A small node limit sends groups through branches, pivots and the settling of large nodes."""
    rng = random.Random(3)
    docs, texts = [], []
    for group in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(60)]
        for _ in range(8):
            if rng.random() < 0.8:
                words = list(words)
                words[rng.randrange(60)] = f"w{rng.randrange(3000)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in near_duplicates(
        spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=4, node_limit=limit, levels=3).collect()}
    assert got == brute_components(docs, 4, 80)


def test_a_large_group_of_near_copies_beside_others(spark):
    """A group that drifts away from its beginning, so that no pivot is linked with all of it."""
    rng = random.Random(8)
    words, texts = [f"w{rng.randrange(10 ** 6)}" for _ in range(80)], []
    for i in range(360):
        if i % 20 == 0:
            words = list(words)
            words[rng.randrange(80)] = f"w{rng.randrange(10 ** 6)}"
        own = list(words)
        own[rng.randrange(80)] = f"x{i}"
        texts.append(" ".join(own))
    texts += [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(150)]
    docs = list(enumerate(rng.sample(texts, len(texts))))
    got = {r.doc_id: r.component_id for r in near_duplicates(
        spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=4).collect()}
    want = brute_components(docs, 4, 80)
    assert got == want and len(set(want.values())) < 400


def test_candidates_that_a_refuted_sure_pair_hid_are_tried(spark, monkeypatch):
    """With sketches that call every candidate sure, thinning keeps a forest that full sets refute in part."""
    from tagloom.llm import near_dedup
    monkeypatch.setattr(near_dedup, "SURE", 0.0)
    monkeypatch.setattr(near_dedup, "SLACK", 12.0)
    rng = random.Random(4)
    texts = []
    for _ in range(10):
        base = [f"w{rng.randrange(5000)}" for _ in range(60)]
        for k in range(10):
            own = list(base)
            for _ in range(k % 5 + 1):
                own[rng.randrange(60)] = f"w{rng.randrange(5000)}"
            texts.append(" ".join(own))
    docs = list(enumerate(texts))
    made = near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=4).collect()
    assert {r.doc_id: r.component_id for r in made} == brute_components(docs, 4, 80)


def test_rows_of_an_id_with_several_texts_are_not_lost(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text), (2, text + " more"), (2, "a wholly different text that nobody else has"), (3, text), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {tuple(r) for r in drop_near_duplicates(docs).collect()}
    assert kept == {r for r in rows if r[0] != 3}
    copies = spark.createDataFrame([(1, "aaa bbb"), (5, "aaa  bbb"), (5, "unique text kept"), (None, "aaa bbb")], "doc_id bigint, text string")
    assert {tuple(r) for r in drop_copies(copies).collect()} == {(1, "aaa bbb"), (5, "unique text kept")}


def test_bpe_pieces_equal_the_library(spark):
    model = PieceModel.load(default_model_path())
    library = sentencepiece.SentencePieceProcessor(model_file=default_model_path())
    rng = random.Random(5)
    alphabet = "abcdefgh  \n.,!ABÉé漢0123=-_'\U0001f600ظ"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 80))) for _ in range(300)]
    texts += [" " * k for k in range(1, 45)] + [" " * k + "foo" for k in range(1, 45)] + ["=" * 70, "aaaaaaaaaaaaaaaa"]
    rows = encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model, block_bytes=2000)
    back = {r.doc_id: (r.ids, r.decoded) for r in decode(rows, model).collect()}
    wrong = [t for i, t in enumerate(texts) if back[i] != (library.encode(t), t)]
    assert wrong == []


def test_unigram_pieces_are_the_best_path(spark):
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -2.2, "ba": -3.1, "aba": -4.0, "▁ab": -4.9, "c": -5.0}
    rows = [("<unk>", 0, 0.0, 2)] + [(p, i + 1, s, 1) for i, (p, s) in enumerate(pieces.items())]
    model = PieceModel.of(UNIGRAM, rows)
    ids = {p: i for p, i, _, _ in rows}

    def best(text):
        if not text:
            return 0.0, []
        ways = [(s + best(text[len(p):])[0], [p, *best(text[len(p):])[1]]) for p, s in pieces.items() if text.startswith(p)]
        if not ways:
            return -15.0 + best(text[1:])[0], ["<unk>", *best(text[1:])[1]]
        return max(ways, key=lambda way: way[0])

    texts = ["abab", "a b", "cab ba", "bbb", "aXYb", "abacaba"]
    got = {r.doc_id: r.ids for r in encode(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()}
    scores = {i: s for (p, i, _, _), s in zip(rows, [-15.0, *pieces.values()])}
    for k, text in enumerate(texts):
        if "X" not in text:
            assert sum(scores[i] for i in got[k]) == pytest.approx(best("▁" + text.replace(" ", "▁"))[0])
    assert got[3] != [] and got[4].count(ids["<unk>"]) == 1


def test_reparameterised_questions_need_consistent_slots(spark):
    item = "A shop sold 12 apples and 30 pears to Anna and then 12 more apples were sold by the shop to Anna again"
    same = item.replace("12", "7").replace("30", "9").replace("Anna", "Maria")
    mixed = item.replace("12", "7", 1).replace("30", "9")
    docs = spark.createDataFrame(
        [(1, "before it all " + item + " after it"), (2, same), (3, mixed), (4, "nothing of the kind is here " * 9)],
        "doc_id bigint, text string")
    rows = contaminated(docs, spark.createDataFrame([(5, item)], "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id, r.exact) for r in rows} == {(1, 5, True), (2, 5, False)}


def literal_runs(doc, item):
    """Longest run of words that a document shares with an item, without case and punctuation, by brute force."""
    one, two = (["".join(c for c in w if c.isalnum()).lower() for w in text.split()] for text in (doc, item))
    best = 0
    for a in range(len(one)):
        for b in range(len(two)):
            n = 0
            while a + n < len(one) and b + n < len(two) and one[a + n] == two[b + n]:
                n += 1
            best = max(best, n)
    return best


def test_copies_rich_in_numbers_or_in_another_case_are_found(spark):
    items = [
        (1, "given 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 find 18 19 20"),
        (2, "On Monday Anna met Boris, Clara, David, Emil, Frida, Georg and Hanna in Paris near Lyon with Ida"),
        (3, "The quick brown fox jumps over the lazy dog while many other animals watch it from afar today"),
    ]
    around = "some words before it {} and some words after it"
    rng = random.Random(2)
    docs = [(10, around.format(items[0][1])), (20, around.format(items[1][1].lower())), (21, items[1][1].upper()),
            (30, around.format(items[2][1].replace(" ", " \n"))), (40, "given 4 3 5 7 6 8 10 9 11 13 12 14 16 15 17 find 20 19 18"),
            (50, None), (60, "")]
    for k in range(60):  # pieces of an item of any length, between other words
        words = items[k % 3][1].split()
        start = rng.randrange(len(words) - 9)
        piece = words[start:start + rng.randrange(9, 20)]
        docs.append((100 + k, "alpha " * 9 + " ".join(piece).lower() + " omega" * 9))
    schema = "{} bigint, text string"
    got = {(r.doc_id, r.item_id) for r in contaminated(
        spark.createDataFrame(docs, schema.format("doc_id")), spark.createDataFrame(items, schema.format("item_id"))).collect()}
    want = {(d, i) for d, text in docs for i, item in items if literal_runs(text or "", item) >= 13}
    assert want <= got and (10, 1) in want and (20, 2) in want
    assert not {d for d, _ in got} & {40, 50, 60}
    assert {d for d, _ in got} == {d for d, _ in want}


def test_licenses_are_found_with_their_spans(spark):
    text = "Some words.\nreleased under THE  MIT license. More.\nLicensed under the Apache Licence, Version 2.0\nrights reserved"
    rows = scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert [(r.license, r.coverage) for r in rows] == [("MIT", 1.0), ("Apache-2.0", pytest.approx(6 / 7))]
    assert text[rows[0].first_char:rows[0].end_char] == "released under THE  MIT license"


def test_token_spans_and_rules():
    tokenizer = Tokenizer.load()
    text = "Hello wörld \U0001f600!\nnew line"
    first, end = token_spans(text, tokenizer)
    assert first[0] == 0 and end[-1] == len(text) and (first[1:] <= end[:-1]).all()
    starts = np.array([0, 2, 6])
    spans = np.array([0, 1, 5]), np.array([1, 5, 7])
    assert attribute(*spans, starts, "start")[0].tolist() == [0, 0, 1]
    assert attribute(*spans, starts, "end")[0].tolist() == [0, 1, 2]
    assert attribute(*spans, starts, "majority")[0].tolist() == [0, 1, 1]


def test_pairs_of_features_are_learnt():
    rng = np.random.default_rng(1)
    values = rng.random((4000, 3))
    labels = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)).astype(float)
    model = fit(values[:3000], labels[:3000])
    assert ((model.scores(values[3000:]) >= 0.5) == labels[3000:]).mean() > 0.9


def test_packing_is_level():
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.pareto(2, (3000, 1)), axis=0)[::-1] * [[1, 1, 1]]
    vectors = sizes / sizes.sum(axis=0) * 8
    loads = np.zeros((8, 3))
    np.add.at(loads, place(vectors, 8), vectors)
    assert loads.max() < 1.02 and loads.min() > 0.98


def test_fingerprints_are_equal_where_the_windows_are(spark):
    dice = random.Random(8)
    rows = [(k, dice.choices("abc", k=n)) for k, n in enumerate((0, 1, 2, 3, 7, 8, 9, 60, 200))]
    held = spark.createDataFrame(rows, "k int, words array<string>")
    for length in range(1, 9):
        seen = {}
        for (_, words), got in zip(rows, held.orderBy("k").select(_fingerprints("words", length)).collect(), strict=True):
            windows = ["".join(words[i:i + length]) for i in range(len(words) - length + 1)]
            assert len(got[0]) == len(windows)
            for window, mark in zip(windows, got[0], strict=True):
                assert seen.setdefault(window, mark) == mark
        assert len(set(seen.values())) == len(seen)
