"""The toxicity classifier: features on written texts, held-out accuracy, calibration, odd rows."""

import random

import pytest

from tagloom.llm import toxicity
from tagloom.llm.toxicity import FEATURES, LEXICON, features_of

FOLDER = "/root/testdata/sf0.1"


def named(text):
    return dict(zip(FEATURES, features_of(text), strict=True))


def test_abusive_words_are_found_plain_and_disguised():
    calm = named("A calm note on the weather, which was mild.")
    assert calm["log_hits"] == calm["disguised"] == calm["near_second"] == 0
    plain = named("Well, you idiot! That was stupid.")
    assert plain["density"] == pytest.approx(2 / 6) and plain["near_second"] == 0.5 and plain["disguised"] == 0
    for word in ("1d10t", "st*upid", "i.d.i.o.t", "stuuupid", "$tupid", "m0r0n"):
        seen = named(f"this {word} said so again")
        assert seen["disguised"] > 0 and seen["obfuscated"] > 0, word
    assert named("what a s t u p i d thing")["disguised"] > 0
    assert named("the plan of 2024 has 3 parts, x-ray and all")["disguised"] == 0


def test_far_from_second_person_is_not_near():
    assert named("idiot " + "word " * 10 + "you")["near_second"] == 0
    assert named("you " + "word " * 2 + "idiot")["near_second"] == 1


def test_densest_stretch_is_counted_in_long_texts():
    assert named("word " * 5000 + "idiot moron " * 5 + "word " * 5000)["densest"] == 10
    assert named(("idiot " + "word " * 99) * 10)["densest"] == 1


def test_features_are_numbers_for_any_text():
    dice = random.Random(1)
    for _ in range(300):
        text = "".join(dice.choices("aA !?.\n\t1@$é漢\U0001f600u", k=dice.randrange(60)))
        values = features_of(text)
        assert len(values) == len(FEATURES) and all(v == v and v >= 0 for v in values)


def test_lexicon_is_of_moderate_size():
    assert 50 < len(LEXICON) < 200


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_documents(tables):
    docs, labels = tables
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert len(rows) > 1000
    toxic = [r.score for r in rows if r.toxic == 1]
    civil = [r.score for r in rows if r.toxic == 0]
    # Some of the labels are wrong by design; the rest must be told apart.
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.93
    assert sum(s >= 0.7 for s in civil) / len(civil) < 0.005
    assert sum(s >= 0.7 for s in toxic) / len(toxic) > 0.5
    # Calibrated: the scores add up to about as many toxic documents as there are.
    assert sum(r.score for r in rows) == pytest.approx(len(toxic), rel=0.25)
    texts = {r.doc_id: r.text for r in docs.collect()}
    abusive = [r for r in rows if r.toxic == 1 and named(texts[r.doc_id])["log_hits"] > 1]
    assert abusive and all(r.predicted == 1 for r in abusive)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, tables):
    docs, labels = (t.where("doc_id < 1500") for t in tables)
    held = toxicity.held_out("doc_id")
    wrong = labels.where(~held).unionByName(labels.where(held).selectExpr("doc_id", "quality", "1 - toxic AS toxic"))
    first = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    second = toxicity.score(docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source"), toxicity.train(docs, wrong)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "you idiot"), (4, "you idiot"), (4, "another text"), (None, "moron"),
            (5, "word " * 60000), (6, "z" * 400000), (7, "! " * 9)]
    docs = spark.createDataFrame([(*r, 0.5, [1.0], 3, "d") for r in rows],
                                 "doc_id bigint, text string, score double, values array<double>, label int, features string")
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 1), (5, 0, 0), (6, 1, None), (None, 1, 1), (99, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.train(docs, known)
        got = toxicity.score(docs, model).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
        assert [r.held_out for r in got if r.doc_id is None] == [False]
        assert toxicity.score(docs.limit(0), model).collect() == []
        assert toxicity.keep_civil(docs, model).columns == docs.columns
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).collect() == []


def test_toxic_rows_go_and_keep_their_columns(spark, tables):
    docs, labels = (t.where("doc_id < 3000") for t in tables)
    model = toxicity.train(docs, labels)
    flagged = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    kept = toxicity.keep_civil(docs, model)
    assert kept.schema == docs.schema and flagged
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - flagged


def test_abuse_of_no_word_list_is_learnt_from_labels(spark):
    dice = random.Random(5)

    def word():
        return "".join(dice.choices(("ba", "lo", "ri", "ten", "mu", "sak", "ol", "fe"), k=dice.randrange(2, 5)))

    rows = []
    for doc in range(1500):
        toxic = int(doc % 5 == 0)
        words = [word() for _ in range(60)]
        for _ in range(3 * toxic):  # one stem, many endings
            words[dice.randrange(60)] = "zorga" + word() + dice.choice((",", ".", ""))
        rows.append((doc, " ".join(words), toxic))
    tables = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(tables.select("doc_id", "text"), tables.select("doc_id", "toxic"))
    assert "zorg" in model.stems and "balo" not in model.stems
    scored = {r.doc_id: r for r in toxicity.score(tables.select("doc_id", "text"), model).collect()}
    unseen = [(scored[doc], toxic) for doc, _, toxic in rows if scored[doc].held_out]
    assert len(unseen) > 300 and sum(r.predicted == toxic for r, toxic in unseen) / len(unseen) > 0.98
    kept = {r.doc_id for r in toxicity.keep_civil(tables, model).collect()}
    assert kept == {doc for doc, r in scored.items() if r.predicted == 0}


def test_stems_are_those_of_enough_toxic_texts(spark):
    texts = [("Zorgana, 12 ab", 1.0)] * 5 + [("zorgelo rare", 1.0)] * 4 + [("mildly said", 0.0)] * 40 + [("", 0.0), ("said zorx", 0.0)]
    stems = toxicity.toxic_stems(spark.createDataFrame(texts, "text string, label double").repartition(3))
    assert set(stems) == {"zorg", "zorga", "zorgan", "zorgana"} and stems["zorg"] > stems["zorga"]
    assert toxicity.toxic_stems(spark.createDataFrame(texts[9:], "text string, label double")) == {}
    assert toxicity.toxic_stems(spark.createDataFrame([], "text string, label double")) == {}
