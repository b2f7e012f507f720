"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and odd columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagloom.llm import quality
from tagloom.llm.decontaminate import contaminated
from tagloom.llm.exact_dedup import drop_copies, exact_groups
from tagloom.llm.licenses import scan_licenses
from tagloom.llm.line_dedup import dedup_lines
from tagloom.llm.near_dedup import near_duplicates
from tagloom.llm.pieces import encode_and_check
from tagloom.llm.sharding import shard
from tagloom.llm.token_counts import Tokenizer, count_tokens
from tagloom.llm.url_filter import judge_urls

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, node int, rep string, "
          "digest string, block string, word string, doc string, shard string, group string, salt string")
LONG = "wordy text of some length. " * 4000
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six"), (4, "one two three four five six"),
        (None, "one two three four five six"), (5, LONG), (6, "a\n\nb"), (None, None), (7, "été 漢字 \U0001f600 x▁y")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "en", None, 3, 1, *["c"] * 8) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 1, 0), (5, 1, None), (None, 1, 0), (6, None, 0)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(0, None), (1, ""), (2, "three four five")], "item_id bigint, text string")


def per_row(labels, benchmark):
    return {
        "lines": dedup_lines, "exact": exact_groups, "near": near_duplicates, "shard": shard,
        "quality": lambda d: quality.score(d, quality.train(d, labels)),
        "pieces": lambda d: encode_and_check(d.sparkSession, d),
    }


@pytest.mark.parametrize("name", ["lines", "exact", "near", "shard", "quality", "pieces"])
def test_one_row_for_each_row(odd, labels, benchmark, name):
    operator = per_row(labels, benchmark)[name]
    rows = operator(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert operator(odd.limit(0)).collect() == []


def test_exact_groups_of_odd_rows(odd):
    got = {(r.doc_id, r.group_size, r.keep_id, r.kept) for r in exact_groups(odd).collect()}
    assert (4, 3, 4, True) in got and (None, 3, 4, False) in got
    assert (1, 3, 1, True) in got and (2, 3, 1, False) in got
    assert drop_copies(odd).where("doc_id IS NULL").count() == 0


def test_exact_groups_compare_content_when_digests_meet(odd):
    weak = exact_groups(odd, digest=lambda text: F.lit(b"same")).drop("digest").collect()
    assert sorted(map(str, weak)) == sorted(map(str, exact_groups(odd).drop("digest").collect()))


def test_near_duplicates_of_odd_rows(odd):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd, shingle=4).collect()}
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (3, 0, 3, True) in got
    assert (4, 3, None, False) in got and (None, 3, None, True) in got


def test_shards_of_odd_rows(odd):
    rows = shard(odd, shards=3).collect()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {8}


def test_pieces_come_back(odd):
    rows = {r.doc_id: r for r in encode_and_check(odd.sparkSession, odd).collect()}
    assert rows[5].round_trip and rows[6].round_trip and rows[1].ids == []
    assert not rows[7].round_trip  # a space mark in a text is read as a space


def test_searches_find_nothing_in_odd_rows(odd, benchmark):
    assert scan_licenses(odd).collect() == []
    assert scan_licenses(odd.limit(0)).collect() == []
    found = contaminated(odd, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(4, 2), (None, 2)}
    assert contaminated(odd.limit(0), benchmark).collect() == []
    assert contaminated(odd, benchmark.limit(0)).collect() == []


def test_token_counts_of_odd_rows(odd):
    rows = count_tokens(odd, Tokenizer.load()).collect()
    assert {(r.section, r.n_tokens) for r in rows if r.doc_id in (1, 2)} == {(0, 0)}
    assert len([r for r in rows if r.doc_id == 6]) == 3
    assert count_tokens(odd.limit(0), Tokenizer.load()).collect() == []


def test_urls_of_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "no scheme", "x"), (4, "HTTP://A.Net/x?y#z", "x"),
         (4, "HTTP://A.Net/x?y#z", "x"), (None, "http://b.org/fr/1", "x"), (5, "http://net", "x")],
        "page_id bigint, url string, host string")
    rules = {"net/": "block", "org/fr/": "allow"}
    rows = judge_urls(pages, rules).collect()
    assert len(rows) == 7
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert got[1] == got[2] == got[3] == ("", "", None)
    assert got[4] == ("a.net", "/x", "net/") and got[5] == ("net", "", None)
    assert all(r.verdict in ("allow", "block") for r in rows)
    assert judge_urls(pages.limit(0), rules).collect() == []


def test_stages_on_odd_rows(spark, odd, labels, benchmark, tmp_path):
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs, folder).count() <= len(ROWS)
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(ROWS)
