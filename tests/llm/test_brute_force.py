"""Whole results of the URL filter, the quality score and the token counts against plain computations."""

import random
import re
import zlib
from collections import defaultdict

from tagloom.llm import quality
from tagloom.llm.queries import URL_RULES, op1_url_filter, op4_quality, op10_token_counts
from tagloom.llm.token_counts import Tokenizer, count_tokens
from tagloom.llm.url_filter import judge_urls

FOLDER = "/root/testdata/sf0.01"


def parsed(url):
    """Host and path by plain string work."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return host.translate(lower), rest[:end]


def longest_rule(host, path):
    fits = []
    for rule in URL_RULES:
        name, _, start = rule.partition("/")
        if ("." + host).endswith("." + name) and path.startswith("/" + start):
            fits.append(rule)
    return max(fits, key=len, default=None)


ODD = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Net/en/x", "http://a.example.net/EN/", "http://xexample.net/en/", "net/",
       "http://net/", "http://net", "http://example.com/de/a?b#c", "http://example.com/de", "http://org/fr/x://y", "http://İ.ORG/fr/",
       "x://y://net/", "http://example.net?/en/", "http://example.net#/en/", "http://a.net/\n/x", "://net/", "http://net/" + "a" * 200_000]


def test_hosts_paths_and_rules_equal_plain_string_work(spark):
    schema = "page_id bigint, url string"
    rows = list(enumerate(ODD)) + [(0, ODD[4]), (None, ODD[8])]
    for table in (spark.createDataFrame(rows, schema), spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")):
        want = sorted((str(r.page_id), *parsed(r.url), str(longest_rule(*parsed(r.url)))) for r in table.collect())
        made = judge_urls(table, URL_RULES).collect()
        assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in made) == want
        assert all(r.verdict == URL_RULES[r.rule] for r in made if r.rule)
        assert {r.verdict for r in made} <= {"block", "allow"}


def test_verdicts_learnt_from_labels_hold_on_other_urls(spark):
    rng = random.Random(3)

    def url(bad):
        word = "".join(rng.choices("abcdefgh", k=8))
        host = rng.choice(["shop", "news", "blog"]) + rng.choice([".com", ".org"])
        if bad:
            return f"http://{host}/{word}?" + "&".join(f"{c}={rng.randrange(10 ** 9)}" for c in word)
        return f"http://{host}/{word}/{word}.html"

    rows = [(i, url(i % 2 == 0), i % 2 == 0) for i in range(1200)]
    labelled = spark.createDataFrame([(u, int(b)) for _, u, b in rows[:800]] + [(None, None)], "url string, label int")
    pages = spark.createDataFrame([r[:2] for r in rows[800:]], "page_id bigint, url string")
    verdict = {r.page_id: r.verdict for r in judge_urls(pages, {}, labelled).collect()}
    right = sum(verdict[i] == ("block" if bad else "allow") for i, _, bad in rows[800:])
    assert right >= 0.97 * 400


def test_url_query_judges_every_page(spark):
    assert op1_url_filter(spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/pages.parquet").count()


def test_held_out_quality_is_better_than_the_majority(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r.quality is not None}
    made = op4_quality(spark, FOLDER).collect()
    assert len(made) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in made)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in made)
    judged = [(r.predicted, labels[r.doc_id]) for r in made if r.held_out and r.doc_id in labels]
    share = sum(label for _, label in judged) / len(judged)
    assert len(judged) > 80 and sum(p == label for p, label in judged) / len(judged) > max(share, 1 - share) + 0.05


def test_quality_is_learnt_from_rows_that_are_not_held_out_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    one, two = (sorted(quality.score(docs, quality.train(docs, x)).collect()) for x in (labels, turned))
    assert one == two


def test_tokens_of_each_line_equal_a_plain_attribution(spark):
    """Each token goes to the line of its first character, found by decoding token by token."""
    encoding = Tokenizer.load().build()[0]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = defaultdict(dict)
    for r in op10_token_counts(spark, FOLDER).collect():
        got[r.doc_id][r.first_char] = (r.end_char, r.n_tokens)
    for doc_id, text in map(tuple, docs.collect()):
        text = text or ""
        starts = [0] + [m.end() for m in re.finditer("\n", text) if m.end() < len(text)]
        assert sorted(got[doc_id]) == starts
        counts, at = defaultdict(int), 0
        character = [i for i, c in enumerate(text) for _ in c.encode()]
        for token in encoding.encode_ordinary(text):
            counts[text.rfind("\n", 0, character[at]) + 1] += 1
            at += len(encoding.decode_single_token_bytes(token))
        assert {s: n for s, (_, n) in got[doc_id].items() if n} == dict(counts)


def test_long_unbroken_texts_are_counted_whole(spark):
    tokenizer = Tokenizer.load()
    texts = ["x" * 50_000, "漢" * 20_000 + "\n" + "y" * 10, "\n" * 3000]
    rows = count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), tokenizer)
    sums = {r.doc_id: r.n for r in rows.groupBy("doc_id").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert sums == {i: len(tokenizer.build()[0].encode_ordinary(t)) for i, t in enumerate(texts)}
