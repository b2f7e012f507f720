"""The filter audit beside a plain simulation of every order."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tagloom.llm.filter_audit import FILTERS, RemovalSteps, audit, audit_filters

SCHEMA = "doc_id bigint, text string, source string, part string, mask int, good int, n int"


def failed(rows):
    """The filters that each row fails, by the plain rules."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append({c for c, fails in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", re.search("[#$%&*|]", text)),
            ("E", any((t or "") == text and d is not None and doc is not None and d < doc for d, t, _ in rows))) if fails})
    return out


def simulated(rows, labels):
    """Apply every order to the list of documents, one filter after the other."""
    fails = failed(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    made, shares = {}, Counter()
    for part in {s or "" for _, _, s in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        for order in permutations(FILTERS):
            left, gone = list(own), []
            for step, letter in enumerate(order, 1):
                out = [k for k in left if letter in fails[k]]
                left = [k for k in left if letter not in fails[k]]
                made[part, "".join(order), step] = [
                    len(left), len(out), sum(letter in fails[k] for k in gone), sum(fails[k] == {letter} for k in own),
                    sum(rows[k][0] in good for k in out), sum(rows[k][0] in toxic for k in out)]
                shares[part, letter] += len(out)
                gone += out
    return sorted((part, order, step, *v, shares[part, order[step - 1]]) for (part, order, step), v in made.items())


def corpus():
    dice = random.Random(3)
    words = ["alpha", "beta", "GAMMA", "delta", "x#y", "Épsilon", "a b", "zeta|"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        size = dice.choice([0, 1, 30, 49, 50, 51, 80])
        text = " ".join(dice.choices(words[: dice.choice([4, 20, 68])], k=size))
        rows.append((i, text, dice.choice(["s0", "s1", None, "s0"])))
    rows += [(1000 + i, rows[i % 7][1], dice.choice(["s0", "s1", "s2"])) for i in range(60)]
    rows += [(5, None, "s1"), (6, "", None), (None, rows[0][1], "s0"), (None, None, None), (0, rows[0][1], "s0"),
             (0, rows[0][1], "s0"), (2000, "same id", "s1"), (2000, "same id", "s1"), (2001, "same id", "s1"), (7, "X " * 60000, "s2")]
    labels = [(i, dice.choice([0, 1, None]), dice.choice([0, 1])) for i in range(0, 1060, 2)]
    return rows, labels + [(4, 1, 0), (4, 0, None), (None, 1, 1)]


def test_audit_equals_simulation(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "p", 3, 1, 9) for r in rows], SCHEMA)
    known = spark.createDataFrame([(*x, "u") for x in labels], "doc_id bigint, quality int, toxic int, known string")
    got = sorted(map(tuple, audit_filters(docs, known).collect()))
    assert got == simulated(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_tables_without_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "p", 3, 1, 9) for r in rows[:20]], SCHEMA)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert audit_filters(docs.limit(0), known).collect() == []
    assert sorted(map(tuple, audit_filters(docs, known.limit(0)).collect())) == simulated(rows[:20], [])


def test_removal_steps_are_the_first_failed_filter():
    steps = RemovalSteps.of("XYZ")
    for order, row in zip(steps.orders, steps.step, strict=True):
        for mask, step in enumerate(row):
            failing = [k for k, c in enumerate(order) if mask >> "XYZ".index(c) & 1]
            assert step == (failing[0] if failing else 3)


def test_audit_takes_any_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 2, 1), ("p", 1, 3, 1, 0), ("p", 3, 4, 0, 2)],
                                   "part string, mask int, n bigint, good bigint, toxic bigint")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in audit(counts, "XY").collect()}
    assert got == {("XY", 1): (5, 7, 0, 3, 10), ("XY", 2): (5, 0, 4, 0, 4), ("YX", 1): (8, 4, 0, 0, 4), ("YX", 2): (5, 3, 4, 3, 10)}
    with pytest.raises(ValueError):
        audit(counts, "XX")
    assert audit(counts.where(F.lit(False))).collect() == []
