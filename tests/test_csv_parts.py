"""Large CSV files cut into splits give the rows of Spark's own multi-line reader."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.sources.csv import read_csv
from tagloom.sources.csv_parts import _lines, parsed_csv
from tests.test_scale import settings

SCHEMA = "Id bigint, Score int, Text string, At timestamp"
BAD = "_bad"


def written(dice, n, eol="\n", broken=()):
    """A file of n records with quotes, commas and line breaks in quoted texts."""
    bits = ["word", ",", '""', "\n", "\r\n", " ", "é漢", '"",""', "x\n\ny", "<p a=\"\"1\"\">"]
    lines = ["Id,Score,Text,At"]
    for i in range(n):
        text = "".join(dice.choices(bits, k=dice.randrange(12 if i % 40 else 300)))
        quoted = dice.choice(['"%s"' % text, "plain", "", '""'])
        lines.append(f'{i},"{i % 7}",{quoted},2020-01-01T00:00:{i % 60:02d}Z')
        if dice.random() < 0.05:
            lines.append("")
    for at, line in broken:
        lines.insert(at, line)
    return (eol.join(lines) + dice.choice(["", eol])).encode()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(spark, paths, split_from=1, bytes_in_split=700):
    with settings(spark, spark__sql__files__maxPartitionBytes=bytes_in_split, spark__sql__files__openCostInBytes=0):
        with parsed_csv(spark, paths, SCHEMA, BAD, split_from) as parsed:
            got = rows(parsed)
        splits = _lines(spark, paths).select("start").distinct().count()
    return got, rows(read_csv(spark, paths, SCHEMA, corrupt_column=BAD)), splits


@pytest.mark.parametrize("seed", range(4))
def test_splits_give_the_rows_of_the_whole(spark, tmp_path, seed):
    dice = random.Random(seed)
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(written(dice, 150, "\r\n" if seed % 2 else "\n"))
    got, want, splits = both(spark, [str(tmp_path)], bytes_in_split=dice.choice([150, 400, 1500]))
    assert splits > 4 and len(want) == 300 and got == want


def test_one_record_may_cover_many_splits(spark, tmp_path):
    body = "line of text\n" * 900
    (tmp_path / "a.csv").write_text(f'Id,Score,Text,At\n1,1,"{body}",\n2,2,"x",\n3,3,"{body}",\n')
    got, want, splits = both(spark, [str(tmp_path)], bytes_in_split=1000)
    assert splits > 20 and got == want and [r[0] for r in got] == [1, 2, 3]


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_misfits_are_kept_with_their_text(spark, tmp_path, eol):
    broken = [(20, 'x9,1,"a\nb",'), (40, "5,1,t,yesterday"), (60, "6,1"), (80, "7,1,t,,extra,fields"), (90, "   ")]
    (tmp_path / "a.csv").write_bytes(written(random.Random(9), 120, eol, broken))
    got, want, _ = both(spark, [str(tmp_path)])
    assert got == want and sum(r[-1] is not None for r in got) >= 4


@pytest.mark.parametrize("line", ['9,1,"a"b",', '9,1,a "quoted word,', '9,1, "blank first",', '9,"1,open to the end,'])
def test_files_with_odd_quotes_are_read_as_a_whole(spark, tmp_path, line):
    (tmp_path / "a.csv").write_bytes(written(random.Random(2), 60, broken=[(30, line)]))
    (tmp_path / "b.csv").write_bytes(written(random.Random(3), 60))
    got, want, _ = both(spark, [str(tmp_path)])
    assert got == want


def test_small_and_compressed_files_go_together_with_large_ones(spark, tmp_path):
    import gzip
    (tmp_path / "a.csv").write_bytes(written(random.Random(4), 200))
    (tmp_path / "b.csv").write_bytes(written(random.Random(5), 3))
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(written(random.Random(6), 200)))
    (tmp_path / "d.csv").write_bytes(b"Id,Score,Text,At\n")
    (tmp_path / "e.csv").write_bytes(b"")
    (tmp_path / "f.csv").write_bytes(b"Id,Score,Text,At\r1,2,x,\r" * 300)
    got, want, _ = both(spark, [str(tmp_path)], split_from=2000)
    assert len(got) > 403 and got == want


def test_large_file_is_parsed_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(written(random.Random(7), 2000))
    with settings(spark, spark__sql__files__maxPartitionBytes=20000, spark__sql__files__openCostInBytes=0):
        with parsed_csv(spark, [str(tmp_path)], SCHEMA, BAD, 1) as parsed:
            tasks = parsed.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4
