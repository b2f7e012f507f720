"""CSV, lake tables and the two jobs."""

from datetime import date, datetime
from math import inf

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.__main__ import main
from tagloom.plans.analysis import RESULTS, read_result
from tagloom.sources.catalog import merge_by_key
from tagloom.plans.etl import run_etl
from tagloom.sources.csv import flatten_arrays, read_csv, write_csv
from tagloom.sources.lake import Lake
from tagloom.staging import scratch_dir, staged

TABLE = "Id long, Value string, PartitionDate string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    texts = [('say "hi", ok', 1.5), ("two\nlines", inf), (" padded ", 0.0), (None, None), ("back\\slash\"", -1.0)]
    df = spark.createDataFrame(texts, "t string, d double")
    write_csv(df, f"{tmp_path}/out")
    assert rows(read_csv(spark, f"{tmp_path}/out", "t string, d double")) == rows(df)


def test_empty_fields_are_null_quoted_or_not(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,Tags,Text\n"1","",\n')
    assert rows(read_csv(spark, f"{tmp_path}/a.csv", "Id long, Tags string, Text string")) == [(1, None, None)]


def test_csv_keeps_microseconds(spark, tmp_path):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 01:02:03.456789' AS t")
    write_csv(df, f"{tmp_path}/out")
    assert rows(read_csv(spark, f"{tmp_path}/out", "t timestamp")) == rows(df)


def test_csv_write_fails_on_an_existing_path(spark, tmp_path):
    df = spark.range(1)
    write_csv(df, f"{tmp_path}/out")
    with pytest.raises(Exception, match="already exists"):
        write_csv(df, f"{tmp_path}/out")
    write_csv(df, f"{tmp_path}/out", mode="overwrite")


def test_csv_reads_several_files_and_reports_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,Text\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("Id,Text\nnot a number,z\n2,w\n")
    both = [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]
    assert rows(read_csv(spark, both, "Id long, Text string")) == sorted(
        [(1, "x\ny"), (None, "z"), (2, "w")], key=repr)
    marked = read_csv(spark, both, "Id long, Text string", corrupt_column="bad")
    assert [r.bad for r in marked.where("bad IS NOT NULL").collect()] == ["not a number,z"]
    assert rows(read_csv(spark, both, "Id long, Text string", mode="DROPMALFORMED")) == [(1, "x\ny"), (2, "w")]


def test_flatten_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "i int, items array<string>")
    assert rows(flatten_arrays(df)) == [(1, "a-b")]


def test_staged_table_is_removed(spark):
    with staged(spark.range(3), "test") as table:
        path = table.inputFiles()[0]
        assert table.count() == 3 and scratch_dir(spark) in path
    with pytest.raises(Exception, match="(?i)not exist"):
        spark.read.parquet(path).count()


def test_overwrite_and_read(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert not lake.exists("t")
    with pytest.raises(ValueError, match="no table"):
        lake.read("t")
    lake.overwrite(spark.createDataFrame([(1, "a", "01_01_2024"), (2, "b", None)], TABLE), "t")
    assert rows(lake.read("t")) == [(1, "a", "01_01_2024"), (2, "b", None)]
    lake.overwrite(spark.createDataFrame([(3, "c", "02_01_2024")], TABLE), "t")
    assert rows(lake.read("t")) == [(3, "c", "02_01_2024")]
    assert lake.read("t").columns == ["Id", "Value", "PartitionDate"]


def test_tables_may_be_empty(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    nothing = spark.createDataFrame([], TABLE)
    lake.overwrite(nothing, "t")
    assert rows(lake.read("t")) == []
    lake.upsert(nothing, "t")
    lake.upsert(spark.createDataFrame([(1, "a", "x")], TABLE), "t")
    lake.upsert(nothing, "t")
    assert rows(lake.read("t")) == [(1, "a", "x")]


DAYS = [(i, f"v{i}", f"{1 + i % 28:02d}_{1 + i // 28 % 12:02d}_2024") for i in range(600)]


def pruned_by(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.split("PartitionFilters: [")[1].split("]")[0], plan


def test_days_are_dates_that_prune(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame([*DAYS, (9000, "undated", None), (9001, "no day", "x")], TABLE), "t")
    first, last = date(2024, 1, 27), date(2024, 2, 3)
    in_range = [r for r in DAYS if first <= datetime.strptime(r[2], "%d_%m_%Y").date() <= last]
    assert rows(lake.read("t", first, last)) == sorted(in_range, key=repr) and len(in_range) > 8
    assert len({f.split("tagloom_day=")[1].split("/")[0] for f in lake.read("t", first, last).inputFiles()}) == 5
    assert lake.read("t").count() == len(DAYS) + 2 and lake.read("t").columns == ["Id", "Value", "PartitionDate"]
    ranged = lake.read_with_day("t").where(F.col("tagloom_day").between(F.lit(first), F.lit(last)))
    filters, _ = pruned_by(ranged)
    assert "tagloom_day" in filters and ranged.count() == len(in_range)
    # A join to a small table of days prunes too, once its days are known.
    holidays = spark.createDataFrame([(date(2024, 1, 1), "off"), (date(2024, 5, 1), "off"), (date(2024, 7, 7), "work")],
                                     "day date, kind string").where("kind = 'off'")
    joined = lake.read_with_day("t").join(F.broadcast(holidays), F.col("tagloom_day") == F.col("day"))
    filters, plan = pruned_by(joined)
    assert "dynamicpruning" in filters
    assert rows(joined.select("Id")) == sorted([(r[0],) for r in DAYS if r[2][:5] in ("01_01", "01_05")], key=repr)


def test_twenty_upserts_leave_one_folder_per_day_and_no_orphan(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    day = ["01_01_2024", "02_01_2024", "03_01_2024"]
    expected = {i: (i, "old", day[i % 3]) for i in range(60)}
    lake.overwrite(spark.createDataFrame(list(expected.values()), TABLE), "t")
    for n in range(20):
        new = {i: (i, f"n{n}", day[(i + n) % 3]) for i in (n, 2 * n, 100 + n)}
        lake.upsert(spark.createDataFrame(list(new.values()), TABLE), "t")
        expected |= new
    assert rows(lake.read("t")) == sorted(expected.values(), key=repr)
    manifest = lake._manifest("t")
    assert len(manifest.partitions) == 3
    files = {"/".join(f.split("/")[-3:-1]) for f in lake.read("t").inputFiles()}
    assert files == {f"tagloom_load={n}/{p}" for p, n in manifest.partitions.items()}
    before = lake._read_manifest("t", manifest.version - 1)
    named = {f"tagloom_load={n}/{p}" for m in (manifest, before) for p, n in m.partitions.items()}
    assert {f"{p.parent.name}/{p.name}" for p in tmp_path.glob("t/data/*/tagloom_day=*")} == named
    assert sorted(lake._versions("t")) == [20, 21]


def test_few_keys_are_found_without_reading_all_row_groups(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    # Ids are scattered over all days, so no day's range excludes any of them.
    table = spark.range(400_000).select(
        F.pmod(F.col("id") * 2654435761, F.lit(1 << 32)).alias("Id"), F.lit("v").alias("Value"),
        F.date_format(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 200).cast("int")), "dd_MM_yyyy").alias("PartitionDate"))
    lake.overwrite(table, "t")
    sample = [r[0] for r in table.where("id % 100000 = 7").select("Id").collect()]
    stored = lake._files("t", lake._manifest("t"), lake._manifest("t").partitions)
    keys = spark.createDataFrame([(k,) for k in [*sample, -5]], "Id long")
    found = lake._matches(stored, "Id", keys)
    assert sorted(r.Id for r in found.collect()) == sorted(sample)
    assert scanned_rows(found) < 0.05 * 400_000
    file = next(f.removeprefix("file://").removeprefix("file:") for f in stored.inputFiles())
    import pyarrow.parquet as pq
    ids = pq.read_table(file, columns=["Id"], partitioning=None)["Id"].to_pylist()
    assert ids == sorted(ids)


def scanned_rows(df):
    """Rows that the scan of an executed frame handed on, after Parquet's filters."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.apply(0)
    while plan.getClass().getSimpleName() != "FileSourceScanExec":
        inner = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.getClass().getSimpleName() else plan.plan()
        plan = inner.collectLeaves().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_overwrite_from_itself(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], TABLE), "t")
    lake.overwrite(lake.read("t").where("Id = 1"), "t")
    assert rows(lake.read("t")) == [(1, "a", "x")]


def test_upsert(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    stored = [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"), (4, "d", "d3"), (None, "n", "d1")]
    lake.overwrite(spark.createDataFrame(stored, TABLE), "t")
    # One row changes in place, one moves to another day, one is new; a NULL key never matches.
    new = spark.createDataFrame([(1, "A", "d1"), (3, "C", "d3"), (5, "e", "d 4/x"), (None, "m", "d2")], TABLE)
    lake.upsert(new, "t")
    expected = sorted([(1, "A", "d1"), (2, "b", "d1"), (3, "C", "d3"), (4, "d", "d3"), (5, "e", "d 4/x"),
                       (None, "n", "d1"), (None, "m", "d2")], key=repr)
    assert rows(lake.read("t")) == expected
    lake.upsert(new.where("Id IS NOT NULL"), "t")
    assert rows(lake.read("t")) == expected
    lake.upsert(spark.createDataFrame([(5, "E", "d 4/x")], TABLE), "t")
    assert (5, "E", "d 4/x") in rows(lake.read("t")) and lake.read("t").count() == 7


def test_upsert_rewrites_only_days_it_changes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    day = [f"0{k}_01_2024" for k in range(1, 5)]
    lake.overwrite(spark.createDataFrame([(k, "a", day[k]) for k in range(4)], TABLE), "t")
    lake.upsert(spark.createDataFrame([(0, "A", day[0]), (9, "z", day[1])], TABLE), "t")
    assert lake._manifest("t").partitions == {
        "tagloom_day=2024-01-01": 2, "tagloom_day=2024-01-02": 2, "tagloom_day=2024-01-03": 1, "tagloom_day=2024-01-04": 1}
    # A row that moves changes the day it leaves, and the day it comes to.
    lake.upsert(spark.createDataFrame([(2, "moved", day[3])], TABLE), "t")
    assert lake._manifest("t").partitions == {
        "tagloom_day=2024-01-01": 2, "tagloom_day=2024-01-02": 2, "tagloom_day=2024-01-04": 3}
    assert rows(lake.read("t")) == [(0, "A", day[0]), (1, "a", day[1]), (2, "moved", day[3]), (3, "a", day[3]), (9, "z", day[1])]


def test_many_keys_are_found_by_their_range(spark, tmp_path, monkeypatch):
    from tagloom.sources import lake as module
    monkeypatch.setattr(module, "SEARCHED_KEYS", 2)
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame(DAYS, TABLE), "t")
    new = [(i, "new", d) for i, _, d in DAYS[100:140:3]] + [(7777, "new", "01_01_2024")]
    lake.upsert(spark.createDataFrame(new, TABLE), "t")
    assert rows(lake.read("t")) == sorted({r[0]: r for r in DAYS + new}.values(), key=repr)


def test_upsert_creates_a_missing_table_like_overwrite(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], TABLE)
    lake.upsert_all({"u": df})
    lake.overwrite_all({"o": df})
    assert rows(lake.read("u")) == rows(lake.read("o"))


def test_upsert_rejects_a_matched_key_given_twice(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame([(1, "a", "x")], TABLE), "t")
    twice = spark.createDataFrame([(1, "b", "x"), (1, "c", "x")], TABLE)
    with pytest.raises(ValueError, match="several new rows"):
        lake.upsert(twice, "t")
    assert rows(lake.read("t")) == [(1, "a", "x")]
    lake.upsert(twice.withColumn("Id", F.lit(7).cast("long")), "t")
    assert lake.read("t").count() == 3


def test_upsert_rejects_other_columns(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame([(1, "a", "x")], TABLE), "t")
    with pytest.raises(ValueError, match="Value"):
        lake.upsert(spark.createDataFrame([(1, "x")], "Id long, PartitionDate string"), "t")


def test_unfinished_write_is_invisible(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame([(1, "a", "x")], TABLE), "t")
    lake._write_load(spark.createDataFrame([(2, "b", "x")], TABLE), "t", 2, "PartitionDate")
    assert rows(lake.read("t")) == [(1, "a", "x")]
    lake.upsert(spark.createDataFrame([(3, "c", "x")], TABLE), "t")
    assert rows(lake.read("t")) == [(1, "a", "x"), (3, "c", "x")]


def test_preview_prints(spark, tmp_path, capsys):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.createDataFrame([(1, "a" * 40, "x")], TABLE), "t")
    lake.preview("t")
    assert "a" * 40 in capsys.readouterr().out


def test_jobs_end_to_end(spark, forum, tmp_path, capsys):
    for name in ("posts", "comments", "synonyms"):
        write_csv(getattr(forum, name), f"{tmp_path}/{name}")
    lake = Lake(spark, f"{tmp_path}/lake")
    load = ["load", "--lake", f"{tmp_path}/lake", "--posts", f"{tmp_path}/posts",
            "--comments", f"{tmp_path}/comments", "--synonyms", f"{tmp_path}/synonyms"]
    main(load)
    loaded = {name: rows(lake.read(name)) for name in
              (schemas.QUESTIONS_TABLE, schemas.ANSWERS_TABLE, schemas.COMMENTS_TABLE)}
    assert [len(loaded[n]) for n in ("questions", "answers", "comments")] == [3, 3, 4]
    # The same exports again change nothing.
    main([*load, "--incremental"])
    assert loaded == {name: rows(lake.read(name)) for name in loaded}
    main(["preview", "--lake", f"{tmp_path}/lake", "--rows", "5"])
    assert "[python, spark]" in capsys.readouterr().out
    main(["analyse", "--lake", f"{tmp_path}/lake", "--output", f"{tmp_path}/results"])
    results = {name: read_result(spark, f"{tmp_path}/results", name).collect() for name in RESULTS}
    assert [tuple(r) for r in sorted(results["general_info"])] == [
        ("Answers", 3), ("Comments", 4), ("Questions", 3)]
    assert {r.Tag: r.QuestionsCount for r in results["final_df"]} == {"python": 3, "spark": 1, "sql": 1}
    assert len(results["top_most_frequent_tags"]) == 5 and len(results["association_rules_df"]) == 4
    assert len(results["tags_frequency"]) == 4


def test_merge_is_left_to_the_table_format(spark):
    rows_in = spark.createDataFrame([(1, "a")], "Id long, Value string")
    spark.sql("CREATE TABLE IF NOT EXISTS plain_merge_target (Id BIGINT, Value STRING) USING parquet")
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE"):
            merge_by_key(rows_in, "plain_merge_target")
    finally:
        spark.sql("DROP TABLE plain_merge_target")


def small_table(spark, rows, value="int"):
    return spark.createDataFrame(rows, f"Id int, Value {value}, PartitionDate string")


def test_upsert_on_a_stale_version_fails_and_loses_nothing(spark, tmp_path):
    lake, other = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path))
    lake.overwrite(small_table(spark, [(1, 1, "a"), (2, 2, "a")]), "t")
    write = lake._write_load

    def slow_write(*args):
        other.upsert(small_table(spark, [(2, 99, "a"), (5, 5, "b")]), "t")
        lake._write_load = write
        return write(*args)

    lake._write_load = slow_write
    with pytest.raises(RuntimeError, match="someone else"):
        lake.upsert(small_table(spark, [(1, 10, "a")]), "t")
    assert sorted(tuple(r)[:2] for r in lake.read("t").collect()) == [(1, 1), (2, 99), (5, 5)]
    lake.upsert(small_table(spark, [(1, 10, "a")]), "t")
    assert sorted(tuple(r)[:2] for r in lake.read("t").collect()) == [(1, 10), (2, 99), (5, 5)]


@pytest.mark.parametrize("kind,good,bad", [("bigint", 7, 2 ** 40), ("string", "7", "seven"), ("double", 7.0, 7.5)])
def test_upsert_stores_the_tables_types(spark, tmp_path, kind, good, bad):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(small_table(spark, [(1, 1, "a")]), "t")
    lake.upsert(small_table(spark, [(1, good, "a"), (2, None, "a")], kind), "t")
    with pytest.raises(Exception, match="cannot be stored"):
        lake.upsert(small_table(spark, [(1, bad, "a")], kind), "t")
    assert sorted((r.Id, r.Value) for r in lake.read("t").collect()) == [(1, 7), (2, None)]


def test_load_neither_loses_nor_merges_records_that_do_not_fit(spark, forum, tmp_path):
    for name in ("posts", "comments", "synonyms"):
        write_csv(getattr(forum, name), f"{tmp_path}/{name}")
    head = ",".join(forum.comments.columns)
    (tmp_path / "bad.csv").write_text(f"{head}\nx3,1,0,text,2020-01-01T00:00:00Z,,5,\n")
    paths = [[f"{tmp_path}/posts"], [f"{tmp_path}/comments", f"{tmp_path}/bad.csv"], [f"{tmp_path}/synonyms"]]
    lake = Lake(spark, f"{tmp_path}/lake")
    with pytest.raises(Exception, match="[Mm]alformed"):
        run_etl(spark, lake, *paths, incremental=False)
    run_etl(spark, lake, *paths, incremental=False, rejects=f"{tmp_path}/rejects")
    assert lake.read("comments").count() == 4
    assert [r._corrupt_record[:2] for r in spark.read.parquet(f"{tmp_path}/rejects/comments").collect()] == ["x3"]
    assert spark.read.parquet(f"{tmp_path}/rejects/posts").isEmpty()


def test_load_accounts_for_every_record(spark, forum, tmp_path):
    for name in ("posts", "comments", "synonyms"):
        write_csv(getattr(forum, name), f"{tmp_path}/{name}")
    head = ",".join(forum.comments.columns)
    bad = ['x3,1,0,text,2020-01-01T00:00:00Z,,5,', '3,1,0,"two\nlines",yesterday,,5,', '3,1,"4"2",text,,,5,']
    (tmp_path / "bad.csv").write_text("\n".join([head, *bad, ""]))
    paths = [[f"{tmp_path}/posts"], [f"{tmp_path}/comments", f"{tmp_path}/bad.csv"], [f"{tmp_path}/synonyms"]]
    lake = Lake(spark, f"{tmp_path}/lake")
    with pytest.raises(ValueError, match=f"3 of {forum.comments.count() + 3} records of the comments"):
        run_etl(spark, lake, *paths, incremental=False)
    assert not lake.exists(schemas.QUESTIONS_TABLE)
    for split_from in (1, 1 << 30):
        folder = f"{tmp_path}/rejects{split_from}"
        got = {r.Export: tuple(r)[1:] for r in run_etl(spark, lake, *paths, False, rejects=folder, split_from=split_from).collect()}
        assert got == {"posts": (forum.posts.count(), forum.posts.count(), 0),
                       "comments": (forum.comments.count() + 3, forum.comments.count(), 3),
                       "synonyms": (forum.synonyms.count(), forum.synonyms.count(), 0)}
        assert spark.read.parquet(f"{folder}/comments").count() == 3
        assert lake.read("comments").count() == 4
