"""Parquet tables partitioned by day, with overwrite and upsert.

A table's rows lie in folders ``<table>/data/tagloom_load=<n>/tagloom_day=<date>``. The day is a real date, made
of the table's day text, which stays a column of its own; so ranges of days and joins to days prune folders.
A small manifest ``<table>/manifest/<version>.json`` names the one load that holds each day. Readers take the highest manifest,
so they see a table before or after a write and never between, no path is overwritten while it is read, and a
write that fails leaves the table as it was. After a write, what neither the new nor the previous manifest names is removed.

Files are sorted by key and carry Parquet's Bloom filters on it, so the search for a few keys skips most row groups.
Making a manifest visible needs a file system that renames a file at once, such as HDFS or a local disk.
"""

import datetime
import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.dates import parse_partition_day
from tagloom.schemas import PARTITION_COLUMN
from tagloom.staging import staged

LOAD_COLUMN, DAY_COLUMN = "tagloom_load", "tagloom_day"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
SEARCHED_KEYS, KEYS_IN_FILTER = 1000, 10
"""Up to so many new keys are looked up one by one in Parquet's statistics and Bloom filters, ten in a filter."""


@dataclass
class Manifest:
    version: int
    partition_column: str
    schema: T.StructType
    # The load that holds each day's folder, and how many folders each load wrote.
    partitions: dict[str, int] = field(default_factory=dict)
    folders: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "version": self.version, "partition_column": self.partition_column,
            "schema": self.schema.jsonValue(), "partitions": self.partitions,
            "folders": self.folders})

    @classmethod
    def from_json(cls, text: str) -> "Manifest":
        raw = json.loads(text)
        return cls(raw["version"], raw["partition_column"],
                   T.StructType.fromJson(raw["schema"]), raw["partitions"], raw["folders"])


def _as_stored(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in the stored types; running it fails on a value that does not come back unchanged."""
    given = {f.name: f.dataType for f in rows.schema.fields}

    def column(field: T.StructField):
        value = F.col(field.name)
        if given[field.name] == field.dataType:
            return value
        made = value.try_cast(field.dataType)
        back = made.try_cast(given[field.name])
        refuse = F.raise_error(F.concat(F.lit(f"{field.name} cannot be stored as "
                                              f"{field.dataType.simpleString()}: "), value.cast("string")))
        return F.when(value.eqNullSafe(back), made).otherwise(refuse.cast(field.dataType)).alias(field.name)

    return rows.select(*map(column, schema.fields))


def _day(partition_column: str) -> Column:
    """The date of a day text; NULL where it is none."""
    return F.to_date(parse_partition_day(partition_column))


def _folder(day: datetime.date | None) -> str:
    return f"{DAY_COLUMN}={NO_DAY if day is None else day.isoformat()}"


def _in_range(folder: str, first: datetime.date | None, last: datetime.date | None) -> bool:
    if first is None and last is None:
        return True
    day = folder.partition("=")[2]  # ISO dates sort as text
    return day != NO_DAY and (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())


class Lake:
    """Named tables below one root folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def read(self, name: str, first_day: datetime.date | None = None,
             last_day: datetime.date | None = None) -> DataFrame:
        """The table, or its rows of a range of days; rows without a day are in no range."""
        manifest = self._manifest(name)
        return self._scan(name, manifest, [p for p in manifest.partitions if _in_range(p, first_day, last_day)])

    def read_with_day(self, name: str) -> DataFrame:
        """The table with its partition column ``tagloom_day``, a date: filters on it and joins to it prune folders."""
        manifest = self._manifest(name)
        return self._files(name, manifest, manifest.partitions).select(*manifest.schema.names, DAY_COLUMN)

    def preview(self, name: str, rows: int = 100, truncate: bool = False) -> None:
        self.read(name).show(rows, truncate)

    def overwrite(self, table: DataFrame, name: str, partition_by: str = PARTITION_COLUMN, key: str = "Id") -> None:
        """Replace the table by new rows; fails if someone else writes it meanwhile."""
        version, load = max([0, *self._versions(name)]) + 1, self._next_load(name)
        written = self._write_load(table, name, load, partition_by, key)
        self._commit(name, Manifest(version, partition_by, table.schema,
                                    dict.fromkeys(written, load), {str(load): len(written)}))

    def upsert(self, rows: DataFrame, name: str, key: str = "Id",
               partition_by: str = PARTITION_COLUMN) -> None:
        """Update the rows whose key is in the table, insert the others, delete nothing.

        Days that hold a matched row or get a new one are written anew, so each day is one folder however many
        upserts there were; other days are not touched. A key given twice is an error if the table holds it, since
        it is then unclear which row wins. A missing table is created. Columns take the
        stored types; a value that its type cannot hold is an error. The upsert fails if
        someone else writes the table meanwhile, since it would undo their work.
        """
        if not self.exists(name):
            self.overwrite(rows, name, partition_by, key)
            return
        current = self._manifest(name)
        missing = set(current.schema.names) ^ set(rows.columns)
        if missing:
            raise ValueError(f"columns differ from table {name}: {sorted(missing)}")
        partition_by = current.partition_column
        if not current.partitions:
            self.overwrite(_as_stored(rows, current.schema), name, partition_by, key)
            return
        with staged(_as_stored(rows, current.schema), f"upsert-{name}") as incoming:
            keys = incoming.select(key).where(F.col(key).isNotNull())
            matched = self._matches(self._files(name, current, current.partitions), key, keys)
            repeated = keys.groupBy(key).count().where("count > 1")
            if not (repeated.isEmpty() or repeated.join(matched, key, "left_semi").isEmpty()):
                raise ValueError(f"several new rows for one {key} of table {name}")
            # One short row per day, never per record.
            days = matched.select("day").unionByName(incoming.select(_day(partition_by).alias("day"))).distinct()
            touched = {_folder(r.day) for r in days.toLocalIterator()} & set(current.partitions)
            kept = self._scan(name, current, touched).join(keys, key, "left_anti")
            load = self._next_load(name)
            written = self._write_load(kept.unionByName(incoming), name, load, partition_by, key)
        partitions = {p: held for p, held in current.partitions.items() if p not in touched} | dict.fromkeys(written, load)
        live = {str(held) for held in partitions.values()}
        # The number that follows the version read: taken already if someone else has committed.
        self._commit(name, Manifest(current.version + 1, partition_by, current.schema, partitions,
                                    {n: count for n, count in {**current.folders, str(load): len(written)}.items() if n in live}))

    def _matches(self, stored: DataFrame, key: str, keys: DataFrame) -> DataFrame:
        """Key and day of the stored rows that have one of the keys."""
        few = [r[0] for r in keys.distinct().limit(SEARCHED_KEYS + 1).collect()]
        if len(few) <= SEARCHED_KEYS:
            # Short lists become equalities, each of which is held against a row group's range and Bloom filter.
            few.sort()
            lists = [F.col(key).isin(few[i:i + KEYS_IN_FILTER]) for i in range(0, len(few), KEYS_IN_FILTER)]
            wanted = reduce(lambda a, b: a | b, lists, F.lit(False))
        else:
            # Keys mostly grow with time: their range lets the scan skip whole row groups.
            first, last = keys.agg(F.min(key), F.max(key)).first()
            wanted = F.col(key).between(F.lit(first), F.lit(last))
        found = stored.where(wanted).select(key, F.col(DAY_COLUMN).alias("day"))
        return found if len(few) <= SEARCHED_KEYS else found.join(keys, key, "left_semi")

    def overwrite_all(self, tables: dict[str, DataFrame], partition_by: str = PARTITION_COLUMN) -> None:
        for name, table in tables.items():
            self.overwrite(table, name, partition_by)

    def upsert_all(self, tables: dict[str, DataFrame], key: str = "Id") -> None:
        for name, rows in tables.items():
            self.upsert(rows, name, key)

    def _scan(self, name: str, manifest: Manifest, partitions) -> DataFrame:
        return self._files(name, manifest, partitions).select(*manifest.schema.names)

    def _files(self, name: str, manifest: Manifest, partitions) -> DataFrame:
        wanted: dict[int, list[str]] = {}
        for partition in partitions:
            wanted.setdefault(manifest.partitions[partition], []).append(partition)
        paths = []
        for load, folders in wanted.items():
            root = self._load(name, load)
            # A load read as a whole is one path, so Spark lists its days in parallel.
            whole = len(folders) == manifest.folders[str(load)]
            paths += [root] if whole else [f"{root}/{folder}" for folder in folders]
        schema = T.StructType([*manifest.schema.fields, T.StructField(DAY_COLUMN, T.DateType())])
        reader = self.spark.read.schema(schema).option("basePath", self._data(name))
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write_load(self, table: DataFrame, name: str, load: int, partition_by: str, key: str = "Id") -> list[str]:
        """Write new files and return the day folders they are in."""
        path = self._load(name, load)
        # Rebalancing gathers a day's rows into few files and splits a hot one.
        dated = table.withColumn(DAY_COLUMN, _day(partition_by)).hint("rebalance", F.col(DAY_COLUMN))
        sorted_by = [DAY_COLUMN] + [key] * (key in table.columns)
        options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.fpp#{key}": "0.001",
                   "parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(4 << 20)}
        try:
            dated.sortWithinPartitions(*sorted_by).write.partitionBy(DAY_COLUMN).options(**options).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise RuntimeError(f"table {name} was written by someone else at the same time") from error
        return [p for p in self._children(path) if p.startswith(f"{DAY_COLUMN}=")]

    def _remove_unnamed(self, name: str, newest: Manifest) -> None:
        """Delete what neither the newest manifest nor the one before it names; newer loads belong to writers at work."""
        manifests = [newest] + [self._read_manifest(name, v) for v in self._versions(name) if v == newest.version - 1]
        named = {(held, p) for m in manifests for p, held in m.partitions.items()}
        live = {held for held, _ in named}
        for load in self._loads(name):
            if load not in live and load <= max(live, default=0):
                self._delete(self._load(name, load))
            elif load in live and any(str(load) in m.folders and m.folders[str(load)] > sum(
                    held == load for held in m.partitions.values()) for m in manifests):
                for folder in self._children(self._load(name, load)):
                    if folder.startswith(f"{DAY_COLUMN}=") and (load, folder) not in named:
                        self._delete(f"{self._load(name, load)}/{folder}")
        for version in self._versions(name):
            if version < newest.version - 1:
                self._delete(f"{self._manifests(name)}/{version}.json")

    def _delete(self, location: str) -> None:
        path, fs = self._path(location)
        fs.delete(path, True)

    def _load(self, name: str, load: int) -> str:
        return f"{self._data(name)}/{LOAD_COLUMN}={load}"

    def _loads(self, name: str) -> list[int]:
        return [int(f.partition("=")[2]) for f in self._children(self._data(name))]

    def _data(self, name: str) -> str:
        return f"{self.root}/{name}/data"

    def _manifests(self, name: str) -> str:
        return f"{self.root}/{name}/manifest"

    def _versions(self, name: str) -> list[int]:
        return [int(f.removesuffix(".json")) for f in self._children(self._manifests(name))
                if f.endswith(".json")]

    def _next_load(self, name: str) -> int:
        """A number that no earlier write has taken, not even a failed one."""
        return max([0, *self._versions(name), *self._loads(name)]) + 1

    def _manifest(self, name: str) -> Manifest:
        versions = self._versions(name)
        if not versions:
            raise ValueError(f"no table {name} below {self.root}")
        return self._read_manifest(name, max(versions))

    def _read_manifest(self, name: str, version: int) -> Manifest:
        path, fs = self._path(f"{self._manifests(name)}/{version}.json")
        lines = self.spark._jvm.java.io.BufferedReader(
            self.spark._jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
        try:
            return Manifest.from_json(lines.readLine())
        finally:
            lines.close()

    def _commit(self, name: str, manifest: Manifest) -> None:
        """Make the new version visible by renaming its complete manifest into place."""
        final, fs = self._path(f"{self._manifests(name)}/{manifest.version}.json")
        draft, _ = self._path(f"{self._manifests(name)}/{manifest.version}-{uuid.uuid4().hex}.draft")
        output = fs.create(draft, False)
        try:
            output.write(bytearray(manifest.to_json().encode("utf-8")))
        finally:
            output.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"table {name} was written by someone else at the same time")
        self._remove_unnamed(name, manifest)

    def _children(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _path(self, location: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())
