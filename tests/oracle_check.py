"""Run queries beside their SQL in DuckDB and compare: python -m tests.oracle_check [folder] [name...]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def ordered(frame):
    """Columns by name, rows by value; missing values alike."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted((tuple(r) for r in frame.itertuples(index=False)), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


def difference(df, relation):
    """None where both results agree, else what differs."""
    got_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    want_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if got_types != want_types:
        return f"types {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    got = ordered(pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object))
    want = ordered(pd.DataFrame(relation.fetchall(), columns=relation.columns, dtype=object))
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows, want {len(want)}; ours {only_got}; theirs {only_want}"


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        df = query(spark, folder)
        try:
            if name in oracles:
                outcome = difference(df, connect(folder).sql(oracles[name])) or f"agrees ({df.count()} rows)"
            else:
                outcome = f"no SQL ({df.count()} rows)"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{name:45} {time.time() - start:6.2f}s {outcome[:700]}", flush=True)


if __name__ == "__main__":
    main()
