"""CSV exports and result tables.

Dialect (fixed values): header line, ``"`` as quote, a quote inside a field doubled, and
fields that may hold line breaks. An empty field is NULL, quoted or not: the exports quote
every field, so they have no other way to leave one out. Writing uses the same dialect, so
a table comes back as it was written, save that empty text becomes NULL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
WRITTEN_TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_csv(spark: SparkSession, paths: list[str] | str, schema, header: bool = True,
             multi_line: bool = True, mode: str = "PERMISSIVE",
             corrupt_column: str | None = None) -> DataFrame:
    """Read one or more files or folders of CSV parts.

    A multi-line file is one task: hand in many files, or set ``multi_line=False`` where no
    field holds a line break. ``corrupt_column`` names an extra column that receives the text
    of records that do not fit the schema.
    """
    options = {"header": header, "quote": QUOTE, "escape": QUOTE, "multiLine": multi_line,
               "mode": mode}
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if corrupt_column:
        wanted = T.StructType([*wanted.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    reader = spark.read.options(**options)
    if wanted is not None:
        reader = reader.schema(wanted)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def write_csv(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table with a header line. Array columns need ``flatten_arrays`` first."""
    (table.write.mode(mode)
     .options(header=True, quote=QUOTE, escape=QUOTE, timestampFormat=WRITTEN_TIMESTAMPS,
              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
     .csv(path))


def flatten_arrays(table: DataFrame, separator: str = "-") -> DataFrame:
    """Array columns as joined text, for formats without arrays."""
    return table.select(*[
        F.concat_ws(separator, f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name) for f in table.schema.fields])
