"""Batch scans (S3): parquet with a pinned schema, and the JDBC / CSV readers.

Every reader returns a lazy DataFrame; Catalyst prunes columns and pushes
filters into the scan (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read with its pinned schema (no inference)."""
    schema = schemas.DRIVER_TABLES.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int = 64, fetch_size: int = 10_000,
                 single_connection: bool = False, **extra: str) -> dict[str, str]:
    """Options for a partitioned JDBC read (one range per task, never one
    driver-side frame). The database driver jar must be on the classpath. Without a
    partition column one task would read everything; that must be asked for."""
    if partition_column is None and not single_connection:
        raise ValueError("name a partition_column (with bounds), or ask for the whole table over "
                         "one connection with single_connection=True")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partitioned JDBC read needs lower_bound and upper_bound")
        options.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        })
    options.update({k: str(v) for k, v in extra.items()})
    return options


def read_jdbc(spark: SparkSession, schema: T.StructType | None = None, **options) -> DataFrame:
    reader = spark.read.format("jdbc").options(**jdbc_options(**options))
    df = reader.load()
    if schema is not None:
        df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


# One set for writing and reading. Texts go through ``csv_encoded``, so no value holds a
# line break, and no text is empty or missing in the file.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "lineSep": "\n",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_NULL, CSV_EMPTY = "\\N", "\\E"
# Code per character; the backslash's own code is put in first and taken out last.
CSV_CODES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def csv_encoded(df: DataFrame) -> DataFrame:
    """Text columns with line breaks, the backslash, NULL and the empty text as codes of two characters,
    so that each row is one line and a file can be cut anywhere."""
    def code(c):
        out = F.col(c)
        for char, short in CSV_CODES:
            out = F.replace(out, F.lit(char), F.lit(short))
        return F.coalesce(F.when(F.col(c) == "", F.lit(CSV_EMPTY)).otherwise(out), F.lit(CSV_NULL)).alias(c)
    texts = _texts(df.schema)
    return df.select(*[code(c) if c in texts else F.col(c) for c in df.columns])


def csv_decoded(df: DataFrame) -> DataFrame:
    def text(c):
        out = F.col(c)
        for char, short in reversed(CSV_CODES):
            out = F.replace(out, F.lit(short), F.lit(char))
        return (F.when(F.col(c) == CSV_NULL, F.lit(None)).when(F.col(c) == CSV_EMPTY, F.lit(""))
                .otherwise(out).alias(c))
    texts = _texts(df.schema)
    return df.select(*[text(c) if c in texts else F.col(c) for c in df.columns])


def read_csv_staging(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S5 re-aimed: header CSV read back with the schema it was written with
    (the reference re-inferred types, which turned decimals into floats and
    read a category named ``NA`` as missing). Every value comes back as written: blanks
    at the ends, empty texts apart from NULL, quotes, line breaks and control characters. A row is a
    line, so large files are split over tasks."""
    return csv_decoded(spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "FAILFAST").csv(path))
