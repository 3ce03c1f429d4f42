"""Readers for the file shapes of the jobs. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SENSOR_SCHEMA = "sensor_id string, timestamp string, temperature double, status string"
TRACK_CSV_SCHEMA = "name string, artist string, album string, count bigint, rating bigint, length bigint, genre string"
#: Columns of the production files; Value is text with thousands separators, and marks such as (D) where it is withheld.
PRODUCTION_SCHEMA = "Year int, Period string, Geo_Level string, State_ANSI int, Commodity_ID int, Domain string, Value string"


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header line into a typed table."""
    return spark.read.csv(path, header=True, schema=schema)


def read_csv_positional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV without header; rows with too few fields are skipped.

    A short row is told from a row with empty trailing values by the corrupt-record column, which is only
    filled when whole rows are parsed: column pruning is off for this scan.
    """
    full = spark.read.option("columnPruning", "false").csv(path, schema=f"{schema}, _bad string", mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    return full.where(F.col("_bad").isNull()).drop("_bad")


def read_json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files that hold one JSON array of objects each."""
    return spark.read.json(path, schema=schema, multiLine=True)


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.json(path, schema=schema)


def json_tuples(df: DataFrame, c: str, names: list[str]) -> DataFrame:
    """Column of JSON arrays ``[[a, b, ...], ...]`` to one row per inner array."""
    inner = df.select(*[x for x in df.columns if x != c], F.posexplode(F.from_json(c, "array<array<string>>")).alias("_pos", "_t"))
    return inner.select(*[x for x in df.columns if x != c], "_pos", *[F.try_element_at(F.col("_t"), F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def read_json_tuples(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Files that hold one JSON array of arrays each."""
    return json_tuples(spark.read.text(path, wholetext=True), "value", names)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Whole documents as text, with the file name and the reading time."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("raw_data"), F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at_utc"))


def with_provenance(df: DataFrame, file: str = "file_name") -> DataFrame:
    """Add file name (or ``file_path``) and reading time to the rows of a file scan."""
    return df.select("*", F.col(f"_metadata.{file}").alias("_source_file"), F.current_timestamp().alias("_ingested_at_utc"))


def read_lines(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Text lines that start with a prefix."""
    return spark.read.text(path).where(F.col("value").startswith(prefix))


def xml_values(df: DataFrame, c: str, path: str) -> DataFrame:
    """All text nodes of an XPath in a column of XML documents, one row each."""
    return df.select(*[x for x in df.columns if x != c], F.explode(F.xpath(c, F.lit(path))).alias("value"))


def html_tag_values(df: DataFrame, c: str, tag: str) -> DataFrame:
    """Text contents of every ``tag`` in a column of pages, one row each."""
    found = F.regexp_extract_all(c, F.lit(f"<{tag}(?:\\s[^>]*)?>([^<]*)</{tag}>"), F.lit(1))
    return df.select(*[x for x in df.columns if x != c], F.explode(found).alias("value"))


def read_table(spark: SparkSession, name: str, cols: list[str]) -> DataFrame:
    return spark.table(name).select(*cols)


def read_clients(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Client master exported as CSV; empty cells and ``nan`` become NULL."""
    return spark.read.csv(path, header=True, schema=schema, nanValue="nan", nullValue="").replace("nan", None)
