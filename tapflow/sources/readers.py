"""Scans: CSV, encoded text, monthly Parquet, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import text_to_id
from ..functions.times import tap_date, tap_time
from ..schema import TAP_HEADERS, TAPS_TEXT

PLAIN_ENCODINGS = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8"}


def read_taps_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = TAPS_TEXT) -> DataFrame:
    """Daily tap extracts under the published headers (``TAP_HEADERS``), renamed to ``schema``.

    Each file's header row is held against the schema: one with other columns, or in another order, stops the
    read instead of being taken by position.
    """
    published = {name: header for header, name in TAP_HEADERS.items()}
    headed = T.StructType([T.StructField(published.get(f.name, f.name), f.dataType) for f in schema])
    return spark.read.schema(headed).option("header", True).option("enforceSchema", False).csv(path).toDF(*schema.names)


def typed_taps(raw: DataFrame) -> DataFrame:
    """Parse ids, date and times once, at ingest."""
    return raw.withColumns(
        {
            "op_date": tap_date(F.col("op_date")),
            "board_stop": text_to_id(F.col("board_stop")),
            "alight_stop": text_to_id(F.col("alight_stop")),
            "board_ts": tap_time(F.col("board_ts")),
            "alight_ts": tap_time(F.col("alight_ts")),
        }
    )


def allow_encoding(spark: SparkSession, encoding: str) -> None:
    """Spark 4 admits regional charsets such as EUC-KR only behind this setting."""
    if encoding.lower() not in PLAIN_ENCODINGS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str,
    encoding: str,
    schema: T.StructType,
) -> DataFrame:
    """Delimited text in any charset the JVM knows, header row expected."""
    allow_encoding(spark, encoding)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .csv(path)
    )


def read_months(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """A month-partitioned table (local, HDFS or ``s3a://``), pruned to ``months``."""
    table = spark.read.option("basePath", root).parquet(root)
    table = table.withColumn("ym", F.col("ym").cast("string"))
    return table if months is None else table.where(F.col("ym").isin(*months))


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    partition: tuple[str, str, str, int] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A query result over JDBC.

    ``partition`` = (column, lower, upper, tasks) splits the read; without it
    one connection reads everything, which suits only small dimensions.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition is None:
        return reader.option("query", query).load()
    column, lower, upper, tasks = partition
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", tasks)
        .load()
    )
