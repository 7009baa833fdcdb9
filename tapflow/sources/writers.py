"""Sinks: Parquet layouts, tables, CSV export, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import year_month
from .readers import read_taps_csv, typed_taps

ROW_GROUP_BYTES = 128 * 1024 * 1024


def write_table(
    df: DataFrame,
    path: str,
    partition_cols: list[str] | None = None,
    *,
    mode: str = "overwrite",
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Parquet, ZSTD.

    With partition columns the rows are clustered by them first; AQE splits a
    month that is larger than an advisory partition over several tasks, so
    one big month is not one big file.
    """
    if partition_cols:
        df = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    writer = df.write.mode(mode).option("compression", "zstd").option("parquet.block.size", row_group_bytes)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, cols: list[str], named: list[str] | None = None) -> None:
    """Replace the partitions present in ``df``; running it again leaves the table as it is.

    ``named`` are all values of the first column that are loaded anew, as for a truncate before a load: those without
    rows in ``df`` lose their old rows, and rows of other values are an error.
    """
    if named is not None:
        df = df.where(F.when(F.col(cols[0]).cast("string").isin(named), True).otherwise(
            F.raise_error(F.concat(F.lit(f"{cols[0]} is not among those named: "), F.coalesce(F.col(cols[0]).cast("string"), F.lit("NULL"))))
        ))
    (
        df.hint("rebalance", *[F.col(c) for c in cols])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*cols)
        .parquet(path)
    )
    if named:
        # Within a loaded value all partitions are replaced, so what is left of the emptied ones goes as a whole.
        loaded = {str(r[0]) for r in df.select(cols[0]).distinct().collect()}
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for value in sorted(set(named) - loaded):
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{cols[0]}={value}")
            folder.getFileSystem(conf).delete(folder, True)


def ingest_days(spark: SparkSession, src_glob: str | list[str], out: str) -> DataFrame:
    """All daily extracts in one scan, compacted to one folder per month."""
    taps = typed_taps(read_taps_csv(spark, src_glob)).withColumn("ym", year_month(F.col("op_date")))
    overwrite_partitions(taps, out, ["ym"])
    return spark.read.parquet(out)


def month_of_date_layout(df: DataFrame, date_col: str, name: str = "month_start") -> DataFrame:
    """Range partitioning by month: each row carries the first day of its month."""
    return df.withColumn(name, F.trunc(F.col(date_col), "MM"))


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Create-or-replace (``overwrite``) or append by column name."""
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.insertInto(name)
        return
    writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def export_csv(df: DataFrame, path: str, cols: list[str]) -> None:
    r"""Headerless CSV in a fixed column order, NULL as ``\N``."""
    (
        df.select(*cols)
        .write.mode("overwrite")
        .option("header", False)
        .option("nullValue", "\\N")
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def jdbc_options(url: str, table: str, schema: str | None, batch: int) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": f"{schema}.{table}" if schema else table,
        "batchsize": str(batch),
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    schema: str | None = None,
    batch: int = 10000,
    properties: dict[str, str] | None = None,
) -> None:
    """Append load. Each task holds one connection, so callers bound the
    task count with ``numPartitions`` in ``properties``."""
    (
        df.write.format("jdbc")
        .mode("append")
        .options(**jdbc_options(url, table, schema, batch))
        .options(**(properties or {}))
        .save()
    )
