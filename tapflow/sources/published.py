"""A published table whose months are replaced all at once.

Each load writes its partitions beside the old ones, below ``versions/version=<id>``, and then replaces one small file,
``current.json``, that names the version of every partition. That replacement is the commit: a job that dies before it
leaves the old state whole, one that dies after it the new one. Nothing that readers may use is ever overwritten.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

POINTER = "current.json"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _text(spark: SparkSession, path: str) -> str | None:
    where, fs = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def pointer(spark: SparkSession, path: str) -> dict | None:
    """What the table consists of now: ``schema``, ``by`` (partition columns), ``parts`` (folder -> version)."""
    text = _text(spark, f"{path}/{POINTER}")
    return json.loads(text) if text is not None else None


def _commit(spark: SparkSession, path: str, state: dict) -> None:
    fresh, fs = _at(spark, f"{path}/.{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(json.dumps(state, ensure_ascii=True).encode()))
    out.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, target, how)


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below ``path``, ``depth`` levels down, as relative paths."""
    where, fs = _at(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    names = [n for n in names if "=" in n]
    return names if depth == 1 else [f"{n}/{below}" for n in names for below in _folders(spark, f"{path}/{n}", depth - 1)]


def load(df: DataFrame, path: str, by: list[str], named: list[str] | None = None) -> None:
    """Replace the values of ``by[0]`` that ``df`` holds, with all partitions below them.

    ``named`` are all values of ``by[0]`` that are loaded anew, as for a truncate before a load: those without rows in
    ``df`` end up empty, and rows of other values are an error. One load at a time may run on a table.
    """
    spark = df.sparkSession
    if named is not None:
        top = F.col(by[0]).cast("string")
        wrong = F.raise_error(F.concat(F.lit(f"{by[0]} is not among those named: "), F.coalesce(top, F.lit("NULL"))))
        df = df.where(F.when(top.isin(named), True).otherwise(wrong))
    version = uuid.uuid4().hex
    fresh = f"{path}/versions/version={version}"
    df.hint("rebalance", *[F.col(c) for c in by]).write.option("compression", "zstd").partitionBy(*by).parquet(fresh)
    # What was written is taken from the folders: the input isn't read again.
    written = _folders(spark, fresh, len(by))
    old = pointer(spark, path) or {"parts": {}}
    gone = {f.split("/")[0] for f in written} | {f"{by[0]}={v}" for v in named or []}
    parts = {f: v for f, v in old["parts"].items() if f.split("/")[0] not in gone} | {f: version for f in written}
    _commit(spark, path, {"schema": df.schema.json(), "by": by, "parts": parts})


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as last committed, in the column order and types of the last load."""
    state = pointer(spark, path)
    if state is None:
        raise FileNotFoundError(f"nothing was loaded at {path}")
    schema = StructType.fromJson(json.loads(state["schema"]))
    if not state["parts"]:
        return spark.createDataFrame([], schema)
    base = f"{path}/versions"
    files = [f"{base}/version={version}/{folder}" for folder, version in sorted(state["parts"].items())]
    found = spark.read.option("basePath", base).parquet(*files)
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete partitions that the pointer no longer names; returns their folders. No reader of an older state may run."""
    state = pointer(spark, path) or {"parts": {}, "by": []}
    kept = {f"version={v}/{f}" for f, v in state["parts"].items()}
    gone = []
    for folder in _folders(spark, f"{path}/versions", 1 + max(1, len(state["by"]))):
        if folder not in kept:
            where, fs = _at(spark, f"{path}/versions/{folder}")
            fs.delete(where, True)
            gone.append(folder)
    return sorted(gone)
