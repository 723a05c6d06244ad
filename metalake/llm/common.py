"""Helpers that the training-data operators share: the shared work folder and cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, one per application.

    It lies in ``spark.checkpoint.dir``; where that is unset a session on one machine chooses
    a temporary folder, once, and a cluster raises. Files stay until the folder's own
    retention or :func:`clear_work` removes them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="metalake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run inside hand whole texts to Python ``rows`` at a time at most. Spark's 10,000 are some tens of
    MB, which executor and worker hold a few times over for each task. The session's option is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


WIDTHS = {"bigint": 8, "int": 4, "double": 8, "boolean": 1}


def few(df: DataFrame, most_bytes: int = 8_000_000) -> DataFrame:
    """``df``, a written table, marked for broadcast if its values take at most ``most_bytes``:
    fixed widths and the longest text or binary of each column, times the counted rows."""
    loose = [f.name for f in df.schema.fields if f.dataType.simpleString() not in WIDTHS]
    told = df.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.octet_length(c)).alias(c) for c in loose]).first()
    width = sum(WIDTHS.get(f.dataType.simpleString(), 0) for f in df.schema.fields) + sum(told[c] or 0 for c in loose)
    return F.broadcast(df) if told["n"] * width <= most_bytes else df


def meet(left: DataFrame, right: DataFrame, on: list[str], weight: str, total: int, how: str = "inner", share: int = 512) -> DataFrame:
    """``left`` joined with ``right``, a written table whose keys are unique and whose ``weight``
    counts the rows of ``left`` with that key; the weights add up to ``total`` at most. Keys of
    more than 1/``share`` of all rows are thus fewer than ``share``: the driver learns their
    hashes, they are broadcast, and their rows of ``left`` stay where they are."""
    key = F.xxhash64(*on)
    hot = [r[0] for r in right.where(F.col(weight) > total / share).select(key).collect()]
    if not hot:
        return left.join(right, on, how)
    is_hot = key.isin(hot)
    there = left.where(is_hot).join(F.broadcast(right.where(is_hot)), on, how)
    return there.unionByName(left.where(~is_hot).join(right.where(~is_hot), on, how))


SCALE = 1 << 40


def draw(df: DataFrame, key: str, n: int, most: int) -> DataFrame:
    """At most ``most`` of the ``n`` rows of ``df``, those of smallest key hash. A threshold
    leaves some four times as many first, so that no task sees ``most`` rows of every partition."""
    place = F.pmod(F.xxhash64(key), F.lit(SCALE))
    near = df if 4 * most >= n else df.where(place < int(SCALE * 4 * most / n))
    return near.orderBy(place, key).limit(most)


def clear_work(spark: SparkSession) -> None:
    """Delete this application's work folder through Hadoop's file system API."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str):
    return F.coalesce(F.col(name), F.lit(""))
