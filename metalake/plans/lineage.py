"""Cutting lineage: tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_dir(spark: SparkSession) -> str:
    """One folder per application in ``spark.checkpoint.dir``; where that is unset a session on
    one machine chooses a temporary folder, once, and a cluster raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="metalake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def written(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the work folder, read back: recovery starts there. With ``by``
    each value of that column has files of its own, so a filter on it reads no others."""
    path = f"{work_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *key: str, per_task: int = 10_000) -> DataFrame:
    """``df``, a stored table of narrow rows, dealt out by ``key`` so that no task has many more than
    ``per_task`` rows. A small file holds many rows in a few row groups, and each of those is one
    task, however much work its rows make later. Rows are counted by the files' footers."""
    tasks = -(-df.count() // per_task)
    return df.repartition(tasks, *key) if tasks > 1 else df


def hot_joined(left: DataFrame, right: DataFrame, key: str, share: int = 512, most: int = 200_000) -> DataFrame:
    """Inner join in which a key of more than 1/``share`` of the rows of ``left``, a written table, is
    no task's burden: such keys are fewer than ``share``, their rows of ``right`` are broadcast
    (if those are ``most`` at most) and their rows of ``left`` stay where they are."""
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = left.count()
    hot = [r[key] for r in counts.where(F.col("n") > max(total / share, 10_000)).collect()]
    mine = right.where(F.col(key).isin(hot)) if hot else None
    if not hot or mine.count() > most:
        return left.join(right, key)
    there = left.where(F.col(key).isin(hot)).join(F.broadcast(mine), key)
    return there.unionByName(left.where(~F.col(key).isin(hot)).join(right.where(~F.col(key).isin(hot)), key))


def weighed_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, share: int = 512) -> DataFrame:
    """Inner join with ``right``, a written table whose keys are unique and whose ``weight`` counts the rows
    of ``left`` with that key. Keys of more than 1/``share`` of all rows (and 10,000) are fewer than
    ``share``: they are broadcast, and their rows of ``left`` stay where they are."""
    key = F.xxhash64(*on)
    total = right.agg(F.sum(weight)).first()[0] or 0
    hot = [r[0] for r in right.where(F.col(weight) > max(total / share, 10_000)).select(key).collect()]
    narrow = right.drop(weight)
    if not hot:
        return left.join(narrow, on)
    there = left.where(key.isin(hot)).join(F.broadcast(narrow.where(key.isin(hot))), on)
    return there.unionByName(left.where(~key.isin(hot)).join(narrow.where(~key.isin(hot)), on))


_MADE: dict[tuple[str, str, str], str] = {}


def made_path(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], None]) -> str:
    """Path of what ``make`` writes there from the tables of ``sf_dir``, by its first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MADE:
        path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
        make(path)
        _MADE[key] = path
    return _MADE[key]


def made_once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from the tables of ``sf_dir``, written by its first use in an application."""
    return spark.read.parquet(made_path(spark, sf_dir, name, lambda path: make().write.parquet(path)))
