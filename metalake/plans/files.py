"""Small files in folders that driver and executors share, through Hadoop's file system API."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def listed(spark: SparkSession, path: str) -> list[str]:
    """Paths of a folder's entries; none if it isn't there."""
    fs, p = at(spark, path)
    return [f.getPath().toString() for f in fs.listStatus(p)] if fs.exists(p) else []


def below(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files under a folder."""
    fs, p = at(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return out


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = at(spark, path)
    return fs.delete(p, True)


def create(spark: SparkSession, path: str, content: dict) -> None:
    """A new JSON file, whole from the moment it is seen: written aside, then renamed, which raises
    FileExistsError if the name is taken."""
    folder, _, _ = path.rpartition("/")
    fs, aside = at(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, at(spark, path)[1], options)
    except Exception as error:  # noqa: BLE001 - taken, however the file system says it
        fs.delete(aside, False)
        raise FileExistsError(path) from error


def records(spark: SparkSession, folder: str) -> list[dict]:
    """The contents of a folder's JSON files."""
    if not any(f.endswith(".json") for f in listed(spark, folder)):
        return []
    return [json.loads(r["value"]) for r in spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").collect()]
