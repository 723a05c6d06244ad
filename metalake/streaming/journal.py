"""Consume a log of objects in micro-batches and feed every selected indexer.

At least once: a batch's offsets are committed by Spark's checkpoint after its writes. Each
write goes to a folder named by the batch's number and replaces it, so a repeated batch
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from metalake.streaming.levels import Levels

Job = Callable[[DataFrame], DataFrame]


def file_log(spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int = 1) -> DataFrame:
    """A log kept as Parquet files; ``files_per_batch`` bounds a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def kafka_options(brokers: str, prefix: str, object_types: list[str], per_batch: int = 200, group: str | None = None) -> dict[str, str]:
    """Options of a Kafka source with one topic per object type."""
    topics = ",".join(f"{prefix}.{t}" for t in sorted(set(object_types)))
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topics, "maxOffsetsPerTrigger": str(per_batch), "startingOffsets": "earliest"}
    return options | ({"kafka.group.id": group} if group else {})


def kafka_log(spark: SparkSession, brokers: str, prefix: str, object_types: list[str], per_batch: int = 200, group: str | None = None) -> DataFrame:
    """A Kafka log (needs Spark's Kafka package on the class path)."""
    return spark.readStream.format("kafka").options(**kafka_options(brokers, prefix, object_types, per_batch, group)).load()


def topics_of(indexers: dict[str, list[str]], chosen: list[str]) -> list[str]:
    """Object types that the chosen indexers read, each once."""
    return sorted({t for name in chosen for t in indexers[name]})


def subscribed(log: DataFrame, prefix: str, object_types: list[str]) -> DataFrame:
    """The messages (topic, value, ...) of a log of several topics that object types are sent to; on a
    log of files the topics are tested where the files are read."""
    return log.where(F.col("topic").isin(sorted({f"{prefix}.{t}" for t in object_types})))


def objects(log: DataFrame, topic: str, schema: str) -> DataFrame:
    """The objects of one topic, from their JSON text (string or UTF-8 bytes); messages that
    :func:`unreadable` lists are left out."""
    told = log.where(F.col("topic") == topic).select(F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"}).alias("v"), "value")
    return told.where(_readable("value")).select("v.*")


def unreadable(log: DataFrame) -> DataFrame:
    """(topic, value) of messages that hold no JSON object."""
    return log.where(~_readable("value")).select("topic", F.col("value").cast("string").alias("value"))


def _readable(column: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(column).cast("string"))).startswith("OBJECT"), F.lit(False))


def by_topic(jobs: dict[str, tuple[str, Job]], prefix: str, kinds: dict[str, str]) -> dict[str, Job]:
    """Jobs of :func:`run_indexers` from ``jobs`` (name: its object type and job): each is given the
    objects of its own topic, with the schema that ``kinds`` names for the type. An object type that
    several jobs read passes the log once."""

    def reader(object_type: str, job: Job) -> Job:
        return lambda rows: job(objects(rows, f"{prefix}.{object_type}", kinds[object_type]))

    return {name: reader(object_type, job) for name, (object_type, job) in jobs.items()}


def run_indexers(log: DataFrame, jobs: dict[str, Job], out: str, checkpoint: str, changes: dict[str, Job] | None = None, stop_after: int | None = None, index: dict[str, list[str]] | None = None) -> StreamingQuery:
    """Gives each batch to every job and writes its rows under ``out/<job>/batch=<n>``; jobs of
    ``changes`` write the additions log, once their batch's index rows are there.

    Each batch and job leaves a row in ``out/_status``: eventful, uneventful or failed. A job
    that fails writes nothing of that batch and doesn't keep the others from theirs. The
    stream ends when the log is read to its end or, at the end of a batch, when ``stop_after``
    objects were read; a later run goes on from there. ``index`` names jobs whose rows are an index
    table, with its key: those batches also go into :class:`.levels.Levels` under ``out/_index``,
    from which :func:`read_index` reads few files however many batches there were.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        told = []
        try:
            for name, job in (jobs | (changes or {})).items():
                path = f"{out}/{name}/batch={number}"
                try:
                    seen = Observation()
                    job(rows).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
                    if name in (index or {}):
                        Levels(rows.sparkSession, f"{out}/_index/{name}", index[name]).add(rows.sparkSession.read.parquet(path), number)
                    n = seen.get["n"]
                    told.append((name, n, "eventful" if n else "uneventful", None))
                except Exception as error:  # noqa: BLE001 - a job's failure is its status, not the stream's
                    told.append((name, 0, "failed", f"{type(error).__name__}: {error}"[:1000]))
            status = rows.sparkSession.createDataFrame(told, "job string, added long, status string, error string")
            status.coalesce(1).write.mode("overwrite").parquet(f"{out}/_status/batch={number}")
        finally:
            rows.unpersist()

    query = log.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    read: dict[int, int] = {}
    while stop_after is not None and not query.awaitTermination(0.1):
        read.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress})
        if sum(read.values()) >= stop_after:
            query.stop()
    return query


def status(spark: SparkSession, out: str) -> DataFrame:
    """(batch, job, added, status, error) of all batches so far."""
    return spark.read.option("basePath", f"{out}/_status").parquet(f"{out}/_status/batch=*")


def read_index(spark: SparkSession, out: str, job: str, key: list[str]) -> DataFrame:
    """The index table that the batches make: for each key, the row of the latest batch. Jobs
    that were run with ``index`` are read from their levels, others from all batches."""
    if (kept := Levels(spark, f"{out}/_index/{job}", key).read()) is not None:
        return kept
    rows = spark.read.parquet(f"{out}/{job}")
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in key]), "batch").alias("v"))
    return last.select(*key, "v.*").drop("batch")
