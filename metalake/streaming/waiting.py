"""Records that come before their origin: held in keyed state until it comes, or given up.

Events are records and origins under one key, the hash of the origin's URL. A record waits in
the state of its key's bucket. Each time its time is up it has been tried once more; when the origin
comes all records of the key leave as resolved, and a record that was tried ``tries`` times in
vain leaves as dead, for a table of its own. An origin is remembered as long as a record would
wait, for records that come just after it; those that come later find it in the stored table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = "key string, url string, record string"
OUT = "key string, url string, record string, status string, tries int"
STATE = "held binary"
HELD = ["key", "url", "record", "tries", "due"]
HELD_SCHEMA = pa.schema(list(zip(HELD, (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64()))))


def events(records: DataFrame, origins: DataFrame, target: str = "target", url: str = "url") -> DataFrame:
    """One stream of records (any columns, as JSON text) and origins, keyed by the origin's hash."""
    held = records.select(F.lower(F.col(target)).alias("key"), F.lit(None).cast("string").alias("url"), F.to_json(F.struct(*records.columns)).alias("record"))
    return held.unionByName(origins.select(F.sha1(F.col(url).cast("binary")).alias("key"), F.col(url).alias("url"), F.lit(None).cast("string").alias("record")))


def resolve(stream: DataFrame, tries: int = 6, every_ms: int = 10_000, buckets: int = 512) -> DataFrame:
    """(key, url, record, status, tries) of a stream of :func:`events`: status is resolved or dead.

    A record is tried again with the first batch that runs ``every_ms`` after its last try. Rows
    without a key are dropped. Keys are dealt to ``buckets``, whose records wait in one state, as
    an Arrow table with a try and a due time for each row, so that a batch's work is one call for
    a bucket, not one for each key. A key that many records wait for is one task's work.
    """

    def step(key: tuple[int], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = pa.ipc.open_stream(bytes(state.get[0])).read_pandas() if state.exists else pd.DataFrame(columns=HELD)
        due = held["due"].to_numpy() <= now
        held["tries"] = held["tries"] + due
        held.loc[due, "due"] = now + every_ms
        if not state.hasTimedOut:
            new = pd.concat([b[["key", "url", "record"]] for b in batches]).assign(tries=0, due=now + every_ms)
            held = pd.concat([new, held], ignore_index=True) if len(held) else new
        origins = held[held["url"].notna()].drop_duplicates("key")
        records = held[held["record"].notna()]
        url = records["key"].map(origins.set_index("key")["url"])
        leave = (url.notna() | (records["tries"] >= tries)).to_numpy(dtype=bool)
        if leave.any():
            told = records[leave].assign(url=url[leave])
            yield told.assign(status=np.where(told["url"].notna(), "resolved", "dead"))[["key", "url", "record", "status", "tries"]]
        rest = pd.concat([records[~leave].assign(url=None), origins[origins["tries"] < tries].assign(record=None)])
        if len(rest):
            table, out = pa.Table.from_pandas(rest[HELD], HELD_SCHEMA, preserve_index=False), pa.BufferOutputStream()
            with pa.ipc.new_stream(out, table.schema) as writer:
                writer.write_table(table)
            state.update((out.getvalue().to_pybytes(),))
            state.setTimeoutDuration(max(1, int(rest["due"].min()) - now))
        elif state.exists:
            state.remove()

    known = stream.where("key is not null").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket")
    return known.applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


@contextmanager
def without_idle_batches(spark: SparkSession) -> Iterator[None]:
    """Streams started inside end with their input. With timers pending they would else run batches
    without data for ever, which is what a stream that never ends wants."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def split(found: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(resolved, dead): the records' own columns, the resolved with their origin's url."""
    whole = found.withColumn("r", F.from_json("record", schema))
    return whole.where("status = 'resolved'").select("r.*", "url"), whole.where("status = 'dead'").select("r.*", "tries")
