"""The object log as a stream over the driver's events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from metalake.plans import pipelines
from metalake.plans.lineage import spread, work_dir
from metalake.sources import bridge
from metalake.sources.bridge import read
from metalake.streaming import journal, waiting

from .formats import SQL_EXTRINSIC, known_forge_origins, remd
from .register import Register

query = Register()


@query("select user_id, max(event_id) as last_event, count(*) as n from events where event_type <> 'error' group by 1")
def streamed_events(spark, sf_dir):
    """Every event passes the stream once; the jobs' batches are then read as one table."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = read(spark, sf_dir, "events")
    events.repartition(3, "event_id").write.parquet(f"{base}/log")
    log = journal.file_log(spark, f"{base}/log", events.schema, 1)
    jobs = {"good": lambda rows: rows.where("event_type <> 'error'").groupBy("user_id").agg(F.max("event_id").alias("last_event"), F.count(F.lit(1)).alias("n"))}
    journal.run_indexers(log, jobs, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{base}/out/good")
    return rows.groupBy("user_id").agg(F.max("last_event").alias("last_event"), F.sum("n").alias("n"))


@query("select event_id as id, event_type as mimetype from events")
def streamed_index(spark, sf_dir):
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("mimetype"))
    events.repartition(5, "id").write.parquet(f"{base}/log")
    log = journal.file_log(spark, f"{base}/log", "id long, mimetype string", 1)
    journal.run_indexers(log, {"mimetype": lambda rows: rows}, f"{base}/out", f"{base}/checkpoint", index={"mimetype": ["id"]}).awaitTermination()
    return journal.read_index(spark, f"{base}/out", "mimetype", ["id"])


@query(SQL_EXTRINSIC)
def streamed_extrinsic(spark, sf_dir):
    """Forge records from the log, oldest first; of an origin's rows the latest batch's stays."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    records, known = remd(spark, sf_dir), known_forge_origins(spark, sf_dir)
    files = 1 + read(spark, sf_dir, "customer").count() // 25_000  # of each month
    for month in (1, 2):
        records.where(F.month("discovery_date") == month).repartition(files).write.mode("append").parquet(f"{base}/log")
    log = journal.file_log(spark, f"{base}/log", records.schema, files)
    journal.run_indexers(log, {"extrinsic": lambda rows: pipelines.origin_extrinsic_metadata(rows, known)}, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return journal.read_index(spark, f"{base}/out", "extrinsic", ["id"])


@query("""select 'contents' as job, user_id, count(*) as n, max(event_id) as last from events where event_id % 3 = 0 and event_id % 13 > 0 group by 2
    union all select 'origins', user_id, count(*), max(event_id) from events where event_id % 3 = 1 and event_id % 13 > 0 group by 2
    union all select 'unreadable', null, count(*), null from events where event_id % 3 < 2 and event_id % 13 = 0""")
def streamed_topics(spark, sf_dir):
    """A log of three topics, two of them subscribed; each job gets its own topic's objects, and
    every thirteenth message is broken."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    value = F.to_json(F.struct(F.col("event_id").alias("id"), "user_id"))
    topic = F.concat(F.lit("log."), bridge.pick(["content", "origin", "other"], F.col("event_id") % 3))
    sent = F.when(F.col("event_id") % 13 > 0, value).otherwise(F.expr("left(to_json(struct(event_id)), 5)")).cast("binary")
    read(spark, sf_dir, "events").select(topic.alias("topic"), sent.alias("value")).repartition(3).write.parquet(f"{base}/log")
    count = lambda rows: rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    types, kinds = {"contents": ("content", count), "origins": ("origin", count)}, {"content": "id long, user_id long", "origin": "id long, user_id long"}
    log = journal.subscribed(journal.file_log(spark, f"{base}/log", "topic string, value binary", 1), "log", journal.topics_of({name: [t] for name, (t, _) in types.items()}, list(types)))
    jobs = journal.by_topic(types, "log", kinds) | {"unreadable": lambda rows: journal.unreadable(rows).agg(F.count(F.lit(1)).alias("n"))}
    journal.run_indexers(log, jobs, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    told = [spark.read.parquet(f"{base}/out/{name}").groupBy("user_id").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(F.lit(name).alias("job"), "user_id", "n", "last") for name in types]
    broken = spark.read.parquet(f"{base}/out/unreadable").agg(F.sum("n").alias("n")).select(F.lit("unreadable").alias("job"), F.lit(None).cast("long").alias("user_id"), "n", F.lit(None).cast("long").alias("last"))
    return told[0].unionByName(told[1]).unionByName(broken)


@query("""select 'good' as job, 3 as batches, count(*) filter (event_type <> 'error') as added, 'eventful' as status from events
    union all select 'changes', 3, count(*), 'eventful' from events union all select 'broken', 3, 0, 'failed'""")
def stream_status(spark, sf_dir):
    """What each job of a stream reports, with an additions log and a job that always fails."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = read(spark, sf_dir, "events")
    events.repartition(3, "event_id").write.parquet(f"{base}/log")
    log = journal.file_log(spark, f"{base}/log", events.schema, 1)
    jobs = {"good": lambda rows: rows.where("event_type <> 'error'"), "broken": lambda rows: rows.select(F.raise_error(F.lit("no tool")).alias("x"))}
    changes = {"changes": lambda rows: rows.select(F.to_json(F.struct("event_id", "event_type")).alias("message"))}
    journal.run_indexers(log, jobs, f"{base}/out", f"{base}/checkpoint", changes).awaitTermination()
    return journal.status(spark, f"{base}/out").groupBy("job", "status").agg(F.countDistinct("batch").cast("int").alias("batches"), F.sum("added").alias("added"))


@query("""select sha1('https://f.org/' || c_custkey) as key, case when c_custkey % 13 <> 0 then 'https://f.org/' || c_custkey end as url, c_custkey as customer,
    case when c_custkey % 13 <> 0 then 'resolved' else 'dead' end as status from customer""")
def late_records(spark, sf_dir):
    """A record of every customer's repository comes first. Two batches later come the origins that
    there are; the other records are given up after six tries."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    told = read(spark, sf_dir, "customer")
    files = 1 + told.count() // 500_000  # of each batch
    customers = spread(told, "c_custkey").select("c_custkey", F.concat(F.lit("https://f.org/"), F.col("c_custkey").cast("string")).alias("url"))
    records = customers.select(F.sha1(F.col("url").cast("binary")).alias("target"), F.col("c_custkey").alias("customer"))
    known = customers.where("c_custkey % 13 <> 0").select("url")
    idle = waiting.events(records.limit(0), spark.range(files).coalesce(1).select(F.concat(F.lit("https://f.org/other/"), F.col("id").cast("string")).alias("url")))
    for part in (waiting.events(records, known.limit(0)), idle, waiting.events(records.limit(0), known), *[idle] * 6):
        part.repartition(files).write.mode("append").parquet(f"{base}/log")
    found = waiting.resolve(journal.file_log(spark, f"{base}/log", waiting.EVENT, files), tries=6, every_ms=1)
    with waiting.without_idle_batches(spark):
        stream = found.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
    stream.awaitTermination()
    rows = spark.read.schema(waiting.OUT).parquet(f"{base}/out")
    return rows.select("key", "url", F.from_json("record", "customer long")["customer"].alias("customer"), "status")


QUERIES, ORACLES = query.queries, query.oracles
