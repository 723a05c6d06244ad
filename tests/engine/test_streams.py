"""Levelled index tables and records that wait for their origins."""

import math

from pyspark.sql import functions as F

from metalake.streaming import journal, waiting
from metalake.streaming.levels import Levels


def test_levels_keep_few_runs(spark, tmp_path):
    index = Levels(spark, f"file://{tmp_path}/index", ["id"], 1)
    assert index.read() is None
    held = {}
    for batch in range(11):
        rows = {(batch * 7 + k * 3) % 25: batch for k in range(6)}
        held |= rows
        assert index.add(spark.createDataFrame([(k, f"v{v}") for k, v in rows.items()], "id int, v string"), batch)
        assert len(index.runs()) == bin(batch + 1).count("1") <= 1 + math.log2(batch + 1)
    got = index.read()
    assert {r.id: r.v for r in got.collect()} == {k: f"v{v}" for k, v in held.items()} and got.columns == ["id", "v"]
    assert len(got.inputFiles()) <= 4
    assert not index.add(spark.createDataFrame([(1, "again")], "id int, v string"), 10) and not index.add(spark.createDataFrame([(1, "old")], "id int, v string"), 3)
    assert index.vacuum() > 0 and {r.id: r.v for r in index.read().collect()} == {k: f"v{v}" for k, v in held.items()} and index.vacuum() == 0


def test_a_stream_keeps_a_levelled_index(spark, tmp_path):
    base = f"file://{tmp_path}"
    for k in range(5):
        spark.range(k * 10, k * 10 + 20).select("id", F.lit(k).alias("v")).coalesce(1).write.mode("append").parquet(f"{base}/log")
    log = journal.file_log(spark, f"{base}/log", "id long, v int", 1)
    journal.run_indexers(log, {"x": lambda rows: rows}, f"{base}/out", f"{base}/check", index={"x": ["id"]}).awaitTermination()
    rows = journal.read_index(spark, f"{base}/out", "x", ["id"])
    assert rows.count() == 60 and rows.groupBy("v").count().orderBy("v").collect()[-1]["count"] == 20
    assert len(Levels(spark, f"{base}/out/_index/x", ["id"]).runs()) == 2


def test_records_wait_for_their_origins(spark, tmp_path):
    base = f"file://{tmp_path}"
    sha = lambda url: spark.range(1).select(F.sha1(F.lit(url).cast("binary"))).first()[0]
    late, never, early = (sha(f"https://{n}/") for n in ("late", "never", "early"))
    batches = [[(late, None, '{"n":1}'), (never, None, '{"n":2}'), (late, None, '{"n":3}'), (None, None, "{}")], [(early, "https://early/", None)], [(late, "https://late/", None), (early, None, '{"n":4}')]]
    batches += [[(f"filler{k}", None, "{}")] for k in range(8)]
    for rows in batches:
        spark.createDataFrame(rows, waiting.EVENT).coalesce(1).write.mode("append").parquet(f"{base}/log")
    log = journal.file_log(spark, f"{base}/log", waiting.EVENT, 1)
    found = waiting.resolve(log, tries=6, every_ms=1)
    with waiting.without_idle_batches(spark):
        query = found.writeStream.format("parquet").option("checkpointLocation", f"{base}/check").option("path", f"{base}/out").trigger(availableNow=True).start()
    query.awaitTermination(120)
    query.stop()
    rows = spark.read.schema(waiting.OUT).parquet(f"{base}/out").where("key not like 'filler%'")
    got = {r.record: (r.key, r.url, r.status) for r in rows.collect()}
    assert got == {'{"n":1}': (late, "https://late/", "resolved"), '{"n":3}': (late, "https://late/", "resolved"), '{"n":4}': (early, "https://early/", "resolved"), '{"n":2}': (never, None, "dead")}
    assert {r.status: r.tries for r in rows.where("record in ('{\"n\":1}', '{\"n\":2}')").collect()} == {"resolved": 2, "dead": 6} or rows.where("status = 'dead'").first().tries == 6
    resolved, dead = waiting.split(rows, "n int")
    assert sorted((r.n, r.url) for r in resolved.collect()) == [(1, "https://late/"), (3, "https://late/"), (4, "https://early/")] and [(r.n, r.tries) for r in dead.collect()] == [(2, 6)]


def test_hot_keys_are_joined_without_their_shuffle(spark):
    from metalake.plans.lineage import hot_joined, written

    left = written(spark.range(60_000).select("id", F.when(F.col("id") % 3 > 0, F.lit("licence")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key")), "left")
    right = spark.createDataFrame([("licence", 1), ("licence", 2), *((f"k{i}", i) for i in range(0, 500, 2))], "key string, v int")
    got, want = hot_joined(left, right, "key"), left.join(right, "key")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and hot_joined(left, right, "key", most=1).count() == want.count()


def test_topics_reach_their_own_jobs(spark):
    rows = [("p.a", '{"id": 1, "x": "é"}'), ("p.a", '{"id": "no"}'), ("p.b", '{"id": 2}'), ("p.a", "{"), ("p.a", "[1]"), ("p.a", ""), ("p.a", None), ("p.c", '{"id": 3}'), (None, "{}")]
    log = journal.subscribed(spark.createDataFrame(rows, "topic string, value string").selectExpr("topic", "cast(value as binary) as value"), "p", ["a", "b"])
    jobs = journal.by_topic({"one": ("a", lambda r: r), "two": ("b", lambda r: r.selectExpr("id + 1 as id"))}, "p", {"a": "id long, x string", "b": "id long"})
    assert sorted(map(tuple, jobs["one"](log).collect()), key=str) == [(1, "é"), (None, None)] and [r.id for r in jobs["two"](log).collect()] == [3]
    assert sorted((r.topic, r.value or "") for r in journal.unreadable(log).collect()) == [("p.a", ""), ("p.a", ""), ("p.a", "[1]"), ("p.a", "{")]


def test_waiting_records_are_called_by_bucket(spark, tmp_path):
    """A batch calls the step once for a bucket: the state has as many rows as buckets, not keys."""
    base = f"file://{tmp_path}"
    keys = spark.range(600).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.lit(None).cast("string").alias("url"), F.col("id").cast("string").alias("record"))
    origins = keys.where("key like '%7'").select("key", F.col("key").alias("url"), F.lit(None).cast("string").alias("record"))
    idle = spark.createDataFrame([("filler", None, "{}")], waiting.EVENT)
    for part in (keys, origins, *[idle] * 7):
        part.coalesce(1).write.mode("append").parquet(f"{base}/log")
    found = waiting.resolve(journal.file_log(spark, f"{base}/log", waiting.EVENT, 1), tries=6, every_ms=1, buckets=8)
    with waiting.without_idle_batches(spark):
        query = found.writeStream.format("parquet").option("checkpointLocation", f"{base}/check").option("path", f"{base}/out").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 8
    rows = spark.read.schema(waiting.OUT).parquet(f"{base}/out").where("key <> 'filler'").groupBy("status", "tries", F.col("url").isNull().alias("lost")).count().collect()
    assert sorted(map(tuple, rows)) == [("dead", 6, True, 540), ("resolved", 1, False, 60)]
