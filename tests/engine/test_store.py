"""Index tables at rest: ranges that are rewritten, commits, failed runs, pages, clean-up."""

import pytest
from pyspark.sql import functions as F

from metalake import schemas
from metalake.operators import tables
from metalake.plans.store import CommitConflict, Store

TOOLS = "id long, tool_name string, tool_version string, tool_configuration string"
ROW = "id string, metadata string, tool_id long"


@pytest.fixture
def store(spark, tmp_path):
    tools = spark.createDataFrame([(1, "t", "1", "{}"), (2, "t", "2", "{}")], TOOLS)
    return Store(spark, f"file://{tmp_path}/s", tools, 100)


def rows_of(store, name):
    return sorted((r.id, r.metadata) for r in store.table(name).collect())


def mimetypes(spark, ids, mimetype="text/plain", tool=1):
    return spark.createDataFrame([(f"{i:06d}", mimetype, "utf-8", tool) for i in ids], schemas.TABLES["content_mimetype"])


def test_store_keeps_tables_whole(spark, store):
    rows = spark.createDataFrame([("a", '{"name":"x\\u0000 Y"}', 1), ("b", "{}", 1)], ROW)
    told = store.add({"content_metadata": rows, "origin_intrinsic": rows})
    assert {(r.name, r.added, r.status) for r in told.collect()} == {("content_metadata", 2, "eventful"), ("origin_intrinsic", 2, "eventful")}
    assert {r.id: r.tokens for r in store.table("origin_intrinsic").collect()} == {"a": ["x", "y"], "b": []}
    again = spark.createDataFrame([("a", '{"name":"z"}', 1)], ROW)
    store.add({"content_metadata": again})
    store.add({"content_metadata": again})
    assert rows_of(store, "content_metadata") == [("a", '{"name":"z"}'), ("b", "{}")] and store.version("content_metadata") == 3
    assert store.changes().count() == 6 and "\\u0000" in "".join(r.message for r in store.changes().collect())
    assert store.run(lambda: {"content_metadata": again.limit(0)}).first().status == "uneventful"


def test_failed_runs_leave_neither_rows_nor_log(spark, store):
    good = mimetypes(spark, range(3))
    licenses = spark.createDataFrame([("a", "MIT", 1)], schemas.TABLES["content_license"])
    twice = store.run(lambda: {"content_mimetype": good, "content_license": licenses.union(licenses)}).first()
    assert twice.status == "failed" and twice.error.startswith("DuplicateId")
    broken = store.run(lambda: {"content_mimetype": good, "content_license": licenses.selectExpr("raise_error('x') as id")}).first()
    nulls = store.run(lambda: {"content_mimetype": good.withColumn("id", F.lit(None).cast("string"))}).first()
    assert broken.status == nulls.status == "failed" and store.changes().count() == 0 and store.table("content_mimetype").count() == 0
    store.add({"content_mimetype": good, "content_license": licenses})
    assert store.changes().count() == 4 and store.table("content_license").count() == 1


def test_only_touched_ranges_are_rewritten(spark, store):
    store.add({"content_mimetype": mimetypes(spark, range(0, 6400, 2))})
    before = store.parts("content_mimetype")
    assert len(before) >= 24 and sum(p.rows for p in before) == 3200 and all(a.high < b.low for a, b in zip(before, before[1:]))
    store.add({"content_mimetype": mimetypes(spark, [3000], "image/png")})
    after = store.parts("content_mimetype")
    assert len({p.path for p in after} - {p.path for p in before}) == 1 and len({p.path for p in before} - {p.path for p in after}) == 1
    fresh = mimetypes(spark, [-1, 1, 3000, 6399, 9999], "image/gif").unionByName(mimetypes(spark, [3000], "image/gif", 2))
    want = tables.upsert(store.table("content_mimetype"), fresh, schemas.KEYS["content_mimetype"])
    want = sorted(map(tuple, want.collect()))
    store.add({"content_mimetype": fresh})
    assert sorted(map(tuple, store.table("content_mimetype").collect())) == want and len(want) == 3205
    last = store.parts("content_mimetype")
    assert len({p.path for p in after} - {p.path for p in last}) == 3 and all(a.high < b.low for a, b in zip(last, last[1:]))


def test_random_batches_equal_upserts(spark, store):
    store.rows_per_file = 7
    held = spark.createDataFrame([], schemas.TABLES["content_mimetype"])
    for step in range(4):
        batch = mimetypes(spark, {(k * 37 + step * 11) % 60 for k in range(12)}, f"type/{step}", step % 2 + 1)
        held = spark.createDataFrame(tables.upsert(held, batch, ["id", "tool_id"]).collect(), held.schema)
        store.add({"content_mimetype": batch})
        assert sorted(map(tuple, store.table("content_mimetype").collect())) == sorted(map(tuple, held.collect()))


def test_licenses_keep_what_is_there(spark, store):
    kind = schemas.TABLES["content_license"]
    store.add({"content_license": spark.createDataFrame([("a", "MIT", 1), ("b", "MIT", 1)], kind)})
    store.add({"content_license": spark.createDataFrame([("a", "MIT", 1), ("a", "ISC", 1)], kind)})
    assert sorted(map(tuple, store.table("content_license").collect())) == [("a", "ISC", 1), ("a", "MIT", 1), ("b", "MIT", 1)]


def test_ranges_and_pages_open_few_files(spark, store):
    store.add({"content_mimetype": mimetypes(spark, range(2000))})
    part = store.between("content_mimetype", "000500", "000520")
    assert part.count() == 20 and len(part.inputFiles()) <= 2
    token, seen, pages = "", [], 0
    while token is not None:
        page, token = store.page("content_mimetype", token, 300)
        seen, pages = seen + [r.id for r in page.collect()], pages + 1
    assert seen == [f"{i:06d}" for i in range(2000)] and pages == 7
    opened = []
    read = store.read
    store.read = lambda name, parts: (opened.append(len(parts)), read(name, parts))[1]
    assert store.page("content_mimetype", "001200", 50)[1] == "001250" and sum(opened) <= 2
    only, more = store.page("content_mimetype", "", 50, tool_ids=[2])
    assert only.count() == 0 and more is None


def test_of_two_writers_one_wins(spark, store):
    store.add({"content_mimetype": mimetypes(spark, [1])})
    with pytest.raises(CommitConflict):
        store._commit(1, {"content_mimetype": {"manifest": "none", "added": 0}})
    assert store.version("content_mimetype") == 1 and store.table("content_mimetype").count() == 1


def test_compaction_and_vacuum(spark, store):
    for i in range(4):
        store.add({"content_mimetype": mimetypes(spark, range(i * 1000, i * 1000 + 250))})
    rows = sorted(map(tuple, store.table("content_mimetype").collect()))
    store.rows_per_file = 600
    files = len(store.parts("content_mimetype"))
    assert store.compact("content_mimetype") > 0 and len(store.parts("content_mimetype")) < files
    assert sorted(map(tuple, store.table("content_mimetype").collect())) == rows and store.compact("content_mimetype") == 0
    store.run(lambda: {"content_mimetype": mimetypes(spark, [5]).union(mimetypes(spark, [5]))})
    assert store.vacuum(1) > 0 and sorted(map(tuple, store.table("content_mimetype").collect())) == rows
    assert store.vacuum(1) == 0 and store.changes().count() == 1000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_open_few_files_and_leave_the_table_where_it_is(spark, store):
    assert store.having("content_mimetype", spark.createDataFrame([("a",)], "id string")).count() == 0
    store.add({"content_mimetype": mimetypes(spark, range(0, 6400, 2))})
    ids = spark.createDataFrame([(f"{i:06d}",) for i in (10, 11, 12, 12, 3000, 999999)] + [("",), (None,)], "id string")
    rows = store.having("content_mimetype", ids)
    assert sorted(r.id for r in rows.collect()) == ["000010", "000012", "003000"]
    assert len(rows.inputFiles()) <= 3 and "BroadcastHashJoin" in plan_of(rows) and "hashpartitioning" not in plan_of(rows)
    many = store.having("content_mimetype", ids, most=2)
    assert sorted(r.id for r in many.collect()) == ["000010", "000012", "003000"]
    wanted = mimetypes(spark, [10, 11, 3000]).unionByName(mimetypes(spark, [3000], tool=2)).select("id", "tool_id")
    assert sorted(map(tuple, store.missing("content_mimetype", wanted).collect())) == [("000011", 1), ("003000", 2)]
