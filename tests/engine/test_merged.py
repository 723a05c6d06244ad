"""Documents of many groups: merged as one row each, and in one exchange for each directory."""

import random

from pyspark.sql import functions as F

from metalake.operators import graph, props
from metalake.plans import pipelines
from metalake.plans.lineage import weighed_join, written


def test_merged_documents_are_what_compact_makes_of_merge(spark):
    r = random.Random(7)
    odd = ['a', 'b "q"', "", "https://x/1", "https://x/2", None, "é\\"]
    kinds = {"id": ["uri", "number"], "author": ["object", "literal"], "license": ["uri", "literal"], "name": ["literal", "date"], "type": ["type"], "as:totalItems": ["number"], "forge:forks": ["literal"], "sameAs": ["literal", "uri"]}
    rows = []
    for d in range(120):
        for pos in range(r.randrange(6)):
            prop = r.choice(list(kinds))
            kind = r.choice(kinds[prop])
            value = str(r.randrange(3)) if kind == "number" else '{"name":"n%d"}' % r.randrange(4) if kind == "object" else r.choice(odd)
            rows.append((f"d{d}", prop, kind, pos // 2, value))
    told = written(spark.createDataFrame(rows, "doc_id string, prop string, kind string, pos int, value string"), "told")
    member = [(f"g{r.randrange(40)}", r.choice("abc"), f"d{d}") for d in range(120) for _ in range(3)]
    groups = written(spark.createDataFrame(member, "group string, rank string, doc_id string").distinct(), "groups")
    want = props.compact(props.merge(told, groups))
    docs = groups.join(props.entries(told), "doc_id", "left").groupBy("group").agg(F.collect_list(F.struct("rank", "entries")).alias("docs"))
    got = props.merged_documents(docs.withColumn("docs", F.filter("docs", lambda d: d["entries"].isNotNull()))).where("metadata is not null")
    made = {row.group: row.metadata for row in got.collect()}
    assert len(made) > 30 and made == {row.doc_id: row.metadata for row in want.collect()}


def test_directories_meet_their_documents_in_one_exchange(spark):
    entries = spark.createDataFrame([(1, 1, "package.json", "file", "c1"), (1, 2, "CITATION.cff", "file", "c2"), (2, 1, "src", "dir", 1), (3, 1, "x", "file", "c1")], "dir_id long, pos int, name string, type string, target string")
    contents = spark.createDataFrame([("c1", "s1"), ("c2", "s2")], "sha1_git string, sha1 string")
    blobs = spark.createDataFrame([("s1", b'{"name":"n"}'), ("s2", b"title: [")], "sha1 string, data binary")
    found = pipelines.directory_metadata(entries.select("dir_id"), entries, contents, blobs).directories
    told = {row.id: (row.metadata, row.mappings) for row in found.collect()}
    both = (f'{{"@context":"{props.CONTEXT}","type":"SoftwareSourceCode","name":"n"}}', ["cff", "npm"])
    assert told == {1: both, 2: both, 3: (pipelines.EMPTY, [])}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Aggregate") <= 2 and "Window" not in plan


def test_first_files_and_lone_directories_come_from_one_aggregate(spark):
    rows = [(1, 1, "PACKAGE.json", "file", "a"), (1, 2, "package.json", "file", "b"), (1, 3, "pom.xml", "file", "c"), (2, 1, "src", "dir", "d"), (3, 1, "src", "dir", "d"), (3, 2, "pom.xml", "dir", "e"), (4, 1, "pom.xml", "file", None)]
    entries = spark.createDataFrame(rows, "dir_id long, pos int, name string, type string, target string")
    told = {r.dir_id: (r.truncated, r.inner, [tuple(h) for h in r.hits]) for r in graph.searched(entries, graph.FILE_RULES, 2).collect()}
    assert told == {1: (True, None, [("npm", "a")]), 2: (False, "d", []), 3: (False, None, []), 4: (False, None, [])}


def test_hot_keys_stay_where_they_are(spark):
    left = spark.range(60_000).select(F.when(F.col("id") < 50_000, 0).otherwise(F.col("id")).alias("k"), "id")
    right = written(left.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") + 1), "right")
    got = weighed_join(left, right, ["k"], "n")
    assert got.count() == 60_000 and got.where("v <> k + 1").isEmpty() and "Union" in got._jdf.queryExecution().optimizedPlan().toString()


def test_branches_of_origins_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    schema = "snapshot long, name string, target_type string, target string"
    rows = [(1, "HEAD", "alias", "master"), (1, "master", "revision", "r1"), (2, "a-1.0.zip", "release", "t1"), (2, "HEAD", "alias", "HEAD")]
    branches = spark.createDataFrame(rows, schema).coalesce(1).mapInArrow(told, schema)
    visits = spark.createDataFrame([("u1", 1, 5, "git", "full", 1), ("u2", 2, 5, "ftp", "full", 2)], "origin string, visit long, date long, type string, status string, snapshot long")
    entries = spark.createDataFrame([(7, 1, "package.json", "file", "c1"), (8, 1, "src", "dir", 7)], "dir_id long, pos int, name string, type string, target string")
    found = pipelines.origin_intrinsic_metadata(
        visits.select(F.col("origin").alias("url")), visits, branches, spark.createDataFrame([("r1", 7)], "id string, directory long"),
        spark.createDataFrame([("t1", "directory", 8)], "id string, target_type string, target long"), entries,
        spark.createDataFrame([("c1", "s1")], "sha1_git string, sha1 string"), spark.createDataFrame([("s1", b'{"name":"n"}')], "sha1 string, data binary"),
    )
    text = f'{{"@context":"{props.CONTEXT}","type":"SoftwareSourceCode","name":"n"}}'
    assert {(r.id, r.from_directory, r.metadata) for r in found.origins.collect()} == {("u1", 7, text), ("u2", 8, text)}
    assert made.value == len(rows)
