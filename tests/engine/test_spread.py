"""Queries over compact files: their work is dealt to many tasks."""

from pyspark.sql import functions as F

from metalake.operators import formats as jobs
from metalake.plans.lineage import spread
from metalake.queries import formats, relational


def test_rows_of_one_row_group_are_dealt_to_many_tasks(spark, tmp_path):
    base = f"file://{tmp_path}"
    keys = spark.range(25_000).coalesce(1)
    keys.select(F.col("id").alias("p_partkey")).write.parquet(f"{base}/part.parquet")
    keys.select(F.col("id").alias("c_custkey"), F.lit(1.5).alias("c_acctbal")).write.parquet(f"{base}/customer.parquet")
    for rows in (formats.parts(spark, base), formats.customers(spark, base)):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 25_000 and max(sizes) < 10_000
    assert spread(keys, per_task=25_000) is keys


def test_files_of_the_search_tables_grow_with_the_documents(spark, tmp_path):
    base = f"file://{tmp_path}"
    text = F.concat(F.lit("the a"), F.col("id").cast("string"))
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.length(text).alias("n_chars"))
    docs.coalesce(1).write.parquet(f"{base}/documents.parquet")
    rows = relational.searchable(spark, base)
    of_file = rows.groupBy(F.input_file_name()).agg(F.min("id").alias("least"), F.max("id").alias("last"), F.count("*").alias("n")).orderBy("least").collect()
    assert sum(r.n for r in of_file) == 100_000 and len(of_file) > 16
    assert all(a.last < b.least for a, b in zip(of_file, of_file[1:]))
    assert rows.where(F.array_contains("tokens", "a78")).count() == 1


def test_files_are_parsed_once_and_others_give_no_rows(spark):
    rows = [("a", b'{"html_url":"https://f.org/a","full_name":"a"}'), ("b", b'{"full_name":"b"}'), ("c", b"[1]"), ("d", b"{<")]
    files = spark.createDataFrame(rows, "doc_id string, data binary")
    found = jobs.github(files)
    assert {r.doc_id for r in found.collect()} == {"a"}
    assert jobs.cff(files.where("doc_id > 'b'")).isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils") <= 3
