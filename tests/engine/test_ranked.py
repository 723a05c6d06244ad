"""Best matches by blocks: equal to ranking everything, and most blocks stay closed."""

import pytest
from pyspark.sql import functions as F

from metalake.operators import search
from metalake.plans import ranked


@pytest.fixture(scope="module")
def rows(spark):
    """3000 documents of 1 to 60 tokens: one token in all of them, some in few, many of one length."""
    n = F.when(F.col("id") % 3 == 0, 7).otherwise(1 + F.col("id") * 7919 % 60).cast("int")
    word = lambda i: F.concat(F.lit("w"), ((F.col("id") * 31 + i * i) % 40).cast("string"))
    more = F.transform(F.sequence(F.lit(1), n), word)
    rare = F.when(F.col("id") % 500 == 1, F.array(F.lit("rare"), F.lit("rare"))).otherwise(F.array().cast("array<string>"))
    tokens = F.concat(F.array(F.lit("all")), more, rare)
    some = spark.range(3000).select(F.format_string("%05d", "id").alias("id"), F.when(F.col("id") % 100 > 0, tokens).otherwise(F.array().cast("array<string>")).alias("tokens"))
    return some.unionByName(spark.createDataFrame([(None, ["all", "w1"]), ("null", None)], "id string, tokens array<string>")).where("id is not null").cache()


@pytest.fixture(scope="module")
def path(spark, rows, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('ranked')}/index"
    ranked.build(rows, path, 100)
    return path


@pytest.mark.parametrize("terms", [["all"], ["all w3"], ["w3", "W5"], ["rare"], ["rare all", "w1"], ["nothing"], ["all nothing"], [], ["..."]])
@pytest.mark.parametrize("limit", [1, 25, 5000])
def test_equals_full_text(spark, rows, path, terms, limit):
    if not terms or terms == ["..."]:
        assert ranked.full_text(spark, path, terms or [""], limit).count() == 0
        return
    want = [(r.id, r["rank"]) for r in search.full_text(rows, terms, limit).select("id", "rank").collect()]
    assert [(r.id, r["rank"]) for r in ranked.full_text(spark, path, terms, limit).collect()] == want


def test_blocks_of_long_documents_stay_closed(spark, rows, path):
    blocks = ranked.read_postings(spark, path).select("block").distinct().count()
    assert 25 <= blocks <= 40
    terms = spark.createDataFrame([("a", "all"), ("b", "all"), ("b", "w3"), ("b", "w3"), ("c", "rare"), ("d", "gone"), ("e", None)], "query_id string, token string")
    found, opened = ranked.best(spark, path, terms, 5, first=2)
    assert {r.query_id: r.n for r in found.groupBy("query_id").agg(F.count("*").alias("n")).collect()} == {"a": 5, "b": 5, "c": 5}
    assert opened <= 2 + 14 + 6 < blocks
    with pytest.raises(ValueError):
        ranked.best(spark, path, terms, 0)


def test_blocks_hold_about_as_many_documents(spark, rows, path):
    sizes = [r.n for r in ranked.read_postings(spark, path).groupBy("block").agg(F.count_distinct("id").alias("n")).collect()]
    assert sum(sizes) == rows.where(F.size("tokens") > 0).count() and max(sizes) <= 160  # a third has one length


def test_an_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    ranked.build(spark.createDataFrame([], "id string, tokens array<string>"), path)
    assert ranked.full_text(spark, path, ["all"]).count() == 0


def test_searches_by_signature_equal_searches_by_postings(spark, rows):
    terms = spark.createDataFrame([("a", "all"), ("b", "all"), ("b", "w3"), ("b", "w3"), ("c", "rare"), ("c", "w12"), ("d", "all"), ("d", "gone"), ("e", None), ("f", "w1"), ("f", "w2"), ("f", "rare")], "query_id string, token string")
    index = search.postings(rows)
    want, got = search.search_postings(index, terms), search.search_postings(index, terms, docs=rows)
    assert want.count() > 3000 and got.count() == want.count() and got.exceptAll(want.select(got.columns)).isEmpty()
