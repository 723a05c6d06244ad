"""Searches by packs: equal to a search of every document, whatever the packs, and nothing is shuffled for them."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from metalake.operators import packed, search
from metalake.plans import lineage, ranked
from metalake.queries import relational


@pytest.fixture(scope="module")
def docs(spark):
    """Ids of UTF-8 above and below each other, tokens that repeat, one document without any, one without id."""
    rows = [(f"d{i:03d}" if i % 5 else f"é{i}", [f"w{(i * j) % 11}" for j in range(1, 2 + i % 17)] + ["all"] * (i % 3)) for i in range(150)]
    return spark.createDataFrame([*rows, ("none", []), ("null", None), (None, ["all", "w1"])], "id string, tokens array<string>")


TERMS = [("a", "all"), ("b", "all"), ("b", "w3"), ("b", "w3"), ("c", "w1"), ("c", "w2"), ("c", "w9"), ("d", "all"), ("d", "gone"), ("e", None), ("f", "w5"), ("f", None), ("g", ""), ("h", "ALL")]


@pytest.mark.parametrize(("most_docs", "most_tokens", "most_asked", "at_once"), [(5000, 10**6, 10**6, 10**6), (7, 40, 3, 5), (1, 1, 1, 1), (1000, 100, 2, 50)])
def test_any_packs_find_the_same(spark, docs, monkeypatch, most_docs, most_tokens, most_asked, at_once):
    for name, value in (("MOST_DOCS", most_docs), ("MOST_TOKENS", most_tokens)):
        monkeypatch.setattr(packed, name, value)
    held = [(r.id, r.tokens) for r in docs.collect() if r.id is not None and r.tokens]
    want = {}
    for query in {q for q, _ in TERMS}:
        asked = {t for q, t in TERMS if q == query}
        for id_, tokens in held:
            if asked <= set(tokens):
                want[query, id_] = (len(tokens), sum(t in asked for t in tokens))
    batches = docs.where("id is not null and size(tokens) > 0").select("id", F.size("tokens").alias("n"), packed.joined(F.col("tokens")).alias("tokens"), F.lit(0).cast("long").alias("place")).toArrow().to_batches()
    packs = [packed.docs_pack(held, None) for held in packed.cut(batches, "n", most_docs, most_tokens)]
    assert sum(p["docs"][0].as_py() for p in packs) == len(held) and (most_docs > 1 or len(packs) == len(held))
    monkeypatch.setattr(packed, "AT_ONCE", at_once)
    terms = spark.createDataFrame(TERMS, "query_id string, token string")
    searches = packed.pack_searches(packed.gathered(terms), most=most_asked).toArrow().combine_chunks().to_batches()[0]
    got = {}
    for p in packs:
        for row in range(searches.num_rows):
            mine, asked = packed.Docs(*[p[c][0].as_py() for c in ("words", "posts", "rows")]), packed.Searches(*[searches[c][row].as_py() for c in ("asked_words", "asked", "names")])
            met = packed.Met(mine, asked)
            rare = met.code[met.at]
            for who, doc, hits in packed.narrowed(mine, met, met.query * 0 + range(len(rare)), mine.start[rare], mine.df[rare].astype("int64")):
                for w, d, h in zip(who, doc, hits, strict=True):
                    key = asked.ids[int(met.query[w])].as_py(), mine.ids[int(d)].as_py()
                    assert key not in got
                    got[key] = (int(mine.n[d]), int(h))
    assert got == want and len(want) > 100


def test_ids_and_queries_keep_their_types(spark, docs):
    numbered = docs.where("id is not null").withColumn("id", F.monotonically_increasing_id())
    terms = spark.createDataFrame([(7, "all"), (7, "w2"), (None, "w9")], "query_id long, token string")
    found = search.search_postings(None, terms, docs=numbered)
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "double"]
    want = numbered.where(F.array_contains("tokens", "all") & F.array_contains("tokens", "w2")).select("id")
    got = found.where("query_id = 7").select("id")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_no_words_and_no_documents(spark, docs):
    empty = spark.createDataFrame([], "query_id string, token string")
    assert search.search_postings(None, empty, docs=docs).isEmpty()
    asked = spark.createDataFrame([("a", "all")], "query_id string, token string")
    assert search.search_postings(None, asked, docs=docs.where("false")).isEmpty()


def test_neither_postings_nor_candidates_are_shuffled(spark):
    plan = relational.search_by_postings(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "CartesianProduct" in plan


@pytest.fixture(scope="module")
def many(spark):
    """600 documents that all hold five words, some of them often, in twenty blocks or more."""
    word = F.when(F.col("i") < 5, F.concat(F.lit("w"), F.col("i").cast("string"))).otherwise(F.concat(F.lit("w"), (F.col("id") * F.col("i") % 7).cast("string")))
    rows = spark.range(600).select("id", F.explode(F.sequence(F.lit(0), 5 + F.col("id") % 40)).alias("i"))
    return rows.groupBy(F.format_string("%03d", "id").alias("id")).agg(F.collect_list(word).alias("tokens")).cache()


@pytest.mark.parametrize(("most_docs", "most_tokens", "limit"), [(5000, 10**6, 1), (60, 10**6, 3), (30, 10**6, 1), (5000, 500, 7)])
def test_best_matches_write_few_rows(spark, many, tmp_path, monkeypatch, most_docs, most_tokens, limit):
    """The tables on the way hold some rows for each search, not one for each search and block."""
    monkeypatch.setattr(packed, "MOST_DOCS", most_docs)
    monkeypatch.setattr(packed, "MOST_TOKENS", most_tokens)
    path, rows = f"file://{tmp_path}/index", []
    ranked.build(many, path, 30)
    blocks = ranked.read_postings(spark, path).select("block").distinct().count()

    def counted(df, *more):
        out = lineage.written(df, *more)
        rows.append(out.count())
        return out

    monkeypatch.setattr(ranked, "written", counted)
    searches = {f"{a} {b}": [f"w{a}", f"w{b}"] for a in range(7) for b in range(7)}
    found, _ = ranked.best(spark, path, spark.createDataFrame([(q, t) for q, terms in searches.items() for t in terms], "query_id string, token string"), limit)
    got = {}
    for r in found.orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.id, r["rank"]))
    for q in ("0 1", "3 3", "4 6", "6 5", "2 0"):
        assert got[q] == [(r.id, r["rank"]) for r in search.full_text(many, searches[q], limit).collect()]
    assert blocks >= 20 and max(rows) <= len(searches) * limit * 13 < len(searches) * limit * blocks


def test_rows_of_one_id_and_length_are_one_document(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["x", "y", "x"]), ("a", ["x", "z", "z"]), ("a", ["x"]), ("b", ["y", "x", "z"])], "id string, tokens array<string>")
    ranked.build(rows, f"file://{tmp_path}/index", 2)
    got = {(r.token, r.id, r.n): r.tf for r in ranked.read_postings(spark, f"file://{tmp_path}/index").collect()}
    assert got == {("x", "a", 3): 3, ("y", "a", 3): 1, ("z", "a", 3): 2, ("x", "a", 1): 1, ("x", "b", 3): 1, ("y", "b", 3): 1, ("z", "b", 3): 1}


def test_ranks_are_rounded_as_by_spark(spark):
    values = [0.0, 0.1234565, 0.1234575, 2.0000005, 1.0000015, 0.9999995, 17.1234564999999, 3 / 7, 5.0]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 6)).collect()]
    assert [x / 1e6 for x in packed.millionths(np.array(values))] == want


def test_documents_are_dealt_before_their_tokens_are_made(spark, monkeypatch):
    """A file of few row groups is few tasks; nothing but reading may happen there."""
    monkeypatch.setattr(packed, "MOST_DOCS", 50)
    plan = packed.pack(relational.token_rows(spark, SF))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "regexp_extract_all" in above and "regexp_extract_all" not in below and "to_json" not in below
