"""Memory of tasks that hand whole texts to Python: rows at a time, words kept."""

import pyarrow as pa

from metalake.llm import common, packing

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_small_batches_are_handed_over_and_the_option_is_put_back(spark):
    before = spark.conf.get(NAME)
    with common.small_batches(spark, 1000):
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(lambda bs: (b.slice(0, 1).set_column(0, "n", pa.array([b.num_rows])) for b in bs), "n long").collect()
    assert [r.n for r in sizes] == [1000] * 5 and spark.conf.get(NAME) == before


def test_packing_reads_texts_in_small_batches(spark, monkeypatch):
    seen, write = [], packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda df, tag: seen.append(int(spark.conf.get(NAME))) or write(df, tag))
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    assert packing.pack(docs, packing.tokenizer_path()).count() == 20
    assert seen == [1000] and spark.conf.get(NAME) != "1000"


def test_a_worker_keeps_few_words_and_encodes_the_rest_again():
    words = packing.WordIds(packing.tokenizer_path())
    assert words.most <= 250_000
    words.most = 2
    assert [words[w] for w in ("one", " two", " three", " three", "one")] == [words[w] for w in ("one", " two", " three", " three", "one")]
    assert len(words) == 2
