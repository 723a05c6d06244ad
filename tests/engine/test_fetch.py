"""Fetching in batches: single bad objects cost their batch nothing."""

import pytest
from pyspark.sql import functions as F

from metalake.operators import fetch


@pytest.fixture
def source():
    """Fails for multiples of 10 and for batches with one; has no odd multiples of 3; 7 comes as None."""

    def ask(rows):
        for r in rows:
            if r["id"] % 10 == 0:
                raise KeyError(r["id"])
            if r["id"] == 7:
                yield None
            elif r["id"] % 6 != 3:
                yield {"id": r["id"], "name": f"{r['kind']}{r['id']}"}

    return ask


@pytest.mark.parametrize("batch_size", [1, 7, 1000])
def test_bad_objects_are_told_and_the_rest_is_kept(spark, source, batch_size):
    args = spark.range(1, 101).withColumn("kind", F.lit("x")).repartition(3)
    answers = fetch.fetched(args, source, "id long, name string", batch_size).cache()
    want = {i for i in range(1, 101) if i % 10 and i % 6 != 3 and i != 7}
    assert sorted((r.id, r.name) for r in fetch.results(answers).collect()) == sorted((i, f"x{i}") for i in want)
    bad = fetch.failures(answers).collect()
    assert {r.id for r in bad} == set(range(10, 101, 10)) and {r.error for r in bad if r.id == 20} == {"KeyError: 20"} and bad[0].kind == "x"
    assert {r.id for r in fetch.not_there(args, answers, "id").collect()} == {i for i in range(1, 101) if i % 10 and (i % 6 == 3 or i == 7)}


def test_nothing_to_fetch_and_a_source_that_never_answers(spark, source):
    def broken(rows):
        raise OSError("x" * 5000)

    args = spark.range(5)
    assert fetch.fetched(args.limit(0), source, "id long", 3).count() == 0
    told = fetch.failures(fetch.fetched(args, broken, "id long", 3)).collect()
    assert len(told) == 5 and all(r.error.startswith("OSError: xx") and len(r.error) == 1000 for r in told)
    with pytest.raises(ValueError):
        fetch.fetched(args, source, "id long", 0)
