"""Calls to a source outside of Spark, in batches that survive single bad objects."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fetch = Callable[[list[dict]], Iterable[dict | None]]


def fetched(args: DataFrame, fetch: Fetch, schema: str, batch_size: int = 100) -> DataFrame:
    """What ``fetch`` finds for the rows of ``args``: found (a struct of ``schema``), or arg and error.

    ``fetch`` takes a list of rows as dictionaries and returns dictionaries of ``schema``; None, or
    fewer results than rows, means that something isn't there. When it fails for a batch, each
    row is asked for on its own, and a row that fails alone gives its ``arg`` and ``error`` and no
    result. A batch counts only as a whole: what it yielded before it failed isn't kept.

    Every read of the result calls ``fetch`` again, and so does a task that is tried again; write it
    before it is used twice (:func:`metalake.plans.lineage.written`).
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in args.schema.fields)
    named = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in args.sparkSession.createDataFrame([], schema).schema.fields)

    def ask(rows: list[dict]) -> Iterator[dict]:
        try:
            yield from [{"found": r, "arg": None, "error": None} for r in fetch(rows) if r is not None]
        except Exception as error:  # noqa: BLE001 - a source may fail in any way; it is told, not raised
            if len(rows) > 1:
                for row in rows:
                    yield from ask([row])
            else:
                yield {"found": None, "arg": rows[0], "error": f"{type(error).__name__}: {error}"[:1000]}

    shape = f"found struct<{named}>, arg struct<{fields}>, error string"
    kinds = _arrow(args, shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch_size):
                out = list(ask(b.slice(at, batch_size).to_pylist()))
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return args.mapInArrow(run, shape)


def _arrow(args: DataFrame, shape: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(args.sparkSession.createDataFrame([], shape).schema)


def results(answers: DataFrame) -> DataFrame:
    return answers.where("found is not null").select("found.*")


def failures(answers: DataFrame) -> DataFrame:
    """The rows that failed alone, with their error."""
    return answers.where("error is not null").select("arg.*", "error")


def not_there(args: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Rows that were asked for without error and not found; ``key`` is in rows and results."""
    told = answers.select(F.coalesce(f"found.{key}", f"arg.{key}").alias(key))
    return args.join(told, key, "left_anti")
