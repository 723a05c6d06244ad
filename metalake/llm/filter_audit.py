"""How filters of documents interact, over every order in which they can be applied.

A document is a row of a mask matrix (0 where it fails a filter, "never" elsewhere), an order
of filters is a row of an inverse-permutation matrix (the position of each filter in it). The
min-plus product of the two is the step at which each order removes each document. Documents
of equal masks are counted first, so the product runs over at most a few hundred weighted
rows a part; the removal steps then say where each weight is added.

A document that is a copy needs the smallest id of its text. Equal texts have equal masks, so
counts by (digest of the text, part, labels) with the smallest id of each are enough: no text
and no list of copies is shuffled.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few, materialize

#: The word separators of the contract's filters and the characters that D looks for.
SPACE = r"[\x20\x09-\x0D]+"
SIGNS = "[#$%&*|]"
NEVER = 1 << 20
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text that isn't null; their names are in order."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(SIGNS),
    }


def removal_steps(fails: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Min-plus product: for every row of ``fails`` (filters that it fails) and every order of
    filter numbers, the step (from 0) that removes it; NEVER or more if none does."""
    positions = np.argsort(orders, axis=1)  # the inverse permutations
    steps = np.full((len(fails), len(orders)), 2 * NEVER)
    for f in range(fails.shape[1]):
        np.minimum(steps, np.where(fails[:, f], 0, NEVER)[:, None] + positions[None, :, f], out=steps)
    return steps


def measured(part: np.ndarray, parts: int, fails: np.ndarray, weights: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """(parts, orders, steps, measures) of weighted rows; ``weights``: all, good, toxic ones."""
    steps, k = removal_steps(fails, orders), fails.shape[1]
    out = np.zeros((parts, len(orders), k, len(MEASURES)), "int64")
    row, order = np.nonzero(steps < k)
    for at, measure in enumerate(("removed", "good_lost", "toxic_lost")):
        np.add.at(out[..., MEASURES.index(measure)], (part[row], order, steps[row, order]), weights[row, at])
    alone = fails.sum(axis=1) == 1
    for s in range(k):
        own = fails[:, orders[:, s]]  # does the row fail the filter of this step?
        for measure, which in (("kept", steps > s), ("redundant", own & (steps < s)), ("unique_fails", own & alone[:, None])):
            row, order = np.nonzero(which)
            np.add.at(out[..., MEASURES.index(measure)], (part[row], order, s), weights[row, 0])
    by_filter = np.zeros((parts, k), "int64")
    removed = out[..., MEASURES.index("removed")]
    for f in range(k):
        by_filter[:, f] = np.where(orders[None] == f, removed, 0).sum(axis=(1, 2))
    out[..., MEASURES.index("shapley")] = by_filter[:, orders]
    return out


def labelled(docs: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``docs``, a written table, with good and toxic; ids that are null have no label."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    told = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(one("quality"), one("toxic"))
    told = few(materialize(told, "labels"))
    said = lambda c: F.coalesce(F.col(c), F.lit(False))
    named = docs.where("id is not null").join(told, "id", "left").select(*docs.columns, said("quality").alias("good"), said("toxic").alias("toxic"))
    return named.unionByName(docs.where("id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def patterns(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str, filters) -> DataFrame:
    """(part, mask, n, good, toxic): weights of the documents that fail the filters in mask,
    whose bit i is filter i, the last one that of copies."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    fails = filters(text)
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails.values())), F.lit(0))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
    )
    rows = materialize(rows, "masks")
    same = labelled(rows, labels, id_col).groupBy("id", "digest", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    texts = same.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"), F.min(known).alias("least")
    )
    first = F.min("least.id").over(Window.partitionBy("digest"))  # one row for each part and labels of a text
    texts = texts.withColumn("first", first)
    pass_ = F.col("unnamed") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask"), pass_.alias("n")), F.struct((F.col("mask") + (1 << len(fails))).alias("mask"), (F.col("n") - pass_).alias("n")))
    each = texts.select("part", "good", "toxic", F.explode(split).alias("s")).where("s.n > 0")
    when = lambda c: F.sum(F.when(F.col(c), F.col("s.n")).otherwise(0)).alias(c)
    return each.groupBy("part", F.col("s.mask").alias("mask")).agg(F.sum("s.n").alias("n"), when("good"), when("toxic"))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    filters=text_filters,
    copies: str = "E",
) -> DataFrame:
    """part, filter_order, step and the counts ``MEASURES`` of each step of each order.

    ``filters`` gives named failure conditions of a text; ``copies`` names one more filter, which
    a text fails that is identical to that of any smaller id. Names are single letters. A null
    text is empty, a null part is the part ''. Rows that share an id are documents of their
    own, and none of them is the other's copy by that id; a null id makes no text a copy and
    isn't one. Labels that are null or absent are neither good nor toxic; of several labels of an
    id any that says 1 counts; labels of unknown ids count nowhere. Very long texts are tested
    whole. No documents: no rows. Other columns of either table play no role, whatever their names.

    Parts hold at most 2**filters patterns each, so the product is small; parts are spread by hash.
    """
    names = [*filters(F.lit("")), copies]
    k = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = np.array(list(itertools.permutations(range(k))))
        spelled = np.array(["".join(names[f] for f in o) for o in orders])
        for b in batches:
            if not b.num_rows:
                continue
            told, part = np.unique(np.array(b["part"].to_pylist(), object), return_inverse=True)
            fails = (b["mask"].to_numpy()[:, None] >> np.arange(k)) & 1 == 1
            weights = np.stack([b[c].to_numpy() for c in ("n", "good", "toxic")], axis=1)
            for low in range(0, len(told), 64):  # a block of parts stays small
                own = (part >= low) & (part < low + 64)
                block = told[low : low + 64]
                out = measured(part[own] - low, len(block), fails[own], weights[own], orders).reshape(-1, len(MEASURES))
                place = np.indices((len(block), len(orders), k)).reshape(3, -1)
                columns = [pa.array(block[place[0]], pa.string()), pa.array(spelled[place[1]], pa.string()), pa.array(place[2] + 1, pa.int32())]
                yield pa.record_batch([*columns, *(pa.array(out[:, m]) for m in range(len(MEASURES)))], ["part", "filter_order", "step", *MEASURES])

    told = patterns(docs, labels, id_col, text_col, part_col, filters)
    sums = told.repartition("part").mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))
    return sums.groupBy("part", "filter_order", "step").agg(*[F.sum(m).alias(m) for m in MEASURES])
