"""Compress vectors to codes: a product quantiser trained by member-resident Lloyd rounds.

Vectors become integers, cut into equal consecutive parts. Parts live as member rows, dealt once
by (position, entry, salt): all members of a codebook entry lie with its owners, and the salt
spreads a popular entry over several. An owner sums its resident members, so an update
shuffles one row for each entry and task. A round then tells every member its nearest new entry
where it lies; only members that change entry are dealt again, in the next shuffle, while the
others stay in the files that they are in. All sums are of integers, hence exact and the same in
any order.

Equal parts of a batch travel as one member with a weight, so a vector that a third of all rows
repeat doesn't fill its owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, meet, new_path

#: Components saturate here (in units of 1/scale), so that squares and their sums stay whole numbers of 64 bits.
MOST = 1 << 24
MEMBER = "pos int, entry int, salt int, part array<int>, n long"


def finite(x: Column) -> Column:
    """Is the array neither null nor empty, with numbers only that aren't null, NaN or infinite?"""
    big = F.lit(float("inf"))
    return F.coalesce((F.size(x) > 0) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < big), F.lit(False))), F.lit(False))


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str | None, scale: int) -> tuple[DataFrame, int]:
    """(vec_id, label, q array<int>) of the usable rows, written, and the length of their q."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"), x.alias("x")).where(finite(F.col("x")))
    bound = lambda v: F.greatest(F.least(F.floor(F.greatest(F.least(v * scale, F.lit(float(MOST))), F.lit(-float(MOST)))), F.lit(MOST)), F.lit(-MOST)).cast("int")
    told = materialize(rows.select("vec_id", "label", F.transform("x", bound).alias("q")), "whole")
    top = told.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = top["d"] if top else 0
    return told.where(F.size("q") == d), d


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype("int64").reshape(-1, width)


def in_parts(q: np.ndarray, parts: int, width: int) -> np.ndarray:
    """(rows, parts, width); vectors that don't divide evenly get zeros at their end."""
    out = np.zeros((len(q), parts * width), "int64")
    out[:, : q.shape[1]] = q
    return out.reshape(len(q), parts, width)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each point's nearest entry, ties to the lower index; exact."""
    span = int(max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)))
    exact = points.shape[1] * (2 * span) ** 2 < 1 << 53  # so float64 holds every partial sum
    a, b = (points.astype("f8"), entries.astype("f8")) if exact else (points, entries)
    far = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    at = far.argmin(axis=1)
    return at, far[np.arange(len(far)), at].astype("int64")


def salted(points: np.ndarray, salts: int) -> np.ndarray:
    """A member's salt follows from its values, so equal ones meet."""
    mix = np.random.default_rng(11).integers(1, 1 << 31, points.shape[1]) | 1
    h = (points * mix).sum(axis=1).astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(salts)).astype("int32")


def member_batch(pos: np.ndarray, entry: np.ndarray, points: np.ndarray, n: np.ndarray, salts: int, more: dict | None = None) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(points) + 1) * points.shape[1], pa.int32())
    part = pa.ListArray.from_arrays(offsets, pa.array(points.astype("int32").ravel()))
    columns = {"pos": pa.array(pos, pa.int32()), "entry": pa.array(entry, pa.int32()), "salt": pa.array(salted(points, salts), pa.int32()), "part": part, "n": pa.array(n, pa.int64())}
    columns |= more or {}
    return pa.record_batch(list(columns.values()), list(columns))


def first_members(rows: DataFrame, d: int, book: np.ndarray, salts: int) -> DataFrame:
    """Every vector's parts with their entries, equal parts of a batch as one."""
    parts, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cut = in_parts(matrix(b[0], d), parts, width)
            for p in range(parts):
                points, n = np.unique(cut[:, p], axis=0, return_counts=True)
                yield member_batch(np.full(len(points), p), nearest(points, book[p])[0], points, n, salts)

    return rows.select("q").mapInArrow(run, MEMBER)


def settled(members: DataFrame, tag: str) -> DataFrame:
    """Members dealt to their owners and written there."""
    owner = ["pos", "entry", "salt"]
    return materialize(members.repartition(*owner).sortWithinPartitions(*owner), tag)


def updated(members: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook of the members' means, rounded down; unused entries stay. Owners sum their
    residents; the driver gets one row an entry, parts * entries at most."""
    sums = members.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("part")[i].cast("long") * F.col("n")).alias(f"s{i}") for i in range(book.shape[2])])
    out = book.copy()
    for r in sums.collect():
        out[r["pos"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(book.shape[2])]
    return out


def migrated(members: list[DataFrame], book: np.ndarray, salts: int) -> list[DataFrame]:
    """The members after one more assignment: those that keep their entry where they lie, and
    the others dealt to their new owners."""
    spark = members[0].sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            pos, was = b["pos"].to_numpy(), b["entry"].to_numpy()
            points, now = matrix(b["part"], book.shape[2]), np.empty(b.num_rows, "int64")
            for p in np.unique(pos):
                own = pos == p
                now[own] = nearest(points[own], book[p])[0]
            yield member_batch(pos, now, points, b["n"].to_numpy(), salts, {"moved": pa.array(now != was)})

    everywhere = members[0]
    for more in members[1:]:
        everywhere = everywhere.unionByName(more)
    path = new_path(spark, "assigned")
    everywhere.mapInArrow(run, f"{MEMBER}, moved boolean").write.partitionBy("moved").parquet(path)
    told = spark.read.schema(f"{MEMBER}, moved boolean").parquet(path)
    return [told.where("not moved").drop("moved"), settled(told.where("moved").drop("moved"), "arrived")]


def train(rows: DataFrame, d: int, n: int, parts: int, entries: int, rounds: int, per_owner: int) -> np.ndarray:
    """Codebooks (parts, entries, width) of ``rows`` (vec_id, q)."""
    width = -(-d // parts)
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "q").select("q").limit(entries).collect()
    book = in_parts(np.array([r["q"] for r in seeds], "int64"), parts, width).transpose(1, 0, 2).copy()
    salts = -(-n // per_owner)
    members = [settled(first_members(rows, d, book, salts), "members")] if rounds else []
    for at in range(rounds):
        if at:
            members = migrated(members, book, salts)
        everywhere = members[0]
        for more in members[1:]:
            everywhere = everywhere.unionByName(more)
        book = updated(everywhere, book)
    return book


def encode(rows: DataFrame, d: int, book: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): each part's nearest entry, two hex digits a part."""
    parts, _, width = book.shape
    digits = np.array([f"{i:02x}" for i in range(book.shape[1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cut = in_parts(matrix(b[2], d), parts, width)
            at, error = zip(*(nearest(cut[:, p], book[p]) for p in range(parts)))
            codes = ["".join(x) for x in digits[np.stack(at, axis=1)]]
            yield pa.record_batch([b[0], b[1], pa.array(codes), pa.array(np.sum(error, axis=0))], ["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "q").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    per_owner: int = 262_144,
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector.

    Rows whose vector is null, empty or holds null or non-finite components are dropped, as are
    vectors of another length than the commonest (ties: the longer), which have no codebook in
    common with the rest. A length that ``parts`` doesn't divide is filled with zeros. Components
    saturate at 2**24/scale. Codebooks start as the ``entries`` smallest ids, ties by the vector,
    null ids last; fewer rows make smaller codebooks. Repeated rows count each. label_error sums
    the errors of equal labels, nulls together. An empty table gives no rows. ``entries`` is at
    most 256; ``per_owner`` bounds the rows of an entry that one owner holds, by salting.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must lie between 1 and 256")
    out = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    rows, d = whole_vectors(df, id_col, vector_col, label_col, scale)
    n = rows.count()
    if not n:
        return df.sparkSession.createDataFrame([], out)
    book = train(rows, d, n, parts, entries, rounds, per_owner)
    told = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    coded = materialize(encode(rows, d, book).withColumn("unlabelled", F.col("label").isNull()).withColumn("tag", F.coalesce(F.col("label").cast("string"), F.lit(""))), "codes")
    by_label = materialize(coded.groupBy("tag", "unlabelled").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    return meet(coded, by_label, ["tag", "unlabelled"], "n", n).select("vec_id", "code", "error", "label_error", F.lit(told).alias("codebooks_sha256"))
