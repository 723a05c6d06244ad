"""Exact dedup: a tree merge of sorted digest runs.

Every row gets a slot (a leaf of the tree) and a digest. Leaf runs hold one row per
(slot, digest): the row to keep and the group's size. In round r the runs of 2**bits
neighbouring slots meet in one task per digest, so a hot digest arrives as a few partial
rows and never as its documents. ``max`` over a struct makes Spark plan sort aggregation on
both sides of each exchange: sorted runs out, merged sorted runs in. A group is confirmed at
each level by SHA-256 plus length plus an independent 64-bit hash of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, materialize, shuffle_partitions, text_or_empty

KEY = ["sha", "n_bytes", "check"]
NO_ID = -(1 << 63)


def digest_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = 64) -> DataFrame:
    """(doc_id, rid, sha, n_bytes, check, slot), written once; rid tells repeated rows apart."""
    text = text_or_empty(text_col)
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("rid"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )
    return materialize(rows.withColumn("slot", F.pmod(F.xxhash64("rid"), F.lit(slots)).cast("int")), "digests")


def merge_tree(runs: DataFrame, levels: int, bits: int) -> DataFrame:
    """One row per digest: the struct to keep and the group's size, after ``levels`` rounds."""
    for _ in range(levels):
        runs = (
            runs.withColumn("slot", F.shiftright("slot", bits))
            .groupBy("slot", *KEY)
            .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
        )
    return runs


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; of equal texts the row with the largest id stays.
    Null text counts as empty. A null id ranks below every other one. Among repeated rows
    (same id and text) exactly one is kept. Empty input gives an empty result. Further
    columns of ``df`` are neither read nor returned.
    """
    levels = 2
    while 2 ** (bits * levels) < 2 * shuffle_partitions(df.sparkSession):
        levels += 1
    rows = digest_runs(df, id_col, text_col, 2 ** (bits * levels))
    leaves = rows.groupBy("slot", *KEY).agg(
        F.max(F.struct("doc_id", "rid")).alias("best"), F.count(F.lit(1)).alias("n")
    )
    merged = merge_tree(leaves, levels, bits).select(*KEY, "best", "n")
    # Down again over the leaves: each digest meets at most one row per slot there, and the
    # rows of a hot digest are spread over all slots.
    told = leaves.select("slot", *KEY).join(merged, KEY)
    return rows.join(told, ["slot", *KEY]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`exact_dedup` keeps, with all their columns.

    Only the dropped rows' ids and digests go to the join, which is a broadcast while they are
    few; of repeated rows (same id and text) that stay, one is chosen."""
    told = exact_dedup(df, id_col, text_col).groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    id_key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))
    odd = materialize(told.where("not kept or n > 1").select(id_key("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"), "kept"), "dropped")
    tagged = df.withColumn("__id", id_key(f"`{id_col}`")).withColumn("__sha", F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256)))
    out = tagged.join(few(odd.select("__id", "__sha")), ["__id", "__sha"], "left_anti")
    many = odd.where("kept").select("__id", "__sha")
    if not many.isEmpty():
        out = out.unionByName(tagged.join(few(many), ["__id", "__sha"], "left_semi").dropDuplicates(["__id", "__sha"]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
