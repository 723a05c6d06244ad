"""Contents: blobs, checksums, MIME types, licenses."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metalake.functions.magic import refined
from metalake.functions.scalars import mime_charset
from metalake.operators.licenses import PHRASES, licenses  # noqa: F401


def with_blobs(ids: DataFrame, blobs: DataFrame, keep_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ids with their data, ids without): a missing blob and, by default, an empty one count
    as absent. ``ids`` has a column id; blobs (sha1, data)."""
    usable = blobs if keep_empty else blobs.where(F.octet_length("data") > 0)
    named = usable.select(F.col("sha1").alias("id"), "data")
    return ids.join(named, "id"), ids.join(named.select("id"), "id", "left_anti")


def git_hash(data: Column) -> Column:
    """SHA-1 of a git blob: header ``blob <length>`` and a NUL, then the data."""
    header = F.concat(F.lit("blob "), F.octet_length(data).cast("string")).cast("binary")
    return F.sha1(F.concat(header, F.unhex(F.lit("00")), data))


def checksums(blobs: DataFrame) -> DataFrame:
    """``blobs`` with sha1, sha256, sha1_git and length of ``data``."""
    data = F.col("data")
    return blobs.withColumns({"sha1": F.sha1(data), "sha256": F.sha2(data, 256), "sha1_git": git_hash(data), "length": F.octet_length(data).cast("long")})


def blake2(blobs: DataFrame) -> DataFrame:
    """(sha1, blake2s256, blake2b512); Spark has no such functions, so Arrow batches are hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = b["data"].to_pylist()
            small = [None if x is None else hashlib.blake2s(x, digest_size=32).hexdigest() for x in data]
            large = [None if x is None else hashlib.blake2b(x, digest_size=64).hexdigest() for x in data]
            yield pa.record_batch([b["sha1"], pa.array(small, pa.string()), pa.array(large, pa.string())], ["sha1", "blake2s256", "blake2b512"])

    return blobs.select("sha1", "data").mapInArrow(run, "sha1 string, blake2s256 string, blake2b512 string")


def missing_checksums(contents: DataFrame, names: list[str], recompute: bool = False) -> DataFrame:
    """Contents that lack a checksum, with ``keys``: the sorted names to compute."""
    lacking = F.array_compact(F.array(*[F.when(F.lit(recompute) | F.col(c).isNull(), c) for c in sorted(names)]))
    return contents.withColumn("keys", lacking).where(F.size("keys") > 0)


def keys_to_update(contents: DataFrame) -> DataFrame:
    """Number of contents for each set of checksums to write."""
    return contents.groupBy("keys").agg(F.count(F.lit(1)).alias("n"))


def update_columns(table: DataFrame, fresh: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``table`` with ``columns`` from ``fresh`` where it has the row; other values stay."""
    new = fresh.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in columns])
    return table.join(new, key, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns])


def mimetypes(blobs: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, mimetype, encoding) of ``data``."""
    kind, charset = mime_charset(F.col("data"))
    # explode keeps the steps apart, so that the marks are looked up once and not for every test behind them
    rows = blobs.select(id_col, "data", F.explode(F.array(F.struct(kind.alias("kind"), charset.alias("charset")))).alias("m"))
    return rows.select(id_col, refined(F.col("data"), F.col("m.kind")).alias("mimetype"), F.col("m.charset").alias("encoding"))
