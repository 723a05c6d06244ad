"""Best-fit packing of token sequences by large-item matching over a length histogram.

The plan needs only how many pieces there are of each length, at most ``capacity`` numbers.
Pieces above a third of the capacity fit at most twice into a bin: a greedy matching pairs
each with the longest other one that still fits. Shorter pieces then best-fit the remaining
gaps. Bins with equal contents are planned together as one *pattern* with a multiplicity;
pieces find their place from their rank among the pieces of their length, which Spark
computes by chunk counts and prefix sums, never by one task per length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, small_batches, text_or_empty
from .pretokens import split

PIECE = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers, from the tokenizer. Each worker
    holds ``most`` pre-tokens, some 45 MB; others are encoded again."""

    def __init__(self, path: str, most: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        self.most = most

    def __missing__(self, word: str) -> bytes:
        out = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < self.most and len(word) < 64:
            self[word] = out
        return out


_WORDS: dict[str, WordIds] = {}


def text_ids(text: str, path: str) -> bytes:
    """Ids of a whole text; its pre-tokens are encoded one by one, as the tokenizer itself does."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return b"".join(map(_WORDS[path].__getitem__, split(text)))


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of ``capacity``, but the first may be shorter."""
    first = n_ids % capacity or capacity
    return [(0, min(first, n_ids))] + [(s, capacity) for s in range(first, n_ids, capacity)]


def token_pieces(df: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for rid, doc_id, text in zip(b[0].to_pylist(), b[1].to_pylist(), b[2]):
                ids = text_ids(text.as_py(), path) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    row = (rid, doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))
                    for column, x in zip(out, row):
                        column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["rid", "doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, PIECE)


def match_large(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Greedy matching of lengths above capacity / 3: (bins, {length: pieces in each bin})."""
    left = {n: c for n, c in counts.items() if 3 * n > capacity and c}
    sizes = sorted(left)
    bins = []
    while sizes:
        long = sizes[-1]
        k = bisect.bisect_right(sizes, capacity - long) - 1  # longest partner that fits
        if k < 0:
            bins.append((left[long], {long: 1}))
            sizes.pop()
            continue
        mate = sizes[k]
        pairs = left[long] // 2 if mate == long else min(left[long], left[mate])
        if pairs:
            bins.append((pairs, {long: 2} if mate == long else {long: 1, mate: 1}))
        left[long] -= pairs
        left[mate] -= pairs
        if mate == long and left[long]:  # an odd one: its partner is the next shorter length
            mate = sizes[k - 1] if k else None
            bins.append((1, {long: 1, mate: 1} if mate else {long: 1}))
            left[long] = 0
            if mate:
                left[mate] -= 1
        sizes = [n for n in sizes if left[n]]
    return bins


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """All patterns: (bins, {length: pieces in each bin}), no bin above ``capacity``."""
    done: list[tuple[int, dict[int, int]]] = []
    gaps: dict[int, list[tuple[int, dict[int, int]]]] = {}

    def put(n: int, holds: dict[int, int]) -> None:
        gap = capacity - sum(a * b for a, b in holds.items())
        gaps.setdefault(gap, []).append((n, holds))

    for n, holds in match_large(counts, capacity):
        put(n, holds)
    for size in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        left = counts[size]
        while left:
            fits = [g for g in gaps if g >= size]
            gap = min(fits, default=capacity)
            fill = min(gap // size, left)
            n, holds = gaps[gap].pop() if fits else (left // fill, {})
            if fits and not gaps[gap]:
                del gaps[gap]
            use = min(n, left // fill)
            put(use, holds | {size: fill})
            if use < n:
                put(n - use, holds)
            left -= use * fill
    for group in gaps.values():
        done += group
    return done


def places(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length: (first rank, pieces in each bin, first sequence, first offset), by rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for n, holds in patterns:
        offset = 0
        for size, times in holds.items():
            rank = used.get(size, 0)
            out.setdefault(size, []).append((rank, times, first, offset))
            used[size] = rank + n * times
            offset += size * times
        first += n
    return out


def ranked(pieces: DataFrame, rows_per_chunk: int = 50_000) -> DataFrame:
    """Adds ``rank`` from 0 among the pieces of equal length, whatever the lengths' counts."""
    chunks = max(2 * shuffle_partitions(pieces.sparkSession), pieces.count() // rows_per_chunk + 1)
    pieces = pieces.withColumn("chunk", F.pmod(F.xxhash64("rid", "piece"), F.lit(chunks)))
    counts = pieces.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("chunk", "length").orderBy("rid", "piece")
    return pieces.withColumn("at", F.row_number().over(within) - 1).join(starts, ["chunk", "length"]).withColumn("rank", F.col("base") + F.col("at"))


def pack(df: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each document is its ids and ``end_id``; null text counts as empty, so it is one piece of
    one id. Only documents above ``capacity`` are cut. Null and repeated ids are packed like
    others; an empty table gives no rows; further columns are not read. Sequences are
    numbered from 0 without gaps, offsets in a sequence have no gaps.
    """
    with small_batches(df.sparkSession):
        pieces = materialize(token_pieces(df, path, capacity, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(plan(counts, capacity))
    lookup = pieces.sparkSession.sparkContext.broadcast({k: np.array(v, "int64").reshape(-1, 4) for k, v in table.items()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            sequence, offset = np.empty(len(rank), "int64"), np.empty(len(rank), "int64")
            for size in np.unique(length):
                here = length == size
                rows = lookup.value[size]
                r = rank[here]
                base, times, first, start = rows[np.searchsorted(rows[:, 0], r, "right") - 1].T
                sequence[here] = first + (r - base) // times
                offset[here] = start + (r - base) % times * size
            yield pa.record_batch([*(b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
