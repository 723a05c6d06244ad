"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Leaf i of the tree holds the rank of the pair that starts at the live symbol i; each inner
node holds the smaller of its children's values, where a value is ``rank * width + i``, so
the root names the leftmost minimum. A merge joins two live neighbours and updates three
leaves, each along one path to the root.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .pretokens import split

NEVER = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    width = 1 << (n - 1).bit_length()
    tree = [NEVER] * (2 * width)
    get = ranks.get
    for i in range(n - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            tree[width + i] = rank * width + i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    low = width - 1
    while (top := tree[1]) != NEVER:
        i = top & low
        j = after[i]
        k = after[j]  # the merged symbol is word[i:k]
        after[i] = k
        if k < n:
            before[k] = i
        h = before[i]
        tree[width + j] = tree[width + i] = NEVER
        if k < n and (rank := get(word[i : after[k]])) is not None:
            tree[width + i] = rank * width + i
        if h >= 0:
            rank = get(word[h:k])
            tree[width + h] = NEVER if rank is None else rank * width + h
        else:
            h = i
        # the three paths to the root; they meet early, as the leaves are neighbours
        h, i, j = (width + h) >> 1, (width + i) >> 1, (width + j) >> 1
        while h:
            a, b = tree[2 * h], tree[2 * h + 1]
            tree[h] = a if a < b else b
            if i != h:
                a, b = tree[2 * i], tree[2 * i + 1]
                tree[i] = a if a < b else b
            if j != i:
                a, b = tree[2 * j], tree[2 * j + 1]
                tree[j] = a if a < b else b
            h >>= 1
            i >>= 1
            j >>= 1
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : after[i]]])
        i = after[i]
    return ids


class Words(dict):
    """Pre-token -> its ids as decimal text; holds at most ``most`` pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], most: int = 700_000):
        self.ranks, self.most = ranks, most

    def __missing__(self, word: str) -> str:
        out = ",".join(map(str, merge_word(word.encode("utf-8"), self.ranks)))
        if len(self) < self.most and len(word) < 64:
            self[word] = out
        return out


_CODECS: dict[str, tuple[Words, dict[str, bytes]]] = {}


def codec(path: str) -> tuple[Words, dict[str, bytes]]:
    """Encoder and decoder of a rank file, built once per Python worker."""
    if path not in _CODECS:
        ranks = load_ranks(path)
        _CODECS[path] = Words(ranks), {str(v): k for k, v in ranks.items()}
    return _CODECS[path]


def encode_text(text: str, words: Words) -> str:
    """Ids as decimals joined by commas."""
    return ",".join(map(words.__getitem__, split(text)))


def decode_text(ids: str, pieces: dict[str, bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, ids.split(","))) if ids else b""


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: every whole text; null text counts as empty and gives no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _ = codec(path)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = [[int(x) for x in s.split(",")] if s else [] for s in (encode_text(t, words) for t in part[1].to_pylist())]
                yield pa.record_batch([part[0], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, data binary: the bytes of the ids; null ids give null, an unknown id fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, pieces = codec(path)
        for b in batches:
            data = [None if x is None else b"".join(pieces[str(i)] for i in x) for x in b[1].to_pylist()]
            yield pa.record_batch([b[0], pa.array(data, pa.binary())], ["doc_id", "data"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, data binary")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded.

    The ids never leave the task. Null and empty texts have no tokens. Rows keep their
    (possibly null or repeated) ids; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces = codec(path)
        sha = hashlib.sha256
        for b in batches:
            n, first, second = [], [], []
            for text in b[1]:
                ids = encode_text(text.as_py(), words)
                n.append(ids.count(",") + 1 if ids else 0)
                first.append(sha(ids.encode("ascii")).hexdigest())
                second.append(sha(decode_text(ids, pieces)).hexdigest())
            yield pa.record_batch([b[0], pa.array(n, pa.int64()), pa.array(first), pa.array(second)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def multi_path() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
