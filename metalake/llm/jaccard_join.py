"""N-gram Jaccard self-join by chosen paths.

Documents with equal shingle sets collapse into one node. In every run each node samples
shared tokens (a shingle is chosen by a hash all nodes share, with probability 1 over the
threshold times the set's size) and goes to the bucket of each; buckets above ``limit`` are
split again by the next level's tokens, so a bucket's path is the tokens chosen so far.
Small buckets are compared by brute force: tiny sets exactly, others on 512-bit sketches with a
margin of five deviations. Runs are
repeated until a pair at the threshold is met with the target probability. Buckets that stay
large are compared in blocks of ``limit`` nodes, pair by pair of blocks.

Buckets only yield spanning edges, whose components contain every link that was met. Each
component is then compared exactly on its whole shingle sets, again in blocks, and yields
per node its number of links and spanning edges of verified links: no pair list of a dense
group is ever written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, materialize, meet, small_batches, text_or_empty
from .components import components
from .shingles import mix, shingle_sets

BINS = 512
TINY = 24
NO_ID = -(1 << 63)


def runs_needed(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold is met with probability ``recall``, even if
    its buckets are split ``depth`` times. All buckets of a run and level are split by the same
    tokens, so a pair survives a run if it shares a chosen token at every level; it shares one
    on average at each, so at least one with probability 1 - 1/e."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - math.exp(-1)) ** depth))


def seeds(runs: int, depth: int) -> np.ndarray:
    """Odd multipliers, one for each run and level."""
    return (mix(np.arange(1, runs * depth + 1, dtype="uint64")) | np.uint64(1)).reshape(runs, depth)


def sample(hashes: np.ndarray, multiplier: np.uint64, threshold: float) -> np.ndarray:
    """The tokens chosen at one level of one run."""
    bound = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(hashes)))))
    return hashes[hashes * multiplier <= bound]


def sketch(hashes: np.ndarray) -> bytes:
    """One bit of the smallest hash in each of 512 ranges; an empty range looks to the right."""
    starts = np.arange(BINS, dtype="uint64") << np.uint64(55)
    first = np.searchsorted(hashes, starts) % len(hashes)
    steps = (hashes[first] >> np.uint64(55)).astype("int64") - np.arange(BINS)
    bits = mix(hashes[first] + (steps % BINS).astype("uint64") * np.uint64(2654435761)) & np.uint64(1)
    return np.packbits(bits.astype("uint8")).tobytes()


def digests(df: DataFrame, runs: int, depth: int, threshold: float, size: int) -> DataFrame:
    """(rid, doc_id, k, th, n, d1, d2, sketch, own, tokens) of every row, written once. own: the
    shingles of a tiny set; tokens: per run and level, the chosen shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = seeds(runs, depth).ravel()
        for b in batches:
            for s in range(0, b.num_rows, 64):
                part = b.slice(s, 64)
                n, d1, d2, sketches, own, tokens = [], [], [], [], [], []
                for h in shingle_sets(part[4].to_pylist(), size):
                    n.append(len(h))
                    with np.errstate(over="ignore"):
                        d1.append(int(np.add.reduce(mix(h), initial=np.uint64(len(h))).view("int64")))
                        d2.append(int(np.bitwise_xor.reduce(h * np.uint64(0xC2B2AE3D27D4EB4F), initial=np.uint64(0)).view("int64")))
                    sketches.append(sketch(h) if len(h) else b"")
                    own.append(h.tobytes() if len(h) <= TINY else b"")
                    tokens.append([sample(h, m, threshold).view("int64") for m in multipliers] if len(h) else [])
                yield pa.record_batch(
                    [*(part[c] for c in range(4)), pa.array(n, pa.int32()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sketches, pa.binary()), pa.array(own, pa.binary()), pa.array(tokens, pa.list_(pa.list_(pa.int64())))],
                    ["rid", "doc_id", "k", "th", "n", "d1", "d2", "sketch", "own", "tokens"],
                )

    schema = "rid long, doc_id long, k long, th long, n int, d1 long, d2 long, sketch binary, own binary, tokens array<array<long>>"
    with small_batches(df.sparkSession):
        return materialize(df.select("rid", "doc_id", "k", "th", "text").mapInArrow(run, schema), "sets")


def by_group(df: DataFrame, key: list[str], work: Callable, schema: str, pairs: Callable | None = None) -> DataFrame:
    """``work`` on the rows of each key, streamed through sorted partitions. ``pairs``, if
    given, takes a batch and the starts of all its groups of two rows at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def last_key() -> list:
            return [held[-1][c][held[-1].num_rows - 1] for c in key]

        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for c in key:
                x = b[c].to_numpy(zero_copy_only=False)
                new[1:] |= x[1:] != x[:-1]
            new[0] = not held or last_key() != [b[c][0] for c in key]
            cuts = np.flatnonzero(new).tolist() + [b.num_rows]
            if cuts[0]:
                held.append(b.slice(0, cuts[0]))
            if len(cuts) > 1:
                if held:
                    yield work(pa.Table.from_batches(held))
                starts, lengths = np.array(cuts[:-2], "int64"), np.diff(cuts[:-1])
                two = lengths == 2 if pairs else np.zeros(len(starts), bool)
                if two.any():
                    yield pairs(b, starts[two])
                for i, n in zip(starts[~two].tolist(), lengths[~two].tolist()):
                    yield work(pa.Table.from_batches([b.slice(i, n)]))
                held = [b.slice(cuts[-2])]
        if held:
            yield work(pa.Table.from_batches(held))

    return df.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def spanning(linked: np.ndarray) -> np.ndarray:
    """Per row of a symmetric boolean matrix, the smallest index of its component."""
    label = np.arange(len(linked))
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(reach, label[None, :], len(label)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def sides(table: pa.Table) -> np.ndarray | None:
    """Which pairs a block pair compares: all within one block, else only across the two."""
    if table["i"][0].as_py() == table["j"][0].as_py():
        return None
    side = table["side"].to_numpy()
    return side[:, None] != side[None, :]


def close(apart: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sketches and sizes leave a link possible. At similarity s the bits differ in a
    share of (1 - s) / 2 with a deviation that was measured as below; five of them are allowed,
    so fewer than one link in a million is passed over."""
    low, high = np.minimum(n, m), np.maximum(n, m)
    deviation = np.sqrt(0.0125**2 + 0.029 / low)
    return (apart <= ((1 - threshold) / 2 + 5 * deviation) * BINS) & (low >= threshold * high - 1e-9)


def alike(common: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    return common >= threshold * (n + m - common) - 1e-9


def near(threshold: float) -> Callable[[pa.Table], pa.RecordBatch]:
    """Spanning edges of a bucket's pairs whose sets may be linked."""

    def work(table: pa.Table) -> pa.RecordBatch:
        n = table["n"].to_numpy().astype(float)
        bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), "uint64").reshape(len(n), -1)
        apart = np.zeros((len(n), len(n)), "uint16")
        for column in bits.T:
            apart += np.bitwise_count(column[:, None] ^ column[None, :])
        linked = close(apart, n[:, None], n[None, :], threshold)
        tiny = np.flatnonzero(n <= TINY)
        if len(tiny) > 1:
            own = [np.frombuffer(x, "uint64") for x in table["own"].take(pa.array(tiny)).to_pylist()]
            linked[np.ix_(tiny, tiny)] = alike(overlaps(own), n[tiny][:, None], n[tiny][None, :], threshold)
        if (across := sides(table)) is not None:
            linked &= across
        root = spanning(linked)
        node = table["node"].to_numpy()
        tied = root != np.arange(len(root))
        return pa.record_batch([pa.array(node[tied]), pa.array(node[root[tied]])], ["a", "b"])

    return work


def near_pairs(threshold: float) -> Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]:
    """:func:`near` for many buckets of two nodes. A bucket that was cut into blocks has its two
    on one side or on both; either way the pair is one that may be compared."""

    def work(b: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        of = lambda c, k: b[c].take(pa.array(starts + k)).to_pylist()
        bits = [np.frombuffer(b"".join(of("sketch", k)), "uint64").reshape(len(starts), -1) for k in (0, 1)]
        n, node = b["n"].to_numpy().astype(float), b["node"].to_numpy()
        first, second = n[starts], n[starts + 1]
        linked = close(np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1), first, second, threshold)
        tiny = np.flatnonzero((first <= TINY) & (second <= TINY))
        if len(tiny):
            x, y = of("own", 0), of("own", 1)
            common = np.array([len(np.intersect1d(np.frombuffer(x[i], "uint64"), np.frombuffer(y[i], "uint64"), assume_unique=True)) for i in tiny.tolist()], float)
            linked[tiny] = alike(common, first[tiny], second[tiny], threshold)
        found = starts[linked]
        return pa.record_batch([pa.array(node[found]), pa.array(node[found + 1])], ["a", "b"])

    return work


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections; elements that only one set has don't matter."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.r_[True, flat[1:] != flat[:-1]]
    at = np.cumsum(fresh) - 1
    shared = np.bincount(at)[at] > 1
    owner, at = owner[shared], at[shared]
    out = np.zeros((len(sets), len(sets)), "float32")
    if len(at):
        at = np.cumsum(np.r_[True, at[1:] != at[:-1]]) - 1
        for low in range(0, at[-1] + 1, columns):
            i, j = np.searchsorted(at, [low, low + columns])
            block = np.zeros((len(sets), min(columns, at[-1] + 1 - low)), "float32")
            block[owner[i:j], at[i:j] - low] = 1
            out += block @ block.T
    return out


def exact(threshold: float) -> Callable[[pa.Table], pa.RecordBatch]:
    """Per row of a block pair: its links (counting copies) and the root of its verified links."""

    def work(table: pa.Table) -> pa.RecordBatch:
        sets = [np.frombuffer(x, "uint64") for x in table["hashes"].to_pylist()]
        n = np.array([len(s) for s in sets], "float64")
        if len(sets) == 2:
            common = np.full((2, 2), float(len(np.intersect1d(*sets, assume_unique=True))))
        else:
            common = overlaps(sets).astype("float64")
        linked = alike(common, n[:, None], n[None, :], threshold)
        np.fill_diagonal(linked, False)
        if (across := sides(table)) is not None:
            linked &= across
        node = table["node"].to_numpy()
        links = linked @ table["copies"].to_numpy().astype("float64")
        return pa.record_batch([pa.array(node), pa.array(node[spanning(linked)]), pa.array(links.astype("int64"))], ["node", "root", "links"])

    return work


def in_blocks(df: DataFrame, group: str, blocks: str) -> DataFrame:
    """Rows of group g in ``blocks`` blocks, once for every pair of blocks (i <= j) theirs is in."""
    own = F.pmod(F.xxhash64("node", group), F.col(blocks)).cast("int")
    return (
        df.withColumn("side", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .drop("other", blocks)
    )


def bucket_edges(nodes: DataFrame, heads: DataFrame, runs: int, depth: int, limit: int, threshold: float) -> DataFrame:
    """Coarse edges of all runs: recursive splitting, then brute force in small buckets. ``nodes`` may
    have rows besides ``heads`` (node), which alone take part: what a step needs of a node is looked
    up in the table written first, so its tokens and sketch are written once."""
    light = nodes.select("node", "n", "sketch", "own")
    firsts = F.filter("tokens", lambda _, at: at % depth == 0)
    paths = nodes.select("node", firsts.alias("firsts")).join(few(heads), "node").select("node", F.posexplode("firsts").alias("run", "chosen"))
    entries = paths.select("node", "run", F.explode("chosen").alias("token")).select(
        "node", "run", F.xxhash64("run", "token").alias("bucket")
    )
    done = []
    for level in range(1, depth + 1):
        entries = materialize(entries, "paths")
        sizes = materialize(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        met = meet(entries, sizes, ["bucket"], "size", entries.count())
        last = level == depth
        small = met if last else met.where(F.col("size") <= limit)
        done.append(small.select("bucket", "node", F.ceil(F.col("size") / limit).cast("int").alias("blocks")))
        if last or sizes.where(F.col("size") > limit).isEmpty():
            break
        chosen = nodes.select("node", "tokens")
        entries = (
            met.where(F.col("size") > limit)
            .join(chosen, "node")
            .select("node", "run", "bucket", F.explode(F.get("tokens", F.col("run") * depth + level)).alias("token"))
            .select("node", "run", F.xxhash64("bucket", "token").alias("bucket"))
            .distinct()
        )
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.unionByName(more)
    rows = in_blocks(pairs.join(light, "node"), "bucket", "blocks")
    return by_group(rows, ["bucket", "i", "j"], near(threshold), "a long, b long", near_pairs(threshold)).distinct()


def jaccard_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    size: int = 5,
    recall: float = 0.999,
    depth: int = 3,
    limit: int = 1024,
) -> DataFrame:
    """One row per input row: doc_id, class_id, n_links, n_shingles, leader.

    Two rows are linked when the Jaccard similarity of their shingle sets is at least
    ``threshold``; n_links counts the linked other rows, copies included. A class is a
    connected component of links; class_id is its smallest id, and leader marks the one row
    of the class to keep (smallest id; among repeated rows any one). Null text counts as
    empty; a text without a word has no shingles, no links and a class of its own. Null ids
    rank first, so such a class may have a null class_id. Empty input gives no rows; further
    columns are not read.
    """
    return classes(df, id_col, text_col, threshold, size, recall, depth, limit).drop("k", "th")


def classes(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, size: int = 5, recall: float = 0.999, depth: int = 3, limit: int = 1024) -> DataFrame:
    """The rows of :func:`jaccard_join` with (k, th), which tell their source rows."""
    runs = runs_needed(recall, depth)
    text = text_or_empty(text_col)
    rows = df.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"),
        F.xxhash64(text).alias("th"),
        text.alias("text"),
    )
    sets = digests(rows, runs, depth, threshold, size)
    full = sets.where("n > 0")
    same = materialize(
        full.groupBy("d1", "d2", "n").agg(F.min(F.struct("k", "rid", "th")).alias("best"), F.count(F.lit(1)).alias("copies"))
        .select("d1", "d2", "n", "copies", F.col("best.rid").alias("node"), F.col("best.k").alias("k"), F.col("best.th").alias("th")),
        "nodes",
    )
    nodes = full.select(F.col("rid").alias("node"), "n", "sketch", "own", "tokens")
    coarse = components(bucket_edges(nodes, same.select("node"), runs, depth, limit, threshold))
    linked = verified(rows, sets, same, coarse, threshold, size, limit)
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(linked.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    told = same.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    told = materialize(told, "told")
    first = materialize(told.groupBy("root").agg(F.min(F.struct("k", "node")).alias("first"), F.count(F.lit(1)).alias("size")), "firsts")
    per_node = meet(told, first, ["root"], "size", told.count()).select(
        "d1", "d2", "n", "node", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "first"
    )
    out = meet(sets.select("rid", "doc_id", "k", "th", "d1", "d2", "n"), materialize(per_node, "per-node"), ["d1", "d2", "n"], "copies", sets.count(), "left")
    class_k = F.coalesce("first.k", "k")
    return out.select(
        "k",
        "th",
        "doc_id",
        F.when(class_k != NO_ID, class_k).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce(F.col("rid") == F.col("first.node"), F.lit(True)).alias("leader"),
    )


def verified(rows: DataFrame, sets: DataFrame, same: DataFrame, coarse: DataFrame, threshold: float, size: int, limit: int) -> DataFrame:
    """(node, root, links) of every block pair of every coarse component, from whole texts."""
    members = materialize(coarse.join(same.select("node", "n", "copies", "k", "th"), "node"), "coarse")
    weight = members.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / limit), F.ceil(F.col("total") / F.lit(1_000_000))).cast("int")
    weight = materialize(weight.select("root", "m", blocks.alias("blocks")), "weights")
    members = materialize(meet(members, weight, ["root"], "m", members.count()), "members")
    texts = rows.select("k", "th", "text").join(few(members), ["k", "th"])
    if repeated(sets):
        texts = texts.dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 64):
                part = b.slice(s, 64)
                data = [h.tobytes() for h in shingle_sets(part["text"].to_pylist(), size)]
                yield pa.record_batch([part["comp"], part["node"], part["copies"], part["blocks"], pa.array(data, pa.binary())], ["comp", "node", "copies", "blocks", "hashes"])

    hashed = texts.select(F.col("root").alias("comp"), "node", "copies", "blocks", "text").mapInArrow(run, "comp long, node long, copies long, blocks int, hashes binary")
    return materialize(by_group(in_blocks(hashed, "comp", "blocks"), ["comp", "i", "j"], exact(threshold), "node long, root long, links long"), "links")


def repeated(rows: DataFrame) -> bool:
    """Whether any row occurs twice with the same id and text."""
    return not rows.groupBy("k", "th").count().where("count > 1").isEmpty()


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that lead their class, with all their columns. Rows without a word
    lead a class each and all stay; of other rows with the same id and text one may stay."""
    found = classes(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col, text_col)
    per_key = found.groupBy("k", "th").agg(F.max("leader").alias("stays"), F.max("n_shingles").alias("words"), F.count(F.lit(1)).alias("n"))
    odd = materialize(per_key.where("not stays or (n > 1 and words > 0)").select("k", "th", "stays"), "followers")
    odd = odd.select(F.col("k").alias("__k"), F.col("th").alias("__th"), F.col("stays").alias("__stays"))
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    keyed = df.withColumn("__k", key).withColumn("__th", F.xxhash64(text_or_empty(text_col)))
    out = keyed.join(few(odd.drop("__stays")), ["__k", "__th"], "left_anti")
    many = odd.where("__stays")
    if not many.isEmpty():
        out = out.unionByName(keyed.join(few(many.drop("__stays")), ["__k", "__th"], "left_semi").dropDuplicates(["__k", "__th"]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
