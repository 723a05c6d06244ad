"""Near-duplicate vectors by lattice hashing.

Each of several tables projects a unit vector to blocks of 8 coordinates at random, shifts them
and decodes each block to the nearest point of the E8 lattice: a cell. A vector lies in its own
cell and also visits the neighbouring cells whose points come next. Two vectors meet in a cell
where one lies and the other lies or visits; pairs that meet are verified by their cosine. The
number of tables follows from the chance that a pair at the threshold meets in one of them.

Only (cell, vector number, sketch) rows are dealt at first; cells with one vector go. In the
others 256 sign bits tell far pairs apart, and only vectors that have a near one in a cell are
fetched for the cosine. A pair that meets several times counts in the first table, and there in
the first cell, so links are counted without writing pairs. Popular cells are compared in
blocks over many tasks; each block yields its vectors' counts and one edge a vector for the
components. Equal vectors are one node with a weight.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, materialize, meet
from .components import components
from .vector_codes import finite

BITS = 256
KEY = ["tab", "cell", "a", "b"]


def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or all of +-1/2 with an even number of minus signs."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            pairs.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    signs = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([*pairs, *map(list, signs)])


SHORTEST = shortest()


def decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of integer coordinates with an even sum."""
    f = np.rint(x)
    rest = x - f
    worst = np.abs(rest).argmax(axis=1)
    odd = np.flatnonzero(f.sum(axis=1) % 2 != 0)
    f[odd, worst[odd]] += np.where(rest[odd, worst[odd]] >= 0, 1, -1)
    return f


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 moved by 1/2."""
    whole, half = decode_d8(x), decode_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def neighbours(x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """x: (rows, blocks, 8). The cells' points and each row's nearest ``probes`` moves of one
    block by a shortest vector, as block * 240 + vector."""
    rows, blocks, _ = x.shape
    points = decode_e8(x.reshape(-1, 8)).reshape(x.shape)
    gain = ((x - points) @ SHORTEST.T).reshape(rows, blocks * len(SHORTEST))
    return points, np.argpartition(-gain, probes - 1, axis=1)[:, :probes]


class Hasher:
    """Tables of random projections to E8 blocks for vectors of one length."""

    def __init__(self, length: int, tables: int, blocks: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng([seed, length])
        self.tables, self.blocks, self.probes = tables, blocks, probes
        self.projections = rng.standard_normal((tables, length, 8 * blocks)) / width
        self.shifts = rng.random((tables, 8 * blocks)) * 2
        self.mix = rng.integers(1, 1 << 63, (tables, blocks, 8), dtype="uint64") | np.uint64(1)
        self.start = rng.integers(1, 1 << 63, tables, dtype="uint64")
        self.planes = rng.standard_normal((length, BITS))

    def cells(self, u: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) hashes: the own cell, then the visited ones."""
        out = np.empty((len(u), self.tables, 1 + self.probes), "int64")
        for t in range(self.tables):
            x = (u @ self.projections[t] + self.shifts[t]).reshape(len(u), self.blocks, 8)
            points, moves = neighbours(x, self.probes)
            whole = lambda p: np.rint(2 * p).astype("int64").astype("uint64")
            own = (whole(points) * self.mix[t]).sum(axis=(1, 2), dtype="uint64") + self.start[t]
            step = np.concatenate([(whole(SHORTEST) * self.mix[t, b]).sum(axis=1, dtype="uint64") for b in range(self.blocks)])
            h = np.concatenate([own[:, None], own[:, None] + step[moves]], axis=1)  # hashes are sums, so a move adds its own
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[:, t] = (h ^ (h >> np.uint64(32))).view("int64")
        return out

    def sketches(self, u: np.ndarray) -> np.ndarray:
        return np.packbits(u @ self.planes > 0, axis=1)


def meeting_chance(distance: float, blocks: int, width: float, probes: int, draws: int = 20_000) -> float:
    """Chance that two unit vectors at this distance meet in a table, by a fixed random experiment:
    their projections differ by normal numbers, whatever the vectors' length."""
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(draws // 2000):
        x = rng.random((2000, blocks, 8)) * 2
        y = x + rng.standard_normal(x.shape) * distance / width
        (p, moves), (q, back) = neighbours(x, probes), neighbours(y, probes)
        gap = (q - p).reshape(len(p), -1)
        step = np.zeros((blocks * len(SHORTEST), blocks * 8))
        for b in range(blocks):
            step[b * 240 : (b + 1) * 240, b * 8 : b * 8 + 8] = SHORTEST
        visits = lambda m, g: (step[m] == g[:, None, :]).all(axis=2).any(axis=1)
        met += int(((gap == 0).all(axis=1) | visits(moves, gap) | visits(back, -gap)).sum())
    return met / draws


def tables_for(threshold: float, recall: float, blocks: int, width: float, probes: int) -> int:
    """Tables with which a pair at ``threshold`` meets somewhere with chance ``recall``."""
    p = meeting_chance(math.sqrt(2 - 2 * threshold), blocks, width, probes)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(max(p, 1e-6), 1 - 1e-9))))


def unit(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(vectors scaled by their largest component, their unit vectors); none is zero."""
    x = np.frombuffer(b"".join(cells), "<f8").reshape(len(cells), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x, h1, h2), written: x is null where the vector can't link; h1 and h2 stand for it."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = finite(v) & F.coalesce(F.exists(v, lambda c: c != 0), F.lit(False))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b[0], pa.array([None if c is None else np.asarray(c.values, "<f8").tobytes() for c in (x if x.is_valid else None for x in b[1])], pa.binary())], ["vec_id", "x"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(fine, v).alias("v"))
    packed = rows.mapInArrow(pack, "vec_id long, x binary")
    return materialize(packed.select("*", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2")), "vectors")


def hashed(nodes: DataFrame, make) -> DataFrame:
    """nodes with cells array<long> (table by table, the own cell first) and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for b in batches:
            x = b["x"].to_pylist()
            sizes = np.array([len(v) // 8 for v in x])
            for length in np.unique(sizes):
                h = hashers.setdefault(int(length), make(int(length)))
                rows = np.flatnonzero(sizes == length)
                for low in range(0, len(rows), 2048):
                    at = rows[low : low + 2048]
                    u = unit([x[i] for i in at])[1]
                    cells, sketch = h.cells(u).reshape(len(at), -1), h.sketches(u)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * cells.shape[1], pa.int32()), pa.array(cells.ravel()))
                    part = b.take(pa.array(at))
                    yield pa.record_batch([*part.columns, lists, pa.array([s.tobytes() for s in sketch], pa.binary())], [*b.schema.names, "cells", "sketch"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.mapInArrow(run, f"{schema}, cells array<long>, sketch binary")


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with their bounds, of rows that are sorted by ``key``; groups are small."""
    rest = None
    for b in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([b]) if b is not None else None
        if rest is not None:
            table = rest if table is None else pa.concat_tables([rest, table])
        if table is None or not table.num_rows:
            continue
        columns = [table[k].to_numpy() for k in key]
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        last = table.num_rows if b is None else int(starts[-1])
        rest = table.slice(last) if b is not None else None
        if last:
            yield table.slice(0, last).combine_chunks(), np.r_[starts[starts < last], last]


def gate(batches: Iterator[pa.RecordBatch], most_bits: int) -> Iterator[pa.RecordBatch]:
    """The rows whose sketch differs from some other row's of their block in ``most_bits`` at most;
    one of the two lies in the cell, and in a block of two parts they are of different parts."""
    for table, bounds in whole_groups(batches, KEY):
        bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u8").reshape(table.num_rows, -1)
        own, part = table["own"].to_numpy(zero_copy_only=False), table["part"].to_numpy()
        cross = table["a"].to_numpy() != table["b"].to_numpy()
        near, sizes = np.zeros(table.num_rows, bool), np.diff(bounds)
        group, left = np.repeat(np.arange(len(sizes)), sizes), np.repeat(bounds[1:], sizes) - np.arange(table.num_rows) - 1
        small = sizes[group] <= 64
        for k in range(1, 64):  # small groups, all at once: every row with the k-th after it
            i = np.flatnonzero(small & (left >= k))
            if not len(i):
                break
            j = i + k
            use = (own[i] | own[j]) & ~(cross[i] & (part[i] == part[j]))
            i, j = i[use], j[use]
            hit = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1) <= most_bits
            near[i[hit]] = near[j[hit]] = True
        for g in np.flatnonzero(sizes > 64):
            s = np.arange(bounds[g], bounds[g + 1])
            for low in range(0, len(s), 256):
                i = s[low : low + 256]
                apart = np.zeros((len(i), len(s)), "int64")
                for word in range(bits.shape[1]):
                    apart += np.bitwise_count(bits[i, word][:, None] ^ bits[s, word][None, :])
                use = (own[i][:, None] | own[s][None, :]) & (i[:, None] != s[None, :]) & ~(cross[i][:, None] & (part[i][:, None] == part[s][None, :]))
                near[i] |= ((apart <= most_bits) & use).any(axis=1)
        kept = table.filter(pa.array(near)).select([*KEY, "part", "own", "node"])
        yield from kept.to_batches()


def met_before(cells: np.ndarray, table: int, cell: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For pairs (i, j): have they met in an earlier table, or in this table's other cell if that
    comes first? cells: (rows, tables, 1 + probes)."""
    out = np.zeros(len(i), bool)
    for t in range(table):
        todo = np.flatnonzero(~out)
        a, b = cells[i[todo], t], cells[j[todo], t]
        out[todo] = (a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1)
    a, b = cells[i, table], cells[j, table]
    # they meet in i's own cell if j comes there, and in j's if i does
    here = np.where((a[:, :1] == b).any(axis=1), a[:, 0], b[:, 0])
    other = np.where((b[:, :1] == a).any(axis=1), b[:, 0], here)
    return out | (np.minimum(here, other) != cell)


def smallest_met(n: int, i: np.ndarray, j: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The smallest node of each row's component under the pairs (i, j)."""
    least = node.copy()
    while True:
        was = least.copy()
        np.minimum.at(least, i, was[j])
        np.minimum.at(least, j, least[i])
        if (least == was).all():
            return least


def verify(batches: Iterator[pa.RecordBatch], threshold: float, probes: int) -> Iterator[pa.RecordBatch]:
    """(node, links, root) of a block's rows: the weights of those vectors whose cosine reaches
    ``threshold`` and that first meet here, and the smallest node linked in this block."""
    for table, bounds in whole_groups(batches, KEY):
        x, nodes, weights = table["x"].to_pylist(), table["node"].to_numpy(), table["n"].to_numpy()
        own, part = table["own"].to_numpy(zero_copy_only=False), table["part"].to_numpy()
        a, b, tab, cell = (table[k].to_numpy() for k in ("a", "b", "tab", "cell"))
        cells = table["cells"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1, 1 + probes)
        out = []
        for low, high in zip(bounds[:-1], bounds[1:]):
            sizes = np.array([len(v) for v in x[low:high]])
            for size in np.unique(sizes):  # vectors of other lengths share a cell by chance only
                s = low + np.flatnonzero(sizes == size)
                raw, u = unit([x[k] for k in s])
                links, pairs = np.zeros(len(s), "int64"), []
                for at in range(0, len(s), 512):
                    cos = u[at : at + 512] @ u.T
                    i, j = np.nonzero(cos >= threshold - 1e-9)
                    value, i = cos[i, j], i + at
                    keep = (i < j) & (own[s[i]] | own[s[j]])
                    if a[low] != b[low]:
                        keep &= part[s[i]] != part[s[j]]
                    i, j, value = i[keep], j[keep], value[keep]
                    close = np.flatnonzero(value < threshold + 1e-9)  # these decide by the formula itself
                    p, q = raw[i[close]], raw[j[close]]
                    sure = np.ones(len(i), bool)
                    sure[close] = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1))) >= threshold
                    pairs.append((i[sure], j[sure]))
                i, j = (np.concatenate(c) for c in zip(*pairs))
                fresh = ~met_before(cells[s], int(tab[low]), int(cell[low]), i, j)
                i, j = i[fresh], j[fresh]
                if not len(i):
                    continue
                np.add.at(links, i, weights[s[j]])
                np.add.at(links, j, weights[s[i]])
                roots = smallest_met(len(s), i, j, nodes[s])
                told = np.flatnonzero(links)
                out.append((nodes[s[told]], links[told], roots[told]))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "links", "root"])


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    recall: float = 0.9999,
    width: float = 1.0,
    probes: int = 8,
    blocks: int | None = None,
    block_rows: int = 1024,
    seed: int = 29,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Linked are vectors whose cosine, in double precision, is at least ``threshold``; none below it
    is. A pair at the threshold is met with chance ``recall``, nearer ones with more. Vectors that
    are null, empty, zero or hold null or non-finite numbers link with nothing, nor do vectors of
    different lengths. Repeated rows of an id are vectors of their own, linked like others; equal
    vectors link. A row with a null id counts as a link of others; its component is the smallest
    id that isn't null, or null, and it is kept only if that is null. An empty table gives no
    rows; other columns play no role. ``blocks`` of 8 coordinates make a cell; by default one
    up to a million different vectors and one more for each thousandfold, so that cells stay small.
    A cell of many near vectors is compared in blocks of ``block_rows``, all its vectors with each
    other, for their links are to be counted.
    """
    rows = vectors(df, id_col, vector_col)
    same = rows.where("x is not null").groupBy("x").agg(F.first("h1").alias("h1"), F.first("h2").alias("h2"), F.min("vec_id").alias("lo"), F.count(F.lit(1)).alias("n"))
    nodes = materialize(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    blocks = blocks or 1 + max(0, math.ceil(math.log10(max(n, 1)) / 3) - 2)
    tables = tables_for(threshold, recall, blocks, width, probes)
    coded = materialize(hashed(nodes.select("node", "x", "n"), lambda d: Hasher(d, tables, blocks, width, probes, seed)), "cells")
    place = F.posexplode("cells").alias("pos", "cell")
    entries = coded.select("node", "sketch", place).select(
        F.floor(F.col("pos") / (1 + probes)).cast("int").alias("tab"), "cell", (F.col("pos") % (1 + probes) == 0).alias("own"), "node", "sketch"
    )
    held = entries.groupBy("tab", "cell").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("own").cast("int")).alias("owns")).where("rows > 1 and owns > 0")
    held = materialize(held.select("tab", "cell", "rows", F.ceil(F.col("rows") / block_rows).cast("int").alias("parts")), "held")
    live = meet(entries, held, ["tab", "cell"], "rows", n * tables * (1 + probes))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = live.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("tab", "cell", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "own", "node", "sketch")
    chance = math.acos(threshold) / math.pi
    most_bits = math.ceil(BITS * chance + 6.5 * math.sqrt(BITS * chance * (1 - chance)))
    passed = dealt.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(lambda b: gate(b, most_bits), "tab int, cell long, a int, b int, part int, own boolean, node long")
    met = few(materialize(passed, "met"))
    fetched = met.join(coded.select("node", "x", "n", "cells"), "node").repartition(*KEY).sortWithinPartitions(*KEY)
    found = materialize(fetched.mapInArrow(lambda b: verify(b, threshold, probes), "node long, links long, root long"), "found")
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = materialize(nodes.join(few(roots), "node", "left").select("node", "h1", "h2", "lo", "n", F.coalesce("root", "node").alias("root"), F.col("root").isNotNull().alias("linked")), "named")
    least = materialize(named.where("linked").groupBy("root").agg(F.min("lo").alias("least"), F.count(F.lit(1)).alias("size")), "least")
    inside = meet(named.where("linked"), least, ["root"], "size", n)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    inside = inside.join(links, "node").select("h1", "h2", "n", (F.col("n") - 1 + F.col("links")).alias("n_links"), "least")
    copies = named.where("not linked and n > 1").select("h1", "h2", "n", (F.col("n") - 1).alias("n_links"), F.col("lo").alias("least"))
    facts = materialize(inside.unionByName(copies), "facts")
    usable, rest = rows.where("x is not null").select("vec_id", "h1", "h2"), rows.where("x is null").select("vec_id")
    total = rows.count()
    told = meet(usable, facts, ["h1", "h2"], "n", total, how="left")
    whole = told.select("vec_id", "n_links", F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("least"))
    whole = whole.unionByName(rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("least")))
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("least").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("least")).alias("kept"))
