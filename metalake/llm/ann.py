"""Approximate nearest neighbours (largest inner product) with balanced posting lists.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) with M the largest
norm (0 for queries). Centroids come from balanced two-way k-means on a bounded sample. Each
vector goes to its nearest list and, near a boundary, to further lists whose distance is
within ``spread`` times the nearest one's. Long lists are dealt to chunks, so that no list
is one task's burden. A query finds lists by a greedy walk on the centroids' neighbour graph,
which every task holds in memory; lists beyond a ratio of the nearest distance are pruned.
Lists and queries then meet by list number; blocks are compared by matrix products.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import draw, materialize


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x binary of float64, norm) of vectors that are not null or zero, of finite
    numbers, and of the commonest length (ties: the longer), equal rows once."""
    x = F.col(vector_col).cast("array<double>")
    big = F.lit(float("inf"))
    fine = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < big), F.lit(False))) & F.exists(x, lambda v: v != 0)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v")).where(F.col("vec_id").isNotNull() & fine)
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = top["d"] if top else 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.asarray(b[1].flatten(), "<f8").reshape(-1, d)
            yield pa.record_batch([b[0], pa.array([r.tobytes() for r in v], pa.binary()), pa.array(np.sqrt((v * v).sum(axis=1)))], ["vec_id", "x", "norm"])

    packed = rows.where(F.size("v") == d).mapInArrow(pack, "vec_id long, x binary, norm double")
    return materialize(packed.dropDuplicates(["vec_id", "x"]), "vectors")


def matrix(column) -> np.ndarray:
    cells = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(cells), "<f8").reshape(len(cells), -1)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top * top - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def halves(points: np.ndarray, most: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Centroids of balanced two-way splits down to ``most`` points each."""
    done, work = [], [points]
    while work:
        p = work.pop()
        if len(p) <= most or (p == p[0]).all():
            done.append(p.mean(axis=0))
            continue
        a, b = p[rng.integers(len(p))], p[rng.integers(len(p))]
        for _ in range(8):
            lean = ((p - a) ** 2).sum(axis=1) - ((p - b) ** 2).sum(axis=1)
            order = np.argsort(lean, kind="stable")
            cut = min(max(int((lean < 0).sum()), len(p) // 3), len(p) - len(p) // 3)  # at least a third on either side
            left, right = p[order[:cut]], p[order[cut:]]
            a, b = left.mean(axis=0), right.mean(axis=0)
        work += [left, right]
    return done


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


class Graph:
    """Neighbour graph of centroids, walked greedily from a few entry points."""

    def __init__(self, centroids: np.ndarray, degree: int = 24):
        self.centroids = centroids
        k = len(centroids)
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 8)).astype(int))
        neighbours = []
        step = max(1, min(1024, 4_000_000 // k))  # a block of distances stays small
        for low in range(0, k, step):
            near = distances(centroids[low : low + step], centroids)
            near[np.arange(len(near)), low + np.arange(len(near))] = np.inf
            neighbours.append(np.argsort(near, axis=1, kind="stable")[:, : min(degree, k - 1)])
        own = np.vstack(neighbours) if k > 1 else np.empty((k, 0), int)
        links = [set(x.tolist()) for x in own]
        for i, x in enumerate(own):
            for j in x.tolist():
                links[j].add(i)
        self.links = [np.array(sorted(x), int) for x in links]

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``beam`` lists near q, nearest first, with their distances."""
        seen = np.zeros(len(self.centroids), bool)
        seen[self.entries] = True
        start = ((self.centroids[self.entries] - q) ** 2).sum(axis=1)
        open_ = list(zip(start.tolist(), self.entries.tolist()))
        heapq.heapify(open_)
        best = [(-d, i) for d, i in open_]
        heapq.heapify(best)
        while len(best) > beam:
            heapq.heappop(best)
        while open_:
            d, i = heapq.heappop(open_)
            if len(best) >= beam and d > -best[0][0]:
                break
            new = self.links[i][~seen[self.links[i]]]
            seen[new] = True
            if not len(new):
                continue
            far = ((self.centroids[new] - q) ** 2).sum(axis=1)
            for d, j in zip(far.tolist(), new.tolist()):
                if len(best) < beam or d < -best[0][0]:
                    heapq.heappush(open_, (d, j))
                    heapq.heappush(best, (-d, j))
                    if len(best) > beam:
                        heapq.heappop(best)
        found = sorted((-d, j) for d, j in best)
        return np.array([j for _, j in found]), np.sqrt([d for d, _ in found])


POINTS = 4


def build_graph(vectors: DataFrame, top: float, sample: int, most_sample: int, list_size: int, n: int) -> Graph:
    """Centroids from the vectors of smallest id hash: at least ``sample``, and as many more as
    give every list of ``list_size`` vectors ``POINTS`` of them, up to ``most_sample``."""
    size = min(max(sample, POINTS * n // list_size), most_sample)
    points = lifted(np.vstack([matrix([r["x"]]) for r in draw(vectors, "vec_id", n, size).select("x").toLocalIterator()]), top)
    most = max(POINTS, int(list_size * len(points) / max(n, 1)))
    return Graph(np.vstack(halves(points, most, np.random.default_rng(7))))


def assign(vectors: DataFrame, graph, top: float, copies: int, spread: float) -> DataFrame:
    """(list, vec_id, x, own): the nearest list (own) and further ones near a boundary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = graph.value.centroids
        step = max(1, min(1024, 4_000_000 // len(centroids)))
        for b in batches:
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                if not part.num_rows:
                    continue
                d = distances(lifted(matrix(part[1]), top), centroids)
                order = np.argpartition(d, min(copies, d.shape[1]) - 1, axis=1)[:, :copies]
                d = np.take_along_axis(d, order, axis=1)
                nearest = d.min(axis=1, keepdims=True)
                row, col = np.nonzero((d <= spread * nearest) | (d == nearest))
                at = pa.array(row)
                best = order[np.arange(len(order)), d.argmin(axis=1)]
                yield pa.record_batch([pa.array(order[row, col]), part[0].take(at), part[1].take(at), pa.array(order[row, col] == best[row])], ["list", "vec_id", "x", "own"])

    return vectors.select("vec_id", "x").mapInArrow(run, "list long, vec_id long, x binary, own boolean")


def best_per_id(s: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of scores and distinct id, the column of its best score; and the ids."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, ids[order][1:] != ids[order][:-1]])
    if len(first) == len(ids):
        return np.broadcast_to(order, s.shape), ids[order]
    ends = np.r_[first[1:], len(ids)]
    at = np.repeat(order[first][None, :], len(s), axis=0)
    for g in np.flatnonzero(ends - first > 1):
        own = order[first[g] : ends[g]]
        at[:, g] = own[s[:, own].argmax(axis=1)]
    return at, ids[order[first]]


def calibrate(vectors: DataFrame, lists: DataFrame, graph, top: float, n: int, k: int, probes: int, target: float) -> tuple[int, float]:
    """(lists to search, distance ratio) with which ``target`` of the true neighbours of
    ``probes`` sample vectors are found. Their neighbours come from a pass over all vectors
    that keeps k distinct ones per sample vector and partition, each with its best row."""
    rows = draw(vectors, "vec_id", n, probes).select("vec_id", "x").collect()
    ids, q = np.array([r["vec_id"] for r in rows]), matrix([r["x"] for r in rows])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.full((len(q), 0), -np.inf), np.empty((len(q), 0), "int64"), np.empty((len(q), 0), "int64")]  # score, id, row
        for b in batches:
            for low in range(0, b.num_rows, 4096):
                part = b.slice(low, 4096)
                if not part.num_rows:
                    continue
                own, row = part[0].to_numpy(), part[2].to_numpy()
                s = np.where(own[None, :] == ids[:, None], -np.inf, q @ matrix(part[1]).T)
                at, distinct = best_per_id(s, own)
                new = [np.take_along_axis(s, at, axis=1), np.broadcast_to(distinct, at.shape), row[at]]
                held = [np.hstack(x) for x in zip(held, new)]
                keep = np.argsort(-held[0], axis=1, kind="stable")[:, : 2 * k]  # an id is there twice at most
                held = [np.take_along_axis(x, keep, axis=1) for x in held]
                same = np.tril(held[1][:, :, None] == held[1][:, None, :], -1).any(axis=2)
                held[0] = np.where(same, -np.inf, held[0])
                keep = np.argsort(-held[0], axis=1, kind="stable")[:, :k]
                held = [np.take_along_axis(x, keep, axis=1) for x in held]
        at, col = np.nonzero(held[0] > -np.inf)
        yield pa.record_batch([pa.array(at), *(pa.array(held[c][at, col]) for c in (1, 2, 0))], ["probe", "vec_id", "row", "score"])

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id")
    found = vectors.select("vec_id", "x", F.xxhash64("x").alias("row")).mapInArrow(best, "probe long, vec_id long, row long, score double")
    per_id = found.groupBy("probe", "vec_id").agg(F.max_by("row", "score").alias("row"), F.max("score").alias("score"))
    true = per_id.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("probe", "vec_id", "row")
    where = lists.select("vec_id", F.xxhash64("x").alias("row"), "list").join(F.broadcast(true), ["vec_id", "row"]).groupBy("probe", "vec_id").agg(F.collect_set("list").alias("lists"))
    places, ratios = [], []
    walks = {}
    for r in where.collect():  # at most probes * k rows
        if r["probe"] not in walks:
            v = q[r["probe"]]
            near, far = graph.search(np.append(v * (top / np.linalg.norm(v)), 0.0), len(graph.centroids))
            walks[r["probe"]] = dict(zip(near.tolist(), zip(range(len(near)), far / max(far[0], 1e-300))))
        at = [walks[r["probe"]][x] for x in r["lists"] if x in walks[r["probe"]]]
        place, ratio = min(at, default=(len(graph.centroids), 2.0))
        places.append(place)
        ratios.append(ratio)
    if not places:
        return 1, 1.0
    return int(np.quantile(places, target, method="higher")) + 1, float(np.quantile(ratios, (1 + target) / 2, method="higher"))


def nearest(
    df: DataFrame,
    queries,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    list_size: int = 400,
    sample: int = 20_000,
    most_sample: int = 400_000,
    copies: int = 4,
    spread: float = 1.12,
    beam: int = 48,
    ratio: float = 1.25,
    probes: int = 64,
    target: float = 0.97,
    chunk: int = 4096,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's ``k`` largest inner products.

    ``queries`` is a condition on vec_id. Candidates are all vectors but the query's own id;
    ties go to the smaller id. Scores are float64 inner products of the original vectors.
    Vectors that are null, zero or hold null or non-finite numbers take no part, nor do null
    ids and vectors of another length than the commonest. Repeated rows of an id count as
    one candidate, with its best score. No usable vector: no rows. At least ``k`` candidates
    are always looked at, if there are as many. ``beam`` lists within ``ratio`` of the nearest
    are searched at least; both are raised until ``target`` of the true neighbours of
    ``probes`` sample vectors are reached. Centroids are fitted on a sample that grows with the
    table from ``sample`` to ``most_sample`` vectors (bounded, documented), so lists stay near
    ``list_size`` up to 40 million vectors; beyond that lists grow, dealt to chunks as ever.
    """
    spark = df.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    vectors = usable(df, id_col, vector_col)
    total = vectors.agg(F.max("norm").alias("top"), F.countDistinct("vec_id").alias("n")).first()
    if not total["n"]:
        return spark.createDataFrame([], out)
    top, n = total["top"], total["n"]
    graph = spark.sparkContext.broadcast(build_graph(vectors, top, sample, most_sample, list_size, n))
    lists = materialize(assign(vectors, graph, top, copies, spread), "lists")
    held = lists.groupBy("list").agg(F.count(F.lit(1)).alias("rows"))
    owners = lists.where("own").groupBy("vec_id").agg(F.min("list").alias("list"))  # an id counts in one list only
    sizes = np.zeros(len(graph.value.centroids), "int64")
    for r in owners.groupBy("list").agg(F.count(F.lit(1)).alias("own")).collect():  # one row per centroid, bounded by the sample
        sizes[r["list"]] = r["own"]
    owned = spark.sparkContext.broadcast(sizes)
    wide, far_out = calibrate(vectors, lists, graph.value, top, n, k, probes, target)
    beam, ratio = max(beam, wide), max(ratio, far_out)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, own = graph.value, owned.value
        for b in batches:
            ids, found = [], []
            for at, q in enumerate(matrix(b[1])) if b.num_rows else ():
                q = np.append(q * (top / np.linalg.norm(q)), 0.0)  # a query's length doesn't change its order
                width = beam
                while True:
                    near, far = g.search(q, width)
                    take = max(int((far <= ratio * far[0]).sum()), 1)
                    cover = np.cumsum(own[near])
                    take = max(take, int(np.searchsorted(cover, k + 1)) + 1)
                    if take <= len(near) or width >= len(g.centroids):
                        break
                    width *= 4
                near = near[:take] if cover[-1] > k else np.arange(len(g.centroids))
                ids += [at] * len(near)
                found += near.tolist()
            at = pa.array(ids, pa.int64())
            yield pa.record_batch([pa.array(found, pa.int64()), b[0].take(at), b[1].take(at)], ["list", "query_id", "q"])

    asked = vectors.where(queries(F.col("vec_id"))).select("vec_id", "x").dropDuplicates().mapInArrow(walk, "list long, query_id long, q binary")
    asked = materialize(asked, "asked")
    held = held.select("list", F.ceil(F.col("rows") / chunk).cast("int").alias("parts"))
    deal = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("blocks")).join(held, "list")
    grid = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(deal, "list").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).withColumn("part", grid("parts"))
    right = lists.join(deal, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).withColumn("block", grid("blocks"))

    def compare(key: tuple, asks: pd.DataFrame, has: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(has):
            return pd.DataFrame({"query_id": np.empty(0, "int64"), "vec_id": np.empty(0, "int64"), "score": np.empty(0)})
        q, x, ids = matrix(asks["q"]), matrix(has["x"]), has["vec_id"].to_numpy()
        asked_ids, repeats = asks["query_id"].to_numpy(), len(np.unique(ids)) < len(ids)
        out_q, out_v, out_s = [], [], []
        for low in range(0, len(q), 256):
            s = q[low : low + 256] @ x.T
            s[ids[None, :] == asked_ids[low : low + 256, None]] = -np.inf
            top_s = np.take_along_axis(s, best_per_id(s, ids)[0], axis=1) if repeats else s
            bound = np.partition(top_s, top_s.shape[1] - k, axis=1)[:, top_s.shape[1] - k] if top_s.shape[1] > k else np.full(len(s), -np.inf)
            slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(bound), bound, 0)))
            row, col = np.nonzero((s >= (bound - slack)[:, None]) & (s > -np.inf))
            exact = (x[col] * q[low + row]).sum(axis=1)  # the same order of additions for every pair
            if repeats:
                order = np.lexsort((-exact, ids[col], row))
                row, col, exact = row[order], col[order], exact[order]
                fresh = np.r_[True, (row[1:] != row[:-1]) | (ids[col[1:]] != ids[col[:-1]])][: len(row)]
                row, col, exact = row[fresh], col[fresh], exact[fresh]
            order = np.lexsort((ids[col], -exact, row))
            row, col, exact = row[order], col[order], exact[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < k
            out_q.append(asked_ids[low + row[kept]])
            out_v.append(ids[col[kept]])
            out_s.append(exact[kept])
        return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    key = ["list", "part", "block"]
    pairs = left.select(*key, "query_id", "q").groupBy(*key).cogroup(right.select(*key, "vec_id", "x").groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
