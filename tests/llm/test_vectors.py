"""Lattice near-duplicates, vector codes and filter audits against plain re-implementations."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metalake.llm import filter_audit, lattice, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, n_links string, lo int, x int"


def odd_vectors(spark, schema=VECTORS):
    """Groups of near vectors of several sizes, one of them large, exact and scaled copies, repeated
    rows and ids, vectors that can't link, other lengths, null ids and clashing columns."""
    rng = np.random.default_rng(4)
    rows, at = [], itertools.count(10)
    for size, noise in ((2, 0.05), (3, 0.25), (5, 0.15), (90, 0.03), (40, 0.22)):
        base = rng.standard_normal(16)
        base /= np.linalg.norm(base)
        for _ in range(size):
            z = rng.standard_normal(16)
            rows.append((next(at), (base + noise * z / np.linalg.norm(z)).tolist()))
    for _ in range(60):
        rows.append((next(at), rng.standard_normal(16).tolist()))
    twin = rng.standard_normal(16).tolist()
    rows += [(3, twin), (2, twin), (2, twin), (4, [3.0 * v for v in twin]), (None, twin), (None, None)]
    rows += [(5, None), (6, []), (7, [0.0] * 16), (8, [float("nan")] + twin[1:]), (9, [float("inf")] + twin[1:]), (1, [None] + twin[1:]), (0, twin[:8]), (-1, twin[:8])]
    return spark.createDataFrame([(i, v, None if k % 3 == 0 else k % 5, "a", 1, 2) for k, (i, v) in enumerate(rows)], schema)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def linked_plainly(rows, threshold):
    """Counter of (vec_id, n_links, component_id, kept)."""
    links = defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i].embedding, rows[j].embedding
        if usable(a) and usable(b) and len(a) == len(b) and any(a) and any(b):
            if np.dot(a, b) / math.sqrt(np.dot(a, a)) / math.sqrt(np.dot(b, b)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out, seen = Counter(), set()
    for start in range(len(rows)):
        if start in seen:
            continue
        group, todo = {start}, [start]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        least = min((rows[i].vec_id for i in group if rows[i].vec_id is not None), default=None)
        for i in group:
            out[rows[i].vec_id, len(links[i]), least, rows[i].vec_id == least] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"block_rows": 16}, {"blocks": 2, "width": 1.4}, {"threshold": 0.9}])
def test_near_vectors(spark, options):
    df = odd_vectors(spark)
    got = lattice.near_vectors(df, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == linked_plainly(df.collect(), options.get("threshold", 0.95))


def test_near_vectors_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert lattice.near_vectors(empty).count() == 0
    alone = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, lattice.near_vectors(alone).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    huge = spark.createDataFrame([(1, [1e300, 1e300]), (2, [1e-300, 1e-300])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, lattice.near_vectors(huge).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_decoded_points_are_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.uniform(-3, 3, (400, 8))
    points = lattice.decode_e8(x)
    twice = np.rint(points * 2)
    assert (points * 2 == twice).all() and ((twice % 2 == 0).all(axis=1) | (twice % 2 != 0).all(axis=1)).all() and (points.sum(axis=1) % 2 == 0).all()
    own = ((x - points) ** 2).sum(axis=1)
    others = ((x[:, None, :] - points[:, None, :] - lattice.SHORTEST[None]) ** 2).sum(axis=2)
    assert len(lattice.SHORTEST) == 240 and np.allclose((lattice.SHORTEST**2).sum(axis=1), 2) and (own[:, None] <= others + 1e-9).all()
    _, moves = lattice.neighbours(x[:, None, :], 5)
    for row, move in zip(others, moves):
        assert set(np.round(np.sort(row)[:5], 9)) == set(np.round(np.sort(row[move]), 9))


def test_recall_follows_from_the_tables():
    """At the threshold itself, 4000 pairs: all but a few in ten thousand meet."""
    rng = np.random.default_rng(8)
    tables = lattice.tables_for(0.95, 0.9999, 1, 1.0, 8)
    h = lattice.Hasher(32, tables, 1, 1.0, 8, 29)
    u = rng.standard_normal((4000, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    z = rng.standard_normal(u.shape)
    z -= (z * u).sum(axis=1, keepdims=True) * u
    v = 0.95 * u + math.sqrt(1 - 0.95**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = h.cells(u), h.cells(v)
    met = ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any(axis=(1, 2))
    assert met.mean() >= 0.999
    far = np.bitwise_count(h.sketches(u) ^ h.sketches(v)).sum(axis=1)
    assert far.max() <= math.ceil(256 * 0.1011 + 6.5 * math.sqrt(256 * 0.1011 * 0.8989))


def coded_plainly(rows, parts, entries, rounds, scale):
    """Codes in Python integers, one row after the other."""
    most = 1 << 24
    kept = [r for r in rows if usable(r.embedding)]
    lengths = Counter(len(r.embedding) for r in kept)
    d = max(lengths, key=lambda n: (lengths[n], n))
    kept = [r for r in kept if len(r.embedding) == d]
    width = -(-d // parts)
    q = [[max(-most, min(most, math.floor(scale * c))) for c in r.embedding] for r in kept]
    cut = [[tuple((v + [0] * (width * parts - d))[p * width : (p + 1) * width]) for p in range(parts)] for v in q]
    seeds = sorted(range(len(kept)), key=lambda i: (kept[i].vec_id is None, kept[i].vec_id or 0, q[i]))[:entries]
    books = [[cut[i][p] for i in seeds] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in cut:
                held[near(v[p], books[p])[1]].append(v[p])
            books[p] = [tuple(sum(c) // len(held[k]) for c in zip(*held[k])) if k in held else e for k, e in enumerate(books[p])]
    told = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    coded = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(e for e, _ in c) for c in coded]
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r.label] += e
    return Counter((r.vec_id, "".join(f"{k:02x}" for _, k in c), e, by_label[r.label], told) for r, c, e in zip(kept, coded, errors))


@pytest.mark.parametrize("options", [{}, {"parts": 5, "entries": 7, "rounds": 3, "per_owner": 20}, {"entries": 256, "rounds": 1}, {"scale": 1 << 30, "rounds": 2}])
def test_vector_codes(spark, options):
    df = odd_vectors(spark, VECTORS.replace("array<float>", "array<double>"))
    got = vector_codes.compress(df, **options)
    want = {"parts": 16, "entries": 64, "rounds": 2, "scale": 256} | {k: v for k, v in options.items() if k != "per_owner"}
    assert Counter(map(tuple, got.collect())) == coded_plainly(df.collect(), **want)


def test_vector_codes_of_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert Counter(map(tuple, vector_codes.compress(df).collect())) == coded_plainly(df.collect(), 16, 64, 2, 256)


def test_vector_codes_of_nothing(spark):
    assert vector_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1), (2, [], 1)], "vec_id long, embedding array<float>, label int")).count() == 0
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([], VECTORS), entries=300)


def test_only_members_that_change_are_dealt_again(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows, d = vector_codes.whole_vectors(df, "vec_id", "embedding", None, 256)
    seeds = [r.q for r in rows.orderBy("vec_id").limit(64).collect()]
    book = vector_codes.in_parts(np.array(seeds, "int64"), 16, d // 16).transpose(1, 0, 2).copy()
    first = vector_codes.settled(vector_codes.first_members(rows, d, book, 1), "first")
    new = vector_codes.updated(first, book)
    stay, moved = vector_codes.migrated([first], new, 1)
    was = Counter((r.pos, tuple(r.part)) for r in first.collect() for _ in range(r.n))
    now = Counter((r.pos, tuple(r.part)) for part in (stay, moved) for r in part.collect() for _ in range(r.n))
    assert was == now and 0 < moved.count() < stay.count()
    old = {(r.pos, tuple(r.part)): r.entry for r in first.collect()}
    assert all(old[r.pos, tuple(r.part)] == r.entry for r in stay.collect()) and all(old[r.pos, tuple(r.part)] != r.entry for r in moved.collect())


def audited_plainly(docs, labels):
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    first = {}
    for r in docs:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    rows = []
    for r in docs:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        fails["E"] = r.doc_id is not None and r.doc_id > first[text]
        rows.append((r.lang or "", {k for k, v in fails.items() if v}, r.doc_id in good, r.doc_id in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                earlier = sum(r[0] == part and f in r[1] for r in rows) - len(gone)
                left = [r for r in left if f not in r[1]]
                alone = sum(r[0] == part and r[1] == {f} for r in rows)
                out[part, order, step] = [len(left), len(gone), earlier, alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, f] += len(gone)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark, small, odd, empty):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    strange = spark.createDataFrame([(3, 1, 0, "x"), (3, 0, 1, "x"), (4, None, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (8, 1, None, "x")], "doc_id long, quality int, toxic int, lang string")
    more = small.unionByName(small.limit(40).withColumn("doc_id", F.col("doc_id") + 5000)).unionByName(small.limit(5).withColumn("text", F.lit(None).cast("string")))
    for docs, told in ((small, labels), (odd, strange), (more, labels)):
        got = filter_audit.audit(docs, told)
        assert got.columns == ["part", "filter_order", "step", *filter_audit.MEASURES]
        rows = got.collect()
        assert len(rows) == len(set(rows)) and set(map(tuple, rows)) == audited_plainly(docs.collect(), told.collect())
    assert filter_audit.audit(empty, labels).count() == 0


def test_removal_steps_are_the_first_failing_ones():
    orders = np.array(list(itertools.permutations(range(4))))
    fails = np.array([[m >> i & 1 for i in range(4)] for m in range(16)], bool)
    got = filter_audit.removal_steps(fails, orders)
    for m, row in enumerate(got):
        for order, step in zip(orders, row):
            first = next((s for s, f in enumerate(order) if fails[m, f]), None)
            assert step == first if first is not None else step >= filter_audit.NEVER


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "aa b", "x"), (2, "b", "x"), (3, "b", "y"), (4, "c", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(docs, labels, filters=lambda text: {"P": text.contains("b")}, copies="Q").collect()
    at = {(r.part, r.filter_order, r.step): r for r in rows}
    assert len(at) == 3 * 2 * 2 and at["x", "PQ", 1].removed == 2 and at["x", "PQ", 2].removed == 0 and at["y", "QP", 1].good_lost == 1 and at["y", "QP", 2].redundant == 1
