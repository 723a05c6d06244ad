"""The n-gram join against brute force over all pairs."""

import itertools
import random
from collections import Counter

from metalake.llm import jaccard_join
from metalake.llm.shingles import shingle_sets


def brute(rows, threshold=0.8):
    sets = [set(x.tolist()) for x in shingle_sets([r.text or "" for r in rows])]
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r.doc_id)
    return sorted(((r.doc_id, min(ids[find(i)], key=lambda x: (x is not None, x)), links[i]) for i, r in enumerate(rows)), key=str)


def check(df):
    got = jaccard_join.jaccard_join(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(df.collect())
    return got


def test_links_and_classes(spark, small):
    near = small.where("doc_id < 40").selectExpr("doc_id + 1000 as doc_id", "concat(text, ' one more') as text", "lang", "source", "n_chars")
    got = check(small.unionByName(near))
    assert len({r.class_id for r in got}) == sum(r.leader for r in got)


def test_odd_rows(spark, odd, empty):
    check(odd)
    assert jaccard_join.jaccard_join(empty).count() == 0
    kept = jaccard_join.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert kept.where("text like 'one two%'").count() == 1


def test_dense_group_in_blocks(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(base[:k] + [f"x{k}"] + base[k + 1 :])) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_join(df, limit=16).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(df.collect())


def test_runs_grow_with_the_target():
    assert jaccard_join.runs_needed(0.999, 1) < jaccard_join.runs_needed(0.999, 3) < jaccard_join.runs_needed(0.99999, 3)


def test_recall_in_buckets_above_the_limit(spark):
    rng, rows = random.Random(6), []
    for k in range(1500):
        words = [f"w{rng.getrandbits(40)}" for _ in range(54)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:44]))]  # 50 and 40 shingles: 0.8
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), limit=1).collect()
    assert sum(r.n_links for r in got) >= 2 * 1500 * 0.9965  # every bucket is split to the last level


def test_tiny_near_copies(spark):
    """Thousands of pairs of 5 and 4 shingles (similarity 0.8), and of pairs just below it."""
    rng, rows = random.Random(9), []
    for k in range(4000):
        words = [f"w{rng.getrandbits(40)}" for _ in range(12)]
        size, cut = [(9, 8), (10, 9), (8, 7), (12, 10)][k % 4]  # shingles 5/4, 6/5, 4/3, 8/6
        rows += [(2 * k, " ".join(words[:size])), (2 * k + 1, " ".join(words[:cut]))]
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [k for k in range(4000) if got[2 * k].n_links]
    assert all(k % 4 < 2 and got[2 * k + 1].class_id == 2 * k and got[2 * k].n_links == 1 for k in linked)
    assert len(linked) >= 0.998 * 2000


def test_hub_of_a_component(spark):
    """A star, a path and a ring: the smallest node of each, whatever hangs on the hub."""
    from metalake.llm.components import components

    edges = [(k, 0) for k in range(1, 6000)] + [(k, k + 1) for k in range(10_000, 10_040)] + [(20_000 + k, 20_000 + (k + 1) % 7) for k in range(7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in range(6000)} | {n: 10_000 for n in range(10_000, 10_041)} | {n: 20_000 for n in range(20_000, 20_007)}


def test_clashing_names_and_hot_groups(spark):
    """Columns named like the results; a third of all rows are one text, another third near copies."""
    same = " ".join(f"s{i}" for i in range(30))
    rows = [(k, same, 1, 2, "x") for k in range(200)]
    rows += [(1000 + k, " ".join(f"t{i}" for i in range(60)) + f" end{k}", 1, 2, "x") for k in range(200)]
    rows += [(2000 + k, " ".join(f"u{k}v{i}" for i in range(20)), 1, 2, "x") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_links int, class_id int, leader string")
    assert len({r.class_id for r in check(df)}) == 202
    kept = jaccard_join.drop_near_copies(df)
    assert kept.columns == df.columns and kept.count() == 202


def test_tokens_are_written_once(spark, monkeypatch):
    seen = []
    write = jaccard_join.materialize
    monkeypatch.setattr(jaccard_join, "materialize", lambda df, tag: (seen.append(df.columns), write(df, tag))[1])
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, " ".join(words)), (4, "other words that stand alone here"), (5, None)]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {1: (1, 2), 2: (1, 2), 3: (1, 2), 4: (4, 0), 5: (5, 0)}
    assert sum("tokens" in columns for columns in seen) == 1
