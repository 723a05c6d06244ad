"""The quality classifier: what EM estimates against labels, and the whole query against a plain version."""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from metalake.llm import quality
from metalake.llm.queries import op8_quality

SF = "/root/testdata/sf0.01"


def test_estimated_accuracies_agree_with_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs)
    rows = quality.voted(docs, "text").join(labels, "doc_id").where("quality is not null").select("__votes", "quality").collect()
    assert abs(model["good_share"] - sum(r.quality == 1 for r in rows) / len(rows)) < 0.05
    told = 0
    for k, (bad, good) in enumerate(model["accuracies"].values()):
        for vote, estimate, right, margin in (("0", bad, 0, 0.2), ("2", good, 1, 0.05)):
            got = [r.quality == right for r in rows if r["__votes"][k] == vote]
            if len(got) >= 10:
                told += 1
                assert abs(sum(got) / len(got) - estimate) < margin
    assert told >= 8


def plain_statistics(text):
    """The labellers' numbers, a character at a time."""
    tokens = text.split()
    n = len(tokens)
    lower, upper = sum("a" <= c <= "z" for c in text), sum("A" <= c <= "Z" for c in text)
    space, symbols, wide = sum(c in " \t\n\r\v\f" for c in text), sum(c in "#$%&*+/<=>@[\\]^_`{}~" for c in text), sum(c > "\x7f" for c in text)
    letters, solid, lines = lower + upper + wide, max(1, len(text) - space), [x for x in text.split("\n") if x]
    top = max(Counter(tokens).values()) / n if n >= 20 else 0.05
    repeated = 1 - len(set(lines)) / len(lines) if len(lines) > 2 else 0.0
    stutter = sum(tokens[i] == tokens[i + 1] for i in range(n - 1)) / max(n, 20)
    return [symbols / solid, upper / max(1, letters), top, min(1.0, len(set(tokens)) / n**0.7), text.count("|") / n, repeated, letters / solid, letters / n, stutter]


def plain_votes(stats):
    out = []
    for at, low, good, upto, high in quality.LABELLERS.values():
        bad = stats[at] < low or stats[at] > high
        out.append(-1 if bad else 1 if good <= stats[at] <= upto else 0)
    return tuple(out)


def plain_posteriors(patterns):
    """EM over a dictionary of patterns, a number at a time."""
    total, kinds = sum(patterns.values()), [k for k, rule in enumerate(quality.LABELLERS.values()) if rule[2] == math.inf]
    n_labellers = len(quality.LABELLERS)
    first = [[{-1: 0.02, 0: 0.28, 1: 0.70} if c == 0 else {-1: 0.25, 0: 0.45, 1: 0.30} for _ in range(n_labellers)] for c in range(1 + len(kinds))]
    for c, row in enumerate(first):
        for k in kinds:
            own = c > 0 and kinds[c - 1] == k
            row[k] = {-1: 0.90, 0: 0.09, 1: 0.01} if own else {-1: 0.002, 0: 0.988, 1: 0.01} if c == 0 else {-1: 0.02, 0: 0.97, 1: 0.01}
    start = [0.8] + [0.2 / len(kinds)] * len(kinds)
    shares, table, strength = start, first, 1 + total / 500

    def member(pattern):
        p = []
        for share, row in zip(shares, table):
            for k, v in enumerate(pattern):
                share *= row[k][v] if k in kinds else 1 if v == 0 else row[k][v] / (row[k][-1] + row[k][1])
            p.append(share)
        return [x / sum(p) for x in p]

    for _ in range(200):
        of = {pattern: member(pattern) for pattern in patterns}
        new = []
        for c, row in enumerate(first):
            told = []
            for k in range(n_labellers):
                sums = {v: strength * row[k][v] + sum(n * of[p][c] for p, n in patterns.items() if p[k] == v) for v in (-1, 0, 1)}
                told.append({v: s / sum(sums.values()) for v, s in sums.items()})
                if c == 0 and k in kinds and told[k][-1] > 0.005:
                    told[k][0], told[k][-1] = told[k][0] + told[k][-1] - 0.005, 0.005
            new.append(told)
        moved = max(abs(a[v] - b[v]) for x, y in zip(new, table) for a, b in zip(x, y) for v in a)
        shares = [(sum(n * of[p][c] for p, n in patterns.items()) + strength * s) / (total + strength) for c, s in enumerate(start)]
        table = new
        if moved < 1e-7:
            break
    return {p: member(p)[0] for p in patterns}


def plain_features(text):
    x, n_words = np.zeros(quality.BUCKETS), quality.BUCKETS - 81 - 9
    for word in set(text.split()):
        x[int(pd.util.hash_array(np.array([word], dtype=object), categorize=False)[0]) % n_words] += 1
    x[:n_words] /= max(1.0, math.sqrt((x[:n_words] ** 2).sum()))
    kinds = [quality.CLASSES[b] for b in text.encode()]
    for (a, b), n in Counter(zip(kinds, kinds[1:])).items():
        x[n_words + 9 * int(a) + int(b)] = math.sqrt(n / (len(kinds) - 1))
    x[-9:] = [min(s, 20) / d for s, d in zip(plain_statistics(text), (0.2, 1, 0.5, 1, 0.5, 1, 1, 10, 0.3))]
    return x


def plain_scores(docs):
    """doc_id: score of every document that isn't blank, trained on all of them."""
    told = {r.doc_id: r.text for r in docs if (r.text or "").split()}
    votes = {i: plain_votes(plain_statistics(t)) for i, t in told.items()}
    patterns = Counter(votes.values())
    if blank := len(docs) - len(told):
        patterns[plain_votes([0.0] * 9)] += blank
    good = plain_posteriors(patterns)
    order = sorted(told)
    x = np.stack([np.append(plain_features(told[i]), 1.0) for i in order])
    y = np.array([good[votes[i]] for i in order])
    share = min(max(y.mean(), 0.02), 0.98)
    weight, w, speed = y * 0.5 / share + (1 - y) * 0.5 / (1 - share), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = 0.9 * speed - 2.0 * (x.T @ (weight * (p - y)) / len(y) + 1e-3 * w)
        w = w + speed
    return dict(zip(order, 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", SF])
def test_the_whole_query_equals_a_plain_version(spark, sf):
    """Fewer rows than the scorer's bound, so both are trained on all of them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = plain_scores(docs)
    got = {r.doc_id: r for r in op8_quality(spark, sf).collect()}
    assert set(got) == {r.doc_id for r in docs}
    assert all(got[i].score == 0 and not got[i].keep for i in got if i not in want)
    assert max(abs(got[i].score - want[i]) for i in want) < 0.005
    assert all(got[i].keep == (want[i] >= 0.5) for i in want if abs(want[i] - 0.5) > 0.005)
