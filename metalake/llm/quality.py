"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good (1), bad (-1) or nothing (0) on every document.
Votes of all documents are counted by pattern, which is all that expectation-maximisation
needs: it estimates each labeller's accuracy on either class and how often it votes. The
posterior of each pattern then labels a bounded sample on which a hashed linear scorer is
trained; the scorer, not the votes, decides on every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import draw, materialize, small_batches, text_or_empty

#: Byte classes for the counts below: space, lower, upper, digit, full stop, mark, bar, symbol, other.
SPACE, LOWER, UPPER, DIGIT, STOP, MARK, BAR, SYMBOL, WIDE = range(9)
CLASSES = np.full(256, WIDE, "uint8")
for _chars, _kind in ((b" \t\n\r\v\f", SPACE), (bytes(range(97, 123)), LOWER), (bytes(range(65, 91)), UPPER), (b"0123456789", DIGIT), (b".!?", STOP), (b",;:'\"()-", MARK), (b"|", BAR), (b"#$%&*+/<=>@[\\]^_`{}~", SYMBOL)):
    CLASSES[list(_chars)] = _kind
CLASS_TABLE = CLASSES.tobytes()
#: Each labeller: (statistic, bad below, good from, good to, bad above); between them it abstains.
#: Detectors of one kind of junk never vote good; the prose labellers do both.
ALWAYS = float("inf")
LABELLERS: dict[str, tuple[int, float, float, float, float]] = {
    "symbols": (0, -1, ALWAYS, ALWAYS, 0.10),
    "capitals": (1, -1, ALWAYS, ALWAYS, 0.50),
    "top_word": (2, -1, ALWAYS, ALWAYS, 0.25),
    "variety": (3, 0.25, ALWAYS, ALWAYS, ALWAYS),
    "bars": (4, -1, ALWAYS, ALWAYS, 0.15),
    "repeated_lines": (5, -1, ALWAYS, ALWAYS, 0.50),
    "stutter": (8, -1, ALWAYS, ALWAYS, 0.12),
    "letters": (6, 0.30, 0.92, 1.0, ALWAYS),
    "casing": (1, 0.002, 0.008, 0.15, 0.40),
    "common_words": (2, -1, 0.015, 0.16, 0.20),
    "word_length": (7, 2.0, 3.0, 8.0, 12.0),
}
BUCKETS = 4096
N_SHAPE = 81
N_STATS = 9


def statistics(text: str, tokens: list[str], kinds: Counter, classes: np.ndarray) -> list[float]:
    """The numbers the labellers look at, each over the whole text; all 0 for a blank one."""
    n = len(tokens)
    if not n:
        return [0.0] * N_STATS
    count = np.bincount(classes, minlength=9).tolist()
    wide = len(text) - (len(classes) - count[WIDE])  # characters beyond ASCII pass as letters
    letters = count[LOWER] + count[UPPER] + wide
    solid = len(text) - count[SPACE]
    lines = [x for x in text.split("\n") if x]
    return [
        count[SYMBOL] / max(1, solid),
        count[UPPER] / max(1, letters),
        max(kinds.values()) / n if n >= 20 else 0.05,
        min(1.0, len(kinds) / n**0.7),
        count[BAR] / n,
        1 - len(set(lines)) / len(lines) if len(lines) > 2 else 0.0,
        letters / max(1, solid),
        letters / n,
        sum(map(eq, tokens, tokens[1:])) / max(n, 20),
    ]


def votes(stats: list[float]) -> list[int]:
    out = []
    for at, low, good, upto, high in LABELLERS.values():
        x = stats[at]
        out.append(-1 if x < low or x > high else int(good <= x <= upto))
    return out


def parts(text: str) -> tuple[list[str], Counter, np.ndarray]:
    tokens = text.split()
    return tokens, Counter(tokens), np.frombuffer(text.encode("utf-8", "surrogatepass").translate(CLASS_TABLE), "uint8")


def features(text: str) -> np.ndarray | None:
    """Hashed presence of words, pairs of neighbouring byte classes, statistics; None if blank."""
    tokens, kinds, classes = parts(text)
    if not tokens:
        return None
    out = np.zeros(BUCKETS, "float32")
    hashed = pd.util.hash_array(np.array(list(kinds), dtype=object), categorize=False)
    words = np.bincount((hashed % np.uint64(BUCKETS - N_SHAPE - N_STATS)).astype("int64"), minlength=BUCKETS - N_SHAPE - N_STATS)
    out[: len(words)] = words / max(1.0, np.linalg.norm(words))
    pairs = np.bincount(classes[:-1] * np.uint8(9) + classes[1:], minlength=N_SHAPE) if len(classes) > 1 else np.zeros(N_SHAPE)
    out[len(words) : len(words) + N_SHAPE] = np.sqrt(pairs / max(1, pairs.sum()))
    out[-N_STATS:] = np.minimum(np.array(statistics(text, tokens, kinds, classes)), 20) / np.array([0.2, 1, 0.5, 1, 0.5, 1, 1, 10, 0.3])
    return out


#: Labellers that only ever vote bad: each stands for its own kind of junk.
DETECTORS = [k for k, rule in enumerate(LABELLERS.values()) if rule[2] == ALWAYS]


#: A detector may be wrong on this share of good documents at most; else a frequent kind of
#: junk could pass as a kind of good document.
MOST_FALSE = 0.005


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(class shares, P(vote | class)[class, labeller, vote + 1]) by EM; class 0 is good.

    Kinds of junk exclude each other, so the bad side is a mixture with one class for each
    detector; within a class votes are independent. Every class starts from, and is smoothed
    towards, labellers that are usually right (worth 1 document in 500), so that the classes
    keep their meaning.
    """
    weight = counts.astype(float)
    hits = np.stack([(patterns == v).astype(float) for v in (-1, 0, 1)], axis=2)
    prior = np.empty((1 + len(DETECTORS), patterns.shape[1], 3))
    prior[1:] = (0.25, 0.45, 0.30)
    prior[0] = (0.02, 0.28, 0.70)
    prior[:, DETECTORS] = (0.02, 0.97, 0.01)
    prior[0, DETECTORS] = (0.002, 0.988, 0.01)
    for c, k in enumerate(DETECTORS, 1):
        prior[c, k] = (0.90, 0.09, 0.01)
    shares = np.array([0.8] + [0.2 / len(DETECTORS)] * len(DETECTORS))
    start, table, strength = shares, prior, 1 + weight.sum() / 500
    for _ in range(rounds):
        member = membership(patterns, shares, table)
        sums = np.einsum("pc,plv->clv", weight[:, None] * member, hits) + strength * prior
        new = sums / sums.sum(axis=2, keepdims=True)
        over = np.minimum(1, MOST_FALSE / new[0, DETECTORS, 0])
        new[0, DETECTORS, 1] += new[0, DETECTORS, 0] * (1 - over)
        new[0, DETECTORS, 0] *= over
        shares = (weight @ member + strength * start) / (weight.sum() + strength)
        done = np.abs(new - table).max() < 1e-7
        table = new
        if done:
            break
    return shares, table


def membership(patterns: np.ndarray, shares: np.ndarray, table: np.ndarray) -> np.ndarray:
    """P(class | votes) of every pattern. A detector that keeps silent tells something; a prose
    labeller that abstains tells nothing, so only its votes count, given that it votes."""
    at = np.arange(patterns.shape[1])
    told = table.copy()
    prose = np.setdiff1d(at, DETECTORS)
    told[:, prose] /= told[:, prose][:, :, [0, 2]].sum(axis=2, keepdims=True)
    told[:, prose, 1] = 1
    log = np.stack([np.log(t[at, patterns + 1]).sum(axis=1) for t in told], axis=1) + np.log(shares)
    p = np.exp(log - log.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def posterior(patterns: np.ndarray, shares: np.ndarray, table: np.ndarray) -> np.ndarray:
    """P(good | votes) of every pattern."""
    return membership(patterns, shares, table)[:, 0]


def accuracies(shares: np.ndarray, table: np.ndarray) -> dict[str, tuple[float, float]]:
    """Per labeller: how often its bad and its good votes are right."""
    out = {}
    for k, name in enumerate(LABELLERS):
        bad, good = shares[1:] @ table[1:, k, 0], shares[0] * table[0, k, 2]
        out[name] = float(bad / (bad + shares[0] * table[0, k, 0])), float(good / (good + shares[1:] @ table[1:, k, 2]))
    return out


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Logistic weights (last one: bias) for soft labels, classes balanced, by gradient descent
    with momentum."""
    x = np.hstack([x, np.ones((len(x), 1), "float32")])
    share = min(max(float(y.mean()), 0.02), 0.98)
    weight = y * 0.5 / share + (1 - y) * 0.5 / (1 - share)
    w, speed = np.zeros(x.shape[1], "float32"), np.zeros(x.shape[1], "float32")
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ ((weight * (p - y)) / len(y)).astype("float32") + decay * w
        speed = 0.9 * speed - 2.0 * grad
        w = w + speed
    return w


def voted(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with __votes (one digit 0, 1, 2 per labeller)."""

    @F.pandas_udf("string")
    def ballot(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: "".join(str(v + 1) for v in votes(statistics(t, *parts(t)))))

    return df.withColumn("__votes", ballot(text_or_empty(text_col)))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 3000) -> dict:
    """Weak-label model and scorer. Votes are counted over all rows of ``df``; the scorer is
    trained on the ``most`` rows with the smallest hash of id and text (documented bound)."""
    key = F.xxhash64(F.col(id_col).cast("long"), text_or_empty(text_col))
    with small_batches(df.sparkSession):
        ballots = materialize(voted(df.select(F.col(id_col), text_or_empty(text_col).alias(text_col)), text_col).select(key.alias("key"), "__votes"), "votes")
    rows = ballots.groupBy("__votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not rows:
        return {"weights": np.zeros(BUCKETS + 1, "float32"), "good_share": 0.5, "accuracies": {}}
    patterns = np.array([[int(c) - 1 for c in r["__votes"]] for r in rows])
    shares, table = em(patterns, np.array([r["n"] for r in rows]))
    label = dict(zip((r["__votes"] for r in rows), posterior(patterns, shares, table)))
    picked = draw(ballots, "key", sum(r["n"] for r in rows), most)
    chosen = {r["key"]: label[r["__votes"]] for r in picked.collect()}
    keys = df.sparkSession.createDataFrame([(k,) for k in chosen], "key long")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [(np.zeros(BUCKETS, "float32") if (x := features(t)) is None else x).tobytes() for t in b[1].to_pylist()]
            yield pa.record_batch([b[0], pa.array(data, pa.binary())], ["key", "x"])

    texts = df.select(key.alias("key"), text_or_empty(text_col).alias("text")).join(F.broadcast(keys), "key")
    got = {r["key"]: r["x"] for r in texts.mapInArrow(featurise, "key long, x binary").toLocalIterator()}
    order = sorted(got)
    x = np.stack([np.frombuffer(got[k], "float32") for k in order])
    y = np.array([chosen[k] for k in order])
    return {"weights": train(x, y), "good_share": float(shares[0]), "accuracies": accuracies(shares, table)}


def score(df: DataFrame, model: dict, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``df`` with score (0 to 1, double) and keep (score >= least) appended."""
    w = df.sparkSession.sparkContext.broadcast(model["weights"])

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        weights, out = w.value, []
        for t in texts:
            x = features(t)
            z = 0.0 if x is None else float(x @ weights[:-1] + weights[-1])
            out.append(0.0 if x is None else 1 / (1 + np.exp(-min(max(z, -30), 30))))
        return pd.Series(out, dtype="float64")

    plain = df.drop("score", "keep")
    return plain.withColumn("score", rate(text_or_empty(text_col))).withColumn("keep", F.col("score") >= least)


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with score and keep for every row; columns of these names are replaced.

    Null, empty and blank texts score 0 and are rejected. Repeated rows get equal scores, and
    ids may be null. An empty table gives no rows.
    """
    return score(df, fit(df, id_col, text_col), text_col)
