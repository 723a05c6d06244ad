"""Language identification by string kernels.

The blended-spectrum presence kernel of two texts is the number of distinct byte n-grams
(n = 1 to 4 of the lower-cased UTF-8) that both hold, over the geometric mean of their own
numbers. Nyström landmarks turn it into a feature map: with K the kernel among landmarks and
k(x) that of x with them, z(x) = k(x) K^-1/2. One ridge regression per language on z is then
kernel ridge regression, one versus the rest. A batch of documents is a 0/1 matrix over the
landmarks' n-grams; one matrix product gives its kernels and a second one its scores. An
n-gram of up to four bytes is a number, so sets are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SCALE, text_or_empty

LETTER = regex.compile(r"\p{L}")
ORDERS = (1, 2, 3, 4)
BATCH = 128


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of all orders as sorted numbers: n * 2**32 + the bytes, big end first."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), "uint8").astype("uint32")
    out, code = [], np.zeros(len(data), "uint32")
    for n in ORDERS:
        if len(data) < n:
            break
        code = (code[: len(data) - n + 1] << np.uint32(8)) | data[n - 1 :]
        if n <= 2:
            own = np.flatnonzero(np.bincount(code, minlength=1))
        else:
            own = np.sort(code)
            own = own[np.r_[True, own[1:] != own[:-1]]]
        out.append(own.astype("int64") + (n << 32))
    return np.concatenate(out) if out else np.empty(0, "int64")


class Kernel:
    """Presence kernel with fixed landmarks."""

    def __init__(self, landmarks: list[np.ndarray]):
        self.known = np.unique(np.concatenate(landmarks)) if landmarks else np.empty(0, "int64")
        self.matrix = np.zeros((len(self.known) + 1, len(landmarks)), "float32")  # the last row: any other n-gram
        for k, own in enumerate(landmarks):
            self.matrix[np.searchsorted(self.known, own), k] = 1
        self.sizes = np.array([len(x) for x in landmarks], "float64")

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """0/1 rows over the landmarks' n-grams, and set sizes."""
        out = np.zeros((len(texts), len(self.matrix)), "float32")
        sizes = np.empty(len(texts))
        for k, text in enumerate(texts):
            own = grams(text)
            sizes[k] = len(own)
            at = np.searchsorted(self.known, own)
            at[at == len(self.known)] = 0
            if len(self.known):
                out[k, at[self.known[at] == own]] = 1
        return out, np.maximum(sizes, 1)

    @property
    def batch(self) -> int:
        """Texts whose 0/1 rows take 64 MB at most."""
        return max(1, min(BATCH, 16_000_000 // len(self.matrix)))

    def values(self, texts: list[str]) -> np.ndarray:
        out, sizes = self.rows(texts)
        return (out @ self.matrix) / np.sqrt(sizes[:, None] * np.maximum(self.sizes, 1))


class Model:
    def __init__(self, languages: list[str], kernel: Kernel, weights: np.ndarray):
        self.languages, self.kernel, self.weights = languages, kernel, weights

    def scores(self, texts: list[str]) -> np.ndarray:
        k = self.kernel.values(texts)
        return np.hstack([k, np.ones((len(k), 1))]) @ self.weights


def spread(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows (id, key, lang) in all, equally many of each language, those of smallest
    id hash, numbered by ``at``. Each language's share is thinned by a threshold first, so the
    ranking sees a few thousand rows of a language, however many there are."""
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per language
    each = max(1, most // max(1, len(counts)))
    place = F.pmod(F.xxhash64("id"), F.lit(SCALE))
    for r in counts:
        if r["n"] > 4 * each:
            rows = rows.where((F.col("lang") != r["lang"]) | (place < int(SCALE * 4 * each / r["n"])))
    order = Window.partitionBy("lang").orderBy(place, "id", "key")
    return rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= each)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", landmarks: int = 96, examples: int = 4000, ridge: float = 1e-3) -> Model:
    """Learns from the rows of ``df`` with a language. Bounds (documented): ``landmarks`` and
    ``examples`` rows, equally many of each language, chosen by a hash of the id; their whole
    texts are used. The landmarks are the first of the examples. Null texts teach nothing; rows
    that share an id are told apart by a hash of their text, and of several languages of one
    text the first by name counts, so the model doesn't depend on the order of tasks."""
    spark = df.sparkSession
    named = df.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    row = named.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    picked = spread(row.select("id", "key", "lang"), examples).collect()
    languages = sorted({r["lang"] for r in picked})
    if not languages:
        return Model([], Kernel([]), np.zeros((1, 0)))
    each = max(1, landmarks // len(languages))
    where: dict[int, str] = {}
    for r in sorted(picked, key=lambda r: r["lang"]):
        where.setdefault(r["key"], r["lang"])
    texts = row.select("key", "text").join(F.broadcast(spark.createDataFrame([(k,) for k in where], "key long")), "key")
    marked = spark.createDataFrame(sorted({(r["key"],) for r in picked if r["at"] <= each}), "key long")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b[0], pa.array([grams(t).astype("<i8").tobytes() for t in b[1].to_pylist()], pa.binary())], ["key", "x"])

    got = {r["key"]: np.frombuffer(r["x"], "<i8") for r in texts.join(F.broadcast(marked), "key").mapInArrow(sets, "key long, x binary").collect()}
    kernel = Kernel([got[i] for i in sorted(got)])
    shared = spark.sparkContext.broadcast(kernel)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = shared.value.batch
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                k = shared.value.values(part[1].to_pylist()).astype("<f8")
                yield pa.record_batch([part[0], pa.array([x.tobytes() for x in k], pa.binary())], ["key", "x"])

    data = {r["key"]: np.frombuffer(r["x"], "<f8") for r in texts.mapInArrow(near, "key long, x binary").collect()}
    order = sorted(data)
    k = np.stack([data[i] for i in order])
    own = np.stack([data[i] for i in sorted(got)])
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = k @ root
    y = np.array([[1.0 if where[i] == lang else 0.0 for lang in languages] for i in order])
    center, mean = z.mean(axis=0), y.mean(axis=0)
    zc = z - center
    w = np.linalg.solve(zc.T @ zc + ridge * len(z) * np.eye(zc.shape[1]), zc.T @ (y - mean))
    return Model(languages, kernel, np.vstack([root @ w, mean - center @ w]))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of every row, from its whole text alone."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        step = model.kernel.batch
        for b in batches:
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                texts = part[1].to_pylist()
                known = [k for k, t in enumerate(texts) if LETTER.search(t)] if model.languages else []
                names, score = ["und"] * len(texts), np.zeros(len(texts))
                if known:
                    z = model.scores([texts[k] for k in known])
                    best = z.argmax(axis=1)
                    score[known] = np.clip(z[np.arange(len(best)), best], 0, 1)
                    for k, at in zip(known, best.tolist()):
                        names[k] = model.languages[at]
                yield pa.record_batch([part[0], pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 1 by 3; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from rows that aren't held out.

    ``und`` for texts that are null or have no letter (Unicode category L), and for all texts if
    nothing could be learned. Of equal scores the language whose name sorts first is told. Repeated rows get equal predictions.
    An empty table gives no rows; further columns are not read.
    """
    model = fit(df.where(~held_out(id_col)), id_col, text_col, lang_col)
    told = predict(df, model, id_col, text_col)
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
