"""Substring dedup by sliding spans of consecutive sentences.

Every run of ``least_units`` consecutive sentences is hashed (96 bits) in the tasks, whatever
their lengths; a longer repeated run is covered by the repeated runs inside it. One row per
document and distinct span goes to the global join, where the first document of each repeated
span is found by a partial aggregate, so that a span that a third of all documents share
arrives as counts. The occurrences then meet the repeated spans; hot ones are broadcast, so no
task gets one whole. Texts stay where they are as long as the places to remove are few enough
to be sent to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, meet, small_batches, text_or_empty
from .sentences import HAS_UNSPACED, starts, words

NO_ID = -(1 << 63)
#: Places to remove are broadcast up to this many bytes; beyond, they and the texts are joined by shuffle.
MOST_SENT = 32_000_000


def spans(text: str, least_units: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, last sentence, digest) of every run of ``least_units`` sentences; case and
    white space don't count, nor do sentences without words."""
    dense = HAS_UNSPACED.search(text) is not None
    bounds = starts(text, dense)
    at, digests = [], []
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if said := words(text[a:b].lower(), dense):
            at.append(k)
            digests.append(xxhash.xxh3_128_digest(" ".join(said).encode("utf-8", "surrogatepass")))
    flat, width = b"".join(digests), 16
    return [(at[i], at[i + least_units - 1], xxhash.xxh3_128_digest(flat[i * width : (i + least_units) * width])) for i in range(len(at) - least_units + 1)]


def removed_units(text: str, places: set[int], least_units: int) -> set[int]:
    """Sentences under the spans whose numbers in the text are ``places``."""
    found = spans(text, least_units)
    return {k for p in places for k in range(found[p][0], found[p][1] + 1)}


def without(text: str, drop: set[int]) -> str:
    at = starts(text)
    return "".join(text[a:b] for k, (a, b) in enumerate(zip(at, at[1:])) if k not in drop) if drop else text


def span_rows(df: DataFrame, least_units: int) -> DataFrame:
    """(k, th, pos, h1, h2) of every span, written once; pos: its number in the text, as
    -1 - pos where the span was seen earlier in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 128):
                part = b.slice(s, 128)
                rows, digests, sizes = [], [], []
                for text in part[2]:
                    seen: set[bytes] = set()
                    found = spans(text.as_py(), least_units)
                    for pos, (_, _, digest) in enumerate(found):
                        rows.append(-1 - pos if digest in seen else pos)
                        digests.append(digest)
                        seen.add(digest)
                    sizes.append(len(found))
                at = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.record_batch(
                    [part[0].take(at), part[1].take(at), pa.array(rows, pa.int32()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].astype("int32"))],
                    ["k", "th", "pos", "h1", "h2"],
                )

    with small_batches(df.sparkSession):
        return materialize(df.select("k", "th", "text").mapInArrow(run, "k long, th long, pos int, h1 long, h2 int"), "spans")


def with_places(tagged: DataFrame, places: DataFrame) -> DataFrame:
    """``tagged`` (with __k and __th) with __places, int32 numbers as binary. The places of a few
    documents are sent to the texts, which aren't shuffled then."""
    bytes_ = places.agg(F.sum(F.octet_length("__places") + 32)).first()[0] or 0
    return tagged.join(F.broadcast(places) if bytes_ <= MOST_SENT else places, ["__k", "__th"], "left")


def span_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_units: int = 3) -> DataFrame:
    """``df`` with ``text_col`` cleaned, and n_removed (long, sentences) appended.

    A sentence goes when a repeated span covers it and the span's first occurrence (smallest
    id, then place in the text) is elsewhere. Spans are runs of ``least_units`` sentences, short
    or long; sentences are those of :mod:`.sentences`. A text without repeated spans is returned
    unchanged; null stays null; texts may become empty. Rows with a null id rank first, by a
    hash of their text, and are documents of their own (of equal texts, one); rows that share
    an id count as one document, whose spans don't repeat each other. Ids lie above -2**62. An
    empty table gives no rows; a column named n_removed is replaced.
    """
    th = F.xxhash64(text_or_empty(text_col))
    k = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.shiftrightunsigned(th, 2) + F.lit(NO_ID))
    rows = span_rows(df.select(k.alias("k"), th.alias("th"), text_or_empty(text_col).alias("text")), least_units)
    firsts = rows.where("pos >= 0")
    repeated = (
        firsts.groupBy("h1", "h2")
        .agg(F.min("k").alias("first"), F.max("k").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first < last").drop("last")
    )
    later = meet(firsts, materialize(repeated, "repeated"), ["h1", "h2"], "n", rows.count()).where("k > first").select("k", "th", "pos")
    gone = later.unionByName(rows.where("pos < 0").select("k", "th", (-1 - F.col("pos")).alias("pos")))
    # one document's places: no more than it has sentences
    places = gone.groupBy(F.col("k").alias("__k"), F.col("th").alias("__th")).agg(F.collect_set("pos").alias("__set"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b[0], b[1], pa.array([np.asarray(x.values, "<i4").tobytes() for x in b[2]], pa.binary())], ["__k", "__th", "__places"])

    places = materialize(places.mapInArrow(pack, "__k long, __th long, __places binary"), "places")
    columns = [c for c in df.columns if c != "n_removed"]
    tagged = df.select(*[F.col(f"`{c}`") for c in columns], k.alias("__k"), th.alias("__th"))
    joined = with_places(tagged, places).select(*[F.col(f"`{c}`") for c in columns], "__places")
    at, kind = columns.index(text_col), joined.schema[text_col].dataType.simpleString()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-1]) + ", n_removed long"
    assert kind == "string", f"{text_col} is {kind}"

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 128):
                part = b.slice(s, 128)
                texts, removed = [], []
                for text, of in zip(part[at].to_pylist(), part[len(columns)].to_pylist()):
                    drop = removed_units(text, set(np.frombuffer(of, "<i4").tolist()), least_units) if of else set()
                    texts.append(without(text, drop) if drop else text)
                    removed.append(len(drop))
                arrays = [part[c] for c in range(len(columns))]
                arrays[at] = pa.array(texts, pa.string())
                yield pa.record_batch([*arrays, pa.array(removed, pa.int64())], [*columns, "n_removed"])

    return joined.mapInArrow(clean, schema)
