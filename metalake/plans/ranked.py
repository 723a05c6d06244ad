"""The best matches of many searches, without ranking all matches.

A document's rank is the number of its tokens that a search asks for, over 1 + ln of its length.
The index deals documents to blocks in the order of their length, so that those of one block can
be ranked much alike, and packs neighbouring blocks together (:mod:`metalake.operators.packed`).
A pack tells for each of its tokens and blocks the largest share of a rank that the token can give
there. Where a pack of documents meets a pack of searches, each search adds up those shares, opens
its most promising blocks first, and ends once it has ``limit`` matches that no match of an unopened
block can reach. Rounds take four times as many packs each time, spread over all lengths, and begin
with what the last round found, so a search takes few rows out of most packs.

Shares, openings and all but the best matches of a pack stay in the memory of its task: what is
shuffled and written grows with the searches and with the documents, not with their product. The driver
sees packs' first block numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metalake.operators import packed
from metalake.operators.search import query_tokens
from metalake.plans.lineage import written

POSTINGS = "token string, id string, n int, tf long, block long"
OPENED = ["opened", "query_id", "id", "n", "hits"]
#: Most blocks of a pack, packs of the first round, tokens of a pack of searches.
MOST_BLOCKS, FIRST_PACKS, MOST_ASKED = 64, 4, 32_000
#: Sums of shares in another order may differ by less than this.
SLACK = 1e-6


def rank_of(hits: Column, n: Column) -> Column:
    return hits / (1 + F.log(n.cast("double")))


def build(rows: DataFrame, path: str, per_block: int = 20_000, id_col: str = "id") -> None:
    """Writes the index of ``rows`` (``id_col``, tokens) below ``path``: blocks of about
    ``per_block`` documents. Rows without tokens match nothing. Documents of one length are
    spread over that length's blocks by a hash of their id; rows of one id and length count
    as one document."""
    docs = rows.select(F.col(id_col).cast("string").alias("id"), F.size("tokens").alias("n"), packed.joined(F.col("tokens")).alias("tokens"))
    # filtered as they are read: Spark would make the tokens once more for it, below a shuffle that deals the rows
    docs = written(docs, "docs").where("id is not null and n > 0")
    # one row for each length that occurs, so one task may add them up
    lengths = docs.groupBy("n").agg(F.count(F.lit(1)).alias("many"))
    order = Window.orderBy("n")
    lengths = lengths.select("n", "many", (F.sum("many").over(order) - F.col("many")).alias("before"), (F.sum(F.col("many") * F.col("n")).over(order) - F.col("many") * F.col("n")).alias("words"))
    within = F.pmod(F.xxhash64("id"), F.col("many"))
    per_pack = per_block * max(1, min(packed.MOST_DOCS // per_block, MOST_BLOCKS))
    # packs end at a number of documents, and of tokens, so that long documents make small ones
    at = docs.join(F.broadcast(lengths), "n").select("id", "n", "tokens", (F.col("before") + within).alias("place"), (F.col("words") + within * F.col("n")).alias("words"))
    dealt = at.select("id", "n", "tokens", "place", (F.floor(F.col("place") / per_pack) + F.floor(F.col("words") / packed.MOST_TOKENS)).cast("long").alias("pack"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            of = b["pack"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                if held and of[begin] != last:
                    yield packed.docs_pack(held, per_block)
                    held = []
                last = of[begin]
                held.append(b.slice(begin, end - begin))
        if held:
            yield packed.docs_pack(held, per_block)

    # whole documents are shuffled, once
    dealt.repartition("pack").sortWithinPartitions("pack").mapInArrow(run, packed.DOCS).write.parquet(f"{path}/packs")


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(packed.DOCS).parquet(f"{path}/packs")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """The index as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                docs = packed.Docs(*[b[c][row].as_py() for c in ("words", "posts", "rows")])
                word, doc = docs.key // docs.many, docs.doc
                for at in (slice(i, i + 100_000) for i in range(0, len(doc), 100_000)):
                    yield pa.record_batch(
                        [docs.words.take(pa.array(word[at])), docs.ids.take(pa.array(doc[at])), pa.array(docs.n[doc[at]].astype("int32")), pa.array(docs.tf[at].astype("int64")), pa.array(docs.block[doc[at]] + b["first_block"][row].as_py())],
                        ["token", "id", "n", "tf", "block"],
                    )

    return read_packs(spark, path).mapInArrow(run, POSTINGS)


def opened_best(docs: packed.Docs, asked: packed.Searches, last: np.ndarray, limit: int, first: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """How many (search, block) pairs of a pack were opened, and the up to ``limit`` best matches there of each
    search of ``asked`` as (search, document, hits). ``last`` has the rank in millionths that a match must
    reach, -1 where any will do, and is raised by what is found."""
    met = packed.Met(docs, asked)
    none = np.empty(0, "int64")
    if not len(met.at):
        return 0, none, none, none
    codes, mine = np.unique(met.code, return_inverse=True)
    to = np.full(len(docs.df), -1)
    to[codes] = np.arange(len(codes))
    to = to[docs.seg_key // docs.blocks]
    top = np.full((len(codes), docs.blocks), -np.inf)
    top[to[to >= 0], (docs.seg_key % docs.blocks)[to >= 0]] = docs.seg_top[to >= 0]
    # blocks without one of a search's tokens have no bound
    bound = np.add.reduceat(top[mine], met.at, axis=0) + SLACK
    order = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    who, doc, hits, rank = none, none, none, none
    opened, seen, wave = 0, 0, first
    while seen < docs.blocks:
        now = bound[:, seen : seen + wave]
        # an equal rank may still win by its id
        query, at = np.nonzero((now > 0) & (now * 1e6 + 1 >= last[met.query][:, None]))
        if not len(query):
            break
        opened += len(query)
        seg = np.searchsorted(docs.seg_key, met.code[met.at[query]] * docs.blocks + order[query, seen + at])
        parts = [(who, doc, hits, rank)]
        for x, d, h in packed.narrowed(docs, met, query, docs.seg_at[seg], docs.seg_len[seg]):
            r = packed.millionths(h / docs.per[d])
            kept = r >= last[met.query[x]]
            parts.append((x[kept], d[kept].astype("int64"), h[kept], r[kept]))
        who, doc, hits, rank = (np.concatenate(x) for x in zip(*parts, strict=True))
        best = np.lexsort((docs.place[doc], -rank, who))
        best = best[np.arange(len(best)) - np.searchsorted(who[best], who[best]) < limit]
        who, doc, hits, rank = who[best], doc[best], hits[best], rank[best]
        full = np.flatnonzero(np.arange(len(who)) - np.searchsorted(who, who) == limit - 1)
        last[met.query[who[full]]] = np.maximum(last[met.query[who[full]]], rank[full])
        seen, wave = seen + wave, wave * 2
    return opened, met.query[who], doc, hits


def best(spark: SparkSession, path: str, terms: DataFrame, limit: int = 100, first: int = 4) -> tuple[DataFrame, int]:
    """The ``limit`` best matches of every search of ``terms`` (query_id, token), all of whose tokens
    must occur: query_id, id, n, rank and place (from 1; ties by id, then length). Also tells how
    many (search, block) pairs were opened, ``first`` of a pack at first."""
    if limit < 1 or first < 1:
        raise ValueError("limit and first must be positive")
    wanted = packed.gathered(terms.select("query_id", "token").where("token is not null"))
    packs, place = read_packs(spark, path), Window.partitionBy("query_id").orderBy(F.desc("rank"), "id", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[tuple, np.ndarray] = {}
        for docs, asked, _ in packed.pairs(batches, True):
            # what a search found in one pack holds for the next that the task reads
            last = reached.setdefault((asked.ids[0].as_py(), len(asked.ids)), np.floor(asked.extra * 1e6 + 0.5).astype("int64"))
            opened, who, doc, hits = opened_best(docs, asked, last, limit, first)
            if opened:
                yield pa.record_batch([pa.array([opened]), *[pa.nulls(1, t) for t in (pa.string(), pa.string(), pa.int32(), pa.int64())]], OPENED)
            if len(who):
                yield pa.record_batch([pa.nulls(len(who), pa.int64()), asked.ids.take(pa.array(who)), docs.ids.take(pa.array(doc)), pa.array(docs.n[doc].astype("int32")), pa.array(hits)], OPENED)

    # first packs spread over all lengths: the numbers of packs, their lowest bits first
    numbers = sorted(r[0] for r in packs.select("first_block").distinct().collect())
    width = max(len(numbers) - 1, 0).bit_length()
    numbers = [numbers[i] for i in sorted(range(len(numbers)), key=lambda i: f"{i:0{width}b}"[::-1])]
    found, opened, begin, end = None, 0, 0, FIRST_PACKS
    while begin < len(numbers) or found is None:
        reached = wanted if found is None else wanted.join(found.where(F.col("place") == limit).select("query_id", "rank"), "query_id", "left")
        asked = packed.pack_searches(reached.withColumn("last", F.lit(-1.0) if found is None else F.coalesce("rank", F.lit(-1.0))), "last", MOST_ASKED)
        met = packed.crossed(packs.where(F.col("first_block").isin(numbers[begin:end])), asked).mapInArrow(run, "opened long, query_id string, id string, n int, hits long")
        met = written(met, "met")
        opened += met.agg(F.sum("opened")).first()[0] or 0
        ranked = met.where("opened is null").select(F.col("query_id").cast(terms.schema["query_id"].dataType), "id", "n", F.round(rank_of(F.col("hits"), F.col("n")), 6).alias("rank"))
        both = ranked if found is None else found.drop("place").unionByName(ranked)
        found = written(both.withColumn("place", F.row_number().over(place)).where(F.col("place") <= limit), "best")
        begin, end = end, end * 4
    return found, opened


def full_text(spark: SparkSession, path: str, terms: list[str], limit: int = 100) -> DataFrame:
    """:func:`metalake.operators.search.full_text` over a built index: id and rank, best first."""
    tokens = spark.range(1).select(F.lit(0).alias("query_id"), F.explode(query_tokens(terms)).alias("token"))
    return best(spark, path, tokens, limit)[0].orderBy("place").select("id", "rank")
