"""Many searches over many documents: packs of documents with their postings meet packs of searches.

A pack of documents holds their words once, and for each word its documents and how often it occurs
there; a pack of searches holds words and searches likewise. One task meets one pack of each at a
time, so memory doesn't grow with the tables; nothing is shuffled for it but the results. Searches
start from the word that is rarest in the pack, and lose candidates word by word, all at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metalake.plans.lineage import written

#: Between the tokens of a document on its way to Python; tokens are letters and digits.
GAP = "\0"
DOCS = "docs long, first_block long, words binary, posts binary, rows binary"
SEARCHES = "searches long, asked_words binary, asked binary, names binary"
#: Documents and tokens of a pack, tokens of a pack of searches, candidates tested at once.
MOST_DOCS, MOST_TOKENS, MOST_ASKED, AT_ONCE = 5_000, 4_000_000, 2_000_000, 300_000


def frozen(**columns) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch(list(columns.values()), list(columns))
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def thawed(data) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_next_batch()


def least(values: np.ndarray) -> np.ndarray:
    """``values``, none negative, in the narrowest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def dictionary(words: Iterable[pa.Array]) -> tuple[np.ndarray, pa.Array]:
    """Codes of all ``words`` in order, and the words that they stand for."""
    coded = pa.chunked_array(list(words), pa.string()).combine_chunks().dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def millionths(ranks: np.ndarray) -> np.ndarray:
    """``ranks``, none negative, as Spark rounds them to six digits: by their decimal digits, halves up."""
    scaled = ranks * 1e6
    out = np.floor(scaled + 0.5).astype("int64")
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4):
        out[i] = int(Decimal(repr(float(ranks[i]))).quantize(Decimal("0.000001"), ROUND_HALF_UP).scaleb(6))
    return out


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, GAP)


# -- packing ------------------------------------------------------------------------------------


def docs_pack(held: list[pa.RecordBatch], per_block: int | None) -> pa.RecordBatch:
    """One row of ``DOCS`` from ``held`` (id, n, tokens joined, place). With ``per_block``, documents are
    sorted by their block, and rows of one block, length and id are one document."""
    table = pa.Table.from_batches(held)
    block = np.zeros(len(table), "int64")
    if per_block:
        table = table.append_column("block", pa.array(table["place"].to_numpy() // per_block))
        table = table.sort_by([(c, "ascending") for c in ("block", "n", "id")])
        block = table["block"].to_numpy()
    table = table.combine_chunks()
    lists = pc.split_pattern(table["tokens"], GAP)
    codes, words = dictionary(x.flatten() for x in lists.chunks)
    ids, n = table["id"].combine_chunks(), table["n"].to_numpy()
    row = np.arange(len(table))
    if per_block:
        same = np.zeros(len(table), bool)
        same[1:] = (block[1:] == block[:-1]) & (n[1:] == n[:-1]) & pc.equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
        row = np.cumsum(~same) - 1
        ids, n, block = ids.filter(pa.array(~same)), n[~same], block[~same]
    many = len(ids)
    doc = np.repeat(row, pc.list_value_length(lists).to_numpy())
    key, tf = np.unique(codes.astype("int64") * many + doc, return_counts=True)
    first = int(block.min())
    return pa.record_batch(
        [
            pa.array([many], pa.int64()), pa.array([first], pa.int64()),
            pa.array([frozen(word=words, df=pa.array(np.bincount(key // many, minlength=len(words)).astype("int32")))], pa.binary()),
            pa.array([frozen(doc=pa.array(least(key % many)), tf=pa.array(least(tf)))], pa.binary()),
            pa.array([frozen(id=ids, n=pa.array(n), block=pa.array(block - first))], pa.binary()),
        ],
        ["docs", "first_block", "words", "posts", "rows"],
    )


def cut(batches: Iterable[pa.RecordBatch], weight: str, most_rows: int, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows in order, in lists of up to ``most_rows`` rows whose ``weight`` adds up to about ``most``."""
    held, rows, heavy = [], 0, 0
    for b in batches:
        weights = b[weight].to_numpy(zero_copy_only=False).astype("int64")
        while b.num_rows:
            fit = min(most_rows - rows, int(np.searchsorted(np.cumsum(weights), most - heavy)) + 1)
            held.append(b.slice(0, fit))
            rows, heavy = rows + min(fit, b.num_rows), heavy + int(weights[:fit].sum())
            b, weights = b.slice(fit), weights[fit:]
            if rows >= most_rows or heavy >= most:
                yield held
                held, rows, heavy = [], 0, 0
    if held:
        yield held


def pack(docs: DataFrame, id_col: str = "id") -> DataFrame:
    """Packs of ``docs`` (``id_col``, tokens), of about as many documents as a task reads together."""
    sent = docs.select(F.col(id_col).cast("string").alias("id"), F.size("tokens").alias("n"), joined(F.col("tokens")).alias("tokens"), F.lit(0).cast("long").alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # not filtered before: Spark would make the tokens once more for it, below the shuffle that deals the rows
        some = (b.filter(pc.and_(pc.is_valid(b["id"]), pc.greater(b["n"], 0))) for b in batches)
        for held in cut(some, "n", MOST_DOCS, MOST_TOKENS):
            yield docs_pack(held, None)

    return sent.mapInArrow(run, DOCS)


def pack_searches(asked: DataFrame, extra: str | None = None, most: int = MOST_ASKED) -> DataFrame:
    """Packs of ``asked``, a written table (query_id, tokens: distinct, at least one, none null), with their
    ``extra`` number, written: each meets every pack of documents."""
    packs = max(1, -(-(asked.agg(F.sum(F.size("tokens"))).first()[0] or 0) // most))
    more = F.lit(0.0) if extra is None else F.col(extra).cast("double")
    sent = asked.select(F.col("query_id").cast("string"), F.size("tokens").alias("n"), joined(F.col("tokens")).alias("tokens"), more.alias("extra"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in cut(batches, "n", most, most):
            table = pa.Table.from_batches(held)
            lists = pc.split_pattern(table["tokens"], GAP)
            codes, words = dictionary(x.flatten() for x in lists.chunks)
            names = table.select(["query_id", "n", "extra"]).combine_chunks().to_batches()[0]
            yield pa.record_batch(
                [pa.array([len(table)], pa.int64()), *[pa.array([x], pa.binary()) for x in (frozen(word=words), frozen(code=pa.array(codes)), frozen(**{c: names[c] for c in names.schema.names}))]],
                ["searches", "asked_words", "asked", "names"],
            )

    # a task that has read a pack of documents meets a few packs of searches with it
    return written(sent.coalesce(packs).mapInArrow(run, SEARCHES), "searches").coalesce(-(-packs // 4))


def gathered(terms: DataFrame) -> DataFrame:
    """(query_id, tokens), written, of ``terms`` (query_id, token); a search that asks for null finds nothing."""
    per = terms.groupBy("query_id").agg(F.sort_array(F.collect_set("token")).alias("tokens"), F.count_if(F.col("token").isNull()).alias("nulls"))
    return written(per.where("nulls = 0").select("query_id", "tokens"), "asked")


# -- meeting ------------------------------------------------------------------------------------


class Docs:
    """A pack of documents in memory: postings sorted by word, then document."""

    def __init__(self, words, posts, rows, blocks: bool = False):
        named, posted, told = thawed(words), thawed(posts), thawed(rows)
        self.words, self.df = named["word"], named["df"].to_numpy()
        self.doc, self.tf = posted["doc"].to_numpy().astype("int32"), posted["tf"].to_numpy()
        self.ids, self.n, self.block = told["id"], told["n"].to_numpy(), told["block"].to_numpy()
        self.many = len(self.ids)
        self.start = np.concatenate([[0], np.cumsum(self.df, dtype="int64")])
        word = np.repeat(np.arange(len(self.df)), self.df)
        self.key = word * self.many + self.doc
        if not blocks:
            return
        self.per = 1 + np.log(self.n.astype("float64"))
        order = pc.sort_indices(self.ids).to_numpy()
        self.place = np.empty(self.many, "int64")
        self.place[order] = np.arange(self.many)
        self.blocks = int(self.block.max()) + 1
        # postings of one word in one block lie together
        at = word * self.blocks + self.block[self.doc]
        self.seg_at = np.flatnonzero(np.diff(at, prepend=-1))
        self.seg_key, self.seg_len = at[self.seg_at], np.diff(self.seg_at, append=len(at))
        self.seg_top = np.maximum.reduceat(self.tf / self.per[self.doc], self.seg_at)


class Searches:
    """A pack of searches in memory."""

    def __init__(self, words, asked, names):
        told = thawed(names)
        self.words, self.code = thawed(words)["word"], thawed(asked)["code"].to_numpy()
        self.ids, self.n, self.extra = told["query_id"], told["n"].to_numpy().astype("int64"), told["extra"].to_numpy()


class Met:
    """The searches all of whose words occur in a pack of documents: ``query`` (their numbers), ``n`` words each,
    from ``at`` on in ``code``, the rarest first."""

    def __init__(self, docs: Docs, searches: Searches):
        local = pc.index_in(searches.words, value_set=docs.words).fill_null(-1).to_numpy()
        code = local[searches.code]
        begin = np.cumsum(searches.n) - searches.n
        whole = np.minimum.reduceat(code, begin) >= 0
        self.query, self.n = np.flatnonzero(whole), searches.n[whole]
        code = code[np.repeat(whole, searches.n)]
        self.at = np.cumsum(self.n) - self.n
        self.code = code[np.lexsort((code, docs.df[code], np.repeat(np.arange(len(self.n)), self.n)))].astype("int64")


def narrowed(docs: Docs, met: Met, which: np.ndarray, low: np.ndarray, many: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(search, document, hits) of every match. The candidates of search ``which[i]`` are ``many[i]``
    postings of its rarest word from ``low[i]`` on; ``AT_ONCE`` or so are tested together."""
    edges = np.cumsum(many)
    begin = 0
    while begin < len(which):
        end = max(begin + 1, int(np.searchsorted(edges, (edges[begin - 1] if begin else 0) + AT_ONCE, "right")))
        some = many[begin:end]
        at = np.repeat(low[begin:end] - (np.cumsum(some) - some), some) + np.arange(some.sum())
        who, doc, hits = np.repeat(which[begin:end], some), docs.doc[at], docs.tf[at].astype("int64")
        level = 1
        while len(who):
            over = met.n[who] == level
            if over.any():
                yield who[over], doc[over], hits[over]
                who, doc, hits = who[~over], doc[~over], hits[~over]
            probe = met.code[met.at[who] + level] * docs.many + doc if len(who) else np.empty(0, "int64")
            found = np.minimum(np.searchsorted(docs.key, probe), len(docs.key) - 1)
            kept = docs.key[found] == probe
            who, doc, hits = who[kept], doc[kept], hits[kept] + docs.tf[found[kept]]
            level += 1
        begin = end


def pairs(batches: Iterable[pa.RecordBatch], blocks: bool) -> Iterator[tuple[Docs, Searches, dict]]:
    """Each row's packs; what a pack of documents makes is kept while the rows that follow have the same."""
    last, docs = None, None
    for b in batches:
        for row in range(b.num_rows):
            mine = [b[c][row].as_buffer() for c in ("words", "posts", "rows")]
            if last is None or any(not x.equals(y) for x, y in zip(mine, last, strict=True)):
                # own copies: the batch may go before the next row is read
                last, docs = [pa.py_buffer(x.to_pybytes()) for x in mine], Docs(*mine, blocks)
            yield docs, Searches(*[b[c][row].as_buffer() for c in ("asked_words", "asked", "names")]), b["first_block"][row].as_py() if blocks else 0


def crossed(packs: DataFrame, searches: DataFrame) -> DataFrame:
    """Every pack of documents with every pack of searches, without a broadcast or a shuffle of either."""
    return packs.hint("shuffle_replicate_nl").crossJoin(searches)


def match(packs: DataFrame, searches: DataFrame) -> DataFrame:
    """(query_id, id, n, hits): every document that holds all words of a search, with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, asked, _ in pairs(batches, False):
            met = Met(docs, asked)
            rare = met.code[met.at]
            for who, doc, hits in narrowed(docs, met, np.arange(len(rare)), docs.start[rare], docs.df[rare].astype("int64")):
                yield pa.record_batch(
                    [asked.ids.take(pa.array(met.query[who])), docs.ids.take(pa.array(doc)), pa.array(docs.n[doc].astype("int32")), pa.array(hits)], ["query_id", "id", "n", "hits"]
                )

    return crossed(packs, searches).mapInArrow(run, "query_id string, id string, n int, hits long")
