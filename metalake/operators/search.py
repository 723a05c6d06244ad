"""Queries over the index tables: full text, producers, id ranges, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metalake.functions.scalars import has_metadata, tokens
from metalake.operators import packed

#: Mappings that statistics always report.
STAT_MAPPINGS = ["cff", "codemeta", "gemspec", "maven", "npm", "pkg-info"]


def query_tokens(terms: list[str]) -> Column:
    return F.array_distinct(F.flatten(F.transform(F.array(*[F.lit(t) for t in terms]), tokens)))


def match_all(rows: DataFrame, terms: list[str]) -> DataFrame:
    """Rows whose ``tokens`` hold every token of every term, with their rank."""
    wanted = query_tokens(terms)
    hits = F.size(F.filter("tokens", lambda t: F.array_contains(wanted, t)))
    rank = F.round(hits / (1 + F.log(F.size("tokens").cast("double"))), 6)
    return rows.where(F.size(F.array_except(wanted, "tokens")) == 0).where(F.size("tokens") > 0).withColumn("rank", rank)


def full_text(rows: DataFrame, terms: list[str], limit: int = 100, id_col: str = "id") -> DataFrame:
    """The ``limit`` best matches, best first, ties by id."""
    return match_all(rows, terms).orderBy(F.desc("rank"), id_col).limit(limit)


def by_producer(rows: DataFrame, mappings: list[str] | None = None, tool_ids: list[int] | None = None) -> DataFrame:
    """Rows that one of ``mappings`` produced with one of ``tool_ids`` (None: any)."""
    if mappings is not None:
        rows = rows.where(F.arrays_overlap("mappings", F.array(*[F.lit(m) for m in mappings]).cast("array<string>")))
    if tool_ids is not None:
        rows = rows.where(F.col("tool_id").isin(tool_ids))
    return rows


def producer_page(rows: DataFrame, page_token: str = "", limit: int = 100, **filters) -> tuple[DataFrame, str | None]:
    """One page by id, and the token of the next: the last id, if more rows follow. The plan runs
    once; ``limit`` + 1 rows pass through the driver."""
    page = by_producer(rows, **filters).where(F.col("id") > page_token).orderBy("id").limit(limit + 1)
    got = page.collect()
    return rows.sparkSession.createDataFrame(got[:limit], page.schema), got[limit - 1]["id"] if len(got) > limit else None


def bound(i: int, n: int, digits: int = 40) -> str:
    """Start of range i of n over hex ids."""
    return f"{i * 16**digits // n:0{digits}x}"


def in_partition(id_col: Column, i: int, n: int) -> Column:
    """Half-open range of hex ids; the last range is open above."""
    low = id_col >= bound(i, n)
    return low if i == n - 1 else low & (id_col < bound(i + 1, n))


def id_partition(rows: DataFrame, i: int, n: int, page_token: str | None = None, limit: int | None = 1000) -> DataFrame:
    """Ids of one range in order, after ``page_token``; ``limit`` must be given."""
    if limit is None:
        raise ValueError("limit should not be None")
    out = rows.where(in_partition(F.col("id"), i, n))
    if page_token is not None:
        out = out.where(F.col("id") > page_token)
    return out.select("id").orderBy("id").limit(limit)


def partition_of(id_col: Column, n: int) -> Column:
    """Which of n ranges a hex id lies in, for scans of all ranges at once (n <= 2**20)."""
    head = F.conv(F.substring(id_col, 1, 10), 16, 10).cast("decimal(20,0)")
    return F.floor(head * n / F.lit(16**10).cast("decimal(20,0)")).cast("int")


def textual(rows: DataFrame, mimetypes: DataFrame) -> DataFrame:
    """Rows of contents whose MIME type is text."""
    return rows.join(mimetypes.where(F.col("mimetype").startswith("text/")).select("id").distinct(), "id", "left_semi")


def mapping_stats(rows: DataFrame) -> DataFrame:
    """One row: total, non_empty and a count for each of the fixed mappings."""
    per = [F.coalesce(F.sum(F.array_contains("mappings", m).cast("long")), F.lit(0)).alias(m.replace("-", "_")) for m in STAT_MAPPINGS]
    return rows.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(has_metadata(F.col("metadata")).cast("long")), F.lit(0)).alias("non_empty"), *per)


def open_mapping_stats(rows: DataFrame) -> DataFrame:
    """(mapping, n) for every mapping that occurs."""
    return rows.select(F.explode(F.array_distinct("mappings")).alias("mapping")).groupBy("mapping").agg(F.count(F.lit(1)).alias("n"))


def postings(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Inverted index (token, id, tf, n); write it clustered by token for repeated searches."""
    each = rows.select(F.col(id_col), F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    return each.groupBy("token", id_col, "n").agg(F.count(F.lit(1)).alias("tf"))


def token_counts(index: DataFrame) -> DataFrame:
    """(token, df): in how many documents each token occurs."""
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def search_postings(index: DataFrame, terms: DataFrame, counts: DataFrame | None = None, id_col: str = "id", docs: DataFrame | None = None) -> DataFrame:
    """Many queries at once: ``terms`` (query_id, token); all tokens of a query must occur.

    A query's rarest token (by ``counts``) yields its candidates, so frequent tokens never
    meet the whole index; the candidates' other tokens are then looked up by token and id. With
    ``docs`` (``id_col``, tokens), the indexed rows, all of that is done in memory (:func:`search_packed`)."""
    if docs is not None:
        kind = docs.schema[id_col].dataType
        return search_packed(packed.pack(docs, id_col), terms).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
    counts = token_counts(index) if counts is None else counts
    wanted = terms.distinct().join(counts, "token", "left")
    per_query = wanted.groupBy("query_id").agg(
        F.min_by("token", F.struct("df", "token")).alias("rare"), F.collect_list("token").alias("all"), F.count(F.lit(1)).alias("need"), F.count("df").alias("met")
    ).where("met = need")
    first = index.select(F.col("token").alias("rare"), id_col)
    asked = per_query.join(first, "rare").select("query_id", id_col, "need", F.explode("all").alias("token"))
    met = asked.join(index, ["token", id_col]).groupBy("query_id", id_col, "n", "need").agg(F.count(F.lit(1)).alias("met"), F.sum("tf").alias("hits"))
    return met.where("met = need").select("query_id", id_col, F.round(F.col("hits") / (1 + F.log(F.col("n").cast("double"))), 6).alias("rank"))


def search_packed(packs: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, id, rank): the matches of many queries, ``terms`` (query_id, token), in the documents of ``packs``.

    Packs of queries meet packs of documents in memory; only results leave a task. These grow with queries
    times documents, as do the tests, but neither candidates nor postings are shuffled."""
    found = packed.match(packs, packed.pack_searches(packed.gathered(terms)))
    rank = F.round(F.col("hits") / (1 + F.log(F.col("n").cast("double"))), 6).alias("rank")
    return found.select(F.col("query_id").cast(terms.schema["query_id"].dataType), "id", rank)
