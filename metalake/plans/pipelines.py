"""Indexing jobs composed of the operators: contents, directories, origins, forge records."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metalake.functions import scalars as S
from metalake.operators import content, graph, props, tables
from metalake.plans.lineage import weighed_join, written


def content_mimetypes(ids: DataFrame, blobs: DataFrame, known: DataFrame | None = None, tool_id: int = 1) -> DataFrame:
    """Rows of content_mimetype for ids with a blob; with ``known`` (id, tool_id), only new ones."""
    wanted = ids.select("id").distinct().withColumn("tool_id", F.lit(tool_id).cast("long"))
    if known is not None:
        wanted = tables.missing(wanted, known, ["id", "tool_id"])
    found, _ = content.with_blobs(wanted, blobs)
    return content.mimetypes(found, "id").withColumn("tool_id", F.lit(tool_id).cast("long"))


def content_licenses(ids: DataFrame, blobs: DataFrame, tool_id: int = 1) -> DataFrame:
    """Rows of content_license: one per license that a content names."""
    found, _ = content.with_blobs(ids.select("id").distinct(), blobs)
    return content.licenses(found, "id").withColumn("tool_id", F.lit(tool_id).cast("long"))


def content_metadata(files: DataFrame, mapping: str, tool_id: int = 1) -> DataFrame:
    """Rows of content_metadata for (doc_id, data) files translated by one mapping."""
    from metalake.registry import MAPPINGS

    return props.compact(MAPPINGS[mapping].translate(files)).select(F.col("doc_id").alias("id"), "metadata", F.lit(tool_id).cast("long").alias("tool_id"))


class Indexed(NamedTuple):
    """What a directory or origin job finds. contents: (id, mapping, metadata) of newly translated
    files; directories: (id, metadata, mappings, truncated); origins: (id, metadata,
    from_directory, mappings), None for a job over directories."""

    contents: DataFrame
    directories: DataFrame
    origins: DataFrame | None = None


EMPTY = f'{{"@context":"{props.CONTEXT}"}}'


#: Ids that are sent to every task at most.
MOST_SENT = 500_000


def sent(ids: DataFrame) -> DataFrame:
    """The distinct ``ids``, a column of a written table, marked for broadcast while its rows are few."""
    return F.broadcast(ids.distinct()) if ids.count() <= MOST_SENT else ids.distinct()


def translated_files(files: DataFrame) -> DataFrame:
    """Property table of written files (doc_id, mapping, data), each by its mapping. Only the
    mappings that occur are planned; there are as many as the registry has."""
    from metalake.registry import REGISTRY

    known = REGISTRY.mappings()
    out = None
    for name in sorted(r["mapping"] for r in files.select("mapping").distinct().collect()):
        rows = known[name].translate(files.where(F.col("mapping") == name).select("doc_id", "data")).select("doc_id", "prop", "kind", "pos", "value")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return files.sparkSession.createDataFrame([], "doc_id string, prop string, kind string, pos int, value string")
    return out


def directory_metadata(wanted: DataFrame, dir_entries: DataFrame, contents: DataFrame, blobs: DataFrame, known: DataFrame | None = None, most: int = 100) -> Indexed:
    """Metadata of the directories ``wanted`` (dir_id), from their files' bytes.

    The first ``most`` entries of a directory (of its only sub-directory, if it holds nothing
    else) are searched for metadata files. Contents (sha1_git, sha1) that are not known are
    skipped. Files whose content is in ``known`` (id, metadata; whichever tool made the rows)
    are not translated again; the others are read from ``blobs`` (sha1, data) and translated,
    each content and mapping once. ``mappings`` names every mapping whose file was found,
    also where its translation failed; a directory without metadata has only the context.
    """
    from metalake.registry import REGISTRY

    rules = REGISTRY.file_rules()
    roots = dir_entries.join(wanted.select("dir_id").distinct(), "dir_id", "left_semi")
    found = written(graph.searched(roots, rules, most), "found")
    inner = found.where("inner is not null").select(F.col("dir_id").alias("outer"), F.col("inner").alias("dir_id"))
    # the filter goes below whatever makes the entries; it is broadcast while the ids are few
    below = dir_entries.join(sent(inner.select("dir_id")), "dir_id", "left_semi").join(inner, "dir_id")
    below = written(graph.searched(below.withColumn("dir_id", F.col("outer")), rules, most), "below")
    hits = found.select("dir_id", "hits").unionByName(below.select("dir_id", "hits")).select("dir_id", F.inline("hits"))
    # a content lies in many directories, so all that asks about contents asks once for each
    pairs = hits.groupBy("target", "mapping").agg(F.count(F.lit(1)).alias("n"))
    located = written(pairs.join(contents.select(F.col("sha1_git").alias("target"), "sha1"), "target"), "located")
    if known is None:
        known = blobs.sparkSession.createDataFrame([], "id string, metadata string")
    reused, rest = graph.split_known(located, known)
    name = F.concat_ws("/", "mapping", "sha1")
    todo = rest.select("sha1", "mapping").distinct().withColumnRenamed("sha1", "id")
    files = content.with_blobs(todo, blobs)[0].withColumnRenamed("id", "sha1")
    files = written(files.select(name.alias("doc_id"), "mapping", "data"), "files", by="mapping")
    fresh = written(translated_files(files), "translated")
    old = known.select(F.col("id").alias("sha1"), "metadata").join(reused.select("sha1").distinct(), "sha1", "left_semi")
    old = written(old.withColumn("doc_id", F.concat_ws("/", F.lit("known"), "sha1", F.xxhash64("metadata").cast("string"))).distinct(), "reused")
    told = props.entries(fresh.unionByName(props.expand(old.select("doc_id", "metadata"))))
    groups = rest.select("target", "mapping", "n", name.alias("doc_id")).unionByName(
        reused.join(old.select("sha1", "doc_id"), "sha1").select("target", "mapping", "n", "doc_id")
    )
    facts = groups.join(told, "doc_id", "left").groupBy("target", "mapping").agg(F.max("n").alias("n"), F.flatten(F.collect_list("entries")).alias("entries"))
    met = weighed_join(hits, written(facts, "facts"), ["target", "mapping"], "n")
    doc = F.struct(F.col("mapping").alias("rank"), "entries").alias("doc")
    rows = met.select("dir_id", F.lit(None).cast("boolean").alias("truncated"), doc).unionByName(found.select("dir_id", "truncated", F.lit(None).alias("doc")))
    each = rows.repartition("dir_id").groupBy("dir_id").agg(F.max("truncated").alias("truncated"), F.collect_list("doc").alias("docs"))
    each = each.select("dir_id", "truncated", F.array_sort(F.array_distinct(F.col("docs.rank"))).alias("mappings"), "docs")
    directories = props.merged_documents(each).select(F.col("dir_id").alias("id"), F.coalesce("metadata", F.lit(EMPTY)).alias("metadata"), "mappings", "truncated")
    done = props.compact(fresh).select(F.split("doc_id", "/")[1].alias("id"), F.split("doc_id", "/")[0].alias("mapping"), "metadata")
    return Indexed(done, directories)


def origin_intrinsic_metadata(
    origins: DataFrame, visit_statuses: DataFrame, branches: DataFrame, revisions: DataFrame, releases: DataFrame, dir_entries: DataFrame,
    contents: DataFrame, blobs: DataFrame, known: DataFrame | None = None, most: int = 100,
) -> Indexed:
    """Metadata of every origin with a full visit, and of ``origins`` (url), from the files in
    the root directory of its head. Origins without head, directory or metadata are left out;
    an origin and a directory count once."""
    wanted = graph.full_visit_origins(visit_statuses, origins)
    statuses = visit_statuses.join(wanted.select(F.col("url").alias("origin")), "origin", "left_semi")
    # both are read several times below, and whatever makes them shouldn't be run each time
    visits = written(graph.latest_full_visits(statuses), "visits")
    wanted_branches = written(branches.join(sent(visits.select("snapshot")), "snapshot", "left_semi"), "branches")
    roots = written(graph.head_directories(graph.origin_heads(visits, wanted_branches), revisions, releases).dropDuplicates(["origin"]), "roots")
    found = directory_metadata(sent(roots.select(F.col("directory").alias("dir_id"))), dir_entries, contents, blobs, known, most)
    directories = written(found.directories, "directories")
    told = directories.where(S.has_metadata(F.col("metadata")))
    rows = roots.join(told, F.col("directory") == F.col("id")).select(F.col("origin").alias("id"), "metadata", F.col("directory").alias("from_directory"), "mappings")
    return Indexed(found.contents, told, rows)


#: Records of this fetcher had percent-encoded origins until then.
QUOTED_FETCHER = "swh-deposit"
QUOTED_UNTIL = "2024-05-16 15:20:00"


def target_of(remd: DataFrame) -> DataFrame:
    """``remd`` with ``target``: SHA-1 (hex) of the origin that a record describes, or null. An
    origin that cannot be decoded counts as it is."""
    quoted = (F.col("fetcher.name") == QUOTED_FETCHER) & (F.col("discovery_date") < F.lit(QUOTED_UNTIL).cast("timestamp"))
    plain = F.try_url_decode(F.replace("origin", F.lit("+"), F.lit("%2B")))
    origin = F.when(quoted, F.coalesce(plain, "origin")).otherwise(F.col("origin"))
    target = F.when(F.col("target_type") == "origin", F.col("target_id")).when(origin.isNotNull(), F.sha1(origin.cast("binary")))
    return remd.withColumn("target", target)


def resolve_targets(remd: DataFrame, origins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with the ``url`` of their origin, records whose origin isn't known yet)."""
    named = target_of(remd).where("target is not null")
    known = origins.select("url", F.sha1(F.col("url").cast("binary")).alias("target"))
    return named.join(known, "target"), named.join(known.select("target"), "target", "left_anti")


def authorised(records: DataFrame) -> DataFrame:
    """Records of a registry, or of an authority on the origin's own host."""
    return records.where((F.col("authority.type") == "registry") | (S.netloc(F.col("authority.url")) == S.netloc(F.col("url"))))


def origin_extrinsic_metadata(remd: DataFrame, origins: DataFrame) -> DataFrame:
    """(id, metadata, from_remd_id, mappings) per origin, from its latest accepted record.

    Every registered mapping of a record's format translates it; their results are merged.
    """
    from metalake.registry import REGISTRY

    found, _ = resolve_targets(remd, origins)
    good = authorised(found)
    known = sorted({f for m in REGISTRY.mappings().values() for f in m.formats})
    # one narrow scan tells which of the known formats occur, so that only their mappings are planned
    formats = [r["format"] for r in remd.where(F.col("format").isin(known)).select("format").distinct().collect()]
    translated, groups = None, None
    for mapping in REGISTRY.mappings().values():
        if not set(mapping.formats) & set(formats or known[:1]):
            continue
        mine = good.where(F.col("format").isin(list(mapping.formats)))
        key = F.concat(F.col("id"), F.lit(f"\u0001{mapping.name}"))
        rows = mapping.translate(mine.select(key.alias("doc_id"), F.col("metadata").alias("data"))).select("doc_id", "prop", "kind", "pos", "value")
        group = mine.select(F.col("id").alias("group"), F.lit(mapping.name).alias("rank"), key.alias("doc_id"))
        translated = rows if translated is None else translated.unionByName(rows)
        groups = group if groups is None else groups.unionByName(group)
    translated = written(translated, "translated")
    done = groups.join(translated.select("doc_id").distinct(), "doc_id", "left_semi")
    used = done.groupBy(F.col("group").alias("id")).agg(F.array_sort(F.collect_set("rank")).alias("mappings"))
    docs = props.compact(props.merge(translated, done)).withColumnRenamed("doc_id", "id")
    dated = good.where(F.col("format").isin(formats)).select("id", "url", "discovery_date").join(docs, "id").join(used, "id")
    last = dated.groupBy("url").agg(F.max_by(F.struct("metadata", "id", "mappings"), F.struct("discovery_date", "id")).alias("v"))
    return last.select(F.col("url").alias("id"), "v.metadata", F.col("v.id").alias("from_remd_id"), "v.mappings")
