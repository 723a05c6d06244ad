"""Registries of mappings and indexers; users add their own under the same rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metalake.operators import formats
from metalake.operators.graph import FILE_RULES
from metalake.plans import pipelines

Translate = Callable[[DataFrame], DataFrame]


class MappingConflict(ValueError):
    """Two external mappings have the same name."""


@dataclass(frozen=True)
class Mapping:
    """Translates files (doc_id, data) into a property table.

    Intrinsic mappings have a file rule (kind, value); extrinsic ones a list of formats.
    """

    name: str
    translate: Translate
    rule: tuple[str, str] | None = None
    formats: tuple[str, ...] = ()
    terms: tuple[str, ...] = ()


def ruled(name: str, rules: DataFrame, rule: tuple[str, str] | None = None, extrinsic: tuple[str, ...] = (), hooks: dict[str, Callable[[Column], Column]] | None = None, terms: tuple[str, ...] = ()) -> Mapping:
    """A mapping of JSON files by rules (key, term, kind), such as :func:`crosswalk_rules` gives.
    ``hooks`` change single keys: from the key's variant to an array of strings."""
    return Mapping(name, lambda files: formats.by_rules(files, rules, hooks=hooks), rule, extrinsic, terms)


def crosswalk_rules(crosswalk: DataFrame, terms: DataFrame, ecosystem: str) -> DataFrame:
    """(key, term, kind) of one ecosystem: the crosswalk's keys, with the kind that the context's
    terms (term, iri, coerce) want; other terms hold plain texts."""
    kinds = terms.select("term", F.when(F.col("coerce") == "@id", "uri").when(F.col("coerce").endswith("Date"), "date").otherwise("literal").alias("kind"))
    mine = crosswalk.where(F.col("ecosystem") == ecosystem).select("key", "term")
    return mine.join(kinds, "term", "left").select("key", "term", F.coalesce("kind", F.lit("literal")).alias("kind"))


@dataclass(frozen=True)
class Indexer:
    """A job over named input tables."""

    name: str
    inputs: tuple[str, ...]
    run: Callable[..., DataFrame]
    doc: str = ""


@dataclass
class Registry:
    builtin: dict[str, Mapping] = field(default_factory=dict)
    external: dict[str, Mapping] = field(default_factory=dict)
    indexers: dict[str, Indexer] = field(default_factory=dict)

    def add_mapping(self, mapping: Mapping) -> None:
        """An external mapping replaces a built-in one of its name; two external ones conflict."""
        if mapping.name in self.external:
            raise MappingConflict(mapping.name)
        self.external[mapping.name] = mapping

    def add_indexer(self, indexer: Indexer) -> None:
        self.indexers[indexer.name] = indexer

    def mappings(self) -> dict[str, Mapping]:
        return dict(sorted((self.builtin | self.external).items()))

    def file_rules(self) -> list[tuple[str, str, str]]:
        """Rules of all intrinsic mappings, for :func:`metalake.operators.graph.detect_files`."""
        return [(m.name, *m.rule) for m in self.mappings().values() if m.rule]

    def for_format(self, name: str) -> list[Mapping]:
        return [m for m in self.mappings().values() if name in m.formats]

    def mapping_table(self, spark: SparkSession) -> DataFrame:
        rows = [(m.name, "intrinsic" if m.rule else "extrinsic", list(m.formats)) for m in self.mappings().values()]
        return spark.createDataFrame(rows, "name string, kind string, formats array<string>")

    def indexer_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i.name, i.doc) for i in sorted(self.indexers.values(), key=lambda i: i.name)], "name string, doc string")

    def term_coverage(self, spark: SparkSession, exclude: tuple[str, ...] = ()) -> DataFrame:
        """(term, mappings): the mappings that can produce a term."""
        rows = [(t, m.name) for m in self.mappings().values() if m.name not in exclude for t in m.terms]
        table = spark.createDataFrame(rows, "term string, mapping string")
        return table.groupBy("term").agg(F.array_sort(F.collect_set("mapping")).alias("mappings"))


_RULES = {name: (kind, value) for name, kind, value in FILE_RULES}
MAPPINGS: dict[str, Mapping] = {
    name: Mapping(name, translate, _RULES.get(name), extrinsic, terms)
    for name, (translate, extrinsic, terms) in formats.BUILTIN.items()
}
REGISTRY = Registry(builtin=MAPPINGS)
for _indexer in (
    Indexer("mimetype", ("content",), pipelines.content_mimetypes, "MIME type and encoding of contents"),
    Indexer("license", ("content",), pipelines.content_licenses, "licenses that contents name"),
    Indexer("content_metadata", ("content",), pipelines.content_metadata, "metadata files, translated"),
    Indexer("directory_metadata", ("directory",), pipelines.directory_metadata, "metadata of directories"),
    Indexer("origin_intrinsic_metadata", ("origin", "origin_visit_status"), pipelines.origin_intrinsic_metadata, "metadata of origins, from their head's root directory"),
    Indexer("origin_extrinsic_metadata", ("raw_extrinsic_metadata",), pipelines.origin_extrinsic_metadata, "metadata of origins, from forge records"),
):
    REGISTRY.add_indexer(_indexer)
