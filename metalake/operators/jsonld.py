"""JSON-LD documents of the vocabulary as a table of nodes and statements.

A document's nodes stand at any depth, inside each other or side by side in ``@graph``; names
come as terms, with prefixes (of the vocabulary or declared by the document) or in full. One
Arrow step takes a document apart and writes every name as a term; everything after that is
joins and aggregates over (doc_id, root, node, prop, pos, kind, value).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Contexts of version 2 (the first may end in a slash), of version 3, and the
#: general vocabulary, whose terms have no types of their own.
CONTEXT_V2 = [
    "https://doi.org/10.5063/schema/codemeta-2.0",
    "https://raw.githubusercontent.com/codemeta/codemeta/master/codemeta.jsonld",
    "https://raw.githubusercontent.com/codemeta/codemeta/2.0/codemeta.jsonld",
    "https://doi.org/doi:10.5063/schema/codemeta-2.0",
    "http://purl.org/codemeta/2.0",
]
CONTEXT_V3 = ["https://w3id.org/codemeta/3.0", "https://raw.githubusercontent.com/codemeta/codemeta/3.0/codemeta.jsonld"]
CONTEXT_SCHEMA = ["http://schema.org", "https://schema.org"]
#: Namespaces of the vocabularies.
SCHEMA_IRI, CODEMETA_IRI = "http://schema.org/", "https://codemeta.github.io/terms/"
#: Terms whose values are URIs, dates and lists in the vocabulary's context.
URI_TERMS = [
    "applicationCategory", "applicationSubCategory", "codeRepository", "downloadUrl", "fileFormat", "identifier", "installUrl", "license",
    "memoryRequirements", "relatedLink", "releaseNotes", "sameAs", "softwareRequirements", "storageRequirements", "url", "softwareSuggestions",
    "contIntegration", "buildInstructions", "developmentStatus", "readme", "issueTracker", "referencePublication",
]
DATE_TERMS = ["dateCreated", "dateModified", "datePublished", "embargoDate"]
LIST_TERMS = ["author"]
PEOPLE = ["author", "editor", "publisher"]
SOFTWARE = {"SoftwareSourceCode", "SoftwareApplication"}
MOST_DEPTH = 400


def known_version(context: object) -> int | None:
    """2 or 3 for the vocabulary's contexts, 0 for the general one (any case), else None."""
    low = context.lower() if isinstance(context, str) else ""
    if low.rstrip("/") == CONTEXT_V2[0] or low in CONTEXT_V2:
        return 2
    return 3 if low.rstrip("/") in CONTEXT_V3 else 0 if low.rstrip("/") in CONTEXT_SCHEMA else None


class Document:
    """One document: its context, its top nodes and which of them is the root."""

    def __init__(self, text: str | None):
        def refuse(name: str) -> None:
            raise ValueError(name)

        whole = json.loads(text or "", parse_constant=refuse)
        if not isinstance(whole, dict) or whole.get("@context") is None:
            raise ValueError("no document of a known vocabulary")
        contexts = whole["@context"] if isinstance(whole["@context"], list) else [whole["@context"]]
        versions = [known_version(c) for c in contexts if not isinstance(c, dict)]
        if not versions or None in versions:
            raise ValueError("unknown context")
        self.typed = max(versions) > 0
        self.names = {"schema": SCHEMA_IRI, "codemeta": CODEMETA_IRI}  # prefixes and terms of one's own
        for c in contexts:
            for name, told in c.items() if isinstance(c, dict) else ():
                iri = told.get("@id") if isinstance(told, dict) else told
                if isinstance(iri, str) and not name.startswith("@"):
                    self.names[name] = iri
        top = whole.get("@graph", whole)
        self.nodes = [n for n in (top if isinstance(top, list) else [top]) if isinstance(n, dict)]
        self.root = self.nodes[0] if len(self.nodes) == 1 else self.lone_software()

    def lone_software(self) -> dict | None:
        """Of several nodes, the one of software that no other node refers to; None if that isn't one."""
        told = set()
        todo: list = [v for n in self.nodes for k, v in n.items() if k not in ("@id", "id")]
        while todo:
            v = todo.pop()
            if isinstance(v, dict):
                told.add(self.id_of(v))
                todo += [x for k, x in v.items() if k not in ("@id", "id")]
            elif isinstance(v, list):
                todo += v
        free = [n for n in self.nodes if set(self.types(n)) & SOFTWARE and (self.id_of(n) is None or self.id_of(n) not in told)]
        return free[0] if len(free) == 1 else None

    def full(self, name: str, most: int = 8) -> str:
        """A name with its prefix, or as a term of one's own, written out."""
        prefix, colon, rest = name.partition(":")
        if not most or rest.startswith("//"):
            return name
        if name in self.names:
            return self.full(self.names[name], most - 1)
        return self.full(self.names[prefix], most - 1) + rest if colon and prefix in self.names else name

    def term(self, name: str) -> tuple[str, bool]:
        """A key as a term, and whether it came with the general vocabulary's prefix."""
        if name in ("@id", "id"):
            return "id", False
        if name in ("@type", "type"):
            return "type", False
        full = self.full(name)
        for iri in (SCHEMA_IRI, SCHEMA_IRI.replace("http:", "https:"), CODEMETA_IRI):
            if full.startswith(iri) and full != iri:
                return full[len(iri) :], name.startswith("schema:")
        return full, False

    @staticmethod
    def id_of(node: dict) -> str | None:
        found = node.get("@id", node.get("id"))
        return found if isinstance(found, str) else None

    def types(self, node: dict) -> list[str]:
        found = node.get("@type", node.get("type"))
        return [self.term(t)[0] for t in (found if isinstance(found, list) else [found]) if isinstance(t, str)]

    def properties(self, node: dict) -> Iterator[tuple[str, bool, list]]:
        """(term, forced, values) of a node; lists and single values alike, nulls left out. Keys that
        are one term follow each other."""
        found: dict[tuple[str, bool], list] = {}
        for key, value in node.items():
            if key in ("@context", "@graph"):
                continue
            prop, forced = self.term(key)
            inner = value["@list"] if isinstance(value, dict) and "@list" in value else value
            items = [x["@list"] if isinstance(x, dict) and "@list" in x else [x] for x in inner] if isinstance(inner, list) else [[inner]]
            found.setdefault((prop, forced), []).extend(v for part in items for v in (part if isinstance(part, list) else [part]) if v is not None)
        return ((prop, forced, values) for (prop, forced), values in found.items())

    def value(self, prop: str, forced: bool, v: object) -> tuple[str, object]:
        """(kind, value) of one value: a text, or for kind node the dict itself."""
        plain = forced or not self.typed
        if isinstance(v, dict) and "@value" in v:
            v, plain = v["@value"], True
        if isinstance(v, dict):
            bare = len(v) == 1 and self.id_of(v) is not None
            return ("uri", self.id_of(v)) if bare else ("node", v)
        if isinstance(v, (bool, int, float)):
            return "number", json.dumps(v)
        if not isinstance(v, str):
            return "literal", json.dumps(v, ensure_ascii=False, separators=(",", ":"))
        if prop == "type":
            return "type", self.term(v)[0]
        kind = "uri" if prop == "id" or not plain and prop in URI_TERMS else "date" if not plain and prop in DATE_TERMS else "literal"
        return kind, v

    def tree(self, node: dict, depth: int = 0) -> object:
        """A node as compact JSON: terms in order, a single value alone, lists (author) as lists."""
        if depth > MOST_DEPTH:
            raise RecursionError
        out: dict = {}
        for prop, forced, values in self.properties(node):
            told = []
            for v in values:
                kind, text = self.value(prop, forced, v)
                told.append(self.tree(text, depth + 1) if kind == "node" else {"id": text} if kind == "uri" and isinstance(v, dict) else json.loads(text) if kind == "number" else text)
            if told:
                out.setdefault(prop, []).extend(told)
        return {k: v[0] if len(v) == 1 and k not in LIST_TERMS else v for k, v in sorted(out.items())}

    def statements(self) -> Iterator[tuple[bool, str, str, int, str, str]]:
        """(root, node, prop, pos, kind, value) of all nodes; a node without an id is named by its
        place. Last come the people of the root, each under the property that leads to them."""
        todo = [(n, self.id_of(n) or f"_:{k}", n is self.root, 0) for k, n in enumerate(self.nodes)]
        held: dict[str, dict[str, list]] = {}
        own: dict[str, list] = {}
        while todo:
            node, name, root, depth = todo.pop()
            if depth > MOST_DEPTH:
                raise RecursionError
            for prop, forced, values in self.properties(node):
                for pos, v in enumerate(values):
                    kind, told = self.value(prop, forced, v)
                    if kind == "node":
                        inner = self.id_of(told) or f"_:{name}/{prop}.{pos}"
                        todo.append((told, inner, False, depth + 1))
                        told = inner
                    if prop in PEOPLE or prop == "type":
                        held.setdefault(name, {}).setdefault(prop, []).append((kind, told))
                        if root and prop in PEOPLE:
                            own.setdefault(prop, []).append((kind, told))
                    yield root, name, prop, pos, kind, told
        for prop, values in own.items():
            found = (x for v in values for x in whom(held, prop, *v, set()))
            for pos, (kind, told) in enumerate(found):
                yield True, "", prop, pos, "person" if kind in ("node", "uri") else "person's name", told


def whom(held: dict[str, dict[str, list]], prop: str, kind: str, value: str, seen: set[str]) -> Iterator[tuple[str, str]]:
    """Who stands there: a Role stands for those that it holds under the same property, however
    deep; one that holds itself, for nobody."""
    if kind not in ("node", "uri"):
        yield kind, value
    elif value not in seen:
        seen.add(value)
        known = held.get(value, {})
        if ("type", "Role") not in known.get("type", []):
            yield kind, value
        for inner in known.get(prop, []) if ("type", "Role") in known.get("type", []) else []:
            yield from whom(held, prop, *inner, seen)


def rows_of(docs: DataFrame, take, schema: str) -> DataFrame:
    """(doc_id, *take(document)) of JSON documents (doc_id, metadata); those that are no documents of
    a known vocabulary give no rows, nor do those nested too deep to be read."""
    fields = [x.split()[0] for x in schema.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = []
            for doc_id, text in zip(b[0].to_pylist(), b[1].to_pylist()):
                try:
                    out += [(doc_id, *row) for row in take(Document(text))]
                except (ValueError, RecursionError):
                    continue
            columns = list(zip(*out)) or [()] * len(fields)
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], fields)

    return docs.select(F.col("doc_id").cast("string"), "metadata").mapInArrow(run, schema)


def statements(docs: DataFrame) -> DataFrame:
    """Table (doc_id, root, node, prop, pos, kind, value) of all nodes. kind: literal, number, uri, date,
    type, or node, whose value names a node; person and person's name tell whom the document's people
    are once Roles are replaced by whom they hold. root marks the node that the document is about:
    its only one, or of several the lone software node that no other refers to."""
    return rows_of(docs, Document.statements, "doc_id string, root boolean, node string, prop string, pos int, kind string, value string")


def properties(docs: DataFrame) -> DataFrame:
    """Property table (doc_id, prop, kind, pos, value) of the roots; nodes inside are JSON text (kind object)."""

    def take(doc: Document) -> Iterator[tuple[str, str, int, str]]:
        for prop, forced, values in doc.properties(doc.root or {}):
            for pos, v in enumerate(values):
                kind, told = doc.value(prop, forced, v)
                node = kind == "node"
                yield prop, "object" if node else kind, pos, json.dumps(doc.tree(told), ensure_ascii=False, separators=(",", ":")) if node else told

    return rows_of(docs, take, "doc_id string, prop string, kind string, pos int, value string")
