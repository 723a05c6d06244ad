"""Property tables: the shape in which translated documents are merged and compacted.

A property table has a row (doc_id, prop, kind, pos, value) per value; kind is literal, uri,
date, number, type or object (value: JSON text, for nested nodes), pos orders lists (author).
The document's own id and types are the props ``id`` and ``type``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metalake.operators import jsonld
from metalake.operators.jsonld import CODEMETA_IRI, DATE_TERMS, LIST_TERMS, SCHEMA_IRI, URI_TERMS  # noqa: F401

CONTEXT = "https://doi.org/10.5063/schema/codemeta-2.0"
PREFIXES = {"as": "https://www.w3.org/ns/activitystreams#", "forge": "https://forgefed.org/ns#", "xsd": "http://www.w3.org/2001/XMLSchema#"}
#: The vocabulary's other terms.
PLAIN_TERMS = [
    "Organization", "Person", "SoftwareSourceCode", "SoftwareApplication", "Text", "URL", "address", "affiliation", "citation", "contributor", "copyrightHolder",
    "copyrightYear", "description", "email", "editor", "encoding", "familyName", "fileSize", "funder", "givenName", "hasPart", "isAccessibleForFree", "isPartOf",
    "keywords", "name", "operatingSystem", "permissions", "position", "processorRequirements", "producer", "programmingLanguage", "provider", "publisher",
    "runtimePlatform", "softwareHelp", "softwareVersion", "sponsor", "supportingData", "targetProduct", "version", "funding", "maintainer",
]
#: Every term that a document of the vocabulary itself can carry.
TERMS = sorted({*URI_TERMS, *DATE_TERMS, *LIST_TERMS, *PLAIN_TERMS, "schema", "codemeta"})
PREFIXED = ["forge:", "as:", "schema:", "codemeta:", "xsd:", "http://", "https://"]
STRINGS = "array<string>"


def drop_empty_uris(rows: DataFrame) -> DataFrame:
    """Rows without an empty URI as value."""
    return rows.where(~((F.col("kind") == "uri") & (F.coalesce("value", F.lit("")) == "")))


def one_of(c: Column, values: list[str]) -> Column:
    return c.isin(values)


def compact_key(prop: Column, kind: Column) -> Column:
    """A term, or the term under ``schema:`` where the value's kind isn't what its context wants."""
    wants = F.when(one_of(prop, URI_TERMS), "uri").when(one_of(prop, DATE_TERMS), "date").otherwise("any")
    known = F.greatest(*[prop.startswith(p) for p in PREFIXED]) | prop.isin("id", "type")
    fits = known | (wants == "any") & kind.isin("literal", "number", "object", "uri", "date") | (wants == kind) | (kind == "object")
    return F.when(fits, prop).otherwise(F.concat(F.lit("schema:"), prop))


def quoted(value: Column) -> Column:
    """A string as JSON text."""
    wrapped = F.substring(F.to_json(F.struct(value.alias("v"))), 6, 2**31 - 1)
    return F.substring(wrapped, F.lit(1), F.length(wrapped) - 1)


def json_value(value: Column, kind: Column) -> Column:
    """JSON text of one value: numbers and nested nodes as they are, the rest as strings."""
    return F.when(kind.isin("number", "object"), value).otherwise(quoted(value))


def full_names(text: Column) -> Column:
    """JSON text (or, after its quote, a name) with the forge prefixes written out."""
    for prefix, iri in PREFIXES.items():
        text = F.replace(text, F.lit(f'"{prefix}:'), F.lit(f'"{iri}'))
    return text


def key_and_json(forge: bool = False) -> tuple[Column, Column]:
    """The key and the JSON text with which a row of a property table stands in its document."""
    key, json = compact_key(F.col("prop"), F.col("kind")), json_value(F.col("value"), F.col("kind"))
    if not forge:
        of_forge = F.col("prop").startswith("as:") | F.col("prop").startswith("forge:") | (F.col("prop") == "type")
        key = F.substring(full_names(F.concat(F.lit('"'), key)), 2, 2**31 - 1)
        json = F.when(of_forge, full_names(json)).otherwise(json)
    return key, json


def compact(props: DataFrame, forge: bool = False) -> DataFrame:
    """(doc_id, metadata): JSON documents, context and type first, then sorted keys. One value is
    a scalar, several a sorted array without repeats; lists (author) are always arrays, in
    order. With ``forge`` the context declares the prefixes of forge records; without, their
    names are written out. A document's rows meet in one exchange."""
    rows = drop_empty_uris(props).where("value is not null")
    listed = F.col("prop").isin(LIST_TERMS)
    key, json = key_and_json(forge)
    keyed = rows.select("doc_id", key.alias("key"), listed.alias("listed"), F.struct(F.when(listed, F.col("pos")).otherwise(0).alias("pos"), json.alias("json")).alias("v"))
    values = keyed.repartition("doc_id").groupBy("doc_id", "key").agg(F.max("listed").alias("listed"), F.sort_array(F.collect_set("v")).alias("vs"))
    texts = F.array_distinct(F.transform("vs", lambda v: v["json"]))
    body = F.when(F.col("listed") | (F.size(texts) > 1), F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))).otherwise(F.element_at(texts, 1))
    pair = F.struct((F.col("key") != "type").alias("late"), "key", F.concat(F.lit('"'), F.col("key"), F.lit('":'), body).alias("text"))
    # a column first, for what stands inside of an aggregate is evaluated part by part
    docs = values.select("doc_id", pair.alias("pair")).groupBy("doc_id").agg(F.sort_array(F.collect_list("pair")).alias("pairs"))
    more = ",".join(f'"{p}":"{iri}"' for p, iri in PREFIXES.items())
    context = F.array(F.lit(f'"@context":["{CONTEXT}",{{{more}}}]' if forge else f'"@context":"{CONTEXT}"'))
    return docs.select("doc_id", F.concat(F.lit("{"), F.array_join(F.concat(context, F.transform("pairs", lambda p: p["text"])), ","), F.lit("}")).alias("metadata"))


def expand(docs: DataFrame) -> DataFrame:
    """Property table of JSON documents (doc_id, metadata).

    The context may be one name, or a list of names and of inline prefixes; invalid text, no
    object, no context or an unknown one give no rows. Of repeated keys the last counts. ``id``
    and ``type`` become rows too; ``@list``, ``@value`` and bare references are unwrapped, and
    names are terms at every depth. Of a ``@graph`` the root's properties are told. Under the
    general vocabulary alone, URIs and dates are plain texts.
    """
    return jsonld.properties(docs)


def merge(props: DataFrame, groups: DataFrame) -> DataFrame:
    """Property table of merged documents. ``groups`` has (group, rank, doc_id): values of a
    property keep the order of first appearance, repeats go; of the documents' ids the first
    stays and other ones become texts of ``sameAs``. A group's rows meet in one exchange."""
    return merge_rows(groups.join(props, "doc_id"))


def merge_rows(joined: DataFrame) -> DataFrame:
    """:func:`merge` of groups that are joined with their documents' properties already."""
    at = F.struct("rank", "pos").alias("at")
    rows = joined.select("group", "prop", "kind", "value", at).repartition("group")
    first = rows.groupBy("group", "prop", "kind", "value").agg(F.min("at").alias("at"))
    kept = F.min(F.when(F.col("prop") == "id", F.struct("at", "value"))).over(Window.partitionBy("group"))["value"]
    other = (F.col("prop") == "id") & (F.col("value") != F.col("kept"))
    named = first.withColumn("kept", kept).select(
        "group", F.when(other, "sameAs").otherwise(F.col("prop")).alias("prop"), F.when(other, "literal").otherwise(F.col("kind")).alias("kind"), "value", "at"
    )
    again = named.groupBy("group", "prop", "kind", "value").agg(F.min("at").alias("at"))
    numbered = again.groupBy("group", "prop").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "value"))).alias("vs"))
    values = numbered.select(F.col("group").alias("doc_id"), "prop", F.posexplode("vs").alias("pos", "v"))
    return values.select("doc_id", "prop", "v.kind", F.when(F.col("prop") == "id", 0).otherwise(F.col("pos")).alias("pos"), "v.value")


def entries(props: DataFrame) -> DataFrame:
    """(doc_id, entries): of every document the key and JSON text of each value, made once however
    many groups it is in. Only ids and lists keep what their merge goes by: pos, kind and value."""
    is_id, listed = F.col("prop") == "id", F.col("prop").isin(LIST_TERMS)
    stays = F.col("value").isNotNull() & ~((F.col("kind") == "uri") & (F.col("value") == ""))
    key, json = key_and_json()
    told = [F.when(is_id | listed, F.col(c)).alias(c) for c in ("pos", "kind", "value")]
    rows = props.where(is_id | stays).select("doc_id", F.struct(key.alias("key"), F.when(stays, json).alias("json"), is_id.alias("is_id"), listed.alias("listed"), *told).alias("entry"))
    return rows.groupBy("doc_id").agg(F.collect_list("entry").alias("entries"))


def merged_documents(groups: DataFrame) -> DataFrame:
    """``groups`` with ``metadata`` in the place of ``docs``, an array of (rank, entries): the text that
    :func:`compact` gives of their :func:`merge`, null where nothing is told. A group is one row, so
    neither of them has its values sorted as rows; each select below stands for itself, for an array
    that is made under a lambda would be made again for each of its items."""
    keep = [F.col(f"`{c}`") for c in groups.columns if c != "docs"]
    own = ["key", "json", "is_id", "listed", "pos", "kind", "value"]
    every = F.flatten(F.transform("docs", lambda d: F.transform(d["entries"], lambda e: F.struct(d["rank"].alias("rank"), *[e[c].alias(c) for c in own]))))
    ids = F.transform(F.filter("every", lambda e: e["is_id"]), lambda e: F.struct(e["rank"], e["pos"], e["value"].alias("value")))
    rows = groups.select(*keep, every.alias("every")).select("*", F.array_min(ids)["value"].alias("kept"))

    def placed(e: Column) -> Column:
        order = F.when(e["listed"], F.struct(e["rank"].alias("rank"), e["pos"].alias("pos"), e["kind"].alias("kind"), e["value"].alias("value")))
        other = e["is_id"] & F.col("kept").isNotNull() & (e["value"] != F.col("kept"))
        key = F.when(other, compact_key(F.lit("sameAs"), F.lit("literal"))).otherwise(e["key"])
        return F.struct((key != "type").alias("late"), key.alias("key"), F.when(other, quoted(e["value"])).otherwise(e["json"]).alias("json"), order.alias("order"))

    def same(array: str, x: Column, at: Column, *fields: str) -> Column:
        found = F.lit(True)
        for f in fields:
            found = found & F.get(array, at)[f].eqNullSafe(x[f])
        return found

    rows = rows.select(*keep, F.sort_array(F.filter(F.transform("every", placed), lambda e: e["json"].isNotNull())).alias("values"))
    first = F.filter("values", lambda x, i: ~same("values", x, i - 1, "key", "json"))
    ordered = F.sort_array(F.transform(first, lambda x: F.struct(*[x[c].alias(c) for c in ("late", "key", "order", "json")])))
    rows = rows.select(*keep, ordered.alias("values"))

    def piece(x: Column, i: Column) -> Column:
        before, after = same("values", x, i - 1, "key"), same("values", x, i + 1, "key")
        many = x["order"].isNotNull() | before | after
        start = F.when(before, "").otherwise(F.concat(F.lit('"'), x["key"], F.when(many, '":[').otherwise('":')))
        return F.concat(start, x["json"], F.when(many & ~after, "]").otherwise(""))

    pieces = F.concat(F.array(F.lit(f'"@context":"{CONTEXT}"')), F.transform("values", piece))
    whole = F.when(F.size("values") > 0, F.concat(F.lit("{"), F.array_join(pieces, ","), F.lit("}")))
    # explode keeps filters on the text above all of this; below, each would hold its steps many times over
    return rows.select(*keep, F.explode_outer(F.array(whole)).alias("metadata"))
