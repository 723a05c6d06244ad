"""Metadata documents to citations: BibTeX text and CSL-JSON, row by row in native columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metalake.functions.scalars import spdx_name
from metalake.operators import jsonld
from metalake.operators.jsonld import PEOPLE
from metalake.plans.lineage import written

TEXTS = [
    "name", "description", "dateCreated", "datePublished", "dateModified", "url", "version", "codeRepository",
    "relatedLink", "downloadUrl", "installUrl", "releaseNotes", "referencePublication",
]
#: The identifiers' prefixes, object types of persistent identifiers and the BibTeX entry types for them.
ENTRY_TYPES = {"snp": "software", "rev": "softwareversion", "rel": "softwareversion", "dir": "softwareversion", "cnt": "codefragment"}


PERSON = "struct<name: string, given: string, family: string, organization: boolean, email: string>"


def people(table: DataFrame) -> DataFrame:
    """(doc_id, role, path, person, affiliations) of everyone with a name, in order of path."""
    entity = F.col("kind") == "person"
    found = table.where(F.col("kind").startswith("person")).select("doc_id", F.col("prop").alias("role"), F.array("pos").alias("path"), F.when(entity, F.col("value")).alias("node"), F.when(~entity, F.col("value")).alias("literal"))
    names = table.where(F.col("prop").isin("name", "givenName", "familyName", "type", "email", "affiliation"))
    first = lambda p: F.min(F.when(F.col("prop") == p, F.struct("pos", "value")))["value"]
    told = names.groupBy("doc_id", "node").agg(
        first("name").alias("name"), first("givenName").alias("given"), first("familyName").alias("family"), first("email").alias("email"),
        F.coalesce(F.bool_or((F.col("prop") == "type") & (F.col("value") == "Organization")), F.lit(False)).alias("organization"),
    )
    whole = told.withColumn("name", F.coalesce("name", F.nullif(F.trim(F.concat_ws(" ", "given", "family")), F.lit("")))).where("name is not null")
    joined = found.join(whole, ["doc_id", "node"], "left")
    person = F.when(
        F.coalesce("name", "literal").isNotNull(), F.struct(F.coalesce("name", "literal").alias("name"), "given", "family", F.coalesce("organization", F.lit(False)).alias("organization"), "email")
    ).cast(PERSON)
    # whom a person is affiliated with: a node's name, or a text
    member = names.where("prop = 'affiliation'").select("doc_id", "node", "pos", "kind", F.col("value").alias("place"))
    org = whole.select("doc_id", F.col("node").alias("place"), F.col("name").alias("org"))
    member = member.join(org, ["doc_id", "place"], "left").withColumn("org", F.coalesce("org", F.when(F.col("kind") == "literal", F.col("place"))))
    member = member.where("org is not null").groupBy("doc_id", "node").agg(F.sort_array(F.collect_list(F.struct("pos", "org"))).alias("orgs"))
    out = joined.join(member, ["doc_id", "node"], "left").select("doc_id", "role", "path", person.alias("person"), F.transform("orgs", lambda o: o["org"]).alias("affiliations"))
    return out.where("person is not null")


def first_seen(items: Column) -> Column:
    """Values of (pos, value) structs in order of pos, without repeats."""
    return F.array_distinct(F.transform(F.sort_array(items), lambda x: x["v"]))


def facts(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, metadata): single texts, and lists of licenses, identifiers,
    people and affiliations. Documents without a usable vocabulary are absent."""
    table = written(jsonld.statements(docs), "statements")
    own = table.where("root and not startswith(kind, 'person')").select("doc_id", "prop", F.array("pos").alias("path"), "value", F.lit(None).cast(PERSON).alias("person"), F.lit(None).cast("array<string>").alias("affiliations"))
    own = own.where(~F.col("prop").isin(PEOPLE) & ~F.col("value").startswith("_:"))
    someone = people(table).select("doc_id", F.col("role").alias("prop"), "path", F.lit(None).cast("string").alias("value"), "person", "affiliations")
    everyone = table.select("doc_id").distinct().select("doc_id", F.lit("").alias("prop"), F.array().cast("array<int>").alias("path"), F.lit(None).cast("string").alias("value"), F.lit(None).cast(PERSON).alias("person"), F.lit(None).cast("array<string>").alias("affiliations"))
    rows = own.unionByName(someone).unionByName(everyone)
    single = [F.min(F.when(F.col("prop") == t, F.struct("path", "value")))["value"].alias(t) for t in TEXTS]
    lists = [first_seen(F.collect_list(F.when(F.col("prop") == p, F.struct(F.col("path").alias("p"), F.col("person").alias("v"))))).alias(f"{p}s") for p in PEOPLE]
    rank = F.concat(F.array(sum((F.when(F.col("prop") == p, i).otherwise(0) for i, p in enumerate(PEOPLE)), F.lit(0))), F.col("path"))
    where = F.collect_list(F.when(F.col("affiliations").isNotNull(), F.struct(rank.alias("p"), F.col("affiliations").alias("v"))))
    place = F.when(F.col("prop") == "id", F.array(F.lit(-1))).otherwise(F.col("path"))  # the document's own id comes first
    texts = [
        first_seen(F.collect_list(F.when(F.col("prop").isin(p), F.struct(place.alias("p"), F.col("value").alias("v"))))).alias(name)
        for p, name in ((["license"], "license_uris"), (["identifier", "id"], "identifiers"))
    ]
    out = rows.groupBy("doc_id").agg(*single, *lists, *texts, F.array_distinct(F.flatten(F.transform(F.sort_array(where), lambda x: x["v"]))).alias("affiliations"))
    out = out.withColumn("licenses", F.array_compact(F.transform("license_uris", spdx_name)))
    ordered = F.concat("identifiers", F.filter(F.transform("identifiers", lambda x: F.substring_index(x, "/", -1)), lambda x: ~x.contains("/")))
    return out.withColumn("identifiers", F.array_distinct(ordered))


def dated(rows: DataFrame) -> DataFrame:
    """``rows`` with _text (published, else created, else modified) and _date, null if unparsable."""
    text = F.coalesce("datePublished", "dateCreated", "dateModified")
    day = F.substring("_text", 1, 10)
    # what can't be a date isn't given to the parser, whose refusals are costly
    return rows.withColumn("_text", text).withColumn("_date", F.when(day.rlike(r"^[+-]?\d+-\d+-\d+$"), F.try_to_date(day, "yyyy-MM-dd")))


def last_name_first(p: Column) -> Column:
    plain = F.regexp_replace(F.trim(p["name"]), r"^(.*) (\S+)$", "$2, $1")
    split = F.when(p["family"].isNotNull(), F.concat_ws(", ", p["family"], p["given"])).otherwise(plain)
    return F.when(p["organization"], F.concat(F.lit("{"), p["name"], F.lit("}"))).otherwise(split)


def names(column: str) -> Column:
    return F.nullif(F.array_join(F.transform(column, last_name_first), " and "), F.lit(""))


def citation_key(swhid: Column) -> Column:
    """The first identifier without a slash, else a short form of the SWHID, else a stub."""
    compact = F.get(F.filter("identifiers", lambda x: ~x.contains("/")), F.lit(0))
    part = lambda k: F.regexp_extract(swhid, r"^swh:1:([a-z]{3}):([0-9a-f]{7})[^;]*(?:.*;lines=(\d+)(?:-(\d+))?)?", k)
    lines = F.concat(F.when(part(3) != "", F.concat(F.lit("-L"), part(3))).otherwise(""), F.when(part(4) != "", F.concat(F.lit("-L"), part(4))).otherwise(""))
    short = F.when(part(1) != "", F.concat(F.lit("swh-"), part(1), F.lit("-"), part(2), lines))
    return F.coalesce(compact, short, F.lit("REPLACEME"))


def entry_type(swhid: Column) -> Column:
    kind = F.regexp_extract(swhid, r"^swh:1:([a-z]{3}):", 1)
    named = F.coalesce(*[F.when(kind == k, v) for k, v in ENTRY_TYPES.items()])
    return F.coalesce(named, F.when(F.col("version").isNotNull(), "softwareversion"), F.lit("software"))


def doi() -> Column:
    found = F.filter("identifiers", lambda x: x.rlike(r"^https?://(dx\.)?doi\.org/"))
    return F.regexp_replace(F.get(found, F.lit(0)), r"^https?://(dx\.)?doi\.org/", "")


def paired(value: Column) -> Column:
    """Do the braces of a text pair up?"""
    braces = F.split(F.regexp_replace(value, "[^{}]", ""), "")
    state = F.aggregate(
        braces,
        F.struct(F.lit(0).alias("open"), F.lit(True).alias("fine")),
        lambda s, c: F.struct(
            (s["open"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)).alias("open"),
            (s["fine"] & (s["open"] - F.when(c == "}", 1).otherwise(0) >= 0)).alias("fine"),
        ),
    )
    return state["fine"] & (state["open"] == 0)


def fielded(value: Column, verbatim: bool) -> Column:
    """A field's value in quotes, or in braces where it has quotes itself. Braces that don't
    pair up are written as TeX commands; characters that TeX reads as commands are escaped,
    but for ``verbatim`` values."""
    escaped = value if verbatim else F.regexp_replace(value, r"([&%$#_])", r"\\$1")
    spelled = F.replace(F.replace(escaped, F.lit("{"), F.lit("\\textbraceleft ")), F.lit("}"), F.lit("\\textbraceright "))
    plain = F.when(~value.rlike("[{}]"), escaped).when(paired(value), escaped).otherwise(spelled)
    return F.when(value.contains('"'), F.concat(F.lit("{"), plain, F.lit("}"))).otherwise(F.concat(F.lit('"'), plain, F.lit('"')))


#: Fields that are names in BibTeX form, addresses or keys.
VERBATIM = {"author", "editor", "date", "year", "doi", "repository", "url", "swhid"}


def bibtex(rows: DataFrame) -> DataFrame:
    """Facts (with a column swhid, which may be null) with ``bibtex`` and ``error``."""
    rows = dated(rows)
    text, date = F.col("_text"), F.col("_date")
    year = F.coalesce(F.year(date).cast("string"), F.when(date.isNull() & text.isNotNull() & text.rlike(r"^\d{4}"), F.substring(text, 1, 4)))
    swhid = F.coalesce("swhid", F.lit(""))
    fields = [
        ("author", names("authors")), ("organization", F.nullif(F.array_join("affiliations", ", "), F.lit(""))), ("license", F.nullif(F.array_join("licenses", " and "), F.lit(""))),
        ("date", F.coalesce(date.cast("string"), text)), ("year", year), ("month", F.lower(F.date_format(date, "MMM"))), ("doi", doi()), ("editor", names("editors")),
        ("publisher", F.nullif(F.array_join(F.transform("publishers", lambda p: p["name"]), ", "), F.lit(""))), ("repository", F.col("codeRepository")), ("url", F.coalesce("url", "relatedLink", "downloadUrl", "installUrl")),
        ("title", F.col("name")), ("abstract", F.col("description")), ("version", F.col("version")), ("swhid", F.col("swhid")),
    ]
    # every field is a column of its own first: inside a lambda its expression would be evaluated at each use
    rows = rows.select("*", *[c.alias(f"field_{k}") for k, c in fields])
    told = [F.when(F.col(f"field_{k}").isNotNull(), F.concat(F.lit(f"    {k} = "), F.col("field_month") if k == "month" else fielded(F.col(f"field_{k}"), k in VERBATIM))) for k, _ in fields]
    rows = rows.withColumn("_lines", F.array_compact(F.array(*told)))
    lines = F.col("_lines")
    head = F.concat(F.lit("@"), entry_type(swhid), F.lit("{"), citation_key(swhid), F.lit(",\n"))
    body = F.concat(head, F.array_join(lines, ",\n"), F.lit("\n}\n"))
    done = rows.withColumn("bibtex", F.when(F.size(lines) > 0, body)).withColumn("error", F.when(F.size(lines) == 0, "no field to cite"))
    return done.drop("_lines", "_text", "_date", *[f"field_{k}" for k, _ in fields])


def csl(rows: DataFrame) -> DataFrame:
    """Facts with ``csl``, a CSL-JSON object; unknown fields are left out."""
    rows = dated(rows)
    date = F.col("_date")
    words = lambda p: F.split(F.trim(p["name"]), " +")
    person = lambda p: F.struct(
        F.when(p["organization"], p["name"]).otherwise(F.coalesce(p["family"], F.element_at(words(p), -1))).alias("family"),
        F.when(~p["organization"], F.coalesce(p["given"], F.nullif(F.array_join(F.slice(words(p), 1, F.greatest(F.size(words(p)) - 1, F.lit(0))), " "), F.lit("")))).alias("given"),
    )
    some = lambda a: F.when(F.size(a) > 0, a)
    parts = F.when(date.isNotNull(), F.struct(F.array(F.array(F.year(date), F.month(date), F.dayofmonth(date))).alias("date-parts")))
    record = F.struct(
        F.lit("software").alias("type"), F.col("name").alias("title"), F.col("description").alias("abstract"), some(F.transform("authors", person)).alias("author"), parts.alias("issued"),
        doi().alias("DOI"), F.get("identifiers", F.lit(0)).alias("id"), F.get(F.transform("publishers", lambda p: p["name"]), F.lit(0)).alias("publisher"), F.col("codeRepository").alias("source"),
        F.coalesce("url", "relatedLink", "downloadUrl", "installUrl").alias("URL"), F.nullif(F.array_join("licenses", " and "), F.lit("")).alias("license"), F.col("version").alias("version"),
    )
    return rows.withColumn("csl", F.to_json(record)).drop("_text", "_date")


def cite(docs: DataFrame, style: str = "bibtex") -> DataFrame:
    """(doc_id, citation, error) of documents (doc_id, metadata, swhid) in one style. Documents
    that aren't JSON-LD of a known vocabulary get an error row."""
    known = facts(docs).join(docs.select("doc_id", "swhid"), "doc_id")
    if style == "bibtex":
        done = bibtex(known).select("doc_id", F.col("bibtex").alias("citation"), "error")
    elif style == "csl":
        done = csl(known).select("doc_id", F.col("csl").alias("citation"), F.lit(None).cast("string").alias("error"))
    else:
        raise ValueError(f"style {style}")
    return docs.select("doc_id").join(done, "doc_id", "left").withColumn("error", F.when(F.col("citation").isNull(), F.coalesce("error", F.lit("not a document of a known vocabulary"))))
