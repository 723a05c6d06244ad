"""Translation jobs: tables of package files and forge records to property tables.

Every job takes files (doc_id, data binary) and returns rows (doc_id, prop, kind, pos, value)
of :mod:`metalake.operators.props`. Text that is not UTF-8, not well formed or not an object
gives no rows; :func:`rejected` tells which documents those are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metalake.functions.scalars import is_url, parsed, spdx_uri
from metalake.operators.decode import gemspec_to_json, has_root, utf8, xml_text, yaml_to_json
from metalake.operators.props import TERMS, expand, quoted

STRINGS = "array<string>"


# -- shared shapes --------------------------------------------------------------------------


def json_files(files: DataFrame, *keys: str) -> DataFrame:
    """(doc_id, f) of JSON files; f: the values of ``keys`` as variants, taken apart in one step, or
    null where the data is no JSON object. Of repeated keys the last counts, at any depth. Nothing is
    filtered here: Spark would test the rows before, and parse every file again for each part of the test."""
    rows = parsed(files.select("doc_id", utf8().alias("t")), F.col("t"), "v")
    fields = ", ".join(f"`{k}`: variant" for k in keys)
    return rows.select("doc_id", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.try_variant_get("v", "$", f"struct<{fields}>")).alias("f"))


def item(key: str, *inner: str) -> Column:
    """The variant under a key, or under the keys inside it."""
    x = F.col(f"f.`{key}`")
    return F.try_variant_get(x, "$" + "".join(f"['{k}']" for k in inner), "variant") if inner else x


def shape(x: Column) -> Column:
    return F.schema_of_variant(x)


def text_of(x: Column) -> Column:
    """A variant that is a string; numbers and other types give null."""
    return F.when(shape(x) == "STRING", F.try_variant_get(x, "$", "string"))


def texts_of(x: Column) -> Column:
    """A string, or the strings of an array; other items are dropped."""
    listed = F.transform(F.filter(F.try_variant_get(x, "$", "array<variant>"), lambda i: shape(i) == "STRING"), lambda i: F.try_variant_get(i, "$", "string"))
    return F.when(shape(x) == "STRING", F.array(F.try_variant_get(x, "$", "string"))).otherwise(F.coalesce(listed, F.array().cast(STRINGS)))


def text_at(key: str, *inner: str) -> Column:
    return text_of(item(key, *inner))


def texts_at(key: str) -> Column:
    return texts_of(item(key))


def as_array(c: Column) -> Column:
    return F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast(STRINGS))


def person_json(name: Column | None, email: Column | None = None, url: Column | None = None, given: Column | None = None, family: Column | None = None, node: Column | None = None, org: Column | None = None) -> Column:
    """JSON text of a Person node, without empty fields; null when nothing is known."""
    given_fields = {"name": name, "email": email, "url": url, "givenName": given, "familyName": family, "id": node}
    fields = {k: F.when(is_url(c) if k == "url" else c != "", c) for k, c in given_fields.items() if c is not None}
    if org is not None:
        fields["affiliation"] = F.when(org != "", F.struct(org.alias("name"), F.lit("Organization").alias("type")))
    known = F.greatest(*[c.isNotNull() for c in fields.values()], F.lit(False))
    fields["type"] = F.lit("Person")
    return F.when(known, F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])))


def placed(prop: str, kind: str) -> Callable[[Column, Column], Column]:
    return lambda x, i: F.struct(F.lit(prop).alias("prop"), F.lit(kind).alias("kind"), i.cast("int").alias("pos"), x.alias("value"))


def values(rows: DataFrame, root: str = "SoftwareSourceCode", needs: Column | None = None, **props: tuple[str, Column]) -> DataFrame:
    """Property table from arrays: prop=(kind, array column); nulls and, for uri, non-URLs go.
    Every document gets a row for its type, ``root``; rows of :func:`json_files` without object, and
    those that don't meet ``needs``, give none."""
    # arrays are columns of their own first: under a lambda every use of a part would evaluate it again
    fine = (F.col("f").isNotNull() if "f" in rows.columns else F.lit(True)) & (F.lit(True) if needs is None else needs)
    held = rows.select("doc_id", fine.alias("fine"), *[F.coalesce(items, F.array().cast(STRINGS)).alias(f"of_{prop}") for prop, (_, items) in props.items()])
    out = [F.array(placed("type", "type")(F.lit(root), F.lit(0)))]
    for prop, (kind, _) in props.items():
        tidy = F.filter(f"of_{prop}", lambda x: x.isNotNull())
        if kind == "uri":
            tidy = F.filter(tidy, is_url)
        out.append(F.transform(tidy, placed(prop.replace("__", ":"), kind)))
    # an inner explode would have Spark make all arrays once more before, to test them
    each = held.select("doc_id", F.explode_outer(F.when(F.col("fine"), F.concat(*out))).alias("p"))
    return each.where("p is not null").select("doc_id", "p.*")


def rejected(files: DataFrame, translated: DataFrame) -> DataFrame:
    """Ids of files that gave no rows."""
    return files.select("doc_id").distinct().join(translated.select("doc_id").distinct(), "doc_id", "left_anti")


def named_person(text: Column) -> Column:
    """``Name <email> (url)`` as a Person node; the marks may be missing, in that order."""
    url = F.regexp_extract(text, r" \((.*)\) *$", 1)
    rest = F.regexp_replace(text, r" +\(.*\) *$", "")
    email = F.regexp_extract(rest, r" <(.*)> *$", 1)
    name = F.regexp_replace(rest, r" +<.*> *$", "")
    return person_json(F.trim(name), F.trim(email), F.trim(url))


TYPE_KEY = "@type of the document"


def by_rules(files: DataFrame, rules: DataFrame, root: str = "SoftwareSourceCode", hooks: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Property table of JSON files by a table of rules (key, term, kind), such as a crosswalk's
    with a kind for each key. Strings, and strings in lists, become values; other types and
    unknown keys are left out. ``hooks`` turn a key's variant into an array of strings first."""
    rows = parsed(files.select("doc_id", utf8().alias("t")), F.col("t"), "v").where(F.schema_of_variant("v").startswith("OBJECT"))
    own = F.struct(F.lit(TYPE_KEY).alias("key"), F.lit(None).cast("variant").alias("value"))
    entries = F.concat(F.map_entries(F.expr("try_variant_get(v, '$', 'map<string, variant>')")), F.array(own))
    pairs = rows.select("doc_id", F.explode(entries).alias("e")).select("doc_id", "e.key", F.col("e.value").alias("x"))
    told = F.when(F.col("key") == TYPE_KEY, F.array(F.lit(root))).otherwise(texts_of(F.col("x")))
    for key, hook in (hooks or {}).items():
        told = F.when(F.col("key") == key, hook(F.col("x"))).otherwise(told)
    every = rules.select("key", "term", "kind").unionByName(files.sparkSession.createDataFrame([(TYPE_KEY, "type", "type")], "key string, term string, kind string"))
    each = pairs.withColumn("items", told).join(F.broadcast(every), "key")  # as many rules as a vocabulary has keys
    found = each.select("doc_id", F.col("term").alias("prop"), "kind", F.posexplode("items").alias("pos", "value"))
    return found.where(F.col("value").isNotNull() & ((F.col("kind") != "uri") | is_url(F.col("value"))))


# -- npm ------------------------------------------------------------------------------------

SHORTCUTS = {"github": "github.com", "gitlab": "gitlab.com", "gist": "gist.github.com"}  # fixed values


def npm_repository() -> Column:
    kind, url = text_at("repository", "type"), text_at("repository", "url")
    plain = text_at("repository")
    host, rest = F.regexp_extract(plain, "^([a-z]+):(.*)$", 1), F.regexp_extract(plain, "^([a-z]+):(.*)$", 2)
    short = F.lit(None).cast("string")
    for prefix, site in SHORTCUTS.items():
        short = F.when(host == prefix, F.concat(F.lit(f"git+https://{site}/"), rest, F.lit(".git"))).otherwise(short)
    from_text = F.when(plain.contains("://"), plain).when(plain.contains(":"), short).when(plain.contains("/"), F.concat(F.lit("git+https://github.com/"), plain, F.lit(".git")))
    return F.coalesce(F.when(kind.isNotNull() & url.isNotNull(), F.concat(kind, F.lit("+"), url)), from_text)


def npm_licenses() -> Column:
    text = F.regexp_replace(text_at("license"), r"[()]", "")
    parts = F.transform(F.split(text, " OR "), lambda x: F.trim(x))
    good = ~text.startswith("SEE LICENSE IN") & ~F.exists(parts, lambda x: x.contains(" "))
    return F.when(good, F.transform(parts, spdx_uri))


def npm_description() -> Column:
    """UTF-16 that was read as UTF-8 starts with two replacement characters and has NULs."""
    text = text_at("description")
    broken = text.startswith("\ufffd\ufffd") & text.contains("\u0000")
    tail = F.substring(F.encode(text, "UTF-8"), 7, 2**31 - 1)
    even = F.when(F.octet_length(tail) % 2 == 0, tail).otherwise(F.substring(tail, F.lit(1), F.octet_length(tail) - 1))
    low = F.decode(even, "UTF-16LE")
    big = F.decode(even, "UTF-16BE")
    readable = lambda c: ~c.rlike("[\\x{0000}\\x{fffd}]")
    fixed = F.when(readable(low) & low.rlike("[ -~]"), low).when(readable(big) & big.rlike("[ -~]"), big)
    return F.when(broken, F.regexp_replace(fixed, "^# ", "")).otherwise(text)


def npm(files: DataFrame) -> DataFrame:
    rows = json_files(files, "name", "version", "description", "homepage", "repository", "bugs", "author", "license", "keywords")
    author = F.when(shape(item("author")) == "STRING", named_person(text_at("author"))).otherwise(person_json(text_at("author", "name"), text_at("author", "email"), text_at("author", "url")))
    return values(
        rows,
        name=("literal", as_array(text_at("name"))),
        version=("literal", as_array(text_at("version"))),
        description=("literal", as_array(npm_description())),
        url=("uri", as_array(text_at("homepage"))),
        codeRepository=("uri", as_array(npm_repository())),
        issueTracker=("uri", as_array(F.coalesce(text_at("bugs", "url"), text_at("bugs")))),
        author=("object", as_array(author)),
        license=("uri", npm_licenses()),
        keywords=("literal", texts_at("keywords")),
    )


def composer(files: DataFrame) -> DataFrame:
    rows = json_files(files, "name", "version", "description", "homepage", "keywords", "license", "authors")
    people = F.filter(F.try_variant_get(item("authors"), "$", "array<variant>"), lambda p: shape(p).startswith("OBJECT"))
    get = lambda p, k: text_of(F.try_variant_get(p, f"$.{k}", "variant"))
    return values(
        rows,
        name=("literal", as_array(text_at("name"))),
        version=("literal", as_array(text_at("version"))),
        description=("literal", as_array(text_at("description"))),
        url=("uri", as_array(text_at("homepage"))),
        keywords=("literal", texts_at("keywords")),
        license=("uri", F.transform(as_array(text_at("license")), spdx_uri)),
        author=("object", F.transform(people, lambda p: person_json(get(p, "name"), get(p, "email")))),
    )


def codemeta(files: DataFrame) -> DataFrame:
    """Documents of a known vocabulary context, property by property."""
    return expand(files.select("doc_id", utf8().alias("metadata")))


# -- XML ------------------------------------------------------------------------------------


def xml_files(files: DataFrame, schema: str, row: str) -> DataFrame:
    """Files whose outermost element is ``row``, with ``x``: the elements that ``schema`` names.
    Text is read in its declared character set; broken XML gives no row."""
    text = xml_text(F.col("data"))
    # explode keeps the steps apart: merged into one projection the text would be decoded for every field
    rows = files.select("doc_id", F.explode(F.array(text)).alias("t")).where(F.col("t").isNotNull() & has_root(F.col("t"), row))
    told = F.from_xml("t", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE", "rowTag": row})
    return rows.select("doc_id", F.explode(F.array(told)).alias("x")).where(F.col("x._corrupt").isNull())


POM = "groupId string, artifactId string, name string, version string, description string, repositories struct<repository: array<struct<url: string, layout: string>>>, licenses struct<license: array<struct<name: string, url: string>>>"
CENTRAL = "https://repo.maven.apache.org/maven2/"  # fixed value


def maven(files: DataFrame) -> DataFrame:
    rows = xml_files(files, POM, "project")
    path = F.concat(F.replace("x.groupId", F.lit("."), F.lit("/")), F.lit("/"), F.col("x.artifactId"))
    usual = F.filter("x.repositories.repository", lambda r: F.coalesce(r["layout"], F.lit("default")) == "default")
    urls = F.filter(F.transform(usual, lambda r: r["url"]), lambda u: u.isNotNull())
    bases = F.when(F.size(F.coalesce(urls, F.array().cast(STRINGS))) > 0, urls).otherwise(F.array(F.lit(CENTRAL)))
    places = F.transform(bases, lambda u: F.concat(F.rtrim(u, F.lit("/")), F.lit("/"), path))
    return values(
        rows,
        name=("literal", as_array(F.col("x.name"))),
        version=("literal", as_array(F.col("x.version"))),
        description=("literal", as_array(F.col("x.description"))),
        identifier=("literal", as_array(F.col("x.groupId"))),
        codeRepository=("uri", F.filter(places, lambda u: ~u.contains("${"))),
        license=("uri", F.transform("x.licenses.license", lambda n: n["url"])),
    )


NUSPEC = "metadata struct<id: string, version: string, description: string, summary: string, projectUrl: string, licenseUrl: string, copyright: string, language: string, releaseNotes: string, authors: string, tags: string, license: struct<_type: string, _VALUE: string>>"


def nuget(files: DataFrame) -> DataFrame:
    rows = xml_files(files, NUSPEC, "package")
    m = "x.metadata."
    text = F.col(f"{m}license._VALUE")
    good = (F.col(f"{m}license._type") == "expression") & ~F.lower(text).rlike(r" with | and |[()]")
    return values(
        rows,
        name=("literal", as_array(F.col(f"{m}id"))),
        version=("literal", as_array(F.col(f"{m}version"))),
        description=("literal", F.array(F.col(f"{m}description"), F.col(f"{m}summary"))),
        url=("uri", as_array(F.col(f"{m}projectUrl"))),
        license=("uri", F.concat(as_array(F.col(f"{m}licenseUrl")), F.coalesce(F.when(good, F.transform(F.split(text, "(?i) or "), lambda x: spdx_uri(F.trim(x)))), F.array().cast(STRINGS)))),
        schema__copyrightNotice=("literal", as_array(F.col(f"{m}copyright"))),
        schema__inLanguage=("literal", as_array(F.col(f"{m}language"))),
        releaseNotes=("literal", as_array(F.col(f"{m}releaseNotes"))),
        author=("object", F.transform(F.filter(F.transform(F.split(f"{m}authors", ","), lambda x: F.trim(x)), lambda x: x != ""), lambda x: person_json(x))),
        keywords=("literal", F.filter(F.split(f"{m}tags", " +"), lambda x: x != "")),
    )


# -- line-based formats ---------------------------------------------------------------------


def header_values(key: str) -> Column:
    """All values of a header, without UNKNOWN; folded lines lose their indent."""
    mine = F.filter("h", lambda x: F.lower(F.regexp_extract(x, r"^([^:\s]+)\s*:", 1)) == key)
    plain = F.transform(mine, lambda x: F.regexp_replace(F.regexp_replace(x, r"^[^:]*:\s?", ""), r"\n {8}", "\n"))
    return F.filter(plain, lambda x: (x != "UNKNOWN") & (F.trim(x) != ""))


def pkg_info(files: DataFrame) -> DataFrame:
    text = F.regexp_replace(utf8(), "\r\n", "\n")
    head = F.element_at(F.split(text, r"\n\n", 2), 1)
    rows = files.select("doc_id", F.split(head, r"\n(?=\S)").alias("h")).where("h is not null")
    first = lambda k: F.get(header_values(k), F.lit(0))
    # all names and addresses are of one person; several of a kind stay apart
    several = lambda a: F.when(F.size(a) == 1, quoted(F.get(a, F.lit(0)))).when(F.size(a) > 1, F.to_json(a))
    known = [F.concat(F.lit(f'"{k}":'), several(F.array_sort(F.array_distinct(header_values(h))))) for k, h in (("email", "author-email"), ("name", "author"))]
    body = F.array_join(F.array_compact(F.array(*known)), ",")
    one = F.when(body != "", F.concat(F.lit("{"), body, F.lit(',"type":"Person"}')))
    return values(
        rows,
        name=("literal", as_array(first("name"))),
        version=("literal", as_array(first("version"))),
        description=("literal", F.concat(header_values("summary"), header_values("description"))),
        url=("uri", header_values("home-page")),
        keywords=("literal", F.filter(F.flatten(F.transform(header_values("keywords"), lambda x: F.split(x, r"\s+"))), lambda x: x != "")),
        license=("uri", F.transform(header_values("license"), lambda x: F.when(~x.contains(" "), spdx_uri(x)))),
        author=("object", as_array(one)),
    )


def gemspec(files: DataFrame) -> DataFrame:
    rows = json_files(gemspec_to_json(files), "name", "version", "email", "summary", "description", "homepage", "license", "licenses", "author", "authors")
    listed = lambda key: F.when(shape(item(key)).startswith("ARRAY"), texts_at(key)).otherwise(F.array().cast(STRINGS))
    people = F.concat(as_array(text_at("author")), listed("authors"))
    return values(
        rows,
        name=("literal", texts_at("name")),
        version=("literal", texts_at("version")),
        email=("literal", texts_at("email")),
        description=("literal", F.concat(texts_at("summary"), texts_at("description"))),
        codeRepository=("uri", texts_at("homepage")),
        license=("uri", F.transform(F.concat(as_array(text_at("license")), listed("licenses")), spdx_uri)),
        author=("object", F.transform(people, lambda x: person_json(x))),
    )


# -- YAML -----------------------------------------------------------------------------------


def cff(files: DataFrame) -> DataFrame:
    keys = ("title", "abstract", "version", "keywords", "doi", "license", "date-released", "url", "repository-code", "authors")
    rows = json_files(yaml_to_json(files), *keys, "preferred-citation")
    cited = F.col("f.`preferred-citation`")
    inner = F.try_variant_get(cited, "$", "struct<" + ", ".join(f"`{k}`: variant" for k in keys) + ">")
    own = F.struct(*[F.col(f"f.`{k}`").alias(k) for k in keys])
    rows = rows.select("doc_id", F.when(F.schema_of_variant(cited).startswith("OBJECT"), inner).otherwise(F.when(F.col("f").isNotNull(), own)).alias("f"))
    people = F.filter(F.try_variant_get(item("authors"), "$", "array<variant>"), lambda p: shape(p).startswith("OBJECT"))
    get = lambda p, k: text_of(F.try_variant_get(p, f"$['{k}']", "variant"))
    node = lambda p: F.when(F.trim(get(p, "orcid")).rlike("^[a-z]+://[^/ ]+"), F.trim(get(p, "orcid")))
    return values(
        rows,
        name=("literal", as_array(text_at("title"))),
        description=("literal", as_array(text_at("abstract"))),
        version=("literal", as_array(text_at("version"))),
        keywords=("literal", texts_at("keywords")),
        identifier=("uri", F.transform(as_array(text_at("doi")), lambda d: F.concat(F.lit("https://doi.org/"), d))),
        license=("uri", F.transform(texts_at("license"), spdx_uri)),
        datePublished=("date", as_array(text_at("date-released"))),
        url=("uri", as_array(text_at("url"))),
        codeRepository=("uri", as_array(text_at("repository-code"))),
        author=("object", F.transform(people, lambda p: person_json(None, given=get(p, "given-names"), family=get(p, "family-names"), node=node(p), org=get(p, "affiliation")))),
    )


def pubspec(files: DataFrame) -> DataFrame:
    rows = json_files(yaml_to_json(files), "name", "description", "keywords", "repository", "issue_tracker", "homepage", "license", "author", "authors", "platforms")
    return values(
        rows,
        name=("literal", as_array(text_at("name"))),
        description=("literal", as_array(text_at("description"))),
        keywords=("literal", texts_at("keywords")),
        codeRepository=("uri", as_array(text_at("repository"))),
        issueTracker=("uri", as_array(text_at("issue_tracker"))),
        operatingSystem=("literal", texts_at("platforms")),
        url=("uri", as_array(text_at("homepage"))),
        license=("uri", F.transform(as_array(text_at("license")), spdx_uri)),
        author=("object", F.transform(F.concat(as_array(text_at("author")), texts_at("authors")), named_person)),
    )


# -- forges ---------------------------------------------------------------------------------


def counter(key: str, collection: str = "as:Collection") -> tuple[str, Column]:
    """A collection node of ``key`` items; the count is a typed value."""
    number = F.when(shape(item(key)) == "BIGINT", F.try_variant_get(item(key), "$", "string"))
    items = F.struct(number.alias("@value"), F.lit("xsd:nonNegativeInteger").alias("type"))
    node = F.to_json(F.struct(items.alias("as:totalItems"), F.lit(collection).alias("type")))
    return "object", as_array(F.when(number.isNotNull(), node))


def forge(files: DataFrame, name: str, site: str, stars: str, followers: str) -> DataFrame:
    rows = json_files(
        files, "html_url", "parent", "has_issues", "license", name, "description", site, "language", "topics", "clone_url", "created_at", "updated_at", "forks_count", stars, followers
    )
    node = lambda url: F.to_json(F.struct(url.alias("id")))
    parent = text_at("parent", "html_url")
    issues = F.when((shape(item("has_issues")) == "BOOLEAN") & F.try_variant_get(item("has_issues"), "$", "boolean"), F.concat(text_at("html_url"), F.lit("/issues")))
    return values(
        rows,
        "forge:Repository",
        text_at("html_url").isNotNull(),
        id=("uri", as_array(text_at("html_url"))),
        name=("literal", as_array(text_at(name))),
        description=("literal", as_array(text_at("description"))),
        url=("uri", as_array(text_at(site))),
        programmingLanguage=("literal", as_array(text_at("language"))),
        keywords=("literal", texts_at("topics")),
        codeRepository=("uri", as_array(text_at("clone_url"))),
        dateCreated=("date", as_array(text_at("created_at"))),
        dateModified=("date", as_array(text_at("updated_at"))),
        license=("uri", F.transform(as_array(text_at("license", "spdx_id")), spdx_uri)),
        issueTracker=("uri", as_array(issues)),
        forge__forkedFrom=("object", as_array(F.when(is_url(parent), node(parent)))),
        forge__forks=counter("forks_count", "as:OrderedCollection"),
        as__likes=counter(stars),
        as__followers=counter(followers),
    )


def github(files: DataFrame) -> DataFrame:
    return forge(files, "full_name", "homepage", "stargazers_count", "subscribers_count")


def gitea(files: DataFrame) -> DataFrame:
    return forge(files, "name", "website", "stars_count", "watchers_count")


# -- SWORD ----------------------------------------------------------------------------------

ATOM = "http://www.w3.org/2005/Atom"
VOCABULARY = "https://doi.org/10.5063/schema/codemeta-2.0"


def sword_leaves(files: DataFrame) -> DataFrame:
    """(doc_id, pos, space, name, value) of the entry's children: namespaces need a parser. A
    child with elements of its own becomes JSON text (kind object)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        from xml.etree import ElementTree

        def tag(e) -> tuple[str, str]:
            space, _, name = e.tag.rpartition("}")
            return space.removeprefix("{"), name

        def node(e):
            inner: dict = {}
            if not len(e) or (e.text or "").strip():
                return (e.text or "").strip()
            for c in e:
                inner.setdefault(tag(c)[1], []).append(node(c))
            return {k: v[0] if len(v) == 1 else v for k, v in sorted(inner.items())}

        for b in batches:
            rows = []
            for doc_id, data in zip(b["doc_id"].to_pylist(), b["data"].to_pylist()):
                try:
                    root = ElementTree.fromstring(data or b"")
                    told = [(child, node(child)) for child in root]
                    json.dumps([value for _, value in told])
                except (ElementTree.ParseError, ValueError, RecursionError):
                    continue
                for pos, (child, value) in enumerate(told):
                    rows.append((doc_id, pos, *tag(child), value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":")), not isinstance(value, str)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_())
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["doc_id", "pos", "space", "name", "value", "nested"])

    return files.select("doc_id", "data").mapInArrow(run, "doc_id string, pos int, space string, name string, value string, nested boolean")


def sword_props(leaves: DataFrame) -> DataFrame:
    from metalake.operators.props import DATE_TERMS, URI_TERMS

    ours = F.lower("space") == VOCABULARY
    atom = (F.col("space") == ATOM) & F.col("name").isin("title", "name", "author", "email")
    prop = F.when(ours, F.col("name")).when(atom, F.when(F.col("name") == "title", "name").otherwise(F.col("name"))).when(
        (F.col("space") == ATOM) & (F.col("name") == "id"), "id").when(F.col("space") != ATOM, F.concat("space", "name"))
    date = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
    padded = F.when(F.col("value").rlike(date), F.concat_ws("-", F.regexp_extract("value", date, 1), F.lpad(F.regexp_extract("value", date, 2), 2, "0"), F.lpad(F.regexp_extract("value", date, 3), 2, "0"))).otherwise(F.col("value"))
    kind = F.when(F.col("nested"), "object").when(F.col("prop").isin(DATE_TERMS), "date").when(F.col("prop").isin([*URI_TERMS, "id"]) & is_url(F.col("value")), "uri").otherwise("literal")
    rows = leaves.withColumn("prop", prop).where("prop is not null and value <> ''")
    first = rows.where("prop = 'id'").groupBy("doc_id").agg(F.min("pos").alias("pos"))
    rows = rows.where("prop <> 'id'").unionByName(rows.where("prop = 'id'").join(first, ["doc_id", "pos"], "left_semi"))
    person = F.when((F.col("prop") == "author") & (kind == "literal"), person_json(F.col("value")))
    return rows.select("doc_id", "prop", F.when(person.isNotNull(), "object").otherwise(kind).alias("kind"), "pos", F.coalesce(person, F.when(kind == "date", padded).otherwise(F.col("value"))).alias("value"))


def sword(files: DataFrame) -> DataFrame:
    return sword_props(sword_leaves(files))


def sword_json(files: DataFrame) -> DataFrame:
    """The older JSON form of deposits, keys as ``prefix:name``; a missing @xmlns is Atom."""
    rows = parsed(files.select("doc_id", utf8().alias("t")), F.col("t"), "v").where(F.schema_of_variant("v").startswith("OBJECT"))
    rows = rows.select("doc_id", F.expr("try_variant_get(v, '$', 'map<string, variant>')").alias("m"))
    space = F.coalesce(text_of(F.col("m")["@xmlns"]), F.lit(ATOM))
    prefix = F.coalesce(text_of(F.col("m")["@xmlns:codemeta"]), F.lit(VOCABULARY))
    rows = rows.where(space == ATOM).select("doc_id", prefix.alias("vocabulary"), F.explode("m").alias("key", "x")).where("not startswith(key, '@')")
    many = F.when(F.schema_of_variant("x").startswith("ARRAY"), F.expr("try_variant_get(x, '$', 'array<variant>')")).otherwise(F.array("x"))
    rows = rows.select("doc_id", "vocabulary", "key", F.posexplode(many).alias("pos", "x"))
    nested = F.schema_of_variant("x").startswith("OBJECT")
    leaves = rows.select(
        "doc_id", "pos", F.when(F.col("key").startswith("codemeta:"), F.col("vocabulary")).otherwise(F.lit(ATOM)).alias("space"),
        F.regexp_replace("key", "^codemeta:", "").alias("name"), F.when(nested, F.regexp_replace(F.to_json("x"), '"codemeta:', '"')).otherwise(F.expr("try_variant_get(x, '$', 'string')")).alias("value"), nested.alias("nested"),
    )
    return sword_props(leaves)


FORGE_TERMS = ("name", "description", "url", "programmingLanguage", "keywords", "codeRepository", "dateCreated", "dateModified", "license", "issueTracker", "forge:forkedFrom", "forge:forks", "as:likes", "as:followers")

#: name: (job, formats of forge records, terms that it can produce; mappings that pass documents
#: of the vocabulary on can produce every term)
BUILTIN: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...], tuple[str, ...]]] = {
    "cff": (cff, (), ("name", "description", "version", "keywords", "identifier", "license", "datePublished", "url", "codeRepository", "author")),
    "codemeta": (codemeta, (), tuple(TERMS)),
    "composer": (composer, (), ("name", "version", "description", "url", "keywords", "license", "author")),
    "gemspec": (gemspec, (), ("name", "version", "email", "description", "codeRepository", "license", "author")),
    "gitea": (gitea, ("gitea-repository-json", "gogs-repository-json"), FORGE_TERMS),
    "github": (github, ("application/vnd.github.v3+json",), FORGE_TERMS),
    "json-sword-codemeta": (sword_json, ("sword-v2-atom-codemeta-v2-in-json",), tuple(TERMS)),
    "maven": (maven, (), ("name", "version", "description", "identifier", "codeRepository", "license")),
    "npm": (npm, (), ("name", "version", "description", "url", "codeRepository", "issueTracker", "author", "license", "keywords")),
    "nuget": (nuget, (), ("name", "version", "description", "url", "license", "releaseNotes", "author", "keywords")),
    "pkg-info": (pkg_info, (), ("name", "version", "description", "url", "keywords", "license", "author")),
    "pubspec": (pubspec, (), ("name", "description", "keywords", "codeRepository", "issueTracker", "operatingSystem", "url", "license", "author")),
    "sword-codemeta": (sword, ("sword-v2-atom-codemeta", "sword-v2-atom-codemeta-v2"), tuple(TERMS)),
}
