"""Translation of package files and forge records, made from the rows of the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metalake.operators import formats, props
from metalake.plans import pipelines
from metalake.plans.lineage import spread
from metalake.sources.bridge import pick, read

from .register import Register

query = Register()


def text(template: str) -> Column:
    """Bytes of a template whose {column} parts are the row's values."""
    parts = []
    for k, piece in enumerate(template.replace("}", "{").split("{")):
        if piece:
            parts.append(F.col(piece).cast("string") if k % 2 else F.lit(piece.replace("[[", "{").replace("]]", "}")))
    return F.concat(*parts).cast("binary")


def rows_sql(source: str, doc_id: str, items: list[tuple[str, str, str]], where: str = "true", root: str | None = "SoftwareSourceCode") -> str:
    """(doc_id, prop, kind, value) of a table: every item's SQL value that isn't null, and the type."""
    items = [*items, ("type", "type", f"'{root}'")] if root else items
    structs = ", ".join(f"{{'prop': '{p}', 'kind': '{k}', 'value': ({v})::varchar}}" for p, k, v in items)
    return f"select doc_id, x.prop as prop, x.kind as kind, x.value as value from (select ({doc_id})::varchar as doc_id, unnest([{structs}]) as x from {source} where {where}) where x.value is not null"


def told(props_table):
    return props_table.select("doc_id", "prop", "kind", "value")


def parts(spark, sf_dir):
    return spread(read(spark, sf_dir, "part"), "p_partkey").withColumn("doc_id", F.col("p_partkey").cast("string")).withColumn("k", F.col("p_partkey") % 4)


def npm_files(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumns({
        "repository": pick(['[["type":"git","url":"https://git.example.org/', '"github:a/', '"https://x.org/', '"o/'], F.col("k")),
        "end": pick(['"]]', '"', '"', '"'], F.col("k")),
        "license": pick(['"MIT"', '"(MIT OR Apache-2.0)"', '"MIT AND ISC"', '"SEE LICENSE IN x"'], F.col("k")),
        "bugs": pick(['"https://b.org/1"', '[["url":"https://b.org/2"]]', '7', '"none"'], F.col("k")),
        "author": pick(['"Ann B <a@x.org> (https://a.org/)"', '[["name":"Bo","email":"b@x.org"]]', '"Cy"', '3'], F.col("k")),
        "size": pick(['"one"', "12", "null", '"four"'], F.col("k")),
    })
    for c in ("repository", "end", "bugs", "author"):
        rows = rows.withColumn(c, F.replace(F.replace(c, F.lit("[["), F.lit("{")), F.lit("]]"), F.lit("}")))
    # keys that come again later, in other shapes: the last counts
    body = text('[["name":"first","author":[["name":"first"]],"repository":"x/y","license":[1,2],"keywords":[["a":1]],"name":"{p_name}","version":"1.{p_size}","description":{size},"homepage":"https://h.org/{doc_id}","repository":{repository}{doc_id}{end},"bugs":{bugs},"author":{author},"license":{license},"keywords":["{p_brand}",5,"{p_type}"] ]]')
    broken = F.lit("{not json").cast("binary")
    return rows.select("doc_id", F.when(F.col("p_partkey") % 50 == 7, broken).otherwise(body).alias("data"))


NPM_ITEMS = [
    ("name", "literal", "p_name"), ("version", "literal", "'1.' || p_size"), ("description", "literal", "['one', null, null, 'four'][p_partkey % 4 + 1]"), ("url", "uri", "'https://h.org/' || p_partkey"),
    ("codeRepository", "uri", "['git+https://git.example.org/' || p_partkey, 'git+https://github.com/a/' || p_partkey || '.git', 'https://x.org/' || p_partkey, 'git+https://github.com/o/' || p_partkey || '.git'][p_partkey % 4 + 1]"),
    ("issueTracker", "uri", "['https://b.org/1', 'https://b.org/2', null, null][p_partkey % 4 + 1]"),
    ("author", "object", """['{"email":"a@x.org","name":"Ann B","type":"Person","url":"https://a.org/"}', '{"email":"b@x.org","name":"Bo","type":"Person"}', '{"name":"Cy","type":"Person"}', null][p_partkey % 4 + 1]"""),
    ("license", "uri", "case when p_partkey % 4 <= 1 then 'https://spdx.org/licenses/MIT' end"), ("license", "uri", "case when p_partkey % 4 = 1 then 'https://spdx.org/licenses/Apache-2.0' end"),
    ("keywords", "literal", "p_brand"), ("keywords", "literal", "p_type"),
]


@query(rows_sql("part", "p_partkey", NPM_ITEMS, "p_partkey % 50 <> 7"))
def npm_translate(spark, sf_dir):
    return told(formats.npm(npm_files(spark, sf_dir)))


@query("select p_partkey::varchar as doc_id from part where p_partkey % 50 = 7")
def npm_rejected(spark, sf_dir):
    files = npm_files(spark, sf_dir)
    return formats.rejected(files, formats.npm(files))


@query("""select p_partkey::varchar as id, 1 as tool_id, '{"@context":"https://doi.org/10.5063/schema/codemeta-2.0","type":"SoftwareSourceCode","description":"' || p_brand || '","keywords":' ||
    case when p_brand = p_type then '"' || p_brand || '"' when p_brand < p_type then '["' || p_brand || '","' || p_type || '"]' else '["' || p_type || '","' || p_brand || '"]' end ||
    ',"license":"https://spdx.org/licenses/MIT","name":"' || p_name || '"}' as metadata from part""")
def content_metadata(spark, sf_dir):
    body = text('[["name":"{p_name}","description":"{p_brand}","license":"MIT","keywords":["{p_type}","{p_brand}"] ]]')
    return pipelines.content_metadata(parts(spark, sf_dir).select("doc_id", body.alias("data")), "npm")


@query(rows_sql("part", "p_partkey", [
    ("name", "literal", "p_name"), ("version", "literal", "'2.' || p_size"), ("description", "literal", "p_type"), ("url", "uri", "case when p_partkey % 2 = 0 then 'https://h.org/' || p_partkey end"),
    ("keywords", "literal", "p_brand"), ("keywords", "literal", "'php'"), ("license", "uri", "'https://spdx.org/licenses/GPL-3.0'"),
    ("author", "object", """'{"email":"a@x.org","name":"' || p_name || '","type":"Person"}'"""), ("author", "object", """'{"name":"Z","type":"Person"}'""")]))
def composer_translate(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("home", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("https://h.org/"), "doc_id")).otherwise("no url"))
    body = text('[["authors":[],"name":[1],"name":"{p_name}","version":"2.{p_size}","description":"{p_type}","homepage":"{home}","keywords":["{p_brand}","php"],"license":"GPL-3.0","authors":[ [["name":"{p_name}","email":"a@x.org"]],[["name":"Z"]] ] ]]')
    return told(formats.composer(rows.select("doc_id", body.alias("data"))))


@query(rows_sql("part", "p_partkey", [
    ("name", "literal", "p_name"), ("version", "literal", "'1.0.' || p_size"), ("description", "literal", "p_type || case when p_partkey % 4 = 2 then ' \u00e9' else '' end"), ("identifier", "literal", "'org.example.' || lower(p_type)"),
    ("codeRepository", "uri", "case p_partkey % 4 when 0 then 'https://repo.maven.apache.org/maven2/org/example/' || lower(p_type) || '/a' || p_partkey when 1 then 'https://r.org/m2/org/example/' || lower(p_type) || '/a' || p_partkey end"),
    ("license", "uri", "'https://l.org/' || p_size"), ("license", "uri", "case when p_partkey % 4 = 1 then 'https://l.org/two' end")], "p_partkey % 40 not in (3, 5)"))
def maven_translate(spark, sf_dir):
    """Some in ISO-8859-1, some not well formed, some with a project below another root."""
    repositories = pick(["", "<repositories><repository><id>r</id><url>https://r.org/m2/</url><layout>default</layout></repository></repositories>",
        "<repositories><repository><url>${repo.url}</url></repository></repositories>", "<repositories><repository><url>no url</url></repository></repositories>"], F.col("k"))
    rows = parts(spark, sf_dir).withColumns({"low": F.lower("p_type"), "repositories": repositories, "more": F.when(F.col("k") == 1, "<license><name>n</name><url>https://l.org/two</url></license>").otherwise("")})
    rows = rows.withColumns({"charset": F.when(F.col("k") == 2, "ISO-8859-1").otherwise("utf-8"), "accent": F.when(F.col("k") == 2, " \u00e9").otherwise("")})
    body = text('<?xml version="1.0" encoding="{charset}"?>\n<!-- made -->\n<project xmlns="http://maven.apache.org/POM/4.0.0"><groupId>org.example.{low}</groupId><artifactId>a{doc_id}</artifactId><name>{p_name}</name><version>1.0.{p_size}</version><description>{p_type}{accent}</description>{repositories}<licenses><license><name>n</name><url>https://l.org/{p_size}</url></license>{more}</licenses></project>')
    broken = F.lit("<project><name>x</project>").cast("binary")
    below = F.lit("<foo><project><name>x</name></project></foo>").cast("binary")
    data = F.when(F.col("p_partkey") % 40 == 3, broken).when(F.col("p_partkey") % 40 == 5, below).when(F.col("k") == 2, F.encode(body.cast("string"), "ISO-8859-1")).otherwise(body)
    return told(formats.maven(rows.select("doc_id", data.alias("data"))))


@query(rows_sql("part", "p_partkey", [
    ("name", "literal", "'N' || p_partkey"), ("version", "literal", "'3.' || p_size"), ("description", "literal", "p_name"), ("description", "literal", "p_type"), ("url", "uri", "'https://p.org/' || p_partkey"),
    ("license", "uri", "case when p_partkey % 4 <> 2 then 'https://spdx.org/licenses/MIT' end"), ("license", "uri", "case when p_partkey % 4 = 1 then 'https://spdx.org/licenses/BSD-2-Clause' end"),
    ("schema:copyrightNotice", "literal", "'\u00a9 ' || p_brand"), ("schema:inLanguage", "literal", "'en'"), ("releaseNotes", "literal", "'notes ' || p_size"),
    ("author", "object", """'{"name":"' || p_brand || '","type":"Person"}'"""), ("author", "object", """'{"name":"Eve","type":"Person"}'"""), ("keywords", "literal", "p_type"), ("keywords", "literal", "'tag'")]))
def nuget_translate(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("license", pick(["MIT", "MIT OR BSD-2-Clause", "MIT AND ISC", "MIT"], F.col("k")))
    body = text('<package xmlns="http://schemas.microsoft.com/packaging/2013/05/nuspec.xsd"><metadata><id>N{doc_id}</id><version>3.{p_size}</version><description>{p_name}</description><summary>{p_type}</summary><projectUrl>https://p.org/{doc_id}</projectUrl><license type="expression">{license}</license><copyright>\u00a9 {p_brand}</copyright><language>en</language><releaseNotes>notes {p_size}</releaseNotes><authors>{p_brand}, Eve</authors><tags>{p_type} tag</tags></metadata></package>')
    wide = F.concat(F.unhex(F.lit("FFFE")), F.encode(body.cast("string"), "UTF-16LE"))
    return told(formats.nuget(rows.select("doc_id", F.when(F.col("k") == 3, wide).otherwise(body).alias("data"))))


def customers(spark, sf_dir):
    return spread(read(spark, sf_dir, "customer"), "c_custkey").withColumn("doc_id", F.col("c_custkey").cast("string")).withColumn("balance", F.round("c_acctbal").cast("long"))


@query(rows_sql("customer", "c_custkey", [
    ("name", "literal", "'pkg-' || c_custkey"), ("version", "literal", "'0.' || c_nationkey"), ("description", "literal", "c_mktsegment"), ("description", "literal", "c_name || chr(10) || 'more of ' || c_name"),
    ("url", "uri", "case when c_custkey % 3 > 0 then 'https://c.org/' || c_custkey end"), ("keywords", "literal", "lower(c_mktsegment)"), ("keywords", "literal", "'py'"), ("license", "uri", "'https://spdx.org/licenses/MIT'"),
    ("author", "object", """'{"email":"c' || c_custkey || '@x.org","name":' || case when c_custkey % 4 = 1 then '["' || c_name || '","Zed"]' else '"' || c_name || '"' end || ',"type":"Person"}'""")]))
def pkg_info_translate(spark, sf_dir):
    rows = customers(spark, sf_dir).withColumns({"home": F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("https://c.org/"), "doc_id")).otherwise("UNKNOWN"), "low": F.lower("c_mktsegment"), "second": F.when(F.col("c_custkey") % 4 == 1, "Author: Zed\n").otherwise("")})
    body = text("Metadata-Version: 1.1\nName: pkg-{doc_id}\nVersion: 0.{c_nationkey}\nSummary: {c_mktsegment}\nHome-page: {home}\nAuthor: {c_name}\n{second}Author-email: c{doc_id}@x.org\nLicense: MIT\nDescription: {c_name}\n        more of {c_name}\nKeywords: {low} py\nPlatform: UNKNOWN\n\nName: body\n")
    return told(formats.pkg_info(rows.select("doc_id", body.alias("data"))))


@query(rows_sql("customer", "c_custkey", [
    ("name", "literal", "'gem' || c_custkey"), ("version", "literal", "case when c_custkey % 3 > 0 then '1.' || c_nationkey end"), ("description", "literal", """'say "' || c_mktsegment || '"'"""), ("description", "literal", "c_name"),
    ("codeRepository", "uri", "'https://g.org/' || c_custkey"), ("license", "uri", "'https://spdx.org/licenses/MIT'"), ("license", "uri", "case when c_custkey % 2 = 0 then 'https://spdx.org/licenses/Ruby' end"),
    ("author", "object", """'{"name":"' || c_name || '","type":"Person"}'"""), ("author", "object", """'{"name":"Yu","type":"Person"}'""")]))
def gemspec_translate(spark, sf_dir):
    rows = customers(spark, sf_dir).withColumns({
        "version": F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("'1."), F.col("c_nationkey").cast("string"), F.lit("'.freeze"))).otherwise("Gem::VERSION"),
        "licenses": F.when(F.col("c_custkey") % 2 == 0, 's.licenses = ["MIT", "Ruby"]').otherwise('s.license = "MIT"')})
    body = text('require "x"\nGem::Specification.new do |s|\n  s.name = "old"\n  s.name = "gem{doc_id}"\n  s.version = {version}\n  s.summary = "say \\"{c_mktsegment}\\"" # not a "value"\n  s.name = NAME\n  s.description = "{c_name}"\n  s.homepage = "https://g.org/{doc_id}"\n  {licenses}\n  s.authors = ["{c_name}", \'Yu\']\n  s.files = Dir["lib"]\nend\n')
    return told(formats.gemspec(rows.select("doc_id", body.alias("data"))))


@query(rows_sql("customer", "c_custkey", [
    ("name", "literal", "'T ' || c_name"), ("description", "literal", "case when c_custkey % 5 = 1 then repeat('[', 450) when c_custkey % 6 <> 1 then c_mktsegment end"), ("version", "literal", "case when c_custkey % 2 = 0 then c_nationkey::varchar end"), ("keywords", "literal", "'one'"), ("keywords", "literal", "lower(c_mktsegment)"),
    ("identifier", "uri", "'https://doi.org/10.1/' || c_custkey"), ("license", "uri", "'https://spdx.org/licenses/Apache-2.0'"), ("datePublished", "date", "'2024-01-02'"), ("codeRepository", "uri", "'https://c.org/' || c_custkey"),
    ("author", "object", """'{"affiliation":{"name":"Inst","type":"Organization"},"familyName":"' || c_name || '","givenName":"Al","id":"https://orcid.org/1","type":"Person"}'"""), ("author", "object", """'{"familyName":"Solo","type":"Person"}'""")], "c_custkey % 30 <> 4"))
def cff_translate(spark, sf_dir):
    """Numbers, true and null are no texts; brackets in a text are no nesting; an alias bomb is refused."""
    key = F.col("c_custkey")
    rows = customers(spark, sf_dir).withColumns({
        "low": F.lower("c_mktsegment"), "version": F.when(key % 2 == 0, F.concat(F.lit("'"), F.col("c_nationkey").cast("string"), F.lit("'"))).otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(".5"))),
        "abstract": F.when(key % 5 == 1, F.concat(F.lit('"'), F.repeat(F.lit("["), 450), F.lit('"'))).when(key % 6 == 1, "null").otherwise(F.col("c_mktsegment")),
    })
    bomb = "title: x\na: &a [1,1,1,1,1,1,1,1,1]\n" + "".join(f"{y}: &{y} [{','.join(['*' + x] * 9)}]\n" for x, y in zip("abcdefg", "bcdefgh"))
    body = text("cff-version: 1.2.0\ntitle: T {c_name}\nabstract: {abstract}\nversion: {version}\nkeywords:\n  - one\n  - true\n  - {low}\ndoi: 10.1/{doc_id}\nlicense: Apache-2.0\ndate-released: 2024-01-02\nrepository-code: https://c.org/{doc_id}\nauthors:\n  - family-names: '{c_name}'\n    given-names: Al\n    affiliation: Inst\n    orcid: ' https://orcid.org/1 '\n  - family-names: Solo\n")
    return told(formats.cff(rows.select("doc_id", F.when(key % 60 == 4, F.lit("- a\n- b\n").cast("binary")).when(key % 60 == 34, F.lit(bomb).cast("binary")).otherwise(body).alias("data"))))


@query(rows_sql("customer", "c_custkey", [
    ("name", "literal", "'dart' || c_custkey"), ("description", "literal", "c_mktsegment"), ("codeRepository", "uri", "'https://d.org/' || c_custkey"), ("url", "uri", "case when c_custkey % 2 = 0 then 'https://home.org/' end"),
    ("license", "uri", "'https://spdx.org/licenses/BSD-3-Clause'"), ("author", "object", """'{"email":"m@x.org","name":"' || c_name || '","type":"Person"}'""")]))
def pubspec_translate(spark, sf_dir):
    rows = customers(spark, sf_dir).withColumn("home", F.when(F.col("c_custkey") % 2 == 0, "https://home.org/").otherwise("none"))
    body = text("name: dart{doc_id}\ndescription: {c_mktsegment}\nversion: 1.0.0\nrepository: https://d.org/{doc_id}\nhomepage: {home}\nlicense: BSD-3-Clause\nauthor: {c_name} <m@x.org>\n")
    return told(formats.pubspec(rows.select("doc_id", body.alias("data"))))


FORGE_ITEMS = [
    ("id", "uri", "'https://f.org/' || c_custkey"), ("name", "literal", "c_name"), ("description", "literal", "c_mktsegment"), ("programmingLanguage", "literal", "n_name"), ("keywords", "literal", "'t1'"), ("keywords", "literal", "'t2'"),
    ("codeRepository", "uri", "'https://f.org/' || c_custkey || '.git'"), ("dateCreated", "date", "'2020-01-01T00:00:00Z'"), ("dateModified", "date", "'2021-01-01T00:00:00Z'"), ("license", "uri", "'https://spdx.org/licenses/MIT'"),
    ("issueTracker", "uri", "case when c_custkey % 2 = 0 then 'https://f.org/' || c_custkey || '/issues' end"), ("forge:forks", "object", """'{"as:totalItems":{"@value":"' || n_orders || '","type":"xsd:nonNegativeInteger"},"type":"as:OrderedCollection"}'"""),
    ("as:likes", "object", """'{"as:totalItems":{"@value":"' || c_nationkey || '","type":"xsd:nonNegativeInteger"},"type":"as:Collection"}'"""),
]
FORGE_SQL = "(select customer.*, n_name, count(o_orderkey) as n_orders from customer join nation on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by all)"


def forge_files(spark, sf_dir, names: dict[str, str]):
    orders = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = customers(spark, sf_dir).join(orders, "c_custkey", "left").join(F.broadcast(nations), "c_nationkey").withColumn("n_orders", F.coalesce("n", F.lit(0)))
    rows = rows.withColumn("issues", F.when(F.col("c_custkey") % 2 == 0, "true").otherwise("false"))
    body = text('[["forks_count":"many","license":"MIT","topics":7,"html_url":"https://f.org/{doc_id}","%s":"{c_name}","description":"{c_mktsegment}","language":"{n_name}","topics":["t1","t2"],"clone_url":"https://f.org/{doc_id}.git","created_at":"2020-01-01T00:00:00Z","updated_at":"2021-01-01T00:00:00Z","license":[["spdx_id":"MIT"]],"has_issues":{issues},"parent":[["html_url":"https://up.org/{c_nationkey}"]],"forks_count":{n_orders},"%s":{c_nationkey},"%s":"many"]]' % (names["name"], names["stars"], names["followers"]))
    return rows.select("doc_id", body.alias("data"), "c_custkey", "c_name")


@query(rows_sql(FORGE_SQL, "c_custkey", [*FORGE_ITEMS, ("forge:forkedFrom", "object", """'{"id":"https://up.org/' || c_nationkey || '"}'""")], root="forge:Repository"))
def github_translate(spark, sf_dir):
    return told(formats.github(forge_files(spark, sf_dir, {"name": "full_name", "stars": "stargazers_count", "followers": "subscribers_count"})))


@query(rows_sql(FORGE_SQL, "c_custkey", [*FORGE_ITEMS, ("forge:forkedFrom", "object", """'{"id":"https://up.org/' || c_nationkey || '"}'""")], root="forge:Repository"))
def gitea_translate(spark, sf_dir):
    return told(formats.gitea(forge_files(spark, sf_dir, {"name": "name", "stars": "stars_count", "followers": "watchers_count"})))


SWORD_ITEMS = [
    ("name", "literal", "c_name"), ("id", "uri", "'https://id.org/' || c_custkey"), ("author", "object", """'{"name":"' || c_name || '","type":"Person"}'"""),
    ("datePublished", "date", "'2024-03-0' || (c_custkey % 9 + 1)"), ("version", "literal", "c_nationkey::varchar"), ("license", "object", """'{"name":"' || c_mktsegment || '"}'"""),
]


@query(rows_sql("customer", "c_custkey", SWORD_ITEMS, root=None))
def sword_translate(spark, sf_dir):
    rows = customers(spark, sf_dir).withColumn("day", F.col("c_custkey") % 9 + 1)
    body = text('<?xml version="1.0"?><entry xmlns="http://www.w3.org/2005/Atom" xmlns:codemeta="https://doi.org/10.5063/SCHEMA/CODEMETA-2.0"><title>{c_name}</title><id>https://id.org/{doc_id}</id><id>https://second.org/</id><updated>x</updated><codemeta:author>{c_name}</codemeta:author><codemeta:datePublished>2024-3-{day}</codemeta:datePublished><codemeta:version>{c_nationkey}</codemeta:version><codemeta:license><codemeta:name>{c_mktsegment}</codemeta:name></codemeta:license></entry>')
    return told(formats.sword(rows.select("doc_id", body.alias("data"))))


@query(rows_sql("customer", "c_custkey", SWORD_ITEMS, root=None))
def sword_json_translate(spark, sf_dir):
    rows = customers(spark, sf_dir).withColumn("day", F.col("c_custkey") % 9 + 1)
    body = text('[["title":"{c_name}","id":"https://id.org/{doc_id}","codemeta:author":"{c_name}","codemeta:datePublished":"2024-3-{day}","codemeta:version":"{c_nationkey}","codemeta:license":[["codemeta:name":"{c_mktsegment}"]]]]')
    return told(formats.sword_json(rows.select("doc_id", body.alias("data"))))


@query(rows_sql("part", "p_partkey", [("id", "uri", "'https://id.org/' || p_partkey"), ("name", "literal", "p_name"), ("version", "number", "p_size"), ("license", "uri", "'https://l.org/'"), ("identifier", "literal", "p_brand"),
    ("dateCreated", "date", "'2020-01-01'"), ("keywords", "literal", "p_type"), ("keywords", "literal", "'k'"), ("url", "uri", "'https://u.org/'"), ("author", "object", """'{"id":"https://o.org/1","name":"' || p_brand || '","type":"Person"}'""")], "p_partkey % 4 <> 3"))
def codemeta_translate(spark, sf_dir):
    contexts = [f'"{props.CONTEXT}/"', '["HTTPS://w3id.org/codemeta/3.0/","https://schema.org/"]', '["http://purl.org/codemeta/2.0",[["x":"https://x.org/"]]]', '["http://purl.org/codemeta/2.0","https://other.org/"]']
    context = F.replace(F.replace(pick(contexts, F.col("k")), F.lit("[["), F.lit("{")), F.lit("]]]"), F.lit("}]"))
    body = text('[["name":[["first":1]],"@context":{context},"@type":"SoftwareSourceCode","@id":"https://id.org/{doc_id}","name":"{p_name}","version":{p_size},"license":[["@id":"https://l.org/"]],"schema:identifier":"{p_brand}","dateCreated":"2020-01-01","keywords":["{p_type}","k"],"url":"https://u.org/","author":[["@list":[ [["@type":"Person","@id":"https://o.org/1","name":"{p_brand}"]] ] ]] ]]')
    return told(formats.codemeta(parts(spark, sf_dir).withColumn("context", context).select("doc_id", body.alias("data"))))


@query("""select p_partkey::varchar as doc_id, '{"@context":"https://doi.org/10.5063/schema/codemeta-2.0",' ||
    '"license":"https://l.org/","name":"' || p_name || '","schema:identifier":"' || p_brand || '","version":' || p_size || '}' as metadata from part""")
def compact_documents(spark, sf_dir):
    body = text('[["@context":"http://purl.org/codemeta/2.0","version":{p_size},"name":"{p_name}","license":"https://l.org/","schema:identifier":"{p_brand}"]]')
    return props.compact(formats.codemeta(parts(spark, sf_dir).select("doc_id", body.alias("data"))))


@query("""select p_partkey::varchar as doc_id, x.prop, x.kind, x.value from (select p_partkey, unnest([{'prop': 'type', 'kind': 'type', 'value': 'SoftwareSourceCode'}, {'prop': 'name', 'kind': 'literal', 'value': p_name},
      {'prop': 'license', 'kind': 'uri', 'value': case when p_partkey % 2 = 0 then 'https://l.org/' || p_size end}, {'prop': 'keywords', 'kind': 'literal', 'value': lower(p_brand)}, {'prop': 'keywords', 'kind': 'literal', 'value': 'k'}]) as x from part) where x.value is not null""")
def rule_translate(spark, sf_dir):
    """Files of a format that only a table of rules knows, with a hook for one of its keys."""
    rules = spark.createDataFrame([("title", "name", "literal"), ("licence", "license", "uri"), ("tags", "keywords", "literal")], "key string, term string, kind string")
    body = text('[["title":"old","title":"{p_name}","licence":"{site}{p_size}","tags":"{p_brand} K","other":[1] ]]')
    rows = parts(spark, sf_dir).withColumn("site", F.when(F.col("p_partkey") % 2 == 0, "https://l.org/").otherwise("l "))
    hooks = {"tags": lambda x: F.split(F.lower(formats.text_of(x)), " ")}
    return told(formats.by_rules(rows.select("doc_id", body.alias("data")), rules, hooks=hooks))


def remd(spark, sf_dir):
    """Forge records: each customer's repository, seen at most twice, by the forge or by another
    site. Every fifth describes a directory of its origin, whose URL is percent-encoded (and
    broken for every thirteenth)."""
    files = forge_files(spark, sf_dir, {"name": "full_name", "stars": "stargazers_count", "followers": "subscribers_count"})
    again = F.explode(F.array(F.lit(1), F.lit(2)))
    rows = files.withColumn("seen", again).where("seen = 1 or c_custkey % 3 = 0")
    url = F.concat(F.lit("https://f.org/"), F.col("doc_id"))
    old = F.col("c_custkey") % 5 == 0
    quoted = F.concat(F.replace(url, F.lit(":"), F.lit("%3A")), F.when(F.col("c_custkey") % 13 == 0, "%zz").otherwise(""))
    return rows.select(
        F.concat_ws("/", "doc_id", "seen").alias("id"), F.when(old, "directory").otherwise("origin").alias("target_type"), F.when(~old, F.sha1(url.cast("binary"))).alias("target_id"),
        F.when(old, quoted).alias("origin"), F.to_timestamp(F.concat(F.lit("2024-0"), F.col("seen").cast("string"), F.lit("-01"))).alias("discovery_date"),
        F.struct(F.lit("forge").alias("type"), F.when(F.col("c_custkey") % 7 == 0, "https://elsewhere.org/").otherwise("https://f.org/").alias("url")).alias("authority"),
        F.struct(F.when(old, pipelines.QUOTED_FETCHER).otherwise("lister").alias("name"), F.lit("1").alias("version")).alias("fetcher"),
        F.when(F.col("c_custkey") % 11 == 0, "unknown").otherwise("application/vnd.github.v3+json").alias("format"), F.col("data").alias("metadata"),
    )


def known_forge_origins(spark, sf_dir):
    return customers(spark, sf_dir).where("c_custkey % 13 <> 0").select(F.concat(F.lit("https://f.org/"), "doc_id").alias("url"))


SQL_EXTRINSIC = f"""select 'https://f.org/' || c_custkey as id, c_custkey || '/' || case when c_custkey % 3 = 0 then 2 else 1 end as from_remd_id, ['github'] as mappings,
    '{{"@context":"https://doi.org/10.5063/schema/codemeta-2.0","type":"https://forgefed.org/ns#Repository","codeRepository":"https://f.org/' || c_custkey || '.git","dateCreated":"2020-01-01T00:00:00Z","dateModified":"2021-01-01T00:00:00Z","description":"' || c_mktsegment ||
    '","https://forgefed.org/ns#forkedFrom":{{"id":"https://up.org/' || c_nationkey || '"}},"https://forgefed.org/ns#forks":{{"https://www.w3.org/ns/activitystreams#totalItems":{{"@value":"' || n_orders ||
    '","type":"http://www.w3.org/2001/XMLSchema#nonNegativeInteger"}},"type":"https://www.w3.org/ns/activitystreams#OrderedCollection"}},"https://www.w3.org/ns/activitystreams#likes":{{"https://www.w3.org/ns/activitystreams#totalItems":{{"@value":"' || c_nationkey ||
    '","type":"http://www.w3.org/2001/XMLSchema#nonNegativeInteger"}},"type":"https://www.w3.org/ns/activitystreams#Collection"}},"id":"https://f.org/' || c_custkey || '",' || case when c_custkey % 2 = 0 then '"issueTracker":"https://f.org/' || c_custkey || '/issues",' else '' end ||
    '"keywords":["t1","t2"],"license":"https://spdx.org/licenses/MIT","name":"' || c_name || '","programmingLanguage":"' || n_name || '"}}' as metadata
    from {FORGE_SQL} where c_custkey % 7 <> 0 and c_custkey % 11 <> 0 and c_custkey % 13 <> 0"""


@query(SQL_EXTRINSIC)
def origin_extrinsic_metadata(spark, sf_dir):
    return pipelines.origin_extrinsic_metadata(remd(spark, sf_dir), known_forge_origins(spark, sf_dir))


@query("""select sha1(case when c_custkey % 5 = 0 then 'https%3A//f.org/' || c_custkey || '%zz' else 'https://f.org/' || c_custkey end) as target, count(*) as n
    from customer, (values (1), (2)) as s(seen) where c_custkey % 13 = 0 and c_custkey % 11 <> 0 and (seen = 1 or c_custkey % 3 = 0) group by 1""")
def unresolved_records(spark, sf_dir):
    records = remd(spark, sf_dir).where("format <> 'unknown'")
    _, lost = pipelines.resolve_targets(records, known_forge_origins(spark, sf_dir))
    return lost.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


QUERIES, ORACLES = query.queries, query.oracles
