"""Citations of documents made from customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from metalake.operators import citation
from metalake.sources.bridge import pick

from .formats import customers, text
from .register import Register

query = Register()


def documents(spark, sf_dir):
    """(doc_id, metadata, swhid): every tenth customer's document has an unknown context, another
    tenth is the only node of a graph; people stand alone, in nested Roles, two in a Role, and
    under prefixed names."""
    rows = customers(spark, sf_dir).withColumns({
        "context": F.when(F.col("c_custkey") % 10 == 9, "https://other.org/").otherwise("https://doi.org/10.5063/schema/codemeta-2.0"),
        "author": pick(['[["type":"Person","name":"Ann Bee"]]', '[["type":"Role","author":[["type":"Role","author":[["type":"Role","author":[["type":"Role","author":[["type":"Person","givenName":"Cy","familyName":"Dee","affiliation":[["name":"Inst"]] ]] ]] ]] ]] ]]', '[["type":"Organization","name":"Team"]]',
            '[["type":"Role","schema:author":[["name":"Jane Doe","id":"https://orcid.org/0000-0002-0000-000X"]] ]]', '[["type":"Role","author":[ [["name":"Ann Bee"]],[["name":"Bob Cee","affiliation":"Works"]] ] ]]',
            '[["type":"Person","schema:name":"Eve Fox","http://schema.org/affiliation":[["type":"Organization","schema:name":"Lab"]] ]]'], F.col("c_custkey") % 6),
        "open": F.when(F.col("c_custkey") % 10 == 8, '"@graph":[{').otherwise(""), "close": F.when(F.col("c_custkey") % 10 == 8, "}]").otherwise(""),
        "date": pick(["2024-02-03", "soon"], F.col("c_custkey") % 2),
        "title": F.when(F.col("c_custkey") % 9 == 0, 'say \\"hi\\" & {x').otherwise(F.col("c_name")),
    })
    rows = rows.withColumn("author", F.replace(F.replace("author", F.lit("[["), F.lit("{")), F.lit("]]"), F.lit("}")))
    body = text('[["@context":"{context}",{open}"type":"SoftwareSourceCode","name":"{title}","version":"{c_nationkey}","author":{author},"datePublished":"{date}","license":"https://spdx.org/licenses/MIT","codeRepository":"https://c.org/{doc_id}","identifier":"https://doi.org/10.1/{doc_id}"{close}]]')
    swhid = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("swh:1:rev:"), F.sha1(F.col("doc_id").cast("binary"))))
    return rows.select("doc_id", body.cast("string").alias("metadata"), swhid.alias("swhid"))


TITLE = """case when c_custkey % 9 = 0 then 'say "hi" & {x' else c_name end"""
NAME = "['Bee, Ann', 'Dee, Cy', '{Team}', 'Doe, Jane', 'Bee, Ann and Cee, Bob', 'Fox, Eve'][c_custkey % 6 + 1]"
PLACES = "[null, 'Inst', null, null, 'Works', 'Lab'][c_custkey % 6 + 1]"


@query(f"""select c_custkey::varchar as doc_id, {TITLE} as name, c_nationkey::varchar as version, 'https://c.org/' || c_custkey as repository, ['MIT'] as licenses,
    string_split(['Ann Bee', 'Cy Dee', 'Team', 'Jane Doe', 'Ann Bee;Bob Cee', 'Eve Fox'][c_custkey % 6 + 1], ';') as people, case when {PLACES} is null then []::varchar[] else [{PLACES}] end as affiliations,
    ['https://doi.org/10.1/' || c_custkey, c_custkey::varchar] as identifiers from customer where c_custkey % 10 <> 9""")
def citation_facts(spark, sf_dir):
    rows = citation.facts(documents(spark, sf_dir))
    return rows.select("doc_id", "name", "version", F.col("codeRepository").alias("repository"), "licenses", F.transform("authors", lambda p: p["name"]).alias("people"), "affiliations", "identifiers")


@query(rf"""select c_custkey::varchar as doc_id, case when c_custkey % 10 = 9 then 'not a document of a known vocabulary' end as error, case when c_custkey % 10 <> 9 then
    '@softwareversion{{' || c_custkey || ',' || chr(10) || '    author = "' || {NAME} || '",' || chr(10) || coalesce('    organization = "' || {PLACES} || '",' || chr(10), '') ||
    '    license = "MIT",' || chr(10) || case when c_custkey % 2 = 0 then '    date = "2024-02-03",' || chr(10) || '    year = "2024",' || chr(10) || '    month = feb,' else '    date = "soon",' end || chr(10) ||
    '    doi = "10.1/' || c_custkey || '",' || chr(10) || '    repository = "https://c.org/' || c_custkey || '",' || chr(10) || '    title = ' || case when c_custkey % 9 = 0 then '{{say "hi" \& \textbraceleft x}}' else '"' || replace(c_name, '#', '\#') || '"' end || ',' || chr(10) || '    version = "' || c_nationkey || '"' ||
    case when c_custkey % 4 = 0 then ',' || chr(10) || '    swhid = "swh:1:rev:' || sha1(c_custkey::varchar) || '"' else '' end || chr(10) || '}}' || chr(10) end as citation from customer""")
def citation_bibtex(spark, sf_dir):
    return citation.cite(documents(spark, sf_dir), "bibtex")


@query(r"""select c_custkey::varchar as doc_id, case when c_custkey % 10 = 9 then 'not a document of a known vocabulary' end as error, case when c_custkey % 10 <> 9 then '{"type":"software","title":"' || case when c_custkey % 9 = 0 then 'say \"hi\" & {x' else c_name end || '","author":[' ||
    ['{"family":"Bee","given":"Ann"}', '{"family":"Dee","given":"Cy"}', '{"family":"Team"}', '{"family":"Doe","given":"Jane"}', '{"family":"Bee","given":"Ann"},{"family":"Cee","given":"Bob"}', '{"family":"Fox","given":"Eve"}'][c_custkey % 6 + 1] || ']' || case when c_custkey % 2 = 0 then ',"issued":{"date-parts":[[2024,2,3]]}' else '' end ||
    ',"DOI":"10.1/' || c_custkey || '","id":"https://doi.org/10.1/' || c_custkey || '","source":"https://c.org/' || c_custkey || '","license":"MIT","version":"' || c_nationkey || '"}' end as citation from customer""")
def citation_csl(spark, sf_dir):
    return citation.cite(documents(spark, sf_dir), "csl")


QUERIES, ORACLES = query.queries, query.oracles
