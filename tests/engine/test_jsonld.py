"""Documents of the vocabulary as nodes and statements, and the people found in them."""

import json

import pytest

from metalake.operators import citation, jsonld, props

CONTEXT = props.CONTEXT
FIRST = {"type": "SoftwareSourceCode", "name": "x", "datePublished": "2023-10-10"}


def documents(spark, *docs):
    return spark.createDataFrame([(str(k), json.dumps(d) if isinstance(d, dict) else d) for k, d in enumerate(docs)], "doc_id string, metadata string")


def people_of(spark, *authors):
    docs = [{"@context": CONTEXT, **FIRST, "author": a} for a in authors]
    got = citation.facts(documents(spark, *docs)).collect()
    return {int(r.doc_id): ([p.name for p in r.authors], r.affiliations) for r in got}


def test_people_in_roles_and_under_prefixed_names(spark):
    jane = {"name": "Jane Doe"}
    named = jane | {"id": "https://orcid.org/0000-0002-0000-000X"}
    loop = {"id": "_:r", "type": "Role", "author": {"id": "_:r"}}
    forms = [
        {"type": "Role", "schema:author": named}, [{"type": "Role", "schema:author": named}], {"type": "Role", "schema:author": jane}, [{"type": "Role", "schema:author": jane}],
        {"type": "Role", "author": [jane, {"givenName": "Bob", "familyName": "Cee"}]}, {"type": "Role", "editor": jane}, {"type": "Role", "author": {"type": "Role", "author": {"@list": [jane]}}},
        [loop, jane], {"http://schema.org/name": "Jane Doe", "schema:affiliation": [{"schema:name": "Lab"}, "Works", {"name": "Lab"}]}, "Jane Doe", [jane, jane], {"email": "x@y"}, [{"type": "Role", "author": jane}, {"name": "Al"}],
    ]
    got = people_of(spark, *forms)
    one = (["Jane Doe"], [])
    assert {k: got[k] for k in (0, 1, 2, 3, 6, 7, 9, 10)} == dict.fromkeys((0, 1, 2, 3, 6, 7, 9, 10), one)
    assert got[4] == (["Jane Doe", "Bob Cee"], []) and got[5] == ([], []) and got[11] == ([], [])
    assert got[8] == (["Jane Doe"], ["Lab", "Works"]) and got[12] == (["Jane Doe", "Al"], [])


def test_graphs(spark):
    person = {"@id": "https://p/", "@type": "Person", "name": "Ann"}
    code = {"@id": "https://c/", "@type": "SoftwareSourceCode", "name": "x", "author": {"@id": "https://p/"}}
    docs = documents(
        spark, {"@context": CONTEXT, "@graph": [code | {"author": person}]}, {"@context": CONTEXT, "@graph": [person, code]}, {"@context": CONTEXT, "@graph": [code, code | {"@id": "https://d/"}]},
        {"@context": CONTEXT, "@graph": [code, {"@type": "SoftwareApplication", "hasPart": {"@id": "https://c/"}, "name": "whole"}]},
    )
    got = {r.doc_id: (r.name, [p.name for p in r.authors]) for r in citation.facts(docs).collect()}
    assert got == {"0": ("x", ["Ann"]), "1": ("x", ["Ann"]), "2": (None, []), "3": ("whole", [])}
    rows = {(r.doc_id, r.prop, r.kind, r.value) for r in props.expand(docs).collect()}
    assert ("1", "author", "uri", "https://p/") in rows and ("0", "author", "object", '{"id":"https://p/","name":"Ann","type":"Person"}') in rows and not any(r[1] == "@graph" for r in rows)


def test_names_at_every_depth(spark):
    doc = {
        "@context": [CONTEXT, {"x": "https://x.org/", "title": {"@id": "schema:name"}, "s2": "http://schema.org/"}], "title": "t", "x:y": 1, "codemeta:readme": "https://r/", "schema:identifier": "i",
        "s2:author": {"@list": [{"schema:name": "Ann", "schema:affiliation": {"s2:name": "Lab", "@type": "schema:Organization"}}]}, "license": [{"@id": "https://l/"}, {"@id": "https://m/", "name": "M"}], "version": True, "dateCreated": "2020", "keywords": ["a", None, ["b"]],
    }
    rows = {(r.prop, r.kind, r.pos, r.value) for r in props.expand(documents(spark, doc)).collect()}
    assert rows == {
        ("name", "literal", 0, "t"), ("https://x.org/y", "number", 0, "1"), ("readme", "uri", 0, "https://r/"), ("identifier", "literal", 0, "i"), ("license", "uri", 0, "https://l/"), ("license", "object", 1, '{"id":"https://m/","name":"M"}'),
        ("version", "number", 0, "true"), ("dateCreated", "date", 0, "2020"), ("keywords", "literal", 0, "a"), ("keywords", "literal", 1, '["b"]'), ("author", "object", 0, '{"affiliation":{"name":"Lab","type":"Organization"},"name":"Ann"}'),
    }
    told = jsonld.statements(documents(spark, doc)).where("not root").collect()
    assert {(r.node, r.prop, r.value) for r in told} == {
        ("_:_:0/author.0", "name", "Ann"), ("_:_:0/author.0", "affiliation", "_:_:_:0/author.0/affiliation.0"), ("_:_:_:0/author.0/affiliation.0", "name", "Lab"), ("_:_:_:0/author.0/affiliation.0", "type", "Organization"),
        ("https://m/", "id", "https://m/"), ("https://m/", "name", "M"),
    }


@pytest.mark.parametrize("text", [None, "", "[1]", "{", '{"name":"x"}', '{"@context":"https://other.org/"}', '{"@context":{}}', '{"@context":"%s","version":NaN}' % CONTEXT, '{"@context":"%s","author":%s1%s}' % (CONTEXT, '{"a":' * 600, "}" * 600)])
def test_no_documents(spark, text):
    docs = spark.createDataFrame([("d", text)], "doc_id string, metadata string")
    assert props.expand(docs).count() == 0 and citation.cite(docs.selectExpr("*", "cast(null as string) as swhid")).first().error == "not a document of a known vocabulary"
