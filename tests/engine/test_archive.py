"""Archive graph, detection, formats, merge, citations and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from metalake.operators import citation, formats, graph, props
from metalake.registry import REGISTRY, Mapping, MappingConflict, Registry
from metalake.sources import crosswalk
from metalake.streaming import journal


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


BRANCHES = "snapshot long, name string, target_type string, target string"


def test_heads(spark):
    b = spark.createDataFrame(
        [
            (1, "HEAD", "alias", "dev"), (1, "dev", "alias", "rel"), (1, "rel", "release", "r1"),
            (2, "HEAD", "alias", "gone"), (2, "gone", None, None), (2, "master", "revision", "m2"),
            (3, "HEAD", "alias", "loop"), (3, "loop", "alias", "HEAD"),
            (4, "HEAD", "content", "c"), (5, "master", "revision", "m5"),
        ],
        BRANCHES,
    )
    assert rows(graph.generic_heads(b)) == [(1, "release", "r1"), (2, "revision", "m2"), (5, "revision", "m5")]


def test_archive_head_is_the_highest_version(spark):
    names = ["x-1.2.tar.gz", "x-1.3-rc1.tar.gz", "x-1.3.tar.gz", "README"]
    b = spark.createDataFrame([(1, n, "revision", n) for n in names], BRANCHES)
    assert rows(graph.archive_heads(b)) == [(1, "x-1.3.tar.gz", "revision", "x-1.3.tar.gz")]


def test_descent_and_detection(spark):
    entries = spark.createDataFrame(
        [(1, 1, "src", "dir", 2), (2, 1, "PACKAGE.json", "file", 7), (2, 2, "package.json", "file", 8), (2, 3, "x.gemspec.bak", "file", 9), (3, 1, "codemeta.JSON", "file", 5), (3, 2, "pom.xml", "dir", 6)],
        "dir_id long, pos int, name string, type string, target long",
    )
    found = graph.detect_files(graph.descend_single(entries))
    assert rows(found) == sorted([(1, "gemspec", 9), (1, "npm", 7), (2, "gemspec", 9), (2, "npm", 7), (3, "codemeta", 5)], key=str)
    flags = {r["dir_id"]: r["truncated"] for r in graph.root_entries(entries, 2).collect()}
    assert flags == {1: False, 2: True, 3: False}


def translate(spark, mapping, data):
    files = spark.createDataFrame([("d", data)], "doc_id string, data binary")
    out: dict = {}
    for r in REGISTRY.mappings()[mapping].translate(files).orderBy("prop", "pos", "value").collect():
        out.setdefault(r["prop"], []).append(json.loads(r["value"]) if r["kind"] == "object" else r["value"])
    return out


def test_npm_variants(spark):
    doc = {"name": 5, "description": "\ufffd\ufffd#\0 \0h\0i\0", "repository": "gitlab:a/b", "bugs": "x y", "author": "A <a@b>", "license": "SEE LICENSE IN X"}
    got = translate(spark, "npm", json.dumps(doc).encode())
    assert got["codeRepository"] == ["git+https://gitlab.com/a/b.git"]
    assert got["author"] == [{"name": "A", "email": "a@b", "type": "Person"}]
    assert got["description"] == ["hi"]
    assert "name" not in got and "issueTracker" not in got and "license" not in got
    assert translate(spark, "npm", b'{"name":"a","name":"b"}')["name"] == ["b"]


BAD = [b"", b"\xff\xfe", b"[1]", b"{", b"<a", b"null", b'{"name": {"a": [1]}, "author": [[2]], "license": 4}', b"a: [b", b"<project><a/></project>", b"<entry><a></entry>", None, b"{\"a\":1} x", b"[" * 5000, b"a: " + b"[" * 5000, b"- " * 3000, b"<a>" * 5000 + b"</a>" * 5000, b'{"a":' * 3000]


@pytest.mark.parametrize("mapping", sorted(REGISTRY.mappings()))
def test_bad_files_don_t_fail_the_job(spark, mapping):
    files = spark.createDataFrame([(str(k), data) for k, data in enumerate(BAD)], "doc_id string, data binary")
    out = REGISTRY.mappings()[mapping].translate(files)
    assert out.where("value is null").isEmpty()
    if mapping != "pkg-info":  # any text has headers, though it may be none
        assert formats.rejected(files, out).count() >= len(BAD) - 6


def test_gemspec_literals(spark):
    text = b'Gem::Specification.new { |g|\n g.name = "a"\n g.authors = ["x", y]\n g.summary = "s",\n g.licenses = ["MIT"]\n}'
    assert translate(spark, "gemspec", text) == {"name": ["a"], "license": ["https://spdx.org/licenses/MIT"], "type": ["SoftwareSourceCode"]}
    assert translate(spark, "gemspec", text + b"# \xff") == {}


def test_preferred_citation_replaces(spark):
    text = b"title: A\npreferred-citation:\n  title: B\n  doi: 10.1/2\n"
    assert translate(spark, "cff", text) == {"name": ["B"], "identifier": ["https://doi.org/10.1/2"], "type": ["SoftwareSourceCode"]}


def test_merge_keeps_order_and_ids(spark):
    table = spark.createDataFrame(
        [("a", "id", "uri", 0, "https://a/"), ("a", "name", "literal", 0, "x"), ("b", "id", "uri", 0, "https://b/"), ("b", "name", "literal", 0, "y"), ("b", "name", "literal", 1, "x")],
        "doc_id string, prop string, kind string, pos int, value string",
    )
    groups = spark.createDataFrame([("g", 1, "a"), ("g", 2, "b")], "group string, rank int, doc_id string")
    got = [(r["prop"], r["value"]) for r in props.merge(table, groups).orderBy("prop", "pos").collect()]
    assert got == [("id", "https://a/"), ("name", "x"), ("name", "y"), ("sameAs", "https://b/")]
    assert json.loads(props.compact(props.merge(table, groups)).first()["metadata"])["schema:sameAs"] == "https://b/"


def test_expand_then_compact_is_stable(spark):
    text = '{"@context":"https://w3id.org/codemeta/3.0","name":"n","license":"https://l/","author":[{"type":"Person","name":"Z"},{"type":"Person","name":"A"}],"version":2}'
    docs = spark.createDataFrame([("d", text)], "doc_id string, metadata string")
    once = props.compact(props.expand(docs))
    assert rows(props.compact(props.expand(once))) == rows(once)
    assert [p["name"] for p in json.loads(once.first()["metadata"])["author"]] == ["Z", "A"]


def test_citations(spark):
    body = {"@context": props.CONTEXT, "name": "n", "author": [{"type": "Person", "givenName": "Jane", "familyName": "Doe"}, {"type": "Organization", "name": "Org"}], "dateCreated": "2023-07-01"}
    docs = spark.createDataFrame([("d", json.dumps(body), "swh:1:cnt:" + "a" * 40 + ";lines=3-4"), ("e", "{}", None)], "doc_id string, metadata string, swhid string")
    got = {r["doc_id"]: r for r in citation.cite(docs).collect()}
    assert got["d"]["citation"].startswith("@codefragment{swh-cnt-aaaaaaa-L3-L4,\n    author = \"Doe, Jane and {Org}\"")
    assert got["e"]["error"]
    csl = json.loads(citation.cite(docs, "csl").where("doc_id = 'd'").first()["citation"])
    assert csl["author"] == [{"family": "Doe", "given": "Jane"}, {"family": "Org"}]
    assert csl["issued"] == {"date-parts": [[2023, 7, 1]]}


def test_crosswalk(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Property,NodeJS,Ruby Gem\nname,name,name\ncodeRepository,\"repository, repo\",\nlicense,,license / licenses\nsoftwareRequirements,deps,\n,x,\nurl,repo,\n")
    got = crosswalk.crosswalk(spark, str(tmp_path / "c.csv"), ["NodeJS", "Ruby Gem"])
    assert rows(got) == sorted([("NodeJS", "name", "name"), ("NodeJS", "repository", "codeRepository"), ("NodeJS", "repo", "url"), ("Ruby Gem", "name", "name"), ("Ruby Gem", "license", "license"), ("Ruby Gem", "licenses", "license")], key=str)


def test_context_terms(spark, tmp_path):
    (tmp_path / "c.jsonld").write_text(json.dumps({"@context": {"name": {"@id": "schema:name"}, "url": {"@id": "schema:url", "@type": "@id"}, "author": {"@id": "schema:author", "@container": "@list"}, "schema": "http://schema.org/"}}))
    assert rows(crosswalk.context_terms(spark, str(tmp_path / "c.jsonld"))) == [("author", "http://schema.org/author", "@list"), ("name", "http://schema.org/name", None), ("url", "http://schema.org/url", "@id")]


def test_registry(spark):
    mine = Registry(builtin=dict(REGISTRY.builtin))
    mine.add_mapping(Mapping("npm", formats.composer, ("exact", "package.json")))
    assert mine.mappings()["npm"].translate is formats.composer
    with pytest.raises(MappingConflict):
        mine.add_mapping(Mapping("npm", formats.npm))
    assert [m.name for m in mine.for_format("gogs-repository-json")] == ["gitea"]
    assert ("maven", "exact", "pom.xml") in mine.file_rules()
    table = {r["term"]: r["mappings"] for r in mine.term_coverage(spark, ("gitea",)).collect()}
    assert table["issueTracker"] == ["codemeta", "github", "json-sword-codemeta", "pubspec", "sword-codemeta"]
    assert table["embargoDate"] == ["codemeta", "json-sword-codemeta", "sword-codemeta"]
    assert mine.mapping_table(spark).count() == 13
    assert REGISTRY.indexer_table(spark).count() == 6


def test_forge_documents(spark):
    record = {"html_url": "https://f.org/a", "full_name": "a", "forks_count": 1, "stargazers_count": 13, "parent": {"html_url": "https://up.org/"}}
    files = spark.createDataFrame([("d", json.dumps(record).encode())], "doc_id string, data binary")
    got = json.loads(props.compact(formats.github(files), forge=True).first()["metadata"])
    assert got == {
        "@context": [props.CONTEXT, props.PREFIXES], "type": "forge:Repository", "id": "https://f.org/a", "name": "a", "forge:forkedFrom": {"id": "https://up.org/"},
        "forge:forks": {"as:totalItems": {"@value": "1", "type": "xsd:nonNegativeInteger"}, "type": "as:OrderedCollection"},
        "as:likes": {"as:totalItems": {"@value": "13", "type": "xsd:nonNegativeInteger"}, "type": "as:Collection"},
    }


def test_a_crosswalk_drives_a_mapping(spark, tmp_path):
    from metalake.registry import crosswalk_rules, ruled

    (tmp_path / "c.csv").write_text("Property,Tool\nname,title\nurl,site\ndateCreated,born\n")
    (tmp_path / "c.jsonld").write_text(json.dumps({"@context": {"name": {"@id": "schema:name"}, "url": {"@id": "schema:url", "@type": "@id"}, "dateCreated": {"@id": "schema:dateCreated", "@type": "schema:Date"}, "schema": "http://schema.org/"}}))
    rules = crosswalk_rules(crosswalk.crosswalk(spark, str(tmp_path / "c.csv"), ["Tool"]), crosswalk.context_terms(spark, str(tmp_path / "c.jsonld")), "Tool")
    mapping = ruled("tool", rules, ("exact", "tool.json"), hooks={"title": lambda x: F.array(F.upper(formats.text_of(x)))})
    files = spark.createDataFrame([("d", b'{"title":"n","site":"no url","born":"2020","other":1}'), ("e", b'{"site":["https://a/","x"]}')], "doc_id string, data binary")
    got = sorted((r.doc_id, r.prop, r.kind, r.value) for r in mapping.translate(files).collect())
    assert got == [("d", "dateCreated", "date", "2020"), ("d", "name", "literal", "N"), ("d", "type", "type", "SoftwareSourceCode"), ("e", "type", "type", "SoftwareSourceCode"), ("e", "url", "uri", "https://a/")]


def test_directories_from_bytes(spark):
    """Descent, the cap on entries, missing blobs, unknown and failing files, reuse."""
    from metalake.plans import pipelines

    entries = spark.createDataFrame(
        [("top", 1, "src", "dir", "src"), ("src", 1, "package.json", "file", "g1"), ("src", 2, "PKG-INFO", "file", "g2"), ("many", 1, "a", "file", "g9"), ("many", 2, "b", "file", "g9"), ("many", 3, "package.json", "file", "g1"),
         ("bad", 1, "package.json", "file", "g3"), ("unknown", 1, "package.json", "file", "g7"), ("old", 1, "codemeta.json", "file", "g4"), ("old", 2, "package.json", "file", "g5"), ("not asked", 1, "package.json", "file", "g1")],
        "dir_id string, pos int, name string, type string, target string",
    )
    contents = spark.createDataFrame([(f"g{k}", f"s{k}") for k in (1, 2, 3, 4, 5)], "sha1_git string, sha1 string")
    blobs = spark.createDataFrame([("s1", b'{"name":"one"}'), ("s2", b"Name: two\n\n"), ("s3", b"{"), ("s4", b"never read"), ("s5", b"")], "sha1 string, data binary")
    known = spark.createDataFrame([("s4", json.dumps({"@context": props.CONTEXT, "id": "https://i/", "name": "old"}))], "id string, metadata string")
    wanted = spark.createDataFrame([(d,) for d in ("top", "many", "bad", "unknown", "old", "top", "absent")], "dir_id string")
    found = pipelines.directory_metadata(wanted, entries, contents, blobs, known, most=2)
    got = {r.id: (json.loads(r.metadata), r.mappings, r.truncated) for r in found.directories.collect()}
    c = {"@context": props.CONTEXT}
    assert got == {
        "top": (c | {"type": "SoftwareSourceCode", "name": ["one", "two"]}, ["npm", "pkg-info"], False),
        "many": (c, [], True), "bad": (c, ["npm"], False), "unknown": (c, [], False),
        "old": (c | {"id": "https://i/", "name": "old"}, ["codemeta", "npm"], False),
    }
    assert sorted((r.id, r.mapping) for r in found.contents.collect()) == [("s1", "npm"), ("s2", "pkg-info")]


def test_origins_from_bytes(spark):
    """Release and revision heads, two origins with one directory, a repeated origin, no head, no metadata."""
    from metalake.plans import pipelines

    urls = ["https://a/", "https://b/", "https://c/", "https://d/", "https://e/"]
    visits = spark.createDataFrame([(u, 1, "2024-01-01", "git", "full", k) for k, u in enumerate(urls)], "origin string, visit long, date string, type string, status string, snapshot long")
    branches = spark.createDataFrame([(0, "HEAD", "revision", "r1"), (1, "HEAD", "release", "l1"), (2, "HEAD", "revision", "gone"), (3, "HEAD", "revision", "r2")], BRANCHES)
    revisions = spark.createDataFrame([("r1", "d1"), ("r2", "d2")], "id string, directory string")
    releases = spark.createDataFrame([("l1", "directory", "d1"), ("l2", "revision", "r1")], "id string, target_type string, target string")
    entries = spark.createDataFrame([("d1", 1, "package.json", "file", "g1"), ("d2", 1, "README", "file", "g1")], "dir_id string, pos int, name string, type string, target string")
    contents = spark.createDataFrame([("g1", "s1")], "sha1_git string, sha1 string")
    blobs = spark.createDataFrame([("s1", b'{"name":"n"}')], "sha1 string, data binary")
    again = spark.createDataFrame([("https://a/",)], "url string")
    found = pipelines.origin_intrinsic_metadata(again, visits, branches, revisions, releases, entries, contents, blobs)
    assert sorted((r.id, r.from_directory, json.loads(r.metadata)["name"]) for r in found.origins.collect()) == [("https://a/", "d1", "n"), ("https://b/", "d1", "n")]
    assert [r.id for r in found.directories.collect()] == ["d1"]


def test_a_stream_stops_after_some_objects(spark, tmp_path):
    log = f"{tmp_path}/log"
    for k in range(4):
        spark.createDataFrame([(2 * k,), (2 * k + 1,)], "id long").coalesce(1).write.mode("append").parquet(log)
    jobs = {"m": lambda d: d}
    run = lambda stop: journal.run_indexers(journal.file_log(spark, log, "id long"), jobs, f"{tmp_path}/out", f"{tmp_path}/check", stop_after=stop)
    run(3)
    seen = spark.read.parquet(f"{tmp_path}/out/m").count()
    assert seen >= 3
    run(100)
    assert spark.read.parquet(f"{tmp_path}/out/m").select("id").distinct().count() == 8
    assert journal.kafka_options("b:1", "p", ["origin", "content", "origin"], 50, "g") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "p.content,p.origin", "maxOffsetsPerTrigger": "50", "startingOffsets": "earliest", "kafka.group.id": "g"
    }


def test_stream_repeats_change_nothing(spark, tmp_path):
    log = f"{tmp_path}/log"
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, mimetype string").coalesce(1).write.parquet(log)
    jobs = {"m": lambda d: d}
    for k in range(2):
        stream = journal.file_log(spark, log, "id long, mimetype string")
        journal.run_indexers(stream, jobs, f"{tmp_path}/out", f"{tmp_path}/check{k}").awaitTermination()
    assert rows(journal.read_index(spark, f"{tmp_path}/out", "m", ["id"])) == [(1, "a"), (2, "b")]
    assert journal.topics_of({"x": ["content"], "y": ["origin", "content"]}, ["x", "y"]) == ["content", "origin"]


def test_alias_chains_have_no_longest_length(spark):
    rows = [(1, "HEAD", "alias", "b0"), *((1, f"b{k}", "alias", f"b{k + 1}") for k in range(19)), (1, "b19", "revision", "r")]
    branches = spark.createDataFrame(rows, "snapshot long, name string, target_type string, target string")
    assert [tuple(r) for r in graph.resolve_aliases(branches, ["HEAD"]).select("snapshot", "name", "target").collect()] == [(1, "HEAD", "r")]
