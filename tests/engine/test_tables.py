"""Contract of the keyed tables, search and pages."""

import pytest
from pyspark.sql import functions as F

from metalake.functions import scalars as S
from metalake.operators import content, search, tables

MIME = "id string, mimetype string, encoding string, tool_id long"


def mime(spark, rows):
    return spark.createDataFrame(rows, MIME)


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_missing_add_update(spark):
    table = mime(spark, [])
    wanted = mime(spark, [("a", "", "", 1), ("b", "", "", 1)]).select("id", "tool_id")
    assert sorted_rows(tables.missing(wanted, table, ["id", "tool_id"])) == [("a", 1), ("b", 1)]
    table = tables.upsert(table, mime(spark, [("a", "text/plain", "us-ascii", 1)]), ["id", "tool_id"])
    assert sorted_rows(tables.missing(wanted, table, ["id", "tool_id"])) == [("b", 1)]
    again = mime(spark, [("a", "text/html", "utf-8", 1)])
    once = tables.upsert(table, again, ["id", "tool_id"])
    assert sorted_rows(once) == [("a", "text/html", "utf-8", 1)]
    assert sorted_rows(tables.upsert(once, again, ["id", "tool_id"])) == sorted_rows(once)


def test_duplicate_ids_change_nothing(spark):
    rows = mime(spark, [("a", "x", "y", 1), ("a", "z", "y", 1)])
    with pytest.raises(tables.DuplicateId):
        tables.checked(rows, ["id", "tool_id"])
    with pytest.raises(tables.DuplicateId):
        tables.upsert(mime(spark, []), rows, ["id", "tool_id"])


def test_licenses_add_up(spark):
    old = spark.createDataFrame([("a", "MIT", 1)], "id string, license string, tool_id long")
    new = spark.createDataFrame([("a", "MIT", 1), ("a", "GPL", 1)], "id string, license string, tool_id long")
    assert sorted_rows(tables.upsert(old, new, ["id", "license", "tool_id"], keep_existing=True)) == [("a", "GPL", 1), ("a", "MIT", 1)]


def test_tools_keep_their_ids(spark):
    schema = "tool_name string, tool_version string, tool_configuration string"
    none = spark.createDataFrame([], "id long, " + schema)
    first, _ = tables.register_tools(none, spark.createDataFrame([("b", "1", '{"y": 1, "x": 2}')], schema))
    both, mine = tables.register_tools(first, spark.createDataFrame([("b", "1", '{"x":2,"y":1}'), ("a", "1", "{}")], schema))
    assert sorted_rows(both) == [(1, "b", "1", '{"x":2,"y":1}'), (2, "a", "1", "{}")]
    assert mine.count() == 2
    assert tables.find_tool(both, "b", "1", '{"y":1,"x":2}').count() == 1
    assert tables.find_tool(both, "b", "1", '{"y":3}').count() == 0


def producers(spark):
    rows = [("o1", '{"@context":"c","name":"n"}', ["npm"], 1), ("o2", '{"name":"n"}', ["npm", "gemspec"], 2), ("o3", '{"@context":"c"}', ["pkg-info"], 2)]
    return spark.createDataFrame(rows, "id string, metadata string, mappings array<string>, tool_id long")


@pytest.mark.parametrize(
    ("options", "ids", "token"),
    [
        ({}, ["o1", "o2", "o3"], None),
        ({"page_token": "o3"}, [], None),
        ({"page_token": "a", "limit": 2}, ["o1", "o2"], "o2"),
        ({"mappings": ["npm", "gemspec"]}, ["o1", "o2"], None),
        ({"mappings": ["npm"], "limit": 1}, ["o1"], "o1"),
        ({"mappings": []}, [], None),
        ({"tool_ids": [2]}, ["o2", "o3"], None),
    ],
)
def test_producer_pages(spark, options, ids, token):
    page, following = search.producer_page(producers(spark), **options)
    assert [r["id"] for r in page.collect()] == ids
    assert following == token


def test_statistics(spark):
    row = search.mapping_stats(producers(spark)).first().asDict()
    assert row == {"total": 3, "non_empty": 2, "cff": 0, "codemeta": 0, "gemspec": 1, "maven": 0, "npm": 2, "pkg_info": 1}
    assert search.mapping_stats(producers(spark).limit(0)).first()["npm"] == 0


def test_full_text_order(spark):
    docs = [("d1", '{"author":[{"name":"Random Person"},{"name":"John Doe"},{"name":"Jane Doe"}]}'), ("d2", '{"author":[{"name":"Random Person"},{"name":"Jane Doe"}]}')]
    rows = spark.createDataFrame(docs, "id string, metadata string").withColumn("tokens", S.json_tokens(F.col("metadata")))
    found = lambda *terms: [r["id"] for r in search.full_text(rows, list(terms)).collect()]
    assert found("Doe") == ["d1", "d2"]
    assert found("Jane") == ["d2", "d1"]
    assert found("John", "Jane") == ["d1"]
    assert found("author") == []


def test_partitions_cover_all_ids(spark):
    rows = spark.range(500).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("id"))
    parts = [{r["id"] for r in search.id_partition(rows, i, 7).collect()} for i in range(7)]
    assert sum(map(len, parts)) == len(set().union(*parts)) == 500
    with pytest.raises(ValueError):
        search.id_partition(rows, 0, 1, limit=None)


def test_nul_is_removed_but_not_escaped_backslashes(spark):
    row = spark.createDataFrame([('{"a":"x\\u0000y","b":"\\\\u0000"}',)], "m string").select(S.without_nul(F.col("m"))).first()
    assert row[0] == '{"a":"xy","b":"\\\\u0000"}'


def test_json_tokens_skip_keys_and_unescape(spark):
    text = '{"k":"A \\"b\\"\\n c\\\\", "n": 5, "l": ["d", {"e": "f g"}]}'
    assert spark.range(1).select(S.json_tokens(F.lit(text))).first()[0] == ["a", "b", "c", "d", "f", "g"]


def test_version_order(spark):
    names = ["foo", "x-0.0.1-beta2.tar.gz", "x-0.0.1.tar.gz", "x-0.0.1+foobar.tar.gz", "x-0.0.2.tar.gz", "x-1.0.tar.gz", "x-20240101123456.tar.gz", f"x-{'9' * 60}.tar.gz"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "n string")
    assert [r["n"] for r in df.orderBy(S.version_key(F.col("n"))).collect()] == names


@pytest.mark.parametrize(
    ("data", "kind", "charset"),
    [
        ("élève\n".encode(), "text/plain", "utf-8"),
        (b"#!/usr/bin/env python\nprint(1)\n", "text/x-python", "us-ascii"),
        (b"\x89PNG\r\n\x1a\n\x00\x00", "image/png", "binary"),
        (b"\xff\xfe\x00\x00\x01\x02\x03\x04\x05\x06", "application/octet-stream", "binary"),
        (b'{"a": 1}', "application/json", "us-ascii"),
        (b"caf\xe9 au lait", "text/plain", "iso-8859-1"),
        (b"", "application/x-empty", "binary"),
    ],
)
def test_mimetypes(spark, data, kind, charset):
    row = content.mimetypes(spark.createDataFrame([("a", data)], "id string, data binary")).first()
    assert (row["mimetype"], row["encoding"]) == (kind, charset)


def test_blobs_and_checksums(spark):
    import hashlib

    blobs = spark.createDataFrame([("a", b"hello"), ("b", b"")], "sha1 string, data binary")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    found, absent = content.with_blobs(ids, blobs)
    assert [r["id"] for r in found.collect()] == ["a"]
    assert sorted(r["id"] for r in absent.collect()) == ["b", "c"]
    row = content.checksums(blobs.where("sha1 = 'a'")).first()
    assert row["sha1_git"] == hashlib.sha1(b"blob 5\0hello").hexdigest()
    row = content.blake2(blobs).first()
    assert row["blake2b512"] in {hashlib.blake2b(x).hexdigest() for x in (b"hello", b"")}


def test_licenses(spark):
    data = [("a", b"// SPDX-License-Identifier: ISC\nReleased under the MIT License."), ("b", b"nothing")]
    got = content.licenses(spark.createDataFrame(data, "id string, data binary"))
    assert sorted((r["id"], r["license"]) for r in got.collect()) == [("a", "ISC"), ("a", "MIT")]


def test_every_license_is_found_by_its_phrases(spark):
    """All phrases, in capitals and broken over lines; and the names that expressions hold."""
    from metalake.operators import licenses

    assert len({n for n, _ in licenses.PHRASES}) >= 110
    rows = [(str(k), ("Word! " + p.upper().replace(" ", "\n * ") + ", and more.").encode()) for k, (_, p) in enumerate(licenses.PHRASES)]
    got = {}
    for r in content.licenses(spark.createDataFrame(rows, "id string, data binary")).collect():
        got.setdefault(r.id, set()).add(r.license)
    assert all(name in got[str(k)] for k, (name, _) in enumerate(licenses.PHRASES))
    # a version isn't taken for a longer one
    lines = ["GNU General Public License version 2.1", "the GNU Lesser General Public License v2.1.", "GNU General Public License, version 30", "gnu general public license 3"]
    told = content.licenses(spark.createDataFrame([(str(k), t.encode()) for k, t in enumerate(lines)], "id string, data binary")).collect()
    assert sorted((r.id, r.license) for r in told) == [("1", "LGPL-2.1"), ("3", "GPL-3.0")]


@pytest.mark.parametrize(
    "expression, names",
    [
        ("MIT OR (Apache-2.0 AND BSD-3-Clause)", ["MIT", "Apache-2.0", "BSD-3-Clause"]), ("((MIT))", ["MIT"]), ("GPL-2.0+ WITH x-1 OR ISC", ["GPL-2.0+ WITH x-1", "ISC"]),
        ("MIT */", ["MIT"]), ("", []), ("OR", []), ("MIT ISC", ["MIT"]), ("MIT AND (ISC", ["MIT", "ISC"]),
    ],
)
def test_spdx_expressions(spark, expression, names):
    from metalake.operators import licenses

    assert spark.range(1).select(licenses.expression_names(F.lit(expression)).alias("n")).first().n == names
