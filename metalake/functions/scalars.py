"""Column functions: URLs, identifiers, JSON text, tokens, version keys. All native."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of license URIs, prefix of persistent object identifiers.
SPDX = "https://spdx.org/licenses/"
OBJECT_ID = "swh:1:"


def is_url(c: Column) -> Column:
    """No space, and a non-empty network location after ``//``; null gives false."""
    return F.coalesce(~c.contains(" ") & c.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+"), F.lit(False))


def netloc(c: Column) -> Column:
    """User info, host and port of a URL; empty when there is none."""
    return F.regexp_extract(c, r"^[^:/?#]*:?//([^/?#]*)", 1)


def spdx_uri(c: Column) -> Column:
    """License name to its SPDX URI; such a URI stays as it is."""
    return F.when(c.startswith(SPDX), c).otherwise(F.concat(F.lit(SPDX), c))


def spdx_name(c: Column) -> Column:
    """SPDX URI to the license name, without ``.html``; null for any other value."""
    name = F.regexp_extract(c, r"^https?://spdx\.org/licenses/(.+?)(?:\.html)?$", 1)
    return F.when(name != "", name)


def swhid(kind: str, hex_id: Column) -> Column:
    return F.concat(F.lit(f"{OBJECT_ID}{kind}:"), F.lower(hex_id))


def without_nul(json_text: Column) -> Column:
    r"""Drops the escape ``\u0000`` from JSON text; an escaped backslash before u0000 stays."""
    return F.regexp_replace(json_text, r"(?<!\\)((?:\\\\)*)\\u0000", "$1")


def canonical_json(json_text: Column) -> Column:
    """JSON text with sorted keys and no spaces; null for invalid text."""
    return F.to_json(F.try_parse_json(json_text))


def whole_json(text: Column) -> Column:
    """A text that is one JSON value and nothing else, as variant. The parser stops after the
    first value; inside brackets, what follows is an error or a second item."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_variant_get(listed, "$[1]", "variant").isNull() & F.rtrim(text).rlike(r"[^\]\s]\s*$|^\s*\[[\s\S]*\]\s*$")
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


@contextmanager
def last_key_wins(spark: SparkSession) -> Iterator[None]:
    """JSON expressions made inside keep the last value of a repeated key, at any depth."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parsed(rows: DataFrame, text: Column, column: str) -> DataFrame:
    """``rows`` with ``text`` as variant; invalid JSON gives null, the last of repeated keys counts."""
    with last_key_wins(rows.sparkSession):
        return rows.withColumn(column, whole_json(text))


def json_leaves(json_text: Column) -> Column:
    """String values (not keys) of JSON text, in order."""
    # Control characters can't occur in JSON text: they stand in for escaped backslashes and
    # quotes, so that every remaining quote opens or closes a string.
    plain = F.replace(F.replace(json_text, F.lit("\\\\"), F.lit("\u0003")), F.lit('\\"'), F.lit("\u0002"))
    found = F.regexp_extract_all(plain, F.lit(r'"[^"]*+"(?:\s*+:)?'), 0)
    values = F.array_join(F.filter(found, lambda x: x.endswith('"')), ",")
    escaped = F.replace(F.replace(values, F.lit("\u0002"), F.lit('\\"')), F.lit("\u0003"), F.lit("\\\\"))
    return F.from_json(F.concat(F.lit("["), escaped, F.lit("]")), "array<string>")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters a-z and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)


def json_tokens(json_text: Column) -> Column:
    """Tokens of all string values of a metadata document; keys don't count."""
    return F.coalesce(F.flatten(F.transform(json_leaves(json_text), tokens)), F.array().cast("array<string>"))


def has_metadata(json_text: Column) -> Column:
    """True when a document has a key besides @context."""
    return F.size(F.array_except(F.coalesce(F.json_object_keys(json_text), F.array().cast("array<string>")), F.array(F.lit("@context")))) > 0


#: Parts of an archive's file name: package, version (after its first number each further one
#: is a single digit), a suffix, extensions.
VERSION = r"[0-9]+(?:\.[0-9])*"
SUFFIX = r"[-+][a-zA-Z0-9.~]+?"
EXTENSIONS = r"(?:\.[a-zA-Z0-9]+)+"
ARCHIVE = rf"^(.*)[-_]({VERSION})({SUFFIX})?({EXTENSIONS})$"


def version_key(name: Column) -> Column:
    """Sortable key of an archive's file name: unmatched names first, then by version numbers;
    a pre-release (-x) sorts before and a post-release (+x) after its version. Numbers may have
    up to 38 digits; a longer one counts as the largest of these."""
    numbers, suffix = F.regexp_extract(name, ARCHIVE, 2), F.regexp_extract(name, ARCHIVE, 3)
    flag = F.when(suffix.startswith("-"), -1).when(suffix.startswith("+"), 1).otherwise(0).cast("decimal(38,0)")
    matched = name.rlike(ARCHIVE)
    whole = lambda x: F.coalesce(x.try_cast("decimal(38,0)"), F.lit("9" * 38).cast("decimal(38,0)"))
    parts = F.transform(F.split(F.when(matched, numbers).otherwise("0"), r"\."), whole)
    return F.struct(
        matched.alias("matched"),
        F.concat(parts, F.array(flag)).alias("numbers"),
        F.substring(suffix, 2, 1000).alias("suffix"),
    )


def first_of(rules: list[tuple[Column, str]]) -> Column:
    """The value of the first rule that holds; null if none does."""
    out = F
    for condition, value in rules:
        out = out.when(condition, value)
    return out


def mime_charset(data: Column) -> tuple[Column, Column]:
    """(mimetype, encoding) of bytes, by leading signatures and character rules."""
    head = F.hex(F.substring(data, 1, 300))
    text = F.decode(data, "ISO-8859-1")
    start = F.substring(text, 1, 1024)
    ascii_only = ~text.rlike(r"[\x80-\xff]")
    utf8 = F.is_valid_utf8(data.cast("string"))
    wide = F.when(head.startswith("FFFE") & ~head.startswith("FFFE0000"), "utf-16le").when(head.startswith("FEFF"), "utf-16be")
    control = text.rlike(r"[\x00-\x06\x0e-\x1a\x1c-\x1f]") & wide.isNull()
    kind = first_of([(F.substring(head, 2 * offset + 1, len(mark)) == mark, mime) for offset, mark, mime in SIGNATURES])
    binary = F.coalesce(kind.isNotNull(), F.lit(False))
    wordy = first_of([(start.rlike(pattern), mime) for pattern, mime in TEXT_KINDS])
    is_json = text.rlike(r"^\s*[{\[]") & whole_json(data.cast("string")).isNotNull()
    wordy = F.coalesce(F.when(is_json, "application/json"), wordy, F.lit("text/plain"))
    empty = F.octet_length(data) == 0
    readable = ~control & (ascii_only | utf8)
    kind = F.when(empty, "application/x-empty").when(binary, kind).when(wide.isNotNull(), "text/plain").when(readable, wordy).when(control, "application/octet-stream").otherwise("text/plain")
    charset = F.when(empty | binary | control, "binary").when(wide.isNotNull(), wide).when(ascii_only, "us-ascii").when(utf8, "utf-8").otherwise("iso-8859-1")
    return kind, charset


#: Fixed values: (offset, bytes in hex, MIME type) of common binary formats.
SIGNATURES = [
    (0, "89504E470D0A1A0A", "image/png"),
    (0, "FFD8FF", "image/jpeg"),
    (0, "474946383761", "image/gif"),
    (0, "474946383961", "image/gif"),
    (0, "49492A00", "image/tiff"),
    (0, "4D4D002A", "image/tiff"),
    (0, "424D", "image/bmp"),
    (8, "57454250", "image/webp"),
    (0, "00000100", "image/vnd.microsoft.icon"),
    (0, "25504446", "application/pdf"),
    (0, "25215053", "application/postscript"),
    (0, "504B0304", "application/zip"),
    (0, "504B0506", "application/zip"),
    (0, "1F8B", "application/gzip"),
    (0, "425A68", "application/x-bzip2"),
    (0, "FD377A585A00", "application/x-xz"),
    (0, "28B52FFD", "application/zstd"),
    (0, "377ABCAF271C", "application/x-7z-compressed"),
    (0, "526172211A07", "application/x-rar"),
    (257, "7573746172", "application/x-tar"),
    (0, "213C617263683E0A", "application/x-archive"),
    (0, "7F454C46", "application/x-executable"),
    (0, "4D5A", "application/x-dosexec"),
    (0, "CAFEBABE", "application/java-vm"),
    (0, "0061736D", "application/wasm"),
    (0, "53514C69746520666F726D6174203300", "application/vnd.sqlite3"),
    (0, "D0CF11E0A1B11AE1", "application/vnd.ms-office"),
    (0, "494433", "audio/mpeg"),
    (0, "4F676753", "audio/ogg"),
    (0, "664C6143", "audio/flac"),
    (8, "57415645", "audio/x-wav"),
    (4, "66747970", "video/mp4"),
    (0, "1A45DFA3", "video/webm"),
    (0, "774F4646", "font/woff"),
    (0, "774F4632", "font/woff2"),
    (0, "4F54544F", "font/otf"),
    (0, "0001000000", "font/ttf"),
    (0, "38425053", "image/vnd.adobe.photoshop"),
    (0, "0000000C6A502020", "image/jp2"),
    (0, "0000000C4A584C20", "image/jxl"),
    (0, "67696D7020786366", "image/x-xcf"),
    (0, "41542654464F524D", "image/vnd.djvu"),
    (0, "00000200", "image/x-win-bitmap"),
    (0, "4D546864", "audio/midi"),
    (0, "2E736E64", "audio/basic"),
    (8, "41494646", "audio/x-aiff"),
    (0, "2321414D52", "audio/amr"),
    (0, "464C5601", "video/x-flv"),
    (0, "000001BA", "video/mpeg"),
    (0, "000001B3", "video/mpeg"),
    (8, "41564920", "video/x-msvideo"),
    (0, "3026B2758E66CF11", "video/x-ms-asf"),
    (0, "04224D18", "application/x-lz4"),
    (0, "4C5A4950", "application/x-lzip"),
    (0, "1F9D", "application/x-compress"),
    (0, "4D534346", "application/vnd.ms-cab-compressed"),
    (0, "303730373031", "application/x-cpio"),
    (0, "EDABEEDB", "application/x-rpm"),
    (0, "CFFAEDFE", "application/x-mach-binary"),
    (0, "FEEDFACF", "application/x-mach-binary"),
    (0, "4243C0DE", "application/x-llvm"),
    (0, "1B4C7561", "application/x-lua-bytecode"),
    (0, "5041434B00", "application/x-git-pack"),
    (0, "894844460D0A1A0A", "application/x-hdf5"),
    (0, "43444601", "application/x-netcdf"),
    (0, "50415231", "application/vnd.apache.parquet"),
    (0, "4152524F5731", "application/vnd.apache.arrow.file"),
    (0, "4F626A01", "application/avro"),
    (0, "D4C3B2A1", "application/vnd.tcpdump.pcap"),
    (0, "A1B2C3D4", "application/vnd.tcpdump.pcap"),
    (128, "4449434D", "application/dicom"),
    (0, "53494D504C4520203D", "image/fits"),
    (0, "C5D0D3C6", "image/x-eps"),
    (0, "789C", "application/zlib"),
]
#: Fixed values: (pattern at the start, MIME type) of kinds of text.
TEXT_KINDS = [
    (r"(?i)^\s*(<!doctype html|<html|<head|<body)", "text/html"),
    (r"(?i)^\s*<svg|^\s*<\?xml[^>]*\?>\s*<svg", "image/svg+xml"),
    (r"^\s*<\?xml", "text/xml"),
    (r"^#![^\n]*python", "text/x-python"),
    (r"^#![^\n]*perl", "text/x-perl"),
    (r"^#![^\n]*ruby", "text/x-ruby"),
    (r"^#![^\n]*node", "application/javascript"),
    (r"^#![^\n]*sh\b", "text/x-shellscript"),
    (r"^<\?php", "text/x-php"),
    (r"^diff --git |^--- [^\n]*\n\+\+\+ ", "text/x-diff"),
    (r"^%!PS", "application/postscript"),
    (r"^\\documentclass", "text/x-tex"),
    (r"^(From |Return-Path: |Received: )[^\n]*\n", "message/rfc822"),
]
