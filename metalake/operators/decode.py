"""Bytes of package files to text and typed JSON: character sets, YAML, Ruby literals."""

from __future__ import annotations

import codecs
import json
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utf8(data: str = "data") -> Column:
    """Text of UTF-8 bytes; null if they are none."""
    return F.try_validate_utf8(F.col(data).cast("string"))


# -- character sets -------------------------------------------------------------------------

UPPER = bytes(range(128, 256)).decode("latin-1")
#: Names of the character sets of one byte a character that an XML declaration may give.
ONE_BYTE = [f"iso-8859-{k}" for k in range(1, 17) if k != 12] + [f"windows-{k}" for k in range(1250, 1259)] + [f"cp{k}" for k in range(1250, 1259)] + ["koi8-r", "koi8-u", "latin1", "latin-1", "cp437", "cp850", "cp866", "macintosh"]


def upper_half(charset: str) -> str:
    """The characters of the bytes 128 to 255; those without one are U+FFFD."""
    return bytes(range(128, 256)).decode(codecs.lookup(charset).name, "replace")


def declared_charset(data: Column) -> Column:
    """Lower-case name of the character set that bytes of XML are in: by their byte-order mark, by
    the zero bytes of UTF-16, by the declaration, else utf-8."""
    head = F.hex(F.substring(data, 1, 4))
    told = F.lower(F.regexp_extract(F.decode(F.substring(data, 1, 400), "ISO-8859-1"), r"""^\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._:-]+)["']""", 1))
    return (
        F.when(head.startswith("EFBBBF"), "utf-8")
        .when(head.startswith("FFFE") | head.startswith("3C00"), "utf-16le")
        .when(head.startswith("FEFF") | head.startswith("003C"), "utf-16be")
        .when(told == "", "utf-8").otherwise(told)
    )


def xml_text(data: Column) -> Column:
    """Text of XML in its own character set, without byte-order mark and declaration. Bytes that
    the set doesn't know, and sets of several bytes other than UTF-8 and UTF-16, give null."""
    charset, latin = declared_charset(data), F.decode(data, "ISO-8859-1")
    place = F.call_function("find_in_set", charset, F.lit(",".join(ONE_BYTE)))
    own = F.substring(F.lit("".join(map(upper_half, ONE_BYTE))), place * 128 - 127, F.lit(128))
    single = F.call_function("translate", latin, F.lit(UPPER), own)
    text = (
        F.when(charset.isin("utf-8", "utf8"), F.try_validate_utf8(data.cast("string")))
        .when(charset.isin("us-ascii", "ascii"), F.when(~latin.rlike(r"[\x80-\xff]"), latin))
        .when(charset == "utf-16le", F.when(F.octet_length(data) % 2 == 0, F.decode(data, "UTF-16LE")))
        .when(charset == "utf-16be", F.when(F.octet_length(data) % 2 == 0, F.decode(data, "UTF-16BE")))
        .when(place > 0, F.when(~single.contains("\ufffd"), single))
    )
    return F.regexp_replace(text, r"^\ufeff?\s*<\?xml[^>]*\?>", "")


def has_root(text: Column, root: str) -> Column:
    """Is the document's outermost element ``root``? Comments, instructions and a document type may come first."""
    return text.rlike(rf"(?s)^(?:\s++|\ufeff|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*+(?:\[.*?\]\s*)?>)*+<{root}[\s/>]")


# -- one Arrow step for formats that need a parser ------------------------------------------


def to_json(files: DataFrame, convert: Callable[[bytes], object]) -> DataFrame:
    """Files with ``data`` as JSON text of what ``convert`` finds; null where that is None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def text(data: bytes | None) -> bytes | None:
            told = convert(data or b"")
            return None if told is None else json.dumps(told, ensure_ascii=False, allow_nan=False).encode("utf-8", "replace")

        for b in batches:
            yield pa.record_batch([b["doc_id"], pa.array([text(x) for x in b["data"].to_pylist()], pa.binary())], ["doc_id", "data"])

    return files.select("doc_id", "data").mapInArrow(run, "doc_id string, data binary")


# -- YAML -----------------------------------------------------------------------------------

MOST_DEPTH, MOST_NODES = 400, 200_000


def yaml_size(text: str, loader: type) -> int | None:
    """How many nodes a document has once its aliases are written out, by its events alone: nothing
    is expanded. None: nested or expanded too far, or an alias inside its own anchor."""
    import yaml

    known: dict[str, int] = {}
    open_: list[list] = [[None, 0]]  # anchor and nodes so far of every open collection
    for e in yaml.parse(text, Loader=loader):
        if isinstance(e, yaml.CollectionStartEvent):
            open_.append([e.anchor, 1])
        elif isinstance(e, yaml.CollectionEndEvent):
            anchor, size = open_.pop()
            open_[-1][1] += size
            if anchor:
                known[anchor] = size
        elif isinstance(e, yaml.ScalarEvent):
            open_[-1][1] += 1
            if e.anchor:
                known[e.anchor] = 1
        elif isinstance(e, yaml.AliasEvent):
            if e.anchor not in known or any(anchor == e.anchor for anchor, _ in open_):
                return None
            open_[-1][1] += known[e.anchor]
        if len(open_) > MOST_DEPTH or open_[-1][1] > MOST_NODES:
            return None
    return open_[0][1]


def plain(value: object) -> object:
    """A YAML value with keys as texts, and null for what JSON doesn't have."""
    if isinstance(value, dict):
        return {k if isinstance(k, str) else json.dumps(k) if k is None or isinstance(k, (bool, int, float)) else str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if value is None or isinstance(value, (str, bool, int, float)) else None


def yaml_converter() -> Callable[[bytes], object]:
    """Typed YAML (null, true, 1, 1.5), dates as text, of repeated keys the last. Documents that are
    no mapping, use unknown tags, or really nest or expand too far give None."""
    import yaml

    base = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    resolvers = {k: [r for r in v if not r[0].endswith(":timestamp")] for k, v in base.yaml_implicit_resolvers.items()}
    loader = type("Typed", (base,), {"yaml_implicit_resolvers": resolvers})

    def convert(data: bytes) -> object:
        try:
            text = data.decode("utf-8").removeprefix("\ufeff")
            brackets = text.count("[") + text.count("{")
            indented = re.search(r"^[ \-?]{%d}" % MOST_DEPTH, text, re.MULTILINE)
            if ("*" in text and "&" in text or brackets > MOST_DEPTH or indented) and yaml_size(text, loader) is None:
                return None
            doc = yaml.load(text, Loader=loader)
            return plain(doc) if isinstance(doc, dict) else None
        except (yaml.YAMLError, ValueError, TypeError, RecursionError, AttributeError):
            return None

    return convert


def yaml_to_json(files: DataFrame) -> DataFrame:
    """Files with ``data`` as JSON text."""
    made: list = []

    def convert(data: bytes) -> object:
        if not made:
            made.append(yaml_converter())
        return made[0](data)

    return to_json(files, convert)


# -- Ruby specifications --------------------------------------------------------------------

SPEC = re.compile(r"Gem::Specification.new +(?:do|\{) +\|.*\|")
ASSIGNED = re.compile(r"\s*\w+\.(\w+)\s*=\s*(.*)")
#: A string, a bracket, a comma, a comment, or anything else, after white space.
TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([\[\],])|(#.*)|(\S))""")
ESCAPE = re.compile(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[0-7]{1,3}|.)", re.DOTALL)
#: What a letter after a backslash stands for.
LETTERS = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\\": "\\", "'": "'", '"': '"'}


def unescaped(m: re.Match) -> str:
    code = m.group(1)
    if code[0] in "xu" and len(code) > 1:
        return chr(int(code[1:], 16))
    return chr(int(code, 8)) if code[0] in "01234567" else LETTERS.get(code, m.group())


def literal(expression: str) -> object:
    """A string or a list of strings and lists; None for anything else. Strings side by side
    are one; an empty or non-literal item voids its list; a comment ends the expression."""
    lists: list[list] = []
    out: list = []  # what stands outside of brackets
    after_value = False
    for m in TOKEN.finditer(expression.replace(".freeze", "")):
        text, mark, comment, other = m.groups()
        here = lists[-1] if lists else out
        if comment:
            break
        if other:
            return None
        if text is not None:
            value = ESCAPE.sub(unescaped, text[1:-1])
            if after_value and isinstance(here[-1], str):
                here[-1] += value
            elif after_value:
                return None
            else:
                here.append(value)
            after_value = True
        elif mark == "[":
            if after_value:
                return None
            lists.append([])
        elif mark == "]":
            if not lists:
                return None
            done = lists.pop()
            (lists[-1] if lists else out).append(done if all(done) else None)
            after_value = True
        else:
            if not lists or not after_value:
                return None
            after_value = False
    return out[0] if len(out) == 1 and not lists else None


def gemspec_converter(data: bytes) -> object:
    """The keys that a specification assigns literals to; the last literal of a key counts."""
    try:
        lines = iter(data.decode("utf-8").split("\n"))
    except UnicodeDecodeError:
        return None
    if not any(SPEC.search(line) for line in lines):  # reads as far as the line that begins it
        return None
    found = ((m.group(1), literal(m.group(2))) for m in map(ASSIGNED.match, lines) if m)
    return {key: value for key, value in found if value}


def gemspec_to_json(files: DataFrame) -> DataFrame:
    return to_json(files, gemspec_converter)
