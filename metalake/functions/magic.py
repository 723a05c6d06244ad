"""Refines the MIME type of leading marks by a tree of tests.

A node is (test, MIME type, nodes below it). Under a node that holds, its nodes are tried in
order, and the first that holds decides further; if none does, the node's own type stays. Tests:

* ``("bytes", offset, hex)``: these bytes stand there;
* ``("mask", offset, mask, hex)``: so do the bytes under a mask;
* ``("int", offset, kind, comparison, number)``: kind is u8, u16le, u16be, u32le or u32be;
* ``("find", pattern)``: a pattern in the first ``HEAD`` bytes, one character a byte.

An offset is a number, or ``("u32le", place, more)``: the number that stands at a place, plus more.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD = 65_536
WIDTHS = {"u8": 1, "u16le": 2, "u16be": 2, "u32le": 4, "u32be": 4}


def wide(text: str) -> str:
    """Pattern of a name in UTF-16, as directories of compound files hold it."""
    return "".join(f"{c}\\x00" for c in text)


def entry(name: str) -> tuple:
    """A file of a ZIP archive whose name begins like this, by its local header."""
    return ("find", rf"(?s)PK\x03\x04.{{26}}{name}")


#: MIME types of a mark and of what stands behind it.
TREE: dict[str, list] = {
    "application/zip": [
        (("bytes", 26, "08000000"), "application/zip", [
            (("find", rf"(?s)^PK\x03\x04.{{26}}mimetype{kind}"), kind.replace("\\", ""), []) for kind in (
                r"application/epub\+zip", r"application/vnd\.oasis\.opendocument\.text", r"application/vnd\.oasis\.opendocument\.spreadsheet", r"application/vnd\.oasis\.opendocument\.presentation", r"application/vnd\.oasis\.opendocument\.graphics")
        ]),
        (entry(r"\[Content_Types\]\.xml"), "application/zip", [
            (entry("word/"), "application/vnd.openxmlformats-officedocument.wordprocessingml.document", []),
            (entry("xl/"), "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", []),
            (entry("ppt/"), "application/vnd.openxmlformats-officedocument.presentationml.presentation", []),
        ]),
        (entry(r"AndroidManifest\.xml"), "application/vnd.android.package-archive", []),
        (entry(r"META-INF/"), "application/java-archive", []),
    ],
    "application/vnd.ms-office": [
        (("find", wide("WordDocument")), "application/msword", []), (("find", wide("Workbook")), "application/vnd.ms-excel", []), (("find", wide("PowerPoint Document")), "application/vnd.ms-powerpoint", []),
    ],
    "application/x-executable": [
        (("bytes", 5, "01"), "application/x-executable", [(("int", 16, "u16le", "=", 1), "application/x-object", []), (("int", 16, "u16le", "=", 3), "application/x-sharedlib", []), (("int", 16, "u16le", "=", 4), "application/x-coredump", [])]),
        (("bytes", 5, "02"), "application/x-executable", [(("int", 16, "u16be", "=", 1), "application/x-object", []), (("int", 16, "u16be", "=", 3), "application/x-sharedlib", []), (("int", 16, "u16be", "=", 4), "application/x-coredump", [])]),
    ],
    "application/x-dosexec": [(("bytes", ("u32le", 60, 0), "50450000"), "application/vnd.microsoft.portable-executable", [])],
    "application/java-vm": [(("int", 4, "u32be", "<", 43), "application/x-mach-binary", [])],
    "video/mp4": [
        (("find", r"(?s)^.{8}(heic|heix|mif1)"), "image/heic", []), (("find", r"(?s)^.{8}avif"), "image/avif", []), (("bytes", 8, "71742020"), "video/quicktime", []), (("bytes", 8, "4D344120"), "audio/x-m4a", []), (("bytes", 8, "336770"), "video/3gpp", []),
    ],
    "video/webm": [(("find", r"(?s)^.{4,60}matroska"), "video/x-matroska", [])],
    "audio/ogg": [(("bytes", 28, "807468656F7261"), "video/ogg", [])],
    "image/tiff": [(("bytes", 8, "4352"), "image/x-canon-cr2", [])],
    "application/x-archive": [(("bytes", 8, "64656269616E2D62696E617279"), "application/vnd.debian.binary-package", [])],
    "image/png": [(("find", r"(?s)^.{37,4096}acTL"), "image/apng", [])],
}


def number(data: Column, offset: Column, kind: str) -> Column:
    """The number at an offset; null beyond the end."""
    width = WIDTHS[kind]
    digits = [F.hex(F.substring(data, offset + 1 + i, F.lit(1))) for i in range(width)]
    whole = F.concat(*(reversed(digits) if kind.endswith("le") else digits))
    return F.when(F.length(whole) == 2 * width, F.conv(whole, 16, 10).cast("long"))


def place(data: Column, offset) -> Column:
    if isinstance(offset, int):
        return F.lit(offset)
    kind, at, more = offset
    where = number(data, F.lit(at), kind) + more
    return F.when(where < (1 << 31) - 64, where.cast("int"))


def holds(data: Column, test: tuple) -> Column:
    """Does a test hold? False where it looks beyond the end."""
    kind, *told = test
    if kind == "find":
        found = F.decode(F.substring(data, 1, HEAD), "ISO-8859-1").rlike(told[0])
    elif kind == "int":
        offset, how, comparison, value = told
        n = number(data, place(data, offset), how)
        found = {"=": n == value, "<": n < value, ">": n > value}[comparison]
    elif kind == "bytes":
        offset, mark = told
        found = F.hex(F.substring(data, place(data, offset) + 1, F.lit(len(mark) // 2))) == mark
    else:
        offset, mask, mark = told
        at = place(data, offset)
        bytes_ = [number(data, at + i, "u8").bitwiseAND(F.lit(m)) == b for i, (m, b) in enumerate(zip(bytes.fromhex(mask), bytes.fromhex(mark)))]
        found = F.lit(True)
        for b in bytes_:
            found = found & b
    return F.coalesce(found, F.lit(False))


def decided(data: Column, nodes: list, kind: Column) -> Column:
    out = F
    for test, name, below in nodes:
        out = out.when(holds(data, test), decided(data, below, F.lit(name)) if below else F.lit(name))
    return out.otherwise(kind) if nodes else kind


def refined(data: Column, kind: Column) -> Column:
    """The type that the tree under ``kind`` gives."""
    out = F
    for base, nodes in TREE.items():
        out = out.when(kind == base, decided(data, nodes, kind))
    return out.otherwise(kind)
