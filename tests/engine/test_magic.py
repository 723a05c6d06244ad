"""MIME types by the tree of tests, against a plain walk over the same rules."""

import io
import random
import re
import zipfile

from metalake.functions import magic
from metalake.functions import scalars as S
from metalake.operators import content

ELF = b"\x7fELF\x02"


def zipped(*names, first=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        if first:
            z.writestr("mimetype", first)
        for n in names:
            z.writestr(n, "content")
    return out.getvalue()


def walked(data):
    """The type by looking at every rule in turn."""

    def at(offset):
        if isinstance(offset, int):
            return offset
        return int.from_bytes(data[offset[1] : offset[1] + 4], "little") + offset[2]

    def true(test):
        kind, *told = test
        if kind == "find":
            return re.search(told[0], data[: magic.HEAD].decode("latin-1")) is not None
        place = at(told[0])
        if kind == "bytes":
            mark = bytes.fromhex(told[1])
            return data[place : place + len(mark)] == mark
        if kind == "mask":
            mask, mark = bytes.fromhex(told[1]), bytes.fromhex(told[2])
            return len(data) >= place + len(mark) and bytes(a & m for a, m in zip(data[place:], mask)) == mark
        width = int(told[1][1:3].rstrip("lb")) // 8
        part = data[place : place + width]
        n = int.from_bytes(part, "little" if told[1].endswith("le") else "big")
        return len(part) == width and {"=": n == told[3], "<": n < told[3], ">": n > told[3]}[told[2]]

    def down(nodes, name):
        for test, own, below in nodes:
            if true(test):
                return down(below, own)
        return name

    for offset, mark, mime in S.SIGNATURES:
        if data[offset : offset + len(mark) // 2].hex().upper() == mark:
            return down(magic.TREE.get(mime, []), mime)
    return None


def kinds(spark, files):
    rows = spark.createDataFrame(list(enumerate(files)), "id int, data binary")
    return {r.id: (r.mimetype, r.encoding) for r in content.mimetypes(rows).collect()}


def test_nested_kinds(spark):
    known = [
        (zipped("a"), "application/zip"), (zipped("a", first="application/epub+zip"), "application/epub+zip"), (zipped("content.xml", first="application/vnd.oasis.opendocument.text"), "application/vnd.oasis.opendocument.text"),
        (zipped("[Content_Types].xml", "_rels/.rels", "word/document.xml"), "application/vnd.openxmlformats-officedocument.wordprocessingml.document"), (zipped("[Content_Types].xml", "xl/workbook.xml"), "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
        (zipped("word/x"), "application/zip"), (zipped("META-INF/MANIFEST.MF", "a.class"), "application/java-archive"), (zipped("AndroidManifest.xml", "META-INF/x"), "application/vnd.android.package-archive"),
        (bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 2000 + "WordDocument".encode("utf-16-le"), "application/msword"), (bytes.fromhex("D0CF11E0A1B11AE1"), "application/vnd.ms-office"),
        (ELF + b"\x01" + b"\0" * 10 + b"\x03\0", "application/x-sharedlib"), (ELF + b"\x02" + b"\0" * 11 + b"\x01", "application/x-object"), (ELF + b"\x01" + b"\0" * 10 + b"\x02\0", "application/x-executable"), (ELF, "application/x-executable"),
        (b"MZ" + b"\0" * 58 + (128).to_bytes(4, "little") + b"\0" * 64 + b"PE\0\0", "application/vnd.microsoft.portable-executable"), (b"MZ" + b"\xff" * 70, "application/x-dosexec"),
        (bytes.fromhex("CAFEBABE00000002"), "application/x-mach-binary"), (bytes.fromhex("CAFEBABE00000041"), "application/java-vm"), (b"\0\0\0\x18ftypavif", "image/avif"), (b"\0\0\0\x18ftypisom", "video/mp4"), (b"\0\0\0\x18ftypqt  ", "video/quicktime"),
        (bytes.fromhex("1A45DFA3") + b"\x01\0\x42\x82\x88matroska", "video/x-matroska"), (b"!<arch>\ndebian-binary   ", "application/vnd.debian.binary-package"), (b"PAR1\x15", "application/vnd.apache.parquet"),
    ]
    got = kinds(spark, [d for d, _ in known])
    assert [got[k] for k in range(len(known))] == [(m, "binary") for _, m in known]
    assert all(walked(d) == m for d, m in known)


def test_agrees_with_a_walk_of_all_rules(spark):
    rng = random.Random(6)
    files = []
    for offset, mark, _ in S.SIGNATURES:
        for _ in range(8):
            data = bytearray(rng.choice([b"\0", b"\x01\x02", bytes(range(7))]) * 200)[: rng.randint(offset + len(mark) // 2, 300)].ljust(offset + len(mark) // 2, b"\0")
            data[offset : offset + len(mark) // 2] = bytes.fromhex(mark)
            if rng.random() < 0.5 and len(data) > 20:
                place = rng.choice([p for p in (4, 5, 8, 14, 16, 18) if not offset <= p < offset + len(mark) // 2])
                data[place] = rng.choice([0, 1, 2, 3, 4, 67, 113])
            files.append(bytes(data))
    got = kinds(spark, files)
    assert all(walked(d) for d in files)
    assert [(d, got[k][0], walked(d)) for k, d in enumerate(files) if got[k][0] != walked(d)] == []
