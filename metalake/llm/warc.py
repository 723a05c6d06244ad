"""WARC archives: write whole-file gzip streams, normalise them to one member per record with
a sidecar offset index, and read records back through the index.

Files go to a folder that driver and executors share, through ``pyarrow.fs`` (any URI scheme
it knows). A task writes under its attempt's own name and reports the name in its output
rows, so a retried task never mixes with a lost one's files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, materialize, new_path

BLOCK = 1 << 20
INDEX = "path string, offset long, length long, record_id string, record_type string"
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_types(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000) -> DataFrame:
    """page_id, url, payload, sha1, record_type, refers_to of every row.

    Of equal payloads of at least ``least`` bytes the largest page_id is the response and the
    others are revisits of it; repeated rows of that page are responses too, and a null id
    ranks last (all null: all responses). Shorter payloads are all responses.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    copies = materialize(
        rows.where(F.col("size") >= least)
        .groupBy("sha1", "size")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .drop("n"),
        "copies",
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(few(copies), ["sha1", "size"], "left").select(
        "page_id", "url", "payload", "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: str) -> int | None:
    number = value.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page_id, url: str, payload: bytes, sha1: str, kind: str, refers_to) -> bytes:
    """One WARC record. A revisit's block ends after the HTTP header, which has the full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + "".join(c if " " < c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_streams(records: DataFrame, folder: str) -> DataFrame:
    """Each partition becomes one whole-file gzip stream; returns (path, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        store, root = fs.FileSystem.from_uri(folder)
        n, out = 0, None
        for b in batches:
            for at in range(b.num_rows):  # one payload at a time, however long they are
                row = [c[at].as_py() for c in b.columns]
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = gzip.GzipFile(fileobj=store.open_output_stream(f"{root}/{name}", compression=None), mode="wb", compresslevel=1, mtime=0)
                out.write(record(*row))
                n += 1
        if out is not None:
            sink = out.fileobj
            out.close()
            sink.close()
            yield pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64())], ["path", "n_records"])

    rows = records.select("page_id", "url", "payload", "sha1", "record_type", "refers_to")
    return materialize(rows.mapInArrow(run, "path string, n_records long"), "streams")


def inflate(raw, block: int = BLOCK) -> Iterator[bytes]:
    """The bytes of a gzip file of one or many members, read once from start to end."""
    engine = zlib.decompressobj(31)
    data = raw.read(block)
    while data:
        if part := engine.decompress(data, block):
            yield part
        data = engine.unconsumed_tail
        if engine.eof:
            data = engine.unused_data or raw.read(block)
            engine = zlib.decompressobj(31)
        data = data or raw.read(block)
    if part := engine.flush():
        yield part


def header_fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])}


def split_records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) in order; holds one record and one block in memory."""
    held, parts = bytearray(), iter(parts)
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            part = next(parts, None)
            if part is None:
                if held.strip():
                    raise ValueError("an archive ends within a record's header")
                return
            held += part
        fields = header_fields(bytes(held[:end]))
        total = end + 4 + int(fields["content-length"]) + 4
        while len(held) < total:
            held += next(parts)
        yield fields, bytes(held[:total])
        del held[:total]


def normalise(streams: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive of ``path`` so that every record is its own gzip member, with an index
    beside it (``.idx``, one JSON line per record); returns (path, n_records) of the new archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for b in batches:
            for path in b["path"].to_pylist():
                source, at = fs.FileSystem.from_uri(path)
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root, recursive=True)
                name = f"{path.rpartition('/')[2].removesuffix('.warc.gz')}-{attempt}.warc.gz"
                n, offset = 0, 0
                with source.open_input_stream(at, compression=None) as raw, store.open_output_stream(f"{root}/{name}", compression=None) as out, store.open_output_stream(f"{root}/{name}.idx", compression=None) as side:
                    for fields, data in split_records(inflate(raw)):
                        member = gzip.compress(data, 6, mtime=0)
                        out.write(member)
                        side.write(json.dumps({"offset": offset, "length": len(member), "id": fields["warc-record-id"], "type": fields["warc-type"]}).encode() + b"\n")
                        n, offset = n + 1, offset + len(member)
                yield pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64())], ["path", "n_records"])

    return materialize(spread(streams.select("path")).mapInArrow(run, "path string, n_records long"), "archives")


def spread(files: DataFrame) -> DataFrame:
    """``files``, one row for each archive, in a task for each: an archive's row is short and its work
    long, so rows must not be put together by their size. Counting them reads a written table."""
    return files.repartitionByRange(max(1, files.count()), "path")


def read_index(archives: DataFrame) -> DataFrame:
    """path, offset, length, record_id and record_type of every record of ``archives`` (path,
    n_records), from their sidecar files; one that lists another number of records raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, n in zip(b["path"].to_pylist(), b["n_records"].to_pylist()):
                store, at = fs.FileSystem.from_uri(path)
                rows, seen = [], 0
                with store.open_input_stream(f"{at}.idx", compression=None) as side:
                    for line in io.BufferedReader(side, BLOCK):
                        told = json.loads(line)
                        rows.append((path, told["offset"], told["length"], told["id"], told["type"]))
                        seen += 1
                        if len(rows) == 4096:
                            yield index_batch(rows)
                            rows = []
                if seen != n:
                    raise ValueError(f"{path}.idx lists {seen} records of {n}")
                if rows:
                    yield index_batch(rows)

    return spread(archives).mapInArrow(run, INDEX)


def index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "offset", "length", "record_id", "record_type"])


def parse_record(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """A row of the result; a response's digest is computed again and must agree."""
    end = data.index(b"\r\n\r\n")
    fields = header_fields(data[:end])
    block = data[end + 4 : end + 4 + int(fields["content-length"])]
    body = block.index(b"\r\n\r\n") + 4
    size = int(header_fields(block[: body - 4])["content-length"])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "response" and (len(block) - body != size or hashlib.sha1(block[body:]).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its header")
    refers = fields.get("warc-refers-to")
    return page_of(fields["warc-record-id"]), size, digest, fields["warc-type"], refers and page_of(refers)


def read_records(index: DataFrame) -> DataFrame:
    """Every indexed record: page_id, payload_bytes, payload_digest, record_type, refers_to. Rows are
    read where they are; rows of an archive that lie together, as :func:`read_index` gives them,
    open it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, io.IOBase] | None = None
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for b in batches:
            rows = []
            for path, offset, length in zip(*(b[c].to_pylist() for c in ("path", "offset", "length"))):
                if opened is None or opened[0] != path:
                    if opened:
                        opened[1].close()
                    store, at = fs.FileSystem.from_uri(path)
                    opened = path, store.open_input_file(at)
                opened[1].seek(offset)
                rows.append(parse_record(gzip.decompress(opened[1].read(length))))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)
        if opened:
            opened[1].close()

    return index.mapInArrow(run, PAGE)


def wrong_revisits(records: DataFrame) -> DataFrame:
    """Revisits of ``records`` whose response is missing or has another digest or length. The
    payloads themselves were checked against the digests when the responses were read."""
    responses = records.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
    return records.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000) -> DataFrame:
    """Writes a record per row, normalises the archives and reads every record back.

    Null html is an empty payload and a null url an empty one; empty input gives no rows;
    further columns are not read. See :func:`record_types` for ties and repeated rows.
    """
    spark = df.sparkSession
    streams = write_streams(record_types(df, id_col, url_col, html_col, least), new_path(spark, "warc-streams"))
    return read_records(read_index(normalise(streams, new_path(spark, "warc"))))
