"""WARC archives: writing, normalising of monolithic gzip files, reading by offset.

Many tools compress a whole WARC file as one gzip stream, in which no record can be reached
without inflating all before it. The normaliser inflates such a file once, from front to back,
writes every record as a gzip member of its own, and a sidecar index with a line per record:
offset, length, type, record id. Records go through it in pieces, so neither a large file nor a
large record is held in memory. Files are the unit of work, one task each; every attempt writes
files of its own, and only those in a table that Spark has committed are read on.

Of records with equal payloads that with the largest page_id is a response; the others are
revisits that name it and carry no payload, but its digest and length.

Defined results for odd input: a null page is an empty payload; a null page_id is written as
"none" and is the largest of its payload only if no other has an id, then all of them are
responses; rows that repeat the largest id are responses each; line ends in addresses are
escaped, a null address is left out; an empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import partitions
from tallygrid.llm.storage import Output, read_range, system, unique
from tallygrid.staging import Staging

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PREFIX = "urn:x-page:"
LEVEL = 1
FILE_BYTES = 64 << 20
PIECE = 1 << 18

FILES = "path string, records long, bytes long"
_FILES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
PLACES = "path string, sidecar string, records long, bytes long"
_PLACES = pa.schema(
    [("path", pa.string()), ("sidecar", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]
)
ROWS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, path string, offset long, length long"
)
_ROWS = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ]
)


def digest(payload: bytes) -> str:
    """SHA-1 in base 32, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_originals(pages: DataFrame, staging: Staging, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to, the id of the record that a page revisits."""
    payload = F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha"),
    )
    groups = staging.write(
        "equal_payloads",
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("sha", "original"),
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    return rows.join(groups, "sha", "left").select(
        "page_id", "url", "payload", refers.alias("refers_to")
    )


def _name(page_id: int | None) -> str:
    return f"<{PREFIX}{'none' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    found = (name or "").strip("<>").removeprefix(PREFIX)
    return None if found in ("", "none") else int(found)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit of another page without it."""
    revisit = refers_to is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if revisit else http + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        safe = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        fields.append(f"WARC-Target-URI: {safe}")
    if revisit:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    fields += [
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = (line.partition(":") for line in lines[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in fields}


# --- writing and normalising


def write_monolithic(pages: DataFrame, folder: str, staging: Staging) -> DataFrame:
    """Archives of about ``FILE_BYTES`` before compression, each one gzip stream; a row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, out, gzip, path, records, size = [], None, None, "", 0, 0

        def finish() -> None:
            out.write(gzip.flush())
            out.close()
            made.append({"path": path, "records": records, "bytes": out.place})

        for batch in batches:
            for page_id, url, payload, refers_to in zip(
                *(batch.column(i).to_pylist() for i in (0, 1)),
                batch.column(2),
                batch.column(3).to_pylist(),
                strict=True,
            ):
                if out is None:
                    path, records, size = unique(folder, ".warc.gz"), 0, 0
                    out, gzip = Output(path), zlib.compressobj(LEVEL, wbits=31)
                data = record(page_id, url, payload.as_py(), refers_to)
                out.write(gzip.compress(data))
                records, size = records + 1, size + len(data)
                if size >= FILE_BYTES:
                    finish()
                    out = None
        if out is not None:
            finish()
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_FILES)

    return staging.write("monolithic", pages.mapInArrow(run, FILES))


def inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file, of one member or many, in bounded pieces."""
    gzip = zlib.decompressobj(wbits=31)
    for piece in pieces:
        while piece:
            yield gzip.decompress(piece, PIECE)
            piece = gzip.unconsumed_tail
            if gzip.eof:
                piece = gzip.unused_data
                gzip = zlib.decompressobj(wbits=31)
    yield gzip.flush()


def rewrite(pieces: Iterator[bytes], write: Callable[[bytes], int]) -> Iterator[tuple[int, int, str, str]]:
    """Write every record of a stream as its own member; yield offset, length, type and id.

    ``write`` takes bytes and returns the place after them.
    """
    held, place = b"", 0
    source = inflated(pieces)

    def more() -> bool:
        nonlocal held
        for piece in source:
            if piece:
                held += piece
                return True
        return False

    while True:
        while b"\r\n\r\n" not in held:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a record")
                return
        head, _, held = held.partition(b"\r\n\r\n")
        fields = parse_head(head.lstrip(b"\r\n"))
        gzip, start = zlib.compressobj(LEVEL, wbits=31), place
        place = write(gzip.compress(head.lstrip(b"\r\n") + b"\r\n\r\n"))
        left = int(fields["content-length"]) + 4
        while left:
            if not held and not more():
                raise ValueError("the archive ends within a record")
            part, held = held[:left], held[left:]
            left -= len(part)
            place = write(gzip.compress(part))
        place = write(gzip.flush())
        yield start, place - start, fields["warc-type"], fields["warc-record-id"]


def _pieces(location: str) -> Iterator[bytes]:
    files, path = system(location)
    with files.open_input_stream(path, compression=None) as f:
        while piece := f.read(PIECE):
            yield piece


def normalised(archives: DataFrame, folder: str, staging: Staging) -> DataFrame:
    """Archives with a member per record and their sidecar indexes; a row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = unique(folder, ".warc.gz")
                sidecar = target.removesuffix(".warc.gz") + ".idx"
                out, index, records = Output(target), Output(sidecar), 0

                def write(data: bytes, out: Output = out) -> int:
                    out.write(data)
                    return out.place

                for entry in rewrite(_pieces(path), write):
                    index.write((" ".join(map(str, entry)) + "\n").encode())
                    records += 1
                out.close()
                index.close()
                row = {"path": target, "sidecar": sidecar, "records": records, "bytes": out.place}
                yield pa.RecordBatch.from_pylist([row], schema=_PLACES)

    n = partitions(archives.sparkSession)
    dealt = archives.select("path").repartition(n, "path")
    return staging.write("normalised", dealt.mapInArrow(run, PLACES))


# --- reading


def read_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and body of a record that is a member of its own."""
    content = zlib.decompress(data, wbits=31)
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = parse_head(head)
    return fields, rest[: int(fields["content-length"])]


def _page(fields: dict[str, str], body: bytes) -> dict:
    http, _, payload = body.partition(b"\r\n\r\n")
    stated = next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and digest(payload) != named:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    url = fields.get("warc-target-uri")
    return {
        "page_id": _number(fields["warc-record-id"]),
        "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload_bytes": int(stated.split(b":")[1]),
        "payload_digest": named,
        "record_type": fields["warc-type"],
        "refers_to": _number(fields.get("warc-refers-to")),
    }


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record, each read at the place that the sidecar index gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                files, path = system(r["path"])
                index_files, sidecar = system(r["sidecar"])
                rows, seen = [], 0
                with files.open_input_file(path) as f, index_files.open_input_stream(sidecar, compression=None) as index:
                    for line in _lines(index):
                        offset, length = map(int, line.split(b" ")[:2])
                        fields, body = read_record(f.read_at(length, offset))
                        seen += 1
                        if fields["warc-type"] in ("response", "revisit"):
                            rows.append(_page(fields, body) | {"path": r["path"], "offset": offset, "length": length})
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)
                            rows = []
                if seen != r["records"]:
                    raise ValueError(f"the index of {r['path']} is incomplete")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)

    n = partitions(archives.sparkSession)
    return archives.repartition(n, "path").mapInArrow(run, ROWS)


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while piece := stream.read(PIECE):
        *lines, held = (held + piece).split(b"\n")
        yield from lines
    if held:
        yield held


def read_at(path: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of a normalised archive."""
    return read_record(read_range(path, offset, length))


def warc_table(pages: DataFrame, staging: Staging) -> DataFrame:
    """Write all pages, normalise the archives, read them back."""
    written = write_monolithic(
        with_originals(pages, staging), f"{staging.folder}/warc_monolithic", staging
    )
    archives = normalised(written, f"{staging.folder}/warc", staging)
    return read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
