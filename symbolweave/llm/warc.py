"""WARC archives: writing records, normalising whole-file gzip streams to one member per record, reading by offset."""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE_BYTES = 4 << 20
PIECE = 1 << 16
ARCHIVES = "archive string, content binary"
NORMAL = "archive string, content binary, index array<struct<record_id:string,start:bigint,size:bigint>>"
RECORDS = "archive string, record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"


def _decided(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, url, payload`` and ``first_id``, the smallest id among equal payloads of at least ``least_bytes``."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_digest", F.sha2("payload", 256)).withColumn("_size", F.length("payload"))
    # Ids and digests only are grouped and counted; payloads meet just the groups that hold more than one record.
    first = rows.where(F.col("_size") >= least_bytes).groupBy("_digest", "_size").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    return rows.join(first.where("n > 1").drop("n"), ["_digest", "_size"], "left").select("page_id", "url", "payload", "first_id")


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, first_id) -> bytes:
    """One record: a response with its payload, or a revisit that names the first record and carries the digest only."""
    revisit = first_id is not None and first_id != page_id
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        clean = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in url)
        lines.append(f"WARC-Target-URI: {clean}")
    lines += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first_id}>"]
    block = b"" if revisit else payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``(archive, content)``: the pages as WARC archives, each one gzip stream of about ``archive_bytes`` of records.

    ``pages(page_id, url, html)``; other columns are not read. A null page is an empty payload, a null url leaves its
    header out. Of equal payloads the smallest id is the response; all rows with that id are. A null id revisits if
    another id holds its payload, else it is a response. An empty table gives no archives.
    """
    def run(batches):
        packer, raw, parts = None, 0, []
        for batch in batches:
            for page_id, url, payload, first_id in zip(*(c.to_pylist() for c in batch.columns)):
                packer = packer or zlib.compressobj(6, zlib.DEFLATED, 31)
                record = record_bytes(page_id, url, payload, first_id)
                parts.append(packer.compress(record))
                raw += len(record)
                if raw >= archive_bytes:
                    yield _batch({"archive": [uuid.uuid4().hex], "content": [b"".join(parts) + packer.flush()]}, _ARCHIVES)
                    packer, raw, parts = None, 0, []
        if packer:
            yield _batch({"archive": [uuid.uuid4().hex], "content": [b"".join(parts) + packer.flush()]}, _ARCHIVES)

    return _decided(pages, least_bytes).mapInArrow(run, ARCHIVES)


def inflate(content: bytes) -> Iterator[bytes]:
    """The bytes of a gzip file, of one member or many, in pieces; the file is inflated once."""
    work, at = zlib.decompressobj(31), 0
    while at < len(content):
        piece = content[at : at + PIECE]
        at += len(piece)
        while piece:
            data = work.decompress(piece, PIECE * 16)
            if data:
                yield data
            if work.eof:
                piece = work.unused_data
                work = zlib.decompressobj(31)
            else:
                piece = work.unconsumed_tail


def split_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict, bytes, bytes]]:
    """``(headers, block, record)`` of each record of a stream; header names in lower case."""
    held, pieces = bytearray(), iter(pieces)

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends inside a record's header")
                return
        headers = {}
        for line in held[:end].decode("utf-8").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        whole = end + 4 + int(headers["content-length"]) + 4
        while len(held) < whole:
            if not more():
                raise ValueError("an archive ends inside a record's block")
        record = bytes(held[:whole])
        del held[:whole]
        yield headers, record[end + 4 : -4], record


def normalise(archives: DataFrame) -> DataFrame:
    """``(archive, content, index)``: every record as its own gzip member, with the offset and size of each member.

    ``archives(archive, content)`` come from ``write_archives`` or from files read as binary. A stream is inflated in
    pieces; besides the archive itself, one record is held at a time.
    """
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out, index, at = [], [], 0
                for headers, _, record in split_records(inflate(content or b"")):
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    index.append({"record_id": headers.get("warc-record-id"), "start": at, "size": len(member)})
                    out.append(member)
                    at += len(member)
                yield _batch({"archive": [name], "content": [b"".join(out)], "index": [index]}, _NORMAL)

    return archives.select("archive", "content").mapInArrow(run, NORMAL)


def read_records(normal: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of normalised archives, each read from its own member by the offset index.

    Digests of responses are computed from the payload read; a revisit has the digest and size of its header.
    """
    def run(batches):
        for batch in batches:
            for name, content, index in zip(*(c.to_pylist() for c in batch.columns)):
                out = {f.name: [] for f in _RECORDS}
                for entry in index or []:
                    member = content[entry["start"] : entry["start"] + entry["size"]]
                    for headers, block, _ in split_records([zlib.decompress(member, 31)]):
                        revisit = headers["warc-type"] == "revisit"
                        out["archive"].append(name)
                        out["record_id"].append(_id(headers.get("warc-record-id")))
                        out["record_type"].append(headers["warc-type"])
                        out["target_uri"].append(headers.get("warc-target-uri"))
                        out["refers_to"].append(_id(headers.get("warc-refers-to")))
                        out["payload_digest"].append(headers["warc-payload-digest"].removeprefix("sha1:") if revisit else digest_of(block))
                        out["payload_bytes"].append(int(headers["x-payload-length"]) if revisit else len(block))
                        out["payload"].append(block if payloads else None)
                yield _batch(out, _RECORDS)

    return normal.select("archive", "content", "index").mapInArrow(run, RECORDS)


def _id(value: str | None) -> str | None:
    """The page of a record's identifier, or the identifier itself if it is another's."""
    if value is None:
        return None
    inner = value.strip("<>")
    return (inner.removeprefix("urn:page:") or None) if inner.startswith("urn:page:") else inner


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_ARCHIVES = pa.schema([("archive", pa.string()), ("content", pa.binary())])
_NORMAL = pa.schema([
    ("archive", pa.string()), ("content", pa.binary()),
    ("index", pa.list_(pa.struct([("record_id", pa.string()), ("start", pa.int64()), ("size", pa.int64())]))),
])
_RECORDS = pa.schema([
    (name, pa.int64() if name == "payload_bytes" else pa.binary() if name == "payload" else pa.string())
    for name in ("archive", "record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")
])
