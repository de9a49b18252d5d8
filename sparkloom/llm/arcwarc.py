"""Legacy archives to WARC.

ARC files hold a version block and then records: a header line whose fields
depend on that version, and as many bytes as the line declares.  The converter
parses them and makes WARC/1.1 records: identifiers derived from the content,
ISO timestamps, a type (warcinfo for version blocks, response for HTTP, revisit
for a payload that another record holds, resource for the rest), and SHA-1
digests of block and payload.

Every record is a gzip member of its own, as such archives are kept.  Files are
written with Spark's text writer, a file's bytes a row (the zero byte behind it is
padding to gzip), and read as binary files, so they may lie in any store that Spark
reaches; a file holds records of at most ``FILE_BYTES`` (or one record), whatever their number.

Scale.  Which record holds a payload is found from digests alone, summed map-side.
The converter reads the files once more, beside a list of each file's revisits:
that list is broadcast if it's under ``BROADCAST_ROWS`` rows, else files and lists are joined
by path, which moves compressed files, never a payload on its own.  The memory of a
task follows the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_schema, dropped, fresh_path, staged

FILE_BYTES = 16_000_000  # of records before compression
BROADCAST_ROWS = 100_000
READ_BYTES = 1 << 14
GZIP = 31  # zlib's window bits for gzip members
LEAST_REVISIT = 1000
START = datetime(2000, 1, 1, tzinfo=timezone.utc)

# The fields of a header line by version.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}


def sha1_hex(data: bytes) -> str:
    return hashlib.sha1(data).hexdigest()


def labelled_digest(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_digest(labelled: str) -> str:
    return base64.b32decode(labelled.removeprefix("sha1:")).hex()


def record_id(*parts: str) -> str:
    """A name-based identifier: the same record gets the same one in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(parts))}>"


def plain_url(url: str | None) -> str:
    """A URL without blanks or control characters, as a header line needs it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "unknown:"


def member(data: bytes) -> bytes:
    """A gzip member."""
    packer = zlib.compressobj(3, zlib.DEFLATED, GZIP)
    return packer.compress(data) + packer.flush()


def members(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, data) of each gzip member; zero bytes behind one are padding."""
    view, at = memoryview(content), 0
    while at < len(content):
        if not content[at]:
            at += 1
            continue
        begin, unpacker, parts = at, zlib.decompressobj(GZIP), []
        while not unpacker.eof:
            if at >= len(content):
                raise ValueError(f"the member at byte {begin} is cut short")
            parts.append(unpacker.decompress(view[at : at + READ_BYTES]))
            at += len(view[at : at + READ_BYTES])
        at -= len(unpacker.unused_data)
        yield begin, b"".join(parts)


# ARC


def arc_version_block(version: int, name: str) -> bytes:
    """The record that opens a file and says how the lines behind it read."""
    title = f"{version} 0 sparkloom\n{' '.join(ARC_FIELDS[version])}\n".encode()
    stamp = START.strftime("%Y%m%d%H%M%S")
    line = f"filedesc://{name} 0.0.0.0 {stamp} text/plain{' 200 - - 0 ' + name if version == 2 else ''} {len(title)}\n"
    return line.encode() + title + b"\n"


def arc_record(page_id: int | None, url: str | None, payload: bytes, version: int, name: str, at: int) -> bytes:
    """A page as a record of a file ``name``, at byte ``at`` of it."""
    own = b"" if page_id is None else f"X-Page-Id: {page_id}\r\n".encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    seconds = (page_id or 0) % (1 << 30)
    date = (START + timedelta(seconds=seconds)).strftime("%Y%m%d%H%M%S")
    middle = f" 200 {sha1_hex(payload)[:8]} - {at} {name}" if version == 2 else ""
    return f"{plain_url(url)} 0.0.0.0 {date} text/html{middle} {len(block)}\n".encode() + block + b"\n"


def arc_segment(records: list[tuple[int | None, str | None, bytes]], version: int, name: str) -> bytes:
    """A version block and the records (page id, URL, payload) behind it, uncompressed."""
    out = [arc_version_block(version, name)]
    at = len(out[0])
    for page_id, url, payload in records:
        out.append(arc_record(page_id, url, payload, version, name, at))
        at += len(out[-1])
    return b"".join(out)


def unpacked(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of each gzip member of a file, or of the whole file if it isn't compressed."""
    return members(content) if content[:2] == b"\x1f\x8b" else iter([(0, content)])


def arc_file_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``arc_records`` of a file with or without compression; a place counts members' bytes, then those inside."""
    version = [1]
    for place, data in unpacked(content):
        for at, fields, block in arc_records(data, version):
            yield place + at, fields, block


def arc_records(content: bytes, state: list[int] | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, fields, block) of each record; a version block sets the fields of the lines behind it (and ``state``)."""
    at, state = 0, state or [1]
    while at < len(content):
        if content[at : at + 1] == b"\n":  # the line feed that ends a record
            at += 1
            continue
        end = content.index(b"\n", at)
        line = content[at:end].decode("utf-8", "replace")
        values = line.split(" ")
        length = int(values[-1])
        block = content[end + 1 : end + 1 + length]
        if len(block) != length:
            raise ValueError(f"the record at byte {at} is cut short")
        if line.startswith("filedesc:"):
            state[0] = int(block.split(b" ", 1)[0])
            fields = dict(zip(ARC_FIELDS[1], values[:4] + values[-1:]))
        elif len(values) != len(ARC_FIELDS[state[0]]):
            raise ValueError(f"the header line at byte {at} has {len(values)} fields, version {state[0]} has {len(ARC_FIELDS[state[0]])}")
        else:
            fields = dict(zip(ARC_FIELDS[state[0]], values))
        yield at, fields, block
        at = end + 1 + length


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """(head with its empty line, payload) of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None
    cut = block.find(b"\r\n\r\n")
    return (block, b"") if cut < 0 else (block[: cut + 4], block[cut + 4 :])


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"^" + name.encode() + rb":\s*(.*?)\r?$", head, re.I | re.M)
    return m[1].decode() if m else None


# WARC


def warc_date(arc_date: str) -> str:
    return datetime.strptime(arc_date[:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(fields: dict[str, str], block: bytes, refers: tuple[str, str, str] | None) -> bytes:
    """A WARC record, without the two line ends behind it; ``refers``: id, URI and date of the record that holds the payload."""
    date = warc_date(fields["Archive-date"])
    parts = http_parts(block)
    version_block = fields["URL"].startswith("filedesc:")
    kind = "warcinfo" if version_block else "resource" if parts is None else "revisit" if refers else "response"
    payload = block if parts is None else parts[1]
    digest = sha1_hex(payload)
    body = block if kind != "revisit" else parts[0]
    head = [("WARC-Type", kind), ("WARC-Record-ID", own_id(fields, block)), ("WARC-Date", date)]
    if not version_block:
        head += [("WARC-Target-URI", fields["URL"]), ("WARC-IP-Address", fields["IP-address"])]
    head.append(("WARC-Block-Digest", labelled_digest(sha1_hex(body))))
    if parts is not None:
        head.append(("WARC-Payload-Digest", labelled_digest(digest)))
    if kind == "revisit":
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", refers[0]), ("WARC-Refers-To-Target-URI", refers[1]), ("WARC-Refers-To-Date", refers[2]),
        ]
    head.append(("Content-Type", "application/http; msgtype=response" if parts is not None else fields["Content-type"]))
    head.append(("Content-Length", str(len(body))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body


def own_id(fields: dict[str, str], block: bytes) -> str:
    return record_id(fields["URL"], fields["Archive-date"], sha1_hex(block))


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a file, by declared lengths; digests are checked."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        length = int(fields["Content-Length"])
        block = content[end + 4 : end + 4 + length]
        if labelled_digest(sha1_hex(block)) != fields["WARC-Block-Digest"]:
            raise ValueError(f"the block of {fields['WARC-Record-ID']} doesn't have its digest")
        yield fields, block
        at = end + 4 + length
        if content[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} doesn't end")
        at += 4


def warc_file_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``warc_records`` of a file with or without compression."""
    for _, data in unpacked(content):
        yield from warc_records(data)


# Spark


def _arc_files(batches):
    """One ARC file a row, each record a gzip member; versions 1 and 2 in turn."""
    from pyspark import TaskContext

    part, number, out, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, html = (c[i].as_py() for c in batch.columns)
            version, name = 1 + number % 2, f"pages-{part:05d}-{number:05d}.arc"
            if not out:
                block = arc_version_block(version, name)
                out, size = [member(block)], len(block)
            record = arc_record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), version, name, size)
            out.append(member(record))
            size += len(record)
            if size >= FILE_BYTES:
                yield _one(b"".join(out), "arc")
                number, out = number + 1, []
    if out:
        yield _one(b"".join(out), "arc")


def _one(data: bytes, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=[name])


def _write_files(files: DataFrame, path: str) -> None:
    """Each row of the one binary column as a file; the text writer's line end is a zero byte, which gzip takes as padding."""
    files.select(F.col(files.columns[0]).cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write pages as ARC files; a null html is an empty payload, a null id isn't named."""
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    _write_files(rows.mapInArrow(_arc_files, "arc binary"), path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def _found(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for at, fields, block in arc_file_records(content.as_py()):
                    parts = http_parts(block)
                    if parts:
                        page = http_field(parts[0], "X-Page-Id")
                        rows.append({
                            "path": path, "at": at, "page_id": None if page is None else int(page), "digest": sha1_hex(parts[1]), "bytes": len(parts[1]),
                            "record": own_id(fields, block), "uri": fields["URL"], "date": warc_date(fields["Archive-date"]),
                        })
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _warc_files(batches):
    """WARC files, each record a gzip member, of ARC files (content, revisits); a revisit names the place of its record and what it refers to."""
    for batch in batches:
        for content, revisits in zip(*batch.columns):
            refers = {r["at"]: (r["record"], r["uri"], r["date"]) for r in revisits.as_py() or ()}
            out, size = [], 0
            for at, fields, block in arc_file_records(content.as_py()):
                record = warc_record(fields, block, refers.get(at)) + b"\r\n\r\n"
                out.append(member(record))
                size += len(record)
                if size >= FILE_BYTES:
                    yield _one(b"".join(out), "warc")
                    out, size = [], 0
            if out:
                yield _one(b"".join(out), "warc")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_REVISIT) -> None:
    """Convert the ARC files in ``arc_path`` to WARC files in ``warc_path``.

    Of the records with equal payloads of at least ``least`` bytes, that with the largest page id is
    the response (a null id is the smallest; then the last place decides), the others revisit it.
    """
    ddl = "path string, at long, page_id long, digest string, bytes long, record string, uri string, date string"
    found = staged(_files(spark, arc_path).mapInArrow(_found(arrow_schema(ddl)), ddl), "arc-records")
    place = F.struct("path", "at")
    rank = F.struct(F.coalesce("page_id", F.lit(-(2**63))), place)
    of_payload = found.where(F.col("bytes") >= least).groupBy("digest", "bytes")
    held = of_payload.agg(F.max_by(F.struct("path", "at", "record", "uri", "date"), rank).alias("r"), F.count("*").alias("n")).where("n > 1")
    refers = found.join(held.select("digest", "bytes", "r"), ["digest", "bytes"]).where((F.col("path") != F.col("r.path")) | (F.col("at") != F.col("r.at")))
    # a file holds a bounded number of bytes, so a bounded number of revisits of ``least`` bytes or more
    revisits = staged(refers.groupBy("path").agg(F.collect_list(F.struct("at", "r.record", "r.uri", "r.date")).alias("revisits")), "revisits")
    rows = revisits.agg(F.sum(F.size("revisits"))).first()[0] or 0
    files = _files(spark, arc_path)
    joined = files.join(F.broadcast(revisits) if rows <= BROADCAST_ROWS else revisits, "path", "left").select("content", "revisits")
    _write_files(joined.mapInArrow(_warc_files, "warc binary"), warc_path)


def _read(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for fields, block in warc_file_records(content.as_py()):
                    parts = http_parts(block)
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    page = http_field(parts[0], "X-Page-Id")
                    digest = hex_digest(fields["WARC-Payload-Digest"])
                    if fields["WARC-Type"] == "response" and sha1_hex(parts[1]) != digest:
                        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't have its digest")
                    # a revisit keeps the head of the response, and so the length of the payload
                    size = len(parts[1]) if fields["WARC-Type"] == "response" else int(http_field(parts[0], "Content-Length"))
                    rows.append({
                        "page_id": None if page is None else int(page), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
                        "record": fields["WARC-Record-ID"], "refers": fields.get("WARC-Refers-To"),
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id)."""
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, record string, refers string"
    rows = staged(_files(spark, path).mapInArrow(_read(arrow_schema(ddl)), ddl), "warc-records")
    # repeated rows make records with one id; they are equal in all that is read here
    holders = rows.where("record_type = 'response'").groupBy("record").agg(F.max("page_id").alias("refers_to")).withColumnRenamed("record", "refers")
    return rows.join(holders, "refers", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as ARC, convert to WARC, read that back: one row per page; other columns aren't read."""
    spark = pages.sparkSession
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    convert(spark, arc, warc)
    dropped(spark, arc)  # the WARC files are committed
    return read_warc(spark, warc).withColumnRenamed("page_id", id_col)
