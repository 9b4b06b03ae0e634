"""Operator 2, WARC records in ZIP packages: writer, and a reader that never extracts.

A package is a ZIP file whose members are stored, not compressed: archives (``archive/*.warc.gz``, one gzip
member per WARC record) and indexes (``indexes/*.cdxj`` or ``*.cdx``, a line per record: key, timestamp and a JSON
object with filename, offset and length). The reader opens a package at its end, parses the end record, the ZIP64
locator and end record where they are needed, and the central directory; takes member offsets from the local
headers; cuts every index into slices of READ_RECORDS lines; and then range-reads the records of a slice. Slices are
dealt to tasks by their number, so one large package is read by many tasks. What cannot be read is an error, never left out:
a compressed archive or index, an archive that no index names, an index line whose archive is missing.

Writing: the digest (SHA-1) and length of every payload are grouped, summed per task before the shuffle;
the largest id of equal payloads of at least ``min_revisit_bytes`` is the response, the others are
revisits that carry headers only. Tasks write packages of about ROLL_BYTES under names of their
own; only names that a finished task has returned are in the manifest, so what a lost or repeated
task leaves behind is never read. Files are reached through the file system of their URI.

Edge cases: a NULL payload is empty; a NULL url is written as an empty target; a NULL id is less
than any other, and stays NULL when read. Repeated rows become records of their own; those that
have the id of the response are responses too. Empty input writes no package. Extra columns are
not archived.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalert.llm.common import stored
from tonalert.operators.joins import checked_broadcast
from tonalert.session import scratch_path

ROLL_BYTES = 64_000_000
READ_RECORDS = 2_000  # records per slice that a task reads
MOST_TASKS = 100_000  # beyond that a task reads several slices
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_EOCD, _EOCD64, _LOCATOR, _CENTRAL, _LOCAL = (b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04")
_FULL = 0xFFFFFFFF


def open_fs(uri: str):
    """(file system, path) of a URI; a bare path is local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- ZIP ---------------------------------------------------------------------------------------


class ZipWriter:
    """Stored members written front to back; sizes go to the local header afterwards by a data
    descriptor, so a member may be streamed. ``zip64`` forces the large records."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc = name.encode(), self.at, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<4sHHHHHIIIHH", _LOCAL, 45, 0x0808, 0, 0, 0x21, 0, _FULL, _FULL, len(self.name), len(extra)) + self.name + extra)
        self.data = self.at

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self._put(data)

    def end(self) -> None:
        size = self.at - self.data
        self._put(b"PK\x07\x08" + struct.pack("<IQQ", self.crc, size, size))
        self.members.append((self.name, self.crc, size, self.start))

    def close(self) -> None:
        first = self.at
        for name, crc, size, start in self.members:
            large = self.zip64 or size >= _FULL or start >= _FULL
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if large else b""
            shown, place = (_FULL, _FULL) if large else (size, start)
            self._put(struct.pack("<4sHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, shown, shown, len(name), len(extra), 0, 0, 0, 0, place)
                      + name + extra)
        size, n = self.at - first, len(self.members)
        large = self.zip64 or n >= 0xFFFF or first >= _FULL
        if large:
            at = self.at
            self._put(struct.pack("<4sQHHIIQQQQ", _EOCD64, 44, 45, 45, 0, 0, n, n, size, first))
            self._put(struct.pack("<4sIQI", _LOCATOR, 0, at, 1))
        n, size, first = (0xFFFF, _FULL, _FULL) if large else (n, size, first)
        self._put(struct.pack("<4sHHHHIIH", _EOCD, 0, 0, n, n, size, first, 0))


def read_range(f, start: int, length: int) -> bytes:
    f.seek(start)
    data = f.read(length)
    if len(data) != length:
        raise ValueError(f"file ends before byte {start + length}")
    return data


def zip_members(f, size: int) -> dict:
    """name -> (start of the stored bytes, length), by the central directory; None for a compressed member."""
    tail_at = max(0, size - 65_557)  # end record and the longest comment
    tail = read_range(f, tail_at, size - tail_at)
    end = tail.rfind(_EOCD)
    if end < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, count, length, first, _ = struct.unpack("<4sHHHHIIH", tail[end:end + 22])
    if count == 0xFFFF or length == _FULL or first == _FULL:
        locator = read_range(f, tail_at + end - 20, 20)
        if locator[:4] == _LOCATOR:
            record = read_range(f, struct.unpack("<4sIQI", locator)[2], 56)
            _, _, _, _, _, _, _, count, length, first = struct.unpack("<4sQHHIIQQQQ", record)
    directory, at, out = read_range(f, first, length), 0, {}
    for _ in range(count):
        head = struct.unpack("<4sHHHHHHIIIHHHHHII", directory[at:at + 46])
        if head[0] != _CENTRAL:
            raise ValueError("broken central directory")
        method, packed, plain, start = head[4], head[8], head[9], head[16]
        n, x, c = head[10:13]
        name, extra = directory[at + 46:at + 46 + n].decode(), directory[at + 46 + n:at + 46 + n + x]
        at += 46 + n + x + c
        while len(extra) >= 4:
            kind, width = struct.unpack("<HH", extra[:4])
            body, extra = extra[4:4 + width], extra[4 + width:]
            if kind == 1:  # the large values, only those that don't fit, in this order
                values = list(struct.unpack(f"<{len(body) // 8}Q", body[:len(body) // 8 * 8]))
                plain = values.pop(0) if plain == _FULL else plain
                packed = values.pop(0) if packed == _FULL else packed
                start = values.pop(0) if start == _FULL else start
        if method:
            out[name] = None
        else:
            local = struct.unpack("<4sHHHHHIIIHH", read_range(f, start, 30))
            out[name] = (start + 30 + local[9] + local[10], packed)
    return out


# -- WARC --------------------------------------------------------------------------------------


def record_bytes(page_id, url, payload: bytes, refers_to=None, revisit=False) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of an equal payload (headers only)."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {''.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers of a record (lower-case names), the HTTP length and the payload (None in a revisit)."""
    top, rest = raw.split(b"\r\n\r\n", 1)
    lines = top.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    http, payload = rest[:int(out["content-length"])].split(b"\r\n\r\n", 1)
    out["http-length"] = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    out["payload"] = None if out["warc-type"] == "revisit" else payload
    return out


def _page(urn: str):
    name = urn[len("<urn:page:"):-1]
    return int(name) if name else None


BATCH_ROWS, BATCH_BYTES = 256, 1_000_000  # rows held as Python objects; payload bytes of a returned batch


def _rows(batches):
    """Rows of Arrow batches as dictionaries, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield from batch.slice(at, BATCH_ROWS).to_pylist()


def write_archives(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to packages; returns the manifest (path, size, records)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("n"))
    groups = keyed.where(F.col("n") >= min_revisit_bytes).groupBy("sha", "n").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("k"))
    groups = groups.where("k > 1 AND refers_to IS NOT NULL").drop("k")
    revisits = keyed.join(groups, ["sha", "n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = stored(revisits.select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "refers_to").distinct(), "revisits")
    # Texts are not shuffled while the list of revisits is small; beyond that by page, never by digest.
    side = checked_broadcast(revisits, materialize=False)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.join(side, F.col("page_id").eqNullSafe(F.col("_id")) & (F.sha1("payload") == F.col("_sha")), "left").select(
        "page_id", "url", "payload", "refers_to")
    folder = scratch_path(pages.sparkSession, "warc")

    def written(batches):
        import pyarrow as pa

        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        name = out = pack = None

        def close():
            data_end = pack.at
            pack.end()
            pack.begin(INDEX)
            pack.write("".join(lines).encode())
            pack.end()
            pack.close()
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [pack.at], "records": [len(lines)], "data_bytes": [data_end]})

        for r in _rows(batches):
            if pack is None:
                name, lines = f"{uuid.uuid4().hex}.wacz", []
                out = fs.open_output_stream(f"{base}/{name}")
                pack = ZipWriter(out)
                pack.begin(DATA)
            revisit = r["refers_to"] is not None
            deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
            packed = deflate.compress(record_bytes(r["page_id"], r["url"], r["payload"], r["refers_to"], revisit)) + deflate.flush()
            at = {"filename": DATA.split("/")[1], "offset": pack.at - pack.data, "length": len(packed)}
            lines.append(f"page:{r['page_id']} 19700101000000 {json.dumps(at)}\n")  # pages carry no time
            pack.write(packed)
            if pack.at >= ROLL_BYTES:
                yield close()
                pack = None
        if pack is not None:
            yield close()

    return stored(rows.mapInArrow(written, "path string, size bigint, records bigint, data_bytes bigint"), "warc-manifest")


def stored_member(members: dict, name: str) -> tuple:
    if members.get(name) is None:
        raise ValueError(f"{name} is {'compressed in the package' if name in members else 'not in the package'}")
    return members[name]


def index_entries(lines: bytes):
    """(archive member, offset, length) of each line of an index."""
    for line in lines.splitlines():
        if line.strip():
            at = json.loads(line[line.index(b"{"):])
            yield f"archive/{at['filename'].split('/')[-1]}", int(at["offset"]), int(at["length"])


def index_slices(f, size: int):
    """(start, bytes) of every run of READ_RECORDS lines of a package's indexes."""
    members = zip_members(f, size)
    indexes = [m for m in members if m.startswith("indexes/") and ".cdx" in m]
    named = set()
    for index in indexes:
        start, length = stored_member(members, index)
        lines = read_range(f, start, length).splitlines(keepends=True)
        named |= {archive for archive, _, _ in index_entries(b"".join(lines))}
        for i in range(0, len(lines), READ_RECORDS):
            part = sum(map(len, lines[i:i + READ_RECORDS]))
            yield start, part
            start += part
    missing = {m for m in members if m.startswith("archive/") and ".warc" in m} - named
    if missing:
        raise ValueError(f"no index names {sorted(missing)}")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the packages of ``manifest`` (path, size): page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload (NULL in a revisit). Runs a job that lists the packages' indexes."""

    def listed(batches):
        import pyarrow as pa

        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()):
                fs, local = open_fs(path)
                with fs.open_input_file(local) as f:
                    rows = [{"path": path, "size": size, "at": at, "bytes": n} for at, n in index_slices(f, size)]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("size", pa.int64()), ("at", pa.int64()), ("bytes", pa.int64())]))

    packages = manifest.select("path", F.col("size").cast("bigint").alias("size"))
    packages = packages.repartition(max(1, min(manifest.count(), MOST_TASKS)), "path")
    slices = stored(packages.mapInArrow(listed, "path string, size bigint, at bigint, bytes bigint"), "warc-slices")
    # A number of its own: rows this small would otherwise be merged into one partition and read by one task.
    ranges = slices.repartition(max(1, min(slices.count(), MOST_TASKS)), "path", "at")

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                fs, path = open_fs(r["path"])
                with fs.open_input_file(path) as f:
                    members = zip_members(f, r["size"])
                    out, held = [], 0
                    for archive, offset, length in index_entries(read_range(f, r["at"], r["bytes"])):
                        data = stored_member(members, archive)[0]
                        x = parse_record(zlib.decompress(read_range(f, data + offset, length), 31))
                        out.append({"page_id": _page(x["warc-record-id"]), "url": x["warc-target-uri"], "payload_bytes": x["http-length"],
                                    "payload_digest": x["warc-payload-digest"].removeprefix("sha1:"), "record_type": x["warc-type"],
                                    "refers_to": _page(x["warc-refers-to"]) if "warc-refers-to" in x else None, "payload": x["payload"]})
                        held += len(x["payload"] or b"")
                        if len(out) == BATCH_ROWS or held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(out, schema=schema())
                            out, held = [], 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=schema())

    def schema():
        import pyarrow as pa

        return pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    return ranges.mapInArrow(read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")
