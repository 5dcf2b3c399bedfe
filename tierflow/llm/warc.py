"""WARC archives: a writer and a splittable reader.

*Writing.* Each task writes its records as one ``.warc.gz`` file, a gzip member
a record. Records with equal payloads of at least ``LEAST_BYTES`` bytes are
written once, for the smallest id; the others become ``revisit`` records that
name the first. A file has a name of its own for each attempt, and only names
in the committed manifest are read, so half-written files of lost executors
are never seen.

*Reading.* Files are cut into byte ranges. A task looks for the gzip magic in
its range, takes a hit for a member's start if it decodes to a WARC record's
first line, and owns the records that start inside its range; the last may
reach beyond it. Member by member it then walks on from there, so a range needs
no index and no neighbour.

A file begins with a ``warcinfo`` record. Records of a page: type, id, target
address, date, payload digest, an HTTP response head and the payload. A revisit
has no payload; its digest and the extension header ``X-Payload-Length`` are of
the whole payload, and ``WARC-Refers-To`` has the id of the response's record.

*Archives from elsewhere.* Only the record type and the lengths are needed.
Digests of a known kind (sha-1, sha-256, sha-512 or md5, in hexadecimal or base
32) are verified, others and missing ones are not; ``payload_digest`` is always
the SHA-256 of what was read. A revisit whose header has no SHA-256 has a NULL
digest, one without a length the length of its HTTP head, if any, else NULL.
Records of other types give no row; ``inventory`` counts them all.

Cases: a NULL payload is an empty one; NULL or odd addresses (control
characters) are left out or escaped; rows without an id get a record without a
page id and are never referred to; repeated rows give a record each, and all
rows with the smallest id of equal payloads are responses; very long payloads
are written and read whole, one at a time; other columns are not read; an
empty table gives no file and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import scratch_path, staged, utf8
from tierflow.llm.shared_files import local_path, open_input, open_output

LEAST_BYTES = 100
SPLIT_BYTES = 16 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"

_MAGIC = b"\x1f\x8b\x08"
_FIRST_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
_READ = 1 << 16


def _record_id(page_id: int | None, digest: str, kind: str) -> str:
    """The same for the same page and payload, so that a revisit can name a record of another task."""
    own = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f"{kind}/{page_id}/{digest}")
    return f"<urn:uuid:{own}>"


def _info() -> bytes:
    content = b"software: tierflow\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}", "Content-Type: application/warc-fields", f"Content-Length: {len(content)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def _record(kind: str, page_id: int | None, refers_to: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    content = head if kind == "revisit" else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest, kind)}", f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%!#$&'()*+,/:;=?@[]~"))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to, digest, 'response')}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(content)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        file, size, records = None, 0, 0
        for batch in batches:
            if file is None:
                file, info = open_output(name), gzip_member(_info())
                file.write(info)
                size = len(info)
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                page_id, url, payload, refers = (c[i].as_py() for c in columns)
                kind = "response" if refers is None else "revisit"
                member = gzip_member(_record(kind, page_id, refers, url, payload, hashlib.sha256(payload).hexdigest()))
                file.write(member)
                size += len(member)
                records += 1
        if file is None:
            return
        file.close()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([records])], names=["name", "size", "records"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Write one archive a task; the manifest ``name, size, records``.

    Which record a page refers to is found on narrow rows (id, digest), with
    the smallest id pre-aggregated, and joined back by the page's own id.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), utf8(payload_col).alias("payload"))
    narrow = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least)).select("page_id", F.unhex(F.sha2("payload", 256)).alias("digest"))
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last").select("digest", "first")
    # a page id may come with several payloads, so the digest goes along
    revisits = narrow.join(first, "digest").filter("page_id > first").select("page_id", "digest", "first").distinct()
    own = F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256)))
    joined = rows.withColumn("digest", own).join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", F.col("first").alias("refers"))
    return staged(joined.mapInArrow(_write(folder), "name string, size long, records long"))


class _Window:
    """A file read forward in pieces."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data = file, at, bytearray()
        file.seek(at)

    def more(self) -> bool:
        piece = self.file.read(_READ)
        self.data += piece
        return bool(piece)

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.at += n


def _member(window: _Window) -> tuple[bytes, int] | None:
    """The decoded member at the window's start and its length, if one is there and whole."""
    unpacker, out, used = zlib.decompressobj(31), [], 0
    while True:
        try:
            out.append(unpacker.decompress(bytes(window.data[used:])))
        except zlib.error:
            return None
        used = len(window.data)
        if unpacker.eof:
            return b"".join(out), used - len(unpacker.unused_data)
        if not window.more():
            return None


def _begins_record(window: _Window) -> bool:
    """Whether the window starts with a member whose first bytes are a WARC record's."""
    while len(window.data) < 512 and window.more():
        pass
    try:
        start = zlib.decompressobj(31).decompress(bytes(window.data[:512]), 64)
    except zlib.error:
        return False
    return _FIRST_LINE.match(start) is not None


def records_in(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of the members that start in ``start .. end - 1``."""
    window = _Window(file, start)
    while True:
        # to the next candidate
        found = window.data.find(_MAGIC)
        while found < 0:
            window.drop(max(0, len(window.data) - len(_MAGIC) + 1))
            if window.at >= end or not window.more():
                return
            found = window.data.find(_MAGIC)
        window.drop(found)
        if window.at >= end:
            return
        if not _begins_record(window):
            window.drop(1)
            continue
        got = _member(window)
        if got is None:  # not a whole member after all
            window.drop(1)
            continue
        yield window.at, got[0]
        window.drop(got[1])


def parse(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), HTTP head and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields: dict[str, str] = {}
    last = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:  # a folded line goes on with the one before
            fields[last] += " " + line.strip()
            continue
        last, _, value = line.partition(":")
        last = last.strip().lower()
        fields[last] = value.strip()
    length = fields.get("content-length", "")
    content = rest[: int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") and "http" not in fields.get("content-type", "").lower():
        return fields, b"", content
    http, _, payload = content.partition(b"\r\n\r\n")
    return fields, http, payload


# Names of digests in archives, and how long they are.
_DIGESTS = {"sha1": 20, "sha256": 32, "sha512": 64, "md5": 16}


def _digest_of(header: str | None) -> tuple[str, bytes] | None:
    """Algorithm and bytes of a digest header of a known kind."""
    name, _, value = (header or "").partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip()
    size = _DIGESTS.get(name)
    try:
        if size and len(value) == 2 * size:
            return name, bytes.fromhex(value)
        found = base64.b32decode(value.upper() + "=" * (-len(value) % 8)) if size else b""
    except ValueError:
        return None
    return (name, found) if size and len(found) == size else None


def _verified(fields: dict[str, str], payload: bytes) -> bool | None:
    """Whether the payload has the digest of its header; None where that says nothing."""
    known = _digest_of(fields.get("warc-payload-digest"))
    return None if known is None else hashlib.new(known[0], payload).digest() == known[1]


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d+", value.strip()) else None


def _row(fields: dict[str, str], http: bytes, payload: bytes, name: str) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload"""
    kind = fields["warc-type"].lower()
    page, refers = _number(fields.get("x-page-id")), _number(fields.get("x-refers-to-page-id"))
    if kind == "response":  # what was read, not what a header says
        if _verified(fields, payload) is False:
            raise ValueError(f"payload of {fields.get('warc-record-id')} in {name} differs from its digest")
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    else:
        known = _digest_of(fields.get("warc-payload-digest"))
        digest = known[1].hex() if known and known[0] == "sha256" else None
        length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)
        size = _number(fields.get("x-payload-length"))
        size = int(length[1]) if size is None and length else size
    return page, fields.get("warc-target-uri"), size, digest, kind, refers, payload


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 7 if with_payload else 6]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names[: len(types)])

        for batch in batches:
            for split in batch.to_pylist():
                rows, held = [], 0
                with open_input(split["name"]) as file:
                    for _, record in records_in(file, split["start"], split["end"]):
                        fields, http, payload = parse(record)
                        if fields.get("warc-type", "").lower() not in ("response", "revisit"):
                            continue
                        rows.append(_row(fields, http, payload, split["name"]))
                        held += len(payload) if with_payload else 1
                        if len(rows) >= 2000 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(record_type, digest, records, bytes) of each range."""
    for batch in batches:
        for split in batch.to_pylist():
            found: dict[tuple[str, str], list[int]] = {}
            with open_input(split["name"]) as file:
                for _, record in records_in(file, split["start"], split["end"]):
                    fields, _, payload = parse(record)
                    kind = fields.get("warc-type", "").lower()
                    state = {None: "not verified", True: "verified", False: "differs"}[_verified(fields, payload) if kind != "revisit" else None]
                    sums = found.setdefault((kind, state), [0, 0])
                    sums[0] += 1
                    sums[1] += len(payload)
            yield pa.RecordBatch.from_pylist([{"record_type": k, "digest": d, "records": n, "bytes": b} for (k, d), (n, b) in found.items()], schema=pa.schema([("record_type", pa.string()), ("digest", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


def _ranges(spark: SparkSession, archives: DataFrame | list[tuple[str, int]], split_bytes: int) -> DataFrame:
    """(name, start, end) of the files' byte ranges, dealt to tasks; made from the manifest by Spark."""
    files = archives.select("name", "size") if isinstance(archives, DataFrame) else spark.createDataFrame(archives, "name string, size long")
    many = int(files.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 0)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.filter("size > 0").select("name", "size", starts.alias("start")).select("name", "start", F.least(F.col("start") + split_bytes, "size").alias("end"))
    tasks = max(1, min(many, max(int(spark.conf.get("spark.sql.shuffle.partitions")), many // 8)))
    return ranges.repartition(tasks)


def read_archives(spark: SparkSession, archives: DataFrame | list[tuple[str, int]], split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit record of the files (a manifest, or (name, size) pairs), a task for each few byte ranges."""
    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if with_payload else "")
    return _ranges(spark, archives, split_bytes).mapInArrow(_read(with_payload), ddl)


def inventory(spark: SparkSession, archives: DataFrame | list[tuple[str, int]], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``record_type, digest, records, bytes`` over all records: digests ``verified``, that ``differs``, or ``not verified``."""
    counted = _ranges(spark, archives, split_bytes).mapInArrow(_count, "record_type string, digest string, records long, bytes long")
    return counted.groupBy("record_type", "digest").agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))


def list_archives(folder: str) -> list[tuple[str, int]]:
    """(name, size) of the archives in a folder, for archives that come without a manifest."""
    path = local_path(folder)
    if path is None:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(folder)
        root = folder.rstrip("/")
        return [(f"{root}/{os.path.basename(f.path)}", f.size) for f in system.get_file_info(fs.FileSelector(at)) if f.path.endswith(".warc.gz")]
    return sorted((os.path.join(path, n), os.path.getsize(os.path.join(path, n))) for n in os.listdir(path) if n.endswith(".warc.gz"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h AND n >= 100
"""
