"""WARC archives: written as one gzip stream per file, normalised to one member per record, read by index.

* :func:`write_archives` decides which records are responses and which revisit an equal payload,
  then writes one archive per partition as a monolithic gzip stream.
* :func:`normalise` inflates each archive once, as a stream, rewrites every record as a gzip member
  of its own and writes a sidecar index (offset, length, type, id per line).
* :func:`read_archives` opens the members at the indexed offsets and returns their contents' facts;
  payloads of responses are hashed again and held against the record's digest.

Of payloads of at least ``REVISIT_BYTES`` that are equal, the record with the largest page id is the
response; the others revisit it. Smaller ones are all responses. Null html is an empty payload,
null urls are written as ``about:blank``, null ids lose against others; of rows that repeat id and
payload one is the response. Extra columns are ignored, whatever their names; an empty table gives no
rows; payloads of any length are written whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusq.llm import sharedfs
from corpusq.llm.common import salt, salted_groups, work_path

REVISIT_BYTES = 1000
LEVEL = 1
_CHUNK = 1 << 20
_DATE = "2000-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """_id, _url, _payload (binary), _refers (null for responses), _target (a response that may be referred to)."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload"))
    rows = rows.withColumn("_long", F.octet_length("_payload") >= REVISIT_BYTES)
    # Small payloads get keys of their own by salt; negated ids turn the smallest of a group into the largest.
    rows = rows.withColumn("_key", F.unhex(F.sha2("_payload", 256))).withColumn("_salt", salt("_id")).withColumn("_back", -F.col("_id"))
    groups = salted_groups(rows.where("_long").select("_key", "_salt", "_back"), ["_key"], "_back")
    known = rows.join(groups, ["_key", "_salt"], "left")
    first = F.row_number().over(Window.partitionBy("_key", "_salt").orderBy(F.col("_back").asc_nulls_last())) == 1
    known = known.withColumn("_first", first & F.col("_back").eqNullSafe(F.col("keep_id")))
    revisit = F.col("_long") & ~F.col("_first")
    return known.select("_id", "_url", "_payload", revisit.alias("_revisit"), F.when(revisit, -F.col("keep_id")).alias("_refers"), (F.col("_long") & F.col("_first")).alias("_target"))


def record(url: str | None, payload: bytes, own: str, refers: str | None) -> bytes:
    """One record; a revisit (``refers`` given) keeps the HTTP header, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Date: {_DATE}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank"),
        "Content-Type: application/http; msgtype=response",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        *([] if refers is None else [f"WARC-Refers-To: {refers}", f"WARC-Profile: {_REVISIT}"]),
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(page_id: int | None, *more: object) -> str:
    return "<urn:x-page:" + ":".join(map(str, ("-" if page_id is None else page_id, *more))) + ">"


def _page(urn: str) -> int | None:
    found = urn.split(":")[2].rstrip(">")
    return None if found == "-" else int(found)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives; returns their paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        path = sharedfs.own_name(folder, f"part-{part:06d}", ".warc.gz")
        with sharedfs.written(path) as f, gzip.GzipFile(fileobj=f, mode="wb", compresslevel=LEVEL, mtime=0) as g:
            for b in batches:
                for page, url, payload, revisit, refers, target in zip(*(c.to_pylist() for c in b.columns)):
                    own = _urn(page) if target else _urn(page, part, n)
                    g.write(record(url, payload, own, _urn(refers) if revisit else None))
                    n += 1
        yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return _files(roles(pages, id_col, url_col, html_col).mapInArrow(run, "path string, records long"))


def rewrite(stream: BinaryIO, out: BinaryIO, index: BinaryIO) -> int:
    """Copies the records of an inflated stream as gzip members; returns their number. Memory: a chunk."""
    at = n = 0
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"record {n} does not start with a WARC version line")
        head, fields = [line], {}
        while (line := stream.readline()).strip():
            head.append(line)
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        size = out.write(pack.compress(b"".join(head) + b"\r\n"))
        left = int(fields["content-length"])
        while left:
            chunk = stream.read(min(left, _CHUNK))
            if not chunk:
                raise ValueError(f"record {n} is cut off")
            size += out.write(pack.compress(chunk))
            left -= len(chunk)
        size += out.write(pack.compress(b"\r\n\r\n") + pack.flush())
        index.write(json.dumps([at, size, fields.get("warc-type"), fields.get("warc-record-id")]).encode() + b"\n")
        at, n = at + size, n + 1
    return n


def normalise(manifest: DataFrame) -> DataFrame:
    """One task per archive: ``x.warc.gz`` to ``x-….members.warc.gz`` and ``x-….index``; once all are there the monoliths go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                stem = sharedfs.own_name(*path.removesuffix(".warc.gz").rsplit("/", 1), "")
                with sharedfs.opened(path) as f, gzip.GzipFile(fileobj=f) as g, sharedfs.written(f"{stem}.members.warc.gz") as out, sharedfs.written(f"{stem}.index") as index:
                    n = rewrite(g, out, index)
                if n != records:
                    raise ValueError(f"{path}: {n} records, {records} written")
                yield pa.RecordBatch.from_pydict({"path": [f"{stem}.members.warc.gz"], "records": pa.array([n], pa.int64())})

    old = [r.path for r in manifest.select("path").collect()]  # a row per partition
    made = _files(manifest.mapInArrow(run, "path string, records long"))
    for path in old:
        sharedfs.removed(path)
    return made


def _files(made: DataFrame) -> DataFrame:
    """Runs the job that writes files; its list of them (a row per partition), dealt out one per task."""
    rows = [(r.path, r.records) for r in made.collect()]
    return made.sparkSession.createDataFrame(rows, "path string, records long").repartition(max(1, len(rows)))


def read_member(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page id, payload bytes, payload SHA-1 in hex, record type, page id referred to) of one record."""
    whole = gzip.decompress(data)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "revisit":
        size = int(re.search(rb"(?i)content-length: *([0-9]+)", http)[1])
        return _page(fields["warc-record-id"]), size, digest, "revisit", _page(fields["warc-refers-to"])
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"{fields['warc-record-id']}: payload digest differs")
    return _page(fields["warc-record-id"]), len(payload), digest, "response", None


def read_archives(members: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per record: id, payload_bytes, payload_digest, record_type, refers_to."""
    names = ["_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                with sharedfs.opened(path) as f, sharedfs.opened(path.removesuffix(".members.warc.gz") + ".index") as index:
                    found = []
                    for line in iter(index.readline, b""):
                        at, size, _, _ = json.loads(line)
                        f.seek(at)
                        found.append(read_member(f.read(size)))
                        if len(found) >= 10_000:
                            yield _batch(found)
                            found = []
                    yield _batch(found)

    def _batch(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    ddl = "_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return members.mapInArrow(run, ddl).withColumnRenamed("_id", id_col)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    folder = work_path(pages.sparkSession, "warc")
    return read_archives(normalise(write_archives(pages, folder, id_col, url_col, html_col)), id_col)
