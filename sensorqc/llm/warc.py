"""WARC archives: a writer and a splittable reader.

Writer: each task writes its rows as gzip members, one per record, into archives of its own in the given
folder (any file system pyarrow can open), and returns one row per archive. That table of archives is the
commit: archives of lost or repeated task attempts aren't in it and are never read. Of records with equal
payloads the one of the smallest id is a response, the others are revisits that carry HTTP headers (so the
full length) and the payload digest but no payload.

Reader: every archive is cut into byte ranges. A task scans its range for the gzip magic number, tries to
decode a WARC header at each candidate and skips false ones, reads the whole member where that succeeds,
also past the end of its range, and goes on behind it. A record belongs to the range in which it starts, so
ranges need no knowledge of each other. Memory is bounded by a chunk and the largest record.

Defined results: a null payload is empty; rows that repeat the smallest id of a payload are all responses;
null ids sort last and come back as null; an empty table gives no archives and no records; a range without
a record start gives nothing. Payload digests of responses are checked (column ``intact``).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorqc.llm.base import arrow_map, materialise

MAGIC = b"\x1f\x8b\x08"
RECORD_SCHEMA = "archive string, offset long, record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary, intact boolean"


@dataclass(frozen=True)
class WarcSettings:
    least_revisit_bytes: int = 0
    archive_bytes: int = 512 << 20
    split_bytes: int = 8 << 20
    task_bytes: int = 64 << 20  # archive bytes a task reads, where there are many
    level: int = 5


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unclean(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(record_id: str | None, url: str | None, payload: bytes, refers_to: str | None, level: int) -> bytes:
    """One gzip member. ``refers_to`` makes it a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-row:{_clean(record_id or '')}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-row:{_clean(refers_to)}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def revisits(pages: DataFrame, id_col: str, payload_col: str, least: int) -> DataFrame:
    """``pages`` with ``_wc_payload`` (bytes) and ``_wc_refers`` (id of the response, null for responses)."""
    payload = F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b""))
    rows = pages.withColumn("_wc_payload", payload).withColumn("_wc_sum", F.sha2("_wc_payload", 256))
    same = rows.filter(F.octet_length("_wc_payload") >= least).groupBy("_wc_sum").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("_wc_first"))
    # only payloads that occur twice go on; Spark broadcasts the table while it is measured small
    same = materialise(same.filter("n > 1").select("_wc_sum", "_wc_first"), "same-payloads")
    rows = rows.join(same, "_wc_sum", "left")
    return rows.withColumn("_wc_refers", F.when(~F.col("_wc_first").eqNullSafe(F.col(id_col)), F.col("_wc_first"))).drop("_wc_sum", "_wc_first")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", cfg: WarcSettings = WarcSettings()) -> DataFrame:
    """Writes archives into ``folder``; returns the table of archives (path, bytes, records)."""
    marked = revisits(pages, id_col, payload_col, cfg.least_revisit_bytes)
    rows = marked.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url"), F.col("_wc_payload").alias("payload"), F.col("_wc_refers").cast("string").alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, top = pafs.FileSystem.from_uri(folder)
        out, path, done, count = None, "", [], 0
        for b in batches:
            for rid, url, payload, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    fs.create_dir(top, recursive=True)
                    path, count = f"{top}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(path, compression=None)
                out.write(record(rid, url, payload, refers, cfg.level))
                count += 1
                if out.tell() >= cfg.archive_bytes:
                    done.append((path, out.tell(), count))
                    out.close()
                    out = None
        if out is not None:
            done.append((path, out.tell(), count))
            out.close()
        base = folder.rstrip("/") if "://" in folder else top
        paths = pa.array([f"{base}/{p.rsplit('/', 1)[1]}" for p, _, _ in done], pa.string())
        yield pa.RecordBatch.from_arrays([paths, pa.array([n for _, n, _ in done], pa.int64()), pa.array([c for *_, c in done], pa.int64())], ["path", "bytes", "records"])

    return materialise(arrow_map(rows, run, "path string, bytes long, records long"), "archives")


class _Bytes:
    """A window over a file: bytes from any position on, read in chunks."""

    chunk = 1 << 20

    def __init__(self, source, size: int):
        self.source, self.size, self.start, self.data = source, size, 0, b""

    def at(self, pos: int, n: int) -> bytes:
        if not (self.start <= pos and pos + n <= self.start + len(self.data)):
            want = min(max(n, self.chunk), self.size - pos)
            self.source.seek(pos)
            self.start, self.data = pos, self.source.read(want)
        return self.data[pos - self.start : pos - self.start + n]


def parse_member(window: _Bytes, pos: int) -> tuple[bytes, int] | None:
    """(decoded record, end of its member), or None if no WARC record starts at ``pos``.

    What doesn't begin as a record is left after its first bytes; a header may have any length.
    """
    z, out, at = zlib.decompressobj(31), bytearray(), pos
    try:
        while not z.eof and at < window.size:
            raw = window.at(at, min(1 << 14, window.size - at))
            at += len(raw)
            out += z.decompress(raw)
            if not b"WARC/1.".startswith(bytes(out[:7])):
                return None
    except zlib.error:
        return None
    return (bytes(out), at - len(z.unused_data)) if z.eof and out.startswith(b"WARC/1.") and b"\r\n\r\n" in out else None


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}


def _urn(value: str | None) -> str | None:
    return _unclean(value.removeprefix("<urn:x-row:").removesuffix(">")) or None if value else None


def decode_record(raw: bytes) -> tuple | None:
    """record_id, url, type, refers_to, payload_bytes, digest, payload, intact; None if the lengths don't fit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    f = _fields(head)
    if not f.get("content-length", "").isdigit() or int(f["content-length"]) + 4 != len(rest):
        return None
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    told = f.get("warc-payload-digest", "").removeprefix("sha1:")
    url = f.get("warc-target-uri")
    kind, length = f.get("warc-type"), _fields(http).get("content-length", "")
    mine = digest(payload) if kind == "response" else told
    size = int(length) if kind == "revisit" and length.isdigit() else len(payload)
    return _urn(f.get("warc-record-id")), None if url is None else _unclean(url), kind, _urn(f.get("warc-refers-to")), size, mine, payload if kind == "response" else None, mine == told


def read_range(source, path: str, size: int, start: int, end: int) -> Iterator[tuple]:
    """Records that start in [start, end)."""
    window, pos = _Bytes(source, size), start
    while pos < end:
        span = window.at(pos, min(_Bytes.chunk, size - pos))
        hit = span.find(MAGIC)
        if hit < 0:
            if pos + len(span) >= size:
                return
            pos += max(1, len(span) - len(MAGIC) + 1)
            continue
        pos += hit
        if pos >= end:
            return
        found = parse_member(window, pos)
        parsed = decode_record(found[0]) if found else None
        if parsed is None:
            pos += 1
            continue
        yield (path, pos, *parsed)
        pos = found[1]


def reading_tasks(archives: DataFrame, cfg: WarcSettings) -> int:
    """Tasks for the ranges: one per ``task_bytes``, and several per core while there are ranges enough."""
    told = archives.agg(F.sum(F.ceil(F.col("bytes") / cfg.split_bytes)).alias("ranges"), F.sum("bytes").alias("bytes")).first()
    ranges, size = told["ranges"] or 0, told["bytes"] or 0
    cores = archives.sparkSession.sparkContext.defaultParallelism
    return max(1, min(ranges, max(4 * cores, -(-size // cfg.task_bytes))))


def read_warc(archives: DataFrame, cfg: WarcSettings = WarcSettings(), payloads: bool = True) -> DataFrame:
    """Records of the archives (path, bytes), one task row per byte range."""
    ranges = archives.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(cfg.split_bytes).cast("long"))).alias("start"))
    # the number is given, as Spark would merge the few bytes that name the ranges into one task
    ranges = ranges.repartition(reading_tasks(archives, cfg))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        names = [f.strip().split()[0] for f in RECORD_SCHEMA.split(",")]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary(), pa.bool_()]
        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, inner = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(inner) as source:
                    for r in read_range(source, path, size, start, min(start + cfg.split_bytes, size)):
                        rows.append(r if payloads else (*r[:8], None, r[9]))
                        held += len(rows[-1][8] or b"")
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return arrow_map(ranges, run, RECORD_SCHEMA)
