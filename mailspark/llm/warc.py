"""WARC archives: a writer with revisit records, and a salvage reader that recovers what follows a damaged stretch."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailspark.llm.common import prepare, slices, stage
from mailspark.session import new_path

_MEMBER, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_FIRST_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_STEP = 1 << 16


def digest(data: bytes) -> str:
    """As archives write it: sha1 in base 32."""
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record(
    kind: str, record_id: str, uri: str | None, payload: bytes, refers_to: str | None = None, date: str = "1970-01-01T00:00:00Z"
) -> bytes:
    """One record, not compressed. A revisit holds the HTTP head of its payload, not the payload itself."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
        f"WARC-Block-Digest: {digest(block)}", f"WARC-Payload-Digest: {digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member of its own."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    """A record that passed its checks, and where its bytes are in the file."""

    start: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    @property
    def payload(self) -> bytes:
        """What follows the HTTP head; the whole block of a record without one."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


@dataclass
class Gap:
    """A quarantined stretch of a file, and why its first byte could not be read on from.

    ``inner`` are offsets in the content of a gzip member from which other records could be read; the gap then has no
    length in the file and stands where the member ends.
    """

    start: int
    end: int
    reason: str
    inner: tuple[int, int] | None = None


class _Bad(Exception):
    """A check that failed, and what a damaged member gave nevertheless."""

    def __init__(self, reason: str, found: list[Record] = [], gaps: list[tuple[int, int, str]] = []):  # noqa: B006
        super().__init__(reason)
        self.found, self.gaps = found, gaps


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """The content of the gzip member at ``at``, where it ends, and what is wrong with it: then as far as it goes."""
    unpacker, out, view = zlib.decompressobj(31), [], memoryview(data)
    while not unpacker.eof:
        if at >= len(data):
            return b"".join(out), at, "truncated member"
        before = unpacker.copy()
        try:
            out.append(unpacker.decompress(view[at : at + _STEP]))
        except zlib.error as e:
            while True:  # byte by byte, up to the one that fails
                try:
                    out.append(before.decompress(view[at : at + 1]))
                except zlib.error:
                    return b"".join(out), at, f"bad member: {e}"
                at += 1
        at = min(at + _STEP, len(data))
    return b"".join(out), at - len(unpacker.unused_data), None


def _records(content: bytes, whole: bool) -> tuple[list[Record], list[tuple[int, int, str]]]:
    """Records of the content of a member and the gaps between them.

    What comes out of a damaged member (not ``whole``) counts only with a block digest that holds.
    """
    found, gaps, at, lost = [], [], 0, None
    while at < len(content):
        try:
            one = _parse(content, at)
            if not whole and not one.headers.get("warc-block-digest", "").startswith("sha1:"):
                raise _Bad("no digest in a damaged member")
        except _Bad as bad:
            lost = lost or (at, str(bad))
            after = content.find(_VERSION, at + 1)
            at = after if after >= 0 else len(content)
            continue
        if lost:
            gaps.append((lost[0], at, lost[1]))
            lost = None
        found.append(one)
        at = one.end
    return found, [*gaps, (lost[0], len(content), lost[1])] if lost else gaps


def _parse(data: bytes, at: int) -> Record:
    """The record at ``at`` of uncompressed data, if all of it is there and its digests hold."""
    first = _FIRST_LINE.match(data, at)
    if not first:
        raise _Bad("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise _Bad("truncated header")
    headers = {}
    for line in data[first.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise _Bad("bad header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("warc-type") or not re.fullmatch("<[^<>]+>", headers.get("warc-record-id", "")):
        raise _Bad("no type or record id")
    length = headers.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length):
        raise _Bad("no content length")
    start, stop = end + 4, end + 4 + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise _Bad("truncated record" if stop + 4 > len(data) else "record does not end at its length")
    out = Record(at, stop + 4, headers, data[start:stop])
    if headers.get("warc-block-digest", "").startswith("sha1:") and headers["warc-block-digest"] != digest(out.block):
        raise _Bad("block digest differs")
    named = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and named.startswith("sha1:") and named != digest(out.payload):
        raise _Bad("payload digest differs")
    return out


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All records of an archive file, plain or of gzip members, that pass their checks, and the gaps between them.

    Where a check fails, the next gzip member or version line from which a record can be read goes on; the bytes
    before it are one gap. A damaged member is inflated as far as it goes and searched the same way inside: its records
    have its span, and the gaps between them their offsets in its content. Records and gaps cover the file.
    """
    at, lost, held, inner = 0, None, [], []

    def stretch(end: int) -> Iterator[Record | Gap]:
        """What was found between the first failed check and ``end``."""
        if not held:
            yield Gap(lost[0], end, lost[1])
            return
        yield from (Record(lost[0], end, one.headers, one.block) for one in held)
        yield from (Gap(end, end, why, (a, b)) for a, b, why in inner or [(0, 0, lost[1])])

    while at < len(data):
        gaps: list[tuple[int, int, str]] = []
        try:
            if data.startswith(_MEMBER, at):
                content, end, wrong = _inflate(data, at)
                records, gaps = _records(content, not wrong)
                if wrong or gaps and not records:
                    raise _Bad(wrong or gaps[0][2], records, gaps)
                found = [Record(at, end, one.headers, one.block) for one in records]
            else:
                one = _parse(data, at)
                found, end = [one], one.end
        except _Bad as bad:
            lost = lost or (at, str(bad))
            held, inner = held + bad.found, inner + (bad.gaps if bad.found else [])
            after = [x for x in (data.find(_MEMBER, at + 1), data.find(_VERSION, at + 1)) if x >= 0]
            at = min(after, default=len(data))
            continue
        if lost:
            yield from stretch(at)
            lost, held, inner = None, [], []
        yield from found
        yield from (Gap(end, end, why, (a, b)) for a, b, why in gaps)
        at = end
    if lost:
        yield from stretch(len(data))


def mark_revisits(pages: DataFrame, key: str, payload: Column, smallest: int) -> DataFrame:
    """``pages`` with ``__payload`` (bytes), ``__type`` and ``__refers``: the largest key of equal payloads is the response.

    Payloads under ``smallest`` bytes are all responses, as are rows without a key if no equal one has a key.
    """
    rows = pages.withColumn("__payload", F.coalesce(payload.cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("__sha", F.sha2("__payload", 256))
    large = rows.where(F.length("__payload") >= smallest).groupBy("__sha").agg(F.max(key).alias("__keep"), F.count("*").alias("__n"))
    rows = rows.join(large.where("__n > 1").drop("__n"), "__sha", "left")
    again = F.col("__keep").isNotNull() & ~F.col(key).eqNullSafe(F.col("__keep"))
    return rows.withColumn("__type", F.when(again, "revisit").otherwise("response")).withColumn("__refers", F.when(again, F.col("__keep")))


def write(
    pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", smallest: int = 1000,
    file_bytes: int = 16 << 20, urn: str = "urn:page",
) -> DataFrame:
    """Write a record per row to archives in the folder ``path`` and return the committed files (``file``, ``records``).

    Tasks write files of about ``file_bytes`` under names of their own, so a task that runs twice leaves a file that
    no list names; readers take the returned list, never a listing of the folder. Null payloads are empty, a null uri
    is left out, a null key gives a record id without a number.
    """
    spark = pages.sparkSession
    prepare(spark)
    place, folder = fs.FileSystem.from_uri(path)
    place.create_dir(folder, recursive=True)
    rows = mark_revisits(pages.select(F.col(key).alias("k"), F.col(uri).alias("u"), F.col(payload).alias("p")), "k", F.col("p"), smallest)
    rows = rows.select(F.col("k").cast("string"), F.col("u").cast("string"), F.col("__refers").cast("string").alias("r"), F.col("__type").alias("t"), F.col("__payload").alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, folder = fs.FileSystem.from_uri(path)
        held, size, count = [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.gz"
            with place.open_output_stream(f"{folder}/{name}", compression=None) as out:
                for one in held:
                    out.write(one)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["file", "records"])

        for batch in slices(batches, "p"):
            for k, u, r, t, p in zip(*(batch.column(c).to_pylist() for c in ("k", "u", "r", "t", "p"))):
                held.append(member(record(t, f"{urn}:{k or ''}", u, p, f"{urn}:{r}")))
                size, count = size + len(held[-1]), count + 1
                if size >= file_bytes:
                    yield close()
                    held, size, count = [], 0, 0
        if held:
            yield close()

    return stage(rows.mapInArrow(run, "file string, records long"), "manifest")


_READ = (
    "file string, start long, end long, reason string, type string, record_id string, uri string, refers_to string, "
    "payload_bytes long, payload_sha1 string, payload binary, inner_start long, inner_end long"
)


def read(spark: SparkSession, path: str, files: DataFrame | None = None, payloads: bool = False) -> DataFrame:
    """A row per record, and a row with ``reason`` per quarantined gap, of the archives in ``path``.

    ``files`` (column ``file``) names the ones that count; without it all ``*.warc`` and ``*.warc.gz`` do. A damaged
    file never fails the read. ``payload_sha1`` (hex) and ``payload_bytes`` are of the full payload: computed from a
    response, and what a revisit says of the payload it stands for. ``payload`` is filled if ``payloads``.
    """
    prepare(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz}").load(path)
    found = found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    if files is not None:
        found = found.join(files.select("file"), "file", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _READ.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                name, rows, size = batch.column("file")[i].as_py(), [], 0
                for x in salvage(batch.column("content")[i].as_py()):
                    if isinstance(x, Gap):
                        rows.append((name, x.start, x.end, x.reason, *[None] * 7, *(x.inner or (None, None))))
                        continue
                    h, body = x.headers, x.payload
                    sha, length = hashlib.sha1(body).hexdigest(), len(body)
                    if h.get("warc-type") == "revisit":
                        sha, length = _revisited(h, x.block)
                    strip = lambda v: v.strip("<>") if v else None
                    rows.append((name, x.start, x.end, None, h.get("warc-type"), strip(h.get("warc-record-id")), h.get("warc-target-uri"),
                                 strip(h.get("warc-refers-to")), length, sha, body if payloads else None, None, None))
                    size += len(body) if payloads else 200
                    if size >= 4 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return found.mapInArrow(run, _READ)


def _revisited(headers: dict[str, str], block: bytes) -> tuple[str | None, int | None]:
    """Digest (hex) and length of the payload that a revisit leaves out."""
    from base64 import b32decode

    named = headers.get("warc-payload-digest", "")
    length = re.search(rb"(?i)^content-length:\s*(\d{1,18})\s*$", block, re.M)
    try:
        sha = b32decode(named[5:]).hex() if named.startswith("sha1:") else None
    except ValueError:
        sha = None
    return sha, int(length[1]) if length else None


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, and give what the records say of each page."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    written = write(pages, path if "://" in path else f"file://{path}")
    records = read(spark, path, written).where("reason is null")
    number = lambda c: F.regexp_extract(c, r"(-?\d+)$", 1)
    long = lambda c: F.when(number(c) != "", number(c)).cast("long")
    return records.select(
        long("record_id").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"),
        F.col("type").alias("record_type"), long("refers_to").alias("refers_to"),
    )
