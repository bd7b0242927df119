"""WARC archives: records are indexed as they are written, and read back by coalesced byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew, dropped, fresh_path, parallelism, qualified, slices

DATE = "1970-01-01T00:00:00Z"
#: Ranges of a file that are at most GAP bytes apart are read as one, up to READ bytes; a file takes FILE bytes.
GAP, READ, FILE = 64 << 10, 8 << 20, 1 << 30
INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """Base32 of 40 hexadecimal digits, as an expression: five of them make four letters."""
    parts = []
    for k in range(8):
        n = F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(_ALPHABET), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    name = lambda x: f"<urn:page:{x}>" if x is not None else f"<urn:uuid:{uuid4()}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (what follows the HTTP head) of one gzipped record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is the smallest page_id with the same payload, if that is another page.

    Payloads under least_bytes refer to none. Minima are combined before the shuffle, and only payloads of several pages are
    joined back, with both sides dealt anew, so that adaptive execution can split a payload of many pages.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    first = own.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    first = dealt_anew(first.where("n > 1 and first_id is not null").drop("n"), "sha")
    other = F.when(F.col("page_id").isNull() | (F.col("first_id") < F.col("page_id")), F.col("first_id"))
    return own.join(first, "sha", "left").select("page_id", "url", "html", base32(F.col("sha")).alias("digest"), other.alias("refers_to"))


def write(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of pages(page_id, url, html) and return the index: file, offset, length, url, digest and more.

    Each record is a gzip member of its own. A task writes files under names of its own and an index row comes only
    from the attempt that ended, so files of lost attempts are never read. The index is checkpointed. `path` is a
    folder that all executors share, in the file system that Spark takes it for; unset, it is a new one in
    spark.checkpoint.dir. A payload of any length is one record. A null html is an empty payload, a
    null url leaves the field out, a null page_id is never referred to; repeated rows each get a record (several
    with the smallest page_id are all responses); an empty table gives an empty index.
    """
    folder = qualified(pages.sparkSession, path or fresh_path(pages.sparkSession, "warc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, name = None, 0, ""
        try:
            for b in slices(batches, "html"):
                rows = []
                for r in b.to_pylist():
                    if out is None or size > FILE:
                        if out:
                            out.close()
                        files, base = pyarrow.fs.FileSystem.from_uri(folder)
                        files.create_dir(base, recursive=True)
                        name, size = f"{folder}/{uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name.rpartition('/')[2]}", compression=None)
                    member = _record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["refers_to"])
                    out.write(member)
                    kind = "response" if r["refers_to"] is None else "revisit"
                    rows.append({"file": name, "offset": size, "length": len(member), "url": r["url"], "digest": r["digest"], "page_id": r["page_id"], "record_type": kind, "refers_to": r["refers_to"]})
                    size += len(member)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
        finally:
            if out:
                out.close()

    return checkpointed(with_roles(pages, least_bytes).mapInArrow(run, INDEX))


_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64()}[t]) for n, t in (x.split() for x in INDEX.split(", "))])
_READ = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("payload", pa.binary())])


def ranges(spans: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> list[tuple[int, int, int]]:
    """(begin, end, number of spans) of the reads that cover sorted (offset, length) spans."""
    out: list[tuple[int, int, int]] = []
    for offset, length in spans:
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            begin, end, n = out[-1]
            out[-1] = (begin, max(end, offset + length), n + 1)
        else:
            out.append((offset, offset + length, 1))
    return out


def read(selected: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, record_type, refers_to, url, digest, payload) of the selected index rows, as the archives have them.

    Rows are sorted by file and offset, and near ranges are read at once. The payload of a response must have the digest
    that its record states, else the read fails; a revisit has none. With payloads false the last column is the
    payload's length instead, payload_bytes. Ids come from the record, the url from the index. Rows selected twice are
    read twice; a null url or id stays null; other columns of the index are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name, stream = None, None, None
        for b in batches:
            rows, k = b.to_pylist(), 0
            while k < len(rows):
                stop = k
                while stop < len(rows) and rows[stop]["file"] == rows[k]["file"]:
                    stop += 1
                if rows[k]["file"] != name:
                    name = rows[k]["file"]
                    files, at = pyarrow.fs.FileSystem.from_uri(name)
                    stream = files.open_input_file(at)
                for begin, end, n in ranges([(r["offset"], r["length"]) for r in rows[k:stop]]):
                    data, out = stream.read_at(end - begin, begin), []
                    for r in rows[k : k + n]:
                        fields, payload = parse(data[r["offset"] - begin :][: r["length"]])
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{name} at {r['offset']}: the payload doesn't have the digest {digest}")
                        number = lambda key: int(fields[key][10:-1]) if fields.get(key, "").startswith("<urn:page:") else None  # noqa: B023, E731
                        out.append({"page_id": number("WARC-Record-ID"), "record_type": kind, "refers_to": number("WARC-Refers-To"), "url": r["url"], "digest": digest, "payload": payload if kind == "response" else None})
                    k += n
                    got = pa.RecordBatch.from_pylist(out, schema=_READ)
                    if not payloads:
                        got = pa.record_batch([*got.columns[:-1], pa.compute.binary_length(got["payload"]).cast(pa.int64())], [*got.schema.names[:-1], "payload_bytes"])
                    yield got

    dealt = selected.repartition(parallelism(selected), "file").sortWithinPartitions("file", "offset")
    last = "payload binary" if payloads else "payload_bytes long"
    return dealt.mapInArrow(run, f"page_id long, record_type string, refers_to long, url string, digest string, {last}")


def round_trip(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, from the archives read back.

    A revisit's length is that of the response that it refers to. A null html has the length and the digest of an empty
    payload; a page with a null id is never referred to, and refers to the smallest id with its payload, if there is one. Repeated
    rows give a row each, other columns of pages are ignored, an empty table gives no rows. Archives stay only where a path is given.
    """
    at = path or fresh_path(pages.sparkSession, "warc")
    got = checkpointed(read(write(pages, at, least_bytes), payloads=False))
    if not path:
        dropped(pages.sparkSession, at)
    full = got.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "digest", F.col("payload_bytes").alias("full_bytes")).distinct()
    return got.join(full.where("refers_to is not null"), ["refers_to", "digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
