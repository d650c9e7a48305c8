"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

Method. An archive may arrive as one gzip stream over all its records, which
nothing can seek in. The normaliser inflates the stream once, from front to
back, writes each record as a gzip member of its own, and beside the archive a
sidecar index with the offset and length of each member. Readers then seek.

One archive is one task's work, one record at a time is held in memory. Files
are written under a name of the attempt and renamed when they are whole, so a
task that is run again leaves the same files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.store import Store

#: Payloads of fewer bytes are always stored, never referred to.
LEAST_REVISIT = 1000
# The time of capture is not in the table.
DATE = "1970-01-01T00:00:00Z"
# Fixed value: the profile of a revisit by equal payload, from the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 20


def _place(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write_whole(uri: str, write: Callable[[BinaryIO], None]) -> None:
    """Write a file under a passing name, then give it its own."""
    files, path = _place(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    passing = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(passing) as out:
        write(out)
    files.move(passing, path)


def _header(fields: list[tuple[str, str | None]], length: int) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {' '.join(v.split())}" for k, v in fields if v], f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or with ``refers_to`` a revisit that holds the response's HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    digest = base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()
    revisit = refers_to is not None
    block = http.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:x-page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<urn:x-page:{refers_to}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _header(fields, len(block)) + block + b"\r\n\r\n"


def read_record(stream: BinaryIO) -> tuple[bytes, dict[str, str], bytes] | None:
    """(whole bytes, header fields, block) of the next record; None at the end."""
    raw = stream.readline()
    if not raw:
        return None
    if not raw.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {raw[:40]!r}")
    fields: dict[str, str] = {}
    while True:
        line = stream.readline()
        raw += line
        if not line.strip():
            break
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    rest = stream.read(length + 4)
    if len(rest) < length + 4:
        raise ValueError("a WARC record is cut off")
    return raw + rest, fields, rest[:length]


def _page(value: str | None) -> int | None:
    number = (value or "").strip("<>").rpartition(":")[2]
    return int(number) if number.lstrip("-").isdigit() else None


def parsed(fields: dict[str, str], block: bytes) -> dict:
    """What a record says of its payload: of a revisit from its headers, else from the payload itself."""
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    digest = base64.b32decode(stated).hex()
    size = next(int(x[15:]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))
    if kind == "response":
        size, found = len(payload), hashlib.sha1(payload, usedforsecurity=False).hexdigest()
        if found != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
    }


def write_archives(pages: DataFrame, store: Store, *, least: int = LEAST_REVISIT) -> DataFrame:
    """(archive) paths of monolithic gzip archives, one per partition, with a record per row of ``pages``.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    largest page_id is the response, the others revisit it. A null html is an
    empty payload. Rows with a null page_id refer to others, but none refers to
    them; where all ids are null each is a response. Equal rows with the largest
    id are all responses.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    whole = pages.select("page_id", "url", html.alias("html")).withColumn("digest", F.sha1(html.cast("binary")))
    ids = whole.where(F.octet_length("html") >= least).select("page_id", "digest")
    groups = ids.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    groups = groups.where("n > 1 and top is not null").select(F.col("digest").alias("_d"), "top")
    # Only ids and digests are joined by digest; the texts move at most once, by their own id.
    # A hash of the two is the key, so that null ids spread, too.
    key = F.xxhash64("page_id", "digest")
    refs = ids.join(groups, F.col("digest") == F.col("_d")).where(
        F.col("page_id").isNull() | (F.col("page_id") < F.col("top"))
    )
    refs = refs.select(key.alias("_k"), F.col("_d").alias("_rd"), "top").distinct()
    rows = whole.withColumn("_key", key).join(
        refs, (F.col("_key") == F.col("_k")) & (F.col("digest") == F.col("_rd")), "left"
    )
    folder = f"{store.folder}/archives"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        wrote = 0

        def fill(out: BinaryIO) -> None:
            nonlocal wrote
            squeeze = zlib.compressobj(6, wbits=31)
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "html", "top")]
                for page, url, html, top in zip(*columns, strict=True):
                    raw = record(page.as_py(), url.as_py(), html.as_py().encode(), top.as_py())
                    out.write(squeeze.compress(raw))
                    wrote += 1
            out.write(squeeze.flush())

        _write_whole(uri, fill)
        if wrote:
            yield pa.RecordBatch.from_arrays([pa.array([uri])], names=["archive"])

    return store.put(rows.select("page_id", "url", "html", "top").mapInArrow(write, "archive string"), "written")


def _one_by_one(archives: DataFrame) -> DataFrame:
    """Archives dealt out to as many tasks, which adaptive execution doesn't merge: their rows are small, their files aren't."""
    return archives.repartition(max(1, archives.count()))


def normalise(archives: DataFrame, store: Store) -> DataFrame:
    """(archive, index) paths of the same records, a gzip member each, with a sidecar index.

    ``archives`` has a column archive of paths to gzip WARC files, in one member
    or many. An index line holds offset, length, type and record id of a member.
    A damaged archive is an error that names it.
    """
    folder = f"{store.folder}/normal"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                lines: list[str] = []

                def fill(out: BinaryIO, uri: str = uri, lines: list[str] = lines) -> None:
                    files, path = _place(uri)
                    offset = 0
                    with files.open_input_stream(path, compression=None) as raw:
                        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), _PIECE)
                        try:
                            while (found := read_record(stream)) is not None:
                                whole, fields, _ = found
                                member = gzip.compress(whole, 6, mtime=0)
                                out.write(member)
                                lines.append(
                                    f"{offset} {len(member)} {fields['warc-type']} {fields['warc-record-id']}\n"
                                )
                                offset += len(member)
                        except (EOFError, OSError, KeyError, ValueError, zlib.error) as error:
                            raise ValueError(f"{uri} is no whole WARC archive: {error}") from error

                name = f"{folder}/{hashlib.md5(uri.encode(), usedforsecurity=False).hexdigest()}.warc.gz"
                _write_whole(name, fill)
                _write_whole(f"{name}.idx", lambda out, lines=lines: out.write("".join(lines).encode()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([f"{name}.idx"])], names=["archive", "index"]
                )

    return store.put(_one_by_one(archives).mapInArrow(run, "archive string, index string"), "normalised")


def read_back(archives: DataFrame) -> DataFrame:
    """A row for each member named in the sidecar indexes, read at its offset."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, path = _place(archive)
                entries = files.open_input_stream(_place(index)[1], compression=None).read().decode().splitlines()
                with files.open_input_file(path) as source:
                    for a in range(0, len(entries), 1000):
                        rows = []
                        for entry in entries[a : a + 1000]:
                            offset, length = map(int, entry.split(" ")[:2])
                            member = gzip.decompress(source.read_at(length, offset))
                            _, fields, block = read_record(io.BytesIO(member))
                            rows.append(parsed(fields, block))
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _one_by_one(archives.select("archive", "index")).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archive_round_trip(pages: DataFrame, *, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages written to monolithic archives, normalised, and read back by index, a row per page.

    Nulls, repeats and ties are treated as `write_archives` says; an empty table
    gives no rows; other columns are ignored.
    """
    store = Store(pages.sparkSession, "warc")
    return read_back(normalise(write_archives(pages, store, least=least), store))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, sha1(html) AS digest, max(page_id) OVER (PARTITION BY sha1(html)) AS top FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM g
"""
