"""WARC archives, written index first and read back by coalesced byte ranges.

Every record is its own gzip member, so that a reader can start at any offset of the index. Writing
gives the index: file, offset, length, URL and digest of each record. Reading sorts the wanted index
rows by file and offset, joins neighbouring ranges into one read, and cuts the records out of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluicebox.llm.common import fresh_path, spread, written

CRLF = b"\r\n"
ARCHIVE_BYTES = 64_000_000
READ_BYTES = 8_000_000
GAP_BYTES = 65_536
# bytes of archives that one task reads
TASK_BYTES = 4 * READ_BYTES

_INDEX = (
    "page_id bigint, url string, payload_digest string, payload_bytes bigint, record_type string, "
    "refers_to bigint, file string, offset bigint, length bigint"
)
_RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def filesystem(location: str):
    """File system and inner path of a folder, by its URI (local, HDFS, S3, ...)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(location)


def _header_text(value: str) -> bytes:
    """A header value on one line."""
    return "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in value).encode()


def _page_urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, date: str, refers_to: int | None, revisit: bool
) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit of another record's payload."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = http if revisit else http + payload
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + _page_urn(page_id),
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _header_text(url))
    if revisit:
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(b"WARC-Refers-To: " + _page_urn(refers_to))
    return CRLF.join([*head, b"", block, b"", b""])


def _number(urn: str) -> int | None:
    inner = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def parsed(data: bytes) -> tuple:
    """Fields of `_RECORD` out of a record; the payload is checked against its digest."""
    head, _, rest = data.partition(CRLF + CRLF)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(CRLF + CRLF)
    size = int(http.decode().rpartition("Content-Length: ")[2].split("\r\n")[0])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    refers_to = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return _number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, kind, refers_to


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    whole = {n: "Int64" for n in names if f"{n} bigint" in schema}
    return pd.DataFrame(rows, columns=names).astype(whole)


def _write(folder: str, date: str, archive_bytes: int):
    def write(batches):
        fs, inner = filesystem(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                page_id, refers_to = _whole(row.page_id), _whole(row.refers_to)
                payload = (row.html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                revisit = refers_to is not None
                raw = record(page_id, row.url, payload, digest, date, refers_to, revisit)
                packed = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packed.compress(raw) + packed.flush()
                if out is None or offset + len(data) > archive_bytes:
                    if out is not None:
                        out.close()
                    # a name of its own: a task that runs again leaves files that no index row names
                    name, offset = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{inner}/{name}", compression=None)
                out.write(data)
                rows.append((page_id, row.url, digest, len(payload), "revisit" if revisit else "response",
                             refers_to, name, offset, len(data)))
                offset += len(data)
            yield _frame(rows, _INDEX)
        if out is not None:
            out.close()

    return write


def write_archives(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 1000,
    archive_bytes: int = ARCHIVE_BYTES, salts: int = 16,
) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives under `folder`; returns the written index.

    Of pages with equal payloads of at least `least_bytes`, the one with the largest id is written as
    a response and the others as revisits of it. Only digests are grouped. A payload that many pages
    share is salted for the join, so that its pages meet in many tasks.
    """
    fs, inner = filesystem(folder)
    fs.create_dir(inner, recursive=True)
    # a null id and a null text have defined results: the record has an empty id, the payload is empty
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    digest = F.sha1(F.col("html").cast("binary"))
    copies = (
        rows.where(F.octet_length("html") >= least_bytes).groupBy(digest.alias("digest"))
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and keeper is not null").select("digest", "keeper")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    keyed = rows.withColumns({"digest": digest, "salt": spread("page_id", "url", over=salts)})
    # shorter payloads have a digest of their own size, so none of them is among the copies
    marked = keyed.join(copies, ["digest", "salt"], "left").select(
        "page_id", "url", "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"),
    )
    return written(marked.mapInPandas(_write(folder, date, archive_bytes), _INDEX), "warc-index")


def _read(folder: str, gap: int, most: int):
    def read(batches):
        fs, inner = filesystem(folder)
        handle, opened, held = None, None, []

        def records():
            nonlocal handle, opened
            if opened != held[0][0]:
                if handle is not None:
                    handle.close()
                handle, opened = fs.open_input_file(f"{inner}/{held[0][0]}"), held[0][0]
            start, end = held[0][1], max(o + n for _, o, n in held)
            handle.seek(start)
            data = memoryview(handle.read(end - start))
            return _frame([parsed(zlib.decompress(data[o - start : o - start + n], 31)) for _, o, n in held], _RECORD)

        for batch in batches:
            for wanted in zip(batch["file"], batch["offset"], batch["length"]):
                if held and (wanted[0] != held[0][0] or wanted[1] - held[-1][1] - held[-1][2] > gap
                             or wanted[1] + wanted[2] - held[0][1] > most):
                    yield records()
                    held = []
                held.append(wanted)
        if held:
            yield records()
        if handle is not None:
            handle.close()

    return read


def read_records(
    index: DataFrame, folder: str, gap_bytes: int = GAP_BYTES, read_bytes: int = READ_BYTES, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Records that the rows of `index` (any selection of it) name, read from the archives.

    Index rows are dealt by stretches of a file, sorted, and joined to reads of at most `read_bytes`
    that pass over gaps of at most `gap_bytes`. The number of tasks follows the bytes to be read: by the
    size of the index alone Spark would read everything in a few.
    """
    wanted = index.select("file", "offset", "length")
    tasks = -(-(wanted.agg(F.sum("length")).first()[0] or 0) // task_bytes) or 1
    return (
        wanted.repartition(tasks, "file", F.expr(f"offset div {read_bytes}")).sortWithinPartitions("file", "offset")
        .mapInPandas(_read(folder, gap_bytes, read_bytes), _RECORD)
    )


def round_trip(pages: DataFrame, spark: SparkSession) -> DataFrame:
    """Write all pages, then read every record back.

    Defined results: a null html is an empty payload; a null id is an empty record id and comes back
    null, and never is what others refer to while an id is there; rows that repeat a page, the one
    referred to included, are a record each; an empty table gives an empty index and no records;
    other columns are not read. Line breaks and blanks of a URL are percent-encoded in its header.
    """
    folder = fresh_path(spark, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder)
