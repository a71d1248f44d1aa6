"""WARC archives: from one gzip stream per file to one member per record, with an index.

Crawlers may write an archive as a single gzip stream, which can only be read from its start.
The normaliser inflates such a file once, as a stream, writes each record as a gzip member of
its own, and beside the archive a sidecar index with the offset and length of every member, so
that any record can be read alone.  On the way, repeated payloads become revisit records.

An archive is the unit of work: writers begin a new one after `archive_bytes` of records, so no
task and no group of index rows grows with the corpus.  Files are named by partition and appear
by renaming when complete; a task that runs again writes the same bytes under the same name.
They lie in the shared folder, through the file system of its URI (file, hdfs, s3, gs).

Defined results: a null payload is an empty one; a null url or id is left out of the record;
repeated rows are records of their own, of equal ids the later record (by archive and position)
counts as the larger; a damaged archive stops the job with its name.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored, table
from .files import NewFile, file_system

# Payloads below this size are never turned into revisits.
REVISIT_BYTES = 1000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31
_DATE = "1970-01-01T00:00:00Z"


def record_id(archive: str, ordinal: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{archive}/{ordinal}").urn


def _clean(value: str) -> str:
    """A header value without line breaks and other control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {_clean(v)}" for k, v in headers.items() if v is not None)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def response(archive: str, ordinal: int, page_id, url: str | None, payload: bytes) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": f"<{record_id(archive, ordinal)}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Payload-Length": str(len(payload)),
        "Page-ID": None if page_id is None else str(page_id),
        "Content-Type": "application/http; msgtype=response",
    }
    return record(headers, _HTTP + payload)


def records(chunks: Iterator[bytes], name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip stream, whatever its members are."""
    inflate, data, started = zlib.decompressobj(_GZIP), bytearray(), False
    need = 0

    def parsed() -> Iterator[tuple[dict[str, str], bytes]]:
        nonlocal need
        at = 0
        while len(data) - at >= need:
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                break
            lines = data[at:end].decode().split("\r\n")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            stop = end + 4 + int(headers["Content-Length"])
            if len(data) < stop + 4:
                # No more parsing until the record is whole.
                need = stop + 4 - at
                break
            yield headers, bytes(data[end + 4 : stop])
            at, need = stop + 4, 0
        del data[:at]

    for chunk in chunks:
        while chunk:
            if inflate.eof:
                inflate = zlib.decompressobj(_GZIP)
            data += inflate.decompress(chunk)
            chunk, started = inflate.unused_data, True
            yield from parsed()
    if data or (started and not inflate.eof):
        raise ValueError(f"{name} ends inside a record")


def _chunks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    system, place = file_system(path)
    with system.open_input_stream(place, compression=None) as stream:
        while chunk := stream.read(size):
            yield chunk


_CRAWL = "archive string, ordinal long, page_id long, payload_bytes long, digest string"


def write_monolithic(
    pages: DataFrame, payload: str, root: str, archive_bytes: int = 32 << 20
) -> DataFrame:
    """Write a response record per row (page_id, url, payload); the stored list of records.

    Each archive is one gzip stream, as a crawler leaves it.
    """
    asked = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col(payload).cast("binary").alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        out = deflate = None
        written = 0
        for batch in batches:
            found = []
            ids, urls = (batch.column(k).to_pylist() for k in ("page_id", "url"))
            for k in range(len(batch)):
                if out is None:
                    name = f"crawl-{part:06d}-{number:04d}.warc.gz"
                    out, ordinal, written = NewFile(f"{root}/monolithic/{name}"), 0, 0
                    deflate = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
                body = batch.column("payload")[k].as_py() or b""
                raw = response(name, ordinal, ids[k], urls[k], body)
                out.write(deflate.compress(raw))
                found.append((name, ordinal, ids[k], len(body), hashlib.sha1(body).hexdigest()))
                ordinal, written = ordinal + 1, written + len(raw)
                if written >= archive_bytes:
                    out.write(deflate.flush())
                    out.close()
                    out, number = None, number + 1
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = zip(*found, strict=True) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names="archive ordinal page_id payload_bytes digest".split(),
            )
        if out is not None:
            out.write(deflate.flush())
            out.close()

    return stored(asked.mapInArrow(run, _CRAWL), "warc-records")


def revisits(crawl: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """The records with what they refer to: of equal payloads the largest page is the response.

    Columns: archive, ordinal, to_page, to_archive, to_ordinal (null for responses).
    """
    large = crawl.where(F.col("payload_bytes") >= least)
    best = F.max(F.struct("page_id", "archive", "ordinal")).alias("best")
    shared = large.groupBy("digest", "payload_bytes").agg(best, F.count("*").alias("n"))
    shared = shared.where("n > 1").select(
        F.col("digest").alias("s_digest"), F.col("payload_bytes").alias("s_bytes"), "best"
    )
    # Stored, so that both sides of the join have an exchange and a hot payload can be split.
    shared = stored(shared, "warc-shared")
    same = (F.col("digest") == F.col("s_digest")) & (F.col("payload_bytes") == F.col("s_bytes"))
    itself = (F.col("archive") == F.col("best.archive")) & (F.col("ordinal") == F.col("best.ordinal"))
    to = F.when(~itself, F.col("best"))
    return crawl.join(shared, same, "left").select(
        "archive", "ordinal",
        to["page_id"].alias("to_page"), to["archive"].alias("to_archive"),
        to["ordinal"].alias("to_ordinal"),
    )


def normalise(decisions: DataFrame, root: str) -> DataFrame:
    """Rewrite every archive of the decisions; (archive, n_records, n_bytes), stored.

    The rows that say what to do are few next to the archives, so adaptive execution would
    merge them, and with them the archives, into few tasks; an explicit number is left alone.
    Writes {root}/normal/<archive> and its sidecar <archive>.idx.json, a line per record.
    """

    def rewrite(rows: pd.DataFrame) -> pd.DataFrame:
        name = rows["archive"].iloc[0]
        refers = {
            r.ordinal: r for r in rows[rows["to_archive"].notna()].itertuples(index=False)
        }
        out, index = NewFile(f"{root}/normal/{name}"), []
        for ordinal, (headers, block) in enumerate(records(_chunks(f"{root}/monolithic/{name}"), name)):
            headers.pop("Content-Length")
            to = refers.get(ordinal)
            if to is not None:
                headers["WARC-Type"] = "revisit"
                headers["WARC-Profile"] = _PROFILE
                headers["WARC-Refers-To"] = f"<{record_id(to.to_archive, int(to.to_ordinal))}>"
                if not pd.isna(to.to_page):
                    headers["Refers-To-Page-ID"] = str(int(to.to_page))
                block = block[: block.index(b"\r\n\r\n") + 4]
            deflate = zlib.compressobj(3, zlib.DEFLATED, _GZIP)
            member = deflate.compress(record(headers, block)) + deflate.flush()
            index.append({"archive": name, "offset": out.size, "length": len(member),
                          "type": headers["WARC-Type"], "uri": headers.get("WARC-Target-URI"),
                          "digest": headers["WARC-Payload-Digest"]})
            out.write(member)
        out.close()
        side = NewFile(f"{root}/normal/{name}.idx.json")
        side.write("".join(json.dumps(x) + "\n" for x in index).encode())
        side.close()
        return pd.DataFrame({"archive": [name], "n_records": [len(index)], "n_bytes": [out.size]})

    n_archives = max(1, decisions.select("archive").distinct().count())
    spread = decisions.repartition(n_archives, "archive")
    found = spread.groupBy("archive").applyInPandas(rewrite, "archive string, n_records long, n_bytes long")
    return stored(found, "warc-archives")


_PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """A row per record, read by its offset: the payload's size and SHA-1, type and reference.

    The payload of a response is hashed again and must have the digest of its header.
    """
    index = spark.read.schema("archive string, offset long, length long").json(
        f"{root}/normal/*.idx.json"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = handle = None
        for batch in batches:
            found = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    if handle is not None:
                        handle.close()
                    system, place = file_system(f"{root}/normal/{archive}")
                    name, handle = archive, system.open_input_file(place)
                handle.seek(offset)
                ((headers, block),) = records(iter([handle.read(length)]), archive)
                digest = base64.b32decode(headers["WARC-Payload-Digest"].partition(":")[2]).hex()
                if headers["WARC-Type"] == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    if hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{archive} is damaged at {offset}")
                page, to = headers.get("Page-ID"), headers.get("Refers-To-Page-ID")
                found.append((None if page is None else int(page), int(headers["Payload-Length"]),
                              digest, headers["WARC-Type"], None if to is None else int(to)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = zip(*found, strict=True) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=[x.split()[0] for x in _PAGES.split(", ")],
            )
        if handle is not None:
            handle.close()

    return index.mapInArrow(run, _PAGES)


def archive_pages(pages: DataFrame, payload: str, root: str) -> DataFrame:
    """Write, normalise and read back: the pages as the archives hold them."""
    spark = pages.sparkSession
    crawl = write_monolithic(pages, payload, root)
    if crawl.isEmpty():
        return spark.createDataFrame([], _PAGES)
    normalise(stored(revisits(crawl), "warc-decisions"), root)
    return read_archives(spark, root)


def op1_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through monolithic and normalised archives and back."""
    return archive_pages(table(spark, sf_dir, "pages"), "html", scratch_path(spark, "warc"))


SQL = {
    "op1_warc_normalise": f"""
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
  sha1(coalesce(html, '')) AS payload_digest,
  CASE WHEN strlen(html) >= {REVISIT_BYTES} AND page_id < max(page_id) OVER same
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(html) >= {REVISIT_BYTES} AND page_id < max(page_id) OVER same
    THEN max(page_id) OVER same END AS refers_to
FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))
"""
}
