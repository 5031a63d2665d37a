"""WARC archives with revisit resolution.

``resolve`` shuffles headers (id, length, digest) by payload digest and names one original per group
of equal payloads; ``write_archive`` writes a ``response`` or a ``revisit`` record per page with
fresh headers; ``read_archive`` parses archives by Content-Length; ``resolve_references`` joins
revisit records to the responses they point at; ``restore`` gives every page its payload back.

The records are written by Spark's text writer with ``CRLF`` after each row, which is the end of a
WARC record, so each part file is a plain WARC/1.1 archive written under Spark's commit protocol.

Null payloads are empty ones. A null URL is left out of its record and read back as null; line ends
in a URL are percent-encoded. Rows tied on the largest page id of a group (repeated rows) are all
responses and share one record id. A null page id sorts below all others. No pages: no archive, and
an empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm.common import prepare, saved

# Field names and constants of the WARC/1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4096
#: Groups of equal payloads that may be broadcast; beyond it the payloads are shuffled by digest.
BROADCAST_GROUPS = 50_000
RECORD = (
    "page_id string, url string, record_id string, record_type string, refers_to_id string, "
    "payload_digest string, payload_bytes long, intact boolean"
)


def payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b""))
    return pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        html.alias("payload"), F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html).alias("payload_digest"),
    )


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The original of each payload that several page ids share: digest, length and page id."""
    groups = headers.where(F.col("payload_bytes") >= min_bytes).groupBy(
        "payload_digest", "payload_bytes"
    ).agg(
        F.max("page_id").alias("original"), F.min("page_id").alias("least"),
        F.count(F.lit(1)).alias("rows"), F.count("page_id").alias("named"),
    )
    # A null id counts as one below all others; a group of nulls only has no original to name.
    return groups.where("original > least OR (named > 0 AND named < rows)").select(
        "payload_digest", "payload_bytes", "original")


def record_id(page_id: Column, digest: Column) -> Column:
    """A version-8 UUID made from page id and payload digest."""
    name = F.sha1(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(name, 1, 8), F.lit("-"), F.substring(name, 9, 4),
        F.lit("-8"), F.substring(name, 13, 3), F.lit("-8"), F.substring(name, 16, 3), F.lit("-"),
        F.substring(name, 19, 12), F.lit(">"),
    )


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def records(pages: DataFrame, groups: DataFrame, broadcast: bool, date: Column) -> DataFrame:
    """The text of one WARC record per page, without the last line end."""
    known = F.broadcast(groups) if broadcast else groups
    joined = pages.join(known, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("original").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") < F.col("original")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return joined.select(F.concat(
        F.lit(VERSION + CRLF),
        F.when(revisit, F.lit("WARC-Type: revisit" + CRLF))
        .otherwise(F.lit("WARC-Type: response" + CRLF)),
        _field("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", digest),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To",
               F.when(revisit, record_id(F.col("original"), F.col("payload_digest")))),
        _field("Page-Id", F.col("page_id").cast("string")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _field("Content-Length", length.cast("string")),
        F.lit(CRLF), http, body, F.lit(CRLF),
    ).alias("value"))


def write_archive(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, date: Column | None = None,
) -> None:
    """Write a deduplicated archive of pages: one file per ``RECORDS_PER_FILE`` records."""
    prepare(pages.sparkSession)
    rows = payloads(pages, id_col, url_col, html_col)
    groups = saved(resolve(rows.drop("payload", "url"), min_bytes))
    when = date if date is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    small = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    records(rows, groups, small, when).write.option("lineSep", CRLF).option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(archive: bytes | memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Header fields (lower-case names) and block of each record."""
    data, at = memoryview(archive), 0
    whole = bytes(archive) if not isinstance(archive, bytes) else archive
    while at < len(whole):
        end = whole.find(b"\r\n\r\n", at)
        if end < 0 or not whole.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = whole[at:end].decode("utf-8", "replace").split(CRLF)[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, size = end + 4, int(fields["content-length"])
        if whole[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield fields, data[start:start + size]
        at = start + size + 4


def _rows(archive: bytes, payload: bool) -> Iterator[tuple]:
    for fields, block in parse(archive):
        head, _, body = bytes(block).partition(b"\r\n\r\n")
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        kind = fields["warc-type"]
        stated = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        size = len(body) if kind == "response" else int(stated[1]) if stated else None
        intact = hashlib.sha1(body).hexdigest() == digest if kind == "response" else None
        row = (fields.get("page-id"), fields.get("warc-target-uri"), fields["warc-record-id"], kind,
               fields.get("warc-refers-to"), digest, size, intact)
        yield (*row, body if kind == "response" else None) if payload else row


def read_archive(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of all archives in a folder, with the payload of responses if asked for."""
    prepare(spark)
    schema = RECORD + (", payload binary" if payload else "")
    types = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [(n, types.get(t, pa.string())) for n, t in (x.split() for x in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows = list(_rows(archive.as_py(), payload))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields, strict=True)],
                        names=[n for n, _ in fields],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)


def resolve_references(rows: DataFrame) -> DataFrame:
    """Add ``refers_to``: the page id of the response that a revisit record points at.

    ``rows`` must be stored (``saved``): they are read for both sides. The side of the originals is
    stored too, so that a record to which a third of all revisits points is split as a skewed join.
    """
    originals = saved(
        rows.where("record_type = 'response'").groupBy("record_id")
        .agg(F.max("page_id").alias("refers_to"))
        .withColumnRenamed("record_id", "refers_to_id")
    )
    return rows.join(originals, "refers_to_id", "left")


def restore(spark: SparkSession, path: str) -> DataFrame:
    """Page id, URL and whole payload of every record, revisits included."""
    rows = read_archive(spark, path, payload=True)
    originals = rows.where("record_type = 'response'").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("source"), F.col("payload").alias("original"))
    joined = rows.drop("payload").withColumn(
        "source", F.coalesce("refers_to_id", "record_id")).join(originals, "source", "left")
    return joined.select("page_id", "url", "payload_digest", F.col("original").alias("payload"))
