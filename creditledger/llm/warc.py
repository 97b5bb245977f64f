"""WARC: write pages as archive records, read archives back, reassemble segments.

Writing.  A page becomes a ``response`` record whose block is an HTTP message with chunked
transfer framing.  Of pages with equal payloads that with the smallest id is the response and
the others are ``revisit`` records that name it and carry no payload.  A block over
``SEGMENT_BYTES`` is split: the first segment keeps the record's headers, the rest are
``continuation`` records that name the first as their origin and bear numbers, the last the
total length too.  Records are written by Spark's text writer, whose line separator is set to
the two line ends that close a record, compressed with gzip, one archive per task, into the
shared folder.

Reading.  Spark's text reader with the same separator gives the archives' bytes back in order,
and a task puts records together by their content length; a compressed archive is read by one
task from its start.  Records without a segment number are whole.  The others are grouped by
origin identifier, ordered by segment number and joined; the numbers must have no gap and the
length must be the total.  Then the chunked framing of the HTTP message is taken off.

Which pages repeat is found on digests alone, with partial aggregates, so that a payload that
a third of all pages share moves as one row per task.  Whole pages move only if the digests that
repeat are too many to broadcast, and then no payload gathers many rows; segments move always.

Defined results: a null page counts as empty.  Rows that repeat an id and its payload are
records of their own and of the same type.  Null ids come after all others; among pages that
all have none each is a response.  A record that breaks off, a gap between segments, a wrong
length or a wrong digest is an error.  Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, cut, new_folder, read, tasks

VERSION = b"WARC/1.1"
END = b"\r\n"
CLOSE = "\r\n\r\n"
SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 8 << 10
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records carry this date; pages have none of their own.
DATE = "1970-01-01T00:00:00Z"


def digest_text(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1 digest."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """What chunked transfer framing holds; raises if it is broken."""
    parts, at = [], 0
    while True:
        line_end = body.index(END, at)
        size = int(body[at:line_end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        start = line_end + 2
        if body[start + size : start + size + 2] != END:
            raise ValueError("a chunk does not end where its length says")
        parts.append(body[start : start + size])
        at = start + size + 2


def http_payload(message: bytes) -> bytes:
    """The payload of an HTTP response message."""
    head, _, body = message.partition(END + END)
    if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        return unchunked(body)
    return body


def header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{name}: {value}".encode() for name, value in fields if value is not None]
    return END.join([VERSION, *lines]) + END + END


def record_id(page_id, digest: str, suffix: str = "") -> str:
    """The identifier of a page's record, from which ``page_of`` takes the page."""
    return f"<urn:x-page:{page_id}:{digest}{suffix}>"


def page_of(identifier: Column) -> Column:
    """The page that an identifier names."""
    return F.split_part(identifier, F.lit(":"), F.lit(3)).try_cast("bigint")


def single_line(value: str | None) -> str | None:
    return None if value is None else re.sub(r"[\r\n]+", " ", value)


def records_of(page_id, url, page: str | None, response, suffix: str) -> Iterator[bytes]:
    """The records of a page, without the line ends that close a record.

    ``response`` is the id of the page that this one repeats, None if it repeats none.
    """
    payload = (page or "").encode("utf-8", "replace")
    digest = digest_text(payload)
    own = record_id(page_id, digest, suffix)
    common = [
        ("WARC-Target-URI", single_line(url)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-Id", page_id),
        ("X-Payload-Length", len(payload)),
    ]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if response is not None:
        block = head + END
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", own),
            *common,
            ("WARC-Profile", IDENTICAL),
            ("WARC-Refers-To", record_id(response, digest)),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
        yield header(fields) + block
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    segments = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    for number, segment in enumerate(segments, 1):
        if number == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common]
            fields += [("Content-Type", "application/http; msgtype=response")]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Date", DATE)]
            fields += [("WARC-Record-ID", record_id(page_id, digest, f"{suffix}:{number}"))]
            fields += [("WARC-Segment-Origin-ID", own)]
        if len(segments) > 1:
            fields += [("WARC-Segment-Number", number)]
            if number == len(segments):
                fields += [("WARC-Segment-Total-Length", len(block))]
        yield header([*fields, ("Content-Length", len(segment))]) + segment


def with_first(pages: DataFrame) -> DataFrame:
    """Pages with ``first``, null where the payload is met once only.

    ``first`` has the id of the response, ``page_id``, and the number ``n`` of its rows.  Only
    digests move while ``first`` is found.  Payloads of more than a task's share of the repeated
    rows are fewer than tasks, so their digests are broadcast; the rest is small or joined by
    hash, which moves their pages, and those of the hot ones by row number, as they are done.
    """
    hashed = pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit(""))))
    own = hashed.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.isnull("page_id").alias("no_id"), "page_id", "n")).alias("first")
    per_digest = own.groupBy("digest").agg(F.sum("n").alias("rows"), least)
    repeated = cut(per_digest.filter("rows > 1"))
    n = tasks(pages.sparkSession)
    total = repeated.agg(F.sum("rows")).scalar()
    is_hot = F.col("rows") * n > total
    hot = repeated.filter(is_hot).select(F.col("digest").alias("of"), F.col("first").alias("hot"))
    warm = repeated.filter(~is_hot).select(F.col("digest").alias("key"), "first")
    marked = hashed.join(F.broadcast(hot), F.col("digest") == F.col("of"), "left")
    row = F.monotonically_increasing_id().cast("string")
    key = F.when(F.col("of").isNull(), F.col("digest")).otherwise(row)
    found = F.coalesce("hot", "first").alias("first")
    joined = marked.withColumn("key", key).join(warm, "key", "left")
    return joined.select(*pages.columns, found)


def write(pages: DataFrame, folder: str) -> None:
    """Write archives of ``pages`` (page_id, url, html) into ``folder``."""
    arrow_rows(pages.sparkSession)
    own = with_first(pages.select(F.col("page_id").cast("bigint"), "url", "html"))

    def batch_of(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    # Ids stay Arrow longs: pandas turns longs beside nulls into doubles, which rounds them.
    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, size = [], 0
            names = ("page_id", "url", "html", "response", "rows")
            columns = (batch.column(c) for c in names)
            for page_id, url, page, response, rows in zip(*columns, strict=True):
                page_id, response = page_id.as_py(), response.as_py()
                # Records that may not be the only one with an id get a number of their own.
                suffix = f":{task}:{row}" if response is not None or rows.as_py() > 1 else ""
                row += 1
                for record in records_of(page_id, url.as_py(), page.as_py(), response, suffix):
                    out.append(record)
                    size += len(record)
                if size > 1 << 24:
                    yield batch_of(out)
                    out, size = [], 0
            yield batch_of(out)

    rows = F.coalesce("first.n", F.lit(0)).alias("rows")
    first = F.col("first.page_id")
    repeats = first.isNotNull() & ~first.eqNullSafe(F.col("page_id"))
    response = F.when(repeats, first).alias("response")
    named = own.select("page_id", "url", "html", response, rows)
    text = named.mapInArrow(framed, "record binary").select(F.col("record").cast("string"))
    text.write.option("lineSep", CLOSE).option("compression", "gzip").text(folder)


RECORD = (
    "record_id string, record_type string, origin string, segment int, total bigint, "
    "page_id bigint, payload_bytes bigint, payload_digest string, refers_to string, block binary"
)


def parsed(head: bytes) -> dict[str, str]:
    lines = head.split(END)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
    pairs = (line.partition(b":") for line in lines[1:])
    return {name.decode().lower(): value.strip().decode() for name, _, value in pairs}


def record_row(fields: dict[str, str], block: bytes) -> tuple:
    def number(name: str):
        return int(fields[name]) if name in fields else None

    page = fields.get("x-page-id")
    return (
        fields["warc-record-id"],
        fields["warc-type"],
        fields.get("warc-segment-origin-id"),
        number("warc-segment-number"),
        number("warc-segment-total-length"),
        None if page in (None, "None") else int(page),
        number("x-payload-length"),
        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        fields.get("warc-refers-to"),
        block,
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in ``folder``, segments as they are."""
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields_of = [f.split() for f in RECORD.split(",")]
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields_of])
    lines = spark.read.option("lineSep", CLOSE).text(folder)
    raw = lines.select(
        F.col("value").cast("binary").alias("part"), F.col("_metadata.file_path").alias("path")
    )
    close = CLOSE.encode()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(schema)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size, path = 0, None
        waiting, fields, start, end = bytearray(), None, 0, 0

        def end_of_archive() -> None:
            # A separator may be left that was no separator in the archive.
            if fields is not None or waiting.strip(END):
                raise ValueError(f"{path} breaks off in a record")
            waiting.clear()

        for batch in batches:
            for part, own_path in zip(batch.column("part"), batch.column("path"), strict=True):
                part, own_path = part.as_py(), own_path.as_py()
                if own_path != path:
                    end_of_archive()
                    path = own_path
                waiting += part
                waiting += close
                while True:
                    if fields is None:
                        found = waiting.find(close)
                        if found < 0 or not waiting.strip(END):
                            break
                        fields = parsed(bytes(waiting[:found]))
                        start = found + len(close)
                        end = start + int(fields["content-length"])
                    if len(waiting) < end + len(close):
                        break
                    if waiting[end : end + len(close)] != close:
                        raise ValueError(f"{path}: a block is not as long as it says")
                    out.append(record_row(fields, bytes(waiting[start:end])))
                    size += end - start
                    del waiting[: end + len(close)]
                    fields = None
                if size > 1 << 24:
                    yield batch_of(out)
                    out, size = [], 0
        end_of_archive()
        yield batch_of(out)

    return raw.mapInArrow(joined, RECORD)


def reassembled(records: DataFrame) -> DataFrame:
    """Records with whole blocks: segments are joined to the record they originate from.

    Raises while running if segment numbers have a gap or the length is not the total.
    """
    whole = records.filter("segment IS NULL").drop("origin", "segment", "total")
    kept = [c for c in whole.columns if c not in ("record_id", "block")]
    segments = records.filter("segment IS NOT NULL").withColumn(
        "origin", F.coalesce("origin", "record_id")
    )
    part = F.struct("segment", "block")
    first = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in kept]
    joined = segments.groupBy("origin").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.max("total").alias("total"), *first
    )
    numbers = F.col("parts.segment")
    right = numbers == F.sequence(F.lit(1), F.size("parts"))
    # Joined at once, as text in a set of characters that has one for each byte.
    texts = F.transform("parts", lambda p: F.decode(p["block"], "ISO-8859-1"))
    block = F.encode(F.array_join(texts, ""), "ISO-8859-1")
    built = joined.withColumn("block", block)
    right = right & (F.octet_length("block") == F.col("total"))
    checked = F.when(F.coalesce(right, F.lit(False)), F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("segments missing of "), F.col("origin"))).cast("binary")
    )
    built = built.select(F.col("origin").alias("record_id"), *kept, checked.alias("block"))
    return whole.unionByName(built)


def payloads(block: Column) -> Column:
    """A struct of length and digest of the payload of HTTP messages."""

    @F.pandas_udf("payload_bytes bigint, payload_digest string")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [http_payload(bytes(b)) for b in batch]
            yield pd.DataFrame(
                {"payload_bytes": [len(p) for p in own], "payload_digest": map(digest_text, own)}
            )

    return measured(block)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page of the archives: size and digest of its payload, type, what it revisits.

    Responses are measured on the payload taken from the archive, and must agree with the
    digest in their headers; revisits have what their headers say of the full payload.
    """
    arrow_rows(spark)
    records = reassembled(read_records(spark, folder))
    found = records.withColumn("found", payloads(F.col("block")))
    revisit = F.col("record_type") == "revisit"
    agrees = F.col("found.payload_digest") == F.col("payload_digest")
    digest = F.when(revisit | agrees, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.col("record_id")))
    )
    return found.select(
        "record_id",
        "page_id",
        F.when(revisit, F.col("payload_bytes"))
        .otherwise(F.col("found.payload_bytes"))
        .alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    write(read(spark, sf_dir, "pages"), folder)
    pages = read_pages(spark, folder)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type")
    return pages.select(*columns, page_of(F.col("refers_to")).alias("refers_to"))


OP10_SQL = r"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS least FROM hashed
), typed AS (
  SELECT *, least IS NOT NULL AND least IS DISTINCT FROM page_id AS again FROM named
)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(hex, 1 + 5 * (k // 4)::INT, 5))::BIGINT)
               >> (15 - 5 * (k % 4))::INT) & 31)::INT, 1) FOR k IN range(32)],
         'string_agg', '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN least END AS refers_to
FROM typed
"""
