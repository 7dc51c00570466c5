"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: the request, the response (or a revisit that refers to
an earlier response with the same payload) and metadata. Records of one capture
name a common record by ``WARC-Concurrent-To``; assembly joins them on it and
gives one nested row per capture.
"""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.runtime import fresh_folder, stored

CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 1_000


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing where the value is null. Control characters and
    spaces can't stand in a value."""
    clean = F.regexp_replace(value.cast("string"), "[\\x00-\\x20\\x7f]", "")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its last line end, which the writer adds."""
    lines = [F.lit(VERSION + CRLF), _header("WARC-Type", kind), *(_header(n, v) for n, v in headers)]
    return F.concat(*lines, _header("Content-Length", F.octet_length(block)), F.lit(CRLF), block, F.lit(CRLF))


def write_captures(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write ``page_id``, ``url``, ``html`` as archives; returns their folder.

    Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes the one with
    the largest ``page_id`` is written as a response, the others as revisits that
    refer to it. Rows that share that ``page_id`` too are each a response. A null
    html has an empty payload; a null url has no target; a null ``page_id`` is less
    than any other and leaves no line. Archives are about as large as a shuffle
    partition (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), each one gzip
    member. An empty table makes a folder without records.
    """
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    size = F.octet_length("html")
    first = stored(
        base.where(size >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1"),
        "repeated-payloads",
    )
    again = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    judged = base.join(first, "digest", "left").withColumn("again", again).hint("rebalance")
    ids = judged.withColumn("capture", F.uuid())

    def urn(part: str, *values: Column) -> Column:
        return F.concat(F.lit(f"<urn:{part}:"), *values, F.lit(">"))

    def response_id(page: Column) -> Column:
        return urn("response", F.col("digest"), F.lit(":"), F.coalesce(page.cast("string"), F.lit("none")))

    center = urn("request", F.col("capture"))
    shared = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit("\r\n\r\n"),
    )
    request = _record(
        F.lit("request"),
        [("WARC-Record-ID", center), *shared, ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.lit("GET / HTTP/1.1\r\n\r\n"),
    )
    # A revisit has an id of its own: no record refers to it.
    own_id = F.when(F.col("again"), urn("revisit", F.col("capture"))).otherwise(response_id(F.col("page_id")))
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", own_id),
            ("WARC-Concurrent-To", center),
            *shared,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Refers-To", F.when(F.col("again"), response_id(F.col("first")))),
            ("WARC-Profile", F.when(F.col("again"), F.lit(REVISIT_PROFILE))),
            ("Content-Type", F.lit("application/http;msgtype=response")),
        ],
        F.when(F.col("again"), http).otherwise(F.concat(http, "html")),
    )
    metadata = _record(
        F.lit("metadata"),
        [
            ("WARC-Record-ID", urn("metadata", F.col("capture"))),
            ("WARC-Concurrent-To", center),
            *shared,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        _header("page-id", F.col("page_id")),
    )
    folder = fresh_folder(spark, "warc")
    records = ids.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", CRLF).option("compression", "gzip").text(folder)
    return folder


RECORD = pa.schema(
    [
        ("type", pa.string()),
        ("record_id", pa.string()),
        ("concurrent_to", pa.string()),
        ("refers_to", pa.string()),
        ("target", pa.string()),
        ("date", pa.string()),
        ("digest", pa.string()),
        ("content_type", pa.string()),
        ("head", pa.binary()),
        ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "type string, record_id string, concurrent_to string, refers_to string, target string, date string,"
    " digest string, content_type string, head binary, payload binary"
)
HEADERS = {
    "type": b"warc-type",
    "record_id": b"warc-record-id",
    "concurrent_to": b"warc-concurrent-to",
    "refers_to": b"warc-refers-to",
    "target": b"warc-target-uri",
    "date": b"warc-date",
    "digest": b"warc-payload-digest",
    "content_type": b"content-type",
}


def _plain(content: bytes) -> bytes:
    """Gzip members one after another, or bytes as they are."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


def parsed(content: bytes) -> Iterator[dict]:
    """The records of one archive; ``Content-Length`` alone says where a block ends."""
    data, at = _plain(content), 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        headers = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers.setdefault(name.strip().lower(), value.strip())
        size = int(headers[b"content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError("the archive ends inside a record")
        at = end + 4 + size
        row = {k: v.decode("utf-8", "replace") if (v := headers.get(n)) is not None else None for k, n in HEADERS.items()}
        head, payload = b"", block
        if headers.get(b"content-type", b"").lower().startswith(b"application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
        yield row | {"head": head, "payload": payload}


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in a folder, one row each. An archive is read
    whole by one task; it must fit a task's memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for row in parsed(content.as_py()):
                    rows.append(row)
                    held += len(row["payload"])
                    if held > 8 << 20 or len(rows) >= 1_000:
                        yield pa.RecordBatch.from_pylist(rows, RECORD)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORD)

    archives = spark.read.format("binaryFile").load(folder).select("content")
    return archives.mapInArrow(run, RECORD_DDL)


def described(records: DataFrame) -> DataFrame:
    """Records with ``payload_bytes`` and ``payload_digest`` (hexadecimal SHA-1)."""
    return records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.sha1("payload")
    )


def without_pages(records: DataFrame) -> DataFrame:
    """Described records as a stored table that keeps only metadata payloads; the
    archives are then parsed once however often the records are read."""
    kept = F.when(F.col("type") == "metadata", F.col("payload"))
    return stored(records.withColumn("payload", kept), "warc-records")


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit, with ``request``, ``response`` and
    ``metadata`` as nested rows.

    The records of a capture name one of them, the one that names none; that id is
    the key of the joins. A missing request or metadata record is null. Records of
    other types are left out.
    """
    keyed = records.withColumn("transaction", F.coalesce("concurrent_to", "record_id"))

    def part(kinds: list[str], name: str) -> DataFrame:
        nested = F.struct(*(F.col(c) for c in records.columns)).alias(name)
        return keyed.where(F.col("type").isin(kinds)).select("transaction", nested)

    captures = part(["response", "revisit"], "response")
    for name in ("request", "metadata"):
        captures = captures.join(part([name], name), "transaction", "left")
    return captures.select("request", "response", "metadata")


def field(block: Column, name: str) -> Column:
    """A field of an ``application/warc-fields`` block, null if it is missing."""
    found = F.regexp_extract(block.cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def resolved(captures: DataFrame) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` of captures of described records: a revisit's payload is that of the response it refers to."""
    response = F.col("response")
    seen = stored(
        captures.select(
            field(F.col("metadata.payload"), "page-id").cast("long").alias("page_id"),
            response["type"].alias("record_type"),
            response["record_id"].alias("record_id"),
            response["refers_to"].alias("refers"),
            response["payload_bytes"].alias("own_bytes"),
            response["payload_digest"].alias("own_digest"),
            F.regexp_replace(response["digest"], "^sha1:", "").alias("said_digest"),
        ),
        "captures",
    )
    originals = stored(
        seen.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers"))
        .agg(F.max("page_id").alias("original"), F.max("own_bytes").alias("bytes")),
        "responses",
    )
    revisit = F.col("record_type") == "revisit"
    return seen.join(originals, "refers", "left").select(
        "page_id",
        F.when(revisit, F.col("bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("said_digest")).otherwise(F.col("own_digest")).alias("payload_digest"),
        "record_type",
        F.when(revisit, F.col("original")).alias("refers_to"),
    )
