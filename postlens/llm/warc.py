"""WARC archives: writing captures, reading records, assembling transactions.

A page is written as three records: its request, a response (or a revisit, if a
page of a larger id has the same payload) and metadata. Response and metadata
name the request in WARC-Concurrent-To; a revisit names the response it repeats
in WARC-Refers-To. Spark's text writer with the record end as line separator
makes the archives, so its commit protocol covers lost tasks.

Reading parses archives by Content-Length, so payloads may hold anything; gzip
files of one or many members and plain files are read alike. ``assemble`` joins
the records of a capture through the concurrent-to identifiers into one row.

An archive is read by one task as a whole, so its size is bounded by bytes: payloads
are written by classes of size (SIZES), each class in archives of as many records as
make ARCHIVE_BYTES of its longest one, so no archive has more, however the pages lie; payloads beyond the last class are
archives of few records, at least one. A payload has to fit one value of Spark (2 GB).

Edge cases: a null payload is empty; a null or multi-line URL is written on one
line; repeated page rows are captures of their own (none revisits the other, as
both have the largest page_id); null page ids count as the smallest; captures
that lack a record have null in its place, and of several records of one kind
the least record id stays, with the count beside it. An empty table gives no
captures. Only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

#: Payloads under so many bytes are always written in full.
LEAST_REVISIT_BYTES = 1000
#: Payload bytes of an archive, and pages of one at most.
ARCHIVE_BYTES, ARCHIVE_PAGES = 64 << 20, 4000
#: The longest payload of each class of sizes.
SIZES = (1 << 16, 1 << 20, 1 << 24)
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "record_id string, warc_type string, concurrent_to string, refers_to string, target_uri string, payload_digest string, payload_bytes long, fields string"


def _uuid(x: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(x), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: Column, record_id: Column, uri: Column, block: Column, content_type: str, more: Column) -> Column:
    """One record without the two line ends that close it; ``more``: further header lines, each with its line end."""
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        head("WARC-Type", kind),
        head("WARC-Record-ID", record_id),
        head("WARC-Date", F.lit(DATE)),
        head("WARC-Target-URI", uri),
        more,
        head("Content-Type", F.lit(content_type)),
        head("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the captures of ``pages`` (``page_id, url, html``) as archives in the folder ``path``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    edges = [-1, *SIZES]
    inside = [(F.col("size") > a) & (F.col("size") <= b) for a, b in zip(edges, SIZES)] + [F.col("size") > SIZES[-1]]
    longest = pages.agg(*[F.max(F.when(x, F.col("size"))) for x in inside]).first()  # of each class; null if it is empty
    repeated = pages.where(F.col("size") >= LEAST_REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    paged = pages.join(repeated, ["digest", "size"], "left")
    name = lambda page: _uuid(F.concat_ws(":", F.lit("payload"), F.coalesce(page.cast("string"), F.lit("")), "digest"))
    revisit = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id"))
    columns = lambda: [  # noqa: E731  made anew for each job: ids drawn from one seed would come again
        "page_id",
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("uri"),
        revisit.alias("revisit"),
        name(F.col("page_id")).alias("response_id"),
        name(F.col("kept")).alias("kept_id"),
        _uuid(F.uuid()).alias("request_id"),  # one for each row, so that repeated rows stay apart
        "digest",
        "html",
    ]
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    with_request = line("WARC-Concurrent-To", F.col("request_id"))
    digest = line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    profile = F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")
    uri = F.col("uri")
    request = _record(F.lit("request"), F.col("request_id"), uri, F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\n\r\n")), "application/http; msgtype=request", F.lit(""))
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.when(F.col("revisit"), _uuid(F.concat(F.lit("revisit"), "request_id"))).otherwise(F.col("response_id")),
        uri,
        F.concat(F.lit(HTTP), F.when(F.col("revisit"), "").otherwise(F.col("html"))),
        "application/http; msgtype=response",
        F.concat(with_request, digest, F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", F.col("kept_id")), profile)).otherwise("")),
    )
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n"))
    metadata = _record(F.lit("metadata"), _uuid(F.concat(F.lit("metadata"), "request_id")), uri, fields, "application/warc-fields", with_request)

    def write(some: DataFrame, most: int, mode: str) -> None:
        count = 3 * max(1, min(ARCHIVE_PAGES, ARCHIVE_BYTES // max(1, most)))
        records = some.select(*columns()).select(F.explode(F.array(request, response, metadata)).alias("value"))
        records.write.mode(mode).option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", count).text(path)

    some = [(x, most) for x, most in zip(inside, longest) if most is not None]
    for n, (x, most) in enumerate(some):
        write(paged.where(x), most, "append" if n else "errorifexists")
    if not some:
        write(paged, 0, "errorifexists")


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header (names in lower case) and block of each record."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if content[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError("not a WARC record")
            continue
        head = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        size = int(head.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends inside a record")
        yield head, block


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """All records of the archives below ``path``; ``payload`` adds the payload bytes.

    Digest (bare lower-case hex SHA-1) and length are of the payload as read; a
    revisit's are the digest it states and null.
    """
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * payload
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string()] + [pa.binary()] * payload

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in (x.as_py() for b in batches for x in b.column("content")):
            rows, held = [], 0
            for head, block in _records(content):
                kind = head.get("warc-type")
                http = head.get("content-type", "").startswith("application/http")
                body = block.partition(b"\r\n\r\n")[2] if http else block
                revisit = kind == "revisit"
                row = (
                    head.get("warc-record-id"),
                    kind,
                    head.get("warc-concurrent-to"),
                    head.get("warc-refers-to"),
                    head.get("warc-target-uri"),
                    head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else hashlib.sha1(body).hexdigest(),
                    None if revisit else len(body),
                    block.decode("utf-8", "replace") if kind == "metadata" else None,
                )
                rows.append(row + ((body,) if payload else ()))
                held += len(body) if payload else 0
                if len(rows) == 5000 or held > 8 << 20:
                    yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, RECORD + (", payload binary" if payload else ""))


def assemble(records: DataFrame) -> DataFrame:
    """One row for each capture: ``capture_id, request, response, metadata`` (structs), ``records``.

    A capture is named by its request's id, which its other records give in
    WARC-Concurrent-To; a record that names none is a capture of its own.
    """
    own = [k for k in records.columns if k not in ("warc_type", "concurrent_to")]
    whole = F.struct(*own[:1], "warc_type", *own[1:])
    of = lambda *kinds: F.min(F.when(F.col("warc_type").isin(*kinds), whole))
    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        of("request").alias("request"), of("response", "revisit", "resource").alias("response"), of("metadata").alias("metadata"), F.count("*").alias("records")
    )


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of assembled captures.

    A revisit takes its length from the response it refers to, and that page's id.
    """
    rows = captures.where("response IS NOT NULL").select(F.expr(r"try_cast(nullif(regexp_extract(metadata.fields, '(?m)^page-id: *(-?[0-9]+)', 1), '') AS bigint)").alias("page_id"), "response.*")
    full = rows.where("warc_type <> 'revisit'").groupBy("record_id").agg(F.max("page_id").alias("full_page"), F.max("payload_bytes").alias("full_bytes"))
    found = rows.join(full.withColumnRenamed("record_id", "full_id"), F.col("refers_to") == F.col("full_id"), "left")
    return found.select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", F.when(F.col("warc_type") == "revisit", "revisit").otherwise("response").alias("record_type"), F.col("full_page").alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and assemble them."""
    spark = pages.sparkSession
    path = store.new_path(spark, "warc")
    write_archives(pages, path)
    store.release(spark)
    return resolve_revisits(store.table(assemble(read_records(spark, path)), "captures"))
