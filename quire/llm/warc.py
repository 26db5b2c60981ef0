"""WARC archives: write pages as request, response or revisit, and metadata records; read them back as captures.

Writing is DataFrame work: a record is a line of Spark's text writer whose separator is the two line ends that close a
WARC record, so files are committed by Spark on any shared store. Reading parses whole files by their content
lengths, then joins the records of a capture through their concurrent-to identifiers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import staged
from quire.session import scratch_path

END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BATCH_BYTES = 8 << 20
FILE_RECORDS = 30_000  # records per archive file, as files are read whole
GZIP_PART = 1 << 16
#: response kinds, the anchors of a capture
ANCHORS = ("response", "revisit", "resource")


def sha1_base32(sha1: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hex (160 bits: 32 digits, no padding), 40 bits at a time."""
    groups = [F.lpad(F.conv(F.substr(sha1, F.lit(at), F.lit(10)), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _block(*headers: tuple[str, Column | str | None]) -> Column:
    """Header lines, without those whose value is null."""
    lines = [F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v)) for k, v in headers]
    return F.concat_ws(END, F.lit("WARC/1.1"), *lines)


def _record(kind: str | Column, own: Column, start: Column, content: str, *more: tuple[str, Column | str], rest: Column | None = None) -> Column:
    """A record whose block is ``start`` and then ``rest``, which may be long: it enters the text once."""
    size = F.octet_length(start) if rest is None else F.octet_length(start) + F.octet_length(rest)
    head = _block(("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", F.col("date")),
                  ("WARC-Target-URI", F.col("uri")), *more, ("Content-Type", content), ("Content-Length", size.cast("string")))
    return F.concat(head, F.lit(END * 2), start, *([] if rest is None else [rest]))


def write(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one capture (request, response or revisit, metadata) per row.

    Of equal payloads of at least ``min_bytes`` bytes the row with the largest id is the response (every such row, if
    the id itself repeats), the others revisit it; smaller payloads are responses. A null payload is empty, a null
    url has no target line, a null id no ``page-id`` line and never is the largest unless all are null."""
    # urls may hold line ends or blanks, which would break the header
    uri = F.col(url).cast("string")
    for c in ("%0D", "%0A", "%09", "%20"):
        uri = F.replace(uri, F.lit(bytes.fromhex(c[1:]).decode()), F.lit(c))
    rows = pages.select(F.col(id_column).alias("id"), uri.alias("uri"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("sha1", F.sha1("body")).withColumn("digest", sha1_base32(F.col("sha1"))).drop("sha1")
    narrow = staged(rows.select("id", "digest", F.octet_length("body").alias("bytes")), "warc-digests")
    # the rows that revisit another: written first, so that Spark knows their size when it plans the join with the pages
    latest = narrow.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("id").alias("latest"), F.count("*").alias("n")) \
        .where("n > 1")
    again = narrow.join(latest, "digest").where(~F.col("id").eqNullSafe(F.col("latest"))).select(
        F.col("id").alias("of"), F.col("digest").alias("of_digest"), F.lit(True).alias("old")).distinct()
    named = rows.join(staged(again, "warc-revisits"), F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    named = named.withColumn("fresh", F.col("old").isNull()).drop("of", "of_digest", "old")
    # the identifier of a capture: its content and its place in this one write, unique among repeated rows
    place = F.md5(F.concat_ws("|", F.col("id").cast("string"), "uri", "digest", F.monotonically_increasing_id().cast("string")))
    named = named.withColumn("date", F.lit(date)).withColumn("place", place)

    def name(role: str) -> Column:
        h = F.md5(F.concat(F.col("place"), F.lit(role)))
        parts = [F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    main = name("response")
    # the host is for the request line alone, so any text will do where the url has none
    host = F.coalesce(F.regexp_extract("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    query = F.coalesce(F.regexp_extract("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), F.when(query == "", "/").otherwise(query), F.lit(f" HTTP/1.1{END}Host: "), host,
                       F.lit(END * 2))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.octet_length("body").cast("string"), F.lit(END * 2))
    fields = F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(END)), F.lit(""))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    http = "application/http; msgtype="
    named = named.withColumn("head", head)
    answer = _record(F.when(F.col("fresh"), "response").otherwise("revisit"), main, F.col("head"), http + "response", digest,
                     ("WARC-Profile", F.when(~F.col("fresh"), PROFILE)), rest=F.when(F.col("fresh"), F.col("body")).otherwise(""))
    records = F.array(_record("request", name("request"), request, http + "request", ("WARC-Concurrent-To", main)),
                      answer,
                      _record("metadata", name("metadata"), fields, "application/warc-fields",
                              ("WARC-Concurrent-To", main)))
    named.select(F.explode(records).alias("value")).write.option("lineSep", END * 2).option("compression", "gzip") \
        .option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _members(data: bytes) -> bytes:
    """The content of a gzip file of one or many members, each read once."""
    plain, at = [], 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof and at < len(data):
            part = data[at:at + GZIP_PART]
            plain.append(member.decompress(part))
            at += len(part) - len(member.unused_data)
        if not member.eof:
            raise ValueError("gzip member is cut off")
        while data[at:at + 1] == b"\0":  # padding
            at += 1
    return b"".join(plain)


def parse(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """The records of an archive file: headers by lower-case name, and the block.

    Plain, or gzip of one or many members. A record without a readable length, or one that is cut off, ends the
    reading with an error."""
    if data[:2] == b"\x1f\x8b":
        data = _members(data)
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        headers = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace")
                   for k, _, v in (x.partition(b":") for x in lines[1:])}
        if end < 0 or not lines[0].startswith(b"WARC/") or not headers.get("content-length", "").isdigit():
            raise ValueError(f"no WARC record at byte {at}")
        size = int(headers["content-length"])
        if end + 4 + size > len(data):
            raise ValueError(f"WARC record at byte {at} is cut off")
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records under a folder: type, record_id, concurrent_to, uri, date, declared_digest, refers_to, http (header
    of request and response blocks) and payload (the block, after that header)."""
    columns = ["type", "record_id", "concurrent_to", "uri", "date", "declared_digest", "refers_to", "http"]
    names = ["warc-type", "warc-record-id", "warc-concurrent-to", "warc-target-uri", "warc-date", "warc-payload-digest",
             "warc-refers-to"]
    schema = pa.schema([(c, pa.string()) for c in columns] + [("payload", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in parse(content.as_py()):
                    http = None
                    if headers.get("content-type", "").startswith("application/http"):
                        head, _, block = block.partition(b"\r\n\r\n")
                        http = head.decode("utf-8", "replace")
                    rows.append([headers.get(n) for n in names] + [http, block])
                    size += len(block) + 200
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(scan, ", ".join(f"{c} string" for c in columns) + ", payload binary")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: record_id, response (a struct of the records' other columns), requests and metadata (arrays).

    A request or metadata record belongs to the response it is concurrent to, or that is concurrent to it, or
    to the response of the request it names. Records that reach no response make no row."""
    columns = [c for c in records.columns if c not in ("concurrent_to",)]
    anchor = F.col("type").isin(*ANCHORS)
    direct = records.where(anchor & F.col("concurrent_to").isNotNull()).select(
        F.col("concurrent_to").alias("via"), F.col("record_id").alias("to"))
    request = records.where((F.col("type") == "request") & F.col("concurrent_to").isNotNull()).select(
        F.col("record_id").alias("via"), F.col("concurrent_to").alias("to"))
    steps = direct.union(request).groupBy("via").agg(F.min("to").alias("to"))
    others = records.where(~anchor).join(
        steps, F.coalesce(F.col("concurrent_to"), F.col("record_id")) == F.col("via"), "left")
    others = others.withColumn("capture", F.coalesce("to", "concurrent_to"))
    rows = records.where(anchor).withColumn("capture", F.col("record_id")).select("capture", *columns) \
        .union(others.where("capture IS NOT NULL").select("capture", *columns))
    whole = F.struct(*columns)
    return rows.groupBy("capture").agg(
        F.first(F.when(anchor, whole), ignorenulls=True).alias("response"),
        F.collect_list(F.when(F.col("type") == "request", whole)).alias("requests"),
        F.collect_list(F.when(F.col("type") == "metadata", whole)).alias("metadata")) \
        .where("response IS NOT NULL").withColumnRenamed("capture", "record_id")


def archive_captures(pages: DataFrame, id_column: str = "page_id", url: str = "url", payload: str = "html",
                     min_bytes: int = 0) -> DataFrame:
    """Write pages to archives in the shared folder, read them back, and return one row per page:
    (id, payload_bytes, payload_digest, record_type, refers_to).

    Sizes and digests are taken from the payloads read; a revisit gets those of the response with its digest.
    Empty table: no rows."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, id_column, url, payload, min_bytes)
    found = read(spark, path)
    fresh = F.col("type") == "response"
    found = found.withColumn("payload_bytes", F.when(fresh, F.octet_length("payload").cast("long"))) \
        .withColumn("sha1", F.sha1("payload")) \
        .withColumn("digest", F.when(fresh, sha1_base32(F.col("sha1")))
                    .otherwise(F.regexp_replace("declared_digest", "^sha1:", ""))) \
        .withColumn("fields", F.when(F.col("type") == "metadata", F.col("payload").cast("string"))).drop("payload", "sha1")
    kind = pages.schema[id_column].dataType.simpleString()
    page = F.nullif(F.regexp_extract(F.get("metadata", 0)["fields"], r"(?m)^page-id: (.*?)\r?$", 1), F.lit(""))
    captures = staged(assemble(found).select(page.cast(kind).alias("id"), "response.type", "response.digest", "response.payload_bytes"),
                      "captures")
    sources = captures.where("type = 'response'").groupBy("digest").agg(
        F.max("id").alias("source"), F.max("payload_bytes").alias("source_bytes"))
    revisit = F.col("type") == "revisit"
    return captures.where(~revisit).select(
        "id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.lit(None).cast(kind).alias("refers_to")).union(
        captures.where(revisit).join(sources, "digest", "left").select(
            "id", F.col("source_bytes"), F.col("digest"), "type", F.col("source")))
