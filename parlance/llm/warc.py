"""Web archives: writing captures as request, response or revisit, and metadata records, and assembling them again.

``write_archives`` turns every page into three WARC records and writes them as gzipped archive files. Of pages
with equal payloads of at least ``min_revisit`` bytes, the one with the largest id is the response and the others
are revisits that refer to it; smaller payloads are responses always. ``read_records`` parses archives by their
records' lengths. ``assemble`` joins a capture's records through their concurrent-to identifiers and gives one
nested row for each capture; a revisit's payload facts come from the response it refers to.

Archives are written by Spark's text sink: a record ends with two line ends, which is the sink's line separator.

Defined results: null html is an empty payload; rows with a null id are responses and never referred to; rows
with equal ids and payloads are captures of their own, all of them responses if theirs is the largest id; an
empty table gives no archive; columns other than id, url and html are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.llm.common import fresh_path, store

END = b"\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
RECORD = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, page_id long, payload_digest string, content binary"
#: Captures in one archive file, which bounds what a reading task opens at once.
CAPTURES_PER_FILE = 20_000


def record_id(kind: str, page_id: Column, digest: Column, copy: Column) -> Column:
    """A name-based identifier: the same kind, page, payload and copy always have the same one."""
    h = F.md5(F.concat_ws("/", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("none")), digest, copy.cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def record(kind: Column | str, rid: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its two line ends, as text of the exact bytes."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), rid), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{k}: "), v) for k, v in headers]  # a null value leaves the header out
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def captures(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """page_id, copy, url, html, digest, refers_to for every page; html is shuffled once, by page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    facts = rows.select("page_id", "digest", F.octet_length("html").alias("bytes")).filter(F.col("bytes") >= min_revisit)
    same = facts.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    # the ids that revisit, one row each; one digest may have a third of all rows, so both sides of the join stay bare
    same = store(same, "warc-same")
    revisits = facts.join(same, "digest").filter("page_id <> first").select("page_id", "digest", "first").distinct()
    # rows of one page id and payload are told apart by a number
    numbered = rows.withColumn("copy", F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url")))
    return numbered.join(revisits, ["page_id", "digest"], "left").select("page_id", "copy", "url", "html", "digest", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 1000) -> None:
    c = captures(pages, id_col, url_col, html_col, min_revisit)
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    own = (F.col("page_id"), F.col("digest"), F.col("copy"))
    main = record_id("capture", *own)
    uri = F.regexp_replace(F.coalesce("url", F.lit("urn:x-none")), r"[\x00-\x20]", "%20")
    path_part = F.coalesce(F.nullif(F.regexp_extract(uri, r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.regexp_extract(uri, r"^[a-z]+://([^/?#]*)", 1)
    page = F.col("page_id").cast("string")
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    referred = F.when(F.col("refers_to").isNotNull(), record_id("capture", F.col("refers_to"), F.col("digest"), F.lit(1)))
    response = record(
        kind, main,
        [("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("WARC-Page-ID", page), ("Content-Type", F.lit("application/http;msgtype=response")),
         ("WARC-Refers-To", referred),
         ("WARC-Profile", F.when(F.col("refers_to").isNotNull(), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))],
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("")),
    )
    request = record(
        "request", record_id("request", *own),
        [("WARC-Target-URI", uri), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), path_part, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
    )
    metadata = record(
        "metadata", record_id("metadata", *own),
        [("WARC-Target-URI", uri), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("fetchTimeMs: 0\r\npageId: "), F.coalesce(page, F.lit("none")), F.lit("\r\n")),
    )
    joined = F.concat_ws(END.decode(), request, response, metadata)
    c.select(joined.alias("value")).write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", CAPTURES_PER_FILE).text(path)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped archive, which may have any number of members."""
    held = bytearray()
    rest, pos = data, 0

    def more() -> bool:
        nonlocal rest, stream
        while rest:
            got = stream.decompress(rest, 1 << 20)
            rest = stream.unconsumed_tail
            if stream.eof:
                rest, stream = stream.unused_data, zlib.decompressobj(31)
            if got:
                held.extend(got)
                return True
        return False

    stream = zlib.decompressobj(31)
    while True:
        while (stop := held.find(END, pos)) < 0:
            del held[:pos]
            pos = 0
            if not more():
                return
        lines = held[pos:stop].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        size = int(headers.get("Content-Length", 0))
        while len(held) < stop + 4 + size and more():
            pass
        yield headers, bytes(held[stop + 4 : stop + 4 + size])
        pos = stop + 4 + size + 4
        if pos > 1 << 22:
            del held[:pos]
            pos = 0


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives in a folder; content is the payload of HTTP records, else the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows.clear()
            held = 0
            return out

        for batch in batches:
            for data in batch.column(0).to_pylist():
                for h, block in records(data):
                    if "application/http" in h.get("Content-Type", ""):
                        block = block.partition(END)[2] if h["WARC-Type"] != "request" else block
                    page = h.get("WARC-Page-ID")
                    rows.append((h.get("WARC-Record-ID"), h.get("WARC-Type"), h.get("WARC-Concurrent-To"), h.get("WARC-Refers-To"), h.get("WARC-Target-URI"), int(page) if page else None, h.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, block))
                    held += len(block) + 300
                    if held > 1 << 24:
                        yield flush()
        if rows:
            yield flush()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One row for each capture: its response or revisit with payload facts, and its request and metadata, nested.

    Only facts of payloads are shuffled, not the payloads: the digest and the length are taken as records are read.
    """
    facts = found.select(
        "record_id", "type", "concurrent_to", "refers_to", "target_uri", "page_id", "payload_digest",
        F.octet_length("content").cast("long").alias("bytes"),
        F.when(F.col("type") == "response", F.sha1("content")).alias("sha1"),
        F.when(F.col("type").isin("request", "metadata"), F.decode("content", "UTF-8")).alias("block"),
    )
    facts = store(facts, "warc-facts")
    main = facts.filter("type IN ('response', 'revisit')").select(F.col("record_id").alias("capture_id"), "type", "target_uri", "page_id", "refers_to", "payload_digest", "bytes", "sha1")
    beside = facts.filter("type IN ('request', 'metadata')")
    ones = beside.groupBy(F.col("concurrent_to").alias("capture_id")).agg(
        F.max(F.when(F.col("type") == "request", F.struct("record_id", "block"))).alias("request"),
        F.max(F.when(F.col("type") == "metadata", F.struct("record_id", "block"))).alias("metadata"),
    )
    captured = store(main.join(ones, "capture_id", "left"), "warc-captures")
    # one response may be referred to by a third of all captures: a plain join, whose large side Spark can split
    responses = captured.filter("type = 'response'")
    shown = store(main.filter("type = 'response'").select(F.col("capture_id").alias("of"), F.col("page_id").alias("of_page"), F.col("sha1").alias("of_sha1"), F.col("bytes").alias("of_bytes")), "warc-responses")
    revisits = captured.filter("type = 'revisit'").join(shown, F.col("refers_to") == F.col("of"), "left")
    cols = ["capture_id", "page_id", "type", "target_uri"]
    return responses.select(*cols, F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"), "request", "metadata").unionByName(
        revisits.select(*cols, F.col("of_bytes").alias("payload_bytes"), F.col("of_sha1").alias("payload_digest"), F.col("of_page").alias("refers_to"), "request", "metadata")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder, read these back and assemble the captures."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return assemble(read_records(pages.sparkSession, path))
