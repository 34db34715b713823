"""A content-addressed archive of WARC records.

Payload bytes are stored once, under their SHA-256. The exact bytes before the
payload (WARC header and HTTP header) are stored apart, a row per record, with
the payload's address. A join of both gives the original records back; every
payload read is held against its address.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayscope.llm.batches import bound_batches
from stayscope.llm.components import kept

#: Payloads of fewer bytes are never revisited.
LEAST_REVISIT = 1000
#: Rows of (digest, id) sent to every task; beyond it the join is by shuffle.
SENT_ROWS = 200_000
#: Crawl date of records made from pages, which have none.
DATE = "1970-01-01T00:00:00Z"
NAME = "urn:stayscope:page:"
END = "\r\n\r\n"


def _failed(message: str) -> Column:
    return F.raise_error(F.lit(message))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and payload (the html in UTF-8; null is empty) of every page, other columns left behind."""
    return pages.select(
        pages[id_col].cast("bigint").alias("page_id"),
        pages[url_col].cast("string").alias("url"),
        F.encode(F.coalesce(pages[html_col].cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )


def _headers(facts: DataFrame, least: int, date: str) -> DataFrame:
    """page_id, digest, stored (the record holds its payload) and head (exact header bytes) of every record.

    Of records with equal payloads of at least `least` bytes the one with the
    largest (page_id, url, place) is the response; the others revisit it.
    """
    row = F.struct("page_id", "url", "place")
    shared = facts.filter(F.col("size") >= least).groupBy("digest").agg(F.max(row).alias("top"), F.count("*").alias("n"))
    known = facts.join(shared.filter("n > 1").select("digest", "top"), "digest", "left")
    stored = F.col("top").isNull() | (F.col("place") == F.col("top.place"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END))

    def line(name: str, *value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n"))

    def page(column: Column) -> Column:
        return F.concat(F.lit(f"<{NAME}"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))

    # A line break in a url would end its header line, so such bytes are written as percent codes.
    uri = F.coalesce(F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(""))
    block = F.octet_length("http") + F.when(F.col("stored"), F.col("size")).otherwise(0)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("stored"), "response").otherwise("revisit")),
        line("WARC-Record-ID", page(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("sha1")),
        F.when(F.col("stored"), "").otherwise(F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", page(F.col("top.page_id"))),
        )),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.concat(F.lit("Content-Length: "), block, F.lit(END)),
        F.col("http"),
    )
    return known.withColumns({"stored": stored, "http": http}).select(
        "page_id", "digest", "stored", F.encode(head, "UTF-8").alias("head")
    )


def _one_of_each(records: DataFrame, facts: DataFrame) -> DataFrame:
    """digest and payload, once per digest.

    Only payloads that occur more than once are compared: of these the rows of
    the largest id are taken together, in the tasks first, so that a payload
    with a third of all rows sends one row per task. The others do not move.
    """
    named = records.select(F.sha2("payload", 256).alias("digest"), "page_id", "payload")
    several = facts.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("top")).filter("n > 1")
    several = several.select(F.col("digest").alias("digest_"), "top")
    if several.limit(SENT_ROWS + 1).count() <= SENT_ROWS:
        several = F.broadcast(several)
    joined = named.join(several, F.col("digest") == F.col("digest_"), "left")
    once = joined.filter("digest_ is null").select("digest", "payload")
    copies = joined.filter("digest_ is not null and page_id <=> top")
    return once.unionByName(copies.groupBy("digest").agg(F.first("payload").alias("payload")))


def write_archive(records: DataFrame, folder: str, least: int = LEAST_REVISIT, date: str = DATE) -> None:
    """Write headers and payloads of records (page_id, url, payload) below `folder`.

    Payloads are taken as equal by SHA-256; rows of one SHA-256 with different
    SHA-1 or size would fail the job. A null page_id is smaller than any other.
    Rows repeated with id and url are records each, one of them the response.
    """
    spark = records.sparkSession
    facts = kept(records.select(
        "page_id", "url", F.monotonically_increasing_id().alias("place"),
        F.octet_length("payload").cast("bigint").alias("size"),
        F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("digest"),
    ), f"{folder}/facts")
    clash = facts.groupBy("digest").agg(F.min(F.struct("sha1", "size")).alias("a"), F.max(F.struct("sha1", "size")).alias("b"))
    if not clash.filter("a <> b").isEmpty():
        raise ValueError("different payloads have one SHA-256")
    _headers(facts, least, date).write.parquet(f"{folder}/headers")
    _one_of_each(records, facts).write.parquet(f"{folder}/payloads")
    if spark.read.parquet(f"{folder}/payloads").count() != facts.select("digest").distinct().count():
        raise RuntimeError("the archive does not hold every payload once")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """head, payload (of a revisit: of the record it refers to) and stored of every record.

    Raises where a payload is missing or is not what its address says.
    """
    heads = spark.read.parquet(f"{folder}/headers").select("digest", "head", "stored")
    bodies = spark.read.parquet(f"{folder}/payloads").select(
        F.col("digest").alias("address"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
        .otherwise(_failed("a stored payload is not that of its address")).alias("body"),
    )
    found = heads.join(bodies, F.col("digest") == F.col("address"), "left")
    body = F.when(F.col("address").isNull(), _failed("a payload is missing")).otherwise(F.col("body"))
    return found.select("head", body.alias("payload"), "stored")


def record_bytes(found: DataFrame) -> DataFrame:
    """record: the bytes of every WARC record of `read_archive`, with the blank lines that end it."""
    body = F.when(F.col("stored"), F.col("payload")).otherwise(F.lit(b""))
    return found.select(F.concat("head", body, F.lit(END.encode())).alias("record"))


def _field(name: str) -> Column:
    """A field of the WARC header, read from its bytes; empty if there is none."""
    return F.regexp_extract(F.substring_index("text", END, 1), rf"\r\n{name}: ([^\r\n]*)", 1)


def page_facts(found: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest (hex SHA-1), record_type and refers_to of every record read.

    All but the payload's size and digest come from the record's own header;
    the digest is worked out from the payload and held against the header's.
    """
    sha1 = F.sha1("payload")
    digest = F.when(F.concat(F.lit("sha1:"), sha1) == F.col("said"), sha1).otherwise(_failed("a header has another digest"))

    def page(name: str) -> Column:
        return F.regexp_extract(_field(name), f"^<{NAME}(-?[0-9]+)>$", 1).try_cast("bigint")

    return found.withColumn("text", F.decode("head", "UTF-8")).withColumn("said", _field("WARC-Payload-Digest")).select(
        page("WARC-Record-ID").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        digest.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )


def export_files(found: DataFrame, folder: str, records_per_file: int = 10_000) -> None:
    """The records of `read_archive` as WARC files; each file holds whole records.

    Payloads must be UTF-8, as those of pages are: the files are written by
    Spark's text writer with the blank lines between records as line end.
    """
    body = F.when(F.col("stored"), F.col("payload")).otherwise(F.lit(b""))
    text = F.decode(F.concat("head", body), "UTF-8").alias("value")
    found.select(text).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(folder)


_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]+)", re.I)


def split_records(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """WARC header and block of each record of a file; raises on bytes that are no record."""
    at = 0
    while at < len(content):
        end = content.find(END.encode(), at)
        length = _LENGTH.search(content, at, end) if end > 0 else None
        if content[at:at + 5] != b"WARC/" or not length:
            raise ValueError(f"no record at byte {at}")
        begin = end + len(END)
        stop = begin + int(length[1])
        if content[stop:stop + len(END)] != END.encode():
            raise ValueError(f"the record at byte {at} is cut off")
        yield content[at:begin], content[begin:stop]
        at = stop + len(END)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """header, http and body of every record of uncompressed WARC files, split by their lengths.

    A file is read in one task and held there whole: write many of them.
    """
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                for header, block in split_records(content):
                    cut = block.find(END.encode())
                    cut = cut + len(END) if cut >= 0 and b"application/http" in header else 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], pa.binary()) for x in (header, block[:cut], block[cut:])],
                        names=["header", "http", "body"],
                    )

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(
        run, "header binary, http binary, body binary"
    )
