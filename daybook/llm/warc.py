"""WARC archives with revisit resolution.

``write_archives`` computes one small header per page, finds the smallest page
of every payload digest that occurs more than once, joins the headers with
those originals, and writes deduplicated archives: a response record with the
payload for every original, a revisit record without payload, with fresh
headers that refer to the original, for every other page. Payloads are moved
once, by page, and never by digest, so a payload that a third of all pages share
does not gather in one task. ``read_archives`` reads the files back, and
``resolve`` joins revisit records with the responses they refer to.

Archives are gzip-compressed files of WARC/1.1 records in the folder shared by
all executors, written by Spark's text writer, whose line separator is the end
of a record. A reader holds one file at a time; ``file_pages`` bounds it.

Defined results: null html is an empty payload; a null url leaves out the
target header; payloads of fewer than ``min_bytes`` are all responses; rows
with one page_id and one payload are one record repeated and have one type; a
null page_id is never an original unless its payload has no other page, and
then is a response; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from daybook.llm.common import new_path

EOL = "\r\n"
RECORD_END = EOL + EOL
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The capture date of every record; pages carry none.
DATE = "2024-01-01T00:00:00Z"
FILE_PAGES = 20_000
SCHEMA = StructType([
    StructField("page_id", LongType()), StructField("url", StringType()), StructField("record_type", StringType()),
    StructField("payload_digest", StringType()), StructField("refers_to", LongType()), StructField("payload", BinaryType()),
])


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hex digits are 8 groups of 20 bits, each 4 letters."""
    letter = lambda v, shift: F.substr(F.lit(ALPHABET), F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))

    def encoded(digits: Column) -> Column:
        groups = [F.conv(F.substr(digits, F.lit(5 * i + 1), F.lit(5)), 16, 10).cast("int") for i in range(8)]
        return F.array_join(F.transform(F.array(*groups), lambda v: F.concat(*[letter(v, s) for s in (15, 10, 5, 0)])), "")

    # the one-element array holds the digest, so that it is computed once
    return F.get(F.transform(F.array(F.sha1(payload)), encoded), 0)


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def headers(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))


def revisits(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages that repeat the payload of a smaller page."""
    large = heads.filter(F.col("bytes") >= min_bytes)
    originals = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    return large.join(originals, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, file_pages: int = FILE_PAGES) -> None:
    repeated = revisits(headers(pages), min_bytes).select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to")
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").withColumn("digest", base32_sha1(payload))
    joined = rows.join(repeated.hint("shuffle_hash"), F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")
    again = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    head = F.concat(
        F.lit("WARC/1.1" + EOL),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page_urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", clean_url)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", page_urn(F.col("refers_to"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, F.lit(0)).otherwise(F.octet_length(payload)).cast("string")),
        F.lit(EOL),
    )
    # the string is the payload's own bytes: the writer does not look at them
    block = F.when(again, F.lit("")).otherwise(F.coalesce(F.col("html"), F.lit("")))
    joined.select(F.concat(head, block).alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", file_pages).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an uncompressed stream."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name.lower()] = value
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record ends before its block")
        yield fields, block


def urn_page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def read_archives(spark, path: str) -> DataFrame:
    """A row per record of the archives in ``path``; the digest of every response is verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                columns: list[list] = [[] for _ in types]
                held = 0
                for fields, block in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))):
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    response = fields["warc-type"] == "response"
                    if response and base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
                        raise ValueError(f"payload digest differs in {fields['warc-record-id']}")
                    row = (urn_page(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], digest, urn_page(fields.get("warc-refers-to")), block if response else None)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    held += len(block)
                    if held > 1 << 24:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=SCHEMA.names)
                        columns, held = [[] for _ in types], 0
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=SCHEMA.names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)


def resolve(records: DataFrame) -> DataFrame:
    """The contract's columns: revisit records get the payload's length from the response they refer to."""
    rows = records.select("page_id", "record_type", "payload_digest", "refers_to", F.octet_length("payload").cast("long").alias("own_bytes"))
    responses = rows.filter("record_type = 'response'")
    originals = responses.groupBy(F.col("page_id").alias("o_page"), F.col("payload_digest").alias("o_digest")).agg(F.max("own_bytes").alias("o_bytes"))
    repeated = rows.filter("record_type = 'revisit'").join(originals, (F.col("refers_to") == F.col("o_page")) & (F.col("payload_digest") == F.col("o_digest")), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return repeated.withColumn("payload_bytes", F.col("o_bytes")).select(columns).union(responses.withColumn("payload_bytes", F.col("own_bytes")).select(columns))


def round_trip(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return resolve(read_archives(spark, path))
