"""WARC archives: writing, reading, and resolution of revisits by payload digest.

Spark's text writer makes the files: a record is one value, and the two line ends after it are the line separator. The
writer's commit protocol makes a lost executor's files disappear, and any store that Spark writes to will do.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

LEAST_BYTES = 1000
#: Keys that a digest's headers are dealt to, and bytes of payloads in an archive of records of mean size.
SALTS, ARCHIVE_BYTES = 16, 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
RECORD = "record_id string, page_id string, record_type string, uri string, payload_digest string, payload_bytes long, refers_to_record string, intact boolean"


def _record_id(key: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), key))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def resolve(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Adds record_type and refers_to (an id) to records (id, payload_digest, payload_bytes, ...).

    Headers only are shuffled by digest: each digest's largest id by partial maxima, and the headers that revisit it by
    several keys a digest, so that one which a third of the records share is no hot key. Payloads meet the decisions by
    their own ids.
    """
    heads = records.filter(F.col("payload_bytes") >= least_bytes).select("payload_digest", "id")
    firsts = heads.groupBy("payload_digest").agg(F.max("id").alias("first"), F.count("*").alias("k")).filter("k > 1 and first is not null")
    firsts = firsts.select("payload_digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = heads.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    revisits = salted.join(firsts, ["payload_digest", "salt"]).filter(~F.col("id").eqNullSafe(F.col("first"))).select(F.col("payload_digest").alias("d"), F.col("id").alias("i"), "first")
    met = records.join(revisits, F.col("id").eqNullSafe(F.col("i")) & (F.col("payload_digest") == F.col("d")), "left")
    return met.withColumn("record_type", F.when(F.col("first").isNotNull(), "revisit").otherwise("response")).withColumnRenamed("first", "refers_to").drop("i", "d")


def write_archives(records: DataFrame, path: str, date: str = DATE, compression: str = "gzip") -> None:
    """records: id, uri, payload (strings), payload_digest, payload_bytes, record_type, refers_to. All headers are new. An archive is read as one
    value, so it holds as many records as ARCHIVE_BYTES has place for at their mean size."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit(""))
    clean = F.regexp_replace("uri", r"[\x00-\x20\x7f]+", "%20")
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL * 2))
    text_id = F.col("id").cast("string")
    digest = F.concat(F.lit("sha1:"), "payload_digest")
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Type: "), "record_type", F.lit(EOL),
        line("WARC-Record-ID", _record_id(F.coalesce(text_id, F.lit("")))),
        F.lit(f"WARC-Date: {date}{EOL}"),
        line("WARC-Target-URI", clean),
        line("X-Page-Id", text_id),
        line("WARC-Payload-Digest", digest),
        F.when(is_revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{EOL}"), line("WARC-Refers-To", _record_id(F.col("refers_to").cast("string"))))).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}Content-Length: "),
    )
    length = (F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("payload_bytes"))).cast("string")
    record = F.concat(head, length, F.lit(EOL * 2), http, F.when(is_revisit, "").otherwise(F.col("payload")))
    mean = records.agg(F.avg("payload_bytes")).first()[0] or 0.0
    most = int(max(1, min(20_000, ARCHIVE_BYTES / (mean + 1000))))
    records.select(record.alias("value")).write.option("lineSep", EOL * 2).option("compression", compression).option("maxRecordsPerFile", most).text(path)


def _headers(block: bytes) -> dict[str, str]:
    rows = (x.partition(b":") for x in block.split(b"\r\n")[1:])
    return {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in rows}


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record; lengths decide, so a payload may hold any bytes. A record that is cut off, or whose
    length is missing or no number, raises a ValueError: what follows it can't be told from its payload."""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        head = _headers(data[at:end]) if end >= 0 else {}
        if not head.get("content-length", "").isdecimal() or end + 4 + (size := int(head["content-length"])) > len(data):
            raise ValueError(f"malformed WARC record at byte {at}")
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under path. Of a response, digest and length are those of the payload read, and
    ``intact`` says whether its header agrees; of a revisit, they are those that its headers state."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for head, block in parse(content):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated, kind = head.get("warc-payload-digest", "").removeprefix("sha1:"), head.get("warc-type")
                    if kind == "revisit":
                        digest, size, intact = stated, int(_headers(http).get("content-length", 0)), True
                    else:
                        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                        intact = digest == stated
                    rows.append((head.get("warc-record-id"), head.get("x-page-id"), kind, head.get("warc-target-uri"), digest, size, head.get("warc-refers-to"), intact))
                    if len(rows) == 5000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, RECORD)


def page_records(pages: DataFrame) -> DataFrame:
    """Records of pages (page_id, url, html). A null html is an empty payload, a null url leaves its header out."""
    p = pages.select(F.col("page_id").alias("id"), F.col("url").cast("string").alias("uri"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    return p.withColumn("payload_digest", F.sha1(F.col("payload").cast("binary"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))


def archive_pages(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes a record per page to new archives under path and reads them back.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to, intact), one row per row of pages. Of equal
    payloads of at least least_bytes the record with the largest page_id is the response and the others revisit it.
    Records that share the largest id are all responses; a null id is smaller than any, and payloads that only records
    without ids share are all responses. An empty table gives an archive without records and an empty result.
    """
    kind = pages.schema["page_id"].dataType
    write_archives(resolve(page_records(pages), least_bytes), path)
    # archives are parsed once; what is kept of them are headers
    read = read_archives(pages.sparkSession, path)
    found = Scratch(pages.sparkSession).save(read, "read").withColumn("page_id", F.col("page_id").cast(kind))
    back = found.filter("record_type = 'response' and page_id is not null").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")).distinct()
    wanted = found.filter("record_type = 'revisit'").join(back, "refers_to_record", "left")
    rest = found.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast(kind))
    return wanted.unionByName(rest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT p.page_id, p.payload_bytes, p.payload_digest, CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to, true AS intact
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 1000
"""
