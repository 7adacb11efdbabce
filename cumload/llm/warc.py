"""WARC revisit resolution (operator 7).

Headers alone are shuffled by payload digest: the smallest id of a digest is
the response, the others become revisit records that refer to it. Deduplicated
archives are written with fresh headers; a reader parses them by their content
lengths and joins revisit records to the responses they refer to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: 5 hex digits make 4 base32 digits."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Headers of ``pages`` (page_id, url, html) with record_type and refers_to.

    Among records with equal payloads of at least ``min_bytes`` the smallest
    page_id is the response (null ids last); smaller payloads are all
    responses. A null html is an empty payload. Of rows alike in page_id and
    payload the first is told from its ``copy``. Only ids, digests and urls
    are shuffled, and no payload is kept, however long. Null urls are left
    out of the records; columns of ``pages`` beyond these three are ignored;
    an empty table gives no rows.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    heads = pages.select("page_id", F.regexp_replace("url", r"[\r\n]+", " ").alias("url"), F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"))
    heads = heads.withColumn("copy", F.row_number().over(Window.partitionBy("payload_digest", "page_id", "payload_bytes").orderBy("url")))
    first = heads.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.min_by("url", F.when(F.col("copy") == 1, F.col("page_id"))).alias("first_url"))
    both = heads.join(first, "payload_digest")
    again = (F.col("payload_bytes") >= min_bytes) & ~(F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("copy") == 1))
    return both.select("page_id", "url", "copy", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_to_url"), "first_id", "first_url", (F.col("payload_bytes") >= min_bytes).alias("shared"))


def _record_id(page_id: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.when(copy > 1, F.concat(F.lit(":"), copy)).otherwise(""), F.lit(">"))


def write_archives(pages: DataFrame, resolved: DataFrame, path: str, *, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 64 << 20) -> None:
    """Write one WARC/1.1 record per page below ``path``, as gzip archives of bounded size.

    A file takes as many records as the mean record lets it have for
    ``file_bytes``, but never so many that their largest sizes could exceed 16
    times that, so that readers can hold any file. An empty table gives no
    records. The text writer names the files (``.txt.gz``) and has no place for
    a warcinfo record; each file is one gzip member.

    Each file's records end with two line ends, which is the record separator
    that the text writer puts between rows. Response records carry the
    payload; revisit records carry the HTTP header alone. Payloads are
    shuffled once: rows alike in id and payload are told apart after the join,
    in the partitions that it left them in.
    """
    size = F.octet_length(F.coalesce("html", F.lit("")))
    mean, most = pages.agg(F.avg(size), F.max(size)).first()
    records_per_file = max(1, int(file_bytes / (max(mean or 0, (most or 0) / 16) + 1024)))
    payload = F.coalesce(F.col("html"), F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    keyed = pages.select(key.alias("_key"), F.col("page_id"), F.regexp_replace("url", r"[\r\n]+", " ").alias("url"), payload.alias("payload"), base32_sha1(F.encode(payload, "UTF-8")).alias("_digest"))
    heads = resolved.where("copy = 1").select(key.alias("_key"), F.col("payload_digest").alias("_digest"), "payload_bytes", "record_type", "first_id", "first_url", "shared")
    r = keyed.join(heads.hint("merge"), ["_key", "_digest"]).withColumnRenamed("_digest", "payload_digest")
    r = r.withColumn("copy", F.row_number().over(Window.partitionBy("_key", "payload_digest").orderBy("url")))
    revisit = F.col("shared") & ((F.col("record_type") == "revisit") | (F.col("copy") > 1))
    r = r.select("page_id", "url", "copy", "payload", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_to_url"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit(_END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("copy"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", F.when(revisit & F.col("refers_to").isNotNull(), _record_id(F.col("refers_to"), F.lit(1)))),
        line("WARC-Refers-To-Target-URI", F.col("refers_to_url")),
        line("WARC-Refers-To-Date", F.when(revisit, date)),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    r.select(F.concat(head, block).alias("value")).write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").mode("overwrite").text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive, gzip or not, one record at a time."""
    source = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    with io.BufferedReader(source, 1 << 20) as archive:
        while first := archive.readline():
            if not first.startswith(b"WARC/"):
                raise ValueError(f"no record where one should start: {first[:40]!r}")
            lines = iter(archive.readline, b"\r\n")
            fields = dict(x.decode().removesuffix("\r\n").split(": ", 1) for x in lines)
            size = int(fields["Content-Length"])
            block, end = archive.read(size), archive.read(4)
            if len(block) < size or end != b"\r\n\r\n":
                raise ValueError(f"record does not end where it says: {fields.get('WARC-Record-ID')}")
            yield fields, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: record_id, page_id, record_type, refers_to_id, and for
    responses the length and digest of the payload as found. One record of a file is unpacked at a time."""
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to_id", pa.string()), ("url", pa.string()), ("said_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def number(urn: str) -> int | None:
        part = urn[1:-1].split(":")[2]
        return None if part == "null" else int(part)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows: list[tuple] = []
                for fields, block in parsed(batch.column(0)[i].as_py()):
                    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
                    found = (None, None) if payload is None else (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
                    rows.append((fields["WARC-Record-ID"], number(fields["WARC-Record-ID"]), fields["WARC-Type"], fields.get("WARC-Refers-To"), fields.get("WARC-Target-URI"), fields["WARC-Payload-Digest"].removeprefix("sha1:"), *found))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    ddl = "record_id string, page_id long, record_type string, refers_to_id string, url string, said_digest string, payload_bytes long, payload_digest string"
    return files.mapInArrow(read, ddl)


def revisits_resolved(records: DataFrame) -> DataFrame:
    """One row per record, revisits with the payload's length and digest from the response they refer to."""
    responses = records.where("record_type = 'response'")
    origin = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(origin, "refers_to_id", "left")
    # a revisit whose response is not here keeps the digest that its header states
    resolved = revisits.select("page_id", F.col("_bytes").alias("payload_bytes"), F.coalesce("_digest", "said_digest").alias("payload_digest"), "record_type", F.col("_page").alias("refers_to"))
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(resolved)
