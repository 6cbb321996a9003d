"""WARC archives written and read with Spark, and transactions assembled from their records.

``write`` gives every page a request, a response (or revisit) and a metadata record. The records
are text, and the text sink's line separator is WARC's record end, so any file system that Spark
writes to will do. A page whose payload (its html in UTF-8) has at least ``MIN_REVISIT`` bytes and
equals the payload of a page with a smaller id becomes a revisit of the smallest.

``records`` reads archives (plain or gzip, one record or all records to a gzip member);
``transactions`` brings the records of one capture together through WARC-Concurrent-To: the request
and metadata records name the response or revisit, and each capture becomes one nested row.

Null html is an empty payload and is always a response; null urls are written as ``urn:page:<id>``;
blanks and control characters in urls are written as %20. Repeated rows (equal page_id and html) write their records each, under
equal record ids: ``transactions`` makes them one capture with its number of copies, ``captures`` gives a row for each. Rows that
share a page_id with other html are captures of their own, with equal page ids. A
null page_id comes back as null and sorts last: it is never revisited if another page can be. Other
columns are ignored. An empty table gives archives without records, and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .shared import read, written

MIN_REVISIT = 100
#: Uncompressed bytes of an archive; a reader holds one archive at a time.
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "fields map<string,string>, payload_bytes long, payload_digest string, declared_digest string, payload binary")


def _id(kind: str, page: str = "page_id"):
    """A record id that only the page, its payload and the record type decide."""
    h = F.md5(F.concat_ws(":", F.coalesce(F.col(page).cast("string"), F.lit("")), F.col("digest"), F.lit(kind)))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
             F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind, headers: list, block):
    """A record's text without its end: headers with a null value are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.lit(f"WARC-Date: {DATE}"),
             *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in headers],
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _kinds(pages: DataFrame) -> DataFrame:
    """(page_id, digest, response_id): response_id is the page that a revisit refers to."""
    rows = pages.select("page_id", "digest", "n")
    first = (rows.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("response_id"), F.count("*").alias("copies"))
             .where("copies > 1").drop("copies"))
    # Written first: adaptive execution can then split the rows of a digest that very many pages have.
    first = written(first, "first-pages")
    return (rows.dropDuplicates(["page_id", "digest"]).join(first, "digest", "left")
            .select(F.col("page_id").alias("id"), F.col("digest").alias("sha"),
                    F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id")).alias("response_id")))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the pages as gzip-compressed archives of about ARCHIVE_BYTES into the folder ``path``."""
    url = F.regexp_replace(F.col(f"`{url_col}`").cast("string"), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), url.alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "n": F.octet_length("html")})
    size = rows.agg(F.avg("n")).first()[0] or 0
    kinds = _kinds(rows)
    full = (rows.join(kinds, rows["page_id"].eqNullSafe(kinds["id"]) & (rows["digest"] == kinds["sha"])).drop("id", "sha")
            .withColumn("url", F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))))
    again = F.col("response_id").isNotNull()
    host, target = F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]*)([^#]*)", 1), F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]*)([^#]*)", 2)
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    main, uri = F.col("main_id"), ("WARC-Target-URI", F.col("url"))
    fields = F.concat_ws("\r\n", F.when(F.col("page_id").isNotNull(), F.concat(F.lit("page-id: "), F.col("page_id").cast("string"))),
                         F.concat(F.lit("payload-length: "), F.col("n").cast("string")))
    full = (full.withColumn("main_id", _id("response"))
            .withColumn("first_id", F.when(again, _id("response", "response_id"))))
    value = F.concat(
        _record(F.lit("request"), [("WARC-Record-ID", _id("request")), ("WARC-Concurrent-To", main), uri,
                                   ("Content-Type", F.lit("application/http; msgtype=request"))],
                F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))),
        F.lit(END),
        _record(F.when(again, "revisit").otherwise("response"),
                [("WARC-Record-ID", main), uri, ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
                 ("WARC-Refers-To", F.col("first_id")), ("WARC-Profile", F.when(again, REVISIT_PROFILE)),
                 ("Content-Type", F.lit("application/http; msgtype=response"))],
                F.when(again, head).otherwise(F.concat(head, F.col("html")))),
        F.lit(END),
        _record(F.lit("metadata"), [("WARC-Record-ID", _id("metadata")), ("WARC-Concurrent-To", main), uri,
                                    ("Content-Type", F.lit("application/warc-fields"))], fields))
    (full.select(value.alias("value")).write.mode("overwrite").option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES // (size + 1500)))).text(path))


def _headers(block: bytes) -> dict[str, str]:
    """Names in lower case; a line that starts with a blank continues the one before."""
    out: dict[str, str] = {}
    last = None
    for line in block.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            out[last := last.strip().lower()] = value.strip()
    return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one archive; a damaged archive raises ValueError."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at, n = 0, len(data)
    while at < n:
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"headers without an end at byte {at}")
        headers = _headers(data[data.index(b"\r\n", at) + 2 : end])
        size = int(headers.get("content-length", -1))
        at = end + 4 + size
        if size < 0 or at > n or data[at : at + 4] not in (b"\r\n\r\n", b""):
            raise ValueError(f"wrong Content-Length before byte {at}")
        yield headers, data[end + 4 : at]
        at += 4


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind, fields, payload = headers.get("warc-type"), {}, block
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        fields = _headers(head)
    elif headers.get("content-type", "").startswith("application/warc-fields"):
        fields = _headers(block)
    return {"record_id": headers.get("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
            "fields": list(fields.items()), "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(),
            "declared_digest": (headers.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
            "payload": payload if payloads else None}


def records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives in the folder ``path`` (columns: RECORD)."""
    import pyarrow as pa

    kinds = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
                       ("target_uri", pa.string()), ("date", pa.string()), ("fields", pa.map_(pa.string(), pa.string())),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string()), ("payload", pa.binary())])

    def work(batches):
        for batch in batches:
            for where, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                try:
                    for headers, block in parse(content.as_py()):
                        rows.append(_row(headers, block, payloads))
                        held += len(block) if payloads else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                except ValueError as e:
                    raise ValueError(f"{where.as_py()}: {e}") from e
                yield pa.RecordBatch.from_pylist(rows, kinds)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(work, RECORD)


def transactions(found: DataFrame) -> DataFrame:
    """One row per capture: capture_id, the nested response, request and metadata records, and copies, how often its response was written.

    A record belongs to the record that its WARC-Concurrent-To names, or else to itself. A request or
    metadata record whose response is missing gives a row with a null response.
    """
    record = F.struct(*found.columns)
    kinds = {"response": ("response", "revisit"), "request": ("request",), "metadata": ("metadata",)}
    return (found.where(F.col("type").isin("response", "revisit", "request", "metadata"))
            .groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
            .agg(*[F.first(F.when(F.col("type").isin(*v), record), ignorenulls=True).alias(k) for k, v in kinds.items()],
                 F.count(F.when(F.col("type").isin(*kinds["response"]), 1)).alias("copies")))


def captures(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok): a row per response or revisit record.

    A revisit has the size and digest of the response that it refers to. Only revisits look for another record, so the
    responses, which refer to none, never meet in one task.
    """
    rows = transactions(found.drop("payload")).select(
        F.try_element_at("metadata.fields", F.lit("page-id")).cast("long").alias("page_id"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("first_id"), "capture_id",
        F.col("response.payload_bytes").alias("n"), F.col("response.payload_digest").alias("sha"),
        F.col("response.declared_digest").alias("declared"), "copies")
    rows = written(rows, "captures")
    first = rows.where("record_type = 'response'").select(
        F.col("capture_id").alias("first_id"), F.col("page_id").alias("refers_to"), F.col("n").alias("first_n"), F.col("sha").alias("first_sha"))
    again = rows.where("record_type = 'revisit'").join(first, "first_id", "left").select(
        "page_id", F.col("first_n").alias("payload_bytes"), F.col("first_sha").alias("payload_digest"), "record_type", "refers_to", "declared", "copies")
    own = rows.where("record_type IS DISTINCT FROM 'revisit'").select(
        "page_id", F.col("n").alias("payload_bytes"), F.col("sha").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"), "declared", "copies")
    both = own.unionByName(again).withColumn("digest_ok", F.col("declared").eqNullSafe(F.col("payload_digest")))
    return (both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("copies", F.lit(1)))))
            .drop("copy", "copies", "declared"))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-archives-{uuid.uuid4().hex}"
    write(read(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return captures(records(spark, path, payloads=False)).drop("digest_ok")


#: The same rows in DuckDB SQL.
OP5_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS m FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= 100 AND m < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND m < page_id THEN m END AS refers_to
FROM f
"""
