"""WARC archives: a request, response or revisit, and metadata record for each page; transactions read back.

Records are UTF-8 text ended by two CRLF, so Spark's text writer with that line end makes the archives, in any store
that Spark writes to. Pages are written by classes of size, so that a number of records bounds an archive's bytes.
Reading unpacks an archive as it goes and holds one record of it, gathers the records of a transaction through
WARC-Concurrent-To and gives one nested row a capture.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder

LEAST = 1000
#: Bytes of payload that an archive holds at most, but for a page that alone has more; and its records at most.
FILE_BYTES, FILE_RECORDS = 256 << 20, 3000
#: Classes of size are powers of this.
CLASS_BASE = 8
#: Fixed values of the format.
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def record_id(kind: str, page):
    """urn:uuid from a page id and the payload, the same in every run."""
    h = F.md5(F.concat_ws(":", F.lit(kind), F.coalesce(page.cast("string"), F.lit("null")), "digest"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def decided(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to). The largest page_id of equal payloads of `least` bytes stays; a null page_id is less than any.

    Pages go with their html only where Spark joins by shuffle; a digest that many pages have is split then, as both
    sides of the join are shuffled.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"))
    own = own.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html").cast("long"))
    sums = own.filter(F.col("bytes") >= least).select("digest", "page_id").groupBy("digest")
    large = cut(sums.agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("digest", "keeper"))
    return own.join(large, "digest", "left").withColumn("refers_to", F.when((F.col("bytes") >= least) & (F.col("keeper") != F.coalesce("page_id", F.col("keeper") - 1)), F.col("keeper"))).drop("keeper")


def size_class(size):
    """0 for what may stand FILE_RECORDS to an archive, and so on by powers of CLASS_BASE."""
    return F.greatest(F.lit(0), F.ceil(F.log(float(CLASS_BASE), F.greatest(size, F.lit(1)) / (FILE_BYTES // FILE_RECORDS * 3)))).cast("int")


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(value, class): the WARC records of the pages as text, without the closing line ends, and the page's class of size.

    Null html: an empty payload. Null url: an empty target. Rows with one page_id and one payload are one
    capture; null page_ids are kept. Payloads are whole, however long. Other columns are ignored, whatever their
    names; an empty table gives no records.
    """
    p = decided(pages, least)
    page, url = F.col("page_id"), F.regexp_replace("url", "[\\r\\n]", "")
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    def record(kind, ident, more: list, block, to=None):
        head = [F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", ident), line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", url), *([line("WARC-Concurrent-To", to)] if to is not None else []), *more]
        return F.concat(*head, line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)

    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    path = F.regexp_replace(F.regexp_extract("url", "^[a-z]+://[^/]*(.*)$", 1), " ", "%20")
    ask = F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path), F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(CRLF * 2))
    head = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    again = F.col("refers_to").isNotNull()
    main = record_id("response", page)
    digest = line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = lambda kind: line("Content-Type", F.lit(f"application/http; msgtype={kind}"))
    old = F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id("response", F.col("refers_to"))))
    body = F.when(again, F.lit("")).otherwise(F.col("html").cast("string"))
    whole = record(F.when(again, F.lit("revisit")).otherwise(F.lit("response")), main, [http("response"), digest, F.when(again, old).otherwise(F.lit(""))], F.concat(head, body))
    request = record(F.lit("request"), record_id("request", page), [http("request")], ask, main)
    facts = F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF + "payloadBytes: "), F.col("bytes").cast("string"), F.lit(CRLF + "refersToPageId: "), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(CRLF))
    metadata = record(F.lit("metadata"), record_id("metadata", page), [line("Content-Type", F.lit("application/warc-fields"))], facts, main)
    return p.select(F.explode(F.array(request, whole, metadata)).alias("value"), size_class(F.col("bytes")).alias("class"))


def write_warc(pages: DataFrame, path: str, least: int = LEAST) -> str:
    """Writes the archives (gzip) to folders under a path, one for each class of size there is, and returns it."""
    out = records(pages, least)
    size = F.octet_length(F.coalesce(F.col("html").cast("binary"), F.lit(b"")))
    found = sorted(r[0] for r in pages.select(size_class(size)).distinct().collect())  # at most 8 classes
    for c in found or [0]:
        own = out.filter(F.col("class") == c).select("value")
        own.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", max(3, FILE_RECORDS // CLASS_BASE**c)).mode("overwrite").text(f"{path}/class-{c}")
    return path


RECORD = "type string, id string, uri string, date string, concurrent_to string, refers_to string, payload_digest string, headers string, block binary, block_digest string, block_bytes long"


def parse(file):
    """(headers, block) of each record of an unpacked archive, read as it goes."""
    while line := file.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        head = [line]
        while (line := file.readline()) not in (b"\r\n", b""):
            head.append(line)
        text = b"".join(head).decode("utf-8", "replace").removesuffix(CRLF)
        size = int(re.search(r"(?im)^content-length:\s*(\d+)", text)[1])
        block = file.read(size)
        if len(block) != size:
            raise EOFError("WARC record cut short")
        yield text, block


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of archives in a folder and those under it, plain or gzip (of one member or one a record).

    blocks=False leaves out their bytes, but not the payload's digest and size. A record cut short or no record raises;
    empty archives give no rows. Nothing is taken out that stands twice.
    """

    def rows(batches):
        fields = ["type", "id", "uri", "date", "concurrent_to", "refers_to"]
        names = ["warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-concurrent-to", "warc-refers-to"]
        types = [pa.string()] * 8 + [pa.binary(), pa.string(), pa.int64()]
        for b in batches:
            for data in b.column(0):
                raw = pa.BufferReader(data.as_buffer())
                file = gzip.GzipFile(fileobj=raw) if data.as_buffer()[:2].to_pybytes() == b"\x1f\x8b" else io.BufferedReader(raw)
                held: list[list] = [[] for _ in types]
                size = 0

                def flush():
                    return pa.record_batch([pa.array(x, t) for x, t in zip(held, types, strict=True)], names=[*fields, "payload_digest", "headers", "block", "block_digest", "block_bytes"])

                for head, block in parse(file):
                    h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.split(CRLF)[1:])}
                    payload = block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else block
                    values = [h.get(n) for n in names] + [(h.get("warc-payload-digest") or "").removeprefix("sha1:") or None, head, block if blocks or h.get("warc-type") == "metadata" else None, hashlib.sha1(payload).hexdigest(), len(payload)]
                    for x, v in zip(held, values, strict=True):
                        x.append(v)
                    size += len(block) if blocks else 200
                    if size > 4 << 20:
                        yield flush()
                        held, size = [[] for _ in types], 0
                if held[0]:
                    yield flush()

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(rows, RECORD)


def captures(records_: DataFrame) -> DataFrame:
    """One row a capture: response (or revisit), request and metadata, joined by concurrent-to. Captures without a request or metadata have null there; records that name no capture are left out."""
    entry = lambda: F.struct(*[c for c in records_.columns])
    key = F.when(F.col("type").isin("response", "revisit"), F.col("id")).otherwise(F.col("concurrent_to"))
    pick = lambda *kinds: F.max(F.when(F.col("type").isin(*kinds), entry()))
    return records_.withColumn("capture", key).filter("capture is not null").groupBy("capture").agg(pick("response", "revisit").alias("response"), pick("request").alias("request"), pick("metadata").alias("metadata")).filter("response is not null")


def op3_warc_transactions(spark, sf_dir: str) -> DataFrame:
    path = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    c = captures(read_records(spark, path, blocks=False))
    fact = lambda name: F.regexp_extract(F.col("metadata.block").cast("string"), f"(?m)^{name}: (-?[0-9]*)\\r", 1)
    number = lambda name: F.when(fact(name) != "", fact(name).cast("long"))
    again = F.col("response.type") == "revisit"
    return c.select(number("pageId").alias("page_id"), F.when(again, number("payloadBytes")).otherwise(F.col("response.block_bytes")).alias("payload_bytes"), F.when(again, F.col("response.payload_digest")).otherwise(F.col("response.block_digest")).alias("payload_digest"), F.col("response.type").alias("record_type"), number("refersToPageId").alias("refers_to"))
