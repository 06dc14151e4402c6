"""WARC archives: writing captures with revisits, reading any archive, and joining the records of a capture.

Archives are written by Spark's text writer: a capture is one string of three records (request, response or revisit,
metadata), and the two line ends after a record are the line separator. Files hold ``CAPTURES_PER_FILE`` captures at
most and are compressed as a whole. Reading takes whole files from Spark's binary source and parses them by their
content lengths, as a stream, so that any bytes may stand in a payload; archives compressed record by record are read
too. Records of one capture are joined through WARC-Concurrent-To, whichever of them carries it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tableload.llm.common import stored
from tableload.session import scratch_dir

CAPTURES_PER_FILE = 500
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "archive string, warc_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "date string, content_type string, http string, payload binary, payload_bytes long, payload_digest string, declared_digest string"
)
_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def base32_sha1(text: Column) -> Column:
    """The SHA-1 of a text in bare upper-case base 32: forty bits at a time."""
    digest = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.upper(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32)), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), *_BASE32)


def _record(kind: str | Column, record_id: Column, fields: list[Column], content_type: str, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}")]
    tail = [F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *head, *fields, *tail), F.lit(END), block)


def _uuid(kind: str, *parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(kind), *[p.cast("string") for p in parts]))
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> None:
    """Write one capture per row of ``pages`` (page_id, url, html) below ``path``.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least ``min_bytes`` bytes the row with
    the smallest id is a response (null ids last; of several rows with that id, one), the others are revisits that
    refer to it. Null urls give records without a target; spaces and control characters in urls are written as %20.
    Extra columns are ignored; without rows no archive holds a record.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(url_col, "[\\x00-\\x20\\x7f]", "%20").alias("url"),
        F.coalesce(F.col(text_col), F.lit("")).alias("payload"),
    )
    rows = stored(rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload")), "captures")
    keys = rows.select("row", "page_id", "digest", "bytes").filter(F.col("bytes") >= min_bytes)
    firsts = keys.groupBy("digest", "bytes").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")).alias("first"), F.count("*").alias("n")
    )
    firsts = stored(firsts.filter("n > 1").select("digest", "bytes", "first.row", "first.page_id"), "firsts")
    revisits = keys.join(firsts.withColumnsRenamed({"row": "first_row", "page_id": "first_id"}), ["digest", "bytes"])
    revisits = stored(revisits.filter("row <> first_row").select("row", "first_row", "first_id"), "revisits")

    rows = rows.join(revisits, "row", "left")
    again, url = F.col("first_row").isNotNull(), F.col("url")
    target = F.concat(F.lit("WARC-Target-URI: "), url)
    answer = _uuid("response", F.col("row"), F.col("page_id"))
    beside = F.concat(F.lit("WARC-Concurrent-To: "), answer)
    host = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    place = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    place = F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), place))
    asked = F.concat(F.lit("GET "), F.coalesce(place, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(END))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    refers = F.when(again, F.concat(F.lit("WARC-Refers-To: "), _uuid("response", F.col("first_row"), F.col("first_id"))))
    profile = F.when(again, F.lit(f"WARC-Profile: {IDENTICAL}"))
    told = F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n"))
    records = F.concat_ws(
        END,
        _record("request", _uuid("request", F.col("row"), F.col("page_id")), [target, beside], "application/http; msgtype=request", asked),
        _record(
            F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
            answer,
            [target, digest, refers, profile],
            "application/http; msgtype=response",
            F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload"))),
        ),
        _record("metadata", _uuid("metadata", F.col("row"), F.col("page_id")), [target, beside], "application/warc-fields", told),
    )
    writer = rows.select(records.alias("value")).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", CAPTURES_PER_FILE).text(path)


def _headers(stream: io.BufferedIOBase) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            break
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and out:  # a folded line
            out[-1] = (out[-1][0], out[-1][1] + " " + text.strip())
        else:
            name, _, value = text.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive, compressed or not, in order."""
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not re.match(rb"WARC/\d", line):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        pairs = _headers(stream)
        head = dict(reversed(pairs))
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends within a record")
        http, payload = None, block
        if head.get("content-type", "").startswith("application/http"):
            at = block.find(b"\r\n\r\n")
            if at >= 0:
                http, payload = block[: at + 4].decode("utf-8", "replace"), block[at + 4 :]
        yield {
            "warc_type": head.get("warc-type", ""),
            "record_id": head.get("warc-record-id", ""),
            "concurrent_to": [v for k, v in pairs if k == "warc-concurrent-to"],
            "refers_to": head.get("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"),
            "date": head.get("warc-date"),
            "content_type": head.get("content-type"),
            "http": http,
            "payload": payload,
            "payload_bytes": len(payload),
            "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            "declared_digest": head.get("warc-payload-digest"),
        }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``; see ``RECORDS``. A broken archive fails the job."""
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = {"concurrent_to": pa.list_(pa.string()), "payload": pa.binary(), "payload_bytes": pa.int64()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one archive at a time
                archive, waiting, held = batch.column("path")[i].as_py(), [], 0
                for record in parse_archive(batch.column("content")[i].as_py()):
                    waiting.append({"archive": archive, **record})
                    held += record["payload_bytes"] + 1000
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(waiting, schema)
                        waiting, held = [], 0
                yield pa.RecordBatch.from_pylist(waiting, schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content").filter("length > 0")
    return files.mapInArrow(parse, RECORDS)


def _nested() -> Column:
    return F.struct("record_id", "target_uri", "date", "content_type", "http", F.col("payload").cast("string").alias("text")).alias("record")


def attached(records: DataFrame) -> DataFrame:
    """(main_id, warc_type, record) for every request or metadata record and each response that it names, or that names it.

    Repeated records count once. A ``main_id`` need not be in the archives. Flat, so that a response may have any number.
    """
    main = F.col("warc_type").isin("response", "revisit")
    others = records.filter(F.col("warc_type").isin("request", "metadata")).select("warc_type", "record_id", "concurrent_to", _nested())
    named = others.select(F.explode("concurrent_to").alias("main_id"), "warc_type", "record")
    naming = records.filter(main).select(F.col("record_id").alias("main_id"), F.explode("concurrent_to").alias("record_id"))
    return named.unionByName(naming.join(others, "record_id").select("main_id", "warc_type", "record")).distinct()


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its columns and all its request and metadata records.

    ``records`` is read several times: store it first. A request or metadata record belongs to the response that it
    names as concurrent, or that names it. The one with the smallest id is ``request`` or ``metadata``, the others are
    in ``more_requests`` and ``more_metadata``, by id (all null if there is none); n_requests and n_metadata count them
    all. Repeated records count once. Records that no response claims give no row: see ``unclaimed``.
    """
    named = attached(records)
    out = records.filter(F.col("warc_type").isin("response", "revisit")).dropDuplicates(["record_id"])
    for one, more, many in (("request", "more_requests", "n_requests"), ("metadata", "more_metadata", "n_metadata")):
        part = named.filter(F.col("warc_type") == one).groupBy("main_id").agg(F.array_sort(F.collect_list("record")).alias("all"))
        part = part.select(
            F.col("main_id").alias("record_id"),
            F.col("all")[0].alias(one),
            F.expr("slice(all, 2, size(all))").alias(more),
            F.size("all").cast("long").alias(many),
        )
        out = out.join(part, "record_id", "left").fillna(0, [many])
    return out


def unclaimed(records: DataFrame) -> DataFrame:
    """The request and metadata records, with all their columns, whose response is not among ``records``."""
    mains = records.filter(F.col("warc_type").isin("response", "revisit")).select(F.col("record_id").alias("main_id"))
    claimed = attached(records).join(mains, "main_id", "left_semi").select("warc_type", "record").distinct()
    others = records.filter(F.col("warc_type").isin("request", "metadata")).withColumn("record", _nested())
    return others.join(claimed, ["warc_type", "record"], "left_anti").select(*records.columns)


def resolved(caught: DataFrame) -> DataFrame:
    """Stored ``captures`` with page_id (from the metadata) and, for revisits, the response's size, digest and page_id.

    Of several metadata records, the first by id that states a page_id counts. A revisit whose response is in no archive keeps null for them, and the digest it declares.
    """
    told = F.concat(F.array("metadata"), F.col("more_metadata"))
    pages = F.transform(told, lambda r: F.regexp_extract(r["text"], "(?m)^page_id: *(-?[0-9]+)", 1))
    caught = caught.withColumn("page_id", F.get(F.filter(pages, lambda page: page != ""), F.lit(0)).cast("long"))
    first = caught.filter("warc_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("first_page"),
        F.col("payload_bytes").alias("first_bytes"),
        F.col("payload_digest").alias("first_digest"),
    )
    again = F.col("warc_type") == "revisit"
    declared = F.regexp_extract("declared_digest", "^(?i:sha1):(.*)$", 1)
    return caught.join(first, "refers_to", "left").select(
        "page_id",
        F.when(again, F.col("first_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.coalesce("first_digest", declared)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(again, F.col("first_page")).alias("refers_to"),
        "record_id",
        "target_uri",
        "http",
        "request",
        "metadata",
        "more_requests",
        "more_metadata",
        "n_requests",
        "n_metadata",
    )


def archived_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """``pages`` written to archives below ``path`` (a new scratch folder if none), read back and resolved."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    write_archives(pages, path, min_bytes)
    records = stored(_light(read_archives(spark, path)), "records")
    return resolved(stored(captures(records), "transactions"))


def _light(records: DataFrame) -> DataFrame:
    """Records without the payload of responses, which stays in the archives; ``declared_digest`` and sizes remain."""
    return records.withColumn("payload", F.when(~F.col("warc_type").isin("response", "revisit"), F.col("payload")))
