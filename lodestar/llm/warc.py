"""WARC archives: writer, and reader with boundary-chain verification (operator 1).

Writing: a record per page, uncompressed, through Spark's text sink with the
record end ``CRLF CRLF`` as line separator, so any store Spark can write
holds the archives and a retried task replaces its file. Of pages with equal
payloads (equal SHA-1, SHA-256 and length) the one with the smallest id is
stored in full, the others as ``revisit`` records that keep the HTTP header.

Reading: the text source splits the files into byte ranges at the magic
``WARC/1.1 CRLF``, wherever it stands, also inside payloads. Every occurrence
is a candidate record: tasks emit its offset and, from its Content-Length,
the offset of its successor. Only candidates that the chain from the file
start reaches are records. Chains of adjacent candidates are contracted to
runs first (one run for each byte range in an ordinary file), then pointer
jumping over the runs doubles the reach each round. A record whose payload
holds the magic consists of several segments; only the files that have such
records are read once more to put them together.

Defined cases: a null or empty payload is a record with 0 payload bytes; a null
url gives no target header, and control characters in urls are percent-encoded;
rows with a null id are written with an empty record id and read back with a
null id; of rows that repeat the smallest id of a payload all are responses; an
empty table gives no records; a file that does not begin with a record has no
records, and a record that is cut short ends its file's chain. Other columns
of the pages are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm._common import scratch, small, stage

MAGIC = "WARC/1.1\r\n"
CRLF2 = "\r\n\r\n"
#: Rows of the table of repeated payloads (about 200 bytes each) up to which it is broadcast.
MAX_BROADCAST_REPEATS = 100_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 10 hex digits are 8 base-32 digits."""
    digits = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record(page: str, date: str) -> Column:
    """Text of one record without its closing CRLF CRLF, from the columns of ``write_warc``."""
    c = lambda name: F.col(f"{page}.{name}")
    revisit = c("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    c("payload_bytes").cast("string"), F.lit(CRLF2))
    block = F.concat(http, F.when(revisit, "").otherwise(c("payload")))
    urn = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat_ws(
        "\r\n", F.lit(MAGIC[:-2]),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), urn(c("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), c("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), c("digest")),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(c("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(CRLF2), block)


def write_warc(pages: DataFrame, path: str, root: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_revisit_bytes: int = 0,
               date: str = "2000-01-01T00:00:00Z") -> str:
    """Write one record per page below ``path``; payloads of fewer bytes never become revisits."""
    payload = F.coalesce(pages[payload_col], F.lit(""))
    url = F.regexp_replace(F.regexp_replace(pages[url_col], "\r", "%0D"), "\n", "%0A")
    url = F.regexp_replace(url, r"[\x00-\x1F\x7F]", "%20")
    p = pages.select(pages[id_col].alias("id"), url.alias("url"), payload.alias("payload"),
                     base32_sha1(payload).alias("digest"), F.sha2(payload, 256).alias("sha256"),
                     F.octet_length(payload).cast("long").alias("payload_bytes"))
    same = ["digest", "sha256", "payload_bytes"]
    groups = (p.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy(*same)
              .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    groups = small(stage(p.sparkSession, groups, root, "repeats"), MAX_BROADCAST_REPEATS)
    marked = p.join(groups, same, "left").withColumn(
        "refers_to", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")))
    (marked.select(F.struct("*").alias("page")).select(_record("page", date).alias("value"))
     .write.mode("overwrite").option("lineSep", CRLF2).text(path))
    return path


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What stands between the magics: (file, file_size, blk, seq, value); seq orders a byte range."""
    m = F.col("_metadata")
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(m["file_path"].alias("file"), m["file_size"].alias("file_size"),
                    m["file_block_start"].alias("blk"), F.monotonically_increasing_id().alias("seq"),
                    "value"))


def _offsets(segs: DataFrame) -> DataFrame:
    """``segs`` (with ``len``) plus ``off``, the file offset of the magic before each segment."""
    n = len(MAGIC)
    blocks = segs.groupBy("file", "blk").agg(F.sum(F.col("len") + n).alias("bytes"))
    before = Window.partitionBy("file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("file", "blk", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "blk").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (segs.withColumn("run", F.coalesce(F.sum(F.col("len") + n).over(inside), F.lit(0)))
            .join(bases, ["file", "blk"])
            .withColumn("off", F.col("base") + F.col("run") - n).drop("base", "run"))


def _parsed(value: Column) -> dict[str, Column]:
    """Fields of a candidate from the text after its magic (its closing CRLF CRLF included)."""
    head = F.substring_index(value, CRLF2, 1)
    closed = F.octet_length(value) > F.octet_length(head)
    field = lambda name, rx: F.nullif(F.regexp_extract(
        head, rf"(?i)(?:^|\r\n){name}:[ \t]*({rx})[ \t]*(?:\r\n|$)", 1), F.lit(""))
    length = F.when(closed, field("Content-Length", r"\d{1,18}").try_cast("long"))
    block = F.substring(value, F.length(head) + 5, F.length(value) - F.length(head) - 8)
    http = F.coalesce(field("Content-Type", r"[^\r\n]*").startswith("application/http"), F.lit(False))
    http_head = F.when(http, F.substring_index(block, CRLF2, 1)).otherwise("")
    payload = F.when(http, F.substring(block, F.length(http_head) + 5, F.length(block))).otherwise(block)
    urn = lambda name: field(name, r"[^\r\n]*")
    return {"head_bytes": F.octet_length(head).cast("long"), "content_length": length,
            "record_type": field("WARC-Type", r"[^\r\n]*"), "record_id": urn("WARC-Record-ID"),
            "refers_to": urn("WARC-Refers-To"), "target_uri": urn("WARC-Target-URI"),
            "digest": field("WARC-Payload-Digest", r"[^\r\n]*"),
            "http_length": F.nullif(F.regexp_extract(
                http_head, r"(?i)\r\nContent-Length:[ \t]*(\d{1,18})", 1), F.lit("")).try_cast("long"),
            "payload": payload}


def _fields(value: Column, keep_payload: bool) -> list[Column]:
    f = _parsed(value)
    payload = f.pop("payload")
    return [c.alias(k) for k, c in f.items()] + [
        F.octet_length(payload).cast("long").alias("stored_bytes"),
        base32_sha1(payload).alias("stored_digest")] + [payload.alias("payload")] * keep_payload


def chain(cands: DataFrame, root: str) -> DataFrame:
    """The candidates (file, off, end, succ, ...) that the chain from offset 0 of their file reaches.

    ``end`` is where the next candidate or the file's end stands. A run is a
    maximal sequence in one byte range in which each candidate's successor is
    the next one and no other pointer enters, so its head decides for all.
    """
    spark = cands.sparkSession
    entered = cands.where("succ <> end").select("file", F.col("succ").alias("off")).distinct()
    order = Window.partitionBy("file", "blk").orderBy("off")
    marked = (cands.join(entered.withColumn("entered", F.lit(True)), ["file", "off"], "left")
              .withColumn("head", F.when(F.coalesce("entered", F.lit(False))
                                         | ~F.lag("succ").over(order).eqNullSafe(F.col("off")),
                                         F.col("off")))
              .withColumn("head", F.last("head", True).over(order)).drop("entered"))
    marked = stage(spark, marked, root, "candidates")
    jump = (marked.groupBy("file", "head").agg(F.max_by("succ", "off").alias("to"))
            .where("to IS NOT NULL"))
    jump = stage(spark, jump, root, "jump0")
    reach = stage(spark, marked.where("off = 0").select("file", "head").distinct(), root, "reach0")
    known, k = reach.count(), 0
    while True:
        k += 1
        step = reach.join(jump, ["file", "head"]).select("file", F.col("to").alias("head"))
        reach = stage(spark, reach.union(step).distinct(), root, f"reach{k}")
        if (now := reach.count()) == known:
            break
        known = now
        a, b = jump.alias("a"), jump.alias("b")
        jump = stage(spark, a.join(b, (F.col("a.file") == F.col("b.file"))
                                   & (F.col("a.to") == F.col("b.head")))
                     .select("a.file", "a.head", "b.to"), root, f"jump{k}")
    return marked.join(reach, ["file", "head"], "left_semi")


def _owned(segs: DataFrame) -> DataFrame:
    """The segments that lie in a record, with the ``start`` and ``succ`` of the last one that starts at or before them.

    ``start`` and ``succ`` are given where a record starts. Inside a byte range a window finds the last
    start; what a range begins with belongs to the last start of the ranges before it, which
    a window over one row a range finds. So no task reads a whole file.
    """
    record = F.when(F.col("start").isNotNull(), F.struct("start", "succ"))
    inside = Window.partitionBy("file", "blk").orderBy("off")
    before = Window.partitionBy("file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    lasts = segs.groupBy("file", "blk").agg(F.max(record).alias("last"))
    carried = lasts.select("file", "blk", F.last("last", True).over(before).alias("carried"))
    own = F.coalesce(F.last(record, True).over(inside), F.col("carried"))
    return (segs.join(carried, ["file", "blk"]).withColumn("own", own)
            .select("file", "off", F.col("own.start").alias("start"), F.col("own.succ").alias("succ"), "value")
            .where(F.col("off") < F.col("succ")))


def read_warc(spark: SparkSession, path: str, root: str, payloads: bool = True) -> DataFrame:
    """The records below ``path``: (file, off, record_type, record_id, refers_to, target_uri, digest,
    http_length, stored_bytes, stored_digest[, payload]).

    ``stored_bytes`` and ``stored_digest`` are taken from the payload as read.
    """
    segs = _segments(spark, path)
    value = F.col("value")
    found = stage(spark, segs.select("file", "file_size", "blk", "seq",
                                     F.octet_length(value).cast("long").alias("len"),
                                     *_fields(value, False)), root, "segments")
    n = len(MAGIC)
    cands = (_offsets(found).where("off >= 0")
             .withColumn("end", F.col("off") + n + F.col("len"))
             .withColumn("succ", F.col("off") + n + F.col("head_bytes") + F.col("content_length") + 8)
             .withColumn("succ", F.when(F.col("succ") <= F.col("file_size"), F.col("succ"))))
    records = stage(spark, chain(cands, root).where("succ IS NOT NULL"), root, "records")
    cols = ["file", "off", "record_type", "record_id", "refers_to", "target_uri", "digest",
            "http_length", "stored_bytes", "stored_digest"]
    split = records.where("succ <> end").select("file", "off", "succ")
    if payloads:
        split = records.select("file", "off", "succ")  # every payload is wanted, so read every file
    out = records.select(*cols) if payloads else records.where("succ = end").select(*cols)
    if payloads or split.limit(1).count():
        files = split.select("file").distinct()
        again = _segments(spark, path).join(files, "file", "left_semi")
        again = _offsets(again.withColumn("len", F.octet_length("value").cast("long"))).where("off >= 0")
        starts = again.join(split.withColumn("start", F.col("off")), ["file", "off"], "left")
        parts = _owned(starts.select("file", "blk", "off", "start", "succ", "value"))
        whole = (parts.groupBy("file", "start")
                 .agg(F.array_sort(F.collect_list(F.struct("off", "value"))).alias("parts"))
                 .select("file", F.col("start").alias("off"),
                         F.array_join(F.col("parts.value"), MAGIC).alias("value")))
        joined = whole.select("file", "off", *_fields(F.col("value"), payloads))
        if payloads:
            return joined.select(*cols, "payload")
        out = out.unionByName(joined.select(*cols))
    return out


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = read_warc(spark, write_warc(pages, f"{root}/archives", root), root, payloads=False)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    response = F.col("record_type") == "response"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(response, F.col("stored_bytes")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(response, F.col("stored_digest"))
        .otherwise(F.regexp_replace("digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, coalesce(html, '') AS html,
         sha1(coalesce(html, '')) AS h
  FROM pages),
q AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY html) AS first,
         list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::BIGINT, 10))::BIGINT
                        >> (5 * (7 - i % 8))::INTEGER) & 31), 1)), 'string_agg', '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""
