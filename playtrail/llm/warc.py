"""WARC archives and their index of captures.

Writing: every page becomes a WARC record. Of records with equal payloads the
one with the smallest page id is a ``response`` with the payload; the others are
``revisit`` records that refer to it (payloads shorter than ``revisit_bytes``
are all responses). The archives are written by Spark's text writer: a row is a
record's header and payload, and the line separator is the record's closing
CRLF CRLF, so any file system Spark writes to will do.

Reading: files are opened with ``binaryFile`` and cut by Content-Length.

Index: each archive yields a run of its captures sorted by URL key, time and
page id. The runs are dealt to key ranges by a range shuffle (a hot URL is cut
by time and page id too), and each range merges the pieces of its runs with a
loser tree. Ranges in order form the global capture history.

Defined results: a null payload is the empty payload; a null URL has an empty
key; a null page id is written as an empty id and read back as null; repeated
rows are records of their own; equal captures keep any order among
themselves; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtrail.session import bounded_broadcast, materialize, scratch_path

EPOCH = "2024-01-01T00:00:00Z"    # capture time of page id 0; one second per id
RECORDS_PER_FILE = 1_000           # bounds the size of an archive
FILES_PER_BATCH = 1
REVISIT_ROWS = 500_000             # revisits that may be broadcast; a shuffle join beyond
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, lower case
    (``http://a.example.com/x?y`` -> ``com,example,a)/x?y``); no scheme, user,
    port or fragment."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^[^@]*@|:[0-9]*$", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    return F.when(bare == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hex string: 8 letters for each 10 digits."""
    letters = []
    for g in range(4):
        number = F.conv(F.substring(digest, 10 * g + 1, 10), 16, 10).cast("long")
        for i in range(8):
            at = F.shiftright(number, 35 - 5 * i).bitwiseAND(F.lit(31))
            letters.append(F.substring(F.lit(BASE32), at.cast("int") + 1, F.lit(1)))
    return F.concat(*letters)


def records(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Header fields and payload of every page's record. Only (digest, smallest
    id) is aggregated, partially before the shuffle; payloads are not moved."""
    df = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"))
    df = df.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    first = df.groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").withColumnRenamed("size", "size_").drop("n")
    narrow = (df.select("page_id", "sha1", "size").join(first, "sha1").where("size = size_ and page_id > first")
              .select(F.col("page_id").alias("again"), F.col("sha1").alias("again_sha1"), "first").distinct())
    narrow = bounded_broadcast(materialize(narrow, "revisits"), REVISIT_ROWS)
    out = df.join(narrow, (F.col("page_id") == F.col("again")) & (F.col("sha1") == F.col("again_sha1")), "left")
    refers = F.when(F.col("size") >= revisit_bytes, F.col("first"))
    return out.select("page_id", "url", "payload", "size", base32_of_hex(F.col("sha1")).alias("digest"), refers.alias("refers_to"))


def write_warc(recs: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records as gzip WARC files under ``path``."""
    revisit = F.col("refers_to").isNotNull()
    when = F.date_format(F.timestamp_seconds(F.unix_seconds(F.lit(EPOCH).cast("timestamp")) + F.coalesce("page_id", F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " ")),
        F.concat(F.lit("WARC-Date: "), when),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string")))]
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    value = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body).alias("value")
    (recs.select(value).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)")


def parse_warc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, header fields, payload)`` of each record, cut by Content-Length."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        fields = {k.decode(): v.decode() for k, v in FIELD.findall(data[at:head])}
        body = head + 4
        end = body + int(fields["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"no record end at byte {end}")
        yield at, fields, data[body:end]
        at = end + 4


def _number(s: str | None) -> int | None:
    digits = (s or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


READ_SCHEMA = ("file string, offset long, page_id long, url string, captured string, payload_bytes long, "
               "payload_digest string, record_type string, refers_to long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import gzip
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):
            rows = []
            for at, f, payload in parse_warc(gzip.decompress(content.as_py())):
                kind, digest = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and (len(payload) != int(f["X-Payload-Length"])
                                           or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"damaged record at byte {at} of {path}")
                rows.append((path, at, _number(f["WARC-Record-ID"]), f["WARC-Target-URI"], f["WARC-Date"],
                             int(f["X-Payload-Length"]), digest, kind, _number(f.get("WARC-Refers-To"))))
            names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
            kinds = [pa.int64() if " long" in c else pa.string() for c in READ_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``; payloads are checked against
    their digests and dropped."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(FILES_PER_BATCH))
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
        return materialize(files.mapInArrow(_read, READ_SCHEMA), "warc-records")
    finally:
        spark.conf.set(conf, before)


def loser_tree_merge(runs: list[list]) -> Iterator:
    """Merge sorted lists. Inner nodes hold the losers of their matches; only the
    path of the last winner is played again. Ties go to the earlier run."""
    k = len(runs)
    if not k:
        return
    its = [iter(r) for r in runs]
    head = [next(it, None) for it in its]

    def beats(i: int, j: int) -> bool:
        if head[i] is None or head[j] is None:
            return head[j] is None and (head[i] is not None or i < j)
        return head[i] < head[j] or (head[i] == head[j] and i < j)

    lost, up = [0] * k, {}
    for i in range(2 * k - 1, 0, -1):       # leaves k..2k-1, inner nodes 1..k-1
        if i >= k:
            up[i] = i - k
        else:
            a, b = up[2 * i], up[2 * i + 1]
            up[i], lost[i] = (a, b) if beats(a, b) else (b, a)
    win = up[1]
    while head[win] is not None:
        yield head[win]
        head[win] = next(its[win], None)
        node = (win + k) // 2
        while node:
            if beats(lost[node], win):
                win, lost[node] = lost[node], win
            node //= 2


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the pieces of runs that fell into this key range, in order."""
    runs: dict[int, list] = {}
    payload: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            key = (r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0)
            runs.setdefault(r["run"], []).append((*key, len(payload)))
            payload.append(r)
    for piece in runs.values():
        piece.sort()          # linear where the shuffle kept the run's order
    order = [x[-1] for x in loser_tree_merge(list(runs.values()))]
    for at in range(0, len(order), 10_000):
        rows = [payload[i] | {"pos": at + j} for j, i in enumerate(order[at:at + 10_000])]
        yield pa.RecordBatch.from_pylist(rows, schema=MERGED)


MERGED = pa.schema([("run", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("pos", pa.int64())])


def capture_history(captures: DataFrame) -> DataFrame:
    """Merge the sorted runs of all archives into one global order:
    ``history_pos`` counts captures by URL key, time and page id from 1."""
    keyed = captures.select(
        F.xxhash64("file").alias("run"), url_key(F.col("url")).alias("url_key"), "captured", "page_id",
        "payload_bytes", "payload_digest", "record_type", "refers_to")
    runs = materialize(keyed.repartition("run").sortWithinPartitions("run", "url_key", "captured", "page_id"), "capture-runs")
    ranges = runs.repartitionByRange("url_key", "captured", "page_id")
    schema = ("run long, url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, pos long")
    merged = materialize(ranges.mapInArrow(_merge, schema).withColumn("range", F.spark_partition_id()), "merged-ranges")
    # Task numbers follow the key order; one row per task, so the offsets are bounded.
    before = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return merged.join(F.broadcast(before), "range").withColumn(
        "history_pos", F.col("before") + F.col("pos") + 1).drop("run", "range", "pos", "before")


def archive(pages: DataFrame, path: str | None = None, revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC archives under ``path`` (by
    default below the shared folder), read them back and merge their index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(records(pages, revisit_bytes), path)
    return capture_history(read_warc(spark, path))
