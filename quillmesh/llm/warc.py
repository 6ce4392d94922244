"""WARC archives: writing through Spark's text sink, reading by boundary chains (operator 8).

Reading doesn't trust the magic: each task lists every place that looks like a record start with
the offset of its successor, and pointer jumping from offset 0 keeps what a real chain reaches.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.words import freeing
from quillmesh.storage import materialize, new_path, small_side

VERSION = "WARC/1.1"
MAGIC = b"WARC/1."
#: Smaller payloads are never written as revisits.
REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4096
#: Payloads of so many bytes at most share files; each class has a sixteenth of the records of the one before.
SIZE_CLASSES = (16_384, 262_144, 4_194_304)
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CANDIDATES = "file string, off long, nxt long, size long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, intact boolean"


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))


def _record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(">"))


def revisit_targets(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``k, refers_to``: payloads (by SHA-256) that several rows share, and the largest page_id of each."""
    meta = pages.where(F.octet_length("t") >= least).select("page_id", F.unhex(F.sha2("t", 256)).alias("k"))
    return meta.groupBy("k").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL").drop("n")


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE, date: str | None = None) -> None:
    """Write one record per row of ``pages`` (page_id long, url, html) to uncompressed WARC 1.1 files.

    Null html is an empty payload, null url an empty target. Of equal payloads of at least ``least``
    bytes, those without the largest page_id are revisits: their block is empty and they name that
    response. Rows that repeat page_id and payload are responses alike; a row without a page_id is
    named by its payload alone, and of such rows only, all are responses. A record's id holds page_id
    and payload digest, so one page_id may stand for several payloads.
    A file has at most ``records_per_file`` records, fewer where payloads are larger, so that its size
    is bounded. ``date`` is the records' WARC-Date (now, by default).
    """
    stamp = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ").alias("url"),
        F.coalesce("html", F.lit("")).alias("t"),
    )
    targets = small_side(materialize(revisit_targets(rows, least), "responses"))
    size, level = F.octet_length("t"), F.lit(0)
    for most in SIZE_CLASSES:
        level = level + (size > most).cast("int")
    rows = rows.withColumns({"digest": F.sha1("t"), "level": level, "k": F.when(size >= least, F.unhex(F.sha2("t", 256)))}).join(targets, "k", "left")
    revisit = F.col("refers_to").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to")))
    record = F.concat(
        F.lit(VERSION + "\r\n"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _header("WARC-Date", F.lit(stamp)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("X-Payload-Length", size),
        F.when(revisit, F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("digest"))))).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.when(revisit, 0).otherwise(size + len(HTTP_HEAD))),
        F.lit("\r\n"),
        # the text sink's line separator is the second half of a record's end
        F.when(revisit, "").otherwise(F.concat(F.lit(HTTP_HEAD), F.col("t"))),
        F.lit("\r\n"),
    )
    out = rows.select("level", record.alias("value"))
    found = sorted(r[0] for r in pages.select(F.octet_length(F.coalesce("html", F.lit(""))).alias("n")).select(sum((F.col("n") > m).cast("int") for m in SIZE_CLASSES).alias("level")).distinct().collect())
    for at in found or [0]:
        out.where(F.col("level") == at).select("value").write.mode("append").option("lineSep", "\r\n").option("maxRecordsPerFile", max(1, records_per_file >> (4 * at))).text(path)


def _number(value: bytes | None) -> int | None:
    value = (value or b"").strip()
    return int(value) if value.lstrip(b"-").isdigit() else None


def _page_of(record_id: bytes | None) -> int | None:
    """The page_id in a record's id; null for ids of other writers."""
    value = (record_id or b"").strip()
    return _number(value[len(b"<urn:page:") :].partition(b":")[0]) if value.startswith(b"<urn:page:") else None


def _sha1_hex(value: bytes | None) -> str | None:
    """Lower-case hex of a labelled digest, be it in hex or base 32; null if it is absent or not SHA-1."""
    label, _, digest = (value or b"").strip().rpartition(b":")
    if label.lower() not in (b"", b"sha1"):
        return None
    try:
        return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else bytes.fromhex(digest.decode("ascii")).hex() or None
    except ValueError:
        return None


def _candidates(file: str, data: bytes) -> Iterator[tuple]:
    """Every offset where a record might start, with where its successor would."""
    at = data.find(MAGIC)
    while at >= 0:
        body = data.find(b"\r\n\r\n", at)
        if body >= 0 and data[at + len(MAGIC) : at + len(MAGIC) + 3] in (b"0\r\n", b"1\r\n"):
            pairs = (x.partition(b":") for x in data[at + len(MAGIC) + 3 : body].split(b"\r\n"))
            head = {k.strip().lower(): v.strip() for k, _, v in pairs}
            length = _number(head.get(b"content-length"))
            if length is not None and 0 <= length <= len(data) - body - 8 and data[body + 4 + length : body + 8 + length] == b"\r\n\r\n":
                payload = data[body + 4 : body + 4 + length]
                if head.get(b"content-type", b"").startswith(b"application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
                digest = _sha1_hex(head.get(b"warc-payload-digest"))
                kind = head.get(b"warc-type", b"").decode("latin-1")
                own = hashlib.sha1(payload).hexdigest() if kind != "revisit" else digest
                size = _number(head.get(b"x-payload-length")) if kind == "revisit" else len(payload)
                yield file, at, body + 8 + length, len(data), _page_of(head.get(b"warc-record-id")), kind, _page_of(head.get(b"warc-refers-to")), size, digest or own, digest in (None, own)
        at = data.find(MAGIC, at + 1)


@freeing
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in CANDIDATES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    for batch in batches:
        for file, data in zip(batch.column(0), batch.column(1)):
            rows = list(_candidates(file.as_py(), data.as_py()))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def reachable(candidates: DataFrame) -> DataFrame:
    """``file, off`` of the records on the chain that starts at offset 0 of each file.

    Pointer jumping: each round a reached record marks what its pointer names, then all pointers
    double, so that a file of n records takes log2(n) rounds.
    """
    step = materialize(candidates.select("file", "off", F.col("nxt").alias("ptr"), (F.col("off") == 0).alias("reached")), "chain")
    count = step.where("reached").count()
    while True:
        marks = step.where("reached").select("file", F.col("ptr").alias("off"), F.lit(True).alias("mark"))
        jump = step.select("file", F.col("off").alias("ptr"), F.col("ptr").alias("ptr2"))
        step = materialize(
            step.join(marks.distinct(), ["file", "off"], "left")
            .join(jump, ["file", "ptr"], "left")
            .select("file", "off", F.coalesce("ptr2", F.lit(-1).cast("long")).alias("ptr"), (F.col("reached") | F.coalesce("mark", F.lit(False))).alias("reached")),
            "chain",
        )
        before, count = count, step.where("reached").count()
        if count == before:
            return step.where("reached").select("file", "off")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all uncompressed WARC 1.0 and 1.1 files under ``path``: ``file, off, page_id,
    record_type, refers_to, payload_bytes, payload_digest, intact``.

    ``page_id`` and ``refers_to`` are null for records that other writers have named. ``intact`` is
    false where a response's bytes don't have the digest of its header. Bytes after a broken record
    are not read as records; a folder without records gives an empty result. A file is one row, so
    files of over 2 GB can't be read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("path", "content")
    found = materialize(files.mapInArrow(_scan, CANDIDATES), "candidates")
    return found.join(reachable(found), ["file", "off"]).drop("nxt", "size")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op8_warc": op8_warc}
ORACLE: dict[str, str] = {
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
        g AS (SELECT page_id, t, strlen(t) AS n, max(page_id) OVER (PARTITION BY t) AS last FROM p)
        SELECT page_id, n AS payload_bytes, sha1(t) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
        FROM g
    """
}
