"""WARC archives as tables of chunks.

Writing: every record becomes one row per chunk of its payload, keyed by record identifier and
chunk number, and every row is written as one WARC record: the first chunk as the response, the
others as its continuations (segments). A payload that was captured before becomes a revisit. No
row is longer than a chunk, so neither the writer nor the reader holds a whole record beyond the
cell it comes from.

Reading: the start line of a record is the line separator of Spark's text reader, which reads
record by record. It ends in a version mark, and a payload is cut inside every such mark, so no chunk
holds one: neither inside a chunk, nor where a chunk follows a header or precedes the next record, can
the separator arise, whatever else a payload begins or ends with.
The digest of a record in one chunk is taken where it is read; the chunks of the others are sorted
by number and folded one after the other into a running digest.

Archives are gzip files in the folder given, ``WARC/1.1``, block ``application/http``. Besides the
standard fields, ``Page-Id`` and ``Refers-To-Page-Id`` carry the ids of the table, ``Payload-Length``
the bytes of the whole payload.

Defined results: null html is an empty payload; a null page_id is kept as null; a null url leaves
out the target, line breaks in a url are escaped. Of rows with equal payloads those with the
smallest page_id are responses and the others revisits, a null page_id only if there is no other.
Repeated rows become records of their own. Columns other than those named are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.store import stored

CHUNK_CHARS = 1 << 16
MIN_REVISIT_BYTES = 0

# Fixed values of the format.
START = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_SEPARATOR = END + START
_MARK = START.rstrip()
_CUT = r"(?<=WARC/1\.)(?=1)"


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a SHA-1 given as 40 hex digits."""
    letters = []
    for part in range(8):
        bits = F.conv(F.substring(sha1_hex, 5 * part + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(BASE32), F.shiftright(bits, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1))
            for k in range(4)
        ]
    return F.concat(*letters)


def chunks(payload: str, size: int = CHUNK_CHARS) -> Column:
    """The payload in pieces of at most ``size`` characters, none of which contains a version
    mark. An empty payload is one empty piece."""
    short = (F.length(payload) <= size) & (F.instr(payload, _MARK) == 0)
    parts = F.split(payload, _CUT, -1)
    cut = F.flatten(
        F.transform(parts, lambda part: F.regexp_extract_all(part, F.lit(f"(?s).{{1,{size}}}"), 0))
    )
    return F.when(short, F.array(payload)).otherwise(cut)


def _field(name: str, value: Column | str) -> Column:
    """A header line; nothing where the value is null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def decided(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html`` with ``sha1``, ``payload_bytes`` and ``refers_to``, which is the
    page_id of the record with the same payload or null for a response."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("sha1", F.sha1("html")).withColumn(
        "payload_bytes", F.octet_length("html").cast("long")
    )
    # The decisions are small rows; payloads meet them by page_id, which is never hot.
    seen = stored(rows.select("page_id", "sha1", "payload_bytes"), "digests")
    first = seen.groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("refers_to"))
    revisits = (
        seen.where(F.col("payload_bytes") >= min_bytes)
        .join(first, ["sha1", "payload_bytes"])
        .where("page_id > refers_to or (page_id is null and refers_to is not null)")
        .select("page_id", "sha1", "refers_to")
        .distinct()
    )
    found = stored(revisits, "revisits")
    same = [
        rows["page_id"].eqNullSafe(found["page_id"]),
        rows["sha1"] == found["sha1"],
        # An equality that a shuffle can be keyed on, null ids included.
        F.coalesce(rows["page_id"], F.lit(-1)) == F.coalesce(found["page_id"], F.lit(-1)),
    ]
    joined = rows.join(found, same, "left")
    return joined.select(*[rows[name] for name in rows.columns], found["refers_to"])


def records(rows: DataFrame, date: str, size: int = CHUNK_CHARS) -> DataFrame:
    """One text per WARC record, from the rows of ``decided``."""
    revisit = F.col("refers_to").isNotNull()
    rows = rows.withColumn("record", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
    pieces = F.when(revisit, F.array(F.lit(""))).otherwise(chunks("html", size))
    rows = rows.withColumn("pieces", pieces).withColumn("n", F.size("pieces")).drop("html")
    rows = rows.select("*", F.posexplode("pieces").alias("at", "piece")).drop("pieces")
    first, segmented = F.col("at") == 0, F.col("n") > 1
    last = segmented & (F.col("at") == F.col("n") - 1)
    block = F.when(first, F.concat(F.lit(HTTP), "piece")).otherwise(F.col("piece"))
    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")
    identifier = F.when(first, F.col("record")).otherwise(
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))
    )
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(START),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", identifier),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("WARC-Segment-Number", F.when(segmented, F.col("at") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(segmented & ~first, F.col("record"))),
        _field(
            "WARC-Segment-Total-Length",
            F.when(last, F.col("payload_bytes") + len(HTTP.encode())),
        ),
        _field("Page-Id", "page_id"),
        _field("Refers-To-Page-Id", "refers_to"),
        _field("Payload-Length", "payload_bytes"),
        _field("Content-Type", F.when(first, "application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(header, block).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    date: str = "1970-01-01T00:00:00Z",
    size: int = CHUNK_CHARS,
    min_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as gzip files below ``path``."""
    texts = records(decided(pages, min_bytes), date, size)
    texts.write.option("lineSep", END).option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``record, chunk, kind, page_id, refers_to, payload_bytes, digest, url, segmented, data``:
    one row per chunk of the archives below ``path``; ``data`` is payload."""
    raw = spark.read.option("lineSep", _SEPARATOR).text(path)
    # Only the first record of a file still has its start line.
    at_start = F.col("value").startswith(START)
    rows = raw.withColumn("head", F.concat(F.substring_index("value", END, 1), F.lit("\r")))
    rows = rows.select(
        F.when(at_start, F.substring("head", len(START) + 1, 1 << 30))
        .otherwise(F.col("head"))
        .alias("head"),
        F.substring("value", F.length("head") + len(END), F.lit(1 << 30)).alias("block"),
    )

    rows = rows.withColumn("fields", F.str_to_map("head", F.lit("\r\n"), F.lit(": "))).drop("head")

    def field(name: str) -> Column:
        return F.col("fields")[name]

    # The last record of a file still has its end mark; what is too much is ASCII.
    extra = F.octet_length("block") - field("Content-Length").cast("int")
    continued = field("WARC-Segment-Origin-ID")
    start = F.when(continued.isNull(), len(HTTP) + 1).otherwise(1)
    length = F.length("block") - extra - start + 1
    rows = rows.withColumn("data", F.substring("block", start, length)).drop("block")
    return rows.select(
        F.coalesce(continued, field("WARC-Record-ID")).alias("record"),
        F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)).alias("chunk"),
        field("WARC-Segment-Number").isNotNull().alias("segmented"),
        field("WARC-Type").alias("kind"),
        field("WARC-Target-URI").alias("url"),
        field("Page-Id").cast("long").alias("page_id"),
        field("Refers-To-Page-Id").cast("long").alias("refers_to"),
        field("Payload-Length").cast("long").alias("payload_bytes"),
        F.substring(field("WARC-Payload-Digest"), 6, 32).alias("digest"),
        "data",
    )


DIGEST_SCHEMA = "record string, page_id long, digest string, read_bytes long, read_digest string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order of record and number to one row per record. Holds one running digest."""
    names = ["record", "page_id", "digest", "read_bytes", "read_digest"]
    known, digest, size = None, None, 0

    def row() -> pa.RecordBatch:
        values = [*known, size, base64.b32encode(digest.digest()).decode()]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        arrays = [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        columns = [batch.column(name) for name in ("record", "page_id", "digest", "data")]
        for record, page_id, stated, data in zip(*columns, strict=True):
            if known is None or record.as_py() != known[0]:
                if known is not None:
                    yield row()
                known = (record.as_py(), page_id.as_py(), stated.as_py())
                digest, size = hashlib.sha1(), 0
            piece = data.as_buffer()
            digest.update(piece)
            size += piece.size
    if known is not None:
        yield row()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` of every record
    below ``path``. Length and digest of a response are those of the payload read, ``intact`` says
    whether they are what the archive states; those of a revisit are the stated ones."""
    rows = read_chunks(spark, path)
    whole = rows.where(~F.col("segmented")).select(
        "page_id",
        "kind",
        "refers_to",
        "payload_bytes",
        "digest",
        F.octet_length("data").cast("long").alias("read_bytes"),
        base32(F.sha1("data")).alias("read_digest"),
    )
    revisit = F.col("kind") == "revisit"
    whole = whole.select(
        "page_id",
        F.when(revisit, F.col("payload_bytes")).otherwise(F.col("read_bytes")).alias(
            "payload_bytes"
        ),
        F.when(revisit, F.col("digest")).otherwise(F.col("read_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
        (revisit | (F.col("digest") == F.col("read_digest"))).alias("intact"),
    )
    parts = rows.where("segmented").select("record", "chunk", "page_id", "digest", "data")
    parts = parts.repartition("record").sortWithinPartitions("record", "chunk").drop("chunk")
    folded = parts.mapInArrow(_fold, DIGEST_SCHEMA).select(
        "page_id",
        F.col("read_bytes").alias("payload_bytes"),
        F.col("read_digest").alias("payload_digest"),
        F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
        (F.col("digest") == F.col("read_digest")).alias("intact"),
    )
    return whole.union(folded)
