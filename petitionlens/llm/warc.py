"""WARC archives written and read back with boundary-chain verification.

Writing: one record per page; of pages with equal payloads that with the
largest id is a response, the others are revisit records without a body.  Spark's
text writer writes the files: a record ends with a line feed, which is the
writer's own row end.

Reading: Spark's text reader splits the files at the record magic, also inside
large files.  Each piece is a candidate record; its place follows from the
sizes of the pieces before it, its successor from its Content-Length.  Pointer
jumping from each file's start keeps the candidates that the chain reaches, in
as many rounds as the logarithm of the longest chain; a magic inside a payload
is never reached, and its piece goes back to the record that holds it.

Defined results: a null or empty html is an empty payload; null ids are the
smallest and are left out of the header; repeated rows of the largest id are
all responses; control characters in a URL are percent-encoded, a null URL is
left out; an empty table writes nothing.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, materialise, read_table, rows_batch, shared_dir, utf8

MAGIC = "WARC/1.1\r\n"
#: Fixed value: the standard's name for revisits of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: ten hex digits at a time become eight base-32 digits."""
    hexed = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_roles(pages: DataFrame, key: str, payload: str, few: int = 100_000) -> DataFrame:
    """Append payload_bytes, payload_digest, record_type and refers_to.

    Only payloads that occur more than once are looked up; the lookup is
    broadcast if it has at most ``few`` rows and joined otherwise.
    """
    marked = pages.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn("payload_digest", base32_sha1(F.col(payload)))
    groups = marked.groupBy("payload_digest", "payload_bytes").agg(F.count(F.lit(1)).alias("__n__"), F.max(key).alias("__first__"))
    groups = materialise(groups.where("__n__ > 1").drop("__n__"))
    if groups.limit(few + 1).count() <= few:
        groups = F.broadcast(groups)
    joined = marked.join(groups, ["payload_digest", "payload_bytes"], "left")
    other = F.col("__first__").isNotNull() & ~F.col(key).eqNullSafe(F.col("__first__"))
    return (
        joined.withColumn("record_type", F.when(other, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(other, F.col("__first__")))
        .drop("__first__")
    )


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _safe_url(url: Column) -> Column:
    for c in "\r\n\t ":
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return url


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", records: int = 50_000, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write one WARC record per row to a new shared folder, at most ``records`` to a file; returns its path.

    ``date`` is the capture time that all records of a write carry.
    """
    path = shared_dir(pages.sparkSession)
    rows = with_roles(pages.select(F.col(key).alias("id"), F.col(url).alias("url"), utf8(html).alias("payload")), "id", "payload")
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Target-URI", _safe_url(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("X-Page-Id", F.col("id")),
        _header("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("none")), F.lit(">")))),
        _header("X-Payload-Bytes", F.col("payload_bytes")),
        _header("Content-Length", F.length(body)),
        F.lit("\r\n"),
        body.cast("string"),
        F.lit("\r\n\r"),
    )
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", records).text(path)
    return path


CANDIDATE = (
    "file string, split long, rel long, size long, next long, page_id long, payload_bytes long, digest string, "
    "declared string, record_type string, refers_to long, body long, length long"
)


def _fields(piece: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields of a piece and where its body begins; None if it has no header with a length."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def _page(value: str | None) -> int | None:
    value = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value.lstrip("-").isdigit() else None


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between two magics, with their file and the split that Spark reads them in."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("value").cast("binary").alias("piece"), "_metadata.file_path", "_metadata.file_block_start")


def candidates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """CANDIDATE rows with ``off``, the magic's place in its file, one for each occurrence of the magic;
    and the place at which each split's first piece begins.

    ``next`` is the successor's distance from the magic.  The digest is null if the piece ends
    before the body does.
    """
    kind = StructType.fromDDL(CANDIDATE)
    schema = arrow_schema(kind)
    magic = len(MAGIC)

    def run(batches: Batches) -> Batches:
        at: dict[tuple[str, int], int] = {}
        for b in batches:
            rows = []
            for piece, file, split in zip(*[c.to_pylist() for c in b.columns]):
                rel = at.get((file, split), 0)
                size = len(piece) + magic
                at[file, split] = rel + size
                found = _fields(piece)
                if found is None:
                    rows.append((file, split, rel, size, *[None] * 9))
                    continue
                fields, body = found
                n = int(fields["content-length"])
                declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                kind_of = fields.get("warc-type")
                full = fields.get("x-payload-bytes", "")
                digest = declared if kind_of == "revisit" else None
                if digest is None and body + n <= len(piece):
                    digest = base32_digest(piece[body : body + n])
                rows.append((
                    file, split, rel, size, magic + body + n + 4, _page(fields.get("x-page-id")),
                    n if kind_of != "revisit" else int(full) if full.isdigit() else None,
                    digest, declared, kind_of, _page(fields.get("warc-refers-to")), body, n,
                ))
            yield rows_batch(rows, schema)

    found = materialise(map_batches(pieces(spark, path), run, kind))
    splits = found.groupBy("file", "split").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(splits.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start")))
    # a file's first piece stands before its first magic; every other piece follows one
    placed = found.join(starts, ["file", "split"]).withColumn("off", F.col("start") + F.col("rel") - magic)
    return materialise(placed.where("off >= 0").drop("start", "split", "rel", "size")), starts


def reachable(found: DataFrame) -> DataFrame:
    """file, off of the candidates on the chain from each file's start, by pointer jumping."""
    state = found.select("file", "off", (F.col("off") + F.col("next")).alias("jump"), (F.col("off") == 0).alias("on"))
    seen = -1
    while True:
        state = materialise(state)
        now = state.where("on").count()
        if now == seen:
            return state.where("on").select("file", "off")
        seen = now
        targets = state.where(F.col("on") & F.col("jump").isNotNull()).select("file", F.col("jump").alias("off"), F.lit(True).alias("hit")).distinct()
        ahead = state.select("file", F.col("off").alias("jump"), F.col("jump").alias("far"))
        state = (
            state.join(ahead, ["file", "jump"], "left")
            .join(targets, ["file", "off"], "left")
            .select("file", "off", F.col("far").alias("jump"), (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on"))
        )


def spanning_digests(spark: SparkSession, path: str, marked: DataFrame, starts: DataFrame) -> DataFrame:
    """file, off, digest of the true records whose payload holds a magic.

    Their pieces are read once more and joined in order; a group is one record.
    """
    order = Window.partitionBy("file").orderBy("off")
    owner = F.last(F.when(F.col("on"), F.struct("off", "body", "length", F.col("digest").isNull().alias("open"))), ignorenulls=True).over(order)
    wanted = marked.select("file", "off", owner.alias("owner")).where("owner.open")
    kind = StructType.fromDDL("file string, split long, rel long, piece binary")
    schema = arrow_schema(kind)

    def run(batches: Batches) -> Batches:
        at: dict[tuple[str, int], int] = {}
        for b in batches:
            rows, held = [], 0
            for piece, file, split in zip(*[c.to_pylist() for c in b.columns]):
                rel = at.get((file, split), 0)
                at[file, split] = rel + len(piece) + len(MAGIC)
                rows.append((file, split, rel, piece))
                held += len(piece)
                if held > 8 << 20:
                    yield rows_batch(rows, schema)
                    rows, held = [], 0
            yield rows_batch(rows, schema)

    placed = map_batches(pieces(spark, path), run, kind).join(starts, ["file", "split"])
    placed = placed.select("file", (F.col("start") + F.col("rel") - len(MAGIC)).alias("off"), "piece")
    parts = placed.join(wanted, ["file", "off"]).groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("off", "piece"))).alias("parts"))
    # binary pieces stay binary: concat keeps the type
    whole = F.aggregate(
        F.col("parts"),
        F.lit(b""),
        lambda acc, x: F.concat(acc, F.when(F.length(acc) > 0, F.lit(MAGIC.encode())).otherwise(F.lit(b"")), x["piece"]),
    )
    payload = F.substring(whole, F.col("owner.body").cast("int") + 1, F.col("owner.length").cast("int"))
    return parts.select("file", F.col("owner.off").alias("off"), base32_sha1(payload).alias("joined"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every verified record.

    A response whose payload differs from its declared digest fails the job.
    """
    found, starts = candidates(spark, path)
    on = reachable(found).withColumn("on", F.lit(True))
    marked = found.join(on, ["file", "off"], "left").withColumn("on", F.coalesce("on", F.lit(False)))
    true = marked.where("on")
    if not true.where(F.col("digest").isNull()).isEmpty():
        true = true.join(spanning_digests(spark, path, marked, starts), ["file", "off"], "left")
        true = true.withColumn("digest", F.coalesce("digest", "joined"))
    checked = F.when(F.col("digest") == F.col("declared"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest at "), F.col("file"), F.lit(":"), F.col("off").cast("string")))
    )
    return true.select("page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from the archives."""
    return read_archives(spark, write_archives(read_table(spark, sf_dir, "pages")))


#: The bits of the SHA-1's hex digits, five at a time, name the base-32 digits.
OP3_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hexed FROM p
), b AS (
  SELECT page_id, payload_bytes,
         list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', hexed[i]) - 1), 4, '0')), 'string_agg', '') AS bits
  FROM h
), d AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(bits[5 * i + j + 1] AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER))) AS INTEGER) + 1, 1)),
           'string_agg', '') AS payload_digest
  FROM b
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM m
"""
