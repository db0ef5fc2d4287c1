"""Groups of equal texts from an extendible-hash index in the shared folder; DataFrame functions only.

1.  The directory.  One scan weighs the key space (64-bit hash of the text) in
    fixed slots.  Starting from a single bucket, the directory doubles while a
    bucket holds more than a page, and each overfull bucket splits in two, up
    to the directory's largest depth.  What is overfull then (a few keys that
    many rows share) becomes a chain of as many pages as it needs, over which
    its rows are dealt by their id.  The directory is stored as a table of at
    most 2^MAX_DEPTH slots, which bounds its broadcast.
2.  The pages.  Rows go once, with their texts, to the task that owns their
    page; light neighbouring buckets share an owner, so owners hold ranges of
    keys.  There rows are sorted by key and bytes: equal keys with different
    bytes become numbered links of the key's collision chain, and only equal
    bytes are equal texts.  The entries are written as the index, without the
    texts of one-page buckets.
3.  Buckets with several pages: the pages' distinct texts meet by key and are
    compared, byte by byte, in a map-side aggregate, and each page's links get
    the joint group back.

Defined results: null counts as the empty text; ids may be null (the largest
id of a group is taken over the others, and null if there is none) and may
repeat (of rows with the group's largest id one stays); empty tables give
empty results; texts of any size are compared whole; columns of other names
pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table, utf8

#: Bits of the key that the directory can tell apart.
MAX_DEPTH = 20
#: What a row weighs besides its text.
ROW_BYTES = 64


@dataclass(frozen=True)
class Bucket:
    """Keys that begin with the ``depth`` bits ``prefix``; its rows are on ``pages`` pages from ``owner`` on."""

    depth: int
    prefix: int
    weight: int
    owner: int = 0
    pages: int = 1


def index_key(data: Column) -> Column:
    """The 64-bit key of a text's bytes."""
    return F.xxhash64(data)


def slot(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def grow(weights: dict[int, int], depth: int, page_bytes: int) -> list[Bucket]:
    """The buckets, in the order of their keys, that doubling a directory up to ``depth`` bits ends with."""
    levels = [weights]
    for _ in range(depth):
        above: dict[int, int] = {}
        for p, w in levels[0].items():
            above[p >> 1] = above.get(p >> 1, 0) + w
        levels.insert(0, above)
    done, overfull = [], [0]
    for bits in range(depth + 1):
        split = []
        for p in overfull:
            w = levels[bits].get(p, 0)
            if w <= page_bytes or bits == depth:
                done.append(Bucket(bits, p, w))
            else:
                split += [2 * p, 2 * p + 1]
        overfull = split
    return sorted(done, key=lambda b: b.prefix << (depth - b.depth))


def with_owners(buckets: list[Bucket], page_bytes: int) -> tuple[list[Bucket], int]:
    """Buckets with their pages' owners, and the number of owners: light neighbours share one."""
    out, owner, held = [], 0, 0
    for b in buckets:
        pages = max(1, -(-b.weight // page_bytes))
        if held and (pages > 1 or held + b.weight > page_bytes):
            owner, held = owner + 1, 0
        out.append(Bucket(b.depth, b.prefix, b.weight, owner, pages))
        if pages > 1:
            owner += pages
        else:
            held += b.weight
    return out, owner + 1


def build_directory(keys: DataFrame, page_bytes: int) -> tuple[DataFrame, int, int] | None:
    """Stored (slot, owner, pages), its depth and the number of owners, for rows of (h, weight); None: no rows.

    The driver sees the weights of at most 2^MAX_DEPTH slots, about eight for each page.
    """
    spark = keys.sparkSession
    fine = materialise(keys.groupBy(slot(F.col("h"), MAX_DEPTH).alias("slot")).agg(F.sum("weight").alias("weight")))
    total = fine.agg(F.sum("weight")).first()[0]
    if total is None:
        return None
    depth = min(MAX_DEPTH, (-(-total // page_bytes) * 8 - 1).bit_length())
    coarse = fine.groupBy(F.shiftright("slot", MAX_DEPTH - depth).alias("slot")).agg(F.sum("weight"))
    buckets, owners = with_owners(grow({r[0]: r[1] for r in coarse.collect()}, depth, page_bytes), page_bytes)
    slots = [
        (s, b.owner, b.pages)
        for b in buckets
        for s in range(b.prefix << (depth - b.depth), (b.prefix + 1) << (depth - b.depth))
    ]
    return materialise(spark.createDataFrame(slots, "slot long, owner int, pages int").coalesce(1)), depth, owners


def build_index(
    docs: DataFrame, key: str = "doc_id", text: str = "text", columns: Sequence[str] = (), page_bytes: int = 16 << 20
) -> DataFrame | None:
    """The stored entries: owner, pages, h, chain, id, place, page_id, page_size, sha, data, rest; None for an empty table.

    ``chain`` numbers the texts of one key on a page; ``place`` is 1 for the
    row with the largest id of its text there, page_id and page_size are that
    id and the number of equal texts.  ``data`` is kept for one row of each
    text where a bucket has several pages.  ``rest`` holds ``columns``.
    """
    data = utf8(text)
    weight = (F.length(data) + F.lit(ROW_BYTES)).cast("long")
    directory = build_directory(docs.select(index_key(data).alias("h"), weight.alias("weight")), page_bytes)
    if directory is None:
        return None
    slots, depth, owners = directory
    rest = F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("boolean")
    rows = docs.select(data.alias("data"), F.col(f"`{key}`").alias("id"), rest.alias("rest"))
    rows = rows.withColumn("h", index_key(F.col("data"))).withColumn("slot", slot(F.col("h"), depth))
    rows = rows.join(F.broadcast(slots), "slot")
    page = F.col("owner") + F.pmod(F.xxhash64("id"), F.col("pages")).cast("int")
    placed = rows.drop("slot").withColumn("owner", page).repartitionById(owners, F.col("owner"))
    # one sort serves all windows
    placed = placed.sortWithinPartitions("owner", "h", "data", F.desc_nulls_last("id"))
    link = Window.partitionBy("owner", "h").orderBy("data")
    same = Window.partitionBy("owner", "h", "data")
    entries = placed.select(
        "*",
        F.dense_rank().over(link).alias("chain"),
        F.row_number().over(same.orderBy(F.desc_nulls_last("id"))).alias("place"),
        F.max("id").over(same).alias("page_id"),
        F.count(F.lit(1)).over(same).alias("page_size"),
    )
    entries = entries.withColumn("sha", F.sha2("data", 256))
    kept = F.when((F.col("pages") > 1) & (F.col("place") == 1), F.col("data"))
    return materialise(entries.withColumn("data", kept))


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", columns: Sequence[str] = (), page_bytes: int = 16 << 20
) -> DataFrame:
    """``key``, keep_id, group_size, kept, text_sha256 and a struct ``rest`` of ``columns`` for each row of ``docs``."""
    index = build_index(docs, key, text, columns, page_bytes)
    if index is None:
        rest = F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("boolean")
        number = F.lit(None).cast("long")
        return docs.limit(0).select(
            key, F.col(f"`{key}`").alias("keep_id"), number.alias("group_size"), F.lit(None).cast("boolean").alias("kept"),
            F.lit(None).cast("string").alias("text_sha256"), rest.alias("rest"),
        )
    one = index.where("pages = 1").select(
        "id", F.col("page_id").alias("keep_id"), F.col("page_size").alias("group_size"), (F.col("place") == 1).alias("kept"), "sha", "rest"
    )
    several = index.where("pages > 1")
    texts = several.where("place = 1").groupBy("h", "data").agg(
        F.max(F.struct("page_id", (-F.col("owner")).alias("first"))).alias("best"),
        F.sum("page_size").alias("group_size"),
        F.collect_list(F.struct("owner", "chain")).alias("links"),  # one for each page of the key
    )
    links = texts.select("h", "best", "group_size", F.explode("links").alias("link")).select("h", "best", "group_size", "link.*")
    joined = several.drop("data").join(links, ["h", "owner", "chain"])
    more = joined.select(
        "id",
        F.col("best.page_id").alias("keep_id"),
        "group_size",
        ((F.col("place") == 1) & (F.col("owner") == -F.col("best.first"))).alias("kept"),
        "sha",
        "rest",
    )
    return one.union(more).withColumnsRenamed({"id": key, "sha": "text_sha256"})


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", page_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that with the largest ``key``."""
    return exact_groups(docs, key, text, docs.columns, page_bytes).where("kept").select("rest.*")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    return exact_groups(read_table(spark, sf_dir, "documents")).drop("rest")


OP13_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
