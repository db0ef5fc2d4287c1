"""SimHash near-duplicates by tiled exact comparison.

Equal fingerprints are merged first.  The distinct ones are dealt into tiles of
one population count each; only tiles whose counts differ by at most the radius
meet.  Inside a tile the fingerprints are grouped by the population counts of
their four 16-bit quarters, and two groups are compared (numpy exclusive-or and
bit counts) only if those counts differ by at most the radius in sum.  A tile
pair returns a spanning forest of its links, never all pairs.

Defined results: null and empty texts have fingerprint zero and link like any
other; a null key takes part in no minimum; repeated rows share one class; an
empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, materialise, read_table, utf8, with_columns
from .components import connected_components

CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - width + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, 42)
    sizes = [len(w) + 1 for w in words]
    starts = [0, *accumulate(sizes)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        h = np.fromiter(
            [digest(joined[s : e - 1], 42) for s, e in zip(starts[at:to], starts[at + width : to + width])], np.uint64, to - at
        )
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Append ``fp``, the fingerprint's 64 bits as a signed long."""

    def run(texts: list[bytes]) -> dict[str, object]:
        return {"fp": np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)}

    return with_columns(docs, utf8(text), run, "fp long", keep)


def quarters(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters of each fingerprint."""
    return np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int16)


class Forest:
    """Components of nodes 0..n-1 under links that come in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(jump := self.root[self.root], self.root):
                self.root = jump

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        return moved, self.root[moved]


def tile_groups(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints ordered by quarter counts, the distinct counts, and where their groups begin and end."""
    q = quarters(fps)
    order = np.lexsort(q.T)
    q, fps = q[order], fps[order]
    cuts = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]).any(axis=1)]) if len(fps) else np.zeros(0, np.int64)
    return fps, q[cuts], np.r_[cuts, len(fps)]


def links(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles of distinct fingerprints (``same``: within one)."""
    a, qa, ca = tile_groups(left)
    b, qb, cb = (a, qa, ca) if same else tile_groups(right)
    shift = 0 if same else len(a)
    found = Forest(len(a) if same else len(a) + len(b))
    for i in range(len(qa)):
        near = np.flatnonzero(np.abs(qb - qa[i]).sum(axis=1) <= radius)
        if same:
            near = near[near >= i]
        if not len(near):
            continue
        cols = np.concatenate([np.arange(cb[j], cb[j + 1]) for j in near])
        for at in range(ca[i], ca[i + 1], 256):
            rows = np.arange(at, min(at + 256, ca[i + 1]))
            for to in range(0, len(cols), 2048):
                other = cols[to : to + 2048]
                r, c = np.nonzero(np.bitwise_count(a[rows][:, None] ^ b[other][None, :]) <= radius)
                if len(r):
                    found.join(rows[r], other[c] + shift)
    nodes = a if same else np.concatenate([a, b])
    u, v = found.edges()
    return nodes[u], nodes[v]


EDGE = "a long, b long"


def link_forest(fps: DataFrame, radius: int = 3, tile: int = 1 << 14) -> DataFrame:
    """Edges (a, b) that connect the distinct ``fp`` rows within ``radius`` bits.

    The driver sees one count for each of the 65 population counts.
    """
    counted = fps.select("fp", F.bit_count("fp").alias("pop"))
    sizes = {r["pop"]: r["count"] for r in counted.groupBy("pop").count().collect()}
    many = {p: -(-n // tile) for p, n in sizes.items()}
    tiles_of = F.create_map(*[F.lit(x) for p, n in (many or {-1: 0}).items() for x in (p, n)])
    number = F.pmod(F.xxhash64("fp"), F.coalesce(tiles_of[F.col("pop")], F.lit(1))).cast("int")
    tiles = counted.select("fp", "pop", number.alias("no")).groupBy("pop", "no").agg(F.collect_list("fp").alias("fps"))
    tiles = materialise(tiles)

    def partners(d: int) -> Column:
        """The partner tiles whose population count is larger by ``d``.

        ``d`` comes from here and not from a default of the lambda, where
        Spark would put the element's position.
        """
        n = F.coalesce(tiles_of[F.col("pop") + d], F.lit(0))
        first = F.col("no") if d == 0 else F.lit(0)
        numbers = F.when(n > first, F.sequence(first, n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda j: F.struct((F.col("pop") + d).alias("pop2"), j.alias("no2")))

    # every tile names its partners: later tiles of its own count, all tiles of the next counts
    named = F.flatten(F.array(*[partners(d) for d in range(radius + 1)]))
    asked = tiles.select("pop", "no", F.explode(named).alias("to"), F.col("fps").alias("left")).select("pop", "no", "to.*", "left")
    met = asked.join(
        tiles.select(F.col("pop").alias("pop2"), F.col("no").alias("no2"), F.col("fps").alias("right")), ["pop2", "no2"]
    )

    schema = arrow_schema(StructType.fromDDL(EDGE))

    def run(batches: Batches) -> Batches:
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                left = cols["left"][i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                right = cols["right"][i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                same = (cols["pop"][i].as_py(), cols["no"][i].as_py()) == (cols["pop2"][i].as_py(), cols["no2"][i].as_py())
                u, v = links(left, right, same, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=schema)

    return map_batches(met, run, EDGE)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the smallest key reachable) for each row of ``docs``."""
    prints = materialise(with_fingerprint(docs, text, width, keep=[key]))
    distinct = materialise(prints.groupBy("fp").agg(F.min(key).alias("first")))
    roots = connected_components(link_forest(distinct, radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    return prints.join(classes, "fp")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest key, null keys last.

    Rows with the same key and text count as one document.
    """
    identity = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.xxhash64(utf8(text)).alias("text"))
    marked = docs.withColumn("__id__", identity)
    first = near_duplicates(marked, "__id__", text, width, radius).where(F.col("__id__") == F.col("component_id"))
    kept = marked.join(first.select("__id__").distinct(), "__id__", "left_semi")
    return kept.dropDuplicates(["__id__"]).select(*docs.columns)


def hex64(col: str) -> Column:
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64("fp").alias("fingerprint"), "component_id")
