"""Training-order materialisation of token sequences.

Texts are cut into sequences of a fixed number of ids.  A sequence's number
(its place in the encoded table) goes through a keyed Feistel permutation
of the smallest even-bit domain, walked on while the value is not below the
number of sequences; the result is its global slot, a bijection that anyone
with key and count can recompute.  Slots are dealt to shards of equal slot
ranges, one task each, and every shard is a file of fixed-stride records, so
slot s stands in shard s // shard_slots at byte (s % shard_slots) * stride and
training reads forward from any slot.

A record is the key, the start and the number of real ids (little-endian int64,
int64, int32), the ids (unsigned 16-bit, or 32-bit for vocabularies above
65,536; unused ones 0) and a line feed.

Texts are encoded once, into a table of packed ids; its lengths give the count,
its records travel to their shards without padding, and it goes when the shards
are written.  The shards are written in two equal waves, each from its own read
of the table, so that only half of the records are in shuffle files at a
time (Spark removes those at the end of each wave).  Defined results: null and empty texts have no
sequence; null keys are stored as the smallest int64 and read back as null;
repeated rows get slots of their own; an empty table writes nothing.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, read_table, rows_batch, shared_dir, utf8
from .tokens import ByteLevelIds, shared

NO_KEY = -(1 << 63)
ROUNDS = 6
WAVES = 2

#: Whether Spark removes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def feistel_slots(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The permutation of 0..n-1 chosen by ``key``, at ``numbers``."""
    half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.SeedSequence(key).generate_state(ROUNDS, np.uint64)
    out = numbers.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        x = out[walk]
        left, right = x >> half, x & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask)
        out[walk] = left << half | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def record_type(length: int, wide: bool) -> np.dtype:
    return np.dtype([("key", "<i8"), ("start", "<i8"), ("n", "<i4"), ("ids", "<u4" if wide else "<u2", (length,)), ("end", "u1")])


def as_binary(rows: np.ndarray) -> pa.Array:
    """The rows of a contiguous array as binary values."""
    size = rows.nbytes // max(1, len(rows))
    offsets = np.arange(0, (len(rows) + 1) * size, size, dtype=np.int32)[: len(rows) + 1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


class Layout:
    """Where the slots of a written order stand."""

    def __init__(self, path: str, n: int, length: int, wide: bool, shard_slots: int, key: int):
        self.path, self.n, self.length, self.wide, self.shard_slots, self.key = path, n, length, wide, shard_slots, key
        self.stride = record_type(length, wide).itemsize
        self.shards = -(-n // shard_slots)


def encode(docs: DataFrame, path: str, key: str, text: str, length: int, wide: bool, name: str) -> DataFrame:
    """Write the table ``name``: part, first, key, n, ids for each document, encoded once.

    ``first`` counts the sequences of ``n`` before it that the task ``part`` made.
    """
    kind = StructType.fromDDL("part int, first long, key long, n long, ids binary")
    schema = arrow_schema(kind)
    form = "<u4" if wide else "<u2"

    def run(batches: Batches) -> Batches:
        encoder = shared(ByteLevelIds, path)
        at = 0
        for b in batches:
            rows, held = [], 0
            for part, k, t in zip(*[c.to_pylist() for c in b.columns]):
                ids = np.frombuffer(encoder.ids(t.decode("utf-8", "replace")), "<u4").astype(form).tobytes()
                n = -(-len(ids) // (length * int(form[2])))
                rows.append((part, at, k, n, ids))
                at += n
                held += len(ids)
                if held > 4 << 20:
                    yield rows_batch(rows, schema)
                    rows, held = [], 0
            yield rows_batch(rows, schema)

    source = docs.select(F.spark_partition_id().alias("part"), F.col(f"`{key}`").cast("long").alias("key"), utf8(text).alias("data"))
    map_batches(source, run, kind).write.format("parquet").option("compression", "zstd").saveAsTable(name)
    return docs.sparkSession.table(name)


def write_order(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = 256, shard_slots: int = 1 << 15, seed: int = 20
) -> Layout:
    """Write all sequences of ``docs`` in training order to a new shared folder.

    Texts are encoded once, into a table that goes when the shards are
    written.  The driver sees one count for each partition of the scan.
    """
    spark = docs.sparkSession
    wide = shared(ByteLevelIds, path).tokenizer.get_vocab_size() > 1 << 16
    name = f"llm_ids_{uuid.uuid4().hex}"
    try:
        encoded = encode(docs, path, key, text, length, wide, name)
        base, total = {}, 0
        for part, n in sorted(tuple(r) for r in encoded.groupBy("part").agg(F.sum("n")).collect()):
            base[part] = total
            total += n
        layout = Layout(shared_dir(spark), total, length, wide, shard_slots, seed)
        if total:
            write_shards(encoded, layout, base)
        return layout
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_shards(encoded: DataFrame, layout: Layout, base: dict[int, int]) -> None:
    """One file for each run of slots, wave after wave."""
    spark = encoded.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        edges = [layout.shards * k // WAVES * layout.shard_slots for k in range(WAVES + 1)]
        for low, high in zip(edges, edges[1:]):
            if low < high:
                write_wave(encoded, layout, base, low, high)
    finally:
        spark.conf.set(CLEANUP, before)


def write_wave(encoded: DataFrame, layout: Layout, base: dict[int, int], low: int, high: int) -> None:
    """The shards of the slots from ``low`` to before ``high``; records travel without their padding.

    A shard's number is its partition's, so that files are named alike in every
    wave; partitions of other waves are empty and write nothing.
    """
    length, total, seed = layout.length, layout.n, layout.key
    known = encoded.sparkSession.sparkContext.broadcast(base)
    form = record_type(length, layout.wide)
    head = form.fields["ids"][1]
    size = form["ids"].base.itemsize
    kind = StructType.fromDDL("slot long, record binary")
    schema = arrow_schema(kind)

    def records(batches: Batches) -> Batches:
        base = known.value
        for b in batches:
            blocks, places, held = [], [], 0
            docs = [x for x in zip(*[c.to_pylist() for c in b.columns]) if x[3]]
            if not docs:
                continue
            numbers = np.concatenate([np.arange(base[part] + first, base[part] + first + n) for part, first, _, n, _ in docs])
            slots = feistel_slots(numbers, total, seed)
            here = (slots >= low) & (slots < high)
            at = 0
            for _, _, k, n, ids in docs:
                mine = here[at : at + n]
                if mine.any():
                    blocks.append(filled(NO_KEY if k is None else k, np.frombuffer(ids, form["ids"].base))[mine])
                    places.append(slots[at : at + n][mine])
                    held += len(places[-1])
                at += n
                if held >= 8192:
                    yield slotted(np.concatenate(places), np.concatenate(blocks))
                    blocks, places, held = [], [], 0
            if held:
                yield slotted(np.concatenate(places), np.concatenate(blocks))

    def filled(key: int, ids: np.ndarray) -> np.ndarray:
        """A document's records."""
        n = -(-len(ids) // length)
        out = np.zeros(n, form)
        grid = np.zeros(n * length, form["ids"].base)
        grid[: len(ids)] = ids
        out["key"], out["ids"] = key, grid.reshape(n, length)
        out["start"] = np.arange(0, n * length, length)
        out["n"] = np.minimum(len(ids) - out["start"], length)
        return out

    def slotted(places: np.ndarray, out: np.ndarray) -> pa.RecordBatch:
        sizes = head + out["n"].astype(np.int64) * size
        whole = out.view(np.uint8).reshape(len(out), form.itemsize)
        real = whole[np.arange(form.itemsize) < sizes[:, None]]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(real.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(places), packed], schema=schema)

    rows = map_batches(encoded.select("part", "first", "key", "n", "ids"), records, kind)
    shard = F.floor(F.col("slot") / layout.shard_slots).cast("int")
    shards = rows.repartitionById(layout.shards, shard).sortWithinPartitions("slot")
    # the text writer copies bytes as they are and ends each row with the record's last byte, a line feed
    body = F.rpad("record", layout.stride - 1, F.lit(b"\0")).cast("string")
    shards.select(body.alias("value")).write.mode("append").option("lineSep", "\n").text(layout.path)


def read_order(spark: SparkSession, layout: Layout, first_slot: int = 0) -> DataFrame:
    """slot, shard, offset_bytes, key, start, n, ids (packed, real ones only) from ``first_slot`` on.

    Shards before it are not opened.
    """
    kind = StructType.fromDDL("slot long, shard int, offset_bytes long, key long, start long, n int, ids binary")
    schema = arrow_schema(kind)
    if not layout.n:
        return spark.createDataFrame([], kind)
    form, slots = record_type(layout.length, layout.wide), layout.shard_slots

    def run(batches: Batches) -> Batches:
        for b in batches:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1)):
                data = np.frombuffer(content.as_buffer(), form)
                for at in range(max(0, first_slot - shard * slots), len(data), 8192):
                    x = data[at : at + 8192]
                    place = np.arange(at, at + len(x))
                    columns = [
                        pa.array(shard * slots + place),
                        pa.array(np.full(len(x), shard, np.int32)),
                        pa.array(place * form.itemsize),
                        pa.array(x["key"], mask=x["key"] == NO_KEY),
                        pa.array(x["start"]),
                        pa.array(x["n"]),
                        as_binary(np.ascontiguousarray(x["ids"])),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    shard = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    files = spark.read.format("binaryFile").load(layout.path).select(shard.alias("shard"), "content")
    found = map_batches(files.where(F.col("shard") >= first_slot // slots), run, kind)
    real = F.substring(F.col("ids"), F.lit(1), F.col("n") * form["ids"].base.itemsize)  # without the padding
    return found.withColumn("ids", real)


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slot, shard, offset_bytes, doc_id, start, n_ids, ids_crc32 of every record, as read back from the shards."""
    import public_tokenizers

    layout = write_order(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_order(spark, layout).select(
        "slot", "shard", "offset_bytes", F.col("key").alias("doc_id"), "start", F.col("n").alias("n_ids"), F.crc32("ids").alias("ids_crc32")
    )
