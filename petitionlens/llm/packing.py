"""Mixture-controlled packing by deficit round-robin.

Each document becomes one item (a very long one several) in the queue of its
source.  An item's virtual time is its place in its queue divided by the
source's target share, so cutting all queues at one virtual time serves every
source its share up to one item.  The global order by virtual time is cut into
blocks of tokens; what a source is owed at a block's start follows from the
sums of the earlier blocks, so each block runs its round-robin in a task of its
own and the deficits still carry through all windows and blocks.  Inside, every
window adds each source's share to its deficit and takes from the queue with
the largest one; an item is cut only where a window ends.  What is left of a
block after its last full window is cut into sequences of powers of two.

Defined results: null and empty texts are the end token alone; a null source is
a queue of its own; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, materialise, read_table, rows_batch, running_offsets, ship_package, utf8
from .tokens import ByteLevelIds, shared

ITEM = 1 << 16


def token_items(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """rid, key, queue, doc_tokens, start, n, ids (packed): a document's ids and id 0, in items of at most ITEM ids."""
    kind = StructType.fromDDL(f"key {docs.schema[key].dataType.simpleString()}, queue string, doc_tokens long, start long, n long, ids binary")
    schema = arrow_schema(kind)
    end = np.zeros(1, "<u4").tobytes()

    def run(batches: Batches) -> Batches:
        encoder = shared(ByteLevelIds, path)
        for b in batches:
            rows, size = [], 0
            for k, q, t in zip(*[c.to_pylist() for c in b.columns]):
                ids = encoder.ids(t.decode("utf-8", "replace")) + end
                n = len(ids) // 4
                for s in range(0, n, ITEM):
                    part = ids[4 * s : 4 * (s + ITEM)]
                    rows.append((k, q, n, s, len(part) // 4, part))
                    size += len(part)
                if size > 8 << 20:
                    yield rows_batch(rows, schema)
                    rows, size = [], 0
            if rows:
                yield rows_batch(rows, schema)

    queue = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    items = map_batches(docs.select(F.col(key).alias("key"), queue.alias("queue"), utf8(text).alias("data")), run, kind)
    return materialise(items.withColumn("rid", F.monotonically_increasing_id()), "zstd")


def fill_windows(
    owed: np.ndarray, share: np.ndarray, queues: list[list[tuple[int, int]]], window: int
) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(rid, start in item, length, window, offset) of all pieces, and the number of windows begun."""
    heads = [0] * len(queues)
    used = [0] * len(queues)
    active = np.array([bool(q) for q in queues])
    deficit = np.where(active, owed.astype(float), -np.inf)
    add = share * window
    pieces: list[tuple[int, int, int, int, int]] = []
    w = 0
    left = int(active.sum())
    while left:
        deficit += add  # an empty queue stays at -inf
        offset = 0
        while offset < window and left:
            s = int(deficit.argmax())
            rid, n = queues[s][heads[s]]
            take = min(window - offset, n - used[s])
            pieces.append((rid, used[s], take, w, offset))
            offset += take
            deficit[s] -= take
            used[s] += take
            if used[s] == n:
                heads[s] += 1
                used[s] = 0
                if heads[s] == len(queues[s]):
                    deficit[s] = -np.inf
                    left -= 1
        w += 1
    return pieces, w


def split_tail(pieces: list[tuple[int, int, int, int, int]], windows: int, window: int) -> list[tuple[int, int, int, int, int]]:
    """Cut the last, partly filled window into windows of powers of two, largest first."""
    total = sum(p[2] for p in pieces if p[3] == windows - 1)
    if not windows or total == window:
        return pieces
    out = [p for p in pieces if p[3] < windows - 1]
    tail = [p for p in pieces if p[3] == windows - 1]
    bounds, at = [], 0
    for bit in range(total.bit_length() - 1, -1, -1):
        if total >> bit & 1:
            bounds.append((at, at + (1 << bit)))
            at += 1 << bit
    for rid, start, n, w, offset in tail:
        for i, (lo, hi) in enumerate(bounds):
            a, b = max(lo, offset), min(hi, offset + n)
            if a < b:
                out.append((rid, start + a - offset, b - a, w + i, a - lo))
    return out


def targets(spans: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """``spans`` (queue, total) with ``share``: the weight of a named source, else its part of all tokens, scaled to sum 1."""
    grand = spans.agg(F.sum("total")).first()[0] or 1
    part = F.col("total") / F.lit(float(grand))
    if weights:
        named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (f"={k}", float(w))])
        part = F.coalesce(named[F.col("queue")], part)
    whole = spans.agg(F.sum(part)).first()[0] or 1.0
    return spans.withColumn("share", part / F.lit(float(whole)))


PIECE = "rid long, start long, length long, sequence_id long, offset long"


def pack(
    items: DataFrame, window: int = 1024, weights: dict[str, float] | None = None, block: int = 1 << 22, few: int = 100_000
) -> DataFrame:
    """The pieces (PIECE; ``start`` counts from the item's own) of the rows rid, queue, n of ``items``.

    The shares of up to ``few`` sources are broadcast, more are joined.  The driver sees two sums over the sources and one sum per range partition.
    """
    light = items.select("rid", "queue", "n")
    queued = materialise(running_offsets(light, [F.col("queue"), F.col("rid")], "n", "at"))
    spans = queued.groupBy("queue").agg(F.min("at").alias("first"), F.sum("n").alias("total"))
    shares = materialise(targets(spans, weights))
    if shares.limit(few + 1).count() <= few:  # no shuffle on the queue, of which one may hold a third of the rows
        shares = F.broadcast(shares)
    place = (F.col("at") - F.col("first") + F.col("n") / 2) / F.col("share")
    timed = queued.join(shares, "queue").select("rid", "queue", "n", "share", place.alias("time"))
    placed = running_offsets(timed, [F.col("time"), F.col("rid")], "n", "pos")
    placed = materialise(placed.withColumn("block", F.floor(F.col("pos") / block)))
    begun = placed.groupBy("block").agg(F.min("pos").alias("before"))
    sums = placed.groupBy("block", "queue").agg(F.sum("n").alias("own"), F.first("share").alias("share"))
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    served = sums.withColumn("served", F.coalesce(F.sum("own").over(earlier), F.lit(0)))
    owed = served.join(begun, "block").select(
        "block", "queue", (F.col("share") * F.col("before") - F.col("served")).alias("owed")
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["time", "rid"])
        queues = [(q, g) for q, g in pdf.groupby("queue", sort=True)]
        pieces, windows = fill_windows(
            np.array([g["owed"].iloc[0] for _, g in queues]),
            np.array([g["share"].iloc[0] for _, g in queues]),
            [list(zip(g["rid"].tolist(), g["n"].tolist())) for _, g in queues],
            window,
        )
        out = pd.DataFrame(split_tail(pieces, windows, window), columns=["rid", "start", "length", "sequence_id", "offset"])
        out["sequence_id"] += int(pdf["block"].iloc[0]) << 32
        return out

    ship_package(items.sparkSession)
    return placed.join(owed, ["block", "queue"]).groupBy("block").applyInPandas(run, PIECE)


def packed_pieces(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", source: str = "source",
    window: int = 1024, weights: dict[str, float] | None = None,
) -> DataFrame:
    """key, start, length, ids (packed), doc_tokens, sequence_id, offset, padding of every piece.

    ``padding`` is what the piece's sequence is filled up with; sequences are
    full or a power of two, so it is 0.
    """
    items = token_items(docs, path, key, text, source)
    found = pack(items, window, weights)
    lists = found.groupBy("rid").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    kind = StructType.fromDDL(
        f"{key} {docs.schema[key].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    schema = arrow_schema(kind)

    def run(batches: Batches) -> Batches:
        for b in batches:
            rows = []
            for k, total, first, ids, pieces in zip(*[c.to_pylist() for c in b.columns]):
                for p in pieces:
                    s, n = p["start"], p["length"]
                    rows.append((k, first + s, n, ids[4 * s : 4 * (s + n)], total, p["sequence_id"], p["offset"]))
            if rows:
                yield rows_batch(rows, schema)

    joined = items.join(lists, "rid").select("key", "doc_tokens", F.col("start").alias("first"), "ids", "pieces")
    return map_batches(joined, run, kind)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    import public_tokenizers

    found = packed_pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
