"""Removal of every byte that a repeated string of ``length`` symbols covers.

A text is a string of symbols: its bytes (``Passage`` BYTES, 400 of them), or
its words (WORDS, 50 of them), each as a 64-bit hash.

1.  Equal texts are merged: one row per distinct text with its number of copies.
2.  Every window of ``length`` symbols picks an anchor: the start, within it, of
    the run of ``gram`` symbols with the smallest hash.  Equal windows pick the
    same place, so a window can only repeat among windows whose anchors hash
    alike.  Anchors that stand alone in the corpus settle their windows as
    unique; if all stretches around equal anchors are equal, their windows are
    repeated.
3.  The remaining stretches meet by anchor.  Cut into pieces counted from the
    anchor they become short strings over piece numbers, and a suffix array
    (linear grouping construction) brings together all places that share the
    whole pieces of a window; the symbols left of each window decide exactly.
4.  An anchor with more than ``group`` places does not go to one task.  Its
    stretches are cut into blocks of BLOCK neighbouring windows by their distance
    to the anchor, and blocks meet by what all their windows have in common:
    equal windows have both alike.  These are small groups again, sorted as in
    3; where even the common part has more than ``group`` surroundings, its few
    windows are counted by hash in a map-side aggregate.
5.  Repeated windows return to their texts, which are cut and hashed.

Windows are judged on the input and never cross texts.  Defined results: null
and empty texts have nothing removed; texts shorter than ``length`` cannot hold
a window; equal rows lose everything from ``length`` symbols on; a text of any
size is read in pieces of SEGMENT symbols; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, materialise, read_table, rows_batch, utf8
from .suffix_array import suffix_array

SEGMENT = 1 << 16
#: Neighbouring windows of a crowded anchor that are compared together.
BLOCK = 16


class Passage(NamedTuple):
    """What repeats: a window's length, an anchor's and a piece's, in symbols of ``unit`` bytes."""

    length: int = 400
    gram: int = 128
    piece: int = 25
    unit: int = 1


BYTES = Passage()
WORDS = Passage(50, 16, 5, 8)

#: ASCII white space
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Texts are cut into words about this many bytes at a time.
FLAT = 1 << 20
ODD = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


_UP, _DOWN = _powers(ODD, 2 * FLAT), _powers(pow(ODD, -1, 1 << 64), 2 * FLAT)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte, and byte behind the last, of each word (maximal run without white space)."""
    space = SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, from sums of its bytes times powers of an odd number."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + FLAT)))
        size = int(ends[to - 1] - first)
        up, down = (_UP, _DOWN) if size <= len(_UP) else (_powers(ODD, size), np.ones(1, np.uint64))
        part = np.frombuffer(data, np.uint8, size, int(first)).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * up[:size])])
        own = starts[at:to] - first
        out[at:to] = (sums[ends[at:to] - first] - sums[own]) * down[own]
        at = to
    out ^= out >> np.uint64(32)
    out *= np.uint64(ODD)
    out ^= out >> np.uint64(29)
    return out


def symbols(texts: list[bytes], unit: int) -> list[bytes]:
    """The texts as packed symbols of ``unit`` bytes: as they are, or a hash for each word."""
    if unit == 1:
        return texts
    out: list[bytes] = []
    held, size = [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t) + 1
        if size >= FLAT or i == len(texts) - 1:
            flat = b" ".join(held)
            starts, ends = word_spans(flat)
            packed = word_hashes(flat, starts, ends).tobytes()
            cuts = np.searchsorted(starts, np.cumsum([0, *[len(x) + 1 for x in held]])).tolist()
            out += [packed[8 * a : 8 * b] for a, b in zip(cuts, cuts[1:])]
            held, size = [], 0
    return out


#: odd multipliers of the doubling hash
MIX = [np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * i & 0xFFFFFFFFFFFFFFFF | 1) for i in range(9)]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` (a power of two) bytes that start at each position."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MIX[7]
    h ^= h >> np.uint64(29)
    size = 1
    for step in range(gram.bit_length() - 1):
        h = h[:-size] * MIX[step] + (h[size:] ^ (h[size:] >> np.uint64(31)))
        size *= 2
    h *= MIX[8]
    h ^= h >> np.uint64(32)
    return h


def chosen_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the index of the smallest, the last of equals."""
    n = len(hashes)
    bits = np.uint64(22)
    low = np.uint64((1 << 22) - 1)
    key = (hashes >> bits << bits) | (low - np.arange(n, dtype=np.uint64))
    pad = -n % width
    grid = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(back[: n - width + 1], ahead[width - 1 : n])
    return (low - (best & low)).astype(np.int64)


def anchor_runs(texts: list[bytes], rule: Passage) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, anchor, first window, last window, anchor hash), counted in symbols, for each run of
    windows with one anchor; texts are hashed together, SEGMENT symbols at a time, so that the arrays stay in cache."""
    length, gram, _, unit = rule
    width = length - gram + 1
    block: list[tuple[int, int, bytes]] = []
    held = 0

    def flush():
        data = np.frombuffer(b"".join(p for _, _, p in block), np.uint8 if unit == 1 else np.uint64)
        hashes = gram_hashes(data, gram)
        pick = chosen_anchors(hashes, width)
        owner_start = np.cumsum([0, *[len(p) // unit for _, _, p in block]])
        piece_of = np.full(len(pick), -1, np.int64)
        for k, s in enumerate(owner_start[:-1]):
            e = min(owner_start[k + 1] - length + 1, len(pick))
            if e > s:
                piece_of[s:e] = k
        change = np.flatnonzero(np.r_[True, (pick[1:] != pick[:-1]) | (piece_of[1:] != piece_of[:-1])])
        ends = np.r_[change[1:], len(pick)] - 1
        ok = piece_of[change] >= 0
        change, ends = change[ok], ends[ok]
        k = piece_of[change]
        shift = np.array([s for _, s, _ in block])[k] - owner_start[:-1][k]
        number = np.array([i for i, _, _ in block])[k]
        a = pick[change]
        return zip(
            number.tolist(), (a + shift).tolist(), (change + shift).tolist(), (ends + shift).tolist(),
            hashes[a].view(np.int64).tolist(),
        )

    for i, text in enumerate(texts):
        for s in range(0, len(text) // unit - length + 1, SEGMENT):
            part = text[s * unit : (s + SEGMENT + length - 1) * unit]
            if block and held + len(part) // unit > SEGMENT:
                yield from flush()
                block, held = [], 0
            block.append((i, s, part))
            held += len(part) // unit
    if block:
        yield from flush()


def stretch_id(stretch: bytes, offset: int) -> int:
    """Signed 64-bit digest of a stretch and its anchor's place; only compared between equal anchors."""
    x = xxhash.xxh3_64_intdigest(stretch, offset)
    return x - (1 << 64) if x >> 63 else x


MANY = object()


def repeated_windows(
    stretches: list[tuple[bytes, int, bool, object]], rule: Passage = BYTES, groups: list[int] | None = None
) -> list[list[int]]:
    """For each (packed symbols, anchor offset, many, owner) the starts of its windows that occur with two owners.

    Windows are compared within a group of ``groups`` (default: all are one).
    ``many`` says that the stretch itself has two; an owner None stands for
    one of its own at every place.  The suffix array of the stretches' pieces
    brings together the places that share all whole pieces of a window; the
    symbols at the window's two ends are then compared.
    """
    core, unit = rule.length // rule.piece - 1, rule.unit
    length, piece = rule.length * unit, rule.piece * unit
    number: dict[bytes, int] = {}
    text: list[int] = []
    where: list[tuple[int, int]] = []  # (stretch, byte) of each symbol
    for k, (data, offset, _, _) in enumerate(stretches):
        for at in range(offset * unit % piece, len(data) - piece + 1, piece):
            text.append(number.setdefault(data[at : at + piece], len(number) + 2))
            where.append((k, at))
        text.append(1)
        where.append((k, -1))
    text.append(0)
    found: list[list[int]] = [[] for _ in stretches]
    if len(text) <= core:
        return found
    symbols = np.array(text)
    order = np.array(suffix_array(text))
    blocks = np.lib.stride_tricks.sliding_window_view(symbols, core)
    whole = np.zeros(len(text), bool)
    whole[: len(blocks)] = (blocks > 1).all(axis=1)
    order = order[whole[order]]
    if not len(order):
        return found
    same = (blocks[order[1:]] == blocks[order[:-1]]).all(axis=1)
    for run in np.split(order, np.flatnonzero(~same) + 1):
        if len(run) < 2 and not stretches[where[run[0]][0]][2]:
            continue
        seen: dict[tuple[int, bytes, bytes], object] = {}
        windows = []
        for s in run.tolist():
            k, at = where[s]
            data, _, many, owner = stretches[k]
            for p in range(max(0, at - piece + unit), min(at, len(data) - length) + 1, unit):
                edge = (groups[k] if groups else 0, data[p:at], data[at + core * piece : p + length])
                own = MANY if many else (k, p) if owner is None else owner
                if seen.setdefault(edge, own) != own:
                    seen[edge] = MANY
                windows.append((k, p, edge))
        for k, p, edge in windows:
            if seen[edge] is MANY:
                found[k].append(p // unit)
    return found


def as_runs(starts: list[int]) -> tuple[list[int], list[int]]:
    """First and last values of the runs of consecutive numbers."""
    x = np.unique(np.array(starts, np.int64))
    if not len(x):
        return [], []
    cut = np.flatnonzero(np.diff(x) > 1)
    return x[np.r_[0, cut + 1]].tolist(), x[np.r_[cut, len(x) - 1]].tolist()


def _map(df: DataFrame, fn, ddl: str) -> DataFrame:
    """``fn`` yields rows (tuples) for a batch given as lists of columns."""
    kind = StructType.fromDDL(ddl)
    schema = arrow_schema(kind)

    def run(batches: Batches) -> Batches:
        for b in batches:
            rows: list[tuple] = []
            size = 0
            for row in fn(*[c.to_pylist() for c in b.columns]):
                rows.append(row)
                size += 64 + sum(len(x) for x in row if isinstance(x, (bytes, list)))
                if size > 8 << 20:
                    yield rows_batch(rows, schema)
                    rows, size = [], 0
            if rows:
                yield rows_batch(rows, schema)

    return map_batches(df, run, kind)


def text_key(data: Column) -> Column:
    """128 bits of SHA-256: the identity of a text."""
    return F.substring(F.unhex(F.sha2(data, 256)), 1, 16)


def distinct_texts(docs: DataFrame, text: str) -> str:
    """Name of a new table (tkey, data), one row per distinct text, bucketed by tkey.

    Later joins on tkey find the long texts already in place; only light lists move.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_texts_{uuid.uuid4().hex}"
    data = docs.select(utf8(text).alias("data")).select(text_key(F.col("data")).alias("tkey"), "data")
    data.groupBy("tkey").agg(F.first("data").alias("data")).write.bucketBy(n, "tkey").format("parquet").saveAsTable(name)
    return name


def core_blocks(data: bytes, offset: int, rule: Passage) -> Iterator[tuple[int, int, int, bytes]]:
    """(block, first window, its place before the common part, symbols) for the blocks of windows of a stretch.

    A block holds the windows that begin 16 b to 16 b + 15 symbols (BLOCK)
    before the anchor at ``offset``.  All of them hold the symbols from the
    last one's start to the first one's end.
    """
    length, unit = rule.length, rule.unit
    last = len(data) // unit - length
    for b in range((offset - last) // BLOCK if offset > last else 0, offset // BLOCK + 1):
        end = offset - b * BLOCK
        p, q = max(0, end - BLOCK + 1), min(last, end)
        if p <= q:
            yield b, p, end - p, data[p * unit : (q + length) * unit]


def block_key(h: int, block: int, part: bytes, before: int, rule: Passage) -> int:
    """Signed 64-bit key of the anchor, the block and what its windows have in common."""
    common = part[before * rule.unit : (before + rule.length - BLOCK + 1) * rule.unit]
    x = xxhash.xxh3_64_intdigest(common, (h + block * ODD) % (1 << 64))
    return x - (1 << 64) if x >> 63 else x


def repeated_runs(texts: DataFrame, rule: Passage = BYTES, group: int = 256, across: bool = False) -> DataFrame:
    """tkey, starts, ends: runs of window starts (in symbols) that occur at least twice among the distinct ``texts``.

    ``texts`` has tkey, data and scope (long): windows are compared within a
    scope.  ``across``: the two occurrences must be in different texts.
    """
    spark = texts.sparkSession
    length, _, _, unit = rule
    many = (F.min("tkey") != F.max("tkey")) if across else (F.count(F.lit(1)) > 1)
    again = (F.min("owner") != F.max("owner")) if across else (F.count(F.lit(1)) > 1)

    def grams(keys, texts, scopes):
        data = symbols(texts, unit)
        at, last_text = 0, -1
        for i, a, first, last, h in anchor_runs(data, rule):
            at, last_text = (at + 1, last_text) if i == last_text else (0, i)
            yield h ^ scopes[i], stretch_id(data[i][first * unit : (last + length) * unit], a - first), keys[i], at

    def stretches(keys, texts, scopes, marks):
        data = symbols(texts, unit)
        status = [{m["i"]: (m["mixed"], m["hot"]) for m in row} for row in marks]
        at, last_text = 0, -1
        sure: dict[int, list[list[int]]] = {}
        for i, a, first, last, h in anchor_runs(data, rule):
            at, last_text = (at + 1, last_text) if i == last_text else (0, i)
            mark = status[i].get(at)
            if mark is None:
                continue
            if not mark[0]:
                runs = sure.setdefault(i, [])
                if runs and runs[-1][1] + 1 == first:
                    runs[-1][1] = last
                else:
                    runs.append([first, last])
                continue
            part = data[i][first * unit : (last + length) * unit]
            yield keys[i], [first], None, h ^ scopes[i], stretch_id(part, a - first), a - first, part, mark[1]
        for i, runs in sure.items():
            yield keys[i], [s for s, _ in runs], [e for _, e in runs], None, None, None, None, None

    name = f"llm_anchors_{uuid.uuid4().hex}"
    try:
        found = _map(texts.select("tkey", "data", "scope"), grams, "h long, sid long, tkey binary, i int")
        found.write.format("parquet").saveAsTable(name)
        anchors = spark.table(name)
        shared = materialise(
            anchors.groupBy("h")
            .agg(F.count(F.lit(1)).alias("n"), (F.min("sid") != F.max("sid")).alias("mixed"), many.alias("many"))
            .where("many")
            .select("h", "mixed", (F.col("n") > group).alias("hot"))
        )
        listed = anchors.select("h", "tkey", "i").join(shared, "h").groupBy("tkey")
        listed = listed.agg(F.collect_list(F.struct("i", "mixed", "hot")).alias("marks"))
        marked = materialise(
            _map(
                texts.join(listed, "tkey").select("tkey", "data", "scope", "marks"),
                stretches,
                "tkey binary, starts array<long>, ends array<long>, h long, sid long, off int, piece binary, hot boolean",
            )
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sure = marked.where(F.col("h").isNull()).select("tkey", "starts", "ends")
    open_ = marked.where(F.col("h").isNotNull())
    distinct = open_.groupBy("h", "sid").agg(
        many.alias("many"),
        F.min("tkey").alias("owner"),
        F.first(F.struct("off", "piece")).alias("x"),
        F.first("hot").alias("hot"),
    )
    owner = F.col("owner") if across else F.lit(None).cast("binary")
    distinct = materialise(distinct.select("h", "sid", "many", owner.alias("owner"), "x.off", "x.piece", "hot"))

    # stretches of crowded anchors as blocks of windows, which meet by their common part
    def blocks(hs, sids, manys, owners, offs, data):
        for h, sid, m, own, off, d in zip(hs, sids, manys, owners, offs, data):
            for b, p, before, part in core_blocks(d, off, rule):
                yield h, sid, p, block_key(h, b, part, before, rule), stretch_id(part, before), m, own, before, part

    form = "h long, sid long, at long, bh long, bsid long, many boolean, owner binary, off int, piece binary"
    crowd = materialise(_map(distinct.where("hot").select("h", "sid", "many", "owner", "off", "piece"), blocks, form))
    parts = crowd.groupBy("bh", "bsid").agg((F.max("many") | again).alias("many"), F.min("owner").alias("owner"), F.first(F.struct("off", "piece")).alias("x"))
    kinds = crowd.select("bh", "bsid").distinct().groupBy("bh").agg((F.count(F.lit(1)) > group).alias("hot"))
    parts = materialise(parts.join(kinds, "bh").select(F.col("bh").alias("h"), F.col("bsid").alias("sid"), "many", "owner", "x.off", "x.piece", "hot"))

    kind = StructType.fromDDL("h long, sid long, rs array<long>, re array<long>")
    schema = arrow_schema(kind)

    def sort_groups(batches: Batches) -> Batches:
        """Rows come in the order of h; whole groups are sorted some thousand stretches at a time, but compared by h, which tells scopes apart."""
        rows: list[tuple] = []

        def settle(part: list[tuple]) -> pa.RecordBatch:
            found = repeated_windows([(data, off, many, own) for _, _, many, own, off, data in part], rule, [r[0] for r in part])
            runs = [as_runs(x) for x in found]
            return rows_batch([(r[0], r[1], s, e) for r, (s, e) in zip(part, runs) if s], schema)

        for b in batches:
            rows += zip(*[c.to_pylist() for c in b.columns])
            if len(rows) >= 4000:
                cut_at = len(rows)
                while cut_at > 0 and rows[cut_at - 1][0] == rows[-1][0]:
                    cut_at -= 1
                if cut_at:
                    part, rows = rows[:cut_at], rows[cut_at:]
                    yield settle(part)
        if rows:
            yield settle(rows)

    columns = ["h", "sid", "many", "owner", "off", "piece"]
    few = distinct.where(~F.col("hot")).select(columns), parts.where(~F.col("hot")).select(columns)
    by_order, blocks_by_order = (map_batches(x.repartition("h").sortWithinPartitions("h", "sid"), sort_groups, kind) for x in few)

    def windows(hs, sids, manys, owners, data):
        for h, sid, m, own, d in zip(hs, sids, manys, owners, data):
            for p in range(len(d) // unit - length + 1):
                yield xxhash.xxh3_128_digest(d[p * unit : (p + length) * unit] + h.to_bytes(8, "little", signed=True)), h, sid, p, m, own

    form = "w binary, h long, sid long, p long, many boolean, owner binary"
    listed_windows = _map(parts.where("hot").select("h", "sid", "many", "owner", "piece"), windows, form)
    twice = listed_windows.groupBy("w").agg((F.max("many") | again).alias("twice")).where("twice").select("w")
    by_count = listed_windows.join(twice, "w").groupBy("h", "sid").agg(F.collect_set("p").alias("rs")).select("h", "sid", "rs", F.col("rs").alias("re"))
    settled = blocks_by_order.union(by_count).withColumnsRenamed({"h": "bh", "sid": "bsid"})

    def moved(by: Column) -> list[Column]:
        return [F.transform(c, lambda x: x + by).alias(c) for c in ("rs", "re")]

    by_block = crowd.select("h", "sid", "at", "bh", "bsid").join(settled, ["bh", "bsid"]).select("h", "sid", *moved(F.col("at")))
    found = by_order.union(by_block)
    placed = open_.select("tkey", "h", "sid", F.col("starts")[0].alias("first")).join(found, ["h", "sid"])
    return sure.union(placed.select("tkey", *moved(F.col("first"))).withColumnsRenamed({"rs": "starts", "re": "ends"}))


def cut(data: bytes, starts: list[int], ends: list[int]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, remaining bytes) for byte ranges in any order."""
    kept, at, removed, spans = [], 0, 0, 0
    for s, e in sorted(zip(starts, ends)):
        if s > at or not spans:
            kept.append(data[at:s])
            spans += 1
            at = s
        if e > at:
            removed += e - at
            at = e
    kept.append(data[at:])
    return removed, spans, b"".join(kept)


def covered(data: bytes, copied: bool | None, starts: list[int] | None, ends: list[int] | None, rule: Passage) -> tuple[list[int], list[int]]:
    """Byte ranges that runs of repeated windows cover; all windows of a copied text are repeated."""
    if rule.unit == 1:
        if copied and len(data) >= rule.length:
            return [0], [len(data)]
        return starts or [], [e + rule.length for e in ends or []]
    if not (copied or starts):
        return [], []
    first, behind = word_spans(data)
    if copied and len(first) >= rule.length:
        return [int(first[0])], [int(behind[-1])]
    return first[starts or []].tolist(), behind[np.array(ends or [], int) + rule.length - 1].tolist()


RESULT = "tkey binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, n_also long"


def cut_texts(
    docs: DataFrame, text: str = "text", rule: Passage = BYTES, group: int = 256, with_text: bool = False, also: Passage | None = None
) -> DataFrame:
    """RESULT for each distinct text of ``docs``, written to the shared folder.

    ``kept`` (null unless ``with_text``) is the remaining text; a character of
    which a part was removed is left out of it.  ``n_also``: bytes that a second
    kind of repeated passage covers (null without one), which stay.
    """
    spark = docs.sparkSession
    name = distinct_texts(docs, text)
    try:
        texts = spark.table(name).withColumn("scope", F.lit(0).cast("long"))
        copies = docs.select(text_key(utf8(text)).alias("tkey")).groupBy("tkey").agg((F.count(F.lit(1)) > 1).alias("copied"))
        sides = copies.where("copied")
        for kind, s, e in ((rule, "starts", "ends"), (also, "starts2", "ends2")):
            if kind is None:
                sides = sides.withColumns({c: F.lit(None).cast("array<long>") for c in (s, e)})
                continue
            lists = repeated_runs(texts, kind, group).groupBy("tkey").agg(
                F.flatten(F.collect_list("starts")).alias(s), F.flatten(F.collect_list("ends")).alias(e)
            )
            sides = sides.join(lists, "tkey", "full")

        def remove(keys, data, copied, starts, ends, starts2, ends2):
            for k, d, c, s, e, s2, e2 in zip(keys, data, copied, starts, ends, starts2, ends2):
                removed, spans, kept = cut(d, *covered(d, c, s, e, rule))
                more = cut(d, *covered(d, c, s2, e2, also))[0] if also else None
                yield k, len(d), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None, more

        joined = spark.table(name).join(sides, "tkey", "left")
        return materialise(_map(joined.select("tkey", "data", "copied", "starts", "ends", "starts2", "ends2"), remove, RESULT))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def suffix_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Passage = BYTES, group: int = 256, also: Passage | None = None
) -> DataFrame:
    """``key``, n_bytes, n_removed, n_spans, kept_sha256, n_also for each row of ``docs``."""
    found = cut_texts(docs, text, rule, group, also=also).drop("kept")
    return docs.select(key, text_key(utf8(text)).alias("tkey")).join(found, "tkey").drop("tkey")


def remove_repeats(docs: DataFrame, text: str = "text", rule: Passage = BYTES) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; all other columns and rows stay (null text: empty)."""
    found = cut_texts(docs, text, rule, with_text=True).select("tkey", F.col("kept").alias("__kept__"))
    rest = docs.withColumn("tkey", text_key(utf8(text))).drop(text)
    return rest.join(found, "tkey").select(*[F.col("__kept__").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and n_passage_bytes: its bytes in
    passages of at least 50 words that also stand elsewhere, however few bytes they have."""
    found = suffix_dedup(read_table(spark, sf_dir, "documents"), also=WORDS)
    return found.withColumnRenamed("n_also", "n_passage_bytes")
