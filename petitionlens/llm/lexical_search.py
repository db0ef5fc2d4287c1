"""Ranked lexical search of many items at once by dense blocked matrix products.

1.  Items are taken in blocks of bounded terms.  A scan of all documents keeps,
    for each, its number of terms and the counts of those that an item of the
    block holds; document frequencies, N and L follow from this small table.
2.  Every task multiplies tiles: a block's compact vocabulary is cut into tiles
    of terms; the weights of the items over a tile times the impacts of a tile
    of documents gives partial scores.  Weights and impacts are whole numbers
    in float64.  A product is below 10^6 * w, and a tile holds so few terms that
    a partial sum stays below 2^53, hence exact in any order of addition;
    tiles are added up in 64-bit integers.
3.  Each task keeps the best rows of each item: all that reach the worst kept
    score go on, and the smaller id wins among equals, so a cut never decides
    by chance.  The tasks' lists meet in two rounds by item.

Defined results: null texts have no term and take no part in N; items without
a term, or with none that a document holds, give no row; rows that share an
item_id are one item, with the terms of all of them; documents that share a
doc_id are ranked each; a null doc_id comes after all others of its score;
empty tables give empty results; texts are read whole; other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Batches, arrow_schema, map_batches, materialise, read_table, rows_batch, utf8

#: Bytes of terms are kept, A-Z lower-cased; all other ASCII separates.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
TOP_IMPACT = 1_000_000  # above (10^9 tf) div (1000 tf + 20 m)
NO_ID = np.iinfo(np.int64).max


def terms(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Block:
    """Some items and their vocabulary."""

    def __init__(self, items: list[tuple[object, set[bytes]]]):
        self.ids = [i for i, _ in items]
        words = sorted(set().union(*[w for _, w in items]))
        self.number = {w: k for k, w in enumerate(words)}
        self.terms = [np.array(sorted(self.number[w] for w in own), np.int32) for _, own in items]
        self.size = len(words)

    def weights(self, w: np.ndarray) -> np.ndarray:
        """Items by terms."""
        out = np.zeros((len(self.ids), self.size))
        for row, own in zip(out, self.terms):
            row[own] = w[own]
        return out


def item_blocks(items: DataFrame, key: str, text: str, most_cells: int) -> Iterator[Block]:
    """Blocks of at most ``most_cells`` items times terms, or of one item; the driver holds one at a time."""
    held: list[tuple[object, set[bytes]]] = []
    words: set[bytes] = set()
    rows = items.select(F.col(f"`{key}`").alias("id"), utf8(text).alias("data")).orderBy("id", "data")
    for r in rows.toLocalIterator():
        own = set(terms(bytes(r["data"])))
        new = own - words
        if held and held[-1][0] == r["id"]:
            held[-1][1].update(own)
            words |= new
            continue
        if held and (len(held) + 1) * (len(words) + len(new)) > most_cells:
            yield Block(held)
            held, words, new = [], set(), own
        held.append((r["id"], own))
        words |= new
    if held:
        yield Block(held)


def postings(docs: DataFrame, key: str, text: str, number: dict[bytes, int]) -> DataFrame:
    """id, n, terms (packed 32-bit numbers), counts for each document with a term."""
    kind = T.StructType.fromDDL("id long, n long, terms binary, counts binary")
    schema = arrow_schema(kind)
    known = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Batches) -> Batches:
        get = known.value.get
        for b in batches:
            rows = []
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if found := terms(data):
                    own = np.array([x for x in map(get, found) if x is not None], np.int32)
                    own, counts = np.unique(own, return_counts=True)
                    rows.append((i, len(found), own.tobytes(), counts.astype(np.int32).tobytes()))
            yield rows_batch(rows, schema)

    return map_batches(docs.select(F.col(f"`{key}`").cast("long"), utf8(text)), run, kind)


def frequencies(posted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and each term's number of documents; the driver gets one row for each task and term."""
    kind = T.StructType.fromDDL("term int, df long")
    schema = arrow_schema(kind)

    def run(batches: Batches) -> Batches:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], schema=schema)

    n, length = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(size, np.int64)
    for r in map_batches(posted.select("terms"), run, kind).groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return n, length or 0, df


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)  # the score to reach
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.held = 0
        self.more: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """A tile of scores: documents by items."""
        row, item = np.nonzero(scores >= self.floor)
        self.more.append((item, scores[row, item], docs[row]))
        self.held += len(row)
        if self.held > max(4 * self.k * len(self.floor), 1 << 16):
            self.prune()

    def prune(self) -> None:
        parts = [(self.item, self.score, self.doc), *self.more]
        item, score, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, np.arange(len(self.floor)))
        place = np.arange(len(item)) - first[item]
        keep = place < self.k
        last = place == self.k - 1
        self.floor[item[last]] = score[last]
        self.item, self.score, self.doc, self.more, self.held = item[keep], score[keep], doc[keep], [], 0


def impacts(n: np.ndarray, docs: int, length: int, of: np.ndarray, tf: np.ndarray) -> np.ndarray:
    m = 50 + (50 * n * docs) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m[of])


def block_scores(posted: DataFrame, block: Block, k: int, docs_in_tile: int, terms_in_tile: int) -> DataFrame:
    """item (its number in the block), id, score: the best ``k`` of each item in each task."""
    docs, length, df = frequencies(posted, block.size)
    kind = T.StructType.fromDDL("item int, doc_id long, score long, part int")
    schema = arrow_schema(kind)
    w = np.array([weight(docs, int(x)) for x in df], np.float64)
    # a partial sum over a tile stays exact
    tile = max(1, min(terms_in_tile, int(2**53 // (max(1.0, w.max(initial=0)) * TOP_IMPACT)) - 1))
    known = posted.sparkSession.sparkContext.broadcast((block, w))

    def run(batches: Batches) -> Batches:
        own, w = known.value
        q = own.weights(w).T
        tiles = [np.ascontiguousarray(q[s : s + tile]) for s in range(0, own.size, tile)]
        best = Best(len(own.ids), k)
        part = 0
        for b in batches:
            ids = b.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
            ns = b.column(1).to_numpy(zero_copy_only=False)
            if len(ids):
                part = b.column(4)[0].as_py()
            for s in range(0, len(ids), docs_in_tile):
                e = min(s + docs_in_tile, len(ids))
                of_terms = b.column(2)[s:e].to_pylist()
                term = np.frombuffer(b"".join(of_terms), np.int32)
                tf = np.frombuffer(b"".join(b.column(3)[s:e].to_pylist()), np.int32).astype(np.int64)
                doc = np.repeat(np.arange(e - s), [len(x) // 4 for x in of_terms])
                value = impacts(ns[s:e], docs, length, doc, tf)
                scores = np.zeros((e - s, len(own.ids)), np.int64)
                for t, weights in enumerate(tiles):
                    here = (term >= t * tile) & (term < (t + 1) * tile) if len(tiles) > 1 else slice(None)
                    dense = np.zeros((e - s, len(weights)))
                    dense[doc[here], term[here] - t * tile] = value[here]
                    scores += (dense @ weights).astype(np.int64)
                best.add(scores, ids[s:e])
        best.prune()
        arrays = [
            pa.array(best.item.astype(np.int32)), pa.array(best.doc, mask=best.doc == NO_ID), pa.array(best.score),
            pa.array(np.full(len(best.item), part, np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_batches(posted.withColumn("part", F.spark_partition_id()), run, kind)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    most_cells: int = 1 << 23,
    docs_in_tile: int = 256,
    terms_in_tile: int = 4096,
) -> DataFrame:
    """``item_key``, rank, ``key``, score: the ``k`` best documents of each item.

    A block's items times its terms are at most ``most_cells``, which bounds
    what the driver, a broadcast and a worker hold (8 bytes a cell); every
    block scans the documents once.
    """
    spark = docs.sparkSession
    found = None
    item_type = items.schema[item_key].dataType
    kind = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)])
    for block in item_blocks(items, item_key, item_text, most_cells):
        if not block.size:
            continue
        posted = materialise(postings(docs, key, text, block.number))
        best = block_scores(posted, block, k, docs_in_tile, terms_in_tile)
        # tasks first meet in groups, so that no item's last round sees a list of every task
        group = F.floor(F.sqrt(F.col("part"))).cast("int")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        near = best.withColumn("place", F.row_number().over(Window.partitionBy("item", group).orderBy(*order)))
        last = near.where(F.col("place") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        names = spark.createDataFrame(list(enumerate(block.ids)), kind)
        rows = last.where(F.col("rank") <= k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = rows if found is None else found.union(rows)
    if found is None:
        found = spark.createDataFrame([], T.StructType([kind["item_id"], *T.StructType.fromDDL("rank int, doc_id long, score long")]))
    return found.withColumnsRenamed({"item_id": item_key, "doc_id": key} if item_key != key else {})


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 50 best documents of each benchmark item."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11_SQL = f"""
WITH word AS (SELECT row_number() OVER () AS row, doc_id, unnest({_TERMS.format('text')}) AS term FROM documents),
doc AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM word GROUP BY row),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM doc),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
counted AS (SELECT row, term, count(*) AS tf FROM word WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, whole GROUP BY term),
scored AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN doc USING (row), whole
  GROUP BY item_id, row)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""
