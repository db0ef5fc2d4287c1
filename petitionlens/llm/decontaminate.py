"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are the stated query set, cut into parts of at most 64 words and
taken in blocks of about ``block`` parts and ``block_words`` words at most, which
bounds the terms, the basis and the memory of a block whatever the items' lengths.
The terms are the words of a block's items that are rare in the corpus (at
least each item's eight rarest and its keys).  Documents are cut into overlapping
windows of words, of which one holds the whole of any stretch that can count;
windows and items become TF-IDF rows over the terms.  A randomised SVD of all
those rows, summed over Spark tasks, gives the latent space; windows whose
cosine with an item reaches ``cosine`` there are candidates, and so are, by exact
counts, those that hold as many of the item's rarest words (its keys) as any
sufficient subsequence must: leaks that the space does not hold, or that other
items in the window outweigh, are not lost, and blocks change no pair.  Windows
that lack more of the item's terms than a sufficient subsequence could are
dropped.  A candidate counts if some compact stretch of words holds a
subsequence that covers ``overlap`` of the item, and half of the item's answer
(its last sentence, at least three words).

Words are lower-cased (A-Z) runs between white space and ASCII punctuation.
Defined results: null and empty texts and items match nothing; items longer
than 64 words are searched in parts of 64, also in several blocks; repeated
documents are all reported; repeated items count once, and items of equal text
are all found; texts of any length are cut into windows; without items or
documents there are no rows.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, materialise, read_table, rows_batch, utf8
from .suffix_dedup import text_key

PART = 64
#: Rarest words that a window must share with an item to be checked.
KEYS = 4
_TABLE = bytearray(range(256))
for _c in (string.punctuation + string.whitespace).encode():
    _TABLE[_c] = 32
for _c in range(65, 91):
    _TABLE[_c] = _c + 32
TABLE = bytes(_TABLE)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def item_parts(item: bytes) -> list[tuple[list[bytes], int]]:
    """The item's words in parts of at most PART, with the number of answer words at each part's end."""
    words = words_of(item)
    sentences = [s for s in re.split(rb"[.!?\n]+", item) if words_of(s)]
    answer = min(len(words), max(3, len(words_of(sentences[-1])) if sentences else 0), max(3, len(words) // 2))
    n = -(-len(words) // PART)
    size = -(-len(words) // n) if n else 0
    parts = [words[i : i + size] for i in range(0, len(words), size)] if n else []
    return [(p, min(len(p), answer) if i == len(parts) - 1 else 0) for i, p in enumerate(parts)]


def common_subsequence(item: list[bytes], window: list[bytes]) -> tuple[int, int, int]:
    """Length of the longest common subsequence, and the first and last word of ``window`` in the
    shortest stretch, ending earliest, that the recursion finds for it."""
    n = len(window)
    codes = {w: i for i, w in enumerate(dict.fromkeys(item))}
    y = np.array([codes.get(w, -1) for w in window])
    best = np.zeros(n + 1, np.int64)  # length * big + start, so ties prefer the latest start
    big = 1 << 32
    row = np.arange(n + 1, dtype=np.int64)
    for w in item:
        hit = y == codes[w]
        cand = best.copy()
        ext = best[:-1] + big
        fresh = best[:-1] < big
        ext = np.where(fresh, big + row[:-1], ext)
        cand[1:] = np.where(hit, np.maximum(cand[1:], ext), cand[1:])
        best = np.maximum.accumulate(cand)
    top = int(best[-1])
    if top < big:
        return 0, 0, 0
    end = int(np.argmax(best >= (top // big) * big))
    return top // big, int(best[end] % big), end - 1


def prefix_lengths(masks: list[int], n: int) -> list[int]:
    """Length of the longest common subsequence of an item of ``n`` words and each prefix of a text.

    ``masks`` has, for each word of the text, the bits of its places in the item (bit-parallel table).
    """
    full = row = (1 << n) - 1
    out = []
    for m in masks:
        hit = row & m
        if hit:
            row = ((row + hit) | (row - hit)) & full
        out.append(n - row.bit_count())
    return out


def compact(n: int) -> int:
    """Words of the widest stretch that can hold an item of ``n`` words."""
    return int(1.5 * n + 5)


def lcs_check(item: list[bytes], answer: int, window: list[bytes], overlap: float) -> float | None:
    """The largest share of the item's words found in order in a compact stretch that has the answer too.

    Every start in the window is tried with all that follows it compactly, so
    common words far from a passage cannot hide it.  Words that the window
    lacks in any order bound the subsequence and spare most windows its table.
    """
    n, need = len(item), overlap * len(item) - 1e-9
    if (Counter(item) - Counter(window)).total() > (1 - overlap) * n + 1e-9:
        return None
    places: dict[bytes, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    masks = [places.get(w, 0) for w in window]
    top = prefix_lengths(masks, n)[-1]
    if top < need:
        return None
    width, best = compact(n), 0
    known = np.r_[0, np.cumsum([m > 0 for m in masks])]
    for first, m in enumerate(masks):
        most = known[min(first + width, len(masks))] - known[first]
        if not m or most < need or most <= best:
            continue
        lengths = prefix_lengths(masks[first : first + width], n)
        if lengths[-1] < need or lengths[-1] <= best:
            continue
        if answer:
            last = first + lengths.index(lengths[-1])
            found, _, _ = common_subsequence(item[-answer:], window[first : last + 1 + answer])
            if 2 * found < answer:
                continue
        best = lengths[-1]
        if best == top:
            break
    return best / n if best else None


class Terms:
    """Terms of a block of items, their IDF, the items as packed lists of terms, and each term's items (the keys' postings).

    An item's keys are its rarest words, KEYS more of them than ``overlap``
    lets a match lack: every match holds at least KEYS (or, of a short item, all that must be there).
    """

    def __init__(self, parts: list[list[bytes]], df: dict[bytes, int], docs: int, overlap: float, common: float = 0.01):
        chosen: set[bytes] = set()
        keys: list[list[tuple[bytes, int]]] = []
        self.least = np.zeros(len(parts), np.float32)
        for j, p in enumerate(parts):
            count = Counter(p)
            ranked = sorted(count, key=lambda w: (df.get(w, 0), w))
            chosen.update(w for i, w in enumerate(ranked) if i < 8 or df.get(w, 0) <= common * docs)
            spare = int((1 - overlap) * len(p) + 1e-9)
            held = 0
            keys.append([])
            for w in ranked:
                if held >= spare + KEYS:
                    break
                keys[-1].append((w, count[w]))
                held += count[w]
            self.least[j] = held - spare
            chosen.update(w for w, _ in keys[-1])
        self.number = {w: i for i, w in enumerate(sorted(chosen))}
        self.idf = np.log((docs + 1) / (np.array([df.get(w, 0) for w in self.number]) + 1.0)) + 1e-3
        self.items = [np.array([self.number[w] for w in p if w in self.number], "<u4").tobytes() for p in parts]
        posted = np.array([(self.number[w], j, n) for j, own in enumerate(keys) for w, n in own], np.int64)
        posted = posted[np.argsort(posted[:, 0], kind="stable")]
        self.first = np.searchsorted(posted[:, 0], np.arange(len(self.number) + 1))
        self.posted, self.need = posted[:, 1].astype(np.int32), posted[:, 2].astype(np.int32)

    def items_times(self, basis: np.ndarray) -> np.ndarray:
        return np.concatenate([a.times(basis) for _, a in in_chunks(self.items, self.idf)])

    def postings(self) -> Postings:
        return Postings(self.first, self.posted, self.need, self.least)


class Postings(NamedTuple):
    """Items and their counts for each term that is a key of theirs, and how many of its keys each item's match holds."""

    first: np.ndarray
    item: np.ndarray
    count: np.ndarray
    least: np.ndarray

    def hits(self, rows: Rows, n: int) -> np.ndarray:
        """(n rows x items): whether a row of terms holds ``least`` of the item's keys."""
        size = self.first[rows.term + 1] - self.first[rows.term]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.first[rows.term] - (ends - size), size)
        held = np.minimum(self.count[at], np.repeat(rows.count, size))
        pair = np.repeat(rows.row, size) * len(self.least) + self.item[at]
        return np.bincount(pair, held, n * len(self.least)).reshape(n, -1) >= self.least


class Rows:
    """TF-IDF rows of windows given as packed, non-empty lists of term numbers, in sparse form."""

    def __init__(self, lists: list[bytes], idf: np.ndarray):
        n = len(idf)
        row = np.repeat(np.arange(len(lists)), [len(x) // 4 for x in lists])
        pairs, count = np.unique(row * n + np.frombuffer(b"".join(lists), "<u4"), return_counts=True)
        self.terms, self.count = n, count
        self.row, self.term = pairs // n, pairs % n
        self.weight = (np.log1p(count) * idf[self.term]).astype(np.float32)
        self.starts = np.flatnonzero(np.r_[True, self.row[1:] != self.row[:-1]])

    def times(self, basis: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weight[:, None] * basis[self.term], self.starts, axis=0)

    def transposed_times(self, y: np.ndarray) -> np.ndarray:
        order = np.argsort(self.term, kind="stable")
        term = self.term[order]
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        out = np.zeros((self.terms, y.shape[1]))
        out[term[starts]] = np.add.reduceat((self.weight[:, None] * y[self.row])[order], starts, axis=0)
        return out


def in_chunks(lists: list[bytes], idf: np.ndarray, size: int = 2048):
    for at in range(0, len(lists), size):
        yield at, Rows(lists[at : at + size], idf)


def summed(df: DataFrame, fn, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all batches of ``fn(batch columns)``, a matrix of ``shape``.

    Tasks add up their own batches, then stripes of rows meet and are added as
    they stream by; the driver sees the finished stripes only.
    """
    kind = StructType.fromDDL("stripe int, sums binary")
    schema = arrow_schema(kind)
    stripe = max(1, (1 << 18) // (8 * shape[1]))

    def partial(batches: Batches) -> Batches:
        total = None
        for b in batches:
            if b.num_rows:
                x = fn(*[c.to_pylist() for c in b.columns])
                total = x if total is None else total + x
        if total is not None:
            yield rows_batch([(i, total[i : i + stripe].astype("<f8").tobytes()) for i in range(0, shape[0], stripe)], schema)

    def add(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(*[c.to_pylist() for c in b.columns]):
                x = np.frombuffer(x, "<f8")
                sums[i] = sums[i] + x if i in sums else x
        yield rows_batch([(i, x.tobytes()) for i, x in sums.items()], schema)

    parts = map_batches(map_batches(df, partial, kind).repartition("stripe"), add, kind)
    out = np.zeros(shape)
    for r in parts.collect():
        x = np.frombuffer(r["sums"], "<f8").reshape(-1, shape[1])
        out[r["stripe"] : r["stripe"] + len(x)] = x
    return out


def latent_basis(windows: DataFrame, terms: Terms, rank: int, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors (terms x rank) of the windows' and items' TF-IDF rows.

    Randomised range finder with one pass of the Gram matrix, then an exact
    decomposition inside the found range.  Items weigh as much as all windows
    together, so that an item leaked once in a huge corpus keeps its direction.
    """
    n = len(terms.number)
    width = min(n, rank + 8)
    idf = terms.idf
    omega = np.random.default_rng(seed).standard_normal((n, width)).astype(np.float32)

    def sketch(lists):
        return sum(a.transposed_times(a.times(omega)) for _, a in in_chunks(lists, idf))

    def energy(lists):
        return sum(np.array([[float((a.weight.astype(float) ** 2).sum())]]) for _, a in in_chunks(lists, idf))

    lists = windows.select("terms")
    weight = max(1.0, summed(lists, energy, (1, 1))[0, 0] / max(1e-9, float(energy(terms.items)[0, 0])))
    z = summed(lists, sketch, (n, width)) + weight * sketch(terms.items)
    q = np.linalg.qr(z)[0].astype(np.float32)

    def gram(lists):
        out = np.zeros((width, width))
        for _, a in in_chunks(lists, idf):
            b = a.times(q)
            out += b.T @ b
        return out

    values, vectors = np.linalg.eigh(summed(lists, gram, (width, width)) + weight * gram(terms.items))
    return (q @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    rank: int = 256,
    cosine: float = 0.5,
    overlap: float = 0.7,
    block: int = 4096,
    block_words: int = 65_536,
) -> DataFrame:
    """``key``, ``item_key``, cosine, lcs_share: each document and each item found in it (best window).

    ``block`` and ``block_words`` are what a block holds on average at most;
    parts are dealt to blocks by hash, so none holds much more.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_key).alias("id"), utf8(item_text).alias("data")).where(F.length("data") > 0).dropDuplicates()
    parts = materialise(_parts(items))
    held, words = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(-(-held // block), -(-words // block_words))
    source = docs.select(F.col(key).alias("key"), utf8(text).alias("data")).withColumn("tkey", text_key(F.col("data")))
    names = [key, item_key, "cosine", "lcs_share"]
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    inner = StructType.fromDDL(f"key {kinds[0]}, id {kinds[1]}, cosine double, lcs_share double, tkey binary")
    found = spark.createDataFrame([], inner)
    for b in range(blocks):
        number = F.pmod(F.xxhash64("id", "data", "part"), F.lit(blocks))
        own = parts.where(number == b).select("id", "words", "answer").collect()
        of_block = _search(source, own, inner, rank, cosine, overlap)
        if blocks > 1:  # a repeated document's rows are alike: they go on as a number
            of_block = of_block.groupBy("key", "id", "tkey").agg(_best(), F.count(F.lit(1)).alias("copies"))
            of_block = of_block.select("key", "id", "best.cosine", "best.lcs_share", "tkey", "copies")
        found = found.union(of_block) if b else of_block
    if blocks > 1:  # an item's parts may stand in several blocks
        found = found.groupBy("key", "id", "tkey").agg(_best(), F.max("copies").alias("copies"))
        found = found.select("key", "id", "best.cosine", "best.lcs_share", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select("key", "id", "cosine", "lcs_share").toDF(*names)


def _best() -> Column:
    """Of rows of one document and item, that with the largest share, then the largest cosine."""
    return F.max(F.struct("lcs_share", "cosine")).alias("best")


def _parts(items: DataFrame) -> DataFrame:
    """id, data (the item's own hash), part, words, n, answer: the parts of each item."""
    kind = StructType.fromDDL(f"id {items.schema['id'].dataType.simpleString()}, data long, part int, words binary, n int, answer int")
    schema = arrow_schema(kind)

    def cut(batches: Batches) -> Batches:
        for b in batches:
            for key, own, data in zip(*[c.to_pylist() for c in b.columns]):
                rows = [(key, own, i, b" ".join(p), len(p), a) for i, (p, a) in enumerate(item_parts(data))]
                yield rows_batch(rows, schema)

    return map_batches(items.select("id", F.xxhash64("data").alias("own"), "data"), cut, kind)


def _search(source: DataFrame, items: list, kind_out: StructType, rank: int, cosine: float, overlap: float) -> DataFrame:
    """The rows of ``kind_out`` of one block: its parts as (id, words, answer)."""
    spark = source.sparkSession
    parts = [(r["id"], bytes(r["words"]).split(), r["answer"]) for r in items]
    vocabulary = {w for _, p, _ in parts for w in p}
    if not parts:
        return spark.createDataFrame([], kind_out)
    shared_words = spark.sparkContext.broadcast(vocabulary)
    kind = StructType.fromDDL("word binary, n long")
    schema = arrow_schema(kind)

    def frequencies(batches: Batches) -> Batches:
        count: dict[bytes, int] = {}
        docs = 0
        for b in batches:
            for t in b.column(0).to_pylist():
                docs += 1
                for w in shared_words.value.intersection(words_of(t)):
                    count[w] = count.get(w, 0) + 1
        yield rows_batch([(b"", docs), *count.items()], schema)

    df = {bytes(r[0]): r[1] for r in map_batches(source.select("data"), frequencies, kind).groupBy("word").agg(F.sum("n")).collect()}
    terms = Terms([p for _, p, _ in parts], df, df.pop(b"", 0), overlap)
    number = spark.sparkContext.broadcast(terms.number)
    longest = max(len(p) for _, p, _ in parts)
    stride = compact(longest)  # the widest stretch that counts is whole in the window of its first word
    span = 2 * stride
    rows_kind = StructType.fromDDL("tkey binary, first long, terms binary")
    rows_schema = arrow_schema(rows_kind)

    def cut(batches: Batches) -> Batches:
        known = number.value
        for b in batches:
            out = []
            for tkey, data in zip(*[c.to_pylist() for c in b.columns]):
                got = [(i, known[w]) for i, w in enumerate(words_of(data)) if w in known]
                if not got:
                    continue
                at = np.array([i for i, _ in got])
                ids = np.array([k for _, k in got], "<u4")
                starts = np.unique(np.concatenate([at // stride, np.maximum(at // stride - 1, 0)])) * stride
                lo = np.searchsorted(at, starts)
                hi = np.searchsorted(at, starts + span)
                out += [(tkey, int(s), ids[x:y].tobytes()) for s, x, y in zip(starts, lo, hi) if y > x]
            yield rows_batch(out, rows_schema)

    windows = materialise(map_batches(source.select("tkey", "data"), cut, rows_kind), "zstd")
    basis = latent_basis(windows, terms, rank)
    queries = terms.items_times(basis)
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    held = spark.sparkContext.broadcast((basis, queries, terms.idf, terms.postings()))
    shared_parts = spark.sparkContext.broadcast(parts)
    near_kind = StructType.fromDDL("tkey binary, first long, part int, cosine double")
    near_schema = arrow_schema(near_kind)

    def search(batches: Batches) -> Batches:
        """Pairs near in the latent space or sharing enough keys, whose window lacks no more of the item's terms than the overlap allows."""
        base, asked, idf, postings = held.value
        known = number.value
        wanted = [Counter(known[w] for w in p if w in known) for _, p, _ in shared_parts.value]
        spare = [(1 - overlap) * len(p) for _, p, _ in shared_parts.value]
        for b in batches:
            keys, firsts, lists = [c.to_pylist() for c in b.columns]
            for at, rows in in_chunks(lists, idf):
                x = rows.times(base)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
                c = x @ asked.T
                out = []
                for i, j in zip(*[v.tolist() for v in np.nonzero((c >= cosine) | postings.hits(rows, len(c)))]):
                    have = Counter(np.frombuffer(lists[at + i], "<u4").tolist())
                    if (wanted[j] - have).total() <= spare[j] + 1e-9:
                        out.append((keys[at + i], firsts[at + i], j, float(c[i, j])))
                yield rows_batch(out, near_schema)

    near = map_batches(windows.select("tkey", "first", "terms"), search, near_kind).dropDuplicates(["tkey", "first", "part"])
    asked = near.groupBy("tkey").agg(F.collect_list(F.struct("first", "part", "cosine")).alias("near"))
    out_schema = arrow_schema(kind_out)

    def verify(batches: Batches) -> Batches:
        for b in batches:
            out = []
            for key, data, tkey, near_rows in zip(*[c.to_pylist() for c in b.columns]):
                words = words_of(data)
                best: dict[object, tuple[float, float]] = {}
                for n in near_rows:
                    item, part, answer = shared_parts.value[n["part"]]
                    share = lcs_check(part, answer, words[n["first"] : n["first"] + span + answer], overlap)
                    if share is not None:
                        best[item] = max(best.get(item, (0.0, 0.0)), (share, n["cosine"]))
                out += [(key, item, c, s, tkey) for item, (s, c) in best.items()]
            yield rows_batch(out, out_schema)

    joined = source.join(asked, "tkey").select("key", "data", "tkey", "near")
    return map_batches(joined, verify, kind_out)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share of every benchmark item found in a document."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
