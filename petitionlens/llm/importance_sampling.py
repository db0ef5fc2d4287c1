"""Draws documents towards a target distribution by hashed n-gram importance.

Arrow kernels cut the text: ascii_lower, split_pattern_regex, list_flatten,
then dictionary_encode.  Runs of several words are formed from shifted
dictionary indices; each distinct run of a batch is hashed (CRC-32) once, and
``take`` brings its bucket to every occurrence.

1.  One scan stores, for each document, the buckets of its features; adding
    them up gives S and s, the target texts give T and t.
2.  A bucket's gain is the scaled logarithm of its share in the target over
    its share in the documents.  A segment sum over a document's buckets gives
    its weight; the keyed noise of its id (Gumbel) makes the highest scores a
    draw without replacement.
3.  Long enough documents get their place by score from a distributed rank.

Defined results: null texts have no word; documents without features weigh 0;
rows that share an id share their noise and are ranked each; a null id hashes
as the empty string and stands after all others of its score; empty tables
give empty results, an empty target gives equal gains wherever s is equal;
texts are read whole; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petitionlens.operators.ranking import with_place

from .common import Batches, arrow_schema, map_batches, materialise, read_table

#: What separates words, once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FLAT_BYTES = 64 << 20


def word_lists(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of ``texts`` as a dictionary array, and the first word's place of each text (one more at the end)."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), pattern=SEPARATORS)
    words = pc.list_flatten(split)
    real = pc.not_equal(words, "")
    # texts that begin or end with a separator have an empty word there
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    starts = before[np.concatenate([[0], np.cumsum(lengths)])]
    return pc.filter(words, real).dictionary_encode(), starts


def bucket_lists(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, text by text, the first one's place of each text, and the words of each text."""
    words, starts = word_lists(texts)
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = [w.encode() for w in words.dictionary.to_pylist()]
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    found, owners = [], []
    run = index  # number of the run of n words that begins at each place
    heads = names
    for n in range(1, longest + 1):
        if n > 1:
            # the run of n - 1 words and the word after it, where both are in one text
            at = max(0, len(text_of) - n + 1)
            inside = text_of[:at] == text_of[n - 1 :]
            pairs = np.where(inside, run[:at] * max(1, len(names)) + index[n - 1 :], -1)
            distinct, run = np.unique(pairs, return_inverse=True)
            heads = [b"" if p < 0 else heads[p // len(names)] + b" " + names[p % len(names)] for p in distinct.tolist()]
        hashed = pa.array([zlib.crc32(h) % buckets for h in heads], pa.int32())
        taken = hashed.take(pa.array(run)).to_numpy(zero_copy_only=False)
        if n == 1:
            found.append(taken)
            owners.append(text_of)
        else:
            found.append(taken[inside])
            owners.append(text_of[:at][inside])
    if longest > 1:
        owner, taken = np.concatenate(owners), np.concatenate(found)
        order = np.argsort(owner, kind="stable")
        owner, taken = owner[order], taken[order]
    else:
        owner, taken = owners[0], found[0]
    firsts = np.searchsorted(owner, np.arange(len(starts)))
    return taken, firsts, np.diff(starts)


def batches_of(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of texts of about FLAT_BYTES together."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    out, start, held = [], 0, 0
    for i, s in enumerate(sizes.tolist()):
        if held and held + s > FLAT_BYTES:
            out.append((start, i))
            start, held = i, 0
        held += s
    return [*out, (start, len(sizes))] if len(sizes) else []


def features(docs: DataFrame, key: str, text: str, longest: int, buckets: int) -> DataFrame:
    """id, n_features, n_words and the packed buckets of each document."""
    kind = T.StructType.fromDDL("id long, n_features long, n_words long, buckets binary")
    schema = arrow_schema(kind)
    form = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Batches) -> Batches:
        for b in batches:
            for s, e in batches_of(b.column(1)):
                taken, firsts, n_words = bucket_lists(b.column(1)[s:e], longest, buckets)
                packed = taken.astype(form)
                size = packed.itemsize
                lists = pa.Array.from_buffers(
                    pa.binary(), e - s, [None, pa.py_buffer((firsts * size).astype(np.int32)), pa.py_buffer(packed.tobytes())]
                )
                columns = [b.column(0)[s:e], pa.array(np.diff(firsts).astype(np.int64)), pa.array(n_words.astype(np.int64)), lists]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return map_batches(docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")), run, kind)


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; the driver gets one row for each bucket."""
    kind = T.StructType.fromDDL("bucket int, n long")
    schema = arrow_schema(kind)
    form = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Batches) -> Batches:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), form), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], schema=schema)

    out = np.zeros(buckets, np.int64)
    for r in map_batches(found.select("buckets"), run, kind).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole-number gain of each bucket, with one added to each count."""
    b = len(source)
    s_all, t_all = float(source.sum() + b), float(target.sum() + b)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist())], np.int64
    )


def noise(seed: int, key: object) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(found: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """id, n_features, n_words, weight, score."""
    kind = T.StructType.fromDDL("id long, n_features long, n_words long, weight long, score long")
    schema = arrow_schema(kind)
    form = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def run(batches: Batches) -> Batches:
        for b in batches:
            lists = b.column(3).to_pylist()
            n = b.column(1).to_numpy(zero_copy_only=False)
            weight = np.zeros(len(lists), np.int64)
            some = np.flatnonzero(n)
            if len(some):
                own = pa.array(gain).take(pa.array(np.frombuffer(b"".join(lists), form).astype(np.int64)))
                starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
                weight[some] = np.add.reduceat(own.to_numpy(), starts)
            extra = np.array([noise(seed, i) for i in b.column(0).to_pylist()], np.int64)
            arrays = [b.column(0), b.column(1), b.column(2), pa.array(weight), pa.array(weight + extra)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_batches(found.select("id", "n_features", "n_words", "buckets"), run, kind)


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """``key``, n_features, n_words, weight, score, rank for every row; rank counts the drawn ones from 1 and is null for others."""
    found = materialise(features(docs, key, text, longest, buckets))
    asked = features(target.select(F.lit(None).cast("long").alias("id"), target_text), "id", target_text, longest, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(asked, buckets))
    rows = materialise(scored(found, gain, seed))
    able = rows.where(F.col("n_words") >= least_words)
    n = able.count()
    placed = with_place(able, [F.desc("score"), F.asc_nulls_last("id")], "rank")
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= percent * n // 100, F.col("rank")))
    others = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.union(others).withColumnRenamed("id", key)


def draw(docs: DataFrame, target: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` whose ids are unique and not null, all columns."""
    ids = resample(docs, target, key, **options).where(F.col("rank").isNotNull()).select(key)
    return docs.join(ids, key, "left_semi").select(docs.columns)


def op12_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document, with the benchmark as target."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("n_words")
