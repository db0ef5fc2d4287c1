from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from petitionlens.llm import importance_sampling as I

from corpus_cases import SF, texts_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(FOLD))


def hashed(t, longest, buckets):
    w = words(t)
    runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(docs, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(hashed(x, longest, buckets))
    for x in target:
        t.update(hashed(x, longest, buckets))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        own = hashed(x, longest, buckets)
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = k
    return Counter(tuple(r[:5]) for r in rows)


def result(docs, target, **options):
    return Counter(tuple(r) for r in I.resample(docs, target, **options).drop("n_words").collect())


@pytest.mark.parametrize("longest", [1, 3])
def test_whole_table(spark, longest):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute(texts_of(docs), [r.text for r in target.collect()], longest)
    assert result(docs.repartition(5), target, longest=longest) == want
    assert sum(r[4] is not None for r in want) > 10


def test_awkward_rows(spark, docs, empty):
    target = spark.createDataFrame([("The Quick fox",), (None,), ("",)], "text string").selectExpr("*", "1 AS rank", "'z' AS id")
    texts = [r.text for r in target.collect()]
    for options in ({}, {"least_words": 0, "percent": 50}, {"least_words": 1, "percent": 100, "longest": 2, "buckets": 70_000}):
        names = {"least_words": "least"}
        want = brute(texts_of(docs), texts, **{names.get(k, k): v for k, v in options.items()})
        assert result(docs, target, **options) == want
    assert result(empty, target) == Counter()
    assert result(docs, target.limit(0)) == brute(texts_of(docs), [])


def test_flat_batches_cut_between_texts(monkeypatch):
    monkeypatch.setattr(I, "FLAT_BYTES", 10)
    assert I.batches_of(pa.array(["aaaa", "bbbbbb", None, "c" * 50, "d"])) == [(0, 3), (3, 4), (4, 5)]


def test_a_very_long_text_and_many_runs():
    long = "alpha beta " * 30_000 + "gamma"
    for longest in (1, 4, 9):
        taken, firsts, n = I.bucket_lists(pa.array([long, None, "alpha", "x y"]), longest, 997)
        for k, t in enumerate([long, None, "alpha", "x y"]):
            assert sorted(taken[firsts[k] : firsts[k + 1]].tolist()) == sorted(hashed(t, longest, 997))
        assert n.tolist() == [60_001, 0, 1, 2]


def test_drawn_documents_keep_their_columns(spark):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    drawn = I.draw(docs, target)
    assert drawn.columns == docs.columns and 0 < drawn.count() <= docs.count() // 10
