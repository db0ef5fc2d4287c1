from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from petitionlens.llm import lexical_search as L

from corpus_cases import SF, texts_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    bags = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(FOLD)))
    out = Counter()
    for item, own in asked.items():
        found = []
        for i, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // length
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in own & bag.keys()
            )
            if s > 0:
                found.append((-s, i is None, i or 0))
        for rank, (s, null, i) in enumerate(sorted(found)[:k], 1):
            out[item, rank, None if null else i, -s] += 1
    return out


def result(docs, items, **options):
    return Counter(tuple(r) for r in L.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect())


def pairs(df, key, text="text"):
    return [(r[0], r[1]) for r in df.select(key, text).collect()]


@pytest.mark.parametrize("options", [{}, {"k": 7, "most_cells": 2000, "docs_in_tile": 13, "terms_in_tile": 50}])
def test_whole_table(spark, options):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert result(docs.repartition(5), items, **options) == brute(texts_of(docs), pairs(items, "item_id"), options.get("k", 50))


def test_sql_says_the_same(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert Counter(con.execute(L.OP11_SQL).fetchall()) == result(docs, items)


def test_awkward_rows_ties_and_repeated_items(spark, docs, empty):
    rows = [(1, "the quick BROWN fox"), (1, "same word"), (2, None), (3, " .,; "), (None, "日本語 x"), (4, "nowhere"), (5, "text " * 9), (5, "text " * 9)]
    items = spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'a' AS rank", "1 AS score", "2 AS doc_id")
    for k in (1, 3, 50):
        assert result(docs, items, k=k) == brute(texts_of(docs), rows, k)
    assert result(empty, items) == Counter() and result(docs, items.limit(0)) == Counter()


def test_equal_scores_go_by_the_smaller_id_whatever_the_tile(spark):
    rows = [(i, "common word here" if i % 2 else f"other text {i}") for i in range(900, 0, -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((r.rank, r.doc_id) for r in L.search(df, spark.createDataFrame([(1, "common")], "item_id long, text string"), docs_in_tile=11).collect())
    assert got == [(i + 1, 2 * i + 1) for i in range(50)]


def test_partial_sums_stay_exact():
    w = L.weight(10**11, 1)
    tile = int(2**53 // (w * L.TOP_IMPACT)) - 1
    assert tile > 4096 and tile * w * L.TOP_IMPACT < 2**53
    best = L.Best(1, 3)
    for s in range(40):
        best.add(np.full((5, 1), 7, np.int64), np.arange(200 - 5 * s, 205 - 5 * s))
    best.prune()
    assert best.doc.tolist() == [5, 6, 7] and best.floor.tolist() == [7]
