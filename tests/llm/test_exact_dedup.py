from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from petitionlens.llm import exact_dedup as X

from corpus_cases import DOCS, SF, texts_of


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, -(i or 0)))):
            out[i, keep, len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def result(df, **options):
    return Counter(tuple(r)[:5] for r in X.exact_groups(df, **options).collect())


@pytest.mark.parametrize("page_bytes", [16 << 20, 20_000, 1_000])
def test_whole_table_for_any_page_size(spark, page_bytes):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(df, page_bytes=page_bytes) == brute(texts_of(df))


@pytest.mark.parametrize("page_bytes", [16 << 20, 200])
def test_awkward_rows(docs, empty, page_bytes):
    assert result(docs, page_bytes=page_bytes) == brute(texts_of(docs))
    assert X.exact_groups(empty, page_bytes=page_bytes).count() == 0
    left = X.drop_exact_duplicates(docs, page_bytes=page_bytes)
    assert left.columns == docs.columns
    assert sorted(t or "" for _, t in texts_of(left)) == sorted({t or "" for _, t in texts_of(docs)})


def test_a_third_of_all_rows_share_one_text(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i % 50}", "en", "s", 1) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert result(df, page_bytes=5_000) == brute(texts_of(df))
    hot = hashlib.sha256(b"hot text " * 20).hexdigest()
    pages = X.build_index(df, page_bytes=5_000).where(f"sha = '{hot}'").groupBy("owner").count()
    spread = [r["count"] for r in pages.collect()]
    assert len(spread) > 20 and max(spread) < 100


def test_equal_keys_with_different_bytes_form_a_chain(spark, monkeypatch):
    monkeypatch.setattr(X, "index_key", lambda data: X.F.xxhash64(X.F.substring(data, 1, 1)))
    rows = [(i, f"a{i % 7}" * 40) for i in range(300)] + [(1000 + i, "b") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for page_bytes in (16 << 20, 1_000):
        assert result(df, page_bytes=page_bytes) == brute(rows)
        assert X.build_index(df, page_bytes=page_bytes).agg({"chain": "max"}).first()[0] > 1


def test_directory_doubles_until_buckets_fit_or_keys_cannot_be_told_apart():
    weights = {s: 10 for s in range(64)} | {9: 1000}
    buckets = X.grow(weights, 6, 100)
    assert sum(b.weight for b in buckets) == sum(weights.values())
    covered = [s for b in buckets for s in range(b.prefix << (6 - b.depth), (b.prefix + 1) << (6 - b.depth))]
    assert covered == list(range(64))
    assert [b for b in buckets if b.weight > 100] == [X.Bucket(6, 9, 1000)]
    placed, owners = X.with_owners(buckets, 100)
    hot = next(b for b in placed if b.weight > 100)
    assert hot.pages == 10 and owners == placed[-1].owner + placed[-1].pages
    held = Counter()
    for b in placed:
        held[b.owner] += b.weight if b.pages == 1 else 0
    assert max(held.values()) <= 100 and held[hot.owner] == 0
