from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from petitionlens.llm import suffix_dedup as S
from petitionlens.llm.suffix_array import suffix_array

from corpus_cases import SF, texts_of


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array_equals_sorting(text):
    text = [*text, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("text", [[1] * 500, [1, 2] * 300, [3, 2, 1] * 200, list(range(1, 400)), list(range(400, 0, -1))])
def test_suffix_array_of_regular_texts(text):
    text = [*text, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in data for p in range(len(t) - length + 1))
    out = []
    for i, t in data:
        mark = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                mark[p] += 1
                mark[p + length] -= 1
        covered = np.cumsum(mark)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~covered])
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        out.append((i, len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def check(df, **options):
    length = options.get("length", 400)
    got = S.suffix_dedup(df, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == brute(texts_of(df), length)


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_hot_groups_give_the_same_rows(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"), group=1)


def test_awkward_rows(docs, empty):
    check(docs)
    assert S.suffix_dedup(empty).count() == 0


def test_shared_passages_with_different_edges(spark):
    r = np.random.default_rng(5)
    word = lambda n: "".join(r.choice(list("abcdefgé \n"), n))
    passages = [word(n) for n in (399, 400, 401, 450, 900)]
    rows = []
    for i in range(60):
        p = passages[i % 5]
        rows.append((i, word(int(r.integers(0, 700))) + p + word(int(r.integers(0, 700)))))
    rows += [(100, passages[3][20:] + passages[3]), (101, "ab" * 900), (102, ("x" * 37 + "y") * 30), (103, passages[4] * 2)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), group=3)


def words_brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for _, t in data]
    words = [[t[s:e] for s, e in own] for (_, t), own in zip(data, spans)]
    seen = Counter(tuple(w[p : p + length]) for w in words for p in range(len(w) - length + 1))
    out = Counter()
    for (i, t), own, w in zip(data, spans, words):
        gone = np.zeros(len(t), bool)
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p : p + length])] > 1:
                gone[own[p][0] : own[p + length - 1][1]] = True
        out[i, len(t), int(gone.sum())] += 1
    return out


def check_words(df, **options):
    got = Counter((r.doc_id, r.n_bytes, r.n_also) for r in S.suffix_dedup(df, also=S.WORDS, **options).collect())
    assert got == words_brute(texts_of(df), 50)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in S.suffix_dedup(df, rule=S.WORDS, **options).collect())
    assert got == words_brute(texts_of(df), 50)


def test_passages_of_fifty_words(spark, docs):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check_words(df)
    check_words(df, group=1)
    check_words(docs)


def test_one_passage_in_a_third_of_all_texts(spark):
    r = np.random.default_rng(9)
    word = lambda n: "".join(r.choice(list("abcdefgh \n"), n))
    hot = word(460)
    rows = [(i, word(int(r.integers(0, 300))) + (hot[int(r.integers(0, 40)) :] if i % 3 == 0 else "") + word(int(r.integers(150, 500)))) for i in range(360)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for group in (256, 8, 2):
        check(df, group=group)
    name = [str(i) for i in range(60)]
    rows = [(i, " ".join([*r.choice(name, 30), *(name if i % 3 == 0 else []), *r.choice(name, 30)])) for i in range(200)]
    check_words(spark.createDataFrame(rows, "doc_id long, text string"), group=5)


def test_texts_beyond_one_segment(spark, monkeypatch):
    r = np.random.default_rng(3)
    long = "".join(r.choice(list("abcdefghij klmno"), 150_000))
    at = S.SEGMENT
    rows = [(1, long), (2, "x " + long[at - 300 : at + 300]), (3, long[2 * at - 200 : 2 * at + 250] + " y"), (4, long[-500:])]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    check_words(spark.createDataFrame(rows, "doc_id long, text string"))


def test_blocks_hold_every_window_once_with_its_common_part():
    rule = S.Passage(40, 8, 5)
    data = bytes(range(100)) + bytes(range(100))
    for offset in (160, 173, 199):
        seen = Counter()
        for b, p, before, part in S.core_blocks(data, offset, rule):
            common = part[before : before + rule.length - S.BLOCK + 1]
            assert len(common) == rule.length - S.BLOCK + 1
            for k in range(len(part) - rule.length + 1):
                seen[p + k] += 1
                assert common in part[k : k + rule.length] and (offset - p - k) // S.BLOCK == b
        assert seen == Counter(range(161))


def test_word_hashes_tell_words_apart():
    texts = [b"", b" a  b\tab b", b"x" * 3_000_000 + b" y", "é 日本語\x0bé".encode(), b"ab " * 500_000]
    known = {}
    for t, packed in zip(texts, S.symbols(texts, 8)):
        own = re.findall(rb"[^\x20\x09-\x0D]+", t)
        hashes = np.frombuffer(packed, np.uint64).tolist()
        assert len(own) == len(hashes)
        for w, h in zip(own, hashes):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_text_without_the_repeats(spark, docs):
    passage = "é" * 10 + "".join(str(i) for i in range(300))
    rows = [(1, "alone " + passage + " left"), (2, "other " + passage + " right"), (3, None), (4, "plain")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS kept", "'t' AS tkey2")
    got = {r.doc_id: r for r in S.remove_repeats(table).collect()}
    assert (got[1].text, got[2].text, got[3].text, got[4].text) == ("alone left", "other right", "", "plain") or (
        got[1].text.startswith("alone") and passage not in got[1].text
    )
    assert got[1].kept == "k"
    assert S.remove_repeats(docs).count() == docs.count()
