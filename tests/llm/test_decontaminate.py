from __future__ import annotations

import numpy as np

from petitionlens.llm import decontaminate as D

from corpus_cases import SF


def words(r, n):
    return [f"{a}{b}" for a, b in zip(r.choice(list("abcdefghijkl"), n), r.integers(0, 900, n))]


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_subsequence_length_equals_the_table_method():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = [bytes([x]) for x in r.integers(97, 101, r.integers(1, 12))]
        b = [bytes([x]) for x in r.integers(97, 102, r.integers(0, 16))]
        n, first, last = D.common_subsequence(a, b)
        assert n == lcs(a, b)
        if n:
            assert lcs(a, b[first : last + 1]) == n


def test_verbatim_and_paraphrased_leaks_are_found_and_clean_documents_left(spark):
    r = np.random.default_rng(9)
    common = [f"c{i}" for i in range(20)]
    items = [(i, " ".join(words(r, 30)) + ". " + " ".join(words(r, 6)) + ".") for i in range(30)]
    items += [(90, None), (91, ""), (92, " ".join(words(r, 200)))]
    text = lambda n: " ".join(w if r.random() < 0.5 else str(r.choice(common)) for w in words(r, n))
    docs = [(i, text(400)) for i in range(200)]
    want = set()
    for k, (i, t) in enumerate(items[:30]):
        para = t.split()
        for j in range(3, 25, 7):  # every seventh word is another one
            para[j] = "other"
        docs.append((1000 + k, text(90) + " " + t.upper() + " " + text(50)))
        docs.append((2000 + k, text(30) + " " + " ".join(para)))
        want |= {(1000 + k, i), (2000 + k, i)}
    docs.append((3000, text(100) + " " + items[32][1] + " " + text(10)))
    want.add((3000, 92))
    scrambled = items[0][1].split()
    docs += [(4000, " ".join(reversed(scrambled))), (4001, " ".join(scrambled[:8])), (None, None), (4002, ""), (4003, items[1][1]), (4003, items[1][1])]
    want |= {(4003, 1)}
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "1 AS terms").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(table, bench)
    assert {(r[0], r[1]) for r in got.select("doc_id", bench.columns[0]).collect()} == want
    assert got.where("doc_id = 4003").count() == 2
    small = D.contaminated(table, bench, block=7)  # several blocks of items
    assert {(r[0], r[1]) for r in small.collect()} == want
    few = D.contaminated(table, bench, block_words=100)  # the parts of the long item stand in several blocks
    assert {(r[0], r[1]) for r in few.collect()} == want
    assert sorted(r[0] for r in few.where("item_id in (1, 92)").collect()) == sorted(r[0] for r in got.where("item_id in (1, 92)").collect())
    share = lambda df: {(r.doc_id, r.item_id): r.lcs_share for r in df.collect()}
    assert share(few) == share(got)


def test_recall_on_the_whole_table_is_that_of_brute_force(spark):
    found = {(r.doc_id, r.item_id) for r in D.op2_decontamination(spark, SF.replace("0.001", "0.01")).collect()}
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text").collect()
    bench = spark.read.parquet(SF.replace("0.001", "0.01") + "/benchmark.parquet").collect()
    joined = lambda t: b" " + b" ".join(D.words_of((t or "").encode())) + b" "
    verbatim = {(d.doc_id, b.item_id) for d in docs for b in bench if joined(b.text) in joined(d.text)}
    assert verbatim and verbatim <= found
    by_id = {d.doc_id: d.text for d in docs}
    for i, k in found - verbatim:  # only near copies of an item
        item = D.words_of(next(b.text for b in bench if b.item_id == k).encode())
        assert lcs(item, D.words_of(by_id[i].encode())) >= 0.7 * len(item)


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x y z")], "doc_id long, text string")
    assert D.contaminated(empty, some).count() == 0 == D.contaminated(docs, none).count()


def test_common_words_around_a_paraphrase_do_not_hide_it():
    r = np.random.default_rng(5)
    rare = lambda n: [w.encode() for w in words(r, n)]
    item = [b"the", b"of", *rare(26), b"of", b"the"]
    for _ in range(20):
        leak = [*rare(2), *item[2:-2], *rare(2)]  # changed first and last words
        far = [b"the", b"of", *rare(40), *leak, *rare(40), b"of", b"the"]
        assert D.lcs_check(item, 0, leak, 0.7) == 26 / 30 == D.lcs_check(item, 0, far, 0.7)
        assert D.lcs_check(item, 6, far, 0.7) is not None
        wide = [x for w in item for x in (w, *rare(2))]  # all words, but never compactly
        assert D.lcs_check(item, 0, wide, 0.7) is None


def test_the_best_compact_stretch_is_that_of_brute_force():
    r = np.random.default_rng(6)
    for _ in range(200):
        a = [bytes([x]) for x in r.integers(97, 103, r.integers(2, 9))]
        b = [bytes([x]) for x in r.integers(97, 105, r.integers(1, 50))]
        size = int(1.5 * len(a) + 5)
        most = max(lcs(a, b[s : s + size]) for s in range(len(b)))
        assert D.lcs_check(a, 0, b, 0.7) == (most / len(a) if most >= 0.7 * len(a) - 1e-9 else None)


def test_no_leak_is_lost_in_a_block_that_the_rank_does_not_hold(spark):
    r = np.random.default_rng(12)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(r.choice(vocabulary, 12 if i % 2 else 60))) for i in range(300)]
    docs, want = [], set()
    for i, t in items:
        para = t.split()
        for j in range(1, len(para) - 1, 4):  # a quarter of the words are others
            para[j] = "other"
        near = " ".join(items[(i + 7) % 300][1].split()[:20])  # words of another item in the window
        docs += [(i, f"{near} {t} {near}"), (1000 + i, f"{near} {' '.join(para)} {near}")]
        want |= {(i, i), (1000 + i, i)}
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {(x[0], x[1]) for x in D.contaminated(table, spark.createDataFrame(items, "item_id long, text string"), rank=16).collect()}
    assert want <= got
    text = dict(docs)
    for i, k in got - want:  # short items whose words stand in another item's part
        assert lcs(items[k][1].split(), text[i].split()) >= 0.7 * len(items[k][1].split())


def test_long_items_with_inserted_words_are_found_at_every_offset(spark):
    r = np.random.default_rng(13)
    item = words(r, 64)
    leak = []
    for i, w in enumerate(item):  # 46 of 64 words stay, in a stretch of 96
        leak += [w if i % 7 not in (2, 5) else "other"] + ["more"] * (i % 2)
    assert len(leak) == 96 and lcs(item, leak) == 46
    docs = [(i, " ".join([*words(r, i), *leak, *words(r, 60)])) for i in range(0, 210, 5)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {x[0] for x in D.contaminated(table, bench).collect()} == {i for i, _ in docs}


def test_a_very_long_item_and_repeated_items(spark):
    r = np.random.default_rng(14)
    long = [f"w{i}" for i in r.permutation(20_000)]
    items = [(1, " ".join(long))] * 3 + [(2, " ".join(long[300:340])), (3, " ".join(long[300:340]))]
    docs = [(1, " ".join(long[5000:5200])), (2, " ".join(words(r, 300))), (3, " ".join(["x", *long[300:340], "y"]))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(table, bench, block_words=4096).select("doc_id", "item_id").collect()
    assert len(got) == len(set(got))
    assert {(1, 1), (3, 2), (3, 3)} <= {tuple(x) for x in got} and all(x[0] != 2 for x in got)


def test_a_block_is_bounded_by_its_words():
    r = np.random.default_rng(15)
    parts = [[w.encode() for w in words(r, 64)] for _ in range(1000)]
    terms = D.Terms(parts, {}, 10, 0.7)
    assert sum(map(len, terms.items)) <= 4 * 64 * len(parts)  # a term of an item takes four bytes
    basis = r.standard_normal((len(terms.number), 5)).astype(np.float32)
    dense = np.zeros((len(parts), len(terms.number)))
    for i, p in enumerate(parts):
        for w in p:
            dense[i, terms.number[w]] += 1
    assert np.allclose(terms.items_times(basis), (np.log1p(dense) * terms.idf) @ basis, rtol=1e-3, atol=1e-3)
