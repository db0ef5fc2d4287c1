from __future__ import annotations

import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from petitionlens.llm import simhash as S
from petitionlens.llm.components import connected_components

from corpus_cases import SF, texts_of


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                a_, b_ = sorted((find(i), find(j)))
                root[b_] = a_
    return [find(i) for i in range(len(prints))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB é\n日", max_size=40))
def test_fingerprint_equals_brute_force(text):
    assert S.fingerprint(text.encode()) == brute_print(text)


def test_links_connect_what_brute_force_connects():
    r = np.random.default_rng(3)
    seeds = r.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(s) ^ sum(1 << int(b) for b in r.choice(64, r.integers(1, 6), replace=False)) for s in seeds for _ in range(12)]
    x = np.unique(np.array([*seeds, *near, 0, 1, 2**64 - 1], np.uint64))
    for same, left, right in ((True, x, x), (False, x[::2], x[1::2])):
        u, v = S.links(left, right, same, 3)
        nodes = np.concatenate([left] if same else [left, right])
        place = {int(n): i for i, n in enumerate(nodes)}
        got = S.Forest(len(nodes))
        got.join(np.array([place[int(n)] for n in u]), np.array([place[int(n)] for n in v]))
        want = S.Forest(len(nodes))
        pairs = [(place[int(a)], place[int(b)]) for a in left for b in right if a != b and (int(a) ^ int(b)).bit_count() <= 3]
        want.join(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
        assert (got.root == want.root).all()


def test_links_between_population_counts_and_between_tiles(spark):
    r = np.random.default_rng(5)
    seeds = [int(x) for x in r.integers(0, 2**63, 30, dtype=np.uint64)]
    # each flipped bit changes the population count, so most links are between different counts
    near = [s ^ sum(1 << int(b) for b in r.choice(64, k, replace=False)) for s in seeds for k in (1, 2, 3, 4) for _ in range(3)]
    prints = sorted({*seeds, *near, 0, 7, 2**64 - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = brute_components(prints)
    for tile in (1 << 14, 4):  # one tile for each count, and several
        got = S.Forest(len(prints))
        edges = [(signed.index(e.a), signed.index(e.b)) for e in S.link_forest(table, tile=tile).collect()]
        got.join(np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
        assert got.root.tolist() == want


def test_near_copies_whose_fingerprints_differ_in_their_population_count(spark):
    base = [f"word{i * i % 1009}" for i in range(400)]
    texts = [" ".join(base), *(" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in range(3, 400, 20))]
    prints = [brute_print(t) for t in texts]
    roots = brute_components(prints)
    linked = [(a, b) for a, x in zip(prints, roots) for b, y in zip(prints, roots) if x == y]
    assert any(a.bit_count() != b.bit_count() for a, b in linked)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = S.near_duplicates(table).select("doc_id", S.hex64("fp"), "component_id").collect()
    assert sorted(tuple(r) for r in found) == [(i, f"{p:016x}", r) for i, (p, r) in enumerate(zip(prints, roots))]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}}


def test_whole_table_and_awkward_rows(spark, docs, empty):
    for table in (spark.read.parquet(f"{SF}/documents.parquet"), docs):
        rows = sorted(texts_of(table), key=lambda r: (r[0] is None, r[0] or 0))
        prints = [brute_print(t) for _, t in rows]
        roots = brute_components(prints)
        ids = {}
        for (i, _), r in zip(rows, roots):
            ids.setdefault(r, []).append(i)
        want = sorted((i, f"{p:016x}", min((x for x in ids[r] if x is not None), default=None)) for (i, _), p, r in zip(rows, prints, roots) if i is not None)
        found = S.near_duplicates(table).select("doc_id", S.hex64("fp"), "component_id").collect()
        assert sorted(tuple(r) for r in found if r[0] is not None) == want and len(found) == len(rows)
    assert S.near_duplicates(empty).count() == 0


def test_one_row_of_each_class_stays(docs, empty):
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    prints = [brute_print(t) for _, t in texts_of(kept)]
    assert len(set(brute_components(prints))) == len(prints)
    everything = [brute_print(t) for _, t in texts_of(docs)]
    assert len(set(brute_components(everything))) == len(prints)
    assert S.drop_near_duplicates(empty).count() == 0
