from __future__ import annotations

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from petitionlens.llm import packing as P
from petitionlens.llm import token_counts as C
from petitionlens.llm import tokens as T
from petitionlens.llm import training_order as O

from corpus_cases import SF, TEXTS, texts_of

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = st.text(alphabet="aBé'sñ12²½ \n\t\u0085\xa0.,!İſß日<|>\x1ćK", max_size=40)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_ids_and_counts_equal_the_library(text):
    own = T.shared(T.ByteLevelIds, BYTES)
    assert own.ranks is not None
    assert own.ids(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert own.count(text) == len(own.ids(text)) // 4
    counter = T.shared(C.WordCounter, WORDS)
    assert counter.count(text, PROVEN) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


PROVEN = C.proven_words(WORDS)


@pytest.mark.parametrize("change", ["prefix", "normalizer", "cut", "merges"])
def test_files_of_another_layout_are_left_to_the_library(change, tmp_path):
    texts = ["Ab cd, it's 12 x", " a  b", "", "Zoë’s ﬁne 3rd", "under_score x-y"]
    for name, kind in (("byte_bpe_50k.json", T.ByteLevelIds), ("word_bpe_49k.json", C.WordCounter)):
        file = json.load(open(public_tokenizers.path(name)))
        cuts = file["pre_tokenizer"].get("pretokenizers", [file["pre_tokenizer"]])
        if change == "prefix":
            cuts[-1]["add_prefix_space"] = True
        elif change == "normalizer":
            file["normalizer"] = {"type": "NFKC"}
        elif change == "cut":
            own = {"type": "Split", "pattern": {"Regex": "[a-z]+"}, "behavior": "Isolated", "invert": False}
            file["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [own, cuts[-1]]}
        else:
            file["model"]["ignore_merges"] = True
        path = str(tmp_path / name)
        json.dump(file, open(path, "w"))
        library = Tokenizer.from_file(path)
        own = kind(path)
        for t in texts:
            want = library.encode(t, add_special_tokens=False).ids
            if kind is T.ByteLevelIds:
                assert own.ranks is None and np.frombuffer(own.ids(t), "<u4").tolist() == want and own.count(t) == len(want)
            else:
                assert not own.words and not C.proven_words(path) and own.count(t, frozenset()) == len(want)


def test_the_given_files_take_the_fast_paths():
    assert T.ByteLevelIds(public_tokenizers.path("byte_bpe_50k.json")).ranks is not None
    assert C.WordCounter(public_tokenizers.path("word_bpe_49k.json")).words


def test_proven_words_are_single_tokens(library):
    assert len(PROVEN) > 10_000
    for w in sorted(PROVEN)[::50]:
        assert len(library[1].encode(w, add_special_tokens=False).ids) == 1


def test_counts_of_awkward_rows_and_the_whole_table(spark, docs, empty, library):
    for table in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        want = sorted(((t or "").encode().__len__(), len(library[1].encode(t or "", add_special_tokens=False).ids)) for _, t in texts_of(table))
        got = C.token_counts(table, WORDS).collect()
        assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert C.token_counts(empty, WORDS).count() == 0


def check_pieces(rows, table, encode, window=1024):
    texts = defaultdict(list)
    for i, t in texts_of(table):
        texts[i].append(encode(t or "") + [0])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, ids in texts.items():
        if len(ids) > 1:  # a repeated row: every id as often as there are rows
            assert sum(p.length for p in pieces[i]) == sum(map(len, ids))
            continue
        at = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[0])
            assert np.frombuffer(p.ids, "<u4").tolist() == ids[0][at : at + p.length]
            at += p.length
        assert at == len(ids[0])
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or at & (at - 1) == 0


def test_packing_is_a_partition_without_padding(spark, docs, empty, library):
    encode = lambda t: library[0].encode(t, add_special_tokens=False).ids
    for table in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        check_pieces(P.packed_pieces(table, BYTES).collect(), table, encode)
    assert P.packed_pieces(empty, BYTES).count() == 0


def test_long_documents_are_several_items(spark, library, monkeypatch):
    table = spark.createDataFrame([(1, "lorem ipsum dolor " * 40_000, "s"), (2, "x", "t")], "doc_id long, text string, source string")
    rows = P.packed_pieces(table, BYTES).collect()
    check_pieces(rows, table, lambda t: library[0].encode(t, add_special_tokens=False).ids)


def test_windows_hold_the_target_mixture(spark):
    r = np.random.default_rng(4)
    items = [(i, "=a" if i % 3 else "=b", int(n)) for i, n in enumerate(r.integers(1, 400, 6000))]
    table = spark.createDataFrame(items, "rid long, queue string, n long")
    queue = {i: q for i, q, _ in items}
    size = {q: sum(n for _, s, n in items if s == q) for q in ("=a", "=b")}
    for weights, share in ((None, size["=a"] / sum(size.values())), ({"a": 1.0, "b": 1.0}, 0.5)):
        got = P.pack(table, weights=weights, block=1 << 17).orderBy("sequence_id").collect()
        joined = P.pack(table, weights=weights, block=1 << 17, few=0).orderBy("sequence_id").collect()
        assert sorted(map(tuple, joined)) == sorted(map(tuple, got))
        taken, total, worst = 0, 0, 0.0
        last = None
        for p in got:
            if last is not None and p.sequence_id != last:
                worst = max(worst, abs(taken - share * total)) if total < 1.9 * size["=b"] else worst
            last = p.sequence_id
            taken += p.length * (queue[p.rid] == "=a")
            total += p.length
        assert worst < 1024 + 2 * 400  # the deficit stays within a window and an item, over all blocks


def test_deficits_carry_into_a_block():
    queues = [[(1, 3000)], [(2, 3000)]]
    pieces, windows = P.fill_windows(np.array([2048.0, -2048.0]), np.array([0.5, 0.5]), queues, 1024)
    assert windows == 6 and [p[0] for p in pieces[:2]] == [1, 1]  # what queue 0 is owed is paid first


def test_tail_is_cut_into_powers_of_two():
    pieces = P.split_tail([(1, 0, 1024, 0, 0), (1, 1024, 300, 1, 0), (2, 0, 7, 1, 300)], 2, 1024)
    sizes = defaultdict(int)
    for _, _, n, w, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert offset == sizes[w]
        sizes[w] += n
    assert sorted(sizes.values()) == [1, 2, 16, 32, 256, 1024]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = O.feistel_slots(np.arange(n), n, 20)
    assert sorted(slots.tolist()) == list(range(n))
    assert (O.feistel_slots(np.arange(n), n, 20) == slots).all()
    if n > 100:
        assert (O.feistel_slots(np.arange(n), n, 21) != slots).any() and (slots != np.arange(n)).mean() > 0.9


def test_order_round_trip_and_resuming(spark, docs, empty, library, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    layout = O.write_order(table, BYTES, length=16, shard_slots=50)
    got = O.read_order(spark, layout).collect()
    want = []
    for i, t in texts_of(table):
        ids = library[0].encode(t or "", add_special_tokens=False).ids
        want += [(i, s, ids[s : s + 16]) for s in range(0, len(ids), 16)]
    assert sorted(((r.key, r.start, np.frombuffer(r.ids, "<u2").tolist()) for r in got), key=str) == sorted(want, key=str)
    assert [r.slot for r in sorted(got, key=lambda r: r.slot)] == list(range(layout.n))
    assert all((r.shard, r.offset_bytes) == (r.slot // 50, r.slot % 50 * layout.stride) for r in got)
    later = O.read_order(spark, layout, first_slot=77).collect()
    assert sorted(later, key=lambda r: r.slot) == sorted((r for r in got if r.slot >= 77), key=lambda r: r.slot)
    assert O.read_order(spark, O.write_order(empty, BYTES)).count() == 0


def test_sequences_of_a_shard_stand_at_their_bytes(spark, tmp_path):
    layout = O.write_order(spark.read.parquet(f"{SF}/documents.parquet"), BYTES, length=64, shard_slots=512)
    rows = {r.slot: r for r in O.read_order(spark, layout).collect()}
    files = {r.path.split("part-")[1][:5]: r.content for r in spark.read.format("binaryFile").load(layout.path).collect()}
    form = O.record_type(64, layout.wide)
    for slot in range(0, layout.n, 97):
        raw = files[f"{slot // 512:05d}"][slot % 512 * layout.stride :][: layout.stride]
        record = np.frombuffer(raw, form)[0]
        assert record["key"] == rows[slot].key and zlib.crc32(record["ids"][: record["n"]].tobytes()) == zlib.crc32(rows[slot].ids)
