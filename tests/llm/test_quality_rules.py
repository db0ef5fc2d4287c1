from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from petitionlens.llm import quality_rules as Q

from corpus_cases import texts_of


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(lines[i] in lines[:i] for i in range(len(lines))), len(lines), len(covered))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab#é \n\t\x0b |日", max_size=60))
def test_features_equal_brute_force(text):
    assert Q.text_features(text.encode()) == brute(text)


def test_repeated_words_of_long_texts(monkeypatch):
    import numpy as np

    words = [str(x).encode() for x in np.random.default_rng(1).integers(0, 60, 210_000)]
    assert Q.repeated_words(words[:190_000]) == brute(b" ".join(words[:190_000]).decode())[5]
    assert Q.repeated_words(words) == brute(b" ".join(words).decode())[5]


def test_binomial_bound_is_exact():
    for n, p in ((10, 0.3), (50, 0.02), (200, 0.5)):
        for k in range(n + 1):
            want = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
            assert abs(Q.binomial_cdf(k, n, p) - want) < 1e-9


def test_the_first_failure_ends_the_sequence():
    assert Q.certified_length([0, 0, 1, 60, 0], 5000, 0.01, 0.001) == 3
    assert Q.certified_length([0], 100, 0.01, 0.001) == 0  # too few documents for any certificate
    assert Q.certified_length([], 5000, 0.01, 0.001) == 0
    for level, risk in ((0.05, 0.02), (0.0125, 0.02), (0.01, 0.004)):
        n = Q.least_good(level, risk)
        assert Q.certified_length([0], n, risk, level) == 1 and Q.certified_length([0], n - 1, risk, level) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=12))
def test_sets_are_nested_and_each_catches_more(rows):
    passed = np.array([r[:2] for r in rows])
    good, bad = (np.array([r[k] for r in rows]) for k in (2, 3))
    sets = Q.nested_sets(passed, good, bad, [3, 2], risk=0.1)

    def rejected(s):  # written out: a document goes if it is above the last cutoff in force of any rule
        return {i for i, r in enumerate(rows) if any(c and r[k] > n - c for k, (c, n) in enumerate(zip(s, (3, 2))))}

    before = set()
    for s in sets:
        now = rejected(s)
        assert before < now and sum(bad[i] for i in now - before) > 0
        before = now
    assert sum(good[i] for i in before) <= 0.4 * good.sum() + 1


def test_awkward_rows_and_filter(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    got = Q.quality_rules(docs, labels).collect()
    want = Counter((i, brute(t)) for i, t in texts_of(docs))
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_lines, r.n_repeat_words)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    kept = Q.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert Q.quality_rules(empty, labels).count() == 0 == Q.filter_documents(empty, labels).count()


def test_certified_rules_reject_junk_and_spare_the_holdout(spark):
    words = " ".join(f"w{i}" for i in range(60))
    junk = " ".join(f"w{i}***" for i in range(60))
    rows = [(i, words + f" end{i}", "en") for i in range(4000)] + [(i, junk + f" end{i}", "en") for i in range(4000, 4100)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 4000)) for i in range(4100)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in Q.quality_rules(table, labels).collect()}
    assert all(got[i] for i in range(4000)) and not any(got[i] for i in range(4000, 4100))


def labelled(spark, sizes, bad=30):
    """Documents and labels: ``sizes`` good ones and ``bad`` full of symbols in each language."""
    words = " ".join(f"w{i}" for i in range(60))
    junk = " ".join(f"w{i}***" for i in range(60))
    rows, labels = [], []
    for lang, n in sizes.items():
        for i in range(n + bad):
            rows.append((len(rows), (words if i < n else junk) + f" end{len(rows)}", lang))
            labels.append((len(rows) - 1, int(i < n)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_small_strata_have_certificates_of_their_own_or_share_one(spark):
    table, labels = labelled(spark, {"en": 900, "de": 330, "fr": 120, None: 110})
    features = Q.materialise(Q.with_features(table, keep=["doc_id", "lang"]))
    found = {r.stratum: r for r in Q.thresholds(features, labels).collect()}
    assert {k: r.own for k, r in found.items()} == {"en": True, "de": True, "fr": False, None: False}
    assert found["fr"][2:] == found[None][2:]
    got = Q.judge(features, Q.thresholds(features, labels)).join(labels, "doc_id").collect()
    assert len(got) == features.count()
    by = Counter((r.lang, r.quality, r.kept) for r in got)
    assert by["fr", 1, True] == 120 and by["de", 0, False] == 30 == by["en", 0, False]
    # the shared certificate needs ln(0.05/3)/ln(0.98) = 203 certifying documents, which these 230 just do not have
    few = sum(1 for r in got if r.lang in ("fr", None) and r.quality == 1)
    assert few == 230


def test_good_labels_alone_or_conflicting(spark):
    table, labels = labelled(spark, {"en": 400}, bad=0)
    assert {r.kept for r in Q.quality_rules(table, labels).collect()} == {True}
    both = labels.withColumn("quality", F.lit(0).cast("int")).union(labels)  # every key has both labels: none is good
    assert {r.kept for r in Q.quality_rules(table, both).collect()} == {True}


def test_no_good_document_certifies_the_sequence_it_chose(spark):
    """A rule that good documents break as often as bad ones is never certified."""
    table, labels = labelled(spark, {"en": 1500}, bad=300)
    table = table.withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.regexp_replace("text", "w", "***")).otherwise(F.col("text")))
    kept = Q.quality_rules(table, labels).join(labels, "doc_id").where("quality = 1")
    assert kept.where("not kept").count() <= 0.02 * kept.count()
