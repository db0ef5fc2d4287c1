"""Risk-controlled quality rules.

Each rule compares one ratio of a document with a cutoff; a document goes if
any rule rejects it.  A labelled holdout chooses the cutoffs of a stratum in two
steps.  One fifth of its good documents (by a hash of the key) and its bad ones
choose a nested sequence of rule sets: each set makes one rule stricter, the one
that catches the most further bad documents for the good ones it loses.  The
other good documents certify the sequence from lenient to strict: a set
passes while the exact binomial test rejects "more than
``max_false_rejection`` of good documents are lost to the whole set", and the
first failure ends it.  The sequence does not depend on the documents that
certify it, so its sets need no correction among themselves; the level is split
over the strata (Bonferroni).

Strata with too few good documents for a certificate of their own share one:
their documents choose and certify one sequence together, and its guarantee
holds for them taken together, not for each.

Defined results: null or empty text has no words and fails the base rules;
documents of a null stratum form their own stratum; a stratum without good
labels, or where nothing can be certified, has the base rules alone; very long
texts are measured whole; repeated rows are each judged (and count as often in
the holdout); an empty table gives an empty result; a table without labels
keeps whatever passes the base rules.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table, ship_package, utf8, with_columns

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def text_features(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words of a whole text."""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    code_points = int(np.count_nonzero((raw & 0xC0) != 0x80))
    spaces = len(text) - len(text.translate(None, SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return n, code_points - spaces, symbols, len(lines) - len(set(lines)), len(lines), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window whose words stand in the text at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    if n < 200_000:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) == n:
            return 0
        hit = np.fromiter((seen[w] > 1 for w in windows), bool, n)
    else:  # number the words and sort the window numbers: a few arrays instead of a tuple per window
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n + 2)
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, back, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        hit = count[back] > 1
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k : n + k] |= hit
    return int(covered.sum())


NAMES = [x.split()[0] for x in FEATURES.split(", ")]


def with_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the FEATURES columns."""

    def run(texts: list[bytes]) -> dict[str, object]:
        return dict(zip(NAMES, zip(*map(text_features, texts)))) if texts else {k: [] for k in NAMES}

    return with_columns(docs, utf8(text), run, FEATURES, keep)


def base_failed(min_words: int = 50, max_repeat_pct: int = 50) -> Column:
    n = F.col("n_words")
    return (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * n)


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


RATIOS = [0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]

#: Each rule's cutoffs from lenient to strict.
CUTOFFS = {
    "symbols": RATIOS,
    "dup_lines": [0.9, 0.8, *RATIOS[:9]],
    "repeat_words": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2],
    "long_words": [40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0],
    "short_words": [1.0, 0.8, 0.6, 0.5, 0.45, 0.4, 0.35, 0.32],
}


def rules() -> dict[str, Column]:
    """Each rule's ratio: bad when above its cutoff."""
    return {
        "symbols": _ratio("n_symbols", "word_chars"),
        "dup_lines": _ratio("n_dup_lines", "n_lines"),
        "repeat_words": _ratio("n_repeat_words", "n_words"),
        "long_words": _ratio("word_chars", "n_words"),
        "short_words": _ratio("n_words", "word_chars"),
    }


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed in logs from the largest term down."""
    if k >= n:
        return 1.0
    total, j = 0.0, k
    if k > n * p:  # sum the upper tail instead
        j, upper = k + 1, 0.0
        while j <= n:
            term = _binomial_term(j, n, p)
            upper += term
            if term < 1e-18:
                break
            j += 1
        return max(0.0, 1.0 - upper)
    while j >= 0:
        term = _binomial_term(j, n, p)
        total += term
        if term < total * 1e-17:
            break
        j -= 1
    return total


def _binomial_term(k: int, n: int, p: float) -> float:
    return math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )


def least_good(level: float, risk: float) -> int:
    """So many good documents, none lost, are certified at ``level``."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def certified_length(lost: list[int], n: int, risk: float, level: float) -> int:
    """How many leading sets pass, where set i loses ``lost[i]`` of ``n`` good documents.

    A set passes if the Clopper-Pearson upper bound of its loss is at most
    ``risk``, that is P(Bin(n, risk) <= lost) <= level.
    """
    for i, k in enumerate(lost):
        if binomial_cdf(k, n, risk) > level:
            return i
    return len(lost)


def nested_sets(passed: np.ndarray, good: np.ndarray, bad: np.ndarray, cutoffs: list[int], risk: float) -> list[tuple[int, ...]]:
    """Rule sets from lenient to strict, each a number of cutoffs in force for every rule (0: rule unused).

    Row i of ``passed`` says how many cutoffs of each rule its ``good[i]`` good
    and ``bad[i]`` bad documents are above.  A set with c cutoffs of a rule in
    force rejects the documents above c or more of them.  The sequence ends when
    no bad document is left to catch, or when it loses four times ``risk``.
    """
    now = [0] * len(cutoffs)
    left = np.ones(len(passed), bool)
    out: list[tuple[int, ...]] = []
    total = int(good.sum())
    while True:
        best = None
        for rule, n in enumerate(cutoffs):
            for c in range(now[rule] + 1, n + 1):
                # a document above the c-th most lenient cutoff is above all n - c + 1 that are as strict or stricter
                hit = left & (passed[:, rule] >= n - c + 1)
                caught, lost = int(bad[hit].sum()), int(good[hit].sum())
                rank = (caught / (lost + 0.5), -lost, -rule, -c)
                if caught and (best is None or rank > best[0]):
                    best = rank, rule, c, hit
        if best is None:
            return out
        _, rule, c, hit = best
        now[rule] = c
        left &= ~hit
        if good[~left].sum() > 4 * risk * total + 1:
            return out
        out.append(tuple(now))


def certify(rows: pd.DataFrame, risk: float, level: float) -> list[float | None]:
    """Each rule's certified cutoff from a stratum's counts: passed_<rule>, chooses, certifies, bad."""
    cutoffs = [len(cuts) for cuts in CUTOFFS.values()]
    passed = rows[[f"passed_{name}" for name in CUTOFFS]].to_numpy()
    sets = nested_sets(passed, rows["chooses"].to_numpy(), rows["bad"].to_numpy(), cutoffs, risk)
    certifies = rows["certifies"].to_numpy()
    lost = [int(certifies[(passed >= np.subtract(cutoffs, s) + 1).any(axis=1)].sum()) for s in sets]
    n = certified_length(lost, int(certifies.sum()), risk, level)
    if not n:
        return [None] * len(cutoffs)
    return [cuts[c - 1] if c else None for c, cuts in zip(sets[n - 1], CUTOFFS.values())]


CHOOSES = 5  # one document in so many chooses the sequence, the others certify it


def thresholds(
    features: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    key: str = "doc_id",
    quality: str = "quality",
    max_false_rejection: float = 0.02,
    level: float = 0.05,
) -> DataFrame:
    """One row for each stratum with a good label: stratum, own (its certificate is its own) and a nullable cutoff for each rule.

    A stratum's documents are counted by the cutoffs they are above, so what
    meets in a task is bounded by the grid of cutoffs (some 100,000 rows)
    whatever the holdout's size.  The driver sees the number of good documents
    of strata that could hold a certificate of their own, nothing else.
    """
    risk, names = max_false_rejection, list(CUTOFFS)
    above = [sum(((value > cut).cast("int") for cut in CUTOFFS[name]), F.lit(0)).alias(f"passed_{name}") for name, value in rules().items()]
    marks = labels.where(F.col(key).isNotNull() & F.col(quality).isin(0, 1)).groupBy(F.col(key).alias("__key__")).agg(
        F.min(quality).alias("__good__")  # a key with both labels counts as bad
    )
    held = features.where(~base_failed()).join(marks, F.col(key) == F.col("__key__"))
    good, first = F.col("__good__") == 1, F.pmod(F.xxhash64(F.col("__key__").cast("string")), F.lit(CHOOSES)) == 0
    counted = held.groupBy(F.col(stratum).alias("stratum"), *above).agg(
        F.count_if(good & first).alias("chooses"), F.count_if(good & ~first).alias("certifies"), F.count_if(~good).alias("bad")
    )
    counted = materialise(counted)
    sizes = counted.groupBy("stratum").agg(F.sum("certifies").alias("n"), F.sum(F.col("chooses") + F.col("certifies")).alias("good"))
    sizes = materialise(sizes.where("good > 0").select("stratum", "n"))
    most = sorted((r["n"] for r in sizes.where(F.col("n") >= least_good(level, risk)).select("n").collect()), reverse=True)
    alone = 0  # strata with a certificate of their own, beside the shared one
    while alone < len(most) and most[alone] >= least_good(level / (alone + 2), risk):
        alone += 1
    while alone and alone < len(most) and most[alone] == most[alone - 1]:  # equal strata are treated alike
        alone -= 1
    own = F.col("n") >= (most[alone - 1] if alone else (1 << 62))
    share = level / (alone + 1)
    strata = sizes.select(F.col("stratum"), own.alias("own"))
    spread = counted.join(strata.withColumnRenamed("stratum", "__s__"), F.col("stratum").eqNullSafe(F.col("__s__")))
    grid = [f"passed_{name}" for name in names]
    group = F.when(F.col("own"), F.struct("stratum")).alias("group")  # null: the shared certificate
    merged = spread.groupBy(group, *grid).agg(*[F.sum(c).alias(c) for c in ("chooses", "certifies", "bad")])
    ship_package(features.sparkSession)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        cuts = certify(rows, risk, share)
        return pd.DataFrame({"id": rows["id"].iloc[:1].to_numpy()} | {f"cut_{n}": np.array([c], float) for n, c in zip(names, cuts)})

    # strata are told apart by their JSON form, as a group's key may be null
    marked = merged.withColumn("id", F.coalesce(F.to_json("group", {"ignoreNullFields": "false"}), F.lit("")))
    found = marked.drop("group").groupBy("id").applyInPandas(one, "id string, " + ", ".join(f"cut_{n} double" for n in names))
    own_id = F.to_json(F.struct("stratum"), {"ignoreNullFields": "false"})
    named = strata.withColumn("id", F.when(F.col("own"), own_id).otherwise(F.lit("")))
    cuts = [F.when(~F.isnan(f"cut_{n}"), F.col(f"cut_{n}")).alias(f"cut_{n}") for n in names]
    return materialise(named.join(found, "id").select("stratum", "own", *cuts))


def judge(features: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Append base_failed and kept.

    Spark broadcasts the stored cutoffs if their size allows it.
    """
    cut = cutoffs.drop("own").withColumnRenamed("stratum", "__stratum__")
    above = [F.coalesce(value > F.col(f"cut_{name}"), F.lit(False)) for name, value in rules().items()]
    rejected = above[0]
    for x in above[1:]:
        rejected = rejected | x
    joined = features.join(cut, F.col(stratum).eqNullSafe(F.col("__stratum__")), "left")
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
        .drop("__stratum__", *[f"cut_{name}" for name in rules()])
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    max_false_rejection: float = 0.02,
    level: float = 0.05,
) -> DataFrame:
    """``key``, ``stratum``, FEATURES, base_failed and kept for each row of ``docs``.

    The texts are read once: their features are written and serve both the
    thresholds and the verdicts.
    """
    features = materialise(with_features(docs, text, keep=[key, stratum]))
    cutoffs = thresholds(features, labels, stratum, key, max_false_rejection=max_false_rejection, level=level)
    return judge(features, cutoffs, stratum)


def filter_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only.

    Texts are read twice, for the thresholds and for the verdicts; they are not shuffled.
    """
    cutoffs = thresholds(materialise(with_features(docs, text, keep=[key, stratum])), labels, stratum, key)
    own = [f"__{i}__" for i in range(len(docs.columns))]  # apart from the feature names
    safe = docs.toDF(*own)
    at = {c: n for c, n in zip(docs.columns, own)}
    judged = judge(with_features(safe, at[text]), cutoffs, at[stratum])
    return judged.where("kept").select(*[F.col(n).alias(c) for c, n in at.items()])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    judged = quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
