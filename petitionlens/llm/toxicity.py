"""Convolutional text classifier for toxicity.

Words (ASCII lower case, cut at white space and ASCII punctuation) are hashed
to embeddings, whole and by their first four bytes, which inflected forms
share; the two are added.  Filters one, two and three words wide slide over the whole text
and keep their largest value; a linear layer gives the logit.  Everything is
trained in numpy on a bounded sample of labelled rows.  One embedding
coordinate for words and one for beginnings start as the log-odds of their
bucket, the rest at random.

A fold of the labelled rows is held back, and all of it calibrates one threshold
for each language with enough labels of both classes, as guessed from the text's function words; the score is the logit
less the threshold's, so 0.5 is the decision in every language.

Defined results: null and empty texts score like a text without any word;
null labels are not learnt from; without labels of both classes every score is
0; a null key counts as held out; texts are scored whole, in stretches.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, utf8, with_columns
from .decontaminate import words_of

BUCKETS = 1 << 16
DIM = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
#: (filter width, word offset) of the blocks of one stacked weight matrix
BLOCKS = [(k, j) for k in WIDTHS for j in range(k)]
STRETCH = 1 << 16
#: Calibration tells logits apart to one BINth.
BIN = 64
#: The row of zeros that pads a text's end.
PAD = 2 * BUCKETS
PADDING = np.full((max(WIDTHS) - 1, 2), PAD, np.int64)

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on with as this",
    "fr": "le la les de et des un une est dans pour que qui sur",
    "de": "der die das und ist nicht ein eine zu den mit von auf im",
    "es": "el los las y que del en por con para una su al se",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]


_CACHE: dict[bytes, int] = {}


def _pair(word: bytes) -> int:
    whole, start = zlib.crc32(word) % BUCKETS, BUCKETS + zlib.crc32(word[:4]) % BUCKETS
    return whole << 32 | start


def buckets(text: bytes) -> np.ndarray:
    """Rows (n words x 2) of the embedding table: the word's and its beginning's."""
    known, out = _CACHE, []
    if len(known) > 400_000:
        known.clear()
    for w in words_of(text):
        pair = known.get(w)
        if pair is None:
            pair = known[w] = _pair(w)
        out.append(pair)
    pairs = np.array(out, np.int64)
    return np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)


def language_table() -> np.ndarray:
    """Language number of each bucket that one language's function words alone fall in."""
    table = np.full(BUCKETS, len(FUNCTION_WORDS), np.int64)
    owners: dict[int, set[int]] = {}
    for i, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            owners.setdefault(zlib.crc32(w.encode()) % BUCKETS, set()).add(i)
    for b, langs in owners.items():
        if len(langs) == 1:
            table[b] = langs.pop()
    return table


def language(ids: np.ndarray, table: np.ndarray) -> int:
    """Number of the language with most function words in the text, "other" if none has any."""
    counts = np.bincount(table[ids[:, 0]], minlength=len(LANGUAGES))[:-1]
    return int(counts.argmax()) if counts.any() else len(LANGUAGES) - 1


class Model:
    def __init__(self, seed: int = 8):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.1, (2 * BUCKETS + 1, DIM)).astype(np.float32)
        self.embed[PAD] = 0
        self.filters = r.normal(0, 0.3, (DIM, len(BLOCKS), FILTERS)).astype(np.float32)
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = r.normal(0, 0.1, (len(WIDTHS), FILTERS)).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.threshold = np.zeros(len(LANGUAGES), np.float32)  # logits

    def windows(self, ids: np.ndarray) -> list[np.ndarray]:
        """Filter values at every position, one (positions x FILTERS) array for each width; ids end in padding."""
        y = (self.embed[ids[:, 0]] + self.embed[ids[:, 1]]) @ self.filters.reshape(DIM, -1)
        y = y.reshape(len(ids), len(BLOCKS), FILTERS)
        n = len(ids) - max(WIDTHS) + 1
        out, at = [], 0
        for k in WIDTHS:
            v = y[:n, at].copy()
            for j in range(1, k):
                v += y[j : n + j, at + j]
            out.append(v)
            at += k
        return out

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """Largest filter values over the whole text, stretch by stretch."""
        best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        for s in range(0, len(ids), STRETCH):
            part = ids[s : s + STRETCH + len(PADDING)]
            if s + STRETCH + len(PADDING) > len(ids):
                part = np.concatenate([part, PADDING])
            best = np.maximum(best, np.stack([v.max(axis=0) for v in self.windows(part)]))
        if not len(ids):
            best = np.zeros_like(best)
        return np.maximum(best + self.bias, 0)

    def logit(self, ids: np.ndarray) -> float:
        return float((self.pooled(ids) * self.out).sum() + self.shift[0])


def log_odds(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of a bucket's presence in toxic against other texts."""
    seen = np.zeros((2, 2 * BUCKETS))
    for ids, t in zip(texts, toxic):
        seen[int(t), np.unique(ids)] += 1
    n = np.bincount(toxic.astype(int), minlength=2)
    return np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 1) / (n[0] + 2))


def train(texts: list[np.ndarray], toxic: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.05, seed: int = 8) -> Model:
    """Adagrad on the log loss, classes weighted alike; only the windows that win a maximum get gradients."""
    m = Model(seed)
    odds = log_odds(texts, toxic)
    odds = np.clip(odds, -1, 4) / 4
    m.embed[:, :2] = 0
    for c, rows in enumerate((slice(0, BUCKETS), slice(BUCKETS, PAD))):
        m.embed[rows, c] = odds[rows]
        m.filters[:, 0, c] = 0
        m.filters[c, 0, c] = 1.0
        m.out[0, c] = 1.0
    r = np.random.default_rng(seed)
    weight = np.where(toxic, len(toxic) / max(1, 2 * toxic.sum()), len(toxic) / max(1, 2 * (~toxic).sum()))
    square = {name: np.full_like(getattr(m, name), 1e-6) for name in ("embed", "filters", "bias", "out", "shift")}
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for at in range(0, len(order), batch):
            g_filters = np.zeros_like(m.filters)
            g_bias, g_out, g_shift = np.zeros_like(m.bias), np.zeros_like(m.out), np.zeros_like(m.shift)
            rows, grads = [], []
            for i in order[at : at + batch]:
                ids = np.concatenate([texts[i], PADDING])
                if len(ids) < max(WIDTHS):
                    continue
                values = m.windows(ids)
                top = np.stack([v.argmax(axis=0) for v in values])  # width x filter
                raw = np.stack([v[t, np.arange(FILTERS)] for v, t in zip(values, top)]) + m.bias
                pool = np.maximum(raw, 0)
                p = 1 / (1 + np.exp(-float((pool * m.out).sum() + m.shift[0])))
                d = np.float32((p - toxic[i]) * weight[i] / batch)
                g_out += d * pool
                g_shift += d
                g = d * m.out * (raw > 0)
                g_bias += g
                for b, (k, j) in enumerate(BLOCKS):
                    w = WIDTHS.index(k)
                    words = ids[top[w] + j]
                    g_filters[:, b] += (m.embed[words[:, 0]] + m.embed[words[:, 1]]).T * g[w]
                    rows += [words[:, 0], words[:, 1]]
                    grads += [m.filters[:, b].T * g[w][:, None]] * 2
            for name, g in (("filters", g_filters), ("bias", g_bias), ("out", g_out), ("shift", g_shift)):
                square[name] += g * g
                getattr(m, name)[...] -= rate * g / np.sqrt(square[name])
            if rows:
                touched, back = np.unique(np.concatenate(rows), return_inverse=True)
                g = np.zeros((len(touched), DIM), np.float32)
                np.add.at(g, back, np.concatenate(grads))
                g[touched == PAD] = 0
                square["embed"][touched] += g * g
                m.embed[touched] -= rate * g / np.sqrt(square["embed"][touched])
    return m


def best_cut(x: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> float:
    """The cut with the fewest errors, in the middle of the widest gap among equals, for counts at rising logits ``x``."""
    right = np.r_[0, np.cumsum(other)] + toxic.sum() - np.r_[0, np.cumsum(toxic)]
    edges = np.r_[x[0] - 2, x, x[-1] + 2]
    gaps = edges[1:] - edges[:-1]
    best = np.flatnonzero(right == right.max())
    i = best[gaps[best].argmax()]
    return float((edges[i] + edges[i + 1]) / 2)


def best_threshold(logits: np.ndarray, toxic: np.ndarray, n: np.ndarray | None = None) -> float:
    """The best cut of logits that stand for ``n`` (default: one each) toxic or other texts."""
    n = np.ones(len(logits), np.int64) if n is None else n
    x, back = np.unique(logits, return_inverse=True)
    return best_cut(x, np.bincount(back, n * toxic, len(x)), np.bincount(back, n * ~toxic, len(x)))


def set_thresholds(m: Model, langs: np.ndarray, logits: np.ndarray, toxic: np.ndarray, n: np.ndarray, least: int = 30) -> None:
    """Set a threshold for each language with ``least`` texts of both classes; the others get the common one."""
    if not len(logits) or toxic.all() or not toxic.any():
        return
    m.threshold[:] = best_threshold(logits, toxic, n)
    for i in range(len(LANGUAGES)):
        own = langs == i
        if min(n[toxic & own].sum(), n[~toxic & own].sum()) >= least:
            m.threshold[i] = best_threshold(logits[own], toxic[own], n[own])


def calibrate(m: Model, texts: list[np.ndarray], toxic: np.ndarray, least: int = 30) -> None:
    """Thresholds from labelled texts at hand."""
    table = language_table()
    langs = np.array([language(x, table) for x in texts], np.int64)
    set_thresholds(m, langs, np.array([m.logit(x) for x in texts]), toxic, np.ones(len(texts), np.int64), least)


def calibrate_on(m: Model, docs: DataFrame, labels: DataFrame, key: str, text: str) -> None:
    """Thresholds from all labelled rows of fold 1, scored in tasks; counts per language and BINth of a logit reach the driver."""
    held = docs.sparkSession.sparkContext.broadcast(m)

    def run(texts: list[bytes]) -> dict[str, object]:
        table, langs, bins = language_table(), [], []
        for t in texts:
            ids = buckets(t)
            langs.append(language(ids, table))
            bins.append(round(BIN * min(50.0, max(-50.0, held.value.logit(ids)))))
        return {"__lang__": langs, "__bin__": bins}

    own = docs.where(fold(key) == 1)
    scored = with_columns(own, utf8(text), run, "__lang__ int, __bin__ int", keep=[key])
    scored = scored.groupBy(key).agg(F.min(F.struct("__lang__", "__bin__")).alias("__at__"))
    known = labels.where((fold(key) == 1) & F.col("toxic").isin(0, 1)).select(key, "toxic").distinct()
    rows = known.join(scored, key).groupBy("__at__.__lang__", "__at__.__bin__", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    lang, at, toxic, n = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4).T
    set_thresholds(m, lang, at / BIN, toxic == 1, n)


def fold(key: str) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: int, rows: int, longest: int) -> list[np.ndarray]:
    """Word buckets of at most ``rows`` labelled rows of one class from the training folds, chosen by a hash of the key.

    Texts above ``longest`` bytes are scored but not learnt from, which bounds what reaches the driver.
    """
    own = labels.where((F.col("toxic") == toxic) & (fold(key) > 1)).select(key).distinct()
    picked = own.orderBy(F.xxhash64(key), key).limit(rows)
    found = docs.select(key, utf8(text).alias("data")).where(F.length("data") <= longest).join(F.broadcast(picked), key)
    found = found.groupBy(key).agg(F.min("data").alias("data")).select("data")
    return [buckets(bytes(r["data"])) for r in found.toLocalIterator()]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = 1200, longest: int = 20_000) -> Model | None:
    """A model from at most ``rows`` toxic and 2 * ``rows`` other labelled texts of folds 2 to 4, calibrated on all of fold 1.

    Returns None without labels of both classes.
    """
    got = [(ids, c == 1) for c in (1, 0) for ids in sample(docs, labels, key, text, c, rows * (2 - c), longest)]
    got.sort(key=lambda x: x[0].tobytes())
    texts, toxic = [ids for ids, _ in got], np.array([t for _, t in got], bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return None
    m = train(texts, toxic)
    calibrate_on(m, docs, labels, key, text)
    return m


def toxicity(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, score, predicted for each row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> dict[str, object]:
        m = held.value
        if m is None:
            return {"score": [0.0] * len(texts)}
        table = language_table()
        out = []
        for t in texts:
            ids = buckets(t)
            out.append(1 / (1 + np.exp(-np.clip(m.logit(ids) - m.threshold[language(ids, table)], -50, 50))))
        return {"score": np.array(out, float)}

    scored = with_columns(docs, utf8(text), run, "score double", keep=[key])
    return scored.select(
        key, F.coalesce(fold(key) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, read_table(spark, sf_dir, "labels")))
