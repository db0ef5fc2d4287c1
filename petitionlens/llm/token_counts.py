"""Token counts by the whole-token shortcut.

Offline, each vocabulary string that ends a word is run through the library's
merges; those that come out as that one token are proven.  A text is cut into
pre-tokens; every proven one counts one, and only the others are merged, each
distinct one once (bounded cache).  Texts with characters outside the ranges of
``tokens`` or with a special token's string are counted by the library whole, and
so are all texts if the file prepares or cuts them in another way than this one.

Defined results: null and empty texts have no bytes and no tokens; repeated
rows are counted alike; texts are read whole, however long.
"""

from __future__ import annotations

import json
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, utf8, with_columns
from .tokens import BYTE_CHAR, BYTE_LEVEL, CACHE, PLAIN_MERGES, as_byte_chars, holds, load, shared

#: As in ``tokens``, up to U+017F and without U+0130, whose lower case is two characters.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
DIGIT = "0-9²³¹¼-¾"
SPACE = "\t-\r \u0085 "
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^{SPACE}{LETTER}{DIGIT}]+")
OTHER = re.compile("[^\t-\r -~ -įı-ſ]")


#: How the file makes words of a text.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


def has_words(tokenizer, end: str) -> bool:
    """Whether the file lower-cases texts, cuts them into words as ``WORDS`` does and merges those with ``end``."""
    file = json.loads(tokenizer.to_str())
    steps = (file.get("normalizer") or {}).get("normalizers") or []
    cuts = (file.get("pre_tokenizer") or {}).get("pretokenizers") or []
    wanted = [SPLIT, BYTE_LEVEL | {"use_regex": False}]
    if steps != NORMALIZERS or len(cuts) != len(wanted) or not all(holds(c, w) for c, w in zip(cuts, wanted)):
        return False
    return holds(file.get("model"), PLAIN_MERGES | {"end_of_word_suffix": end})


def proven_words(path: str, end: str = "</w>") -> frozenset[str]:
    """Lower-case words that the vocabulary holds and that its merges make one token; none of a file without such words."""
    tokenizer = load(path)
    if not has_words(tokenizer, end):
        return frozenset()
    merge = tokenizer.model.tokenize
    byte_of = {c: b for b, c in BYTE_CHAR.items()}
    found = set()
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if not token.endswith(end):
            continue
        try:
            word = bytes(byte_of[c] for c in token[: -len(end)]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if word and not OTHER.search(word) and word.lower() == word and WORDS.fullmatch(word) and WORDS.match(word).end() == len(word):
            if [t.id for t in merge(as_byte_chars(word))] == [number]:
                found.add(word)
    return frozenset(found)


class WordCounter:
    """``count(text)`` for a lower-casing BPE file with word ends."""

    def __init__(self, path: str, end: str = "</w>"):
        self.tokenizer = load(path)
        self.words = has_words(self.tokenizer, end)
        self.merge = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}

    def count(self, text: str, proven: frozenset[str]) -> int:
        if not self.words or OTHER.search(text) or any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        total, known = 0, self.known
        for word, n in Counter(WORDS.findall(text.lower())).items():
            if word in proven:
                total += n
                continue
            size = known.get(word)
            if size is None:
                if len(known) > CACHE:
                    known.clear()
                size = known[word] = len(self.merge(as_byte_chars(word)))
            total += n * size
        return total


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """``key``, n_bytes, n_tokens, over_limit.  The proven words are broadcast; the vocabulary bounds them."""
    proven = docs.sparkSession.sparkContext.broadcast(proven_words(path))

    def run(texts: list[bytes]) -> dict[str, object]:
        counter = shared(WordCounter, path)
        words = proven.value
        return {
            "n_bytes": [len(t) for t in texts],
            "n_tokens": [counter.count(t.decode("utf-8", "replace"), words) for t in texts],
        }

    counted = with_columns(docs, utf8(text), run, "n_bytes long, n_tokens long", keep=[key])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
