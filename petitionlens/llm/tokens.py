"""Token ids of whole texts, as the tokenizers library gives them, by a faster encoder where it is proven to agree."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Characters whose classes (letter, digit, white space) are the same in every library and Unicode version.
OTHER = re.compile(r"[^\t-\r -~\xa0-\u024f]")

#: A space beside other white space, where the cut depends on what follows.
ADJOINING = re.compile(r"[\t-\r \x85\xa0] | [\t-\r \x85\xa0]")

#: What the fast paths stand for; a file that says otherwise is left to its library.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
PLAIN_MERGES = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False,
    "ignore_merges": False,
}

#: How byte-level vocabularies cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries of a worker's cache of merged words.
CACHE = 400_000


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def holds(part: dict | None, wanted: dict) -> bool:
    """Whether a part of a tokenizer file says what is ``wanted``; a missing or empty value stands for None."""
    return part is not None and all((part.get(k) or None) == (v or None) for k, v in wanted.items())


def is_byte_level(file: dict) -> bool:
    """No normaliser, the usual byte-level cut, and merges alone."""
    merges = PLAIN_MERGES | {"end_of_word_suffix": None}
    return file.get("normalizer") is None and holds(file.get("pre_tokenizer"), BYTE_LEVEL) and holds(file.get("model"), merges)


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + i)
    return table


BYTE_CHAR = byte_alphabet()


def as_byte_chars(text: str) -> str:
    return text.encode().decode("latin-1").translate(BYTE_CHAR)


def rank_encoder(tokenizer):
    """The vocabulary as a tiktoken encoding, which merges several times faster.

    It merges by smallest id; that is the file's own order only if the ids of
    the merges rise, which is checked, as is how the file prepares and cuts
    texts.  None otherwise.
    """
    file = json.loads(tokenizer.to_str())
    if not is_byte_level(file):
        return None
    model = file["model"]
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(x >= y for x, y in zip(made, made[1:])):
        return None
    import tiktoken

    byte_of = {c: b for b, c in BYTE_CHAR.items()}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {bytes(byte_of[c] for c in w): i for w, i in vocabulary.items() if w not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteLevelIds:
    """``ids(text)`` for a byte-level BPE file: little-endian unsigned 32-bit ids, as bytes.

    Texts of the known ranges without a special token's string go to the rank
    encoder, where one fits the file; the others to the file's own library.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = rank_encoder(self.tokenizer)
        self.sizes: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, text: str) -> int:
        """The number of ids of ``text``.

        A space between two characters that are no white space begins a new
        piece wherever it stands, so what stands between such spaces can be
        counted apart, and each distinct stretch once (a bounded cache, whose
        older half gives way).
        """
        if self.ranks is None or OTHER.search(text) or ADJOINING.search(text) or any(s in text for s in self.special):
            return len(self.ids(text)) // 4
        encode = self.ranks.encode_ordinary
        first, *rest = text.split(" ")
        total = len(encode(first))
        sizes = list(map(self.sizes.get, rest))
        if None not in sizes:
            return total + sum(sizes)
        if len(self.sizes) > CACHE:
            self.older, self.sizes = self.sizes, {}
        known, older = self.sizes, self.older
        for part, n in zip(rest, sizes):
            if n is None and (n := known.get(part)) is None:
                n = older.get(part)
                known[part] = n = len(encode(" " + part)) if n is None else n
            total += n
        return total

    def ids(self, text: str) -> bytes:
        if self.ranks is None or OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


_LOADED: dict[tuple[type, str], object] = {}


def shared(kind: type, path: str):
    """One instance per worker process."""
    key = (kind, path)
    if key not in _LOADED:
        _LOADED[key] = kind(path)
    return _LOADED[key]
