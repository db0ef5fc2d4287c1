"""Cases that the operators' tests share."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

#: Awkward texts: null, empty, blank, one word, repeats, other alphabets, long.
TEXTS = [
    None, "", " \n\t ", "word", "two words", "three word text", "a b c a b c a b c", "ÀÉ ß é x 日本語 текст",
    "line\nline\nother\nline", "x" * 5000, "the quick brown fox jumps over the lazy dog " * 200, "same text", "same text",
    "<|endoftext|> inside <|startoftext|>", "tab\tvt\x0bff\x0c nb sp\u0085nel  two\n\n three", "it's don't we'll I'VE 12 345 ²½",
]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
