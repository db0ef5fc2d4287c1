"""Main text of web pages, with a suffix array over each host's text outside articles.

Markup decides what it can: the blocks inside <article> or <main>, without the
menus, asides, forms, adverts, notices and comments in them, are the main text,
and elements whose name, class, id or role names such a part are not.  Where that
leaves no article at all, names of several parts (``has-sidebar``) are taken
whole and a form may hold the article, so that no wrapper hides it.  What
stands outside both is undecided.  On pages without an article the undecided
blocks are the only text, and there repetition decides: the streams of all
blocks outside articles of a host's pages go through the suffix-array search,
and every run of ``length`` bytes that distinct pages of the host share is
boilerplate; the unique rest of the undecided blocks is kept.

The same search judges the text inside articles.  Pages may share passages, so
being repeated is not enough there: a block goes as a template's only if runs of
one and a half times ``length`` bytes that other articles of the host hold cover
it whole, the same block stands in more than half of the host's distinct
articles, FEW at least, and such blocks are not over half of the article, as in
near copies.  Only articles with an anchor that as many articles hold go to the
suffix array: blocks of a run's length or more that so many share always have
one; shorter ones count where what stands beside them is shared too.

Defined results: null and empty html gives the empty text; a page cut off
inside a tag or an element is read as far as it goes; omitted end tags of
paragraphs, list items, table cells, rows and options are implied; pages without a URL form
one host; identical streams of two pages are boilerplate as a whole; repeated
rows are treated each; a page of any size is parsed whole, and an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Batches, arrow_schema, map_batches, materialise, read_table, rows_batch, utf8
from .suffix_dedup import Passage, anchor_runs, repeated_runs

#: What HTML names and what sites call the parts around the main text.
RAW = {"script", "style", "template", "noscript", "textarea", "iframe", "svg", "title", "object"}
APART = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "select", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: What a tag that begins ends, if it is open: (names, names that hide it).
SCOPE = {"table", "td", "th", "caption", "button", "object", "template"}
LISTS = {"ul", "ol", "menu", "dl", *SCOPE, "article", "main", "section", "aside", "nav", "header", "footer", "form", "blockquote"}
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "ul",
}
GROUPS = {"thead", "tbody", "tfoot"}
SIBLINGS = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, LISTS), "dd": ({"dt", "dd"}, LISTS), "tr": ({"tr"}, {"table", *GROUPS}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select", "datalist"}),
    **dict.fromkeys(sorted(GROUPS), ({"tr", *GROUPS}, {"table"})),
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "gdpr", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup",
    "promo", "related", "replies", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar",
}

#: Fewest articles of a host that can show what its template is.
FEW = 4

TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)


def is_apart(name: str, attributes: str, whole: bool = False) -> bool:
    """Whether an element's name, role, class or id says so; ``whole``: class and id names count unsplit."""
    if name in APART:
        return True
    if name in ("html", "body", "article", "main") or "=" not in attributes:
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        words = value.lower().strip("\"'").split() if whole else re.split(r"[^a-z0-9]+", value.lower())
        if not (ROLES if key.lower() == "role" else NAMES).isdisjoint(words):
            return True
    return False


def implied_end(open_names: list[str], names: set[str], hides: set[str]) -> int | None:
    """Depth of the innermost open element of ``names`` that no later one of ``hides`` hides."""
    for depth in range(len(open_names) - 1, -1, -1):
        if open_names[depth] in names:
            return depth
        if open_names[depth] in hides:
            return None
    return None


def blocks(page: str, lenient: bool = False) -> list[tuple[str, int]]:
    """(text, kind) of the blocks in page order; kind 2: in an article, 1: undecided, 0: apart.

    ``lenient`` takes class and id names whole (``has-sidebar`` is no sidebar)
    and an article in a form for an article.
    """
    out: list[tuple[str, int]] = []
    text: list[str] = []
    open_names: list[str] = []
    apart = inside = None  # depth of the element that began it
    at = 0

    def end_block() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                out.append((" ".join(words), 0 if apart is not None else 2 if inside is not None else 1))

    def close(depth: int) -> None:
        nonlocal apart, inside
        if apart is not None and depth <= apart:
            end_block()
            apart = None
        if inside is not None and depth <= inside:
            end_block()
            inside = None
        del open_names[depth:]

    while m := TAG.search(page, at):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name not in INLINE:
            end_block()
        if m[1]:
            if name in open_names:
                close(len(open_names) - 1 - open_names[::-1].index(name))
            continue
        while name in SIBLINGS and (depth := implied_end(open_names, *SIBLINGS[name])) is not None:
            close(depth)
        if name in ENDS_P and (depth := implied_end(open_names, {"p"}, SCOPE)) is not None:
            close(depth)
        if name in VOID or m[3].endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if lenient and name in ("article", "main") and apart is not None and open_names[apart] == "form":
            end_block()
            apart = None
        if apart is None and is_apart(name, m[3], lenient):
            end_block()
            apart = len(open_names)
        if inside is None and apart is None and name in ("article", "main"):
            inside = len(open_names)
        open_names.append(name)
    text.append(page[at:])
    end_block()
    return out


def split_page(data: bytes) -> tuple[str | None, bytes, list[int], bytes | None]:
    """The main text (None without an article), the stream of the other blocks, the bounds of the undecided ones in it,
    and the stream of the article's blocks."""
    main, stream, bounds, size, found = [], [], [], 0, False
    page = data.decode("utf-8", "replace")
    parts = blocks(page)
    if all(kind < 2 for _, kind in parts):  # wrappers named after what they stand beside may hide the article
        again = blocks(page, lenient=True)
        parts = again if any(kind == 2 for _, kind in again) else parts
    for text, kind in parts:
        if kind == 2:
            main.append(text)
            found = True
            continue
        raw = text.encode()
        if kind == 1:
            bounds += [size, size + len(raw)]
        stream.append(raw)
        size += len(raw) + 1
    return " ".join(main) if found else None, b"\n".join(stream), bounds, "\n".join(main).encode() if found else None


def keep_unique(stream: bytes, bounds: list[int], starts: list[int], ends: list[int], length: int) -> str:
    """Undecided blocks less the repeated runs, where a run covers the whole block or ``length`` bytes of it.

    A run that only reaches into a block from its neighbour leaves it alone; a
    character that is cut is dropped.
    """
    merged: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e + length)
        else:
            merged.append([s, e + length])
    out = []
    for lo, hi in zip(bounds[::2], bounds[1::2]):
        parts, at = [], lo
        for s, e in merged:
            s, e = max(s, lo), min(e, hi)
            if e - s >= min(length, hi - lo):
                parts.append(stream[at:s])
                at = e
        parts.append(stream[at:hi])
        words = b" ".join(parts).decode("utf-8", "ignore").split()
        if words:
            out.append(" ".join(words))
    return " ".join(out)


def covered_blocks(stream: bytes, starts: list[int], ends: list[int], length: int) -> list[tuple[int, bytes]]:
    """Number and digest of each block that runs of windows, which begin at ``starts`` to ``ends``, cover whole."""
    merged: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e + length)
        else:
            merged.append([s, e + length])
    out, at, run = [], 0, 0
    for i, block in enumerate(stream.split(b"\n")):
        while run < len(merged) and merged[run][1] < at + len(block):
            run += 1
        if run < len(merged) and merged[run][0] <= at:
            out.append((i, hashlib.sha256(block).digest()[:16]))
        at += len(block) + 1
    return out


def without_template(article: str, numbers: list[int] | None) -> str:
    """The article's blocks but those of ``numbers``, which all stay if they are more than half of it."""
    parts = article.split("\n")
    gone = set(numbers or [])
    if 2 * sum(len(parts[i]) for i in gone) > sum(map(len, parts)):
        gone = set()
    return " ".join(x for i, x in enumerate(parts) if i not in gone)


def template_blocks(heads: DataFrame, articles: DataFrame, inner: Passage) -> DataFrame:
    """art, numbers: the blocks of each article that its host's template put there.

    ``heads`` has art (the article's identity), scope and grams (its anchors)
    once for each distinct article, ``articles`` art, scope and the stream of every page.
    """
    sizes = heads.groupBy("scope").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FEW)

    def usual(found: DataFrame, by: str) -> DataFrame:
        """The (scope, ``by``) of more than half of a host's articles, FEW at least."""
        counted = found.groupBy("scope", by).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= FEW)
        return counted.join(sizes, "scope").where(2 * F.col("m") > F.col("n")).select("scope", by)

    grams = heads.select("art", "scope", F.explode("grams").alias("h"))
    asked = materialise(grams.join(materialise(usual(grams, "h")), ["scope", "h"]).select("art").distinct())
    texts = materialise(articles.join(asked, "art").groupBy("art").agg(F.first("scope").alias("scope"), F.first("data").alias("data")))
    texts = texts.withColumnRenamed("art", "tkey")
    runs = repeated_runs(texts, inner, across=True)
    lists = runs.groupBy("tkey").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    kind = StructType.fromDDL("art binary, scope long, number int, block binary")
    schema = arrow_schema(kind)

    def cover(batches: Batches) -> Batches:
        for b in batches:
            for key, scope, data, starts, ends in zip(*[c.to_pylist() for c in b.columns]):
                yield rows_batch([(key, scope, i, block) for i, block in covered_blocks(data, starts, ends, inner.length)], schema)

    found = materialise(map_batches(texts.join(lists, "tkey").select("tkey", "scope", "data", "starts", "ends"), cover, kind))
    common = usual(found.select("art", "scope", "block").distinct(), "block")
    return found.join(common, ["scope", "block"]).groupBy("art").agg(F.collect_list("number").alias("numbers"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", length: int = 64) -> DataFrame:
    """``key``, ``url``, text, n_chars of each row of ``pages``.

    The pages are parsed three times, for the streams and anchors, for the
    articles that the suffix array judges, and for the texts; only streams,
    anchors, such articles and pages without one are moved.
    """
    inner = Passage(length + length // 2, 16, 4)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.xxhash64(host).alias("scope"), utf8(source).alias("data"))
    parsed_kind = StructType.fromDDL(
        f"key {pages.schema[key].dataType.simpleString()}, url string, scope long, article binary, stream binary, bounds array<long>,"
        " other boolean, art binary, grams array<long>"
    )
    parsed_schema = arrow_schema(parsed_kind)

    def parse(with_text: bool):
        def batch(rows: list[tuple], articles: list[bytes | None]):
            marks: list[set[int]] = [set() for _ in rows]
            if not with_text:
                for i, _, _, _, h in anchor_runs([x or b"" for x in articles], inner):
                    marks[i].add(h)
            arts = [None if x is None else hashlib.sha256(x + str(r[2]).encode()).digest()[:16] for r, x in zip(rows, articles)]
            return rows_batch([(*r, art, sorted(m) or None) for r, art, m in zip(rows, arts, marks)], parsed_schema)

        def run(batches: Batches) -> Batches:
            for b in batches:
                rows, articles, size = [], [], 0
                for k, u, scope, data in zip(*[c.to_pylist() for c in b.columns]):
                    _, stream, bounds, article = split_page(data)
                    other = article is None
                    if with_text:
                        rows.append((k, u, scope, article, None, None, other))
                    else:
                        rows.append((k if other else None, u if other else None, scope, None, stream, bounds if other else None, other))
                    articles.append(article)
                    size += len(data)
                    if size > 8 << 20:
                        yield batch(rows, articles)
                        rows, articles, size = [], [], 0
                yield batch(rows, articles)

        return map_batches(own, run, parsed_kind)

    identity = F.substring(F.unhex(F.sha2(F.concat(F.col("stream"), F.col("scope").cast("string").cast("binary")), 256)), 1, 16)
    first = materialise(parse(False).withColumn("tkey", identity))
    streams = first.where(F.length("stream") >= length).groupBy("tkey")
    streams = materialise(streams.agg(F.first("scope").alias("scope"), F.first("stream").alias("data"), (F.count(F.lit(1)) > 1).alias("copied")))
    runs = repeated_runs(streams, Passage(length, 16, 4), across=True)
    lists = runs.groupBy("tkey").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    lists = streams.where("copied").select("tkey", "copied").join(lists, "tkey", "full")
    kind = StructType.fromDDL(f"key {pages.schema[key].dataType.simpleString()}, url string, text string")
    schema = arrow_schema(kind)

    def trim(batches: Batches) -> Batches:
        for b in batches:
            rows = []
            for k, u, stream, bounds, copied, starts, ends in zip(*[c.to_pylist() for c in b.columns]):
                if copied and len(stream) >= length:
                    starts, ends = [0], [len(stream) - length]
                rows.append((k, u, keep_unique(stream, bounds, starts or [], ends or [], length)))
            yield rows_batch(rows, schema)

    heads = first.where(F.col("art").isNotNull()).groupBy("art").agg(F.first("scope").alias("scope"), F.first("grams").alias("grams"))
    parsed = parse(True).where(~F.col("other"))
    template = materialise(template_blocks(materialise(heads), parsed.select("art", "scope", F.col("article").alias("data")), inner))

    def assemble(batches: Batches) -> Batches:
        for b in batches:
            rows = [(k, u, without_template(a.decode(), numbers)) for k, u, a, numbers in zip(*[c.to_pylist() for c in b.columns])]
            yield rows_batch(rows, schema)

    articles = map_batches(parsed.join(template, "art", "left").select("key", "url", "article", "numbers"), assemble, kind)
    undecided = first.where("other").join(lists, "tkey", "left")
    undecided = map_batches(undecided.select("key", "url", "stream", "bounds", "copied", "starts", "ends"), trim, kind)
    both = articles.union(undecided)
    return both.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return main_text(read_table(spark, sf_dir, "pages"))
