from __future__ import annotations

import base64
import hashlib

import duckdb
import pytest

from petitionlens.llm import html_extract as H
from petitionlens.llm import warc as W

from corpus_cases import SF

FAKE = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\ngarbage"
PAGES = [
    (1, "http://a/ b\r\nx", "plain"), (2, None, None), (3, "u", ""), (4, "u", FAKE), (5, "u", FAKE), (None, "u", "plain"), (5, "u", FAKE),
    (6, "u", "WARC/1.1\r\n" * 5), (7, "u", "é" * 50_000 + "WARC/1.1\r\nContent-Length: 99999\r\n\r\n"), (8, "u", "\n\r\n"),
]


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_round_trip_of_awkward_payloads(spark, small_splits):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "1 AS id").repartition(3)
    got = sorted((tuple(r) for r in W.read_archives(spark, W.write_archives(pages, records=4)).collect()), key=str)
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = max(first.get(h or "", i), i)
    want = []
    for i, _, h in PAGES:
        data, top = (h or "").encode(), first[h or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "response" if i == top else "revisit", None if i == top else top))
    assert got == sorted(want, key=str)


def test_lookup_by_join_gives_the_same_roles(spark):
    pages = spark.createDataFrame(PAGES, "id long, url string, html string").selectExpr("id", "coalesce(html, '') AS payload")
    by_join = W.with_roles(pages, "id", "payload", few=0).select("id", "record_type", "refers_to").collect()
    assert sorted(by_join, key=str) == sorted(W.with_roles(pages, "id", "payload").select("id", "record_type", "refers_to").collect(), key=str)


def test_a_damaged_payload_fails_the_job(spark, tmp_path):
    path = W.write_archives(spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string"))
    text = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    broken = str(tmp_path / "broken")
    spark.createDataFrame([(t.replace("payload\r", "paylaod\r")[:-1],) for t in text], "value string").coalesce(1).write.text(broken)
    with pytest.raises(Exception, match="digest"):
        W.read_archives(spark, broken).collect()


def test_table_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(con.execute(W.OP3_SQL).fetchall(), key=str)
    assert sorted((tuple(r) for r in W.op3_warc(spark, SF).collect()), key=str) == want
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_archives(spark, W.write_archives(empty)).count() == 0


def test_blocks_of_awkward_markup():
    assert H.split_page(b"")[0] is None
    assert H.split_page(b"<article><h1>T</h1><p>a&amp;b <i>c</i>d&nbsp;e<br>f<script>var x='<p>';</script>g")[0] == "T a&b cd e f g"
    assert H.split_page(b"<article><p>x<nav>menu</nav>y<div class='comments'><p>said</div><form>in</form>z</article>")[0] == "x y z"
    assert H.split_page(b"<article><!-- <p>no --><p>yes</p><p>no end <b")[0] == "yes no end"
    assert H.split_page("<main>é 日本</main><p>out".encode())[0] == "é 日本"
    assert H.split_page(b"<article>caf\xff</article>")[0] == "caf�"


def test_repeated_runs_decide_outside_articles(spark):
    boil = "Read our cookie statement and subscribe to the weekly letter of this site, dear reader of ours. "
    page = "<html><body><div><p>{b}</p><div>Unique story number {i} tells of the {j}th sheep.</div><p>All rights reserved {b}</p></div></body></html>"
    rows = [(i, f"http://h.com/{i}", page.format(b=boil, i=i, j=i * i)) for i in range(6)]
    rows += [
        (10, "http://other.com/", f"<p>{boil} once only</p>"), (11, None, None), (None, "http://h.com/x", ""), (13, "u", "<p>a<p"),
        (12, "http://h.com/a", f"<nav>x</nav><article><p>{boil}</p></article><footer>{boil}"), (13, "u", "<p>a<p"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS key", "'y' AS stream").repartition(4)
    got = H.main_text(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"Unique story number {i} tells of the {i * i}th sheep." for i in range(6))
    assert text[10] == f"{boil}once only" and text[11] == "" == text[None] and text[12] == boil.strip() and text[13] == "a"
    assert all(r.n_chars == len(r.text) for r in got)


def test_articles_of_the_whole_table(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.url, r.text) for r in H.op6_html_extraction(spark, SF).collect()}
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", inner)]
        assert got[p.page_id] == (p.url, " ".join(x for x in parts if x))
    assert H.main_text(pages.limit(0)).count() == 0


def test_hosts_that_share_a_text_without_articles_keep_it(spark):
    words = lambda k, n: " ".join(f"{k}{i * i % 97}w{i}" for i in range(n))
    story = words("story", 60)
    rows = []
    for host in ("a", "b"):
        rows.append((len(rows), f"http://{host}.com/1", f"<div>{story}</div>"))
        # other pages of the host hold pieces of the story, each shorter than a repeated run, in other surroundings
        for at in range(0, len(story) - 60, 7):
            rows.append((len(rows), f"http://{host}.com/x{at}", f"<div>{words(f'{host}{at}p', 12)}{story[at : at + 60]}{words(f'{host}{at}q', 12)}</div>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")  # all groups of anchors meet in one task
        text = {r.url: r.text for r in H.main_text(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert text["http://a.com/1"] == story == text["http://b.com/1"]


def test_omitted_end_tags_are_implied():
    text = lambda x: H.split_page(b"<article>" + x + b"</article>")[0]
    assert text(b"<p class='ad'>buy <b>now</b><p>one<p class=promo>x<div>two</div>three<p class=ad>y<hr>four") == "one two three four"
    assert text(b"<ul><li class='share'>tweet <a>it<li>one<li class=ad><p>x<li><p>two</ul>end") == "one two end"
    assert text(b"<ul><li class='share'>a<ul><li>b</ul>c<li>out</ul>") == "out"  # an inner list ends nothing outside
    assert text(b"<dl><dt class=ad>x<dd>one<dd class=ad>y<dt>two</dl>") == "one two"
    assert text(b"<table><tr><td class=promo>x<td>one<tr class=ad><td>y<tr><td>two<tbody class=ad><tr><td>z<tbody><tr><td>three</table>") == "one two three"
    assert text(b"<p class=ad>x<table><tr><td>one</table>") == "one"
    assert text(b"<div class=ad><p>x<p>y</div>one") == "one"  # a paragraph's end leaves what holds it apart


@pytest.mark.parametrize(
    "page",
    [
        '<div class="content has-sidebar"><article><p>the story</p></article></div><div class="sidebar">links</div>',
        "<form><main><p>the story</p></main><button>go</button></form>",
        '<nav>menu</nav><main><div class="post-header-wrap"><p>the story</p></div></main>',
    ],
)
def test_wrappers_named_after_other_parts_do_not_hide_the_article(spark, page):
    rows = spark.createDataFrame([(1, "http://a/1", page)], "page_id long, url string, html string")
    assert [r.text for r in H.main_text(rows).collect()] == ["the story"]


def test_the_suffix_array_finds_the_template_inside_articles(spark):
    """A block that most articles of a host hold goes; a passage that few share, near copies and small hosts stay."""
    notice = "You are reading the free edition of this paper; readers who pay see it all, without waiting and without letters."
    shared = "A passage that two of the stories quote at length, word by word, since it is what the minister said on that day."
    story = lambda host, i: f"{host} story {i}: " + " ".join(f"{host}{i * j % 101}x{j}" for j in range(60))
    near = " ".join(f"copied{j}" for j in range(80))
    rows, want = [], {}

    def add(url, *blocks, kept):
        rows.append((len(rows), url, "<article>" + "".join(f"<p>{x}</p>" for x in blocks) + "</article>"))
        want[url] = " ".join(kept)

    for i in range(6):
        own = [story("a", i), *([shared] if i < 2 else [])]
        add(f"http://a.com/{i}", own[0], notice, *own[1:], kept=own)
        add(f"http://n.com/{i}", near, f"its version {i}", kept=[near, f"its version {i}"])
        own = [story("c", i), *([notice] if i < 3 else [])]
        add(f"http://c.com/{i}", *own, kept=own)  # no more than half
    for i in range(3):
        add(f"http://few.com/{i}", story("f", i), notice, kept=[story("f", i), notice])
        add(f"http://same.com/{i}", story("s", 0), notice, kept=[story("s", 0), notice])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.url: r.text for r in H.main_text(pages).collect()} == want


def test_blocks_that_runs_cover_whole():
    stream = b"0123456789\nabcdefghij\nxyz"
    cover = lambda s, e: [i for i, _ in H.covered_blocks(stream, s, e, 5)]
    assert cover([0], [5]) == [0] and cover([0], [4]) == [] and cover([8], [18]) == [1] and cover([0, 8], [8, 20]) == [0, 1, 2]


def test_adverts_and_related_articles_stay_apart(spark):
    page = '<article>real</article><div class="related"><article>other</article></div><form><article>sign up</article></form>'
    rows = spark.createDataFrame([(1, "http://a/1", page)], "page_id long, url string, html string")
    assert [r.text for r in H.main_text(rows).collect()] == ["real"]


def test_archives_follow_the_standards_grammar(spark):
    """Records parsed by the standard's grammar, with the fields that it makes mandatory."""
    import re

    rows = [(1, "http://a/", "same é"), (2, "http://b/", "same é"), (3, None, ""), (4, "http://c/", "WARC/1.1\r\nContent-Length: 3")]
    path = W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), date="2025-05-06T07:08:09Z")
    seen = {}
    for (content,) in spark.read.format("binaryFile").load(path).select("content").collect():
        data, at = bytes(content), 0
        while at < len(data):
            head = re.compile(rb"WARC/1\.[01]\r\n((?:[!-9;-~]+:[^\r\n]*\r\n)+)\r\n").match(data, at)
            fields = dict(line.split(b": ", 1) for line in head[1].split(b"\r\n")[:-1])
            end = head.end() + int(fields[b"Content-Length"])
            assert data[end : end + 4] == b"\r\n\r\n"
            assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date"} <= fields.keys() and fields[b"WARC-Date"] == b"2025-05-06T07:08:09Z"
            assert (b"WARC-Profile" in fields) == (fields[b"WARC-Type"] == b"revisit")
            seen[fields[b"WARC-Record-ID"]] = (fields[b"WARC-Type"], data[head.end() : end])
            at = end + 4
    assert seen == {
        b"<urn:page:1>": (b"revisit", b""), b"<urn:page:2>": (b"response", "same é".encode()),
        b"<urn:page:3>": (b"response", b""), b"<urn:page:4>": (b"response", b"WARC/1.1\r\nContent-Length: 3"),
    }
