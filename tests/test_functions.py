"""Column functions on edge rows, against plain Python where that defines the result."""

import re
from html import unescape
from urllib.parse import unquote, urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lingmill.functions import tags, text, urls
from lingmill.functions.blocks import page_blocks

#: Text of a block, and the lines that cleaning leaves of it.
CLEANED = [
    ("", []),
    ("a b " * 12 + "x", []),  # 49 characters
    ("a b " * 12 + "xy", ["a b " * 12 + "xy"]),  # 50 characters
    ("a" * 95 + "12345", ["a" * 95 + "12345"]),  # exactly 0.95 small letters
    ("a" * 96 + "1234", []),
    ("b" * 50 + " " * 3 + "c", []),  # b counts twice
    ("p" * 60, ["p" * 60]),  # p does not count
    ("A" * 20 + "1" * 80, ["A" * 20 + "1" * 80]),  # exactly 0.2 capitals
    ("A" * 21 + "1" * 79, []),
    ("word " * 12 + "...", []),
    ("word " * 12 + "…", ["word " * 12 + "…"]),
    ("  " + "Word one, " * 6 + " ", [("Word one, " * 6).strip()]),
    ("Word  one　two " * 5, [("Word one two " * 5).strip()]),
    ("x\x1c" + "Word one, " * 6 + "\x1c", ["x " + ("Word one, " * 6).strip()]),
    ("سلام " * 12, [("سلام " * 12).strip()]),
    ("Word   one  " * 5, [("Word one " * 5).strip()]),  # 50 only before blanks are folded
    ("Some words stand here, and some more stand there too.\n" * 2 + "  short\n\n", ["Some words stand here, and some more stand there too."]),
    ("\U0001f600 " * 30, [("\U0001f600 " * 30).strip()]),
]


def _cleaned(spark, blocks):
    df = spark.createDataFrame(list(enumerate(blocks)), "i int, t string").coalesce(1)
    got = {r.i: r.c for r in df.select("i", text.clean_block(F.col("t")).alias("c")).collect()}
    return [got[i] for i in range(len(blocks))]


def test_clean_block_edges(spark):
    for (block, want), got in zip(CLEANED, _cleaned(spark, [b for b, _ in CLEANED])):
        assert got == want, block


@settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="abpB .\n  \x1cA!e", min_size=40, max_size=160), min_size=60, max_size=100))
def test_clean_block_properties(spark, blocks):
    once = _cleaned(spark, blocks)
    for block, lines in zip(blocks, once):
        assert len(set(lines)) == len(lines)
        for line in lines:
            assert line == line.strip() and not re.search(r"\s\s", line) and not line.endswith("...")
            assert re.sub(r"\s", "", line) in re.sub(r"[^\S\n]", "", block)
    # the order of blocks does not matter, nor does a line that is there again
    assert _cleaned(spark, blocks[::-1]) == once[::-1]
    assert _cleaned(spark, [f"{b}\n{b}" for b in blocks]) == once


def test_marks_and_options(spark):
    line = "Plain words without any of them at all " * 2
    df = spark.createDataFrame([(line,), (line + "now, then.",)], "t string")
    kept = df.select(F.size(text.clean_block(F.col("t"), min_marks=1)).alias("n")).collect()
    assert [r.n for r in kept] == [0, 1]
    p = spark.createDataFrame([("p" * 60,)], "t string")
    assert p.select(F.size(text.clean_block(F.col("t"), alphabet="ascii"))).first()[0] == 0


def test_sentences(spark):
    rows = [("One two. Three!  Four",), ("",), ("  ",), ("No end",), ("A.  B? C",), ("a  b",)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select("t", text.sentences(F.col("t")).alias("s"), text.sentence_counts(F.col("t")).alias("n")).collect()
    for r in out:
        assert r.n.sentences == len(r.s)
        assert r.n.words == sum(len(s.split(" ")) for s in r.s)
        assert r.n.characters == sum(map(len, r.s))


def test_paragraphs(spark):
    df = spark.createDataFrame([("one\ntwo\n• three\n\n last\n",)], "t string")
    assert df.select(text.paragraphs(F.col("t"))).first()[0] == ["onetwo\n• three", "last"]


BASES = [
    "http://a.com", "http://a.com/", "http://a.com/b/c/d", "https://u@a.com:80/b/c/?q=1",
    "http://a.com/b//c/d;p?x#f", "http://a.com/b/..", "http://www.A.com/x/y.html?a/b",
]
HREFS = [
    "x", "/x", "../x", "../../../../x", "./", ".", "..", "./x", "//other/x", "?q=1", "?", "#a", "mailto:a@b",
    "http://c.com/../x", "HTTP://c.com/X", "https:/z", "http:z", "//", "///x", "x/./y/../z", "/a/../../b", "/a//b",
    "a//b", "  /sp", " x\ty\n", "x?", "x#", "/..", "/.", "a/..", "a/.", "..?q", "x;p", "/x;", "javascript:void(0)",
    "x:y", "////", "///", "//;", "b/c?d=../e", "//other?x", "/a/b/..#f", "http:", "http://", "//?x", "", "/été",
]


def _resolved(spark, pairs):
    df = spark.createDataFrame(pairs, "b string, h string")
    return [r.r for r in df.select(urls.resolve(F.col("b"), F.col("h")).alias("r")).collect()]


def test_resolve(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    assert _resolved(spark, pairs) == [urljoin(b, h) for b, h in pairs]


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab./?#;:", max_size=12), min_size=60, max_size=120))
def test_resolve_random(spark, hrefs):
    pairs = [(b, h) for b in BASES[2:4] for h in hrefs if not re.match("[a-z]+:", h)]
    if pairs:
        assert _resolved(spark, pairs) == [urljoin(b, h) for b, h in pairs]


def test_percent_decode(spark):
    values = ["a%20b", "a+b", "%", "%zz", "100%", "%C3%A9", "%41%", "%2B", "plain"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(urls.percent_decode(F.col("v"))).collect()] == [unquote(v) for v in values]


def test_url_parts(spark):
    df = spark.createDataFrame([("HTTPS://user@www.My_Host.org:8080/a?b",), ("no url",)], "u string")
    u = F.col("u")
    row = df.select(urls.netloc(u), urls.origin(u), urls.domain(u), urls.robots_url(u), urls.registered_domain(u)).first()
    assert row[0] == "user@www.My_Host.org:8080"
    assert row[1] == "https://user@www.My_Host.org:8080"
    assert row[3] == row[1] + "/robots.txt"
    assert row[4] == "my_host.org"


@pytest.mark.parametrize(
    "html, index, follow",
    [
        ('<meta name="robots" content="NOINDEX">', False, True),
        ("<META CONTENT='noindex,nofollow' NAME=robots>", False, False),
        ('<meta name="robots" content="none">', True, True),
        ('<meta name="robots" content=""><meta name="robots" content="noindex">', True, True),
        ('<meta name="robots" content="all"><meta name="robots" content="noindex">', True, True),
        ('<!-- <meta name="robots" content="noindex"> -->', True, True),
        ('<meta name="other" content="noindex">', True, True),
        ('<meta name="robots" content="NOARCHIVE,NOCACHE" />', True, True),
        ('<meta data-x="name=robots" content="noindex">', True, True),
        ("", True, True),
        (None, False, False),
    ],
)
def test_robots_meta(spark, html, index, follow):
    df = spark.createDataFrame([(html,)], "h string").select(tags.robots_directives(F.col("h")).alias("m"))
    row = df.first().m
    assert (row.can_index, row.can_follow) == (index, follow)


def test_hrefs(spark):
    html = (
        "<a href=one>1</a><A title='a>b' HREF = \"two\">2</A><!-- <a href=no>x</a> --><abbr href=no></abbr>"
        "<script>var s = '<a href=no>';</script><a data-href=no>3</a><a href='?x=1&amp;y=2'\n>4</a><a href=''>5</a>"
        "<a href='a' href='b'>6</a>"
    )
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(tags.hrefs(F.col("h"))).first()[0] == ["one", "two", "?x=1&y=2", "", "b"]


@pytest.mark.parametrize(
    "html, want, want_html5",
    [
        ("<p>one<p>two</p>", ["onetwo"], ["one", "two"]),
        ("<p>a <span>b</span> c</p>", ["a b c"], None),
        ("<div>no</div><ul><li>no</li></ul>", [], None),
        ("<div><h2>yes</h2>no<span>and</span></div>", ["yes", "and"], None),
        ("<p>a<br>b<img src=x>c</p>", ["abc"], None),
        ("<p>a<script>no()</script><style>p{}</style><!-- no -->b</p>", ["ab"], None),
        ("<p>&lt;&amp;&eacute;&#233;&#xe9;&nosuch;</p>", ["<&ééé&nosuch"], None),
        ("<p>a<b>c</p>d</b><p>e</p>", ["ac", "e"], None),
        ("<article><p>open</article><p>next</p>", ["open", "next"], None),
        ("<p>a</div>b</p>", ["ab"], None),
        ("<p>open to the end", ["open to the end"], None),
        ("<template><p>no</p></template><p>y<rt>no</rt></p>", ["", "y"], None),
        ("<p></p>", [""], None),
        ("", [], None),
        (None, [], None),
    ],
)
def test_blocks(html, want, want_html5):
    assert page_blocks(html) == want
    assert page_blocks(html, html5=True) == (want_html5 or want)


def test_references_are_those_of_the_standard_library(spark):
    values = [
        "/p?a=1&#038;b=2", "/r?a&#x26;b", "/caf&eacute;", "/caf&eacutex", "&notit;", "&amp", "a&b", "&#0;&#128;&#xD800;",
        "&#99999999999;&#11;&#x1F600;", "&nope;", "&", "&&amp;&", "&acE;", "none",
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    assert [r[0] for r in df.select(tags.decode_entities(F.col("v"))).collect()] == [unescape(v) for v in values]


def test_long_tags_take_no_stack(spark):
    pages = [
        "<a " + "x" * 1_000_000 + ' href="/big">k</a>',
        "<a " + " ".join(f"a{i}=1" for i in range(100_000)) + ' href="/many">k</a>',
        '<a href="/open>' + "z" * 500_000,
    ]
    df = spark.createDataFrame([(p,) for p in pages], "h string").coalesce(1)
    assert [r[0] for r in df.select(tags.hrefs(F.col("h"))).collect()] == [["/big"], ["/many"], []]
