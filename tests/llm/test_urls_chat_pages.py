"""Operators on URLs, conversations and pages, on odd rows and by hand."""

import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import chat, html, queries, url_rules

URLS = [
    None, "", "no scheme", "://", "http://", "http://Example.ORG", "https://example.org/", "https://a.b.example.org/es/x?q=/fr/#z",
    "https://example.org/es", "https://notexample.org/es/x", "https://example.org/en/12", "http://x.com/fr/a", "http://x.com/de/",
    "http://com/de/", "http://org#/x", "ftp://a://b/c", "http://x.com/de/", "http://x.com:80/de/", "http://.com/de/", "http://x\ny.org/a\nb",
]
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"), ("x.com", "/de/", "allow"), ("x.com", "", "block"), ("Example.org", "/es/x", "allow"),
    (None, "/", "block"), ("", "/", "block"), ("com", "/de/", "allow"),
]


def judged_by_hand(url, rules):
    host, _, rest = (url or "").partition("://")
    if "://" not in (url or ""):
        return "", "", None, "allow"
    found = re.match(r"([^/?#]*)([^?#]*)", rest, re.DOTALL)
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]
    fits = [
        (len(h.split(".")), len(p), v, h.lower() + p)
        for h, p, v in rules
        if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, "allow")


def test_urls_by_hand(lab):
    pages = lab.createDataFrame([(i if i else None, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    rules = lab.createDataFrame(RULES, "host string, path string, verdict string")
    for given, own in ((rules, RULES), (rules.limit(0), [])):
        got = url_rules.judge(pages, given).select("page_id", "url", "host", "path", "rule", "verdict").collect()
        want = [(i if i else None, u, *judged_by_hand(u, own)) for i, u in enumerate(URLS)]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert url_rules.judge(pages.limit(0), rules).count() == 0


def test_sweep_keeps_nested_prefixes(lab):
    lab.conf.set("spark.sql.shuffle.partitions", "5")
    keys = [f"{a}.{b}.{c}" for a in "abc" for b in "abcd" for c in "abcdefgh"] + ["", "a", "a.b", "zz"]
    prefixes = ["a", "a.b", "a.b.c", "b.", "b.d.h", "c.a.a.x", "z"]
    got = url_rules.sweep(lab.createDataFrame([(k,) for k in keys], "key string"), lab.createDataFrame([(p,) for p in prefixes], "prefix string"))
    lab.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r.key: r.stack for r in got.collect()} == {k: sorted((p for p in prefixes if k.startswith(p)), key=len) for k in keys}


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello ann"), (1, 3, "cy", None), (1, 4, "ann", ""),
    (2, 0, "ann", "alone"), (3, 0, "system", "nobody"), (None, 0, "ann", "x"), (None, None, None, "y"),
    (4, 0, "ann", "same"), (4, 0, "ann", "same"), (4, 0, "bob", "tie"), (4, None, "bob", "first"),
]


def rotated_by_hand(turns):
    out = []
    for conv in {t[0] for t in turns}:
        own = [(t[1], t[2] or "", t[3] or "") for t in turns if t[0] == conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        for view in {s for _, s, _ in own if s != "system"}:
            at = 0
            for n, (turn, speaker, text) in enumerate(own):
                role = "assistant" if speaker == view else speaker if speaker == "system" else "user"
                piece = f"<|im_start|>{role}" + (f" name={speaker}" if role == "user" else "") + f"\n{text}<|im_end|>\n"
                end = at + len(piece)
                mine = role == "assistant"
                out.append((conv, view, turn, n, speaker, role, piece, at, end, mine, end - len(text) - 11 if mine else end, end - 1 if mine else end))
                at = end
    return out


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_perspectives_by_hand(lab, partitions):
    lab.conf.set("spark.sql.shuffle.partitions", partitions)
    turns = lab.createDataFrame([(*t, "clash") for t in TURNS], "conv_id long, turn long, role string, text string, perspective string")
    got = chat.rotate(turns).collect()
    lab.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rotated_by_hand(TURNS)))
    for r in got:
        assert not r.trained or r.rendered[r.loss_start - r.start : r.loss_end - r.start].endswith("<|im_end|>")


def test_a_long_conversation_is_cut_into_blocks(lab):
    turns = [(1, i, "ann" if i % 3 else "bob", "z" * (i % 5)) for i in range(900)] + [(i, 0, "ann", "x") for i in range(2, 60)]
    got = chat.rotate(lab.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rotated_by_hand(turns)))
    assert chat.rotate(lab.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


ARTICLE = "<article><h1>Head &amp; line</h1><p>One <b>bo</b>ld&nbsp;\n  text<br>next</p><p>Two &lt;x&gt; <a href='/u'>link</a>.</p></article>"
WANT = "Head & line One bold text next Two <x> link."


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>B</a></li></ul></nav>{}<footer>&copy; x</footer>",
        "<header><h2>Site</h2></header><div class='cookie-notice'>We use cookies</div>{}<aside><p>Side</p></aside>",
        "<div id=sidebar-1><p>Side</p></div>{}<section class='comments'><article><p>First!</p></article></section>",
        "<form><label>Name</label><input name=q><textarea>Say</textarea><button>Go</button></form>{}<div class=ad-slot>Buy</div>",
        "<main>{}<div class='share'>Share</div><ol class=comment-list><li>Nice</li></ol></main><div role=navigation>Next</div>",
        "<script>var a='<article>no</article>';</script><style>p{{x:1}}</style><!-- <p>no</p> -->{}<noscript>no</noscript>",
    ],
)
def test_only_the_article_is_kept(lab, around):
    pages = [(i, f"http://h/{i}", page(around.format(ARTICLE.replace("One", f"One{i}")))) for i in range(4)]
    got = html.extract(lab.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: WANT.replace("One", f"One{i}") for i in range(4)}
    assert all(r.n_chars == len(r.text) for r in got)


def test_template_text_is_found_without_an_article(lab):
    body = "<div><p>Welcome to the site</p></div><ul><li><a href=a>A</a></li><li><a href=b>B</a></li></ul><div class=story><p>Text {0}.</p><p>More {0}.</p></div><p>All rights reserved</p>"
    pages = [(i, "http://h/x", page(body.format(i) + ("<hr>" if i % 2 else ""))) for i in range(5)]
    got = html.extract(lab.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Text {i}. More {i}." for i in range(5)}


@pytest.mark.parametrize("others", [0, 8])
@pytest.mark.parametrize("copies", [2, 3, 5])
def test_copies_of_an_article_are_no_template(lab, others, copies):
    """On a host that holds only copies, and in a layout of their own among other pages."""
    own = "<div class=special><h2>Copied head</h2><blockquote>Copied text</blockquote></div>"
    body = "<p>Site name</p><div class=story><h3>Head {0}</h3><pre>Text {0}</pre></div>"
    pages = [(i, f"http://h/{i}", page(own if i < copies else body.format(i))) for i in range(copies + others)]
    got = {r.page_id: r.text for r in html.extract(lab.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {got[i] for i in range(copies)} == {"Copied head Copied text"}
    assert all(got[i] == f"Head {i} Text {i}" for i in range(copies, copies + others))


def test_odd_pages(lab):
    odd = [None, "", " ", "plain text only", "<", "<p", "<p>cut &am", "</p></div>", "<article>unclosed <p>a<p>b", "<!-- open", "<script>open",
           "<article>" + "<div>" * 3000 + "deep", "<article>" + "word " * 50_000, "<article><p>&#65;&#x42;&notin;&bogus; &amp;amp;</article>"]
    urls = [None, "http://h/a", "nothing"]
    pages = [(i * 3 + k, u, h, "x") for i, h in enumerate(odd) for k, u in enumerate(urls)] + [(0, None, None, "x")] * 2
    frame = lab.createDataFrame(pages, "page_id long, url string, html string, wrapper string")
    got = html.extract(frame.withColumn("text", F.lit(1)))
    rows = got.collect()
    assert len(rows) == len(pages) and "wrapper" in got.columns
    text = {}
    for r in rows:
        text.setdefault(r.html, set()).add(r.text)
    assert text[None] == text[""] == text[" "] == text["<script>open"] == text["<!-- open"] == {""}
    assert text["plain text only"] == {"plain text only"}
    assert text[odd[8]] == {"unclosed a b"}
    assert text[odd[12]] == {" ".join(["word"] * 50_000)}
    assert text[odd[13]] == {entities.unescape("AB&notin;&bogus; &amp;amp;")}
    assert html.extract(frame.limit(0)).count() == 0


def test_wrapper_is_a_union_free_expression(lab):
    pages = [(0, "http://h/1", "<ul><li>a</li><li>b</li></ul><p>x</p>"), (1, "http://h/2", "<ul><li>a</li></ul><hr><p>y</p><p>z</p>")]
    found = html.infer(lab.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert [(r.host, html.expression(r.wrapper)) for r in found] == [("h", "<ul> (<li> # </li>)+ </ul> <hr>? (<p> # </p>)+")]


def test_pages_of_a_table(lab, small):
    pages = {r.page_id: r.html for r in lab.read.parquet(f"{small}/pages.parquet").collect()}
    for r in queries.REGISTRY["op1_html_extraction"](lab, small).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.DOTALL)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(entities.unescape(inner).split())


def test_alignment_is_a_longest_common_subsequence():
    random = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(random.choice(list("abcd"), random.integers(0, 14))) for _ in range(2))
        pairs = html._matched(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, p in enumerate(a):
            for j, q in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if p == q else max(best[i][j + 1], best[i + 1][j])
        assert len(pairs) == best[-1][-1]


def test_long_pages_without_repeats_align(lab):
    random = np.random.default_rng(4)
    names = ["div", "section", "h2", "h3", "table", "pre", "dl", "ul", "blockquote"]
    body = ["".join(f"<{t} class=k{k % 7}x>t{i}</{t}>" for i, (t, k) in enumerate(zip(random.choice(names, 4000), random.integers(0, 99, 4000), strict=True))) for _ in range(2)]
    pages = [(i, "http://h/x", f"<article>{b}</article>") for i, b in enumerate(body)]
    got = html.extract(lab.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)).collect()
    assert {r.text for r in got} == {" ".join(f"t{i}" for i in range(4000))}


@pytest.mark.parametrize("body, text", [
    ('<main class="content no-sidebar"><p>One</p></main>', "One"),
    ('<div class="single has-sidebar"><article><p>One</p></article></div>', "One"),
    ('<article class="post comments-open"><p>One</p><div class="comments"><article class="comment"><p>no</p></article></div></article>', "One"),
    ('<article><p>One <span class="advert">no <b>no</b></span> two</p><p>three <span><span class="big">four</span></span></p></article>', "One two three four"),
    ('<article><p>One <span class="ad">no</p><p>two</p></article>', "One two"),
    ("<nav><ul><li>no<article><p>One</p></article>", "One"),
    ("<header><h1>no</h1><main><p>One</p></main>", "One"),
    ('<form id="page"><main><p>One</p></main></form>', "One"),
    ('<div class="site-header">no</div><div class="search-form">no</div><article><header><h1>One</h1></header></article><div id="sidebar-left">no</div>', "One"),
    ("<aside><article><p>no</p></article></aside><article><p>One</p></article>", "One"),
    ('<article><p>One</p><div class="related-posts">no</div><p class="comment">no</p></article>', "One"),
])
def test_classes_that_say_what_an_element_is(body, text):
    for around in ("<body>", '<body class="single has-sidebar comments">'):
        assert html.Extractor().text(f"<html>{around}{body}</body></html>", None) == text
