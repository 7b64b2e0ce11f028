import math
import random
from collections import Counter, defaultdict

from rowtide.llm import html_extract as H

from .helpers import frame, with_clashes

SCHEMA = "page_id long, url string, html string"


def test_blocks_entities_and_noise():
    page = ('<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="has-sidebar"><nav><ul><li><a href="/">no</a></ul></nav>'
            '<div class="ad">no</div><main><h1>T &amp; t</h1><p>A &lt;b&gt;&nbsp; c<br>d<aside>no</aside><ul><li>one<li>two</ul><form>no</form>'
            '<table><tr><td>1<td>2<tr><td>3</table><p>in<b>li</b>ne<!-- no --> x<script>if (a<b) "</p>";</script>'
            '<section class="comments"><article class="comment">no</article></section></main><footer>&copy; no</footer>')
    assert H.extract(page, set()) == "T & t\nA <b> c d\none\ntwo\n1 2\n3\ninline x"


def test_broken_pages():
    assert H.extract(None, set()) == H.extract("", set()) == H.extract("<script>x", set()) == ""
    assert H.extract("plain a < b &amp", set()) == "plain a < b &"
    assert H.extract("<article><p>one<p><b>two</article><footer>no", set()) == "one\ntwo"
    assert H.extract("<div>" * 3000 + "deep", set()) == "deep"
    assert len(H.extract("<article><p>" + "word " * 200_000, set())) == 999_999
    assert H.extract('<a "' * 5000, set()).startswith('<a "')


def test_site_style_tree_removes_templates_only(spark):
    pages = [(i, f"http://h.org/{i}", f'<body><div class="top">Same on all pages</div><div class="x"><p>Text {i} of its own</p></div></body>') for i in range(6)]
    pages += [(10, "http://one.org/", pages[0][2]), (11, None, "<p>alone</p>"), (12, "http://h.org/12", None)]
    copies = [(i, "http://c.org/", "<body><article><p>Copied text</p></article></body>") for i in range(20, 25)]
    df = frame(spark, pages + copies, SCHEMA)
    got = {r.page_id: r for r in H.extract_pages(df).collect()}
    assert got == {r.page_id: r for r in H.extract_pages(df, max_broadcast=0, salts=3).collect()}  # salted by host
    assert [got[i].text for i in range(6)] == [f"Text {i} of its own" for i in range(6)]
    assert got[10].text == "Same on all pages\nText 0 of its own" and got[11].text == "alone" and (got[12].text, got[12].n_chars) == ("", 0)
    assert {got[i].text for i in range(20, 25)} == {"Copied text"} and got[20].n_chars == 11


def test_copies_are_no_template(spark):
    def page(i):
        return f'<html><body><div class="top">Same on all pages</div><div class="x"><p>Text {i} of its own</p></div></body></html>'

    two = [(i, "http://two.org/", page(0)) for i in range(2)]
    many = [(100 + i, "http://many.org/", page(0 if i < 90 else i)) for i in range(100)]
    got = {r.page_id: r.text for r in H.extract_pages(frame(spark, two + many, SCHEMA)).collect()}
    assert {got[0], got[1]} == {"Same on all pages\nText 0 of its own"}
    assert [got[100 + i] for i in range(100)] == [f"Text {0 if i < 90 else i} of its own" for i in range(100)]


def test_tree_against_entropies_by_hand(spark):
    """Every node's importance, from the pages' own paths and texts."""
    rng = random.Random(3)
    pages = []
    for i in range(60):
        parts = "".join(f'<div class="{c}"><p>{rng.choice(["same", f"own {i}", f"some {i % 4}"])}</p></div>' for c in rng.sample("abcde", 3))
        pages.append((i, f"http://h{i % 2}.org/", f"<html><body>{parts}</body></html>"))
    pages += pages[:20] * 3
    got = {(r.host, r.node): (r.pages, round(r.importance, 9)) for r in H.style_tree(frame(spark, pages, SCHEMA)).collect()}
    seen = defaultdict(lambda: defaultdict(Counter))
    for url, html in {(u, h) for _, u, h in pages}:
        for node, kind, what in set(H.style_rows(html)):
            seen[url.split("/")[2], node][kind][what] += 1

    def entropy(c):
        m = sum(c.values())
        return 1.0 if m <= 1 else -sum(n / m * math.log(n / m) for n in c.values()) / math.log(m)

    assert got == {k: (max(sum(c.values()) for c in v.values()), round(max(map(entropy, v.values())), 9)) for k, v in seen.items()}


def test_teaser_in_an_article_is_not_the_page():
    page = '<body><article>teaser</article><div class="story"><p>' + "A long story. " * 20 + "</p></div></body>"
    assert H.extract(page, set()) == "teaser\n" + ("A long story. " * 20).strip()
    assert H.extract('<body><article>' + "A long story. " * 20 + '</article><div>elsewhere</div>', set()) == ("A long story. " * 20).strip()


def test_repeats_clashes_and_empty_table(spark):
    df = with_clashes(frame(spark, [(1, "http://a.org", "<article>x</article>")] * 2 + [(None, None, None)], SCHEMA))
    assert sorted((str(r.page_id), r.text) for r in H.extract_pages(df).collect()) == [("1", "x"), ("1", "x"), ("None", "")]
    assert H.extract_pages(df.limit(0)).count() == 0
