import html as stdlib_html
import random
import re
import time
from html.parser import HTMLParser

import numpy as np

from corefold.llm import html


def page(body, head="<title>T</title><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = """<nav><ul><li>Menu</li></ul></nav><!-- ad --><div class="ad">Buy</div><header>Site</header>
<article><h1>A &amp; B &lt;x&gt; &#233;&nbsp;z</h1><p><b>One<br>two   three<p>Four</p><aside>Aside</aside><div class="share-buttons">Share</div>
<form><p>Form</p></form><section><h2>Sub</h2><ul><li>i1<li>i2</ul></section><pre>a
 b</pre><section id="comments"><p>Great post!</p></section></article><footer>&copy; foot</footer>"""


def text(source):
    return html.main_text([t for t, _ in html.blocks(source)])


def test_article_without_furniture():
    assert text(page(ARTICLE)).split("\n\n") == ["A & B <x> é z", "One two three", "Four", "Sub", "i1", "i2", "a b"]


def test_odd_markup():
    assert text(None) == text("") == text("<!-- only") == text("<script>x") == ""
    assert text("plain &amp; text") == "plain & text"
    assert text("<article><p>a</article><p>b") == "a\n\nb"
    assert text("<article><p>cut <b>short") == "cut short"
    assert text("<main><p>m</p><article><p>a</p></article></main>") == "m\n\na"
    assert text("<main><p>long body text of the page</p><article>teaser</article></main>") == "long body text of the page\n\nteaser"
    assert text("<main><header><h1>Title</h1></header><p>m</p></main>") == "Title\n\nm"
    assert text('<header>Site</header><article><div class="post-header"><h1>Title</h1></div><p>a</p></article>') == "Title\n\na"
    assert text('<div class="entry-header"><h1>Title</h1></div><div id="header">Site</div>') == "Title"
    assert text('<p>a <img alt="5" tall"> body</p>') == "a body" and text('<p title="a>b">c</p>') == "c"
    assert text("<p title='it>s'>d</p><a href=x'y>e</a>") == "d\n\ne" and text('<p title="open>f</p>') == "f"
    assert text('<div class="layout with-sidebar"><p>in</p><div class="sideBar sidebar">no</div></div>') == "in"
    assert text('<p a="x>y" hidden>no</p><p data-x=\'>\'>yes</p>') == "yes"
    assert text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert text("<article><p>a<hr>b<img src=x>c</p><textarea><p>no</textarea></article>") == "a\n\nbc"
    long = "<article>" + "<p>word</p>" * 20000 + "</article>"
    assert text(long).count("word") == 20000


def test_hostile_pages_take_linear_time():
    n = 1_000_000
    units = ["<a ", "<a \"", "<a b=\"", "<a b='", "<div>", "<p>", "<b>", "<li><b>", "</div", "<script></script ", "<!--", "<![CDATA[", "&amp", " class=", "<x class='", "<", "<p></b>", "<option>", "<td><div>"]
    for unit in units:
        began = time.monotonic()
        html.blocks(unit * (n // len(unit)) + '"')
        assert time.monotonic() - began < 40, unit


class Plain(HTMLParser):
    """A plain reading of well-formed articles: the text of h1 and p elements in article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out, self.now = False, [], ""

    def cut(self):
        if self.now.strip():
            self.out.append(re.sub(r"\s+", " ", self.now).strip())
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("p", "h1"):
            self.cut()
        if tag == "br":
            self.now += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.now += data


def test_extract_on_the_pages_matches_a_plain_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.collect()
    got = {r.page_id: r for r in html.extract(pages).collect()}
    assert len(got) == len(rows)
    for r in rows:
        plain = Plain()
        plain.feed(r.html)
        assert got[r.page_id].text == "\n\n".join(plain.out) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def longest(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_shared_blocks_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = (np.array(rng.sample(range(12), rng.randint(1, 12))) for _ in range(2))
        assert len(html.shared_blocks(a, b)) == longest(a, b)


def test_neighbours_lose_what_they_share(spark):
    menu, foot = "<p>Home News Sport</p>", "<p>All about this site and more</p>"
    own = lambda i, n=40: f"<div>own text {i} " + f"w{i} " * n + "</div>"
    rows = [(i, f"http://h.example/{'ab'[i % 2]}/{i:03d}?q={i}", page(menu + own(i) + foot)) for i in range(60)]
    rows += [(100, "http://alone.example/x", page(menu + own(100) + foot)), (101, None, page(menu + own(101))), (102, "http://h.example/b/1", None), (None, "http://z.example/", page(own(7)))]
    rows += [(200 + i, f"https://copy.example/{i}", page(menu + own(200) + foot)) for i in range(3)]
    rows += [rows[5], (103, "http://h.example/c/1", page(f"<article>{menu}<p>kept</p></article>"))]
    inside = lambda i, more="": page(f"<main>{menu}<p>{own(i)}</p>{more}{foot}</main>")
    # Menus inside landmarks; a copy next to its original; an article that is only a teaser.
    rows += [(300, "http://m.example/1", inside(300)), (301, "http://m.example/2", inside(300)), (302, "http://m.example/3", inside(302))]
    rows += [(303, "http://m.example/4", page(f"<main>{menu}<header><h1>Head 303</h1></header><article>teaser 303</article>{own(303)}{foot}</main>"))]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, gone string, text string")
    for parts in (1, 7, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = html.extract(pages.repartition(3)).collect()
        assert len(got) == len(rows)
        by = {r.page_id: r.text for r in got}
        squeezed = lambda i: re.sub(r"\s+", " ", re.sub("<.*?>", "", own(i))).strip()
        assert all(by[i] == squeezed(i) for i in range(60)), parts
        assert by[100].split("\n\n") == ["Home News Sport", squeezed(100), "All about this site and more"]
        assert by[101].split("\n\n") == ["Home News Sport", squeezed(101)]
        assert by[102] == "" and by[None] == squeezed(7) and by[103] == "Home News Sport\n\nkept"
        assert by[200] == by[201] == by[202] == "Home News Sport\n\n" + squeezed(200) + "\n\nAll about this site and more"
        assert [by[300 + i] for i in range(4)] == [squeezed(300), squeezed(300), squeezed(302), f"Head {303}\n\nteaser 303\n\n{squeezed(303)}"]
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert html.extract(pages.limit(0)).collect() == []


def test_places():
    assert html.place("https://User@Host.Example:80/a/b?q#f") == ("host.example", "/a/b")
    assert html.place("//h?x") == ("h", "/") and html.place(None) == ("", "") and html.place("nonsense") == ("", "nonsense")
    assert stdlib_html.unescape("&amp;") == "&"
