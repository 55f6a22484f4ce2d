import re
from html import unescape

import numpy as np
import pytest

from llm_tables import CLASHES
from remarklab.llm import html_extract as H
from remarklab.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tree(spark):
    return H.train(spark)


def extract(tree, html):
    return H.extractor(tree)(html)[0]


def clean(text):
    return " ".join(unescape(text).split())


def test_every_page_of_the_table(spark, tree, sf):
    """The test pages' articles have paragraphs and a heading only: brute force by patterns."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op12_html_extract"](spark, sf).collect()}
    assert len(got) == len(pages) > 0
    for r in pages:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL).group(1)
        blocks = [clean(re.sub(r"<[^>]*>", "", part.replace("<br>", " "))) for part in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


WORDS = "the article goes on with quite a few words in every paragraph so that it reads like a text written by somebody"
ARTICLE = f"<h1>Title of it</h1><p>{WORDS}.<p>Short.<p>{WORDS} and <a href='/x'>a link</a> more.</p><ul><li>one item<li>two items</ul>"
TEXT = "\n\n".join(["Title of it", f"{WORDS}.", "Short.", f"{WORDS} and a link more.", "one item", "two items"])

AROUND = [
    '<header class="site-header"><a href="/">Home</a><p>Our motto is here</p></header>{}',
    "<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>{}",
    '<div class="ad">Buy this thing now for little money and get another one free.</div>{}',
    "{}<aside><h2>More</h2><p>" + WORDS + "</p></aside>",
    '{}<div id="sidebar"><p>' + WORDS + "</p></div>",
    '<div class="cookie-banner"><p>We use cookies to make this page better.</p><button>Accept all</button></div>{}',
    '<div role="alert">Notice: this page moves soon.</div>{}',
    '{}<form action=x><label>Your mail</label><input name=m><textarea>write here</textarea><select><option>a<option>b</select></form>',
    '{}<section id="comments"><h3>2 comments</h3><div class="comment"><p>' + WORDS + "</p></div><p>I agree</p></section>",
    "{}<footer>&copy; 2024 someone &middot; all rights</footer>",
    "{}<script>var a = '<p>no text</p>';</script><style>p{{}}</style><noscript>Turn it on</noscript><!-- <p>nor this</p> -->",
]


@pytest.mark.parametrize("around", AROUND)
def test_article_element(tree, around):
    page = "<!DOCTYPE html><html><head><title>T &amp; U</title></head><body>" + around.format(f"<article>{ARTICLE}</article>") + "</body></html>"
    assert extract(tree, page) == TEXT
    assert extract(tree, page.replace("article>", "main>")) == TEXT


@pytest.mark.parametrize("around", AROUND)
def test_inside_the_article(tree, around):
    """Adverts, notices, asides, forms and comments within the article's element."""
    page = "<body><article class='post has-sidebar'>" + around.format(ARTICLE).replace("header", "nav") + "</article></body>"
    assert extract(tree, page) == TEXT


def test_page_without_article_element(tree):
    body = f"<h1>Title of it</h1><p>{WORDS}.</p><p>Short.</p><p>{WORDS}</p>"
    page = ("<body><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div class=content>" + body
            + "</div><div><a href=3>Related one</a><br><a href=4>Other</a></div><div id=footer>All of it is ours</div></body>")
    assert extract(tree, page) == "\n\n".join(["Title of it", f"{WORDS}.", "Short.", WORDS])


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), (" \n", ""), ("<", ""), ("<p", ""), ("</", ""), ("<!--", ""), ("<nav>x", ""),
    ("<article>a &lt;b&gt; &amp;amp; &#x41;&#66; &am &amp", "a <b> &amp; AB &am &"),
    ("<article>a<b>b</b>c <i>d\n\n\te</i><br>f&nbsp;g", "abc d e f g"),
    ("<article><p>1 < 2 and 3 > 2 <3", "1 < 2 and 3 > 2 <3"),
    ("<article><p>a<P>b</p>c</article>d", "a\n\nb\n\nc"),
    ('<article><p title="a > b" x=\'>\'>kept</p><p class="open>all of it', "kept\n\nall of it"),
    ("<ARTICLE><SCRIPT>x</script >y<script>never closed </article>", "y"),
    ("<article><p>x<!-- a -- > b -->y<!-->z<?php echo ?>w<![CDATA[v]]>", "xyzw"),
    ("<article><p>a</b></div></p></p>b<li>c</ul>d", "a\n\nb\n\nc\n\nd"),
    ("<article>same</article><article>same</article>", "same\n\nsame"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ("<article><p>日本語 😀 text</p>", "日本語 😀 text"),
])
def test_markup(tree, html, want):
    assert extract(tree, html) == want


def test_long_and_deep_pages(tree):
    many = "<article>" + "<p>one two three</p>" * 50000 + "</article>"
    assert extract(tree, many) == "\n\n".join(["one two three"] * 50000)
    deep = "<article>" + "<div><b>" * 50000 + "x"
    assert extract(tree, deep) == "x"
    odd = "<article>" + "<b ='" * 30000 + "<p =\"" * 30000
    assert extract(tree, odd) == ""


def test_rows_stay_as_they_are(spark, tree):
    names = [*CLASHES, "text", "n_kept", "html"]
    rows = [(1, *names[:-1], "<article>a</article>"), (1, *names[:-1], "<article>a</article>"), (None, *names[:-1], None)]
    df = spark.createDataFrame(rows, ", ".join(["page_id bigint", *[f"{c} string" for c in names]]))
    out = H.extract_pages(df, tree)
    assert out.columns == [c for c in df.columns if c not in ("text", "n_kept")] + ["text", "n_blocks", "n_kept"]
    assert sorted((r.page_id or 0, r.text, r.n_blocks, r.n_kept, r.score) for r in out.collect()) == [
        (0, "", 0, 0, "score"), (1, "a", 1, 1, "score"), (1, "a", 1, 1, "score")]
    assert H.extract_pages(df.limit(0), tree).count() == 0


def test_tree_fits_its_table(tree):
    rows = np.array(H.labelled_rows())
    assert tree.predict(rows[:, :-1]).tolist() == (rows[:, -1] == 1).tolist()


def test_other_labels_give_another_tree(spark):
    rows = [[w, 0.0, 0, 0, 0, 0, 0, 0, 0, float(w > 10)] for w in range(1, 21)]
    tree = H.train(spark, [[float(x) for x in r] for r in rows])
    assert extract(tree, f"<p>few words<p>{WORDS}") == WORDS
