"""Block extraction on planted pages."""

import re

import numpy as np

from tests.conftest import SF
from tidemark.llm import html_text
from tidemark.llm.queries import op7_html_extraction

TREE = html_text.train_tree()


def text(page):
    return html_text.main_text(page, TREE)


def test_article_page():
    page = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{margin:0}</style><script>var t="</p><p>x</p>";</script></head>
    <body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- <p>gone</p> -->
    <div class="ad">Buy these fine words now please.</div><div id="cookie-notice"><p>We use cookies, accept them all.</p></div>
    <article><header><h1>A short&nbsp;title</h1></header><p><b>First   line &lt;b&gt; with
    breaks.<br>next<p>One.</p><div class="share"><a href="#">Share this</a></div><p>A <a href="/x">linked</a> word among
    several others in a sentence.</p><ul><li>item one<li>item two</ul><section class="comments"><p>Great post, I read it all.</p></section></article>
    <aside><p>Some long related text that is in the sidebar of the page, with many words.</p></aside>
    <form><label>Search</label><input value="go"></form><footer>&copy; host &middot; words here</footer></body></html>"""
    assert text(page) == "\n\n".join([
        "A short title", "First line <b> with breaks. next", "One.",
        "A linked word among several others in a sentence.", "item one", "item two"])


def test_page_without_article_element():
    body = "A sentence with enough words to look like the body of some longer text, which it is, at least here. " * 3
    page = f"""<body><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul><h2>Head line</h2>
    <p>{body}</p><p>{body}</p><div><a href=4>More</a> <a href=5>links</a></div><div class='footer'>Imprint and words</div></body>"""
    assert text(page) == "\n\n".join(["Head line", body.strip(), body.strip()])


def test_article_in_a_marked_wrapper():
    body = "A sentence with enough words to look like the body of some longer text, which it is, at least here. " * 3
    inner = f"<ul><li><a href=1>One</a><li><a href=2>Two</a></ul><{{0}}><h1>Head line</h1><p>{body}</p>" \
        f"<div class=share>Share this</div><section class=comments><article><p>Great post.</p></article></section></{{0}}>"
    whole = f"Head line\n\n{body.strip()}"
    for mark in ("class='has-sidebar'", "class='layout-sidebar-right'", "class='no-comments'", "id='page-header-fixed'", "class='page header'"):
        for tag in ("article", "main"):
            assert text(f"<body><div {mark}>{inner.format(tag)}</div>") == whole, (mark, tag)
    assert text(f"<body><form id=aspnetForm>{inner.format('main')}</form>") == whole
    assert text(f"<body><div class='no-sidebar wide'><h1>Head line</h1><p>{body}</p></div>") == whole
    for mark in ("class=related", "class=sidebar"):  # cards beside the article
        assert text(f"<body>{inner.format('article')}<div {mark}><article><p>{body}</p></article></div>") == whole
    for wrapper in ("aside", "div hidden", "div role=search", "div class=sidebar style='display:none'"):
        assert text(f"<body><{wrapper}><article><p>{body}</p></article></{wrapper.split()[0]}>") == ""
    assert text(f"<body><div class=has-sidebar><div class=comments><article class=comment><p>{body}</p></article></div></div>") == ""


def test_inline_elements_stay_inline():
    assert text("<article><p>Let <math><mi>x</mi></math> be given.</p></article>") == "Let x be given."
    assert text("<article><p>Press <button>OK</button> to go on.</p></article>") == "Press OK to go on."
    for gone in ("<svg><text>icon</text></svg>", "<script>f('<p>')</script>", "<select><option>one</option></select>", "<object>no plugin</object>",
                 "<video>old <b>browser</b></video>", "<noscript>turn it on</noscript>", "<template><p>shape</p></template>"):
        assert text(f"<article><p>Words before {gone} and words after.</p><p>next</p></article>") == "Words before and words after.\n\nnext", gone


def test_names_inside_an_article_are_whole():
    kept = "<article><p>one</p><div class='{}'><p>A paragraph of the article with its own words.</p></div><p>two</p></article>"
    whole = "one\n\nA paragraph of the article with its own words.\n\ntwo"
    for name in ("notice-board-history", "social-history", "comment-on-the-text lead", "ad-hoc", "skip-of-a-ship"):
        assert text(kept.format(name)) == whole, name
    for name in ("notice", "cookie-notice", "wide share", "comments", "social share", "related"):
        assert text(kept.format(name)) == "one\n\ntwo", name
    assert text("<article><p>A <span class='skip-rope'>rope</span> and more words here.</p></article>") == "A rope and more words here."


def test_defined_cases():
    assert text(None) == text("") == text("   ") == text("<p></p><div> </div>") == ""
    assert text("plain words") == "plain words"
    assert text("<article>3 < 5 &amp; 7 > 6 &#233; &bogus; &#x1F600;") == "3 < 5 & 7 > 6 \xe9 &bogus; \U0001F600"
    assert text("<article><p>open <b>never closed") == "open never closed"
    assert text("<article><p>a</p><script>if (a<b) {</script x><p>b</p><script>unclosed") == "a\n\nb"
    assert text("<article><p a='1>2' b=\"<p>\" c>kept</p><p hidden>gone</p><p style='display: none'>gone</p>") == "kept"
    long = "<article>" + "<div>" * 3000 + "word " * 50_000 + "</div>" * 3000
    assert len(text(long).split()) == 50_000
    assert text("<" * 5000 + "a='" * 2000) is not None


def test_tree_fits_its_table_and_predicts_by_its_splits():
    table = np.array(html_text.LABELLED_BLOCKS, dtype=float)
    assert (TREE.predict(table[:, :-1]) == table[:, -1]).all()
    split = html_text.train_tree([(1.0, 0.0, 0), (2.0, 5.0, 0), (3.0, 0.0, 1), (4.0, 5.0, 1)])
    assert split.feature[0] == 0 and split.threshold[0] == 2.5
    assert split.predict(np.array([[2.4, 0.0], [2.6, 9.0]])).tolist() == [0, 1]


def test_rows(spark):
    rows = [(1, "u", "<article><p>one</p><p>two é</p>", 5), (1, "u", "<article><p>one</p><p>two é</p>", 5), (None, None, None, 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, N_CHARS int")
    got = [tuple(r) for r in html_text.extract(df).collect()]
    assert got == [(1, "u", "one\n\ntwo é", 10), (1, "u", "one\n\ntwo é", 10), (None, None, "", 0)]
    assert html_text.extract(df.limit(0)).collect() == []


def test_query_keeps_the_article_of_every_page(spark):
    import html

    got = {r.page_id: r for r in op7_html_extraction(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|$)", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b))).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[page.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)
