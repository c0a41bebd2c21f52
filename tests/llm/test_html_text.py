import re
from html import unescape

from lineforge.llm import html_text


def test_query_gives_the_articles_blocks(spark, sf):
    """Against the articles cut out of the pages by hand (they hold p, h1, b and br only)."""
    out = {r.page_id: (r.text, r.n_chars) for r in html_text.html_query(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(out) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        want = "\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)
        assert out[r.page_id] == (want, len(want))


def text(html, **k):
    return html_text.main_text(html, **k)


def test_markup():
    assert text("<p>a &lt;b&gt; &amp; &eacute;&#8364;&nbsp;c<p> d\n\te <br>f</p>") == "a <b> & é€ c\nd e f"
    assert text('<body class="has-sidebar"><div id="nav-main">x</div><h1>T</h1>tail') == "T\ntail"
    assert text("<script>var a='</p><p>no';</script><style>p{}</style><!-- <p>no</p> -->yes<noscript>no</noscript>") == "yes"
    assert text("<header>no</header><article><header><h1>T</h1></header><p>x</p><aside>no</aside><form>no</form></article><footer>no") == "T\nx"
    assert text('<main><p>a</p><div class="cookie-notice">no</div><section id=comments><p>no</p></section><p>b') == "a\nb"
    assert text('<article class="comment">short</article><article><p>long text here</p></article>') == "long text here"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a\nb\nc\nd\ne"
    assert text("a < b and <3 & c") == "a < b and <3 & c"
    assert text("") == "" and text("<") == "<" and text("<!--") == "" and text("</p></div>") == ""
    assert text("<b>" * 20_000 + "deep" + "<div>" * 20_000 + "er") == "deep\ner"


def test_layout_classes_keep_the_article():
    body = "<h1>T</h1><p>the text of the article</p>"
    for html in ('<article class="post has-sidebar">%s</article>', '<article class="post comments-open">%s</article>',
                 '<div class="content-sidebar-wrap"><article>%s</article></div>', '<div id="page" class="no-sidebar"><main>%s</main></div>',
                 '<div id="page" class="no-sidebar has-header"><div class="entry">%s</div></div>',
                 '<article><div class="no-sidebar">%s</div><div class="share">no</div></article>',
                 '<div id=wrap class="with-menu"><div class=sidebar>no</div><article>%s</article><div class=newsletter>no</div></div>'):
        assert text(html % body + "<div class=menu>no</div>") == "T\nthe text of the article", html
    comments = "<div id=comments class=comments-area><article class=comment-body><p>a comment that is longer than all else</p></article></div>"
    assert text(f"<div class=no-sidebar><article>{body}</article>{comments}</div>") == "T\nthe text of the article"
    assert text(f"<main>{body}{comments}</main>") == "T\nthe text of the article"


def test_templates_of_a_host(spark):
    page = lambda i, h="h.org": (i, f"https://{h}/{i}", f"<html><body><div class=zz><p>Read  our paper</p></div><div><p>text {i}</p>"  # noqa: E731
                                 f"<p>other {i * 7}</p></div><div>Made by us</div></body></html>")
    rows = [page(i) for i in range(20)] + [page(90, "lone.org")]
    rows += [(100, "https://h.org/x", rows[0][2])] * 5 + [(101, None, None), (102, "nohost", ""), (None, "https://H.org:80/", "<p>Read our paper")]
    article = "<article><p>Same line</p><div>Share this</div><p>text {}</p></article>"
    rows += [(200 + i, f"http://a.net/{i}", article.format(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as template", "'x' as text")
    out = {}
    for r in html_text.extract_text(df.repartition(3)).collect():
        out.setdefault(r.page_id, r.text)
    assert out[3] == "text 3\nother 21" and out[100] == "text 0\nother 0"
    assert out[90] == "Read our paper\ntext 90\nother 630\nMade by us"
    assert out[101] == "" and out[102] == ""
    assert out[205] == "Same line\ntext 5"
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_notices_in_the_article_on_all_of_a_hosts_pages(spark):
    """What stands in p, li or a in the article of every page goes; what the author repeats on some stays."""
    rows = [(i, f"https://n.org/{i}", f"<article><h1>T {i}</h1><p>Subscribe <b>now</b></p><p>text {i} by <b>me</b></p>"
             + ("<p>As I said</p>" if i % 3 == 0 else "") + "<ul><li>Write to us</li></ul><a href=/x>More</a></article>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    assert all(out[i] == f"T {i}\ntext {i} by me" + ("\nAs I said" if i % 3 == 0 else "") for i in range(40)), out[0]


def test_copies_of_one_page_are_no_template(spark):
    rows = [(i, "https://c.org/?" + str(i), "<div><p>one text</p></div>") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_text.extract_text(df).collect()} == {"one text"}


def test_covers_around_the_article_are_spared():
    art = "<article><p>one text</p></article>"
    more = "<form><p>subscribe</p></form><div hidden><p>hidden words</p></div>"
    for page in (f"<form id='f'>{art}</form>", f"<div hidden>{art}</div>", f"<div style='display: none'>{art}</div>{more}",
                 f"<div role='search'><form>{art}{more}</form></div>"):
        assert html_text.main_text(f"<body>{page}</body>") == "one text"
    assert html_text.main_text("<body><form><p>a long text that fills the page</p></form><form><p>login</p></form></body>") == \
        "a long text that fills the page"
    teaser = "<aside><article><p>a teaser much longer than the text itself</p></article></aside>"
    assert html_text.main_text(f"<body>{teaser}<form>{art}</form></body>") == "one text"


def test_stray_end_tags_take_time_in_proportion():
    import time
    page = "<div>" * 30_000 + "x" + "</span></section>" * 50_000 + "<li>y" * 5_000
    begun = time.process_time()
    html_text.parse(page)
    assert time.process_time() - begun < 4
