import re
import time
from html import unescape

import duckdb
import pytest
from helpers import DATA

from docketflow.llm.html_extract import THRESHOLD, extract, main_text, op6_html_extraction


def article_of(html):
    """What the given pages hold between <article> tags, block by block."""
    if not html or "<article>" not in html:
        return ""
    inner = html.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.split(r"</?(?:p|h1)[^>]*>", inner)
    return "\n".join(t for b in blocks if (t := " ".join(unescape(re.sub(r"<[^>]+>", " " if "<br" in b else "", b)).split())))


def test_query_finds_every_article(spark):
    pages = dict(duckdb.sql(f"select page_id, html from '{DATA}/sf0.01/pages.parquet'").fetchall())
    got = {r.page_id: r for r in op6_html_extraction(spark, f"{DATA}/sf0.01").collect()}
    assert got.keys() == pages.keys()
    assert [i for i in pages if got[i].text != article_of(pages[i])] == []
    assert all(r.n_chars == len(r.text) for r in got.values())


A = "<p>A first paragraph, long enough to be the text of an article. It has two sentences.</p>"
B = "<p>And so on; another paragraph, which is also long enough, follows it here.</p>"
TEXT = "A first paragraph, long enough to be the text of an article. It has two sentences.\nAnd so on; another paragraph, which is also long enough, follows it here."


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""), ("", ""), ("<html></html>", ""), ("plain words, no tags.", "plain words, no tags."),
        (f"<body><nav><a href=x>Menu, one</a></nav><div>{A}{B}</div><footer>Imprint, all rights.</footer></body>", TEXT),
        (f"<body><header>Site name</header><main>{A}<div class='ad'>Buy, buy!</div>{B}<form>Mail: <input></form></main><aside>Elsewhere, news.</aside></body>", TEXT),
        (f"<article>{A}<script>if (a < b) document.write('<p>no</p>')</script><style>p{{}}</style>{B}</article><div id=comments><p>First! I was here, I was the first reader of all.</p></div>", TEXT),
        (f"<article>{A}{B}<section class='reader-comments'><p>What a long comment, nobody will want to read it, ever.</p></section></article>", TEXT),
        (f"<article><p>Short one.</p>{A}{B}<p>End.</p></article>", "Short one.\n" + TEXT + "\nEnd."),
        (f"<article>{A}{B}", TEXT), (f"<article><p>A &lt;b&gt; &amp; c&nbsp;d &#233;,\n e.{B}</article>", "A <b> & c d é, e.\n" + TEXT.split("\n")[1]),
        (f"<ARTICLE><P>In <B>bold</B> and <A HREF='x'>a link</A>, as usual.{B}</ARTICLE>", "In bold and a link, as usual.\n" + TEXT.split("\n")[1]),
        (f"<article>{A}<!-- <p>hidden, very much so</p> -->{B}<div class='cookie-notice'>We use cookies, of course.</div></article>", TEXT),
    ],
)
def test_crafted_pages(html, want):
    assert main_text(html) == want


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f"<article><h1>Title</h1><p>A lead, of a few words.</p><section>{A}{B}</section></article>", "Title\nA lead, of a few words.\n" + TEXT),
        (f"<main><h1>Title</h1><p>A lead, of a few words.</p><div>{A}{B}</div></main>", "Title\nA lead, of a few words.\n" + TEXT),
        (f"<body><div class='has-sidebar'>{A}{B}</div></body>", TEXT), (f"<article class='post no-comments'>{A}{B}</article>", TEXT),
        (f"<body><form id='search'><h1>Title</h1>{A}{B}</form></body>", "Title\n" + TEXT), (f"<body><div class='layout sidebar'>{A}{B}</div></body>", TEXT),
        (f"<article>{A}<h2 id='related-work'>Related work</h2>{B}<h2 id='search'>Search</h2>{A}</article>", TEXT.replace("\n", "\nRelated work\n") + "\nSearch\n" + TEXT.split("\n")[0]),
        (f"<article><p>See <a href=x><code>x</code></a>, or <b><a href=y>y</a></b>, in this rather long paragraph.</p>{A}{B}</article>", "See x, or y, in this rather long paragraph.\n" + TEXT),
        (f"<article>{A}{B}</article><div id=comments>{A * 9}</div><div class='related-posts'>{B}</div><div class='site-footer'>{B}</div>", TEXT),
    ],
)
def test_pages_that_are_not_flat(html, want):
    assert main_text(html) == want


def test_tables_with_edges(spark):
    pages = spark.createDataFrame([(1, "u", A, "x"), (1, "u", A, "x"), (None, None, None, "x")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.n_chars) for r in extract(pages).collect()) == [(0, 0), (1, 82), (1, 82)]
    assert extract(pages.where("false")).count() == 0


def test_long_page():
    assert main_text("<article>" + A * 20_000 + "</article>").count("\n") == 19_999


def pages_of_articles():
    return [h for (h,) in duckdb.sql(f"select html from '{DATA}/sf0.01/pages.parquet' order by page_id").fetchall() if h and "<article>" in h]


def nameless(html):
    """Only div where names said something, and no class, id or role."""
    html = re.sub(r"<(/?)(?:article|nav|footer|aside|header|section|main|form)\b[^>]*>", r"<\1div>", html)
    return re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|\S+?(?=[\s>]))", "", html)


FOOTER = "<div><p>Imprint and terms, all rights are reserved here.</p></div>"
COMMENT = "<div><p>First! I was here before all of you.</p></div>"
ADVERT = "<div>Buy now, it is cheap.</div>"


def beside(html):
    return nameless(html.replace("</article>", "</article>" + FOOTER, 1))


def comment_within(html):
    return nameless(html.replace("<article>", "<article>" + COMMENT, 1))


def advert_within(html):
    head, article = html.split("<article>", 1)
    return nameless(head + "<article>" + article.replace("</p>", "</p>" + ADVERT, 1))


@pytest.mark.parametrize(("change", "least", "without"), [(nameless, 0.98, 1), (beside, 0.98, 1), (comment_within, 0.95, 0.05), (advert_within, 0.95, 0.1)])
def test_without_names_the_ratios_decide(change, least, without):
    pages = pages_of_articles()

    def right(threshold):
        return sum(main_text(change(h), threshold) == article_of(h) for h in pages) / len(pages)

    assert right(THRESHOLD) >= least
    assert right(0.0) <= without


@pytest.mark.parametrize("unit", ["<div>", "<b>", "<a", '<a "', "<div class=ad>x", "<b><li>x", "</x>", "<!x", "<form>x", "<script></script"])
def test_time_is_linear_in_broken_pages(unit):
    def seconds(size):
        t = time.process_time()
        main_text(unit * (size // len(unit)))
        return time.process_time() - t

    seconds(10_000)
    assert seconds(400_000) < 8 * seconds(100_000) + 0.3
