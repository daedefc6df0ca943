from barlake.llm import pages, queries

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{margin:0}</style>
<script>var t="</p><p>no</p>";</script></head><body class="home">
<header><h1>Site</h1><nav><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav></header>
<!-- <p>hidden</p> --><div class="ad-box">Buy now, a rather long advert text that looks like prose.</div>
<div id="cookie-notice"><p>We use cookies to make this page a bit slower for everybody.</p></div>
<article><header><h1>A&nbsp;heading</h1></header>
<p><b>First line.<br><p>Second &lt;tag&gt; &eacute;\n   line <i>in</i>line<br>after<p>
<ul><li>one<li>two</ul><blockquote>quote</blockquote>
<aside>read this too</aside><form><p>Name</p><input name=n><button>Go</button></form>
<p>Last.</p><section class="comments"><h3>Comments</h3><p>I disagree with all of this, said a reader.</p></section></article>
<div class="sidebar"><p>Other stories</p></div><footer>&copy; me</footer>"""

WANT = ("A heading\nFirst line.\nSecond <tag> é line inline after\none\ntwo\nquote\nLast.")


def test_article_of_a_full_page():
    assert pages.main_text(PAGE) == WANT


def test_pages_without_an_article():
    html = ("<body><div id=menu><a href=a>a</a> <a href=b>b</a> <a href=c>c</a></div><div id=x>"
            + "".join(f"<p>Paragraph {i} has a good number of words in a row.</p>" for i in range(6))
            + "<p>Short.</p></div><div><a href=1>1</a><a href=2>2</a><a href=3>3</a><a href=4>4</a></div></body>")
    got = pages.main_text(html).split("\n")
    assert got[0].startswith("Paragraph 0") and got[-1] == "Short." and len(got) == 7


def test_odd_pages(spark):
    odd = [None, "", "plain words", "<p>", "<<<>>>", "</p></div>", "<article></article>", "<article>x", "&#0;&bogus;&amp",
           "<p>" * 3000 + "deep" + "</p>" * 3000, "<div>" * 3000 + "deep" + "</div>" * 3000,
           "<article>" + "<p>word and word</p>" * 20_000 + "</article>", "<script>unclosed", "<!-- unclosed"]
    df = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got[0] == got[1] == got[3] == got[6] == "" and got[2] == "plain words" and got[7] == "x"
    assert got[9] == got[10] == "deep" and got[11].count("\n") == 19_999 and got[12] == got[13] == ""
    assert pages.extract(df.limit(0)).count() == 0
    clash = pages.extract(df.withColumn("text", df.html))       # the output column is replaced
    assert clash.columns == ["page_id", "html", "text"] and clash.where("page_id = 2").first().text == "plain words"


def test_smoothing_keeps_a_constant():
    assert all(abs(x - 3) < 1e-9 for x in pages.smoothed([3.0] * 9))


def test_query_on_the_fixture(spark):
    """Every page of the fixture has one article: its blocks in order, nothing else."""
    import html
    import re
    sf = "/root/testdata/sf0.001"
    source = {r.page_id: r.html for r in queries.table(spark, sf, "pages").collect()}
    rows = queries.op6_html(spark, sf).collect()
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
