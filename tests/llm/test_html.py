from cases import pages

from tidemark.llm import catalog, html_consensus as H

ARTICLE = "<article><h1>T &amp; t</h1><p>one\n  two<br>three <b>four</b><p>five&nbsp;six</article>"
NOISE = ('<header>top</header><nav><ul><li><a href=x>menu</a></ul></nav><script>var t="</p><p>no";</script><style>p{}</style>'
         '<!-- a <p>comment</p> --><div class="ad-box">buy</div><form><input><p>mail</p></form>')
TAIL = '<aside>side</aside><div id="comments"><p>reader says a lot of things here</p></div><footer>&copy; x</footer>'
TEXT = "T & t\n\none two three four\n\nfive six"


def page(body):
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{NOISE}{body}{TAIL}</body></html>"


def test_blocks_and_noise():
    assert H.extract(page(ARTICLE), []) == TEXT
    assert H.extract(page('<div class="post-12">' + ARTICLE.replace("article", "section") + "</div>"), []) == TEXT
    for junk in (None, "", "<", "<p", "<!--", "<script>", "&#x110000;", "</p></div>", "<div class='ad'>x</div>"):
        assert isinstance(H.extract(junk, ["body>article"]), str)
    assert H.extract("plain text", []) == "plain text"
    assert H.extract("<p a='x>y' b=\">\">in</p>", []) == "in"
    assert len(H.extract("<p>" + "word " * 300_000 + "</p>", [])) == 5 * 300_000 - 1
    assert H.extract("<div>" * 3000 + "deep" + "</div>" * 3000, []) == "deep"


def test_generalised_paths():
    a = H.vote(page('<div class="post-12 x"><p>some words in a block</p></div>'))
    assert a == H.vote(page('<div class="x post-99"><p>some other words in it</p></div>')) == "body>div.post.x"


def test_consensus_corrects_an_odd_page(spark):
    usual = [(i, "http://H.example/%d" % i, page(f'<div class="story"><p>{"story words " * 9}</p></div><div class="box"><p>box</p></div>'))
             for i in range(40)]
    odd = (100, "https://u@h.example:80/x", page(f'<div class="story"><p>the story</p></div><div class="box"><p>{"box words " * 30}</p></div>'))
    other = (101, "http://other.example/", page(f'<div class="box"><p>{"box words " * 3}</p></div>'))
    out = {r.page_id: r.text for r in H.extract_main_text(pages(spark, [*usual, odd, other, (102, None, None)])).collect()}
    assert out[100] == "the story" and out[101] == " ".join(["box words"] * 3) and out[102] == ""
    assert out[0] == " ".join(["story words"] * 9)


def test_awkward_rows(spark):
    rows = [(None, None, None), (1, "", ""), (2, "no url", ARTICLE), (2, "no url", ARTICLE), (3, None, page(ARTICLE))]
    out = H.extract_main_text(pages(spark, rows))
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(r.text for r in out.collect()) == ["", "", TEXT, TEXT, TEXT]
    assert H.extract_main_text(pages(spark, [])).count() == 0


def test_query_gives_the_articles(spark, sf_small):
    import html
    import re
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    out = catalog.op3_host_paths(spark, sf_small).collect()
    assert len(out) == len(source)
    for r in out:
        inner = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
