import pytest
from cases import pages
from test_html import ARTICLE, TEXT, page

from tidemark.llm import html_consensus as H

BODY = " ".join(["A long sentence of the story that runs on."] * 20)
AROUND = f'<div class="related"><p>{"Other stories to read. " * 5}</p></div><div class="comments"><p>{"I think so too. " * 20}</p></div>'


@pytest.mark.parametrize("wrapper", [
    '<div class="has-sidebar">', '<div id="page" class="no-sidebar">', '<div class="header-layout">', '<section class="post related-topic">',
    '<page-root class="no-sidebar">'])
def test_wrappers_named_for_their_layout_keep_the_article(wrapper):
    end = f"</{wrapper[1:].split()[0]}>"
    assert H.extract(page(wrapper + ARTICLE + end), []) == TEXT
    for inner in (f"<article><h1>T</h1><p>{BODY}</p></article>", f"<h1>T</h1><p>{BODY}</p>"):
        for before in ("", "<p>Home page</p>"):
            assert H.extract(f"<body>{before}{wrapper}{inner}{AROUND}{end}</body>", []) .endswith(f"T\n\n{BODY}")
    assert H.extract(f"<body>{wrapper}<p>{BODY}</p>{end}{AROUND}</body>", []) == BODY
    nested = f'<body>{wrapper}<div class="banner-top"><article><p>{BODY}</p></article></div>{AROUND}{end}</body>'
    assert H.extract(nested, []) == BODY


def test_named_parts_stay_out_beside_an_article():
    story = f"<article><h1>T</h1><p>{BODY}</p></article>"
    comments = '<div id="comments"><article class="comment"><p>' + "I think so too. " * 200 + "</p></article></div>"
    footer = f'<div class="footer"><p>{"All rights are kept by us. " * 50}</p></div>'
    cards = '<div class="related">' + f"<article><h2>Card</h2><p>{BODY[:200]}</p></article>" * 9 + "</div>"
    for more in (comments, footer, cards, comments + footer + cards):
        assert H.extract(f"<body>{story}{more}</body>", []) == f"T\n\n{BODY}"
    assert H.extract(f'<body><div class="no-sidebar">{story}{comments}{cards}</div></body>', []) == f"T\n\n{BODY}"


def test_page_of_named_parts_only_is_read():
    assert H.extract("<body><p><span class='notice'>only this</span></p></body>", []) == "only this"
    assert H.extract("<body><div class='comments'><p>only this</p></div></body>", []) == "only this"


def test_host_of_wrapped_pages(spark):
    rows = [(i, f"http://h.example/{i}", page(f'<div class="has-sidebar"><article><p>{BODY} {i}</p></article></div>')) for i in range(5)]
    out = {r.page_id: r.text for r in H.extract_main_text(pages(spark, rows)).collect()}
    assert out == {i: f"{BODY} {i}" for i in range(5)}
