import pytest
from cases import pages
from test_html import page

from tidemark.llm import html_consensus as H

BODY = " ".join(["A long sentence of the story that runs on."] * 30)
LEAD = "The lead says in short what the story is about."
PARTS = f'<h1>The title</h1><p>{LEAD}</p><div class="entry-content"><p>{BODY}</p></div><p>Written down by the editor.</p>'
TEXT = f"The title\n\n{LEAD}\n\n{BODY}\n\nWritten down by the editor."
LINKS = "<ul>" + "".join(f'<li><a href="/{k}">Another story of this site</a></li>' for k in range(9)) + "</ul>"


@pytest.mark.parametrize("whole", [
    f"<article>{PARTS}</article>", f"<main>{PARTS}</main>", f'<div class="post">{PARTS}</div>', f'<div class="x">{PARTS}</div>', PARTS,
    f"<article><div><div>{PARTS}</div></div></article>", f'<div class="x"><section><div>{PARTS}</div></section></div>',
    f'<article><div class="top"><h1>The title</h1><p>{LEAD}</p></div><div class="entry-content"><p>{BODY}</p></div>'
    "<p>Written down by the editor.</p></article>"])
def test_title_lead_and_end_beside_the_body_are_kept(whole):
    assert H.extract(page(whole), []) == TEXT
    assert H.extract(page(whole), [H.vote(page(whole))]) == TEXT


def test_link_lists_and_boxes_beside_it_are_not():
    inner = f'<div class="entry-content"><p>{BODY}</p></div>'
    for more in (LINKS, f"<div>{LINKS}</div>", '<div class="box"><p>Buy now</p></div>'):
        for around in ("{}", "<main>{}</main>", '<div class="x">{}</div>'):
            if around == "<main>{}</main>" and "box" in more:
                continue
            assert H.extract(page(around.format(inner + more)), []) == BODY


def test_deep_and_wide_pages():
    deep = "<div>" * 3000 + f"<p>{BODY}</p>" + "</div>" * 3000
    assert H.extract(deep, []) == BODY
    assert H.extract("<div>" + f"<div><p>{LEAD}</p></div>" * 5000 + "</div>", []) == "\n\n".join([LEAD] * 5000)


def test_host_of_nested_pages(spark):
    rows = [(i, f"http://h.example/{i}", page(f"<article>{PARTS}</article>{LINKS}")) for i in range(5)]
    out = {r.page_id: r.text for r in H.extract_main_text(pages(spark, rows)).collect()}
    assert out == dict.fromkeys(range(5), TEXT)
