"""Tags as browsers see them, in linear time; parts of an article that only sound like furniture."""
import random
import time

import pytest

from tidemark.llm import html_consensus as H

BODY = "A long paragraph of running text about nothing in particular, long enough to be the text of a page. " * 3
BODY = " ".join(BODY.split())


@pytest.mark.parametrize("page, text", [
    ("<p title=it's>hello there</p>", "hello there"),
    ("<p title='it\"s' class=\"x'y\">hello there</p>", "hello there"),
    ("<p title=\"a>b\">hello there</p>", "hello there"),
    ("<p title=a\"b>hello</p><p title=c\"d>there</p>", "hello\n\nthere"),
    ("<p =x y = 'z' / w>hello</p>", "hello"),
    ("<p title=\"never closed>hello there</p>", "hello there"),
    ("<p a='>'>one</p><p b='>two</p>", "one\n\ntwo"),
    ("if x < y and y <z then", "if x < y and y <z then"),
    ("Let <math><mi>x</mi></math> be <object>this</object> or <canvas>that</canvas>.", "Let x be this or that."),
    ("a <!-- b --> c <!DOCTYPE x> d <?php e ?> f </> g", "a c d f g"),
    ("one <b>two</b x='>'> three", "one two three"),
    ("a &lt;b&gt; &amp;amp; c", "a <b> &amp; c"),
    ("<p>a<br>b<br/>c</br>d", "a b c d"),
])
def test_markup(page, text):
    assert H.extract(page, []) == text


@pytest.mark.parametrize("part", [
    '<p class="share-price">The share price rose.</p>', '<h2 id="search-algorithms">Search algorithms</h2>',
    '<h2 id="related-work">Related work</h2>', '<section id="header-files"><p>Header files are read first.</p></section>',
    '<div class="notice-of-motion">The motion was read.</div>', '<p class="comment-from-ceo">We are glad, they said.</p>',
    '<p class="byline">By Somebody</p>'])
def test_parts_that_only_sound_like_furniture_stay(part):
    import re
    words = re.sub("<[^>]*>", "", part)
    assert H.extract(f"<body><article><h1>T</h1><p>{BODY}</p>{part}<p>{BODY}</p></article></body>", []) == "\n\n".join(["T", BODY, words, BODY])


@pytest.mark.parametrize("part", [
    '<div class="share-buttons"><a href="#">Share</a></div>', '<section class="comments"><p>' + BODY + "</p></section>",
    '<div id="related-posts"><a href="#">More</a></div>', '<div class="ad-slot">Buy this</div>', '<p class="newsletter-signup">Sign up</p>',
    '<div class="td-social"><a href="#">Us</a></div>', '<aside><p>Beside it</p></aside>', "<form><p>Name</p></form>", '<div role="alert">Look</div>'])
def test_furniture_within_the_article_goes(part):
    assert H.extract(f"<body><article><h1>T</h1><p>{BODY}</p>{part}<p>{BODY}</p></article></body>", []) == "\n\n".join(["T", BODY, BODY])


@pytest.mark.parametrize("page", [
    "if x<y then " * 90_000, "<a b='" * 100_000 + ">", ("<p a=\"x>" * 100_001) + '"', "<div>" * 100_000 + "x", "</article>" * 50_000,
    "<section>" * 50_000 + "</article>" * 50_000, "<b>" * 1000 + "<div>" + "<i>" * 50_000 + "</b>" * 50_000, "<!--" * 250_000,
    "<p><span class='notice'>" * 50_000, "<select>" * 100_000, "<li><p>" * 50_000, "<" * 1_000_000, "<p>" + "</span>" * 100_000,
    "<div class='a1 b2'><article>" * 20_000 + "x"], ids=range(14))
def test_time_is_linear(page):
    began = time.process_time()
    H.extract(page, [])
    assert time.process_time() - began < 5


def test_paths_stay_short():
    containers, _ = H.parse("<div class='wide-column'>" * 8000 + "x")
    assert sum(len(c.path) for c in containers) < 8001 * (H.LONG_PATH + 1) and len({c.path for c in containers}) == len(containers)


@pytest.mark.parametrize("seed", range(8))
def test_generated_templates(seed):
    """Nested templates with furniture in random places: what is left is what was put into the article."""
    rng = random.Random(seed)
    kept = []

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))

    def paragraph():
        kept.append(words(rng.randint(25, 60)))
        return f"<p class='{rng.choice(['lead', 'p-1', 'body text', ''])}'>{kept[-1]}</p>"

    def furniture():
        return rng.choice([f"<nav><ul><li><a href='#'>{words(2)}</a></ul></nav>", f"<div class='share-links'><a>{words(1)}</a></div>",
                           f"<aside>{words(9)}</aside>", f"<div class='ad'>{words(6)}</div>", f"<script>var x = '<p>{words(3)}</p>';</script>",
                           f"<style>p {{}}</style><form><input><p>{words(3)}</p></form>"])

    def section(depth):
        inner = "".join(section(depth - 1) if depth and rng.random() < .4 else rng.choice([paragraph, paragraph, furniture])()
                        for _ in range(rng.randint(2, 4)))
        return f"<{'div' if depth else 'section'} class='level-{depth}'>{inner}</{'div' if depth else 'section'}>"

    title = words(4)
    body = section(3) + paragraph()
    page = f"<html><head><title>x</title></head><body>{furniture()}<main><article><h1>{title}</h1>{body}</article></main><footer>{words(8)}</footer></body></html>"
    assert H.extract(page, []) == "\n\n".join([title, *kept])
    reading = H.read(page)
    assert H.Reading.unpack(reading.pack()) == reading
