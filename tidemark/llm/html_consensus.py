"""Main text of web pages by consensus host paths.

Every page's containers are scored; the best one, widened to the article it is part of, votes, by its path of tags and
classes with changing parts removed, for how pages of its host are built.  The
votes are counted per host in Spark and each page's text is chosen by the paths
that won on its host.  A page is parsed once; its blocks are written with their
containers until the votes are known.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, materialize

# Paths with at least this share of a host's votes win (so at most 20 a host).
WINNING_SHARE = 0.05
# Blocks beside the best container belong to it up to this share of link text; one of them has so many characters.
FEW_LINKS = 0.3
RUNNING = 20

# Fixed values of HTML and of common page design.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes template svg select".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
table tbody td tfoot th thead tr ul""".split())
CONTAINER = frozenset("article body div main section td blockquote center details".split())
CLOSES_P = BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
               "option": ("option",)}
SCOPE = frozenset("table td th caption ul ol dl div section article main aside nav body html".split())
LEFT_OUT = frozenset("nav header footer aside form menu button dialog head search".split())
LEFT_OUT_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs
comment comments consent cookie cookies copyright disqus dropdown footer form gdpr header login masthead menu modal nav navbar
navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended
related replies reply respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription
toolbar topbar widget widgets""".split())
THREAD_NAMES = frozenset("comment comments disqus replies reply respond".split())
# Words that say nothing about what an element is for; short ones (a prefix of a site) do not either.
NEUTRAL_NAMES = frozenset("""area article articles body bottom box button buttons block bottom center col column container content count
entry group heading icon icons info inner inline item items left link links list main message module outer page panel post posts
right row section site slot stories text thread title top unit wrap wrapper""".split())
SHORT_NAME = 3
PHRASING = frozenset("""a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark output q s samp small span strong
sub sup time tt u var""".split())
LEFT_OUT_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
LIKELY_NAMES = frozenset("article blog body content entry hentry main page post story text".split())

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_BETWEEN = re.compile(r"[\s/]*")
_ATTR_NAME = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_PLAIN_VALUE = re.compile(r"[^\s>]*")
# A longer path is named by its digest.
LONG_PATH = 200
_NAME = re.compile(r"[A-Za-z]+")


@dataclass(slots=True)
class Container:
    path: str
    outer: int
    likely: bool
    tag: str = ""
    score: float = 0.0


class Tags:
    """The tags of a page from left to right, in time linear in its length.

    As in a browser, a quote counts only where an attribute's value begins.  A
    tag that would swallow the rest of the page (its quote closes after the last
    ``>``) ends at the first ``>`` instead, and so do all tags after it; a ``<``
    behind which no ``>`` comes is text.
    """

    def __init__(self, page: str):
        self.page = page
        self.last_end = page.rfind(">")
        self.last_quote = {q: page.rfind(q) for q in "\"'"}
        self.simple = False
        self.unclosed: set[str] = set()

    def next(self, at: int) -> tuple[int, int, str, str, dict[str, str]] | None:
        """(start, end, kind, name, attributes); kind is "<", "/" or "!" (nothing to see)."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0 or start + 1 >= len(page):
                return None
            c = page[start + 1]
            if page.startswith("!--", start + 1):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, "!", "", {}
            if c in "!?" or c == "/" and not page[start + 2:start + 3].isalpha():
                end = page.find(">", start) if start <= self.last_end else -1
                return start, len(page) if end < 0 else end + 1, "!", "", {}
            if start > self.last_end:
                return None
            name = _TAG_NAME.match(page, start + 1 + (c == "/"))
            if name:
                end, given = self._attributes(name.end())
                return start, end, "/" if c == "/" else "<", name[0].lower(), given
            at = start + 1

    def _attributes(self, at: int) -> tuple[int, dict[str, str]]:
        page, given, begin = self.page, {}, at
        while not self.simple:
            at = _BETWEEN.match(page, at).end()
            if at >= len(page):
                self.simple = True
                break
            if page[at] == ">":
                return at + 1, given
            name = _ATTR_NAME.match(page, at)
            equals = _EQUALS.match(page, name.end())
            value, at = "", name.end()
            if equals:
                at = equals.end()
                quote = page[at:at + 1]
                if quote and quote in "\"'" and at < self.last_quote[quote]:
                    end = page.find(quote, at + 1)
                    value, at = page[at + 1:end], end + 1
                else:
                    plain = _PLAIN_VALUE.match(page, at)
                    value, at = plain[0], plain.end()
            given.setdefault(name[0].lower(), value)
        return page.find(">", begin) + 1, {}

    def after_end_tag(self, name: str, at: int) -> int | None:
        """The place behind the next end tag of this name; None if there is none."""
        if name in self.unclosed:
            return None
        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(self.page, at)
        if end is None:
            self.unclosed.add(name)
        return end and end.end()


@dataclass(slots=True)
class Named:
    """An element whose class or id has a word of ``LEFT_OUT_NAMES``; outer is the named element around it."""

    outer: int
    step: str
    thread: bool
    titled: bool = False
    weight: float = 0.0
    ignored: bool = False


def _names(value: str) -> set[str]:
    """The words of a class or id: ``main-Nav_2`` has main and nav."""
    split = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
    return {w.lower() for w in _NAME.findall(split)}


def _is_furniture(given: dict[str, str]) -> bool:
    """Whether a class or the id names furniture and nothing else: ``share-buttons``
    does, ``share-price`` does not."""
    for name in [*given.get("class", "").split(), given.get("id", "")]:
        words = _names(name)
        if words & LEFT_OUT_NAMES and all(w in LEFT_OUT_NAMES or w in NEUTRAL_NAMES or len(w) <= SHORT_NAME for w in words):
            return True
    return False


def _step(tag: str, classes: str) -> str:
    """One step of a generalised path: classes in order, numbers and long codes removed."""
    kept = []
    for name in classes.split():
        name = re.sub(r"[0-9]+", "", name.lower()).strip("-_")
        if name and len(name) <= 40 and name not in kept:
            kept.append(name)
    return ".".join([tag, *sorted(kept)])


def _without_named(containers: list[Container], blocks: list[tuple[int, str, float]], named: list[Named],
                   where: list[tuple[int, int]], articles: list[int]) -> list[tuple[int, str, float]]:
    """The blocks that the name rule leaves.  ``where`` has (named element, article) of each block, ``articles`` the
    named element around each article or main.

    The name is ignored on an element that holds more running text than all that is left, and on those around it: a
    wrapper named for its layout.  Counted are its text outside named elements within, or its largest article.  Where
    it has no title and no article, the rest must not hold a likely container with a good share of its text, and a
    thread of comments is never taken for the page.
    """
    worth = [len(text) * (1.0 - links) for _, text, links in blocks]
    clean, inner = [0.0] * len(named), [0.0] * len(articles)
    for w, (n, a) in zip(worth, where, strict=True):
        if n >= 0:
            clean[n] += w
            if a >= 0 and articles[a] == n:
                inner[a] += w
    largest: dict[int, float] = {}
    for n, w in zip(articles, inner, strict=True):
        if n >= 0 and w > 0:
            largest[n] = max(largest.get(n, 0.0), w)
    for n, e in enumerate(named):
        e.weight, e.titled = largest.get(n, clean[n]), e.titled or n in largest

    def ignore(n: int) -> None:
        while n >= 0 and not named[n].ignored:
            named[n].ignored = True
            n = named[n].outer

    rest = likely = 0.0

    def count() -> None:
        nonlocal rest, likely
        rest = likely = 0.0
        for w, (at, _, _), (n, _) in zip(worth, blocks, where, strict=True):
            if n < 0 or named[n].ignored:
                rest += w
                likely += w if containers[at].likely else 0.0

    alike = defaultdict(list)
    for n, e in enumerate(named):
        alike[e.step, e.outer].append(n)
    count()
    for n in sorted((n for n, e in enumerate(named) if e.weight > 0), key=lambda n: -named[n].weight):
        e = named[n]
        if e.weight <= rest:
            break
        if not e.ignored and (e.titled or not e.thread and likely < 0.25 * e.weight):
            for k in alike[e.step, e.outer]:
                ignore(k)
            count()
    return [b for b, (n, _) in zip(blocks, where, strict=True) if n < 0 or named[n].ignored]


def parse(page: str, by_name: bool = True) -> tuple[list[Container], list[tuple[int, str, float]]]:
    """Containers of the page, and its blocks as (container, text, share of link text).

    Blocks of menus, headers, footers, sidebars, notices, adverts, forms and
    comments are left out, as are scripts, styles and markup.  Unclosed and
    wrongly nested tags are closed where a browser would.  What classes and ids
    name is left out unless it holds the page's text (``_without_named``), and
    a page of which nothing would be left is read without that rule.
    """
    containers = [Container("", -1, False)]
    blocks: list[tuple[int, str, float]] = []
    named: list[Named] = []
    articles: list[int] = []
    where: list[tuple[int, int]] = []
    # Open elements: (tag, container, left out, inside a link, named element, article).
    stack: list[tuple[str, int, bool, bool, int, int]] = [("", 0, False, False, -1, -1)]
    # Where each tag, and each tag of SCOPE, is open.
    depths: dict[str, list[int]] = defaultdict(list)
    scopes: list[int] = []
    held: list[str] = []
    links = 0
    skipped = False

    def close_block() -> None:
        nonlocal links
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text and not stack[-1][2]:
                blocks.append((stack[-1][1], text, min(1.0, links / len(text))))
                where.append(stack[-1][4:])
            held.clear()
        links = 0

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in BLOCK or stack[-1][4] != stack[-2][4]:
                close_block()
            tag = stack.pop()[0]
            depths[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    def close(name: str, anywhere: bool = False) -> None:
        """Close the innermost such element, if no element of ``SCOPE`` lies within it."""
        if depths[name] and (anywhere or not scopes or scopes[-1] <= depths[name][-1]):
            pop_to(depths[name][-1])

    def write(text: str) -> None:
        nonlocal links
        if text and not stack[-1][2]:
            held.append(text)
            if stack[-1][3]:
                links += len(text.strip())

    at, size, tags = 0, len(page), Tags(page)
    while at < size:
        tag = tags.next(at)
        if tag is None:
            write(page[at:])
            break
        start, end, kind, name, given = tag
        write(page[at:start])
        at = end
        if kind == "!":
            continue
        if kind == "/":
            if name == "br":
                write(" ")
            else:
                close(name, anywhere=name in BLOCK)
            continue
        if name in RAW:
            if page[end - 2] != "/":
                at = tags.after_end_tag(name, at) or size
            write(" ")
            continue
        if name in BLOCK:
            if name in CLOSES_P:
                close("p")
            for same in CLOSES_SAME.get(name, ()):
                close(same)
            close_block()
        if name in VOID:
            write(" ")
            continue
        _, inside, out, link, around, article = stack[-1]
        given = {k: html.unescape(v) for k, v in given.items() if k in ("class", "id", "role", "hidden")}
        words = _names(given.get("class", "") + " " + given.get("id", ""))
        if not out:
            out = name in LEFT_OUT or given.get("role", "").lower() in LEFT_OUT_ROLES or "hidden" in given
            if by_name and not out and name not in ("html", "body", "article", "main") and (
                    _is_furniture(given) if article >= 0 else words & LEFT_OUT_NAMES):
                if name in PHRASING:
                    out = skipped = True
                else:
                    close_block()
                    named.append(Named(around, _step(name, given.get("class", "")), bool(words & THREAD_NAMES)))
                    around = len(named) - 1
            if out and name not in BLOCK and held:
                # An inline element that is left out does not end its block: skip to its end.
                at = tags.after_end_tag(name, at) or at
                continue
        if name == "h1" and around >= 0 and not out:
            named[around].titled = True
        if name in ("article", "main") and not out and not words & LEFT_OUT_NAMES:
            articles.append(around)
            article = len(articles) - 1
        if name in CONTAINER and not out:
            step = _step(name, given.get("class", ""))
            path = f"{containers[inside].path}>{step}" if containers[inside].path else step
            if len(path) > LONG_PATH:
                path = "#" + hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest()
            containers.append(Container(path, inside, name in ("article", "main") or bool(words & LIKELY_NAMES), name))
            inside = len(containers) - 1
        depths[name].append(len(stack))
        if name in SCOPE:
            scopes.append(len(stack))
        stack.append((name, inside, out, link or name == "a", around, article))
    pop_to(1)
    close_block()
    left = _without_named(containers, blocks, named, where, articles) if named else blocks
    return (containers, left) if left or not (named or skipped) else parse(page, by_name=False)


def score(containers: list[Container], blocks: list[tuple[int, str, float]]) -> int | None:
    """The container whose blocks hold the most running text; None where no block is left."""
    for at, text, links in blocks:
        worth = len(text) * (1.0 - links)
        factor = 1.0
        while at >= 0 and factor > 0.1:
            containers[at].score += worth * factor * (1.5 if containers[at].likely else 1.0)
            at, factor = containers[at].outer, factor * 0.6
    best = max(range(len(containers)), key=lambda k: (containers[k].score, -k))
    return best if blocks else None


def _within(containers: list[Container], path: str) -> set[int]:
    """Containers with this path and those inside them; outer ones always come first."""
    found: set[int] = set()
    for k, c in enumerate(containers):
        if c.path == path or c.outer in found:
            found.add(k)
    return found


def widen(containers: list[Container], blocks: list[tuple[int, str, float]], best: int) -> int:
    """The container of the whole article around the best one: headline, lead and trailing text beside it belong to it.

    That is the nearest article around it, or the nearest main whose other
    blocks have few links; else its outer container, as long as the blocks that
    this adds have few links and lie directly in it.  One named for an article
    may also add those of other containers in it.
    """
    last = list(range(len(containers)))
    for k in range(len(containers) - 1, 0, -1):
        last[containers[k].outer] = max(last[containers[k].outer], last[k])
    upto = [0] * (len(containers) + 1)
    for at, _, _ in blocks:
        upto[at + 1] += 1
    for k in range(len(containers)):
        upto[k + 1] += upto[k]

    def held(k: int) -> int:
        return upto[last[k] + 1] - upto[k]

    inside = _within(containers, containers[best].path)

    def added(k: int) -> list[tuple[int, str, float]]:
        return [b for b in blocks if k <= b[0] <= last[k] and b[0] not in inside]

    def running(more: list[tuple[int, str, float]]) -> bool:
        size = sum(len(text) for _, text, _ in more)
        return sum(len(text) * links for _, text, links in more) <= FEW_LINKS * size

    if containers[best].tag in ("article", "main"):
        return best
    k = containers[best].outer
    while k > 0 and containers[k].tag not in ("article", "main"):
        k = containers[k].outer
    if k > 0 and (containers[k].tag == "article" or running(added(k))):
        return k
    k, seen = containers[best].outer, held(best)
    while k >= 0:
        if held(k) > seen:
            more, seen = added(k), held(k)
            if more:
                own = [b for b in more if b[0] == k]
                whole = len(own) == len(more) or (containers[k].likely and containers[k].tag != "body")
                if not whole or not running(more) or max(len(b[1]) for b in more) < RUNNING and not containers[k].likely:
                    break
                best, inside = k, _within(containers, containers[k].path)
        k = containers[k].outer
    return best


@dataclass(slots=True)
class Reading:
    """A parsed page: its own best path, and its blocks with the containers they lie in."""

    own: str | None
    paths: list[str]
    outer: list[int]
    at: list[int]
    texts: list[str]

    def choose(self, winners: list[str]) -> str:
        """The main text: blocks in page order, joined by two newlines.

        The page's own best path is used if it won on the host, else the first
        winner the page has text under, else its own best path.
        """
        if self.own is None:
            return ""
        for path in [self.own] if self.own in winners else [*winners, self.own]:
            inside = [False] * len(self.paths)
            for k, (mine, outer) in enumerate(zip(self.paths, self.outer, strict=True)):  # outer ones come first
                inside[k] = mine == path or outer >= 0 and inside[outer]
            texts = [text for at, text in zip(self.at, self.texts, strict=True) if inside[at]]
            if texts:
                return "\n\n".join(texts)
        return ""

    def pack(self) -> str:
        return json.dumps([self.own, self.paths, self.outer, self.at, self.texts])

    @staticmethod
    def unpack(packed: str) -> Reading:
        return Reading(*json.loads(packed))


def read(page: str | None) -> Reading:
    containers, blocks = parse(page or "")
    best = score(containers, blocks)
    own = None if best is None else containers[widen(containers, blocks, best)].path
    # Containers without text, and without others that have some, are not needed any more.
    used = [False] * len(containers)
    for at, _, _ in blocks:
        while at >= 0 and not used[at]:
            used[at] = True
            at = containers[at].outer
    number, kept = {-1: -1}, []
    for k, c in enumerate(containers):
        if used[k]:
            number[k] = len(kept)
            kept.append(c)
    return Reading(own, [c.path for c in kept], [number[c.outer] for c in kept], [number[at] for at, _, _ in blocks], [t for _, t, _ in blocks])


def vote(page: str | None) -> str | None:
    """The path a page votes for; None for a page without text."""
    return read(page).own


def extract(page: str | None, winners: list[str]) -> str:
    """The main text of one page, given the paths that won on its host."""
    return read(page).choose(winners)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def read_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, host, path, reading): every page parsed once, with the path it votes for."""

    def make():
        def step(ids, urls, hosts, texts):
            found = [read(t) for t in texts]
            return [ids, urls, hosts, [r.own for r in found], [r.pack() for r in found]]
        return step

    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                          F.col(html_col).cast("string").alias("page"))
    kind = pages.schema[id_col].dataType.simpleString()
    return map_rows(source, ["id", "url", "host", "page"], f"id {kind}, url string, host string, path string, reading string", make)


def winning_paths(votes: DataFrame, share: float = WINNING_SHARE) -> DataFrame:
    """(host, paths) from votes (host, path): per host the paths that got ``share`` of its votes, most votes first."""
    votes = materialize(votes.where("path IS NOT NULL").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "path-votes")
    total = materialize(votes.groupBy("host").agg(F.sum("n").alias("total")), "host-votes")
    won = votes.join(total, "host").where(F.col("n") >= share * F.col("total"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return won.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): one row per page.

    A null or textless page has an empty text; a null url belongs to the host
    without a name; repeated rows each stay; other columns are ignored; an
    empty table gives an empty one.  The paths are written before they are
    joined: Spark broadcasts them only where their size allows, else it joins
    by sorting and splits a host with very many pages.
    """
    parsed = materialize(read_pages(pages, id_col, url_col, html_col), "page-readings")
    paths = materialize(winning_paths(parsed.select("host", "path")), "host-paths")
    joined = parsed.join(paths, "host", "left")

    def make():
        return lambda ids, urls, packed, wins: [ids, urls, [Reading.unpack(r).choose(w or []) for r, w in zip(packed, wins, strict=True)]]

    kind = pages.schema[id_col].dataType.simpleString()
    out = map_rows(joined, ["id", "url", "reading", "paths"], f"id {kind}, url string, text string", make)
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
