"""Main text of html pages: flat text blocks, classified by a decision tree.

A page is cut into flat text blocks at block-level tags (scripts, styles,
comments and the like never enter).  A block is described by its word count
and link density, those of its two neighbours, and what encloses it (article,
menu, header, footer, sidebar, form, a class or id that speaks of adverts,
notices or comments).  A decision tree, grown on the small labelled table below
by Gini impurity, says which blocks are the article's.

A hint is read from a name's own words, not from what it says of state or
category (has-sidebar, category-reviews), nor beside a name that leads with a
content word (content sidebar-left).  Hints of the elements that hold the
article, or are it, do not count.  The article is the page's main element or
first article element in no hinted box, else its first box named for content in
none, else the first of both in boxes with only a part of a name as a hint (or
before that the only article element outside hinted boxes, whatever its own
name), else the first article element in any box.

Defined results: a null or empty html, or one without article text, gives an
empty text; unclosed tags, stray ends, markup that breaks off and very long pages
are read to the end; white space inside a block (decoded spaces included) is one
space and blocks are joined by one newline; only page_id, url and html are read; repeated rows get
equal results.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of html by what they do to a text block.
DROPPED = frozenset("script style noscript template svg math iframe object canvas audio video head title select option textarea button datalist map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that speak of what is not the article.
HINTS = {
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted teaser outbrain taboola dfp".split(),
    "notice": "cookie cookies consent gdpr notice notices notification alert alertdialog dialog popup modal overlay paywall subscribe subscription newsletter signup login disclaimer warning toast".split(),
    "comment": "comment comments commentlist disqus reply replies respond discussion feedback review reviews".split(),
    "side": "sidebar side aside widget widgets related recommended recommendations more popular trending share sharing social tags tagcloud toc rail complementary".split(),
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar tabs pagination pager search skip".split(),
    "frame": "header masthead footer foot copyright colophon bottom legal contentinfo".split(),
}
HINT_OF = {word: kind for kind, words in HINTS.items() for word in words}
#: Words that begin names of a state or category.
ABOUT = frozenset("has have with without no not is category cat tag tagged topic format layout js".split())
CONTENT_HINTS = frozenset("article content main post entry story body text articlebody".split())

# A quoted value begins after an equals sign only; elsewhere a quote is a character like any other.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)?)*)(?:>|\Z)",
    re.S,
)
_ATTRS = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_article", "page_has_article", "heading", "item", "set_apart")
# What sets a block apart from the article, whatever else encloses it.
APART = frozenset(("nav", "header", "footer", "aside", "form", "hidden", *HINTS))


@dataclass
class Block:
    text: str
    words: int
    linked: int
    inside: frozenset


@dataclass(eq=False)
class _Box:
    """An open element: what it says about the text in it by its kind and by its names."""

    name: str
    kinds: frozenset
    hints: frozenset
    whole: bool  # a name that leads is hint words only
    content: bool  # named for content


def _hides(name: str, value: str) -> bool:
    return name == "hidden" or (name == "style" and bool(_NONE.search(value))) or (name == "aria-hidden" and value.strip().lower() == "true")


def _box(name: str, attrs: str) -> _Box:
    out = {name} & {"article", "main", "nav", "header", "footer", "aside", "form", "li", "figure"} | ({"heading"} if name in HEADINGS else set())
    hints, whole, content = set(), False, False
    if attrs and name not in ("html", "body", "main"):  # their names speak of the whole page
        for m in _ATTRS.finditer(attrs):
            if m[1].lower() not in ("class", "id", "role"):
                continue
            named = [[w for w in _SPLIT.split(token) if w] for token in (m[2] or m[3] or m[4] or "").lower().split()]
            named = [words for words in named if words and words[0] not in ABOUT]
            words = {w for token in named for w in token}
            if words & CONTENT_HINTS:
                out.add("content")
            if named and named[0][0] in CONTENT_HINTS and not any(w in HINT_OF for w in named[0]):
                content = True
                continue
            hints |= {HINT_OF[w] for w in words if w in HINT_OF}
            whole |= bool(named) and all(w in HINT_OF for w in named[0])
        if content and not whole:
            hints = set()
        if any(_hides(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTRS.finditer(attrs)):
            out.add("hidden")
    return _Box(name, frozenset(out), frozenset(hints), whole, content)


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page in order."""
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[_Box] = []
    inside: tuple[_Box, ...] = ()
    found: list[tuple[str, int, int, tuple[_Box, ...]]] = []
    tier, article = 9, ()  # how sure the article met is, and the boxes down to it
    named: list[tuple[_Box, ...]] = []  # article elements with hints of their own, outside hinted boxes
    early = False
    in_link, dropped, at = False, "", 0
    page = page or ""

    def close() -> None:
        words = _html.unescape("".join(text)).split()
        if words:
            found.append((" ".join(words), len(words), len(_html.unescape("".join(linked)).split()), inside))
        text.clear()
        linked.clear()

    while m := _TOKEN.search(page, at):  # from the end of what was read last: a script may hold what looks like markup
        if not dropped and m.start() > at:
            text.append(page[at : m.start()])
            if in_link:
                linked.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if dropped:
            if m[1] and name == dropped:
                dropped = ""
            continue
        if name in DROPPED:
            if not m[1] and not m[3].endswith("/"):
                # the end tag, not a tag inside the element, ends it
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                if name in ("head", "svg", "math", "object", "select", "map", "button", "datalist", "audio", "video", "canvas"):
                    dropped = name if end else ""
                else:
                    at = page.find(">", end.start()) + 1 or len(page) if end else (len(page) if name in ("script", "style", "title", "textarea") else at)
            continue
        if name == "a":
            in_link = not m[1]
            continue
        if name in INLINE:
            if name in ("br", "img", "input"):
                text.append(" ")
            if name != "span":  # a span may be named for an advert or a notice
                continue
        if name not in INLINE:
            close()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    if name in INLINE and text and (stack[k].kinds or stack[k].hints):
                        close()
                    del stack[k:]
                    break
            else:
                continue
        elif name not in VOID and not m[3].endswith("/"):
            box = _box(name, m[3])
            if name == "p" or name == "li" or name in HEADINGS:
                # these end one another where the end tag was left out
                while stack and stack[-1].name in (("p", "span", *HEADINGS) if name != "li" else ("p", "span", "li")):
                    stack.pop()
            if name in INLINE and (box.kinds or box.hints) and text:
                close()
            if (name in ("article", "main") or box.content) and not any(b.kinds & APART for b in stack):
                outer = 0 if not any(b.hints for b in stack) else 1 if not any(b.whole for b in stack) else 2
                if name == "article" and box.hints:
                    if not outer:
                        early |= tier > 2
                        named.append((*stack, box))
                else:
                    rank = 0 if name == "main" else (0, 2, 3)[outer] if name == "article" else (1, 2, 9)[outer]
                    if rank < tier:
                        tier, article = rank, (*stack, box)
            stack.append(box)
        else:
            continue
        inside = tuple(b for b in stack if b.kinds or b.hints)
    if not dropped and at < len(page):
        text.append(page[at:])
    close()
    if len(named) == 1 and early and tier > 1:
        article = named[0]
    free = {id(b) for b in article}
    for said, words, links, boxes in found:
        kinds = frozenset().union(*(b.kinds if id(b) in free else b.kinds | b.hints for b in boxes))
        out.append(Block(said, words, links, kinds))
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    n = len(found)
    words = np.array([0, *(b.words for b in found), 0], dtype=float)
    links = np.array([0, *(min(1.0, b.linked / b.words) for b in found), 0], dtype=float)
    has = float(any(b.inside & {"article", "main"} for b in found))
    rows = np.zeros((n, len(FEATURES)))
    rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4], rows[:, 5] = words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:]
    for i, b in enumerate(found):
        k = b.inside
        rows[i, 6:] = (bool(k & {"article", "main", "content"}), has, "heading" in k, "li" in k, bool(k & APART))
    return rows


# The labelled table: small pages whose blocks begin with + (the article's) or - (not).
# Elements that are never the article's, each put before, between and after paragraphs below.
ENCLOSING = (
    "nav", "footer", "aside", "form", "header", "div class=advert", "div class=cookie-notice", "section class=comments",
    "div class=sidebar", "div class=menu", "div id=footer", "div class=header", "ul class=breadcrumbs", "div role=dialog", "div class=sponsored",
)
_LONG = "a paragraph that goes on for quite a number of words until it comes to its end, which takes one or two lines of text"
_SHORT = "few words"


def _labelled_pages() -> list[str]:
    """LABELLED and, for every enclosing element, pages with and without an article element around or beside it."""
    out = list(LABELLED)
    for few in ("Few", "Few words", "A few words more"):
        for link in ("", "<a href=x>link</a> "):
            out.append(f"<body><article><h1>+{few}</h1><p>+{_LONG}</p><p>+{few} {link}</p></article>")
            out.append(f"<body><article><p>+{few} {link}{_LONG}</p><p>+{few}</p></article><footer>-{few}</footer>")
            out.append(f"<body><div><h1>+{few}</h1><p>+{_LONG}</p><p>+{few}</p><p>+{_LONG} {link}</p></div><div><a href=x>-{few}</a></div>")
            out.append(f"<body><div><a href=x>-{few}</a> <a href=y>{few}</a></div><div><h2>+{few}</h2><p>+{_LONG} {link}</p></div><div><p>-{few}</p></div><div><a href=x>-{few}</a></div>")
    for wrapper in ("article class='post category-reviews tag-popular'", "div class='content has-sidebar'", "div class='page header-fixed'", "div id=content class='sidebar-left'", "article class=review"):
        inner = ("<article>", "</article>") if "page" in wrapper else ("", "")
        out.append(f"<body><nav><a href=x>-{_SHORT}</a></nav><{wrapper}>{inner[0]}<h1>+{_SHORT}</h1><p>+{_LONG}</p><div class=share-buttons>-{_SHORT}</div><p>+{_LONG}</p>{inner[1]}</{wrapper.split()[0]}><div class='related-posts'>-{_LONG}</div>")
    for element in ENCLOSING:
        name = element.split()[0]
        for text in (_LONG, f"{_LONG} {_LONG} {_LONG}", _SHORT, f"<a href=x>{_SHORT}</a>", f"<a href=x>{_SHORT}</a> and {_LONG}"):
            box = f"<{element}><p>-{text}</p></{name}>"
            for before, after in ((_LONG, _LONG), (_SHORT, _SHORT), (_LONG, _SHORT)):
                out.append(f"<body>{box}<article><h1>+{_SHORT}</h1><p>+{before}</p><p>+{after}</p></article>{box}")
                out.append(f"<body><p>+{_LONG} {before}</p>{box}<p>+{_LONG} {after}</p>{box}")
                out.append(f"<body><article><p>+{before} <a href=x>{_SHORT}</a></p><p>+<a href=x>{_SHORT}</a> {after}</p><p>+{after}</p></article>{box}")
                out.append(f"<body><p>+{_LONG} {_LONG} <a href=x>{_SHORT}</a> {before}</p>{box}<p>+{_LONG} {after} {_LONG}</p>{box}")
            if name != "header":
                out.append(f"<body><article><p>+{_LONG}</p>{box}<p>+{_SHORT}</p>{box}<p>+{_SHORT}</p></article><p>-{_LONG}</p><p>-{_SHORT}</p>")
    return out


LABELLED = (
    "<body><header>-Site name</header><nav><a href=x>-Home</a> <a href=y>News</a></nav><article><h1>+A headline of some words</h1><p>+A first paragraph that runs over quite a few words to say what it is about.<p>+Short.<p>+Read <a href=z>this</a> as well before the end of the story.</article><footer>-(c) site, all rights kept by the site and those who write for it every day of the week</footer>",
    "<body><nav><ul><li><a href=a>-One</a><li><a href=b>-Two</a><li><a href=c>-Three</a></ul></nav><div class=ad>-Buy these things now while they last and save</div><article><h1>+Title</h1><p>+Text one.</p><p>+Be.</p><p>+More text follows here, with a number of words that fill one line at least.</p><ul><li>+first point of the list<li>+second point of the list</ul></article><aside>-Also on this site you may find a paragraph of many words that has nothing to do with the page</aside><footer>-Imprint of the site</footer>",
    "<body><div id=cookie-notice>-We use cookies to keep this site running and to learn how it is used by you and others.</div><div class=menu><a href=a>-Start</a> <a href=b>About</a></div><main><h1>+Heading</h1><p>+A paragraph in the main part of the page that explains one thing or another.</p><div class=advert>-A word from the people who pay for this page, long enough to look like a paragraph of text.</div><p>+The rest.</p><form action=s>-Your name and mail to get our letter every week</form></main><section class=comments><h2>-Comments</h2><p>-I read this with pleasure and would like to read more of the same soon.</p></section>",
    "<body><article><header><h1>-Header line of the article box</h1></header><p>+The first paragraph stands below the header and goes on for a while until it ends.</p><div class=share><a href=t>-Share</a></div><p>+Another.</p><div class=comments><p>-First reader says that this is a fine piece of work and leaves again.</p><p>-Me too.</p></div><footer>-Posted on Monday by the editors of the paper</footer></article><div class=sidebar><p>-Weather today: rain in the morning and some sun in the afternoon, wind from the west.</p></div>",
    "<body><div class=header>-The Daily</div><div><a href=a>-World</a> <a href=b>Sports</a> <a href=c>Money</a></div><div><p>+Without any article element the text still is in paragraphs of many words, one after another, as here in this first one of them.</p><p>+And here in the second one, which has a few words less than the first one but is long all the same.</p><p>+It ends with a line of ten words in all here.</p></div><div><a href=d>-More news</a> <a href=e>Older news</a></div><div class=footer>-All rights reserved</div>",
    "<p>+Nothing but a few words",
    "<body><p>+Just one page of text with nothing around it but the body, and that is all there is.</p><p>+Second paragraph of the same page, which also has a number of words to be read by somebody.</p><p><a href=a>-next page</a></p>",
    "<body><table><tr><td><a href=a>-Index</a></td></tr></table><div class=content><h2>+Section heading</h2><p>+Words in a box that is named for its content are taken as the article even in short lines.</p><p>+So it is.</p></div><div class=related><a href=b>-Something else to read</a><p>-You may like these stories from our archive as well, picked by hand.</p></div><div role=dialog>-Please accept our terms before you go on reading this page</div>",
    "<body><form><label>-Search the site for words</label></form><article><p>+One.</p><p>+Two words.</p><p>+Three words here.</p><p>+<a href=x>linked line of the article</a></p><aside>-Box in the article with facts that are not part of its text and go on for long</aside><p>+Last line of the text.</p><nav><a href=p>-Previous</a> <a href=n>Next</a></nav></article>",
    "<body><main><div class=breadcrumb><a href=h>-Home</a> - Section</div><article><h1>+Name of the story</h1><p>+It was a long story and it took many lines to tell, more than one would think at first.</p><blockquote>+What somebody said about it</blockquote><pre>+a line of code</pre></article><div class=newsletter>-Get the best stories in your mail each morning, for free and without any spam at all</div></main>",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    xs, ys = [], []
    for page in _labelled_pages():
        found = blocks(page)
        ys += [b.text[0] == "+" for b in found]
        xs.append(features(found))
    return np.concatenate(xs), np.array(ys, dtype=bool)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 16) -> tuple:
    """A decision tree: (share of True) at a leaf, else (feature, threshold, at most, above)."""
    if depth == 0 or y.all() or not y.any():
        return (float(y.mean()),)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            gini = sum(part.sum() * 2 * (p := y[part].mean()) * (1 - p) for part in (low, ~low))
            # among equal splits a yes-or-no feature before a count: it holds for other pages, too
            rank = (round(gini, 9), f < 6, f)
            if best is None or rank < best[0]:
                best = (rank, f, float(t), low)
    if best is None:
        return (float(y.mean()),)
    _, f, t, low = best
    return (f, t, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def apply_tree(tree: tuple, row: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0] > 0.5


def main_text(page: str | None, tree: tuple) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, row in zip(found, features(found)) if apply_tree(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tree = grow(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), tree) for h in b["html"]]
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
