"""Main text of HTML by the maximum-scoring subsequence.

A page is read as a stream of words and tags. A word scores by the log odds of main text given the elements around it,
positive or negative, a tag negative, with weights from the labelled pages below: those of elements by a
logistic regression, those of tags by counts. One linear scan finds the contiguous region with the greatest sum.
Words of that region that score below zero (a menu or an advert amid the article) are left out.

Reading is linear in the page: elements are counted by name, what stands around a word is a set of known
features that nested elements share, and a tag that never ends is found to be so once.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The labelled pages; an element with "data-main" holds the main text.
LABELLED = [
    """<html><head><title>t</title></head><body><header><a href=/>Site name</a><p>Tag line of site</p></header><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a href=c>Contact</a></li></ul></nav>
<div class="ad">Buy now and save</div><div class="notice">We use cookies on this site</div><article data-main><h1>The headline of the story</h1><p>The first paragraph has a number of words and goes on for a while.</p>
<p>The second has <b>bold words</b> and <a href=x>a link</a> in it, and more text.</p><ul><li>a point of the list</li></ul></article><aside class="sidebar"><h3>Related</h3><ul><li><a href=d>More</a></li></ul></aside>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I agree with the story, well said.</p></div></section><form><label>Your name</label><input><button>Send</button></form><footer>Copyright of the site. All rights reserved.</footer></body></html>""",
    """<body><div id="header"><h1>Site</h1></div><div id="menu" class="menu"><a href=1>One</a><a href=2>Two</a></div><div id="cookie-banner" class="banner cookie">This site uses cookies.</div>
<div id="content" class="content post entry"><div data-main><h2>A post title</h2><p>Body text of the post, with a good many words in it.</p><blockquote>A quoted sentence stands here.</blockquote><table><tr><td>cell of a table</td><td>another cell</td></tr></table></div>
<div class="share social">Share this on a network</div><div class="advert ads sponsored">Sponsored text of a shop</div></div><div id="sidebar"><div class="widget">Popular posts list</div></div>
<div id="comments" class="comment-list replies"><p>A reader writes a reply here.</p></div><div id="footer" class="footer">Imprint and terms</div></body>""",
    """<body><nav class="breadcrumb">Home / Topic</nav><main data-main><h1>Main heading</h1><p>Plain words of a page in its main element go here.</p><figure><figcaption>caption words</figcaption></figure><h2>Part two</h2><p>Further words.</p><pre>code words</pre></main>
<div class="newsletter subscribe promo">Subscribe to our letter</div><div role="navigation" class="pagination">1 2 3 Next</div><div class="popup modal alert" role="dialog">Sign in to go on</div><footer><p>Legal words</p></footer></body>""",
    """<body><header class="masthead navbar">Masthead words</header><div class="page wrapper container"><div class="article-body story text" data-main><p>Words of the story without any heading, some of them long.</p><p>And a further paragraph, with <i>inline</i> words.</p><dl><dt>term</dt><dd>its meaning</dd></dl></div></div>
<aside>Aside words about something else</aside><div class="related recommended">You may also like this</div><section id="disqus_thread">Thread of readers</section><div class="disclaimer">Notice of terms</div></body>""",
    """<body class="single no-sidebar comments-open"><div class="wrap has-sidebar with-banner"><nav class="site-nav"><ul><li><a>Home</a></li><li><a>Contact</a></li></ul></nav><article class="post" data-main><header><h1>Heading in the article</h1><p>Lead words of it</p></header><p>Text of the story.</p><ol><li>a first point</li></ol></article><div class="post-related related"><ul><li><a>Other story</a></li></ul></div></div></body>""",
    """<body><main><article data-main><h1>Words</h1><p>Text of it all.</p><h3>A part</h3><p>More of it.</p></article><section class="comments"><h2>Comments</h2><article class="comment"><header><b>A reader</b></header><p>What a reader says of it.</p></article><article class="comment"><p>And another one does.</p><footer>Reply</footer></article><form class="comment-form respond"><p>Leave a reply</p></form></section><aside class="widget"><h3>Popular</h3><p>Words aside</p></aside></main></body>""",
    """<body><div class="cookie-consent gdpr cookies" role="dialog"><p>We use cookies, by your consent.</p></div><div class="banner advertisement"><p>An advertisement in a paragraph.</p></div><div class="ads"><p>Buy this now.</p></div><div data-main><p>Text of a page without any names.</p><p>And more text of it.</p><h2>Heading</h2><ul><li>a point</li></ul></div><div class="disclaimer notice"><p>All of this is without warranty.</p></div><div class="footer contentinfo" role="contentinfo"><p>Imprint of the site</p></div></body>""",
    """<body><article><div data-main><h2>Title</h2><p>Text before.</p></div><div class="ad"><p>Sponsored words amid the text</p></div><div class="advert"><p>An advert</p></div><div class="newsletter subscribe"><p>Subscribe by mail</p></div><div class="share social"><ul><li><a>Share it</a></li></ul></div><div data-main><p>Text behind.</p></div><aside><p>Aside in the article</p></aside><nav class="pagination"><a>1</a></nav><nav><ul><li>Contents</li></ul></nav><footer><p>Filed under words</p></footer></article></body>""",
    """<body><div class="breadcrumbs breadcrumb">Home / Topic</div><div class="menu"><p>Menu words</p></div><div class="nav navigation" role="navigation"><p>Go there</p></div><div class="navbar"><p>Go here</p></div><div class="content"><p data-main>Body text.</p><p data-main>Body text goes on.</p></div><div class="sidebar" role="complementary"><h3>Side</h3><p>Words of the side.</p></div><div class="widget"><p>Widget words.</p></div><div class="comments"><div class="comment"><p>A comment.</p></div></div><div class="replies"><p>A reply.</p></div><div class="promo sponsored"><p>Promoted.</p></div><div class="popup"><p>Sign up.</p></div><div class="modal"><p>Sign in.</p></div></body>""",
    """<body><form><p>Name of yours</p><label>Mail</label></form><dialog><p>A dialog</p></dialog><menu><li>An entry</li></menu><search><p>Search here</p></search><button>Press</button><div hidden><p>Hidden words</p></div><header><p>Site header words</p></header><div id="header"><p>Header words</p></div><div id="disqus"><p>Thread</p></div><main data-main><header><h1>In main</h1></header><p>Main words.</p><table><tr><td>cell</td></tr></table></main><footer><p>Footer words</p><ul><li>Imprint</li></ul></footer><div class="copyright"><p>Rights</p></div></body>""",
    """<body><p data-main>A page of bare paragraphs.</p><p data-main>Nothing is around them.</p><ul data-main><li>a point</li></ul><nav><p>Go on</p></nav></body>""",
    """<html><body><div data-main>Words in a division alone.<br>And more of them.</div></body></html>""",
    """<body><div><div><div data-main>Words in nested divisions.</div><div data-main>And more of them.</div></div></div></body>""",
    """<body><center data-main>Bare words of an old page.</center><nav>Home</nav></body>""",
    """<body><nav>Home Contact</nav><section data-main><h2>Section heading</h2><p>The words of a page may stand in sections, one after the other.</p></section><section data-main><p>Another section goes on with more words of the same page.</p><ul><li>first point of a list</li></ul></section><footer>End words</footer></body>""",
]

#: What a "<" can begin: a tag with its name; anything else is text.
_OPEN = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|(!--)|([!?]))")
#: What ends a tag or begins a quoted value in it.
_STOP = re.compile(r">|=\s*([\"'])")
_ATTR = re.compile(r"""(?<![^\s/"'])(class|id|role|hidden|aria-hidden|style|data-main)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: Elements whose content is not text of the page.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "select", "object", "canvas", "noembed", "noframes", "xmp"}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that make context; an end tag of any other is only a break.
_CONTEXT = set("html body header nav main article section aside footer div form fieldset button menu figure table tr td th ul ol li dl dd dt h1 h2 h3 h4 h5 h6 p blockquote pre center details dialog address hgroup search".split())
_CLOSES_P = _CONTEXT - {"html", "body", "tr", "td", "th", "li", "dd", "dt", "button"}
_SPLIT = re.compile(r"[^a-z]+")
_WORD_SPACE = re.compile(r"\s+")

#: A class name with one of these tells of the page's layout, not of what the element is; only the whole name counts.
_LAYOUT = {"no", "has", "with", "without", "hide", "open"}
#: Elements that mean another thing within an article or main element.
_INNER = {"header", "footer", "nav", "aside", "form"}

Context = frozenset[str]
Part = tuple[str, str, Context, bool]


def _features(name: str, attrs: str, inner: bool) -> tuple[list[str], bool]:
    """What an element adds to its context, and whether it is marked as main text."""
    out, main = [f"in<{name}>" if inner and name in _INNER else f"<{name}>"], False
    for m in _ATTR.finditer(attrs) if attrs else ():
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "data-main":
            main = True
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            out.append("hidden")
        elif key in ("class", "id", "role") and name not in ("html", "body"):
            for whole in value.split():
                words = [w for w in _SPLIT.split(whole) if w]
                out += [whole] if _LAYOUT.intersection(words) else words
    return out, main


class _Ends:
    """Where the tags of a page end. What one search passes is not searched again, so all searches are linear in the page."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.lost: set[int] = set()  # places from which a tag does not end
        self.begin, self.stop = 0, _STOP.search(page)

    def _next(self, at: int) -> re.Match | None:
        if at < self.begin or self.stop is not None and at > self.stop.start():
            self.begin, self.stop = at, _STOP.search(self.page, at)
        return self.stop

    def of(self, at: int) -> int:
        """Where the ">" of the tag whose name ends at at stands, quoted values skipped; -1 if there is none."""
        passed = []
        while at not in self.lost:
            passed.append(at)
            m = self._next(at)
            if m is None:
                break
            if m[1] is None:
                return m.start()
            close = self.page.find(m[1], m.end())
            if close < 0:
                break
            at = close + 1
        self.lost.update(passed)
        return -1


def parts(page: str, known: Context | None = None) -> Iterator[Part]:
    """(kind, text, context, main): kind "t" is text, "i" an inline tag, "b" a tag that ends a block.

    context is the set of features of all elements around, of those in known if that is given. Unclosed elements end
    with an enclosing one; a tag that does not end stops at the next "<"; markup cut off at the end of a page is dropped.
    """
    stack: list[tuple[str, Context, bool, bool]] = [("", frozenset(), False, False)]  # name, context, main, within article
    standing: dict[str, int] = defaultdict(int)
    at, text_from, n = 0, 0, len(page)
    ends = _Ends(page)
    while True:
        _, context, main, inner = stack[-1]
        m = _OPEN.search(page, at)
        stop = m.start() if m else n
        if m is None and page.endswith(("<", "</"), text_from):
            stop = page.rfind("<", text_from)
        if stop > text_from:
            yield "t", page[text_from:stop], context, main
        if m is None:
            return
        if not m[2]:
            end = page.find("-->" if m[3] else ">", m.end())
            at = text_from = n if end < 0 else end + (3 if m[3] else 1)
            continue
        closing, name = bool(m[1]), m[2].lower()
        end = ends.of(m.end())
        attrs = page[m.end() : end]
        if end >= 0:
            at = text_from = end + 1
        else:
            end = page.find("<", m.end())
            attrs, at = "", n if end < 0 else end
            text_from = at
        if name in _RAW and not closing:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = text_from = close.end() if close else n
            yield "b", name, context, main
            continue
        if name in _INLINE:
            yield "i", name, context, main
            continue
        yield "b", name, context, main
        if name in _VOID or name not in _CONTEXT:
            continue
        if not closing:
            while stack[-1][0] == "p" and name in _CLOSES_P or stack[-1][0] == name == "li":
                standing[stack.pop()[0]] -= 1
            _, context, main, inner = stack[-1]
            added, marked = _features(name, attrs, inner)
            new = [f for f in added if f not in context and (known is None or f in known)]
            stack.append((name, context.union(new) if new else context, marked or main, inner or name in ("article", "main")))
            standing[name] += 1
        elif standing[name]:
            while True:
                gone = stack.pop()[0]
                standing[gone] -= 1
                if gone == name:
                    break


#: Penalty of the regression's squared weights.
PENALTY = 0.02


@cache
def trained() -> tuple[dict[str, float], dict[str, float], float]:
    """(weight of each context feature, weight of each tag, bias), from LABELLED.

    A piece of text is an example: its context, and whether it is main text; text without any element around it is
    main text. Both classes weigh the same. A tag scores below zero, the more so the less main text is beside it.
    """
    rows: list[Context] = [frozenset()] * 4
    y = [True] * 4
    tag_in, tag_out = defaultdict(float), defaultdict(float)
    for page in LABELLED:
        for kind, text, context, main in parts(page):
            if kind == "t" and text.strip():
                rows.append(context)
                y.append(main)
            elif kind != "t":
                (tag_in if main else tag_out)[text] += 1
    names = sorted(set().union(*rows))
    x = np.array([[n in r for n in names] + [1.0] for r in rows], float)
    label = np.array(y, float)
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (weight * (p - label)) + PENALTY / len(y) * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + PENALTY / len(y) * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    tags = {t: -0.05 + min(0.0, 0.1 * math.log((tag_in[t] + 1) / (tag_out[t] + 1))) for t in {*tag_in, *tag_out}}
    return dict(zip(names, w[:-1].tolist(), strict=True)), tags, float(w[-1])


#: Bounds of a word's score: boilerplate counts little, so that an advert amid an article doesn't part it.
LOW, HIGH = -0.25, 3.0


@lru_cache(maxsize=50_000)
def _context_score(context: Context) -> float:
    """The log odds of main text in a context, within LOW and HIGH."""
    weights, _, bias = trained()
    return max(LOW, min(HIGH, bias + sum(weights[f] for f in sorted(context))))


@cache
def _known() -> Context:
    return frozenset(trained()[0])


def main_text(page: str | None) -> str:
    """The main text of a page: blocks in page order joined by one space, empty if there is none."""
    _, tags, _ = trained()
    blocks: list[tuple[str, float, float]] = []  # text, score of a word, score of the tags before it
    held: list[str] = []
    score, before = 0.0, 0.0

    def flush() -> None:
        nonlocal held, before
        text = _WORD_SPACE.sub(" ", html.unescape("".join(held))).strip()
        held = []
        if text:
            blocks.append((text, score, before))
            before = 0.0

    for kind, text, context, _ in parts(page or "", _known()):
        if kind == "t":
            # text of another context follows a tag that ended the block before it
            score = _context_score(context)
            held.append(text)
        elif kind == "i":
            before += tags.get(text, -0.05) / 4
        else:
            flush()
            before += tags.get(text, -0.05)
    flush()
    # the maximum-scoring run of blocks: every word adds its score, tags between blocks take theirs
    best, best_run, run, begin = 0.0, (0, 0), 0.0, 0
    for i, (text, word, tag) in enumerate(blocks):
        if run + tag <= 0:
            run, begin = 0.0, i
        else:
            run += tag
        run += word * (text.count(" ") + 1)
        if run > best:
            best, best_run = run, (begin, i + 1)
    return " ".join(t for t, word, _ in blocks[best_run[0] : best_run[1]] if word > 0)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id, the keep columns, text, n_chars): one row for each input row.

    Null html gives an empty text. Repeated rows and null ids pass through. An empty table gives no rows.
    """
    cols = [F.col(id_col), *(F.col(k) for k in keep), F.col(html_col)]
    chosen = pages.select(*cols)
    schema = chosen.drop(html_col).schema.add("text", "string").add("n_chars", "long")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                texts = [main_text(h) for h in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    return chosen.mapInArrow(run, schema)
