"""Main-text extraction: blocks labelled by a minimum cut.

A page is tokenised into tags and text; a stack with the usual implied ends
(an open <p> ends at the next block, an end tag closes what it encloses) gives
each text block its chain of elements.  A logistic classifier turns a block's
text (length, sentence marks, link density, kind of element, notice phrases)
and what stands around it (article or navigation elements, roles, class and id
words) into a cost for calling it boilerplate and a cost for calling it content.
The weights of the text are learned from the pages themselves: blocks within
article and main elements are examples of content, those within nav, aside,
footer, form and the like are examples of boilerplate; all of the table's blocks
are counted by their features, and only the counts reach the driver.  Where
there are few examples, the weights stay near the stated ones.  The costs are
the capacities to the two terminals.  Blocks that follow each other, and blocks
that share a parent, are joined by smoothness edges, weak across the border of
two regions of the page.  An article or main element starts anew whatever class
words say of what stands around it, unless a navigation, aside, footer or form
element does or, for an article, a list of comments, related pages or
advertisements; names of several words (with-sidebar, site-header) say less than
whole ones, unless they are made of what is held and of the part of a page that
holds it (ad-slot, comments-list).  An article's own header element is a header
like others.  A maximum flow separates content from boilerplate with
the least total cost.

The text is the content blocks in page order, joined by one newline, with
character references decoded within each run of text and white space within a
block made one space.  Hidden elements and class words of a paragraph's own
speak against a text, but within an article they don't decide alone.  Costs that
are equal leave a block out, and so does a tie of the cut.

Cases: a null or empty page, or one without text, gives an empty string; pages
of any length are whole; broken or cut off markup is closed at its end; repeated
rows are extracted each; an empty table gives an empty one; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import sigmoid
from .common import carry, slices

# Element names of HTML by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meta link nobr q rp rt ruby s samp small source span "
    "strike strong sub sup time track tt u var wbr".split()
)
#: Elements whose text is never page text.
UNSEEN = frozenset("head script style noscript template textarea title iframe select option datalist svg math canvas audio video object map".split())
#: Elements that an opening tag of the same group ends.
SELF_ENDING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article section main div table ul ol dl form aside nav header footer blockquote td th button".split())

#: What elements, roles and class or id words say about the text within; positive speaks for content.
BY_TAG = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "button": -9.0, "dialog": -9.0, "menu": -6.0, "header": -6.0, "fieldset": -6.0}
BY_ROLE = {"main": 3.0, "article": 4.0, "navigation": -9.0, "banner": -9.0, "contentinfo": -9.0, "complementary": -9.0, "search": -9.0, "form": -9.0, "dialog": -9.0, "alertdialog": -9.0, "alert": -9.0, "menu": -9.0, "menubar": -9.0}
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs topbar masthead header footer foot sidebar sidebars side rail aside widget widgets "
    "notice notices cookie cookies consent gdpr alert alerts popup modal overlay paywall toast disclaimer copyright legal "
    "newsletter subscribe subscription signup login form search comment comments commentlist disqus reply replies respond responses discussion "
    "share sharing social related recommended recommendations outbrain taboola pagination pager toolbar skip hidden".split()
)
#: Those whose articles are not the page's own, and elements and roles whose content never is.
OTHERS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion promoted newsletter "
    "comment comments commentlist disqus reply replies respond responses discussion related recommended recommendations outbrain taboola".split()
)
BARRED = frozenset("nav aside footer form button dialog menu".split())
BARRED_ROLES = frozenset(role for role, evidence in BY_ROLE.items() if evidence < 0)
#: Words that make a name of several words tell of the page's state or layout.
STATES = frozenset("with without has have no is not are fixed sticky open opened closed collapsed enabled disabled visible overflow active layout container wrapper wrap page content".split())
#: Those of AGAINST that no page as a whole is named after, and words for the parts of a page: a name made of both is about what it holds (ad-slot, comments-list, related-posts).
HELD = OTHERS | frozenset("share sharing social cookie cookies consent gdpr subscribe subscription popup paywall toast".split())
PARTS = frozenset(
    "container containers wrapper wrap box block blocks slot slots list thread threads item items section area bar panel inner outer holder unit units card cards content body text post posts article articles story stories "
    "reading link links button buttons zone module region group row column grid title heading label count top bottom left right small large".split()
)
FOR = frozenset("article articlebody content post entry story maincontent body text main prose".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Phrases of notices and legal lines.
NOTICE = re.compile(r"\b(cookies?|all rights reserved|privacy policy|terms of (use|service)|subscribe|sign (in|up)|log ?in|newsletter|advertisement|sponsored|copyright)\b|©", re.IGNORECASE)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

SIBLINGS, NEIGHBOURS, ACROSS, SCALE = 0.7, 1.0, 0.05, 1000

#: Elements that hold text themselves; and words that a paragraph of the page's own text may well have in its class.
PARAGRAPHS = frozenset("p li dt dd td th blockquote pre figcaption caption h1 h2 h3 h4 h5 h6 span em strong b i".split())
AMBIGUOUS = frozenset("side share sharing notice notices response responses reply replies respond legal search hidden skip rail foot header form alert alerts discussion comment comments related social disclaimer banner header footer".split())
#: Weights of a block's text that are learned: for a constant, the length, a sentence mark at the end, a heading or paragraph, links and notices.
STATED = np.array([-0.8, 1.0, 0.5, 0.5, -3.0, -2.0])
#: How many examples the stated weights stand for, and how far the text alone may speak for or against a block.
STATED_EXAMPLES, MOST_TEXT = 40.0, 2.5
#: Lengths are told apart by halves of the square root of the number of words, up to this many.
LENGTHS = 9
CELLS = LENGTHS << 4


def cell_features() -> np.ndarray:
    """The features of each cell: what ``cell_of`` numbers."""
    n = np.arange(CELLS)
    bit = lambda k: (n >> k & 1).astype(float)
    return np.column_stack([np.ones(CELLS), (n >> 4) / (LENGTHS - 1) * 2, bit(0), bit(1), bit(2), bit(3)])


def cell_of(text: str, tag: str, linked: int) -> int:
    words = text.count(" ") + 1
    length = min(LENGTHS - 1, int(2 * words**0.5))
    ends, plain = text[-1] in ".!?…»”\"", tag in HEADINGS or tag == "p"
    return length << 4 | ends | plain << 1 | (linked > 0.5 * len(text)) << 2 | (words < 40 and NOTICE.search(text) is not None) << 3


def fit_weights(content: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Weights from the examples' counts by cell: logistic regression by
    Newton's steps, drawn towards the stated weights."""
    x, w = cell_features(), STATED.copy()
    n = content + other
    for _ in range(25):
        p = sigmoid(x @ w)
        slope = x.T @ (content - n * p) - STATED_EXAMPLES * (w - STATED)
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + STATED_EXAMPLES * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + np.clip(step, -1.0, 1.0)
        if np.abs(step).max() < 1e-9:
            break
    return w


def text_evidence(weights: np.ndarray) -> list[float]:
    """What the text says, by cell."""
    return np.clip(cell_features() @ weights, -MOST_TEXT, MOST_TEXT).tolist()


@dataclass(slots=True)
class Element:
    tag: str
    evidence: float
    unseen: bool
    region: int
    key: int
    link: bool
    barred: int
    own: bool


@dataclass(slots=True)
class Block:
    text: str
    evidence: float
    cell: int
    example: int
    region: int
    parent: int


def _against(value: str, paragraph: bool) -> float:
    """What the names in a class or id say against the text within."""
    worst = 0.0
    for name in value.split():
        words = [w.lower() for w in _NAME_WORD.findall(name)]
        bad = [w in AGAINST for w in words]
        if all(bad) or HELD.intersection(words) and all(b or w in PARTS for w, b in zip(words, bad, strict=True)):
            doubtful = paragraph and AMBIGUOUS.issuperset(words)
            worst = min(worst, (-2.0 if doubtful else -9.0) if bad else 0.0)
        elif any(bad) and not STATES.intersection(words):
            # the last word is what a name is about
            worst = min(worst, -5.0 if bad[-1] else -2.0)
    return worst


def _own_evidence(tag: str, attributes: str, inside: bool) -> tuple[float, bool, bool, int]:
    """(evidence, hidden, main, barred) of an element by its name and
    attributes; ``inside``: an article holds it already; ``main``: it starts
    the page's own text; ``barred``: 2 if nothing within does, 1 if no article
    within does."""
    evidence = BY_TAG.get(tag, 0.0)
    hidden = False
    main = tag in ("article", "main")
    barred = 2 if tag in BARRED else 0
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name = m[1].lower()
            value = m[2] or m[3] or m[4] or ""
            if name == "role":
                role = value.strip().lower()
                evidence += BY_ROLE.get(role, 0.0)
                main |= role in ("main", "article")
                barred = 2 if role in BARRED_ROLES else barred
            elif name == "style":
                hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE) is not None
            elif name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden |= value.lower() == "true"
            elif name == "itemprop":
                evidence += 3.0 if value == "articleBody" else 0.0
                main |= value == "articleBody"
            elif tag not in ("html", "body") and tag not in HEADINGS:
                against = _against(value, tag in PARAGRAPHS)
                if against:
                    evidence += against
                elif FOR.intersection(w.lower() for w in _NAME_WORD.findall(value)):
                    evidence += 1.0
                if any(w.lower() in OTHERS for w in value.split()):
                    barred = max(barred, 1)
    if inside and evidence > 0:
        evidence = min(evidence, 1.0)
    return evidence, hidden, main, barred


def blocks_of(page: str) -> list[Block]:
    stack = [Element("", 0.0, False, 0, 0, False, 0, False)]
    out: list[Block] = []
    pieces: list[str] = []
    linked = 0
    made = regions = 0

    def flush(holder: Element) -> None:
        nonlocal linked
        if not pieces:
            return
        text = " ".join("".join(pieces).split())
        if text:
            example = -1 if holder.barred == 2 else 1 if holder.own and not holder.barred else 0
            out.append(Block(text, holder.evidence, cell_of(text, holder.tag, linked), example, holder.region, holder.key))
        pieces.clear()
        linked = 0

    def holder() -> Element:
        for e in reversed(stack):
            if e.tag not in INLINE:
                return e
        return stack[0]

    def close_to(index: int) -> None:
        flush(holder())
        del stack[index:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not stack[-1].unseen:
            text = html.unescape(text)
            pieces.append(text)
            if stack[-1].link:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
                    if stack[i].tag not in INLINE:
                        break
            else:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close_to(i)
                        break
                    if tag == "p" and stack[i].tag in SCOPE:
                        break
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush(holder())
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        if m[3].endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag not in INLINE:
            flush(holder())
            ends = SELF_ENDING.get(tag)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or ends and stack[i].tag in ends:
                    del stack[i:]
                    if not ends:
                        break
                    continue
                if stack[i].tag in SCOPE and not (ends and stack[i].tag in ("td", "th")):
                    break
        up = stack[-1]
        own, hidden, main, barred = _own_evidence(tag, m[3], up.evidence > 2.5)
        above = up.evidence
        if main and above < 0.0 and up.barred < (1 if tag == "article" else 2):
            above = 0.0
        made += 1
        region = up.region
        if abs(own) >= 3.0 or above != up.evidence:
            regions += 1
            region = regions
        evidence = max(-12.0, min(6.0, above + own - 3.0 * hidden)) if above > -6.0 else above
        # hidden text outside of the page's own text is a menu, a dialogue or a form
        unseen = up.unseen or hidden and not up.own or tag in UNSEEN
        stack.append(Element(tag, evidence, unseen, region, made, up.link or tag == "a", max(up.barred, barred), main or up.own))
    flush(holder())
    return out


def minimum_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut.  source[i] and
    sink[i] are capacities to the terminals; edges (i, j, capacity) run both
    ways.  Shortest augmenting paths in level graphs."""
    n = len(source)
    excess = [a - b for a, b in zip(source, sink, strict=True)]  # what passes through a node alone is gone
    to: list[int] = []
    left: list[int] = []
    around: list[list[int]] = [[] for _ in range(n)]
    for i, j, c in edges:
        around[i].append(len(to))
        to.append(j)
        left.append(c)
        around[j].append(len(to))
        to.append(i)
        left.append(c)
    while True:
        level = [-1] * n
        line = deque(i for i in range(n) if excess[i] > 0)
        for i in line:
            level[i] = 0
        reached = False
        while line:
            i = line.popleft()
            if excess[i] < 0:
                reached = True
                continue
            for e in around[i]:
                if left[e] and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    line.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        step = [0] * n
        for start in range(n):
            while excess[start] > 0:
                path: list[int] = []
                i = start
                while excess[i] >= 0 or not path:
                    while step[i] < len(around[i]):
                        e = around[i][step[i]]
                        if left[e] and level[to[e]] == level[i] + 1:
                            break
                        step[i] += 1
                    else:
                        if not path:
                            break
                        i = to[path.pop() ^ 1]
                        step[i] += 1
                        continue
                    path.append(e)
                    i = to[e]
                if not path:
                    break
                flow = min(excess[start], -excess[i], *(left[e] for e in path))
                excess[start] -= flow
                excess[i] += flow
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow


def main_text(page: str | None, by_text: list[float] | None = None) -> str:
    """The page's own text; ``by_text``: the evidence of each cell, by the
    stated weights if there is none."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    by_text = by_text or text_evidence(STATED)
    evidence = [b.evidence + by_text[b.cell] for b in blocks]
    source = [round(SCALE * max(0.0, e)) for e in evidence]
    sink = [round(SCALE * max(0.0, -e)) for e in evidence]
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, round(SCALE * (NEIGHBOURS if blocks[i - 1].region == b.region else ACROSS))))
        if b.parent in last and last[b.parent] != i - 1:
            edges.append((last[b.parent], i, round(SCALE * SIBLINGS)))
        last[b.parent] = i
    content = minimum_cut(source, sink, edges)
    return "\n".join(b.text for b, keep in zip(blocks, content, strict=True) if keep)


def learn(df: DataFrame, html_col: str = "html") -> np.ndarray:
    """Weights from the examples of all pages: one row of counts for each
    cell reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, CELLS), np.int64)
        for batch in slices(batches, "_html"):
            for x in batch.column("_html"):
                for b in blocks_of(x.as_py() or ""):
                    if b.example:
                        found[int(b.example > 0), b.cell] += 1
        some = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[1, some]), pa.array(found[0, some])], ["cell", "content", "other"])

    counted = df.select(F.col(f"`{html_col}`").alias("_html")).mapInArrow(count, "cell bigint, content bigint, other bigint")
    content, other = np.zeros(CELLS), np.zeros(CELLS)
    for row in counted.groupBy("cell").agg(F.sum("content").alias("content"), F.sum("other").alias("other")).collect():
        content[row["cell"]], other[row["cell"]] = row["content"], row["other"]
    return fit_weights(content, other)


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None, weights: np.ndarray | None = None) -> DataFrame:
    """(id_col, [keep], text): the main text of every page, by the given weights
    or those learned from the pages."""
    rows, names, own, page, schema = carry(df, id_col, html_col, keep)
    by_text = text_evidence(learn(df, html_col) if weights is None else weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            texts = [main_text(x.as_py(), by_text) for x in batch.column(page)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, "main_text"])

    out = rows.mapInArrow(run, schema + "main_text string")
    return out.select(*(F.col(n).alias(c) for c, n in zip(own, names, strict=True)), F.col("main_text").alias("text"))
