"""The main text of web pages, by minimum cut.

A page becomes a row of text blocks. A classifier on tags, names of enclosing elements,
length and links says what it costs to call a block content or boilerplate; these are the
capacities to the two terminals. Blocks that follow each other, and blocks of one parent
element, are tied by smoothness edges. The minimum cut is the labelling of least total cost,
found by maximum flow.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.llm.common import text_of

# Elements by what they do to a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "head script style noscript template svg math iframe object canvas audio video map select option "
    "datalist button textarea title".split()
)
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul caption".split()
)
# Elements that end an open one of the same kind.
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
# Words in class, id or role that tell what an element is for.
GOOD_WORDS = frozenset("article articlebody content post entry story main maincontent text body".split())
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising adbox banner breadcrumb breadcrumbs byline comment "
    "commentlist comments commentary consent contentinfo cookie cookies copyright disclaimer discussion disqus "
    "feedback footer form gdpr header hidden legal links login masthead menu menubar meta modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup privacy promo "
    "promoted promotion rail recommended recommendations register related reply replies respond responses "
    "search share sharing side sidebar signup skip social sponsor sponsored subscribe subscription tags teaser "
    "toolbar topbar trending widget widgets".split()
)
BAD_TAGS = frozenset("nav aside footer form menu dialog fieldset".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass
class Block:
    text: str
    tag: str
    parent: int  # number of the element around the block's own
    good: int
    bad: int
    linked: int  # characters in links


class _Element:
    __slots__ = ("tag", "number", "good", "bad", "silent", "link")

    def __init__(self, tag: str, number: int, around: _Element | None, attributes: str) -> None:
        self.tag, self.number = tag, number
        self.good, self.bad = (around.good, around.bad) if around else (0, 0)
        self.silent = tag in SILENT or bool(around and around.silent)
        self.link = tag == "a" or bool(around and around.link)
        if tag in ("article", "main"):
            self.good += 1
        if tag in BAD_TAGS or (tag == "header" and not self.good):
            self.bad += 1
        if attributes and tag not in ("html", "body"):
            words: set[str] = set()
            for _, a, b, c in _NAMES.findall(attributes):
                value = a or b or c
                words.update(_WORD.findall(value.lower()))
                words.update(_WORD.findall(_CAMEL.sub(r"\1 \2", value).lower()))
            if words & BAD_WORDS:
                self.bad += 1
            elif words & GOOD_WORDS:
                self.good += 1
            if not self.silent and _HIDDEN.search(attributes):
                self.silent = True


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in page order, with white space made single blanks."""
    root = _Element("", 0, None, "")
    stack, count, found = [root], 0, []
    parts: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in BLOCK), 0)
            own = stack[k]
            around = stack[k - 1].number if k else 0
            found.append(Block(text, own.tag, around, own.good, own.bad, min(linked, len(text))))
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].silent:
            text = html.unescape(text)
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    def close(k: int) -> None:
        if any(e.tag in BLOCK for e in stack[k:]):
            flush()
        del stack[k:]

    while (match := _MARKUP.search(page, at)) is not None:
        say(page[at : match.start()])
        at = match.end()
        slash, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        if tag in BLOCK:
            flush()
            ends = SIBLING.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p" or stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        elif tag == "body" or (stack[-1].tag == "head" and tag not in SILENT and tag not in VOID):
            stack = [e for e in stack if e.tag != "head"]
        if tag in VOID:
            if tag == "br":
                say(" ")
            continue
        if tag == "body":
            stack = [e for e in stack if e.tag != "head"]
        count += 1
        element = _Element(tag, count, stack[-1], attributes)
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
        if not attributes.endswith("/") or tag not in ("svg", "iframe", "script"):
            stack.append(element)
    say(page[at:])
    flush()
    return found


# The classifier: fixed weights of the evidence for content.
BIAS, IN_GOOD, IN_BAD, OUTSIDE = -0.4, 3.0, -7.0, -3.0
LENGTH, LINKS, SENTENCE, PARAGRAPH, HEADING, LIST, RIGHTS = 0.9, -4.0, 0.6, 0.8, 0.2, -0.8, -3.0


def evidence(block: Block, has_good: bool) -> float:
    score = BIAS + LENGTH * min(2.0, math.log1p(len(block.text) / 40)) + LINKS * block.linked / len(block.text)
    if block.good:
        score += IN_GOOD
    elif has_good:
        score += OUTSIDE
    score += IN_BAD * min(block.bad, 2)
    if block.text[-1] in ".!?…:;\"'”»":
        score += SENTENCE
    if block.tag in ("p", "pre", "blockquote"):
        score += PARAGRAPH
    elif block.tag in ("h1", "h2", "h3", "h4"):
        score += HEADING
    elif block.tag in ("li", "td", "th"):
        score += LIST
    if "©" in block.text[:80] and len(block.text) < 300:
        score += RIGHTS
    return score


FOLLOWING, TOGETHER = 0.5, 0.9


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours, and the nearest blocks of one parent element."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i and (blocks[i - 1].bad > 0) == (block.bad > 0):
            edges.append((i - 1, i, FOLLOWING))
        if block.parent in last:
            edges.append((last[block.parent], i, TOGETHER))
        last[block.parent] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling that costs least: |score| for a label against a score's sign, an edge's
    weight for different labels at its ends. Nodes on the source's side are True."""
    near: list[dict[int, float]] = [{} for _ in scores]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    scores = list(scores)
    label: list[bool | None] = [None] * len(scores)
    # A node that its edges can't outweigh has its label already; they then pull at the rest.
    todo = deque(range(len(scores)))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(scores[i]) >= sum(near[i].values()):
            label[i] = scores[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                scores[j] += w if label[i] else -w
                todo.append(j)
            near[i] = {}
    rest = [i for i, x in enumerate(label) if x is None]
    if rest:
        for i, x in zip(rest, _flow([scores[i] for i in rest], [{rest.index(j): w for j, w in near[i].items()} for i in rest]), strict=True):
            label[i] = x
    return [bool(x) for x in label]


def _flow(scores: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Maximum flow by shortest augmenting paths; True: reachable from the source after it."""
    n = len(scores)
    room = [dict(x) for x in near] + [{}, {}]
    source, sink = n, n + 1
    for i, s in enumerate(scores):
        if s > 0:
            room[source][i], room[i][source] = s, 0.0
        elif s < 0:
            room[i][sink], room[sink][i] = -s, 0.0
    while True:
        back, queue = {source: source}, deque([source])
        while queue and sink not in back:
            i = queue.popleft()
            for j, w in room[i].items():
                if w > 1e-12 and j not in back:
                    back[j] = i
                    queue.append(j)
        if sink not in back:
            return [i in back for i in range(n)]
        path, j = [], sink
        while j != source:
            path.append((back[j], j))
            j = back[j]
        least = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= least
            room[b][a] = room[b].get(a, 0.0) + least


def main_text(page: str) -> str:
    """The content blocks of a page, joined by empty lines."""
    blocks = blocks_of(page)
    has_good = any(b.good and not b.bad for b in blocks)
    kept = minimum_cut([evidence(b, has_good) for b in blocks], ties(blocks))
    return "\n\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(page) for page in pages], dtype=object)


def main_text_of(page: Column) -> Column:
    return _main_text(page)


def extract_content(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (its code points).

    Whole pages count and nothing of the content is cut. A null or empty page, and one
    without content, has an empty text. Each page stands alone, so repeated rows agree.
    Columns called like new ones are replaced.
    """
    kept = [c for c in pages.columns if c != html_column and c.lower() not in ("text", "n_chars")]
    done = pages.select(*kept, main_text_of(text_of(html_column)).alias("text"))
    return done.withColumn("n_chars", F.char_length("text").cast("bigint"))
