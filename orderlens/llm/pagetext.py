"""Main text of web pages by tag-path ratios.

Each block of text on a page has a path of tags from the root. Text length and punctuation are summed
per path and divided by the path's blocks; both ratios are smoothed along the page, fused, and paths
above a threshold are content. Blocks that their tags or names mark as something else (menus, adverts,
forms, comments ...) take no part, nor do blocks of links outside the article; headings, lists and other short blocks that stand in the same element
as content blocks belong to the article too, and so does what else stands in the element that holds the content.
Inside an article or main element a name that may be a topic too (``legal-analysis``) only lowers its paths' ratios.

Time and memory are linear in the page, however deep its elements are nested.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import read

#: a path is content from this share of the page's (length-weighted) mean of fused ratios on
THRESHOLD = 0.4
#: weights of a block and its neighbours on each side, in the smoothing
KERNEL = (0.4, 0.24, 0.06)
#: an element whose content blocks hold this share of the page's content is part of the article
CONTAINER = 0.1
#: share of the content that an article or main element, or else the lowest element, must hold to be the article as a whole
FRAME, WHOLE = 0.5, 0.9
#: share of a block's characters inside links above which it is a menu, if it stands outside the article
LINKS = 0.5
#: what the ratio of a path counts whose name makes it doubtful, and the share of a doubtful element's characters that must be content
DOUBTFUL, PROVEN = 0.5, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.DOTALL)
_NAMES = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_HREF = re.compile(r"(?<![\w-])href\s*=", re.IGNORECASE)
# names of HTML elements, by what they do here
RAW = frozenset("script style noscript template textarea xmp iframe noembed noframes title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br".split())
OTHER_TAGS = frozenset("head nav footer aside form button select option dialog menu svg canvas object audio video map "
                       "fieldset input datalist math applet marquee".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
                   "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
# what an opening tag closes, and the elements behind which it doesn't look
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "thead": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
          "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"})}
# words in class, id and role that mark what is not the article
OTHER_NAMES = frozenset(
    "nav navbar navigation menu submenu sidebar side aside footer foot header masthead topbar banner ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
    "overlay dialog comment comments respond reply replies disqus share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login signin search breadcrumb breadcrumbs pagination pager toolbar widget widgets "
    "contentinfo complementary skip tags copyright legal disclaimer form".split())
# those of them that name a part of a page and hardly a topic: they mark it inside the article as well
PART_NAMES = frozenset(
    "nav navbar navigation menu submenu sidebar masthead topbar ad ads advert adverts advertisement sponsored popup modal overlay "
    "comment comments respond replies disqus newsletter subscribe signup login signin breadcrumb breadcrumbs pagination pager "
    "toolbar widget widgets".split())
P_ENDS_BEHIND = ("button", "table", "td", "th", "li", "div")
_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    other: bool  # not the article
    order: int  # elements are numbered in page order, so those inside one follow it without a gap
    path: int  # number of its path of labels: tags, and the names of general elements
    depth: int  # labels of the path
    framed: bool  # an article element, or inside one
    inside: bool  # inside an article or main element
    doubt: Element | None  # the outermost element, itself included, whose name may be a topic


@dataclass(eq=False)
class Block:
    element: Element
    text: str
    links: int  # characters in links

    @property
    def path(self) -> int:
        return self.element.path


def _names(attrs: str) -> tuple[set[str], bool, str, bool]:
    """Words of the names, whether the element is hidden, its class, and whether a whole attribute names another part."""
    words, hidden, first, whole = set(), False, "", False
    for m in _NAMES.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value == "true"
        else:
            found = set(_WORDS.findall(value))
            words |= found
            whole |= bool(found) and found <= OTHER_NAMES
            if name == "class":
                first = value
    return words, hidden, first, whole


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in order, white space turned into single spaces, empty ones left out."""
    return parse(page)[0]


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """The blocks of :func:`blocks`, and all elements in page order."""
    root = Element("", None, False, 0, 0, 0, False, False, None)
    elements, open_ = [root], [root]
    places: dict[str, list[int]] = defaultdict(list)  # by tag: places in open_, ascending
    paths: dict[tuple[int, str], int] = {}  # (path above, label) -> path
    out: list[Block] = []
    text: list[str] = []
    linked = [0, 0]  # number of open elements where a link is open (0: none is), characters in links
    unseen = ["", 0, 0]  # tag of a hidden inline element, how many of its tag are open in it, number of open elements at its start
    at = 0

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def flush() -> None:
        joined = " ".join("".join(text).split())
        if joined:
            out.append(Block(open_[-1], joined, linked[1]))
        text.clear()
        linked[1] = 0

    def add(raw: str, decode: bool = True) -> None:
        if raw and not unseen[1]:
            part = html.unescape(raw) if decode else raw
            text.append(part)
            if linked[0]:
                linked[1] += len(part.strip())

    def cut_off(to: int) -> None:
        while len(open_) > to:
            places[open_.pop().tag].pop()
        if unseen[2] > len(open_):  # so does a hidden inline element
            unseen[1:] = 0, 0
        if linked[0] > len(open_):  # a link ends with the element that it stands in
            linked[0] = 0

    def close(to: int) -> None:
        flush()
        cut_off(to)

    end_raw = None
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        add(page[at:m.start()])
        at = m.end()
        if m["cdata"] is not None:
            add(m["cdata"], decode=False)
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        ending = bool(m["close"] or m["close2"])
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag == "a":
            linked[0] = 0 if ending or not _HREF.search(attrs) else len(open_)
        if tag in ("br", "wbr"):
            text.append(" " if tag == "br" else "")
            continue
        if tag in INLINE:
            if tag in VOID:
                continue
            if unseen[1]:
                if tag == unseen[0]:
                    unseen[1] += -1 if ending else 1
                    unseen[2] *= unseen[1] > 0
            elif not ending and _names(attrs)[1]:  # what it holds is not shown
                unseen[:] = tag, 1, len(open_)
            continue
        if ending:
            if places[tag]:
                close(places[tag][-1])
            else:
                flush()
            continue
        if tag in RAW:
            if not attrs.rstrip().endswith("/") or tag in ("script", "style", "textarea", "title"):
                end_raw = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.IGNORECASE).search(page, at)
                at = end_raw.end() if end_raw else len(page)
            flush()
            continue
        flush()
        if tag in ENDS_P and places["p"] and places["p"][-1] > last(P_ENDS_BEHIND):
            cut_off(places["p"][-1])
        if tag in CLOSES:
            ends, limit = CLOSES[tag]
            border = last(limit)
            behind = [places[t][k] for t in ends for k in [bisect_right(places[t], border)] if k < len(places[t])]
            if behind:
                cut_off(min(behind))
        if tag in VOID:
            continue
        words, hidden, first, whole = _names(attrs)
        above = open_[-1]
        inside = above.inside or above.tag in ("article", "main")
        marked = bool(words & OTHER_NAMES) and tag not in ("html", "body", "main") and not (tag == "article" and "comment" not in words and "comments" not in words)
        if inside and tag in ("header", "h1", "h2", "h3", "hgroup") and not words & (OTHER_NAMES - {"header"}):
            marked = False
        # inside the article a name is proof if it names a part of a page or nothing else; else the ratios decide
        doubtful = marked and inside and not whole and not words & PART_NAMES
        marked &= not doubtful
        other = above.other or hidden or bool(unseen[1]) or marked or tag in OTHER_TAGS or tag == "header" and not inside
        label = tag if tag in ("html", "body", "article", "main") or not first else f"{tag}.{first}"
        general = tag in ("html", "body")
        path = above.path if general else paths.setdefault((above.path, label + "?" * doubtful), len(paths) + 1)
        e = Element(tag, above, other, len(elements), path, above.depth + (not general), above.framed or tag == "article", inside, above.doubt)
        if doubtful and e.doubt is None:
            e.doubt = e
        elements.append(e)
        places[tag].append(len(open_))
        open_.append(e)
    add(page[at:])
    flush()
    return out, elements


def _smoothed(values: list[float]) -> list[float]:
    n, out = len(values), []
    for k in range(n):
        total = weight = 0.0
        for d in range(-len(KERNEL) + 1, len(KERNEL)):
            if 0 <= k + d < n:
                w = KERNEL[abs(d)]
                total += w * values[k + d]
                weight += w
        out.append(total / weight)
    return out


def ratios(part: list[Block]) -> tuple[dict[int, float], dict[int, int]]:
    """Per path: its fused ratio of text and punctuation, smoothed over the blocks in page order, and its characters."""
    size: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for b in part:
        s = size[b.path]
        s[0] += len(b.text)
        s[1] += len(_PUNCTUATION.findall(b.text))
        s[2] += 1
    length = _smoothed([math.log1p(size[b.path][0] / size[b.path][2]) for b in part])
    points = _smoothed([math.log1p(size[b.path][1] / size[b.path][2]) for b in part])
    fused: dict[int, list[float]] = defaultdict(list)
    for b, x, y in zip(part, length, points, strict=True):
        fused[b.path].append(x * (1 + y))
    score = {p: sum(v) / len(v) for p, v in fused.items()}
    return score, {p: s[0] for p, s in size.items()}


def _proven(shown: list[Block], content: set[int]) -> list[Block]:
    """The blocks without those of doubtful elements that are not mostly content."""
    chars: dict[Element, list[int]] = defaultdict(lambda: [0, 0])
    for b in shown:
        if b.element.doubt is not None:
            n = chars[b.element.doubt]
            n[0] += len(b.text)
            n[1] += len(b.text) * (b.path in content and b.links <= LINKS * len(b.text))
    return [b for b in shown if b.element.doubt is None or chars[b.element.doubt][1] >= PROVEN * chars[b.element.doubt][0]]


def main_text(page: str | None) -> str:
    """The article of a page, a line for each of its blocks; empty where there is none."""
    all_, elements = parse(page or "")
    shown = [b for b in all_ if not b.element.other]
    part = [b for b in shown if b.links <= LINKS * len(b.text)]
    if not part:
        return ""
    score, size = ratios(part)
    chars = sum(size.values())
    mean = sum(score[p] * n for p, n in size.items()) / chars
    doubtful = {b.path for b in part if b.element.doubt is not None}
    content = {p for p, x in score.items() if x * (DOUBTFUL if p in doubtful else 1) >= THRESHOLD * mean}
    shown = _proven(shown, content)
    part = [b for b in shown if b.links <= LINKS * len(b.text)]
    # the characters of content that an element's blocks hold, and with all that stands inside it
    direct, all_in = [0] * len(elements), [0] * len(elements)
    total = 0
    for b in part:
        if b.path in content:
            holder = b.element.parent if b.element.parent is not None else b.element
            direct[holder.order] += len(b.text)
            total += len(b.text)
    all_in[:] = direct
    end = list(range(len(elements)))  # the last element inside each
    for e in reversed(elements[1:]):
        all_in[e.parent.order] += all_in[e.order]
        end[e.parent.order] = max(end[e.parent.order], end[e.order])
    # the element that holds the article
    above = [e for e in elements if all_in[e.order] and e.tag not in ("", "html", "body")]
    frames = [e for e in above if e.tag in ("article", "main") and all_in[e.order] >= FRAME * total]
    whole = max(frames or [e for e in above if all_in[e.order] >= WHOLE * total], key=lambda e: (e.depth, e.order), default=None)
    # in an article or main element blocks of links are the article's; in another, those between its first and last content
    if whole is not None:
        within = [whole.order <= b.element.order <= end[whole.order] for b in shown]
        at = [k for k, b in enumerate(shown) if b.path in content and b.links <= LINKS * len(b.text) and within[k]]
        part = [b for k, b in enumerate(shown) if b.links <= LINKS * len(b.text) or (frames or at[0] < k < at[-1]) and within[k]]
    # an article element, if the page has one that holds content, is the article
    framed = [b for b in part if b.element.framed]
    framed_chars = sum(len(b.text) for b in framed if b.path in content)
    if framed_chars >= 0.5 * total:
        part = framed
    # a page without such an element, as one with its sections in the body: whatever holds content directly
    kept_in = [n > 0 and (n >= CONTAINER * total or whole is None) for n in direct]
    if whole is not None:
        kept_in[whole.order] = True
    for e in elements[1:]:
        kept_in[e.order] |= kept_in[e.parent.order]
    return "\n".join(b.text for b in part if b.path in content or kept_in[b.element.order])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    NULL and empty html give an empty text; broken markup is read as far as it goes; long pages are
    taken whole; repeated rows each get a row; no rows: no rows. Columns besides page_id, url and
    html are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"],
                                "text": pd.Series([main_text(h) for h in b["html"]], index=b.index, dtype=object)})

    kind = pages.schema["page_id"].dataType.simpleString()
    url = pages.schema["url"].dataType.simpleString()
    # page_id as text: pandas would turn whole numbers beside a NULL to floating point
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html")
    out = rows.mapInPandas(run, f"page_id string, url {url}, text string")
    return out.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("n_chars", F.length("text").cast("long"))


def op10_pagetext(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
