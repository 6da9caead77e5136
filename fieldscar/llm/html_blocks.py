"""Main text of web pages by line-block distribution.

Markup is stripped to lines (one per block element); the text lengths of the lines, without links, are summed over a
sliding window; the text runs from each surge of that sum to the next dive, with every line between. Elements that
hold menus, adverts and the like become empty lines, so that the sum dives to zero at them. A stretch without a
line inside an ``article`` or ``main`` element must surge higher, by what the lines inside such elements reach.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, functions as F

from .common import arrow_map, register, table

#: Lines in a window, the sum at which a window counts as a surge, and the share of the largest sum inside article
#: elements that a stretch outside must reach.
WINDOW, SURGE, OUTSIDE_SHARE = 3, 86, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe select canvas video audio".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead tr ul".split())
SPACED = frozenset("br td th option".split())
BOILERPLATE = frozenset("head nav header footer aside form menu dialog button fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Parts of a class or id that mark an element as something other than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead comment comments commentlist disqus discussion respond reply replies "
    "cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations popup modal overlay toolbar pagination pager widget copyright disclaimer".split())
#: Parts that may stand beside those; any other part makes the name one of the text, such as "related-work".
BESIDE = frozenset(
    "area bar block body bottom box btn button buttons card cards col column container content fixed global group head home icon icons "
    "inline inner item items js layer left link links list main message module outer page panel post posts primary rail right row "
    "secondary section site slot small sticky story stories tag tags text title top unit view wrap wrapper article articles".split())
_NEVER_MARKED = frozenset("html body main article".split())
_CONTENT = frozenset("article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())


def _marked(name: str, attrs: str) -> bool:
    """Whether the attributes say that the element is not part of the article."""
    for m in _ATTR.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in _NEVER_MARKED:
            continue
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id"):
            for word in value.split():
                parts = {p.lower() for p in _NAME_PART.findall(word) if not p.isdigit()}
                if parts & MARKS and parts <= MARKS | BESIDE or word.lower() in MARKS:
                    return True
    return False


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """(text, its length outside links, inside an article or main element) per line; "" lines stand
    for what is no text of the page."""
    out, stack, pending, linked = [], [], [], 0
    off = content = links = 0  # open elements that are boilerplate, content, links

    def flush(gap: int = 0):
        nonlocal pending, linked
        if pending:
            text = " ".join(unescape("".join(pending)).split())
            if text:
                out.append((text, max(0, len(text) - linked), content > 0))
            pending, linked = [], 0
        out.extend([("", 0, False)] * gap)

    def pop():
        nonlocal off, content, links
        _, is_off, is_content, is_link = stack.pop()
        if is_off:
            flush()
        if is_content and content == 1:
            flush(gap=WINDOW)  # the sum dives where the article ends
        off, content, links = off - is_off, content - is_content, links - is_link

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        piece = html[at:m.start() if m else end]
        if piece and not off:
            pending.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        name = (m.group("name") or "").lower()
        if not name:
            continue
        if m.group("close"):
            if name in BLOCK:
                if not off:
                    flush()
            elif name in SPACED and not off:
                pending.append(" ")
            if any(s[0] == name for s in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW and not m.group("attrs").endswith("/"):
            closed = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = closed.end() if closed else end
            continue
        if name in BLOCK and not off:
            flush()
        elif name in SPACED and not off:
            pending.append(" ")
        if name in VOID:
            continue
        if name in BLOCK:  # an open paragraph ends here
            inner = len(stack)
            while inner and stack[inner - 1][0] not in BLOCK:
                inner -= 1
            if inner and stack[inner - 1][0] == "p":
                while len(stack) >= inner:
                    pop()
        if name == "li" and stack and stack[-1][0] == "li":
            pop()
        is_off = name in BOILERPLATE or _marked(name, m.group("attrs"))
        if name in _HEADINGS and off == 1 and content and stack[-1][0] == "header":
            pop()  # the headline in an article's own header
            stack.append(("header", False, False, False))
            is_off = False
        if is_off and not off:
            flush(gap=WINDOW)
        kind = (name, is_off, name in _CONTENT and not off and not is_off, name == "a")
        if kind[2] and not content:
            flush(gap=WINDOW)
        stack.append(kind)
        off, content, links = off + kind[1], content + kind[2], links + kind[3]
    flush()
    return out


def main_text(html: str) -> str:
    """Lines between surges and dives of the windowed text length, joined by line breaks.

    A stretch starts where the sum rises from zero and ends where it is zero again; lines without text of their
    own (links only) at its ends are none of it, those between are. A stretch with a line inside an article element
    is text; another one is if its largest sum reaches SURGE (half of the page's largest sum, on short pages) and
    OUTSIDE_SHARE of the largest sum inside.
    """
    lines = lines_of(html)
    weight = [own for _, own, _ in lines]
    total = [sum(weight[i:i + WINDOW]) for i in range(len(lines))]
    inside = [sum(own for _, own, within in lines[i:i + WINDOW] if within) for i in range(len(lines))]
    surge = max(min(SURGE, max(total, default=0) / 2), OUTSIDE_SHARE * max(inside, default=0))
    kept, i = [], 0
    while i < len(lines):
        dive = i
        while dive < len(lines) and total[dive]:
            dive += 1
        part = range(i, dive)
        if part and (any(lines[k][2] and weight[k] for k in part) or max(total[i:dive]) >= surge):
            held = [k for k in part if weight[k]]
            kept += [lines[k][0] for k in range(held[0], held[-1] + 1) if lines[k][0]]
        i = dive + 1
    return "\n".join(kept)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text``, the main text of every page.

    A null html is an empty page, whose text is empty. Any markup gives a result: unclosed elements
    end with their parent, unclosed tags and comments with the page. Repeated rows are kept;
    columns not in ``keep`` are ignored.
    """
    def rows(batch):
        out = {f"k{i}": batch.column(i) for i in range(batch.num_columns - 1)}
        yield out | {"text": [main_text(h or "") for h in batch.column(batch.num_columns - 1).to_pylist()]}

    source = pages.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(html).alias("html"))
    fields = [f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    return arrow_map(source, ", ".join([*fields, "text string"]), rows).withColumnsRenamed(
        {f"k{i}": k for i, k in enumerate(keep)})


@register("op1_html_blocks")
def op1_html_blocks(spark, folder):
    found = extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
