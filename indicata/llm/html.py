"""Main text of web pages by two passes over their blocks.

Pass one decides what it can: blocks in menus, forms, notices and the like, or made of links, are bad; long blocks, or
those with the stop words of running text, are good.  Pass two gives the short blocks left over the label of the
nearest decided block of the same region (the article, if the page marks one); at equal distance, good wins.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import map_slices

# Element names, words of class, id and role attributes, and frequent function words.
UNSEEN = ("script", "style", "noscript", "template", "title", "svg", "iframe", "object", "select", "textarea", "button",
          "audio", "video", "canvas", "math")
BOILERPLATE = frozenset("nav aside footer form menu dialog".split())
MAIN = frozenset("article main".split())
CONTAINERS = frozenset("html body div section nav aside footer header form menu dialog article main ul ol dl table "
                       "thead tbody tfoot tr td th figure blockquote details fieldset center".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre address figcaption caption hr legend summary "
                                "option col colgroup head".split())
HINTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner "
                  "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar sidebars aside "
                  "complementary contentinfo footer footers header masthead topbar cookie cookies consent gdpr notice "
                  "notices alert popup modal overlay newsletter subscribe subscription signup login search share "
                  "sharing social related recommended recommendations widget widgets comment comments commentlist "
                  "disqus replies responses reactions toolbar skip".split())
COMMENTS = frozenset("comment comments commentlist reply replies response".split())
STOP_WORDS = frozenset("""
    a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they this
    to was we were which with you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu
    que qui sa se ses son sur un une vous
    als auf aus bei das dem den der des die ein eine einem einen er es für hat ich im in ist mit nicht sich sie sind
    und von war wie wird zu zum zur
    al como con del e el en es esta este ha la las lo los más no para pero por que se sin su sus un una y
    """.split())

LONG, SHORT = 120, 25
DENSITY, LINKED = 0.12, 0.5

_UNSEEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(UNSEEN) + r")\b[^>]*(?:/>|>.*?(?:</\1\s*>|\Z))|<!\[CDATA\[|\]\]>|<[!?][^>]*>",
    re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""")
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")


def _hints(attributes: str) -> set[str]:
    found = set()
    for m in _ATTRIBUTE.finditer(attributes):
        found.update(_LETTERS.findall((m[1] or m[2] or m[3] or "").lower()))
    return found


@dataclass
class Block:
    """One block of text: its region (number of the article, -1 outside), the part of it in links, and its label."""

    text: str
    region: int
    boilerplate: bool
    linked: float
    label: bool | None = None


def blocks(page: str) -> list[Block]:
    """The non-empty blocks of a page in its order."""
    parts = _TAG.split(_UNSEEN.sub(" ", page))
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []  # open containers: name, region, boilerplate
    region, bad, regions = -1, False, 0
    held: list[str] = []
    linked, in_link = 0, False

    def close():
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Block(text, region, bad, linked / len(text)))
            held.clear()
        linked = 0

    for i in range(0, len(parts), 4):
        text = parts[i]
        if text:
            held.append(text)
            if in_link:
                linked += len(text.strip())
        if i + 1 == len(parts):
            break
        ends, name, attributes = parts[i + 1], parts[i + 2].lower(), parts[i + 3]
        if name == "a":
            in_link = not ends
        elif name == "br":
            held.append(" ")
        elif name in BLOCKS:
            close()
            in_link = False
            if name not in CONTAINERS:
                continue
            if ends:
                if any(x[0] == name for x in stack):
                    while stack.pop()[0] != name:
                        pass
                    _, region, bad = stack[-1] if stack else ("", -1, False)
            elif not attributes.endswith("/"):
                hints = _hints(attributes) if "=" in attributes else set()
                if name in MAIN:
                    bad = bad or bool(hints & COMMENTS)
                    if region < 0:
                        region, regions = regions, regions + 1
                elif name not in ("html", "body"):
                    bad = bad or name in BOILERPLATE or bool(hints & HINTS) or name == "header" and region < 0
                stack.append((name, region, bad))
    close()
    return out


def _stop_share(text: str) -> float:
    words = _LETTERS.findall(text.lower())
    return sum(x in STOP_WORDS for x in words) / len(words) if words else 0.0


def classify(found: list[Block]) -> None:
    """Both passes; afterwards every label is set."""
    marked = any(x.region >= 0 and not x.boilerplate for x in found)
    for x in found:
        if x.boilerplate or x.linked > LINKED or marked and x.region < 0:
            x.label = False
        elif len(x.text) >= LONG or len(x.text) >= SHORT and _stop_share(x.text) >= DENSITY:
            x.label = True
    decided = [i for i, x in enumerate(found) if x.label is not None]
    first = {i: x.label for i, x in enumerate(found)}
    at = 0
    for i, x in enumerate(found):
        if first[i] is not None:
            continue
        while at < len(decided) and decided[at] < i:
            at += 1
        before = decided[at - 1] if at else None
        after = decided[at] if at < len(decided) else None
        near = [(abs(i - j), not first[j]) for j in (before, after)
                if j is not None and not found[j].boilerplate and found[j].region == x.region]
        x.label = not min(near)[1] if near else x.region >= 0


def main_text(page: str | None) -> str:
    """The good blocks of a page, one a line; empty for null, empty and pages without any."""
    if not page:
        return ""
    found = blocks(page)
    classify(found)
    return "\n".join(x.text for x in found if x.label)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole html.

    Null, empty and blank pages, and those without a good block, have an empty text.  Markup that is broken off or
    never closed ends with the page.  Pages are handled alone: repeated rows get equal texts, an empty table none.
    """
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{page}`").alias("html"))
    kinds = {x.name: x.dataType.simpleString() for x in rows.schema}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_slices(rows, "html", run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
