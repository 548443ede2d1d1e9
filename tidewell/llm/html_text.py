"""Main text of web pages by the distribution of text over lines.

Markup is stripped to one line per block. Lengths of the lines' own text are
summed over a sliding window; text starts where the sums surge and ends where
they dive to nothing. Lines of menus, notices and the like have no length.
Where the page says which element is its article, lines inside always carry
enough length and lines outside none, so that surge and dive fall on its ends.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.arrays import text_batches

#: Lines in a window, and the length at which a window is a surge.
WINDOW = 3
SURGE = 80

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?=[a-zA-Z/])[^>]*(?:>|\Z)", re.S)
_ATTRIBUTES = re.compile(r"([^\s/=>\"'][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements: contents that are no text; those that end a line; those without an end; those apart from the article.
_RAW = frozenset("script style noscript template iframe svg canvas textarea select title object audio video head".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_APART = frozenset("nav footer aside form menu dialog button fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in a class, id or role that say a block is not the article.
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login search comment comments commentlist reply replies "
    "respond discussion disqus sidebar aside complementary menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer contentinfo "
    "masthead topbar toolbar share sharing social related recommended recommendations widget skip form dialog".split())


def _parsed(attributes: str) -> dict[str, str]:
    """Values by lower-cased name, empty where there is none; the first of equal names counts."""
    found = {}
    for name, *values in _ATTRIBUTES.findall(attributes):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _names(attributes: dict[str, str], whole: bool) -> set[str]:
    """Words of class, id and role; only names of a single word if ``whole``. "has-sidebar" names no sidebar."""
    found = set()
    for mark in ("class", "id", "role"):
        for name in attributes.get(mark, "").split():
            parts = [p.lower() for p in _PARTS.findall(name)]
            if parts and parts[0] not in ("has", "with", "no", "without", "not") and (len(parts) == 1 or not whole):
                found.update(parts)
    return found


def _apart(name: str, attributes: str) -> bool:
    if name in _APART:
        return True
    held = _parsed(attributes)
    if "hidden" in held or held.get("aria-hidden", "").strip().lower() == "true" or _NO_DISPLAY.search(held.get("style", "")):
        return True
    return not _NAMES.isdisjoint(_names(held, whole=name in ("article", "main")))


def lines_of(page: str) -> tuple[list[tuple[str, int, bool, bool]], bool]:
    """(text, length of its links, apart, in the article) of every line with text; whether the page names an article."""
    lines, pieces = [], []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, apart, in a header, in the article
    apart = header = inside = named = False
    linked = anchors = 0
    at, end = 0, len(page)

    def flush():
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            heading = any(name in _HEADINGS for name, *_ in stack[-3:])
            lines.append((text, linked, apart or header and not (inside and heading), inside))
        pieces.clear()
        linked = 0

    while at < end:
        found = _MARKUP.search(page, at)
        text = html.unescape(page[at: found.start() if found else end])
        if text:
            pieces.append(text)
            if anchors:
                linked += len(text.split()) and len(" ".join(text.split()))
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name == "a":
            anchors = 0 if found[1] else 1
            continue
        if name in _RAW and not found[1]:
            if not found[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)|<body(?=[\s>])" if name == "head" else rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end if close is None else close.start() if close[0].lower().startswith("<body") else close.end()
            continue
        if name == "br":
            pieces.append("\n")
            continue
        if name not in _BLOCKS and name not in ("span", "b", "i", "em", "strong"):
            if name in _VOID or found[1] or not _apart(name, found[3]):
                continue
        elif name in _BLOCKS:
            flush()
        if name in _VOID:
            continue
        if found[1]:
            if any(entry[0] == name for entry in stack):
                flush()
                while stack.pop()[0] != name:
                    pass
                apart, header, inside = stack[-1][1:] if stack else (False, False, False)
            continue
        if name == "p" and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
            stack.pop()
            apart, header, inside = stack[-1][1:] if stack else (False, False, False)
        mine = name not in ("body", "html") and _apart(name, found[3])
        if name not in _BLOCKS:
            if not mine:
                continue
            flush()
        if name in ("article", "main") and not apart and not mine:
            inside = named = True
        apart, header = apart or mine, header or name == "header" or "header" in _names(_parsed(found[3]), whole=False)
        stack.append((name, apart, header, inside))
    flush()
    return lines, named


def main_text(page: str | None) -> str:
    """Blocks of the article in page order, two line feeds between them; empty if there are none."""
    lines, named = lines_of(page or "")
    lengths = []
    for text, linked, apart, inside in lines:
        if apart or named and not inside or not named and linked * 2 > len(text):
            lengths.append(0)
        else:
            lengths.append(max(len(text), SURGE) if named else len(text))
    kept, running = [], False
    for i, line in enumerate(lines):
        window = sum(lengths[i: i + WINDOW])
        running = window >= SURGE and lengths[i] > 0 or running and window > 0
        if running and lengths[i]:
            kept.append(line[0])
    return "\n\n".join(kept)


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without ``column``, with ``text``: the main text of each page.

    Null and empty pages, and pages without an article, have an empty text.
    Unclosed elements end with their parents, an unclosed tag or comment with
    the page. A column named text is replaced; others are carried along.
    """
    kept = [f for f in pages.schema if f.name not in (column, "text")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    names = [f.name for f in kept]

    def run(batches):
        for batch in text_batches(batches, column):
            texts = pa.array([main_text(page) for page in batch.column(column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], names=[*names, "text"])

    return pages.select(*[f"`{n}`" for n in names], column).mapInArrow(run, schema + "text string")
