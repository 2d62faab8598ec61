"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 3  # lines summed into one block
SURGE = 40  # weighted characters a block needs to make a passage strong
WEIGHT = SURGE  # of a character inside article or main: any text there is strong

# Element names and class or id words by their role in a page.
RAW = "script|style|noscript|template|iframe|svg|textarea|select|object|canvas|title"
BLOCKS = set(
    "address article aside blockquote body br button caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
# Elements whose end tag may be missing, with the elements that end them where they open.
IMPLIED = {
    "p": BLOCKS - {"br"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "caption": {"tr", "tbody", "thead"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr", "tbody", "tfoot"},
    "h1": set(), "h2": set(), "h3": set(), "h4": set(), "h5": set(), "h6": set(),
}
NESTING = BLOCKS - VOID - set(IMPLIED) - set("tbody thead tfoot html body".split()) | {"span", "label"}
BOILERPLATE = set("head nav footer aside form menu dialog button label".split())
ROLES = set("navigation banner contentinfo complementary search alert dialog menu menubar alertdialog form".split())
# Words of a class or id that name boilerplate; layout words do so only where the text is short or mostly links.
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr popup modal "
    "overlay newsletter subscribe subscription nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar "
    "comment comments respond replies reply disqus share sharing social related recommend recommended recommendations login signup "
    "pagination pager paywall teaser teasers".split()
)
LAYOUT = set("banner notice notices side widget widgets header search toolbar tags copyright legal skip alert disclaimer".split())
# Words that may stand beside them in one name.
BESIDE = set(
    "site page main box bar list section container wrapper wrap area block slot unit link links top bottom left right inner outer item "
    "items button buttons icon icons panel form thread post posts story stories text".split()
)
FEW = 120  # characters below which a block with a layout word is boilerplate

# No part of it goes back over what it has read, and none reads past the next tag in vain.
INSIDE = r"(?:\"[^\"]*+\"|'[^']*+'|[^'\"<>]++)*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b{INSIDE}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/<>]*+)({INSIDE})>"
    r"|<[!?/][^<>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z][^\s=\"'<>/]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'<>]++)))?+|\"[^\"]*+\"|'[^']*+'")

KEEP, DOUBT, DROP = range(3)


def _named(value: str) -> int:
    """What the names in a class or id say; a name counts as a whole, so that ``has-sidebar`` is not ``sidebar``."""
    found = KEEP
    for name in value.lower().split():
        parts = set(re.split(r"[_-]+", name)) - {""}
        if parts <= NAMES | LAYOUT | BESIDE:
            found = max(found, DROP if parts & NAMES else DOUBT if parts & LAYOUT else KEEP)
    return found


def _verdict(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element is boilerplate (``DROP``), or is if its text is short or mostly links (``DOUBT``)."""
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        return DROP
    found = KEEP
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "role" and value.lower() in ROLES):
            return DROP
        if name in ("class", "id") and (tag not in ("article", "main") or "comment" in value.lower()):
            found = max(found, _named(value))
    return found


def lines(page: str) -> list[tuple[str, int, bool]]:
    """Lines of a page with text, as ``(text, linked characters, in article)``; boilerplate, and lines that only open or close elements, are left out."""
    out: list[tuple[str, int, bool, tuple[int, ...]]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = []  # element, verdict, number of a doubted block
    opened: Counter[str] = Counter()
    doubted: list[int] = []
    skipped = articles = linked = links = doubts = 0
    at = 0

    def end_line():
        nonlocal linked
        line = " ".join("".join(parts).split())
        if line:
            out.append((line, linked, articles > 0, tuple(doubted)))
        parts.clear()
        linked = 0

    def text(piece: str):
        nonlocal linked
        if not skipped and piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if links:
                linked += len(piece)

    def leave():
        nonlocal skipped, articles
        name, verdict, number = stack.pop()
        opened[name] -= 1
        skipped -= verdict == DROP
        articles -= name in ("article", "main")
        if number:
            doubted.remove(number)
        return name

    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag == "a":
            links = 0 if closing else 1
        if tag in BLOCKS:
            end_line()
            if not closing and stack and tag in IMPLIED.get(stack[-1][0], ()):
                leave()
        if tag not in NESTING and tag not in IMPLIED:
            continue
        if closing:
            if opened[tag]:
                while leave() != tag:
                    pass
            continue
        verdict = _verdict(tag, m[4], articles > 0)
        if tag in IMPLIED and verdict == KEEP:
            continue
        if tag in ("article", "main") and verdict != DROP and skipped and not any(v == DROP and n in ("article", "section", "aside") for n, v, _ in stack):
            # A container before the article was never closed.
            stack, skipped, doubted = [(n, KEEP, 0) for n, _, _ in stack], 0, []
        if tag != "span" or verdict or m[4]:
            number = 0
            if verdict == DOUBT:
                doubts = number = doubts + 1
                doubted.append(number)
            stack.append((tag, verdict, number))
            opened[tag] += 1
            skipped += verdict == DROP
            articles += tag in ("article", "main")
    text(page[at:])
    end_line()
    return _settled(out, doubts)


def _settled(found: list[tuple[str, int, bool, tuple[int, ...]]], doubts: int) -> list[tuple[str, int, bool]]:
    """The lines without those of doubted blocks with little text of their own, or mostly links."""
    size, linked = [0] * (doubts + 1), [0] * (doubts + 1)
    for line, in_links, _, blocks in found:
        for k in blocks:
            size[k] += len(line)
            linked[k] += in_links
    bad = {k for k in range(1, doubts + 1) if size[k] < FEW or 2 * linked[k] > size[k]}
    return [(line, in_links, inside) for line, in_links, inside, blocks in found if not bad.intersection(blocks)]


def _passages(sizes: list[int]) -> list[tuple[int, int, bool]]:
    """Passages as ``(first line, line after the last, strong)``: a block of empty lines ends one, a block of ``SURGE`` makes it strong."""
    out: list[tuple[int, int, bool]] = []
    for i, size in enumerate(sizes):
        if not size:
            continue
        start, end, strong = out.pop() if out and i - out[-1][1] < WINDOW else (i, i, False)
        out.append((start, i + 1, strong or sum(sizes[max(start, i - WINDOW + 1) : i + 1]) >= SURGE))
    return out


def extract(page: str | None) -> str:
    """Text between the first surge and the last dive of the line-block distribution.

    A block is the sum of the weighted text lengths of ``WINDOW`` lines in a
    row. A passage starts (surge) where blocks become positive and ends (dive)
    where a whole block is empty again; it is kept whole. Lines inside article
    or main have ``WEIGHT`` a character; elsewhere a character counts 1 and
    lines that are mostly links count as empty. The text reaches from the
    first to the last passage with a block of ``SURGE`` (or over all passages,
    if none has one), every passage in between included.
    """
    if not page:
        return ""
    found = lines(page)
    sizes = [WEIGHT * len(t) if inside else len(t) if 2 * linked <= len(t) else 0 for t, linked, inside in found]
    passages = _passages(sizes)
    strong = [k for k, p in enumerate(passages) if p[2]]
    if strong:
        passages = passages[strong[0] : strong[-1] + 1]
    return " ".join(t for a, b, _ in passages for t, _, _ in found[a:b])


def extract_pages(pages: DataFrame, html_col: str = "html", keep_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep_cols`` and ``text`` of every page, one row per input row, no shuffle.

    A null or empty page, or one without main text, gives an empty text;
    repeated rows stay; an empty table gives an empty result; other columns,
    also one called ``text``, are not looked at.
    """
    schema = T.StructType([*(pages.schema[c] for c in keep_cols), T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([extract(page) for page in batch.column(len(keep_cols)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep_cols)], texts], names=[*keep_cols, "text"])

    return pages.select(*keep_cols, html_col).mapInArrow(run, schema)
