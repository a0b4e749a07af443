"""Main text of web pages by two passes of block rules.

Pass one reads blocks of text between block-level tags and decides each by its link density, length and stop-word
density. Blocks inside menus, page headers and footers, sidebars, notices, adverts, forms and comment sections are
decided by where they stand. Pass two gives ambiguous blocks, short ones or those of middling density, the label of
the nearest decided neighbour; a heading looks at what follows it.

An <article> or <main> is evidence that both passes weigh. It is believed if its text is at least as long as the good
text outside it; the page's only <h1> counts for TITLE characters. In a believed element an article may be written in
any style: only many links make a block bad, others are good or ambiguous, and pass two drops ambiguous ones that stand
between bad neighbours. Outside a believed element only blocks of a <main> around or beside the article can be good. An
element that is not believed, as it is a teaser or a card, changes nothing.

Defined results: null, empty and unparsable pages give the empty string; null ids and urls stay null; repeated rows are
answered each; unclosed tags, comments, scripts and quotes end where a browser would end them or with the page.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common words of the supported languages.
STOP_WORDS = {
    "en": "a an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the their there they this to was we were which who will with you",
    "de": "als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich ihr im in ist mit nach nicht noch sich sie sind so und von vor war wie wir zu zum zur über",
    "fr": "à au aux avec ce cette comme dans de des du elle en est et eux il ils je la le les leur mais ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous",
    "es": "a al como con de del el ella en entre era es esta este fue ha la las le lo los más me mi muy no nos o para pero por que se si sin sobre su sus también un una y ya",
}
_STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())
MOST_LINKS, ARTICLE_LINKS = 0.2, 0.5
SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.20, 0.30
TITLE = 400

_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead tr ul""".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math canvas object audio video".split())
_APART = frozenset("nav aside footer form button select head menu dialog label fieldset option".split())
_RESET = frozenset("nav aside footer header form head menu".split())  # an article inside these means that they were left open
_CLOSES_P = _BLOCK - {"body", "html"}
_HINT = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|"
                   r"alert|popup|modal|overlay|newsletter|subscribe|signup|sign-up|login|sidebar|side-bar|widget|menu|nav|navbar|navigation|"
                   r"breadcrumbs?|pagination|pager|toolbar|masthead|site-header|page-header|footer|copyright|legal|disclaimer|social|share|sharing|"
                   r"related|recommended|recommendations|teasers?|comments?|commentlist|respond|replies|reply|disqus|hidden|skip-link)(?:$|[\s_-])", re.I)
_KEEP = frozenset("html body article main".split())

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"
                    r"<(/?)([A-Za-z][^\s/>]*+)((?>\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden|aria-label)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|$|/)""", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())


def _apart(name: str, given: str, inside: bool) -> bool:
    """Whether the element is none of the main text."""
    if name in _APART or name == "header" and not inside:
        return True
    if name in ("html", "body") or not given:
        return False
    for key, value in _NAMED.findall(given):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key == "role" and value.lower() in _ROLES or key in ("class", "id") and _HINT.search(value):
            return True
    return False


class Block:
    __slots__ = ("text", "link", "heading", "apart", "inside", "title")

    def __init__(self, text: str, link: int, heading: bool, apart: bool, inside: int, title: bool):
        self.text, self.link, self.heading, self.apart, self.inside, self.title = text, link, heading, apart, inside, title


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; ``inside`` is 2 in an article, 1 in a main element, else 0."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # name, apart, inside
    parts: list[tuple[str, bool]] = []
    breaks, at = 0, 0

    def state():
        return (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def flush():
        nonlocal breaks
        breaks = 0
        if parts:
            text = " ".join(references.unescape("".join(t for t, _ in parts)).split())
            if text:
                link = sum(len("".join(references.unescape(t).split())) for t, linked in parts if linked)
                apart, inside = state()
                found.append(Block(text, link, any(n in _HEADING for n, _, _ in stack[-4:]), apart, inside,
                                   any(n == "h1" for n, _, _ in stack[-4:])))
            parts.clear()

    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            linked = any(n == "a" for n, _, _ in stack)
            parts.append((text, linked))
            if breaks and not text.isspace():
                breaks = 0
        if not m:
            break
        at = m.end()
        close, name, given = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not name:
            continue
        name = name.lower()
        if close:
            if name == "p" and not any(n == "p" for n, _, _ in stack):
                flush()
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                if name in _BLOCK or any(n in _BLOCK or n in _APART for n, _, _ in stack[depth:]) or name in _APART:
                    if name not in _BLOCK and name not in _APART:  # a stray inline end does not end blocks
                        del stack[depth]
                        continue
                    flush()
                del stack[depth:]
            elif name in _BLOCK:
                flush()
            continue
        if name == "br":
            parts.append((" ", False))
            breaks += 1
            if breaks > 1:
                flush()
            continue
        if name in _RAW:
            if not given.rstrip().endswith("/") or name in ("script", "style", "title", "textarea"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            parts.append((" ", False))
            continue
        apart, inside = state()
        if name in ("article", "main"):
            while stack and apart and any(n in _RESET for n, _, _ in stack):
                own = [k for k, (n, _, _) in enumerate(stack) if n in _RESET]
                outer = stack[own[0] - 1][1] if own[0] else False
                if outer:
                    break
                flush()
                del stack[own[0] :]
                apart, inside = state()
        if name in _BLOCK:
            flush()
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in ("p", "li", "td", "th", "div", "article", "section")), None)
            if depth is not None and stack[depth][0] == "p" and name in _CLOSES_P:
                del stack[depth:]
                apart, inside = state()
            elif name in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                stack.pop()
                apart, inside = state()
        elif name in ("body",):
            del stack[:]
            apart, inside = False, 0
        if name in _VOID:
            parts.append((" ", False))
            continue
        if given.rstrip().endswith("/") and name not in _BLOCK and name != "a":
            continue
        if name in _APART and name not in _BLOCK:
            flush()
        inside = max(inside, 2 if name == "article" else name == "main")
        stack.append((name, apart or _apart(name, given, inside > 0), inside))
    flush()
    return found


def _links(block: Block) -> float:
    return block.link / max(1, len(block.text) - block.text.count(" "))


def _decide(block: Block) -> str:
    """good, bad, or what pass two settles: short, near."""
    if block.apart:
        return "bad"
    size = len(block.text)
    if _links(block) > MOST_LINKS:
        return "bad"
    if size < SHORT:
        return "bad" if block.link else "short"
    words = _LETTERS.findall(block.text.lower())
    stops = sum(w in _STOP for w in words) / max(1, len(words))
    if stops >= MANY_STOPS:
        return "good" if size > LONG else "near"
    return "near" if stops >= FEW_STOPS else "bad"


def _believed(own: list[Block], first: list[str]) -> int:
    """2 if the page's articles hold its main text, 1 if its main element does, 0 if neither or there is none."""
    titles = [b for b in own if b.title and not b.apart]
    for level in (2, 1):
        within = sum(len(b.text) for b in own if b.inside >= level and not b.apart and _links(b) <= ARTICLE_LINKS)
        outside = sum(len(b.text) for b, label in zip(own, first) if b.inside < level and label == "good")
        titled = len(titles) == 1 and titles[0].inside >= level
        if within and within + TITLE * titled >= outside:
            return level
    return 0


def _prior(block: Block, label: str, believed: int) -> str:
    """The label of pass one with what the markers tell; ``held`` is ambiguous and good unless its neighbours are bad."""
    if block.apart or not believed:
        return label
    if block.inside >= believed:
        return label if label == "good" else "bad" if _links(block) > ARTICLE_LINKS else "held"
    return label if block.inside else "bad"


def main_text(page: str | None) -> str:
    if not page:
        return ""
    own = blocks(page)
    first = [_decide(b) for b in own]
    believed = _believed(own, first)
    first = [_prior(b, label, believed) for b, label in zip(own, first)]
    decided = [k for k, label in enumerate(first) if label in ("good", "bad")]
    # neighbours of a held block are those of its own element; what stands apart in it tells nothing
    telling = [believed > 0 and b.inside >= believed and not b.apart for b in own]
    last, before, held_last, held_before = None, [], None, []
    for k, label in enumerate(first):
        before.append(last)
        held_before.append(held_last)
        last = k if label in ("good", "bad") else last
        if not telling[k] and not own[k].apart:
            held_last = None
        elif telling[k] and label != "held":
            held_last = k
    kept, after, held_after = [], None, None
    for k in range(len(own) - 1, -1, -1):
        label = first[k]
        if not telling[k] and not own[k].apart:
            held_after = None
        if label == "held":
            a, b = held_before[k], held_after
            label = "bad" if a is not None and b is not None and first[a] == first[b] == "bad" else "good"
        elif label in ("good", "bad"):
            after = k
            held_after = k if telling[k] else held_after
        else:
            a, b = before[k], after
            if not decided:
                label = "good" if label == "near" else "bad"
            elif own[k].heading and b is not None:
                label = first[b]
            elif a is None or b is None:
                label = first[a if b is None else b]
            elif first[a] == first[b]:
                label = first[a]
            elif k - a != b - k:
                label = first[a if k - a < b - k else b]
            else:
                label = "good" if label == "near" else "bad"
        if label == "good":
            kept.append(own[k].text)
    return "\n".join(reversed(kept))


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: the id, the url, ``text`` and its length in code points, ``n_chars``."""
    schema = df.select(F.col(f"`{key}`"), F.col(f"`{url}`")).schema.add("text", "string").add("n_chars", "long")

    def over(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=schema.names)

    return df.select(F.col(f"`{key}`"), F.col(f"`{url}`"), F.col(f"`{html}`")).mapInArrow(over, schema)
