"""Main text of web pages by scoring the containers of their paragraphs.

Each paragraph gives its parent points for its length and its commas, and its
grandparent half of them; points count less the more of a container's text is links.
The best container and those of its siblings that aren't mostly links are kept.
If the best container lies in an ``article`` or ``main`` element, that element is taken, and
with an article all others of the page that aren't mostly links.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp".split())
RAW_WITH_REFERENCES = frozenset("textarea title".split())
DROPPED = frozenset(
    "head nav footer aside form button select option input textarea label fieldset dialog "
    "menu svg math object canvas audio video".split()
) | RAW | RAW_WITH_REFERENCES
# Of these, what stands within a line and does not end it.
WITHIN = frozenset(
    "button select option input textarea label svg math object canvas audio video script style noscript "
    "template iframe noembed noframes".split()
)
# What a form is made of.
CONTROLS = frozenset("form input select textarea button".split())
PARAGRAPHS = frozenset("p pre td blockquote dd".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body article main section div header h1 h2 h3 h4 h5 h6 ul ol li dl dt table thead "
    "tbody tfoot tr th caption figure figcaption hr address hgroup details summary center".split()
) | DROPPED - WITHIN
CLOSES_P = BLOCKS - {"td", "dd", "dt", "li"}
# An element of these ends an open one of the same group, within the list or table around.
SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
AROUND = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "option": {"select"}}

# Words that are a class, an id or a role of an element that isn't part of the text.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar side aside nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar "
    "comment comments disqus replies respond cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended pagination pager widget toolbar search dialog complementary contentinfo "
    "skip hidden popular trending signin paywall".split()
)
# Names of several words say so if all are of the list above or of these.
FRAME = frozenset(
    "site page main post posts articles stories list item items wrapper wrap container box block area "
    "section inner outer left right top bottom bar link links button buttons icon icons thread js "
    "slot slots unit units google dfp primary secondary form forms law info user users rail content text "
    "message msg panel zone region global mobile desktop field fields label title holder more most read "
    "policy reader readers visitor".split()
)
# Names that begin or end with one of these say so of what holds a form, or no long text but links.
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs comment comments disqus cookie cookies gdpr popup modal "
    "newsletter subscribe signup login signin share sharing rail trending popular paywall toolbar "
    "pagination search".split()
)
# Names of a state, not of what an element holds.
STATES = frozenset("has with no not is without".split())
# A header outside the articles that is no header element.
HEADERS = frozenset("header masthead topbar".split())
# Words that say so only alone: in longer names they are used of text too.
ALONE = frozenset("side hidden skip search notice notices alert".split())
COMMENTS = frozenset("comment comments disqus replies respond".split())
# Elements that are not left out by a name: headings are named after their text, and links stand in it.
UNNAMED = frozenset("html body main h1 h2 h3 h4 h5 h6 a".split())
# Elements whose own text, if it is long, speaks for the container.
SCORED = PARAGRAPHS | {"div", "section", "article", "main", "li", "body"}
LONG = 25
# A sibling of the best container with a larger share of links is not text.
MOST_LINKS = 0.5

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)")
_ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACES = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    parent: Node | None
    dropped: bool
    named: bool = False
    maybe: bool = False
    controls: int = 0
    in_comments: bool = False
    in_article: bool = False
    kept: bool = False
    score: float = 0.0
    chars: int = 0
    link_chars: int = 0
    long_chars: int = 0
    article_chars: int = 0


@dataclass(slots=True)
class Block:
    """Text that stands together, and the block element around it."""

    node: Node
    # each with the element it stands in, and whether that is in a link
    pieces: list[tuple[str, Node, bool]] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""

    def read(self) -> None:
        self.text = _SPACES.sub(" ", "".join(t for t, _, _ in self.pieces)).strip()
        self.link_chars = sum(len(t.strip()) for t, _, in_link in self.pieces if in_link)


def _attributes(source: str) -> dict[str, str]:
    """Names and values; of names that repeat the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in ("'", '"') and value[-1] == value[0]:
            value = value[1:-1]
        found.setdefault(name.lower(), html.unescape(value))
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or _HIDDEN.search(attributes.get("style", "")) is not None
    )


def _names(attributes: dict[str, str], *names: str) -> Iterator[list[str]]:
    """The words of each class, id or role, in order."""
    for name in names:
        for token in attributes.get(name, "").split():
            words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if any(words):
                yield [w for w in words if w]


def _unlikely(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a name says that an element isn't part of the text."""
    if tag in UNNAMED:
        return False
    if tag == "article":
        return any(set(w) & COMMENTS and set(w) <= COMMENTS | FRAME for w in _names(attributes, "class", "id"))
    for words in _names(attributes, "class", "id", "role"):
        own = set(words)
        if not in_article and own & HEADERS and own <= HEADERS | FRAME:
            return True
        if own <= UNLIKELY if len(words) == 1 else own & UNLIKELY - ALONE and own <= UNLIKELY | FRAME:
            return True
    return False


def _maybe_unlikely(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a name may say so; what the element holds decides."""
    if tag in UNNAMED or tag == "article":
        return False
    return any(
        words[0] not in STATES and (words[0] in STRONG or words[-1] in STRONG)
        for words in _names(attributes, "class", "id", "role")
    )


def _parsed(page: str) -> tuple[list[Node], list[Block]]:
    """The page's elements and blocks, both in page order. Linear in the page, however deep."""
    root = Node("html", None, False)
    nodes, stack, blocks, block, links = [root], [root], [], None, 0
    opened: Counter[str] = Counter()

    def close(until: int) -> None:
        nonlocal links, block
        for node in stack[until:]:
            opened[node.tag] -= 1
            links -= node.tag == "a"
            if node.tag in BLOCKS:
                block = None
        del stack[until:]

    def close_same(tags, around) -> None:
        if not any(opened[t] > 0 for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in around:
                return
            if stack[k].tag in tags:
                return close(k)

    def add(text: str) -> None:
        nonlocal block
        if stack[-1].dropped:
            return
        if block is None:
            if not text.strip():
                return
            block = Block(next(n for n in reversed(stack) if n.tag in BLOCKS))
            blocks.append(block)
        block.pieces.append((text, stack[-1], links > 0))

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            add(html.unescape(page[at:start]))
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(page, start) or _LOOSE_TAG.match(page, start)
        if not m:
            add("<")
            at = start + 1
            continue
        at, closing, tag = m.end(), m[1], m[2].lower()
        if closing:
            if opened[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            elif tag in BLOCKS:
                block = None
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in CLOSES_P:
            close_same({"p"}, {"table", "button", "object"})
        if tag in SAME:
            close_same(SAME[tag], AROUND[tag])
        if tag in BLOCKS:
            block = None
        if tag in CONTROLS:
            stack[-1].controls += 1
        if tag in VOID:
            continue
        if tag in RAW or tag in RAW_WITH_REFERENCES:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            if end:
                close_at = page.find(">", end.start())
                at = size if close_at < 0 else close_at + 1
            else:
                at = size
            continue
        up = stack[-1]
        attributes = _attributes(m[3])
        dropped = up.dropped or tag in DROPPED or tag == "header" and not up.in_article or _hidden(attributes)
        named = not dropped and _unlikely(tag, attributes, up.in_article)
        maybe = not dropped and not named and _maybe_unlikely(tag, attributes)
        comments = (named or maybe) and any(COMMENTS & set(w) for w in _names(attributes, "class", "id"))
        in_article = up.in_article or tag in ("article", "main")
        node = Node(tag, up, dropped, named, maybe, 0, up.in_comments or comments, in_article)
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
        links += tag == "a"
    for b in blocks:
        b.read()
    return nodes, [b for b in blocks if b.text]


def _without_named(nodes: list[Node], blocks: list[Block]) -> list[Block]:
    """The blocks without what stands in elements that a name says aren't part of the text.

    A name does not count for what is around the page's articles or ``main``. Without
    these, and inside them, it does not count for what holds most of the long text.
    """
    for b in blocks:
        if len(b.text) >= LONG and b.node.tag in SCORED and not b.node.in_comments:
            b.node.long_chars += max(len(b.text) - b.link_chars, 0)
    root = nodes[0]
    for n in reversed(nodes[1:]):
        if n.in_article and not n.parent.in_article and not n.dropped and not n.named:
            n.article_chars = n.long_chars + 1
        n.parent.long_chars += n.long_chars
        n.parent.article_chars += n.article_chars
        n.parent.controls += n.controls
    for n in nodes[1:]:
        around = n.article_chars > 0 and 2 * n.article_chars >= root.article_chars
        most = 2 * n.long_chars > root.long_chars and (n.in_article or not root.article_chars)
        named = n.named or n.maybe and (n.in_comments or n.controls > 0 or not n.long_chars)
        n.dropped = n.dropped or n.parent.dropped or named and not around and not most
    for b in blocks:
        if any(n.dropped for _, n, _ in b.pieces):
            b.pieces = [p for p in b.pieces if not p[1].dropped]
            b.read()
    return [b for b in blocks if b.text]


def _within(nodes: list[Node], blocks: list[Block], kept: set[int]) -> list[Block]:
    """The blocks below any of the elements, and those blocks, that are in ``kept`` by their ``id``."""
    for n in nodes:
        n.kept = id(n) in kept or n.parent is not None and n.parent.kept
    return [b for b in blocks if b.node.kept or id(b) in kept]


def _density(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


def main_text(page: str) -> str:
    """The blocks of the main text, one a line."""
    nodes, blocks = _parsed(page)
    text = _main_text(nodes, _without_named(nodes, blocks))
    if not text and any(n.named or n.maybe for n in nodes):
        text = _main_text(*_parsed(page))
    return text


def _main_text(nodes: list[Node], blocks: list[Block]) -> str:
    candidates: list[Node] = []
    for b in blocks:
        size = len(b.text)
        b.node.chars += size
        b.node.link_chars += min(b.link_chars, size)
        if size >= LONG and b.node.tag in SCORED:
            points = 1 + sum(b.text.count(c) for c in ",،、，") + min(size / 100, 3)
            points *= 1 - min(b.link_chars, size) / size
            own = b.node.parent if b.node.tag in PARAGRAPHS | {"li"} else b.node
            for node, share in ((own, 1.0), (own.parent if own else None, 0.5)):
                if node is not None:
                    if not node.score:
                        candidates.append(node)
                    node.score += share * points
    for n in reversed(nodes[1:]):
        n.parent.chars += n.chars
        n.parent.link_chars += n.link_chars
    best = max(candidates, key=lambda n: n.score * (1 - _density(n)), default=None)
    if best is None:
        # No paragraph is long enough to count: an article element, or what isn't links.
        rest = [b for b in blocks if b.node.in_article]
        rest = rest or [b for b in blocks if b.link_chars <= len(b.text) / 2]
        return "\n".join(b.text for b in rest)
    if best.in_article:
        while best.parent is not None and best.parent.in_article:
            best = best.parent
    # What holds no more text than the best container stands for it, as then do its siblings.
    while not best.in_article and best.parent is not None and best.parent.chars == best.chars:
        best = best.parent
    kept = {id(best)}
    if best.tag == "article":
        # All articles of the page, but lists of links.
        kept |= {
            id(n) for n in nodes
            if n.tag == "article" and n.parent is not None and not n.parent.in_article and n.chars and _density(n) <= MOST_LINKS
        }
    if best.tag not in ("article", "main", "body", "html") and best.parent is not None:
        kept |= {id(n) for n in nodes if n.parent is best.parent and n.chars and _density(n) <= MOST_LINKS}
        kept |= {id(b) for b in blocks if b.node is best.parent and b.link_chars <= len(b.text) * MOST_LINKS}
    return "\n".join(b.text for b in _within(nodes, blocks, kept))


def _extract(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py() or "") for p in pages], pa.string())


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of each page's main text.

    Pages are read whole. A null or empty page, or one with nothing but what is left out,
    has an empty text. Character references are decoded; white space inside a block is one
    space. Every row is read alone, so ids may be null or repeat; other columns are not
    looked at.
    """
    text = pages.select("page_id", "url", F.arrow_udf(_extract, "string")("html").alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
