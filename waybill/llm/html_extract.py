"""Main text of web pages by tag-path ratios.

Per page, the text is cut into blocks, each with its path of tags from the root.
Text length and punctuation marks are added up per path and divided by the
path's blocks; both ratios are smoothed over neighbouring blocks, multiplied
into one score, and paths at or above a share of the page's mean score count as
content. Where elements marked as main hold half of the content or more, the
outermost of them are the article; else it is the innermost element around all
content, or its parent if that is a single block. All blocks of the article that
are not page furniture (menus, adverts, forms, comments and so on) are the text.
A tag, a role or being hidden makes furniture in any case; a class or id does
unless the element is around the page's article or holds most of it. Comments and
teasers are furniture also where they are articles by tag.

Defined results: null and empty pages, and pages without content, give an empty
text; an article of links only is kept. Time and memory are linear in a page's length. Pages are independent of each other, so repeated rows give repeated
results and an empty table gives no rows. Broken nesting is closed the way
browsers do it, as far as paragraphs, list items, table cells and options go.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, steps

#: What may start markup; a ``<`` before anything else is text.
_START = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[A-Za-z])")
_TAG = re.compile(r"<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE_TAG = re.compile(r"<([A-Za-z][^\s/>]*)([^>]*)>")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")
_MARKS = re.compile(r"[.,;:!?。，；：！？、…]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
#: Elements that do not end a block of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
#: Start tags that close an open element of the listed kinds, up to the nearest of the limits.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
FURNITURE_TAGS = frozenset("nav footer aside dialog button head".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments disqus cookie cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended pagination pager toolbar widget widgets copyright legal disclaimer paywall teaser teasers".split()
)
#: Words that name furniture only where the rest of the class or id names it or a box, too (``social-links``, not ``social-history``).
WEAK_WORDS = frozenset("legal social share sharing related notice notices promotion subscription copyright disclaimer login".split())
BOX_WORDS = frozenset(
    "area bar block body bottom box button buttons card container content count entry footer global group header icon icons inner item items left line link links list listing main more module outer page panel post posts right row section site slot stories tab thread title tools top user wrap wrapper".split()
)
#: First words of a class that tell how the page is laid out (``has-sidebar``).
LAYOUT_WORDS = frozenset("no not has have with without hide".split())
#: Furniture however much text it holds.
READER_WORDS = frozenset("comment comments disqus teaser teasers".split())
MAIN_WORDS = frozenset("article articlebody main content post entry story".split())
#: A path is content if its score is at least this share of the page's mean.
SHARE = 0.2


@dataclass(eq=False)
class Element:
    tag: str
    path: int
    parent: Element | None
    #: Furniture by tag, role or being hidden.
    hard: bool = False
    #: Furniture by name, unless it turns out to hold the article.
    suspect: bool = False
    readers: bool = False
    #: Marked as main by tag or role, or by a class or id.
    article: bool = False
    named: bool = False
    #: Whether this or an element around it is hard or suspect; then the nearest such block around text.
    doubtful: bool = False
    holder: Element | None = None
    furniture: bool = False
    main: bool = False
    mass: int = 0


@dataclass(eq=False)
class Block:
    element: Element
    path: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _names_furniture(name: str, strict: bool) -> bool:
    """Whether one class or id is that of furniture; ``strict``: made of such words and names of boxes only."""
    found = [w.lower() for w in _WORD.findall(name)]
    own = [w for w in found if w in FURNITURE_WORDS]
    if not own or found[0] in LAYOUT_WORDS:
        return False
    if strict or WEAK_WORDS.issuperset(own):
        return all(w in FURNITURE_WORDS or w in BOX_WORDS or w.isdigit() for w in found)
    return True


def _element(tag: str, attributes: str, parent: Element, paths: dict[tuple[int, str], int]) -> Element:
    hard = tag in FURNITURE_TAGS
    suspect = tag == "form"
    article = tag in ("article", "main")
    tokens: list[str] = []
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            hard |= value.lower() in FURNITURE_ROLES
            suspect |= value.lower() == "form"
            article |= value.lower() in ("main", "article")
        elif name == "hidden" or name == "aria-hidden":
            hard |= name == "hidden" or value.lower() == "true"
        elif name == "style":
            hard |= bool(_UNSEEN.search(value))
        elif name == "itemprop":
            article |= value.lower() == "articlebody"
        elif name in ("class", "id"):
            tokens += value.split()
    words = [w.lower() for token in tokens for w in _WORD.findall(token)]
    naming = [t for t in tokens if _names_furniture(t, article)] if tag not in ("html", "body", "main") else []
    readers = any(not READER_WORDS.isdisjoint(w.lower() for w in _WORD.findall(t)) for t in naming)
    # A header inside the article holds its heading; elsewhere it is the page's.
    hard |= (tag == "header" or "header" in words) and not article and not parent.main
    suspect |= bool(naming)
    named = not suspect and tag in ("div", "section", "td") and not MAIN_WORDS.isdisjoint(words)
    key = (parent.path, tag + "".join(f".{w}" for w in words[:2]))
    element = Element(tag, paths.setdefault(key, len(paths) + 1), parent, hard, suspect, readers, article and not suspect, named)
    element.doubtful = hard or suspect or parent.doubtful
    element.holder = parent.holder if tag in INLINE else element
    # While parsing, ``main`` means inside an article.
    element.main = parent.main or article
    return element


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """The page's blocks of text in order, furniture and all but raw elements included, and its elements, parents first."""
    root = Element("", 0, None)
    root.holder = root
    stack, elements = [root], [root]
    where: dict[str, list[int]] = defaultdict(list)  # places of the open elements of each tag
    paths: dict[tuple[int, str], int] = {}
    endless: set[str] = set()  # raw elements that nothing closes from here on
    found: list[Block] = []
    current: Block | None = None
    links = 0
    at, end = 0, len(page)
    tags = _TAG

    def say(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            if text.isspace():
                return
            top = stack[-1]
            current = Block(top if top.doubtful else top.holder, top.holder.path)
            found.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def close(until: int) -> None:
        nonlocal current, links
        for element in stack[until:]:
            links -= element.tag == "a"
            if element.tag not in INLINE or element.doubtful != stack[until - 1].doubtful:
                current = None
        for element in reversed(stack[until:]):
            where[element.tag].pop()
        del stack[until:]

    def last(*kinds: str) -> int:
        return max((where[kind][-1] for kind in kinds if where[kind]), default=0)

    while at < end:
        start = _START.search(page, at)
        if not start:
            say(page[at:])
            break
        begin = start.start()
        say(page[at:begin])
        kind = start[0]
        if kind in ("<!--", "<![CDATA[", "<!", "<?"):
            mark = {"<!--": "-->", "<![CDATA[": "]]>"}.get(kind, ">")
            until = page.find(mark, start.end())
            at = until + len(mark) if until >= 0 else end
            continue
        if kind.startswith("</"):
            until = page.find(">", begin)
            if until < 0:
                say(page[begin:])
                break
            at = until + 1
            tag = _NAME.match(page, begin + 2)[0].lower()
            if where[tag]:
                close(where[tag][-1])
            elif tag not in INLINE:
                current = None
            continue
        token = tags.match(page, begin)
        if not token:
            # A quote that nothing closes: from here on tags end at the first ``>``, which keeps time linear.
            tags = _LOOSE_TAG
            token = tags.match(page, begin)
            if not token:
                say(page[begin:])
                break
        at = token.end()
        tag, attributes = token[1].lower(), token[2]
        if tag == "br":
            say(" ")
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                ending = None if tag in endless else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if not ending:
                    endless.add(tag)
                at = ending.end() if ending else (end if tag in ("script", "style") else at)
            continue
        if tag not in INLINE:
            current = None
            spot = last("p")
            if spot and tag not in VOID | {"td", "th", "tr"}:
                close(spot)
        if tag in CLOSES:
            kinds, limits = CLOSES[tag]
            spot = last(*kinds)
            if spot > last(*limits):
                close(spot)
        if tag in VOID or attributes.endswith("/") and tag not in INLINE:
            continue
        element = _element(tag, attributes, stack[-1], paths)
        if element.doubtful != stack[-1].doubtful:
            current = None
        where[tag].append(len(stack))
        stack.append(element)
        elements.append(element)
        links += tag == "a"
    return found, elements


def _settle(blocks: list[Block], texts: list[str], elements: list[Element]) -> None:
    """Decide which elements are furniture and which are main, from how much text they hold.

    The page's article is the largest element marked as main. Furniture by name is no furniture after all if it is around
    the article or holds most of it; without an article, if it holds most of the page.
    """
    for element in elements:
        element.mass = 0
        element.furniture = element.hard or bool(element.parent and element.parent.furniture)
    for block, text in zip(blocks, texts, strict=True):
        if not block.element.furniture:
            block.element.mass += len(text)
    for element in reversed(elements[1:]):
        element.parent.mass += element.mass
    whole = elements[0].mass
    marked = [e for e in elements if not e.furniture and e.article and (not e.doubtful or 3 * e.mass >= whole)]
    marked = marked or [e for e in elements if not e.doubtful and e.named]
    article = max(marked, key=lambda e: e.mass, default=None)
    around, up = set(), article
    while up:
        around.add(up)
        up = up.parent
    inside: set[Element] = set()
    for element in elements:
        if element is article or element.parent in inside:
            inside.add(element)
        spared = element in around
        if not spared and not element.readers and element.tag not in INLINE and (article is None or element in inside):
            spared = 2 * element.mass > (article.mass if article else whole)
        above = element.parent
        element.furniture = element.hard or bool(above and above.furniture) or element.suspect and not spared
        element.main = bool(above and above.main) or not element.furniture and (element.article or element.named)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks, texts = [], []
    found, elements = blocks_of(page)
    for block in found:
        text = _SPACE.sub(" ", html.unescape("".join(block.parts))).strip()
        if text:
            blocks.append(block)
            texts.append(text)
    if not blocks:
        return ""
    _settle(blocks, texts, elements)
    size, marks, count, linked = (defaultdict(float) for _ in range(4))
    for block, text in zip(blocks, texts, strict=True):
        size[block.path] += len(text)
        marks[block.path] += len(_MARKS.findall(text))
        linked[block.path] += block.linked
        count[block.path] += 1

    def smoothed(total: dict[int, float]) -> dict[int, float]:
        row = [total[b.path] / count[b.path] for b in blocks]
        wide = [row[0], *row, row[-1]]
        sums: dict[int, float] = defaultdict(float)
        for k, block in enumerate(blocks):
            sums[block.path] += 0.25 * wide[k] + 0.5 * wide[k + 1] + 0.25 * wide[k + 2]
        return {path: s / count[path] for path, s in sums.items()}

    length, pauses = smoothed(size), smoothed(marks)
    score = {path: length[path] * (1 + pauses[path]) * max(0.0, 1 - linked[path] / size[path]) for path in size}
    mean = sum(score[b.path] for b in blocks) / len(blocks)
    content = {path for path in score if score[path] >= SHARE * mean and score[path] > 0}

    plain = [(block.element, block.path in content, text) for block, text in zip(blocks, texts, strict=True) if not block.element.furniture]
    total = sum(len(text) for _, chosen, text in plain if chosen)
    main = [text for element, _, text in plain if element.main]
    # Without content, as where all text is links, only what is marked as main is left.
    if not total or 2 * sum(len(text) for element, chosen, text in plain if chosen and element.main) >= total:
        return "\n".join(main)
    # The innermost element around all content; it must be more than one block.
    for element in elements:
        element.mass = 0
    for element, chosen, text in plain:
        element.mass += len(text) if chosen else 0
    for element in reversed(elements[1:]):
        element.parent.mass += element.mass
    top = next(element for element, chosen, _ in plain if chosen)
    while top.mass < total:
        top = top.parent

    def under(top: Element) -> list[str]:
        inside = {top}
        for element in elements:
            if element.parent in inside:
                inside.add(element)
        return [text for element, _, text in plain if element in inside]

    texts = under(top)
    return "\n".join(under(top.parent) if len(texts) == 1 and top.parent else texts)


def extract_main_text(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per row of ``df`` its id and url, the main ``text`` and ``n_chars``, its code points."""
    source = df.select(df[id_column].alias("id"), df[url_column].alias("url"), df[html_column].alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "html"):
            texts = [main_text(page) for page in column(part, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), column(part, "url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_column, url_column, "text", "n_chars"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(work, f"`{id_column}` {kind}, `{url_column}` string, text string, n_chars bigint")
