"""HTML as arrays of block nodes in document order, with features of each node."""

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

# Nothing here is tried twice: a run that was read is not given back.
OPENING = re.compile(r"<(?:!--|(?P<close>/?)(?P<tag>[a-zA-Z])|[!?/])")
NAME_END = re.compile(r"[\s/>]")
ENDS_OR_QUOTES = re.compile(r"[>\"']")
TAG = re.compile(r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"[a-z]+")

# What these elements hold is never text of the page.
SILENT = frozenset(
    "script style noscript template title textarea select button iframe object svg canvas audio video annotation annotation-xml".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
# A silent element that can stand inside one of its kind.
NESTS = frozenset("object svg template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var nobr blink output meter progress label math semantics mi mn mo ms mtext mspace mrow"
    " msub msup msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded mphantom merror menclose mmultiscripts"
    " mprescripts".split()
)
# A start tag ends an open element of these kinds.
ENDS = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre"
    " section table ul details".split()
)
# A start tag of these ends an open button or select, where it can't stand.
SECTIONS = frozenset("article body main section nav header footer aside form".split())
SCOPE = frozenset("ul ol dl table td th div article section body main aside nav form blockquote".split())
TAGS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption"
    " nav header footer aside form address details body html".split()
)
TAG_ID = {t: i + 1 for i, t in enumerate(TAGS)}

# Attribute tokens by what they tend to name; one feature per group.
GROUPS = (
    "article content main post entry story body text prose page blog single",
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc",
    "header masthead topbar top branding logo banner hero",
    "footer foot bottom copyright legal colophon imprint",
    "sidebar side aside widget rail related recommended recommendations popular trending more archive tags",
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner adsense",
    "cookie cookies consent notice gdpr popup modal overlay alert message warning disclaimer privacy banner",
    "comment comments reply replies respond disqus discussion thread feedback reviews reader",
    "form search login signup signin register newsletter subscribe subscription contact input",
    "share sharing social follow facebook twitter toolbar tools buttons meta byline author date",
)
GROUP_OF: dict[str, int] = {}
for _bit, _names in enumerate(GROUPS):
    for _name in _names.split():
        GROUP_OF[_name] = GROUP_OF.get(_name, 0) | 1 << _bit
ROLES = {
    "navigation": 1 << 1, "banner": 1 << 2, "contentinfo": 1 << 3, "complementary": 1 << 4, "search": 1 << 8,
    "main": 1, "article": 1, "dialog": 1 << 6, "alert": 1 << 6, "form": 1 << 8,
}
# Tags that say the same as a group.
TAG_GROUP = {
    "article": 1, "main": 1, "nav": 1 << 1, "header": 1 << 2, "footer": 1 << 3, "aside": 1 << 4, "form": 1 << 8,
    "dialog": 1 << 6,
}


@dataclass
class Page:
    """Nodes as parallel lists; node 0 is the page itself."""

    tag: list[int] = field(default_factory=lambda: [0])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    own: list[int] = field(default_factory=lambda: [0])  # attribute and tag groups
    above: list[int] = field(default_factory=lambda: [0])  # groups of the ancestors
    place: list[int] = field(default_factory=lambda: [0])  # among its siblings
    marked: list[int] = field(default_factory=lambda: [0])  # label, on training pages
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def _groups(tag: str, attributes: str) -> tuple[int, int]:
    bits, label = TAG_GROUP.get(tag, 0), 0
    if attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                for word in WORD.findall(value):
                    bits |= GROUP_OF.get(word, 0)
            elif name == "role":
                bits |= ROLES.get(value, 0)
            elif name == "data-keep":
                label = 1
    return bits, label


class Scanner:
    """Tags and comments of a page, in time proportional to its length.

    A tag runs from ``<`` and a letter (or ``</`` and a letter) to the next ``>`` that
    stands in no quotes. One without such an end is text; an end tag then runs to the
    next ``>``, as declarations do. A comment without an end runs to the end of the page.

    After the first tag without an end the scanner reads on in steps: from quote to
    closing quote. Two ways of reading that meet at an opening quote go on alike, so a
    quote from which no end was found is remembered and never followed again.
    """

    def __init__(self, source: str):
        self.source = source
        self.steps = False
        self.dead: set[int] = set()  # opening quotes from which no end is found
        self.found: dict[object, tuple[int, int]] = {}  # pattern: last search, and what it found

    def _next(self, what, at: int) -> int:
        """The next place of a pattern or text, the page's length without one."""
        since, place = self.found.get(what, (0, -1))
        if not since <= at <= place:
            if isinstance(what, str):
                place = self.source.find(what, at)
            else:
                match = what.search(self.source, at)
                place = match.start() if match else -1
            place = len(self.source) if place < 0 else place
            self.found[what] = at, place
        return place

    def _end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag, -1 without one."""
        source, way = self.source, []
        at = self._next(ENDS_OR_QUOTES, at)
        while at < len(source) and source[at] != ">":
            closing = -1 if at in self.dead else source.find(source[at], at + 1)
            if closing < 0:
                at = len(source)
                break
            way.append(at)
            match = ENDS_OR_QUOTES.search(source, closing + 1)
            at = match.start() if match else len(source)
        if at < len(source):
            return at
        self.dead.update(way)
        return -1

    def token(self, at: int):
        """The next token from a place on: its start, its end, whether it is an end tag,
        the tag's name and its attributes (no name: nothing to read). None at the end."""
        source = self.source
        while opening := OPENING.search(source, at):
            start, at = opening.span()
            if opening["tag"] is not None:
                if not self.steps:
                    if tag := TAG.match(source, start):
                        return start, tag.end(), tag["close"], tag["tag"], tag["attributes"]
                    self.steps = True
                name = at - 1
                name_end = self._next(NAME_END, name)
                end = self._end(name_end)
                if end >= 0:
                    return start, end + 1, opening["close"], source[name:name_end], source[name_end:end]
                if not opening["close"]:
                    continue
                end = self._next(">", name_end)
                if end < len(source):
                    return start, end + 1, "/", source[name:name_end], ""
                continue
            elif source.startswith("<!--", start):
                end = source.find("-->", at)
                return start, len(source) if end < 0 else end + 3, "", None, ""
            end = self._next(">", at)
            if end < len(source):
                return start, end + 1, "", None, ""
        return None


def parse(source: str) -> Page:
    """The page's block nodes and its blocks of text.

    Text of inline elements belongs to the block around them. Missing end tags are
    implied where HTML implies them; an end tag without a start is ignored. Every
    character reference is decoded, and white space is one space.

    A silent element ends at its end tag, at the end of a block around it, or at a
    start tag of a block that can't stand in it. Without an end tag of its own it
    holds inline content only and ends at the next block (script and style: the page;
    template: the block around it). A silent element, and what is open in it, stands
    on the stack with the node around it.
    """
    page = Page()
    open_: list[tuple[str, int]] = [("", 0)]  # block elements
    links = silent = 0  # silent: place on the stack of the first silent element
    loose = False  # a silent element without an end tag is open
    tags: dict[tuple[bool, str], tuple[int, int]] = {}
    opened = Counter()  # names on the stack
    pieces: list[str] = []
    linked = 0
    children = [0]
    at, size = 0, len(source)
    scanner = Scanner(source)

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                page.blocks.append((open_[-1][1], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop_to(depth: int):
        nonlocal silent, loose
        if depth < silent or not silent:
            flush()
        for name, _ in open_[depth:]:
            opened[name] -= 1
        del open_[depth:]
        if depth <= silent:
            silent, loose = 0, False

    def next_tag(tag: str, closing: bool) -> tuple[int, int]:
        """Where the next tag of this kind starts and ends; past the page without one."""
        where = tags.get((closing, tag), (-1, 0))
        if where[0] < at:
            slash = "/" if closing else ""
            match = re.compile(rf"<{slash}{tag}(?![^\s/>])", re.IGNORECASE).search(source, at)
            end = source.find(">", match.end()) if match else -1
            where = tags[closing, tag] = (size + 1, size) if end < 0 else (match.start(), end + 1)
        return where

    def end_silent(tag: str):
        """End the silent elements in which a block's start tag can't stand."""
        if loose:
            pop_to(silent)
            return
        if not (opened["svg"] or opened["button"] or opened["select"]):
            return
        for k in range(len(open_) - 1, silent - 1, -1):
            name = open_[k][0]
            if name in ("foreignobject", "desc", "title", "template"):
                return
            if name == "svg" or (name in ("button", "select") and tag in SECTIONS):
                pop_to(k)
                return

    while at < size:
        found = scanner.token(at)
        stop = found[0] if found else size
        if stop > at and not silent:
            text = source[at:stop]
            if "&" in text:
                text = html.unescape(text)
            pieces.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        _, at, closing, tag, attributes = found
        if tag is None:
            continue
        tag = tag.lower()
        in_svg = opened["svg"] > 0  # silent elements stand nowhere but in the silent part
        if in_svg and not closing and attributes.endswith("/"):
            continue
        if tag in SILENT:
            if closing:
                if opened[tag]:
                    pop_to(next(k for k in range(len(open_) - 1, 0, -1) if open_[k][0] == tag))
                continue
            end, after = next_tag(tag, True)
            if tag in RAW and end < (next_tag("svg", True)[0] if in_svg else size):
                at = after
                continue
            if tag in ("script", "style") and not in_svg:
                break
            if attributes.endswith("/") and tag not in RAW:
                continue
            if silent and loose and opened[tag]:
                pop_to(silent)
            closed = end < size and (tag in NESTS or tag in RAW or next_tag(tag, False)[0] > end)
            open_.append((tag, open_[-1][1]))
            opened[tag] += 1
            if not silent:
                silent = len(open_) - 1
                loose = not closed and tag != "template"
            continue
        if silent and (tag in VOID or tag in INLINE):
            continue
        if tag == "br" or tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        if closing:
            if opened[tag]:
                k = next(k for k in range(len(open_) - 1, 0, -1) if open_[k][0] == tag)
                if k < silent or not silent:
                    links = 0
                pop_to(k)
            continue
        if silent and tag in TAG_ID:
            end_silent(tag)
        if not silent:
            flush()
        ends = ENDS.get(tag) or ({"p"} if tag in CLOSES_P else ())
        if any(opened[name] for name in ends):
            for k in range(len(open_) - 1, silent, -1):
                if open_[k][0] in ends:
                    pop_to(k)
                elif open_[k][0] in SCOPE:
                    break
        up = open_[-1][1]
        opened[tag] += 1
        if silent:
            open_.append((tag, up))
            continue
        bits, label = _groups(tag, attributes)
        node = len(page.tag)
        page.tag.append(TAG_ID.get(tag, 0))
        page.parent.append(up)
        page.depth.append(len(open_))
        page.own.append(bits)
        page.above.append(page.above[up] | page.own[up])
        page.place.append(children[up])
        page.marked.append(label or page.marked[up])
        children[up] += 1
        children.append(0)
        open_.append((tag, node))
    flush()
    return page


SENTENCE = re.compile(r"[.!?;:,。！？،]")


def features(pages: list[Page]) -> np.ndarray:
    """One row per node of the pages, one after another."""
    sizes = [len(p.tag) for p in pages]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    total = int(starts[-1])

    def column(name):
        return np.concatenate([np.array(getattr(p, name), np.int64) for p in pages]) if pages else np.zeros(0, np.int64)

    tag, depth, own, above, place = (column(n) for n in ("tag", "depth", "own", "above", "place"))
    page = np.repeat(np.arange(len(pages)), sizes)
    first = starts[page]
    parent = np.where(column("parent") < 0, -1, column("parent") + first)
    chars, linked, marks, words, blocks = (np.zeros(total) for _ in range(5))
    for p, start in zip(pages, starts):
        for node, text, in_links in p.blocks:
            k = start + node
            chars[k] += len(text)
            linked[k] += in_links
            marks[k] += len(SENTENCE.findall(text))
            words[k] += text.count(" ") + 1
            blocks[k] += 1
    # Nodes stand in document order: a subtree is a run, its sums differences.
    last = np.arange(total) + 1
    stack_end = last.tolist()
    up = parent.tolist()
    for k in range(total - 1, -1, -1):
        if up[k] >= 0 and stack_end[k] > stack_end[up[k]]:
            stack_end[up[k]] = stack_end[k]
    last = np.array(stack_end, np.int64)
    here = np.arange(total)

    def below(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[last] - sums[here]

    all_chars, all_linked, all_marks, all_words = below(chars), below(linked), below(marks), below(words)
    nodes = last - here
    kids = np.bincount(parent[parent >= 0], minlength=total).astype(float)
    siblings = np.where(parent >= 0, kids[parent], 1)
    alike = np.zeros(total)
    keys = parent * 64 + tag
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    alike = counts[inverse] / siblings
    before, after = np.zeros(total), np.zeros(total)
    order = np.lexsort((place, parent))
    same = parent[order][1:] == parent[order][:-1]
    before[order[1:][same]] = all_chars[order[:-1][same]]
    after[order[:-1][same]] = all_chars[order[1:][same]]
    page_chars = np.maximum(all_chars[first], 1)
    text_before = np.concatenate([[0], np.cumsum(chars)])[here] - np.concatenate([[0], np.cumsum(chars)])[first]
    one = np.maximum(all_chars, 1)
    parent_chars = np.where(parent >= 0, all_chars[parent], all_chars)
    plain = [
        depth, np.log1p(chars), np.log1p(all_chars), all_linked / one, np.log1p(all_words), all_marks / np.maximum(all_words, 1),
        np.log1p(nodes), all_chars / nodes, all_chars / page_chars, all_chars / np.maximum(parent_chars, 1), np.log1p(kids),
        np.log1p(place), np.log1p(siblings), alike, np.log1p(before), np.log1p(after), text_before / page_chars,
        all_chars / np.maximum(all_words, 1),
    ]
    flags = [(own >> b) & 1 for b in range(len(GROUPS))] + [(above >> b) & 1 for b in range(len(GROUPS))]
    kinds = [tag == t for t in range(len(TAGS) + 1)]
    return np.stack([np.asarray(c, np.float32) for c in plain + flags + kinds], 1)
