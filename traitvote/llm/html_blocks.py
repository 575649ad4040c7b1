"""Leaf blocks of a web page and their features, for use in tasks."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html.parser import HTMLParser

# --- Fixed values: elements of HTML by the part they play. ---
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT = frozenset("script style template noscript head title svg iframe".split())
#: What can stand in a head; anything else begins the body, with or without ``</head>``.
IN_HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: Parts of class names and ids that tell what an element is for.
HINTS = tuple(
    "comment reply discuss cookie consent notice alert banner sidebar side menu nav foot head advert ads "
    "promo sponsor share social related recommend subscribe newsletter login search form "
    "breadcrumb content article post entry main story body text page wrap copyright meta".split()
)
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")
_TOKEN = re.compile(r"[a-z]+")


class Element:
    """An open element and what is known of it and all elements above it.

    What an element adds nothing to it shares with its parent, so a deep page
    takes no more than its length.
    """

    __slots__ = ("parent", "tag", "said", "tags", "hints", "tokens", "line")

    def __init__(self, parent: Element | None, tag: str, said: str) -> None:
        self.parent, self.tag, self.said = parent, tag, said
        above = parent or _NOTHING
        self.tags, self.hints, self.tokens = above.tags, above.hints, above.tokens
        #: The last tag that is no part of a line of text.
        self.line = above.line if tag in INLINE else tag
        if tag not in INLINE and tag not in self.tags:
            self.tags = (*self.tags, tag)
        if said:
            hints = {hint for hint in HINTS if hint in said}
            tokens = set(_TOKEN.findall(said))
            self.hints = self.hints if hints <= self.hints else self.hints | hints
            self.tokens = self.tokens if tokens <= self.tokens else self.tokens | tokens


class _Nothing:
    tags: tuple[str, ...] = ()
    hints = tokens = frozenset()
    line = ""


_NOTHING = _Nothing()


@dataclass
class Block:
    """White space as one space; ``inside`` is the innermost element around it."""

    text: str
    inside: Element | None
    link_chars: int


class _Parser(HTMLParser):
    """Cuts a page at elements that are no part of a line of text.

    The places of the open elements are kept by tag, so a tag takes the same
    time however many are open.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._stack: list[Element] = []
        self._places: defaultdict[str, list[int]] = defaultdict(list)
        self._lines: list[int] = []  # places of elements that are no part of a line
        self._silent = 0
        self._parts: list[str] = []
        self._began, self._inside = False, None
        self._links = 0

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self._parts)).strip()
        if text and self._began:
            self.blocks.append(Block(text, self._inside, self._links))
        self._parts, self._began, self._inside, self._links = [], False, None, 0

    def _open(self, tag: str, said: str) -> None:
        place = len(self._stack)
        self._stack.append(Element(self._stack[-1] if self._stack else None, tag, said))
        self._places[tag].append(place)
        if tag not in INLINE:
            self._lines.append(place)
        self._silent += tag in SILENT

    def _close(self, at: int) -> None:
        while len(self._stack) > at:
            tag = self._stack.pop().tag
            self._places[tag].pop()
            if tag not in INLINE:
                self._lines.pop()
            self._silent -= tag in SILENT

    def _end_head(self, tag: str) -> None:
        """Close an open head, and a title left open in it, where the body begins."""
        heads = self._places["head"]
        if tag in IN_HEAD or not heads:
            return
        if tag == "body" or self._silent == len(heads) + len(self._places["title"]):
            self._close(heads[0])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_head(tag)
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in ENDS_PARAGRAPH and self._places["p"]:
            self._close(self._places["p"][-1])
        elif tag in ("li", "option", "dt", "dd", "tr", "td", "th") and self._stack and self._stack[-1].tag == tag:
            self._close(len(self._stack) - 1)
        said = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "aria-label"))
        if any(k == "hidden" for k, _ in attrs):
            said += " hidden"
        self._open(tag, said.lower())

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_head(tag)
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if self._places[tag]:
            at = self._places[tag][-1]
            # an end of an inline element reaches no further than its block
            if tag not in INLINE or not self._lines or self._lines[-1] < at:
                self._close(at)

    def handle_data(self, data: str) -> None:
        if data.strip() and self._stack and self._stack[-1].tag == "head":
            self._close(len(self._stack) - 1)
        if self._silent:
            return
        if data.strip():
            if not self._began:
                self._began, self._inside = True, self._stack[-1] if self._stack else None
            if self._places["a"]:
                self._links += len(data.strip())
        self._parts.append(data)


def blocks_of(html: str | None) -> list[Block]:
    """The leaf blocks of a page in their order; none for NULL or no text."""
    parser = _Parser()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


def _bin(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= edge for edge in edges)


def features_of(blocks: list[Block]) -> list[list[str]]:
    """Names of the features of each block: elements above it, and its text."""
    out = []
    for k, block in enumerate(blocks):
        text, above = block.text, block.inside or _NOTHING
        found = ["bias"]
        found += [f"above={tag}" for tag in above.tags if tag not in ("html", "body")]
        found += [f"parent={above.line}"]
        found += [f"hint={hint}" for hint in sorted(above.hints)]
        found += [f"token={token}" for token in sorted(above.tokens)]
        words = text.count(" ") + 1
        links = block.link_chars / len(text)
        found.append(f"words={_bin(words, (2, 4, 8, 16, 32, 64))}")
        found.append(f"links={_bin(links, (0.01, 0.3, 0.7, 0.99))}")
        found.append(f"end={text[-1] if text[-1] in '.!?:,;' else ''}")
        found.append(f"place={_bin(k / len(blocks), (0.1, 0.3, 0.7, 0.9))}")
        if "©" in text:
            found.append("copyright")
        out.append(found)
    return out
