"""Leaf blocks of a web page: runs of text between block-level tags, with what surrounds them."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from html import unescape

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup and no text of the page; left open, they hide the rest, as in a browser.
RAW_TAGS = frozenset("script style iframe textarea".split())
#: Elements whose text is not shown, or not as text; they end with their parent at the latest.
UNSEEN_TAGS = frozenset("select svg template".split())
#: A start tag of the key closes an open element of these names.
CLOSES = {
    "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head", "title"),
}
#: An open element of these names hides what is open around it from the rules above.
SCOPES = frozenset("ul ol dl table html body".split())
NO_NAMES: frozenset[str] = frozenset()
_PART = re.compile(r"[a-z]+")
_BEGINS = re.compile(r"<[/!?A-Za-z]")
_TAG = re.compile(r"""<(?:(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[!?/][^>]*+>)""")
_ATTRIBUTE = re.compile(r"""([^\s/=>"']++)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")


def _attributes(written: str) -> list[tuple[str, str]]:
    return [(m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or "")
            for m in _ATTRIBUTE.finditer(written)]


def _targets(attributes: list[tuple[str, str]]) -> list[str]:
    """The target of an anchor, if it has one."""
    return [unescape(value) for name, value in attributes if name in ("href", "xlink:href") and value][:1]


class Place:
    """An open element and those around it; blocks of one place share it, so reading is linear in the page.

    ``inside`` and ``named`` are the tags, and the words of classes, ids and roles, from here to the root;
    an element that adds none has the set of its parent.
    """

    __slots__ = ("tag", "inside", "named", "unseen")

    def __init__(self, tag: str, inside: frozenset[str], named: frozenset[str], unseen: bool) -> None:
        self.tag, self.inside, self.named, self.unseen = tag, inside, named, unseen

    def within(self, tag: str, words: frozenset[str]) -> Place:
        inside = self.inside if tag in self.inside else self.inside | {tag}
        named = self.named if words <= self.named else self.named | words
        return Place(tag, inside, named, self.unseen or tag in UNSEEN_TAGS)


ROOT = Place("", frozenset(), frozenset(), False)


@dataclass
class Block:
    text: str
    place: Place
    link_chars: int = 0


class _Reader:
    """The elements that are open, and the block that is being read."""

    def __init__(self) -> None:
        self.open: list[Place] = []
        #: Where the open elements of a tag are, innermost last.
        self.at: dict[str, list[int]] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.links: list[str] = []
        self.blocks: list[Block] = []

    @property
    def here(self) -> Place:
        return self.open[-1] if self.open else ROOT

    def flush(self) -> None:
        """End the block at hand with the elements that are open now."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, self.here, self.linked))
            self.parts, self.linked = [], 0

    def drop_to(self, at: int) -> None:
        """Close the elements from a place on."""
        if any(place.tag in BLOCK_TAGS and not place.unseen for place in self.open[at:]):
            self.flush()
        while len(self.open) > at:
            self.at[self.open.pop().tag].pop()

    def innermost(self, tags: Iterable[str]) -> int:
        """Where the innermost open element of one of the tags is; -1 if none is open."""
        return max((self.at[tag][-1] for tag in tags if self.at.get(tag)), default=-1)

    def close(self, closed: tuple[str, ...]) -> None:
        at = self.innermost(closed)
        if at >= 0 and at >= self.innermost(SCOPES):
            self.drop_to(at)

    def start(self, tag: str, attributes: str) -> None:
        if self.here.unseen:
            pass
        elif tag in BLOCK_TAGS:
            self.close(("p",))
            if tag in CLOSES:
                self.close(CLOSES[tag])
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        names = NO_NAMES
        if attributes:
            found = _attributes(attributes)
            named = " ".join(value for name, value in found if name in ("class", "id", "role"))
            if named:
                names = frozenset(_PART.findall(named.lower()))
            if tag == "a":
                self.links += _targets(found)
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append(self.here.within(tag, names))

    def end(self, tag: str) -> None:
        at = self.innermost((tag,))
        if at >= 0:
            self.drop_to(at)

    def text(self, data: str) -> None:
        if self.here.unseen:
            return
        if "&" in data:
            data = unescape(data)
        self.parts.append(data)
        if self.at.get("a"):
            self.linked += len(data)


def blocks(html: str | None) -> list[Block]:
    """The blocks of a page, as ``read_page`` finds them."""
    return read_page(html)[0]


def read_page(html: str | None) -> tuple[list[Block], list[str]]:
    """The blocks of a page in order, and the targets of all its anchors, with text or without.

    A null, an empty or a textless page has no blocks. What ``noscript``, ``canvas``,
    ``object`` and ``math`` hold is text like any other; whether it is main text is for
    the caller to say. Anchors count where their text is unseen too. Character references are decoded, white space is one space, and
    elements that the page leaves open end with their parent or with the page. A tag or
    comment that never ends hides the rest of the page, as it does in a browser.
    """
    html, reader, at = html or "", _Reader(), 0
    while at < len(html):
        begin = html.find("<", at)
        if begin != at:
            reader.text(html[at : begin if begin >= 0 else len(html)])
            if begin < 0:
                break
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 2)
            at = end + 3 if end >= 0 else len(html)
            continue
        found = _TAG.match(html, begin)
        if found is None:
            if _BEGINS.match(html, begin) is None:
                reader.text("<")
                at = begin + 1
            else:  # an open quote or no end
                end = html.find(">", begin)
                at = end + 1 if end >= 0 else len(html)
            continue
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            reader.end(tag)
        elif tag in RAW_TAGS:
            close = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(html, at)
            at = close.end() if close else len(html)
        elif not (found[3].endswith("/") and tag in UNSEEN_TAGS):
            reader.start(tag, found[3])
    reader.flush()
    return reader.blocks, reader.links
