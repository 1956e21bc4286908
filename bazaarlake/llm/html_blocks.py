"""Leaf blocks of a web page: runs of text between block-level tags, with what stands around them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

# Element names by kind.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head iframe noscript object script style svg template title".split())
BLOCK = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead tr ul".split()
)
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas center cite code data del dfn em font i iframe ins kbd map mark nobr output picture "
    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var video wbr".split()
)
KNOWN = BLOCK | INLINE | UNSEEN
CLOSES_P = BLOCK - {"br", "body", "button", "html", "label", "option", "select", "textarea"}
#: An element of the key is ended by one of the value that begins inside the same parent.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

# Words in class, id and role by which pages name their parts.
FAMILIES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar pager pagination skip tabs toc",
    "header": "header masthead topbar banner brand logo site",
    "footer": "footer bottom copyright legal colophon imprint",
    "side": "sidebar aside rail widget widgets secondary complementary related recommended recommendations more trending popular teaser",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion adsense dfp",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay disclaimer warning privacy paywall",
    "comment": "comment comments commentlist disqus reply replies respond discussion reader readers feedback",
    "form": "form search login signup subscribe subscription newsletter contact register",
    "share": "share sharing social follow tags tag meta byline author date",
    "main": "article content post entry story main body text page blog news",
}
FAMILY_OF = {word: family for family, text in FAMILIES.items() for word in text.split()}
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SENTENCE_END = re.compile(r"[.!?…][\"'»”)]*$")


@dataclass
class Block:
    text: str
    features: list[str]


class Around:
    """An open element, and what it and all elements around it say. What an element adds nothing to is shared with its parent."""

    __slots__ = ("block", "inside", "said", "tag")

    def __init__(self, tag: str, names: frozenset[str], outer: Around | None) -> None:
        inside = outer is not None and outer.inside
        said = {f"named:{n}" for n in names}
        if tag in KNOWN:  # other names say nothing and may be without number
            said.add(f"in:{tag}")
        if inside:  # a name inside the article's own element says more than the same name around it
            said.update(f"inner:{n}" for n in names if n != "main")
            if tag in ("aside", "footer", "form", "header", "nav", "section", "ul"):
                said.add(f"inner:{tag}")
        before = outer.said if outer is not None else frozenset()
        self.tag = tag
        self.said = before if said <= before else before | said
        self.inside = inside or tag in ("article", "main") or "main" in names
        self.block = tag if tag in BLOCK or outer is None else outer.block


OUTSIDE = Around("", frozenset(), None)
OUTSIDE.block = "none"


class Blocks(HTMLParser):
    """Collects (text, link characters, innermost element) of each leaf block, in time that grows with the page alone."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Around] = []
        self.places: dict[str, list[int]] = {}  # of each tag's open elements
        self.blocks: list[int] = []  # places of open block elements
        self.unseen = 0
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.around = OUTSIDE
        self.found: list[tuple[str, int, Around]] = []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.found.append((text, self.linked, self.around))
        self.parts, self.linked, self.around = [], 0, OUTSIDE

    def pop(self) -> None:
        tag = self.open.pop().tag
        self.places[tag].pop()
        if tag in BLOCK:
            self.blocks.pop()
        self.unseen -= tag in UNSEEN
        self.links -= tag == "a"

    def close_to(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
        if tag == "body":
            while self.open and self.open[-1].tag != "html":
                self.pop()
        if self.blocks and (tag in CLOSES_P or tag in ENDED_BY):
            above = self.open[self.blocks[-1]].tag
            if (above == "p" and tag in CLOSES_P) or tag in ENDED_BY.get(above, ()):
                self.close_to(self.blocks[-1])
        if tag in VOID:
            return
        names = set()
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names.update(FAMILY_OF[w] for w in NAME.findall(CAMEL.sub(" ", value).lower()) if w in FAMILY_OF)
            elif key == "hidden" or (key == "style" and value and "display:none" in value.replace(" ", "").lower()):
                names.add("hidden")
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(Around(tag, frozenset(names), self.open[-1] if self.open else OUTSIDE))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.places.get(tag):
            self.close_to(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.unseen:
            return
        if data.strip():
            if self.around is OUTSIDE and self.open:
                self.around = self.open[-1]
            if self.links:
                self.linked += len(data)
        self.parts.append(data)


def bins(name: str, value: float, *edges: float) -> str:
    return f"{name}:{sum(value >= e for e in edges)}"


def features_of(text: str, linked: int, around: Around, place: float) -> list[str]:
    """Ancestor tags with the names that they carry, and the form of the text."""
    out = {"all", *around.said}
    out.add("inside" if around.inside else "outside")
    words = text.count(" ") + 1
    out.add(f"tag:{around.block}")
    out.add(bins("words", words, 3, 8, 20, 60))
    out.add(bins("links", linked / max(1, len(text)), 0.05, 0.4, 0.8))
    out.add(bins("commas", text.count(","), 1, 3))
    out.add(bins("place", place, 0.1, 0.9))
    if SENTENCE_END.search(text):
        out.add("sentence")
    if "©" in text or "(c)" in text.lower():
        out.add("copyright")
    return sorted(out)


def blocks_of(html: str) -> list[Block]:
    """All leaf blocks of a page in order. A tag that is cut off at the page's end is dropped."""
    last = html.rfind("<")
    if last > html.rfind(">") and html[last + 1 : last + 2].isalpha() | (html[last + 1 : last + 2] in ("/", "!", "?", "")):
        html = html[:last]
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    n = len(parser.found)
    return [Block(t, features_of(t, k, a, i / max(1, n - 1))) for i, (t, k, a) in enumerate(parser.found)]
