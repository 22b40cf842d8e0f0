"""A small tolerant HTML tree: block elements and the text runs between them."""

from __future__ import annotations

import re
from html import unescape

# Element names of HTML by how they are laid out.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr picture source object svg g text tspan math mrow mi mn mo ms mtext "
    "msup msub msubsup mfrac msqrt mroot mover munder munderover mfenced mstyle mpadded mphantom mtable mtr mtd semantics "
    "path circle rect line polyline polygon ellipse defs use symbol desc".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template iframe textarea title annotation".split())
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"ul", "ol", "dl", "table", "select"}

# Words in class, id and role by what they name.
NAMES = {
    "comment": "comment comments reply replies disqus discussion respond responses".split(),
    "ad": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner dfp".split(),
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay toast paywall disclaimer notification announcement warning".split(),
    "form": "form forms search login signin signup register subscribe subscription newsletter contact".split(),
    "side": "sidebar sidebars aside related recommended recommendations trending popular widget widgets rail complementary also teaser".split(),
    "menu": "nav navi navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc skip tabs toolbar".split(),
    "social": "share sharing social follow likes tweet tags tagcloud meta byline author".split(),
    "foot": "footer foot bottom copyright legal colophon contentinfo credits".split(),
    "head": "header head masthead topbar top logo branding hero".split(),
    "content": "article content contents post entry body main story text prose page blog hentry".split(),
}
_KIND_OF = {name: kind for kind, names in reversed(NAMES.items()) for name in names}
#: Inline elements of these names stand for themselves; any other is part of the text around it.
_APART = {"hidden", *(f"whole:{kind}" for kind in ("comment", "ad", "notice", "form", "side", "menu"))}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>?)", re.S
)
_NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/>=]|$)|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.I)
_LABEL = re.compile(r"data-label\s*=\s*\"(\w+)\"")
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}

_names: dict[str, tuple[str, ...]] = {}


def names_of(attributes: str) -> tuple[str, ...]:
    """What class, id and role name, each name on its own.

    ``whole:ad`` is a name that is the word itself, ``last:ad`` one that ends in
    it (``text-ad``) and ``first:ad`` one that starts with it (``ad-free``), as
    the last word of a compound says what a thing is and the first only of what kind.
    """
    if (found := _names.get(attributes)) is not None:
        return found
    seen = {"hidden"} if _HIDDEN.search(attributes) else set()
    for match in _NAMED.finditer(attributes):
        for name in next((g for g in match.groups() if g is not None), "").split():
            words = [w.lower() for w in _SPLIT.split(name) if w]
            kinds = [_KIND_OF.get(w) for w in words]
            if len(kinds) == 1:
                seen.add(f"whole:{kinds[0]}")
            elif kinds:
                seen.add(f"last:{kinds[-1]}")
                seen.update(f"first:{kind}" for kind in kinds[:-1])
    if len(_names) > 50_000:
        _names.clear()
    _names[attributes] = tuple(sorted(n for n in seen if not n.endswith(":None")))
    return _names[attributes]


class Tree:
    """Nodes in page order, parents first. Node 0 is the document; text runs have the tag ``#text``."""

    __slots__ = ("parent", "tag", "names", "text", "size", "links", "label")

    def __init__(self) -> None:
        self.parent, self.tag, self.names, self.text, self.size, self.links, self.label = [-1], ["#root"], [()], [""], [0], [0], [""]

    def _add(self, parent: int, tag: str, names: tuple[str, ...], text: str, size: int, links: int, label: str) -> int:
        for column, value in zip((self.parent, self.tag, self.names, self.text, self.size, self.links, self.label), (parent, tag, names, text, size, links, label)):
            column.append(value)
        return len(self.tag) - 1


def parse(html: str) -> Tree:
    """Build the tree of a page; whatever is not closed or not opened is repaired, never refused."""
    tree = Tree()
    stack, pieces, linked, in_link = [0], [], 0, False
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                tree._add(stack[-1], "#text", (), text, len(text), min(linked, len(text)), "")
            pieces.clear()
        linked = 0

    while at < end:
        mark = html.find("<", at)
        match = _TAG.match(html, mark) if mark >= 0 else None
        while mark >= 0 and match is None:  # a lone "<" is text
            mark = html.find("<", mark + 1)
            match = _TAG.match(html, mark) if mark >= 0 else None
        if mark < 0:
            mark = end
        if mark > at:
            piece = html[at:mark]
            pieces.append(piece)
            if in_link:
                linked += len(piece.strip())
        if match is None:
            break
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        name, closing, attributes = name.lower(), match.group(1), match.group(3)
        if name == "a":
            in_link = not closing
        if name == "br":
            pieces.append(" ")
            continue
        if name in RAW:
            if not closing and not attributes.endswith("/>"):
                close = _ENDS[name].search(html, at)
                at = close.end() if close else end
            continue
        inline = name in INLINE
        if inline and (closing or len(attributes) < 6 or _APART.isdisjoint(names_of(attributes))):
            if closing and len(stack) > 1 and tree.tag[stack[-1]] == name:  # an inline element that counts as a block
                flush()
                stack.pop()
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        flush()
        if closing:
            in_link = False
            for depth in range(len(stack) - 1, 0, -1):
                if tree.tag[stack[depth]] == name:
                    del stack[depth:]
                    break
            continue
        if name in CLOSES_P:
            for depth in range(len(stack) - 1, max(0, len(stack) - 4), -1):
                if tree.tag[stack[depth]] == "p":
                    del stack[depth:]
                    break
        if name in SAME:
            for depth in range(len(stack) - 1, 0, -1):
                tag = tree.tag[stack[depth]]
                if tag in SAME[name]:
                    del stack[depth:]
                    break
                if tag in SCOPE:
                    break
        label = m.group(1) if len(attributes) > 12 and (m := _LABEL.search(attributes)) else ""
        names = names_of(attributes) if len(attributes) > 5 else ()
        stack.append(tree._add(stack[-1], name, names, "", 0, 0, label))
    flush()
    size, links, parent = tree.size, tree.links, tree.parent
    for n in range(len(size) - 1, 0, -1):
        size[parent[n]] += size[n]
        links[parent[n]] += links[n]
    return tree
