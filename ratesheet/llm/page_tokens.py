"""A page as tokens: elements that make blocks, and the text of each block, with their roles.

A role is a 64-bit hash of the path of elements (name, classes, id without digits) from the root,
so that the same tag or text in another place is another token. Elements inside a line (a, b, span)
make no tokens; their text belongs to the block around them.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

#: Comments, tags with quoted values, and what else stands between angle brackets. Each alternative
#: ends at the end of the page at the latest and is tried once a place.
_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S,
)
_VALUE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; it runs to the end tag.
_RAW = set("script style textarea title iframe noembed noframes noscript xmp".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td template tfoot th thead tr ul button object svg".split()
)
_CLOSES_P = _BLOCK - set("body caption dd dt head html legend li option select summary tbody td template tfoot th thead tr button object svg".split())
#: Start tag -> the open elements it ends, and where the search for them stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
_P_STOPS = {"table", "td", "th", "caption", "button", "object", "template"}

#: Elements that hold no main text, and words of class, id or role that say so.
_ASIDE = set("head nav aside footer form menu button select template dialog object svg option".split())
_ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies discussion disqus footer gdpr login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond search share sharebar sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription teaser teasers toolbar widget widgets".split()
)
#: Of these, the words that count on an article.
_ARTICLE_WORDS = set("ad ads advert advertisement comment comments promo promoted recommended related reply sponsored teaser".split())


@dataclass
class Node:
    """An open element. ``aside``: by its own name or words; ``main``: 2 for an article, 1 for a main part."""

    name: str
    role: int
    parent: int
    aside: bool
    main: int
    chars: int = 0
    links: int = 0


@dataclass
class Page:
    """Nodes in page order (the first is the page itself) and tokens: (kind, role, node, text).

    Kinds: "<" start tag, ">" end tag, "x" text of a block.
    """

    nodes: list[Node] = field(default_factory=list)
    tokens: list[tuple[str, int, int, str]] = field(default_factory=list)

    def chain(self, node: int) -> list[int]:
        """The node and all around it."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.nodes[node].parent
        return found


def _role(kind: str, parent: int, told: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{told}".encode("utf-8", "surrogatepass"), seed=parent) >> 1


def _described(name: str, rest: str) -> tuple[str, bool, int]:
    """(signature, whether it stands aside, main) of a start tag."""
    words, signature, hidden, main = set(), name, False, 2 * (name == "article") or int(name == "main")
    for key, value in _VALUE.findall(rest) if rest else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key, value.lower()) == ("aria-hidden", "true"):
            hidden = True
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif key in ("class", "id", "role"):
            signature += f" {key}={re.sub('[0-9]+', '0', value)}"
            words.update(w.lower() for w in _WORD.findall(value))
            main = main or int(key == "role" and value.lower() == "main")
        elif key == "itemprop" and value.lower() == "articlebody":
            main = max(main, 1)
    aside = name in _ASIDE or hidden
    if name not in ("html", "body", "main"):
        aside |= bool(words & (_ARTICLE_WORDS if name == "article" else _ASIDE_WORDS))
    return signature, aside, main


class _Reader:
    def __init__(self):
        self.page = Page([Node("", 0, -1, False, 0)])
        self.stack: list[tuple[str, int]] = []  # name and node; node -1 for elements inside a line
        self.pieces: list[tuple[str, bool]] = []

    @property
    def here(self) -> int:
        return next((n for _, n in reversed(self.stack) if n >= 0), 0)

    def flush(self) -> None:
        """The text read since the last block boundary is a block."""
        if not self.pieces:
            return
        text = " ".join("".join(t for t, _ in self.pieces).split())
        links = sum(len(t.strip()) for t, linked in self.pieces if linked)
        self.pieces = []
        if not text:
            return
        node = self.here
        nodes = self.page.nodes
        self.page.tokens.append(("x", _role("x", nodes[node].role, text), node, text))
        for k in self.page.chain(node):
            nodes[k].chars += len(text)
            nodes[k].links += links

    def cut(self, to: int) -> None:
        del self.stack[to:]

    def end_implied(self, names: set[str], stops: set[str]) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name in names:
                return self.cut(k)
            if name in stops:
                return None

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.pieces.append((" ", False))
            return
        if name not in _BLOCK:
            if name not in _VOID:
                self.stack.append((name, -1))
            return
        self.flush()
        if name in _CLOSES_P:
            self.end_implied({"p"}, _P_STOPS)
        if name in _ENDS:
            self.end_implied(*_ENDS[name])
        if name in _VOID:
            return
        signature, aside, main = _described(name, rest)
        nodes, parent = self.page.nodes, self.here
        if name == "header":  # of the page, unless it heads the article
            aside |= not any(nodes[k].main for k in self.page.chain(parent))
        nodes.append(Node(name, _role("<", nodes[parent].role, signature), parent, aside, main))
        self.stack.append((name, len(nodes) - 1))
        self.page.tokens.append(("<", nodes[-1].role, len(nodes) - 1, ""))

    def end(self, name: str) -> None:
        block = name in _BLOCK
        if block:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                if block:
                    node = self.stack[k][1]
                    self.page.tokens.append((">", self.page.nodes[node].role ^ 1, node, ""))
                return self.cut(k)
            if not block and self.stack[k][1] >= 0:
                return None


def _unwrap(page: Page) -> None:
    """What holds the article is not aside, whatever it is called: forms or layout around a page."""
    nodes = page.nodes
    mains = [k for k, n in enumerate(nodes) if n.main and not n.aside and n.chars]
    if mains:
        chains = [page.chain(k) for k in mains]
        if all(any(nodes[k].aside for k in chain) for chain in chains):
            for k in chains[0]:
                nodes[k].aside = False
        return
    first = next((k for k, n in enumerate(nodes) if n.name == "h1" and n.chars), None)
    for k in page.chain(first) if first is not None else ():
        if 2 * nodes[k].chars > nodes[0].chars:
            nodes[k].aside = False


def read(source: str | None) -> Page:
    """The tokens of a page; of one that breaks off, those up to there."""
    reader, at = _Reader(), 0
    source = source or ""
    while True:
        found = _MARKUP.search(source, at)
        text = source[at : found.start() if found else len(source)]
        if text:
            linked = any(name == "a" for name, _ in reader.stack)
            reader.pieces.append((html.unescape(text), linked))
        if not found:
            break
        at = found.end()
        if name := (found[2] or "").lower():
            if found[1]:
                reader.end(name)
            elif name in _RAW:
                over = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = over.start() if over else len(source)
            else:
                reader.start(name, found[3].strip())
    reader.flush()
    _unwrap(reader.page)
    return reader.page
