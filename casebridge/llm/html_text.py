"""Main text of web pages by scoring the element tree.

Every paragraph earns points for itself, its commas and its length, less the share of its text that is link text. The
points go in full to the element that holds it, by half to the next one out and by a third, a quarter .. beyond.
The best element, its score again discounted by its own link share, is the article, with the elements around it that
hold nothing else. Elements beside it that have few links or score well enough are kept with it. Menus, headers, footers, sidebars, notices, adverts,
comments of readers, scripts, styles and the fields of forms are left out wherever they stand, by tag, role, class or id.

A class or id is read word by word. A word that stands for itself (``sidebar``) names the element; one behind ``no``, ``has``,
``category`` and the like doesn't. One that is part of a longer name (``sidebar-right``) leaves a block out as long as there is
a text outside it: where nearly all text of the page lies in such a block, or in a form, it is a container like any other.

Null, empty and text-free pages give an empty text, and an empty table no rows. Pages are independent rows: ties go to the
outermost, then the first element, repeated rows repeat their result, and a page of any length is worked on whole. Columns
other than the html and those kept are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names by what they mean for a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEAVE_OUT = frozenset(
    "head title script style noscript template nav footer aside button select option textarea input iframe svg canvas "
    "object menu dialog audio video map".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidenav menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription signup login comment comments respond reply replies disqus discussion share sharing social related "
    "recommended pagination pager widget".split()
)
# Words before a noise word of one name that make it a property: no-sidebar, has-comments, category-social.
QUALIFIERS = frozenset("no not non without with has have having is category cat tag type format topic".split())
HOLDS_PARAGRAPHS = frozenset("article body main section div td blockquote center details figure li dd th form fieldset".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote ul ol dl table figure".split())

# An element that the start of another one closes, and the elements that keep it from reaching further out.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
P_SCOPE = frozenset("article aside body button div td th table section main form li blockquote header footer nav caption dd figure".split())

# A quote opens a value only after "="; every character is read once.
_ATTRS = r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title|noscript|iframe|svg)\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>{_ATTRS})>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_NO_TAG = re.compile(r"<(?!!--)")
_NAMING = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


#: What an element is by its name: kept, left out unless nearly all text is in it, left out.
KEPT, DOUBTFUL, NOISE = 0, 1, 2
#: Times the text outside that a doubtful element's text must have to be kept.
NEARLY_ALL = 10


class Element:
    __slots__ = ("name", "parent", "order", "score", "chars", "linked", "noise")

    def __init__(self, name: str, parent: Element | None, order: int, noise: int) -> None:
        self.name, self.parent, self.order, self.noise = name, parent, order, noise
        self.score = 0.0
        self.chars = self.linked = 0


def named_noise(value: str) -> int:
    """What the names of a class or id say."""
    found = KEPT
    for name in value.split():
        words = [w.lower() for w in _NAME_WORDS.findall(name)]
        at = next((i for i, w in enumerate(words) if w in NOISE_WORDS), None)
        if at is not None and QUALIFIERS.isdisjoint(words[:at]):
            if len(words) == 1:
                return NOISE
            found = DOUBTFUL
    return found


def noise_of(name: str, attrs: str, inside_article: bool) -> int:
    if name in LEAVE_OUT or name == "header" and not inside_article:
        return NOISE
    found = DOUBTFUL if name == "form" else KEPT
    if name in ("html", "body", "main", "article") or not attrs:
        return found
    for m in _NAMING.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.lower() in NOISE_ROLES:
            return NOISE
        if key == "hidden" and m[2] is None and m[3] is None or key == "aria-hidden" and value.lower() == "true":
            return NOISE
        if key in ("class", "id") and name not in PLAIN - {"ul", "ol", "blockquote", "table", "figure"}:
            found = max(found, named_noise(value))
    return NOISE if found == DOUBTFUL and name not in BLOCKS else found


def without_doubtful(blocks: list[tuple[str, int, list[Element]]]) -> list[tuple[str, int, list[Element]]]:
    """Blocks outside doubtful elements, and inside those that hold nearly all text that is left, from the outermost in."""
    doubtful = {id(e) for _, _, path in blocks for e in path if e.noise == DOUBTFUL}
    while doubtful:
        outside, inside = 0, dict.fromkeys(doubtful, 0)
        for text, links, path in blocks:
            outermost = next((id(e) for e in path if id(e) in doubtful), None)
            if outermost is None:
                outside += max(0, len(text) - links)
            else:
                inside[outermost] += max(0, len(text) - links)
        most = max(inside, key=inside.__getitem__)
        if inside[most] <= NEARLY_ALL * outside:
            break
        doubtful.discard(most)
    return [b for b in blocks if not any(id(e) in doubtful for e in b[2])]


def blocks_of(html: str) -> tuple[list[tuple[str, int, list[Element]]], list[Element]]:
    """Blocks of text in page order with their link characters and open elements, and all elements."""
    root = Element("#page", None, 0, KEPT)
    stack, every = [root], [root]
    blocks: list[tuple[str, int, list[Element]]] = []
    parts: list[str] = []
    links = anchors = articles = noisy = 0

    def end_block() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, links, [e for e in stack if e.name in BLOCKS or e is root]))
            parts.clear()
        links = 0

    def pop() -> None:
        nonlocal anchors, articles, noisy
        e = stack.pop()
        anchors -= e.name == "a"
        articles -= e.name in ("article", "main")
        noisy -= e.noise == NOISE

    def close(names: frozenset[str], scope: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i].name in scope:
                return

    last = html.rfind(">") + 1  # what follows holds no tag
    for m in _TOKEN.finditer(html[:last] + _NO_TAG.sub("&lt;", html[last:])):
        kind = m.lastgroup
        if kind == "text":
            if not noisy:
                text = unescape(m["text"]) if "&" in m["text"] else m["text"]
                parts.append(text)
                if anchors:
                    links += len(text.strip())
            continue
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in BLOCKS:
            end_block()
        elif name == "br":
            parts.append(" ")
        if m["end"]:
            if any(e.name == name for e in stack):
                close(frozenset((name,)), frozenset() if name in BLOCKS else P_SCOPE)
            continue
        if name in VOID:
            continue
        if name in CLOSES:
            close(*CLOSES[name])
        if name in BLOCKS:
            close(frozenset(("p",)), P_SCOPE)
        attrs = m["attrs"]
        if attrs.endswith("/") and name not in BLOCKS:
            continue
        e = Element(name, stack[-1], len(every), noise_of(name, attrs, articles > 0))
        stack.append(e)
        every.append(e)
        anchors += name == "a"
        articles += name in ("article", "main")
        noisy += e.noise == NOISE
    end_block()
    return blocks, every


def main_text(html: str | None) -> str:
    if not html:
        return ""
    blocks, every = blocks_of(html)
    blocks = without_doubtful(blocks)
    for text, links, open_elements in blocks:
        density = min(1.0, links / len(text))
        points = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - density)
        share = 1.0
        for e in reversed(open_elements):
            e.chars += len(text)
            e.linked += min(links, len(text))
            if e.name in HOLDS_PARAGRAPHS or e.parent is None:
                e.score += points / share
                share += 1
    held = {id(e): e for _, _, path in blocks for e in path if e.name in HOLDS_PARAGRAPHS or e.parent is None}
    if not held:
        return ""

    def rank(e: Element) -> float:
        bonus = 25.0 if e.name in ("article", "main") else 0.0
        return (e.score + bonus) * (1 - e.linked / e.chars if e.chars else 0.0)

    best = max(held.values(), key=lambda e: (rank(e), -e.order))
    outer = best
    while outer is not None:  # the whole article, not its strongest part
        if outer.name in ("article", "main"):
            best = outer
            break
        outer = outer.parent
    enough = max(10.0, 0.2 * rank(best))
    while best.parent is not None and best.name not in ("article", "main") and best.parent.name in HOLDS_PARAGRAPHS - {"body"} and best.parent.chars == best.chars:
        best = best.parent
    kept = {id(best)}
    if best.parent is not None and best.name not in ("article", "main", "body"):
        for e in every:
            if e.parent is best.parent and e.chars:
                if e.linked / e.chars < 0.25 or e.name in HOLDS_PARAGRAPHS and rank(e) >= enough:
                    kept.add(id(e))
    elif best.name in ("article", "main"):
        for e in held.values():  # an article in several parts
            if e.name == best.name and e.parent is best.parent and rank(e) >= enough:
                kept.add(id(e))
    return "\n".join(text for text, _, path in blocks if any(id(e) in kept for e in path))


@F.arrow_udf(T.StringType())
def main_text_of(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns and the main text of every page."""
    return pages.select(*keep, main_text_of(F.col(html_col)).alias(out_col))
