"""Main text of web pages by composite text density.

Every element of the page gets a composite density: its characters per tag, adjusted for how much
of them is link text (a menu is nearly all links, an article nearly none). An element's density
sum adds up the densities of its children; the subtree with the largest sum is the article's body.
An ``article`` or ``main`` element counts for more, but a short one beside the real text loses. The smallest density on the
path from the best subtree to the body element is the threshold of content: other parts of the page that reach it (other articles, where
the best one is an article) belong to the text too.

Elements that are no article by their meaning (menus, headers and footers of the page, sidebars, forms, scripts, notices, adverts,
reader comments) are cut before. Where only a class, id or role says so, an element stays if it carries the page (an article or most
of the unlinked text); and names that also occur on parts of an article (notice, legal, discussion) do not cut what lies inside the content, unless it is mostly links.

One pass over the rows, no shuffle; a page is one cell.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patchloom.llm.rows import with_text_columns

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split())
#: Elements that never hold article text.
_CUT = frozenset(
    "head script style noscript template iframe object embed svg canvas nav footer aside form menu dialog button select option "
    "textarea input label fieldset title xmp noembed noframes audio video map datalist".split())
#: Parts of class, id and role values that name what is no article.
_CUT_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner popup modal overlay "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav aside widget widgets toolbar "
    "header masthead footer cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond reply replies discussion related recommended recommendations teaser teasers share sharing social "
    "pagination pager copyright legal disclaimer complementary contentinfo search form skip tags".split())
#: First parts that turn a name into a remark on the layout (``has-sidebar``).
_REMARKS = frozenset("has no with without is js".split())
#: Elements that names do not cut, and the names that cut an article all the same.
_KEEP = frozenset(["html", "body", "main"])
_CUT_ARTICLE = frozenset("comment comments reply replies ad advert advertisement sponsored promo related recommended teaser teasers".split())
#: Names that parts of an article bear as well.
_LOOSE_WORDS = frozenset(
    "discussion legal notice notices widget widgets form alert notification tags search skip copyright disclaimer banner toolbar overlay".split())
#: Elements that say they hold the text, and how much more they count.
_MARKED, _STANDING = frozenset(["article", "main"]), 3
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names of headers, which inside an article are its own.
_HEADERS = frozenset(["header", "masthead"])
_CLOSES_P = _BLOCK - frozenset(["br", "li", "dd", "dt", "tr", "td", "th", "tbody", "thead", "tfoot", "option", "optgroup", "html", "head", "body"])
_CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_NAME = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?<![^\s"'/])hidden(?![^\s=/>])|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "names", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, cut: bool):
        self.tag, self.parent, self.cut, self.names = tag, parent, cut, frozenset()
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _is_cut(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in _CUT:
        return True
    if tag == "header":
        return not inside_article
    return bool(attributes) and tag not in _KEEP and _HIDDEN.search(attributes) is not None


def _cut_names(tag: str, attributes: str, inside_article: bool) -> frozenset[str]:
    """The parts of names for which an element is cut."""
    if not attributes or tag in _KEEP or tag == "header":
        return frozenset()
    names, hit = _CUT_ARTICLE if tag == "article" else _CUT_WORDS, set()
    for a, b, c in _NAME.findall(attributes):
        for name in (a or b or c).lower().split():
            words = _SPLIT.split(name)
            if words[0] not in _REMARKS:
                hit |= names.intersection(words)
    return frozenset(hit - _HEADERS if inside_article else hit)


def tree(page: str) -> Node:
    """The element tree of a page, forgiving of unclosed and misnested tags."""
    root = node = Node("#root", None, False)
    at, size = 0, len(page)
    open_now: dict[str, int] = {}
    last_close = page.rfind(">")
    lower = None

    def leave(up: Node) -> Node:
        """The node above ``up``, all elements down from it being closed."""
        nonlocal node
        while node is not up:
            open_now[node.tag] -= 1
            node = node.parent
        open_now[up.tag] -= 1
        return up.parent

    while at < size:
        open_at = page.find("<", at)
        if open_at < 0:
            node.parts.append(page[at:])
            break
        if open_at > last_close and not page.startswith("<!", open_at) and not page.startswith("<?", open_at):
            node.parts.append(page[at: open_at + 1])
            at = open_at + 1
            continue
        if open_at > at:
            node.parts.append(page[at:open_at])
        m = _TOKEN.match(page, open_at)
        if m is None:
            m = _LOOSE.match(page, open_at)
            if m is None:
                node.parts.append("<")
                at = open_at + 1
                continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_now.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                node = leave(up)
            elif tag == "br" or tag == "p":
                node.parts.append(Node(tag, node, False))
            continue
        if tag in _CLOSES_P or tag in _CLOSED_BY:
            ends, walls = _CLOSED_BY.get(tag, (frozenset(["p"]), frozenset()))
            last, up = None, node if any(open_now.get(e) for e in ends) else root
            while up is not root and up.tag not in walls and not (ends == frozenset(["p"]) and up.tag in _BLOCK and up.tag != "p"):
                if up.tag in ends:
                    last = up
                up = up.parent
            if last is not None:
                node = leave(last)
        inside_article = open_now.get("article", 0) > 0
        child = Node(tag, node, _is_cut(tag, m[3], inside_article))
        if not child.cut:
            child.names = _cut_names(tag, m[3], inside_article)
            child.cut = bool(child.names)
        node.parts.append(child)
        if tag in _VOID:
            continue
        if tag in _RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find("</" + tag, at) if len(lower) == size else -1
            if len(lower) != size:  # lower case of a few letters is longer
                found = re.compile("</" + re.escape(tag), re.I).search(page, at)
                end = found.start() if found else -1
            if end < 0:
                break
            close = page.find(">", end)
            at = size if close < 0 else close + 1
            continue
        if m[3].endswith("/") and tag in ("svg", "path"):
            continue
        open_now[tag] = open_now.get(tag, 0) + 1
        node = child
    return root


def _keep_carriers(root: Node) -> None:
    """Takes back cuts by name of elements that hold an article or main element or most of the unlinked text; never of comments,
    adverts and lists of other pages."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        order.append((node, linked))
        stack.extend((p, linked) for p in node.parts if not isinstance(p, str) and (not p.cut or p.names))
    held: dict[int, tuple[int, bool]] = {}
    for node, linked in reversed(order):
        chars, carrier = 0, False
        for p in node.parts:
            if isinstance(p, str):
                chars += 0 if linked else len(p) - p.count(" ") - p.count("\n")
            elif (inner := held.get(id(p))) and not p.names & _CUT_ARTICLE:
                chars += inner[0]
                carrier = carrier or inner[1]
        held[id(node)] = chars, carrier or node.tag in ("article", "main") and chars > 0
    for node, _ in order:
        chars, carrier = held[id(node)]
        if node.names and not node.names & _CUT_ARTICLE and (carrier or chars * 2 > held[id(root)][0]):
            node.cut = False


def _measure(root: Node) -> list[Node]:
    """Counts of every kept element, children first; returns them in page order."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append((node, linked))
        linked = linked or node.tag == "a"
        for p in reversed(node.parts):
            if not isinstance(p, str) and not p.cut:
                stack.append((p, linked))
    for node, linked in reversed(order):
        linked = linked or node.tag == "a"
        for p in node.parts:
            if isinstance(p, str):
                n = len(p) - p.count(" ") - p.count("\n")
                node.chars += n
                if linked:
                    node.link_chars += n
            elif not p.cut:
                node.chars += p.chars
                node.tags += p.tags + 1
                node.link_chars += p.link_chars
                node.link_tags += p.link_tags + (p.tag == "a")
    return [n for n, _ in order]


def _score(nodes: list[Node], body: Node) -> None:
    """Composite densities and their sums."""
    share = body.link_chars / body.chars if body.chars else 0.0
    for n in nodes:
        if not n.chars:
            continue
        tags, plain = max(n.tags, 1), max(n.chars - n.link_chars, 1)
        links, link_tags = max(n.link_chars, 1), max(n.link_tags, 1)
        base = math.log(n.chars / plain * n.link_chars + share * n.chars + math.e)
        n.density = n.chars / tags * max(math.log(n.chars * tags / (links * link_tags)), 0.0) / base if base > 0 else 0.0
    for n in nodes:
        n.sum = sum(p.density for p in n.parts if not isinstance(p, str) and not p.cut)


def _standing(n: Node) -> float:
    return _STANDING * max(n.sum, n.density) if n.tag in _MARKED else n.sum


def _contents(best: Node, body: Node, least: float) -> list[Node]:
    """The best subtree and every other one of the body whose density reaches ``least`` (beside an article, other articles), in page order."""
    path, up = set(), best
    while up is not body and up.parent is not None:
        up = up.parent
        path.add(id(up))
    out, stack = [], [body]
    while stack:
        n = stack.pop()
        fits = n.density > 0 and n.density >= least and (best.tag not in _MARKED or n.tag in _MARKED)
        if n is best or fits and id(n) not in path:
            out.append(n)
        else:
            stack.extend(p for p in reversed(n.parts) if not isinstance(p, str) and not p.cut)
    return out


def _keep_parts(content: Node) -> None:
    """Takes back cuts by loose names inside the content of what is not mostly links."""
    stack = [content]
    while stack:
        n = stack.pop()
        if n.cut:
            _measure(n)
            if n.link_chars * 2 > n.chars:
                continue
            n.cut = False
        stack.extend(p for p in n.parts if not isinstance(p, str) and (not p.cut or p.names and p.names <= _LOOSE_WORDS))


def _menus(body: Node, least: float) -> set[int]:
    """Lists of links that stand in the body itself, where that is the frame of the text; not those under a heading, nor paragraphs."""
    out, stack = set(), [body]
    while stack:
        n = stack.pop()
        heading = False
        for p in n.parts:
            if isinstance(p, str):
                heading = heading and not p.strip()
            elif not p.cut and p.chars:
                if p.tag in _BLOCK and p.tag != "p" and p.link_chars * 2 > p.chars and p.density < least:
                    if not heading:
                        out.add(id(p))
                else:
                    stack.append(p)
                heading = p.tag in _HEADINGS
    return out


def _write(node: Node, left_out: set[int], out: list[str]) -> None:
    """The text of a subtree, block by block."""
    stack: list[Node | str | None] = [node]
    while stack:
        p = stack.pop()
        if p is None:
            out.append("\0")
        elif isinstance(p, str):
            out.append(p)
        elif id(p) in left_out:
            out.append("\0")
        elif not p.cut:
            if p.tag in _BLOCK:
                out.append("\0")
                stack.append(None)
            stack.extend(reversed(p.parts))


def main_text(page: str | None) -> str:
    """The article text of a page: white space inside a block as one space, blocks joined by one space; empty if there is none."""
    if not page:
        return ""
    page = page.replace("\0", " ")
    root = tree(page)
    _keep_carriers(root)
    nodes = _measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    inside = list(_within(body))
    _score(inside, body)
    best = max((n for n in inside if n.chars), key=_standing, default=body)
    if best.tag not in _MARKED and (best.sum == 0.0 or best.tag == "p"):  # text that stands alone: the whole body is its frame
        best = body
    least, up = best.density, best
    while up is not body and up.parent is not None:
        up = up.parent
        least = min(least, up.density)
    out: list[str] = []
    for n in _contents(best, body, least):
        if n is not body:
            _keep_parts(n)
        out.append("\0")
        _write(n, _menus(body, least) if n is body else set(), out)
    blocks = (_SPACE.sub(" ", entities.unescape(x)).strip() for x in "".join(out).split("\0"))
    return " ".join(b for b in blocks if b)


def _within(node: Node):
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(p for p in reversed(n.parts) if not isinstance(p, str) and not p.cut)


def extracted(df: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Every row's kept columns as ``row``, its main ``text`` and ``n_chars`` (code points). A null or empty page has an empty
    text; repeated rows give repeated results, an empty table an empty one; of equally good subtrees the first counts; page and text are whole,
    however long."""

    def work(pages: pa.Array) -> list:
        texts = [main_text(p) for p in pages.to_pylist()]
        return [texts, [len(t) for t in texts]]

    return with_text_columns(df, html, keep, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], lambda: work)
