"""Main text of web pages by composite text density.

Every page becomes a tree of elements. An element's density is its characters per tag,
lowered by the share of characters and tags that lie in links. An element's sum is that
of its children's densities; the subtree with the highest sum is the article's core. The
lowest density on its path up to the body is the threshold that the core's neighbours
along this path must reach to belong to the text too. Texts beside block elements count
as blocks. Menus, headers, footers, asides, forms, adverts, comments, scripts and styles are
cut out before; names that can as well belong to the article's own parts (header, notice)
cut only outside the core.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video map head title nav aside footer "
    "form button select textarea input fieldset dialog menu noembed noframes".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: What an opening element ends, up to the element that bounds it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: Words of class, id and role names that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notification notifications modal popup overlay newsletter "
    "subscribe subscription signup comment comments commentlist disqus respond replies sidebar sidebars widget widgets "
    "menu menus nav navbar navigation navigationbar breadcrumb breadcrumbs pagination pager toolbar footer masthead "
    "social sharing recommended recommendations login toc skip complementary contentinfo".split()
)
#: Names that mark it only as a whole, and only outside the core.
DOUBTFUL = frozenset("hidden header search notice notices related alert alerts share".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: What may stand in a head; anything else ends it.
HEAD = frozenset("base link meta title style script noscript template noframes head".split())
#: What runs on with the texts beside it.
RUNS_ON = INLINE | frozenset("br img script style noscript template".split())
KEPT = frozenset("html body main article".split())
BODY_END = re.compile(r"[-_\s]+|(?<=[a-z])(?=[A-Z])")
TAG = re.compile(
    r"<!--(?:>|->|[\s\S]*?(?:--!?>|\Z))|<(?:!\[CDATA\[[\s\S]*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z))"
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>][^\s>]*)))?")


class Node:
    """An element: its children are nodes and texts, in page order."""

    __slots__ = (
        "name", "children", "parent", "cut", "doubt", "chars", "tags", "link_chars", "link_tags", "density", "total", "kept"
    )

    def __init__(self, name: str, parent: Node | None, cut: bool, doubt: bool = False):
        self.name, self.parent, self.cut, self.doubt, self.children = name, parent, cut or doubt, doubt and not cut, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.kept = name in ("article", "main")


class _Open:
    """The open elements, outermost first, and the depths at which each name is open.

    All questions about names take constant time (and the logarithm of the depth), so that
    a page of elements that are never closed takes no more time than any other.
    """

    def __init__(self, root: Node):
        self.nodes = [root]
        self.depths: dict[str, list[int]] = {}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.name, []).append(len(self.nodes))
        self.nodes.append(node)

    def end(self, depth: int) -> None:
        """Ends the element at a depth and all within."""
        for node in self.nodes[depth:]:
            self.depths[node.name].pop()
        del self.nodes[depth:]

    def innermost(self, names: Iterable[str]) -> int:
        """The greatest depth at which one of these names is open, 0 if none is."""
        return max((self.depths[x][-1] for x in names if self.depths.get(x)), default=0)

    def outermost(self, names: Iterable[str], above: int) -> int:
        """The least depth beyond ``above`` at which one of these names is open, 0 if none is."""
        found = 0
        for name in names:
            depths = self.depths.get(name, ())
            at = bisect.bisect_right(depths, above)
            if at < len(depths):
                found = min(found or depths[at], depths[at])
        return found


def _attributes(text: str) -> dict[str, str]:
    """Names, in lower case, and values of a tag's attributes; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _is_cut(name: str, text: str, stack: _Open) -> tuple[bool, bool]:
    """Whether an element is cut, and whether it is unless it lies in the core."""
    if name in DROPPED:
        return True, False
    if name == "header":
        return not stack.innermost(("article", "main")), False
    if not text or name in KEPT:
        return False, False
    found = _attributes(text)
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true":
        return True, False
    for declared in found.get("style", "").lower().split(";"):
        key, _, value = (x.strip() for x in declared.removesuffix("!important").partition(":"))
        if (key, value.removesuffix("!important").strip()) in (("display", "none"), ("visibility", "hidden")):
            return True, False
    doubt = False
    for key in ("class", "id", "role"):
        value = found.get(key, "")
        words = {x.lower() for x in BODY_END.split(value) if x}
        if words & MARKS and not words & {"has", "with", "no", "without"}:
            return True, False
        doubt = doubt or bool(DOUBTFUL & set(value.lower().split()))
    return False, doubt


def parse(page: str) -> Node:
    """The tree of a page. Unclosed elements end with what bounds them, stray ends are passed over."""
    root = Node("html", None, False)
    stack, at, size = _Open(root), 0, len(page)
    while at < size:
        found = TAG.search(page, at)
        if found is None:
            _add_text(stack, page[at:])
            break
        if found.start() > at:
            _add_text(stack, page[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            if found.group().startswith("<![CDATA["):
                _add_text(stack, html.escape(found.group()[9:].removesuffix("]]>"), quote=False))
            continue
        name = name.lower()
        if found.group(1):
            depth = stack.innermost((name,))
            if depth and not (name in INLINE and stack.innermost(("td", "th", "table")) > depth):
                stack.end(depth)
            continue
        if name == "html" or (name == "body" and stack.innermost(("body",))):
            continue
        if name == "body":
            stack.end(1)
        if stack.top.name == "head" and name not in HEAD:
            stack.end(len(stack.nodes) - 1)
        if name in CLOSES_P:
            _close(stack, {"p"}, {"table", "td", "th", "button", "body"})
        if name in ENDS:
            _close(stack, *ENDS[name])
        node = Node(name, stack.top, *_is_cut(name, found.group(3), stack))
        stack.top.children.append(node)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if not found.group(3).endswith("/") or name not in ("svg", "math"):
            stack.push(node)
    return root


def _add_text(stack: _Open, text: str) -> None:
    """Puts a text into the innermost element; a head ends before it."""
    if stack.top.name == "head" and text.strip():
        stack.end(len(stack.nodes) - 1)
    stack.top.children.append(text)


def _close(stack: _Open, names: set[str], bounds: set[str]) -> None:
    """Ends the innermost element of a name, or the outermost of several names, and all within, up to ``bounds``."""
    bound = stack.innermost(bounds)
    found = stack.outermost(names, bound) if len(names) > 1 else stack.innermost(names)
    if found > bound:
        stack.end(found)


def _ordered(root: Node) -> list[Node]:
    """Elements that are not cut, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.children) if isinstance(x, Node) and not x.cut]
    return out


def _keep_holders(root: Node) -> None:
    """An element that holds an article is never cut by its class alone."""
    todo = [root]
    seen: list[Node] = []
    while todo:
        node = todo.pop()
        seen.append(node)
        todo += [x for x in node.children if isinstance(x, Node)]
    for node in reversed(seen):
        if node.kept and node.parent is not None:
            node.parent.kept = True
        if node.kept and node.name not in DROPPED:
            node.cut = False


def _wrap_texts(root: Node) -> None:
    """Texts beside block elements become blocks of their own, with the inline elements between them."""
    for node in _ordered(root):
        loose = any(isinstance(x, str) and x.strip() for x in node.children)
        if not loose or all(isinstance(x, str) or x.name in RUNS_ON for x in node.children):
            continue
        children: list[Node | str] = []
        run: Node | None = None
        for child in node.children:
            if isinstance(child, Node) and child.name not in RUNS_ON:
                run = None
                children.append(child)
                continue
            if run is None:
                run = Node("#text", node, False)
                children.append(run)
            run.children.append(child)
            if isinstance(child, Node):
                child.parent = run
        node.children = children


def _restore(root: Node) -> bool:
    """Takes back all doubtful cuts within an element; whether there were any."""
    todo, any_ = [root], False
    while todo:
        for child in todo.pop().children:
            if isinstance(child, Node):
                any_ = any_ or child.doubt
                child.cut, child.doubt = child.cut and not child.doubt, False
                if not child.cut:
                    todo.append(child)
    return any_


def measure(nodes: list[Node], body: Node) -> None:
    """Counts of characters and tags, densities and sums of densities of all elements."""
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        link = node.name == "a"
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.cut:
                node.chars += child.chars
                node.tags += child.tags + (child.name != "#text")
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.name == "a")
        if link:
            node.link_chars = node.chars
    body_share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, t = max(node.chars, 1), max(node.tags, 1)
        lc, lt = node.link_chars, max(node.link_tags, 1)
        plain = max(node.chars - lc, 1)
        base = math.log(c / plain * lc + body_share * c + math.e)
        node.density = c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0)) / math.log(base + 1) if node.chars else 0.0
    for node in nodes:
        node.total = sum(x.density for x in node.children if isinstance(x, Node) and not x.cut)
        own = sum(len(x.strip()) for x in node.children if isinstance(x, str))
        node.total += own / max(node.tags, 1)


def _headings(root: Node) -> list[Node]:
    """The outermost headings within an element, itself included."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.name in HEADINGS:
            found.append(node)
        else:
            todo += [x for x in node.children if isinstance(x, Node) and not x.cut]
    return found


def chosen(root: Node) -> list[Node]:
    """The elements whose texts are the page's main text, in page order."""
    _wrap_texts(root)
    nodes = _ordered(root)
    body = next((x for x in nodes if x.name == "body"), root)
    measure(nodes, body)
    if not body.chars and _restore(root):
        return chosen(root)
    inside = [x for x in nodes if x.chars and x.name not in INLINE] or [body]
    best = max(inside, key=lambda x: x.total)
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    holders = [x for x in path if x.name == "article"] or [x for x in path if x.name == "main"]
    _restore(holders[-1] if holders else best)
    if holders:
        return [holders[-1]]
    taken = {id(best)}
    for inner, outer in zip(path, path[1:], strict=False):
        for child in outer.children:
            if child is inner or isinstance(child, str) or child.cut or not child.chars:
                continue
            heading = 2 * sum(x.chars for x in _headings(child)) >= child.chars
            linked = child.link_chars > 0.3 * child.chars
            if not linked and (child.density >= threshold or heading):
                taken.add(id(child))
    return [x for x in nodes if id(x) in taken]


def texts(node: Node) -> Iterator[str]:
    """Blocks of an element: text between borders of block elements, white space as one blank."""
    held: list[str] = []
    todo: list = [(node, False)]
    while todo:
        item, after = todo.pop()
        if isinstance(item, str):
            held.append(item)
            continue
        if item.cut:
            held.append(" ")
            continue
        if item.name == "br":
            held.append(" ")
            continue
        block = item.name not in INLINE
        if block and held:
            yield " ".join(html.unescape("".join(held)).split())
            held = []
        if not after:
            todo.append((item, True)) if block else None
            todo += [(x, False) for x in reversed(item.children)]
    if held:
        yield " ".join(html.unescape("".join(held)).split())


def main_text(page: str | None) -> str:
    """The main text: blocks in page order, joined by two line breaks; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _keep_holders(root)
    return "\n\n".join(block for node in chosen(root) for block in texts(node) if block)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id long, url string, html string).

    Whole pages are read. A null or empty page, or one without text, has the empty text;
    null ids and urls stay null; repeated rows are extracted alike; other columns are
    ignored; an empty table gives no rows. Pages are trees without limits of depth.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
