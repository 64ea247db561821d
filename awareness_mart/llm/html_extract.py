"""Main text of pages by wrapper induction: what pages of a host share is its template.

Blocks are counted over all pages of a host by the labels above them, without numbers; a
block on more than half of the distinct pages that have such a place is template. Pages
whose containers are nested alike are of one layout. Per layout up to REFERENCES pages are
kept, chosen by hash. Their DOM trees, with runs of equal siblings folded into one, are
aligned by simple tree matching (Yang, 1991); the node below which the varying text of the
aligned nodes lies is the content slot. Every page of the layout is then cut at that slot,
without template text and without the parts that never are an article: menus, headers,
footers, sidebars, notices, adverts, forms, comments. A page whose host tells nothing is
its own reference.
"""

from __future__ import annotations

import html as markup
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import HOT_SHARE

REFERENCES = 6  # pages of a layout of a host whose trees are aligned to find its slot
MOSTLY = 0.8  # share of a node's varying text that makes its child the content slot
HELD = 32 << 20  # characters of candidate pages that a task holds before it hands them on
DEPTH = 200  # deeper elements pass their text on to the one at this depth
LAYOUT = 4  # levels of containers that tell layouts apart
MAIN = 0.98  # a container with more of the slot's text is the article of an altered copy, no notice

# Fixed names: elements that hold no text of a page, that start a block, that may be the
# content slot, and whose text is never part of the article; words of class, id and role.
SILENT = ("script", "style", "noscript", "template", "svg", "iframe", "object", "math")
CONTROLS = ("select", "button", "label", "textarea", "datalist")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr")
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead title tr ul"
).split()
SLOTS = ("html", "body", "div", "section", "main", "article", "td", "table", "tbody", "tr", "center")
NEVER = ("head", "title", "nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset")
NEVER_WORDS = (
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer form header masthead menu modal nav navbar navigation "
    "newsletter notice notification pagination pager popup promo promoted promotion related "
    "replies reply share sharing sidebar social sponsor sponsored subscribe toolbar widget "
    "search contentinfo complementary banner-ad site-header site-footer page-footer main-nav site-nav "
    "nav-menu cookie-banner cookie-notice comment-list share-buttons related-posts social-links"
).split()
ADVERTS = ("ad", "ads", "advert", "adverts", "advertisement", "sponsored")  # as first or last part of a name
# Elements that can be a notice as a whole; a heading, paragraph or item alone is part of the article.
CONTAINERS = (*SLOTS, "ul", "ol", "dl", "figure", "details", "address")
# Block elements that end when another of the kind begins.
ENDS = {"p": BLOCKS, "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "td": ["td", "th", "tr"],
        "th": ["td", "th", "tr"], "tr": ["tr"], "head": ["body"]}

_BLANK = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S | re.I,
)
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in (*SILENT, *CONTROLS)}
_NAME_PARTS = re.compile(r"[-_]+")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Node:
    """A block element: its label, and blocks of text and child nodes in page order."""

    __slots__ = ("label", "tag", "never", "parts")

    def __init__(self, tag: str, names: str = "", in_article: bool = False) -> None:
        self.tag = tag
        self.label = f"{tag} {names.replace('/', '|')}".strip()
        self.never = tag in NEVER or (tag not in ("html", "body") and never_named(names))
        if tag == "header" and in_article:
            self.never = False
        self.parts: list[Node | str] = []

    def children(self) -> list[Node]:
        return [x for x in self.parts if isinstance(x, Node)]

    def text(self, silent: frozenset[int] | set[int] = frozenset()) -> list[str]:
        """Blocks here and below, without parts that never are content and nodes (ids) without voice."""
        out: list[str] = []
        stack = [(id(self) not in silent, iter(self.parts))]
        while stack:
            heard, parts = stack[-1]
            for part in parts:
                if isinstance(part, str):
                    if heard:
                        out.append(part)
                elif not part.never:
                    stack.append((id(part) not in silent, iter(part.parts)))
                    break
            else:
                stack.pop()
        return out


_NEVER = frozenset(NEVER_WORDS)


@lru_cache(20_000)
def never_named(names: str) -> bool:
    """Whether a word of class, id and role says that the element is never part of an article."""
    for name in names.split():
        parts = _NAME_PARTS.split(name)
        if name in _NEVER or parts[0] in ADVERTS or parts[-1] in ADVERTS:
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page's block elements; other elements only pass their text on."""
    root = Node("html")
    open_, pending = [root], []

    def flush() -> None:
        text = _BLANK.sub(" ", markup.unescape("".join(pending))).strip()
        if text:
            open_[-1].parts.append(text)
        pending.clear()

    at, endless = 0, set()
    while token := _TOKEN.search(page, at):
        pending.append(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if tag in _END and not token["end"] and tag not in endless:
            if tag in ("svg", "math") and token["attributes"].rstrip().endswith("/"):
                continue
            end = _END[tag].search(page, at)
            if end or tag in ("script", "style"):
                at = end.end() if end else len(page)
            else:
                endless.add(tag)
            if tag in CONTROLS:
                pending.append(" ")
        if tag == "br":
            pending.append(" ")
        if tag not in _BLOCKS:
            continue
        flush()
        if token["end"]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
            continue
        if open_[-1].tag in ENDS and tag in ENDS[open_[-1].tag]:
            open_.pop()
        if tag == "html":
            continue
        found = _ATTRIBUTE.findall(token["attributes"])
        names = " ".join(v for _, *values in found for v in values if v).lower()
        in_article = tag == "header" and any(x.tag == "article" for x in open_)
        node = Node(tag, " ".join(names.split()), in_article)
        open_[-1].parts.append(node)
        if tag not in VOID and len(open_) < DEPTH:
            open_.append(node)
    pending.append(page[at:])
    flush()
    _keep_article(root)
    return root


def _keep_article(root: Node) -> None:
    """The article or main with most text, and what it lies in, are never excluded."""
    sizes: dict[int, int] = {}
    best, chain = 0, []
    stack = [(root, iter(root.parts))]
    sizes[id(root)] = 0
    while stack:
        node, parts = stack[-1]
        for part in parts:
            if isinstance(part, Node):
                sizes[id(part)] = 0
                stack.append((part, iter(part.parts)))
                break
            sizes[id(node)] += len(part)
        else:
            size = sizes[id(node)]
            if node.tag in ("article", "main") and size > best:
                best, chain = size, [n for n, _ in stack]
            stack.pop()
            if stack and (not node.never or node.tag in ("article", "main")):
                sizes[id(stack[-1][0])] += size
    for node in chain:
        node.never = False


def large(root: Node, template: frozenset[int]) -> list[str]:
    """Paths of never-parts that hold most of the text that is not template, outermost first."""
    nodes = list(nodes_of(root))
    sizes = _varying([(p, n, n) for p, n in nodes], template, everything=True)
    return [p for p, n in nodes if n.never and sizes.get(p, 0) > MOSTLY * sizes.get("", 0)]


def content(root: Node) -> str:
    """Text by which copies are known: that outside never-parts, or all if these hold most."""
    if large(root, frozenset()):
        return "\n".join(own_text([n]) for _, n in nodes_of(root))
    return "\n".join(root.text())


def release(root: Node, paths: list[str]) -> None:
    """Nodes at these paths are looked into from now on."""
    wanted = set(paths)
    stack = [("", [root])] if wanted else []
    while stack:
        path, items = stack.pop()
        if path in wanted:
            for node in items:
                node.never = False
        seen: dict[str, int] = {}
        for label, below in folded(merged(items)):
            n = seen[label] = seen.get(label, -1) + 1
            at = f"{path}/{label}#{n}"
            if any(p == at or p.startswith(f"{at}/") for p in wanted):
                stack.append((at, below))


_BLOCKS = frozenset(BLOCKS)


def folded(node: Node) -> list[tuple[str, list[Node]]]:
    """Children of a node, neighbours of one label as one item."""
    out: list[tuple[str, list[Node]]] = []
    for child in node.children():
        if out and out[-1][0] == child.label:
            out[-1][1].append(child)
        else:
            out.append((child.label, [child]))
    return out


def own_text(nodes: list[Node]) -> str:
    return "\n".join(x for n in nodes for x in n.parts if isinstance(x, str))


def merged(nodes: list[Node]) -> Node:
    """One node with the parts of all, to look below a folded item."""
    if len(nodes) == 1:
        return nodes[0]
    out = Node(nodes[0].tag)
    out.label, out.never = nodes[0].label, nodes[0].never
    out.parts = [x for n in nodes for x in n.parts]
    return out


class Shape:
    """A folded node to align: its items' children in order, a number for its form, its size."""

    __slots__ = ("label", "node", "children", "form", "size")

    def __init__(self, label: str, node: Node, forms: dict[tuple, int]) -> None:
        self.label, self.node = label, node
        self.children = [Shape(below, merged(items), forms) for below, items in folded(node)]
        self.form = forms.setdefault((label, *[c.form for c in self.children]), len(forms))
        self.size = 1 + sum(c.size for c in self.children)


def matching(a: Node, b: Node) -> tuple[int, list[tuple[str, Node, Node]]]:
    """Simple tree matching: the size of the best alignment, and its nodes with their paths in a."""
    forms: dict[tuple, int] = {}
    known: dict[tuple[int, int], int] = {}
    left, right = Shape(a.label, a, forms), Shape(b.label, b, forms)
    found, stack = [], [("", left, right)]
    while stack:
        path, x, y = stack.pop()
        found.append((path, x.node, y.node))
        seen: dict[str, int] = {}
        names = []
        for child in x.children:
            n = seen[child.label] = seen.get(child.label, -1) + 1
            names.append(f"{path}/{child.label}#{n}")
        for i, j in _aligned(x.children, y.children, known)[1]:
            stack.append((names[i], x.children[i], y.children[j]))
    return len(found), found


def _size(x: Shape, y: Shape, known: dict[tuple[int, int], int]) -> int:
    if x.form == y.form:
        return x.size
    key = (x.form, y.form)
    if key not in known:
        known[key] = 1 + _aligned(x.children, y.children, known)[0]
    return known[key]


def _aligned(
    xs: list[Shape], ys: list[Shape], known: dict[tuple[int, int], int]
) -> tuple[int, list[tuple[int, int]]]:
    """The best alignment in order of children of equal labels: its size and pairs.

    Only a band around the diagonal is searched. What leaves it skips more children of the
    shorter side than the band is wide, and has at most the size of the others; the band is
    doubled until that is no better than what was found inside.
    """
    if len(xs) > len(ys):
        size, pairs = _aligned(ys, xs, known)
        return size, [(i, j) for j, i in pairs]
    both = {x.label for x in xs} & {y.label for y in ys}
    left = [(i, x) for i, x in enumerate(xs) if x.label in both]
    right = [(j, y) for j, y in enumerate(ys) if y.label in both]
    turned = len(left) > len(right)
    if turned:
        left, right = right, left
    n, m = len(left), len(right)
    most: dict[str, int] = {}
    for _, y in right:
        most[y.label] = max(most.get(y.label, 0), y.size)
    bounds = sorted(min(x.size, most[x.label]) for _, x in left)
    total, band = sum(bounds), 16
    while True:
        last, moves = [0] * (m + 1), []
        for i in range(1, n + 1):
            x = left[i - 1][1]
            from_, to = max(1, i - band), min(m, i + m - n + band)
            row, move = last[:], bytearray(to - from_ + 1)
            for j in range(from_, to + 1):
                best, how = last[j], 0
                if row[j - 1] > best:
                    best, how = row[j - 1], 1
                if right[j - 1][1].label == x.label:
                    size = last[j - 1] + _size(x, right[j - 1][1], known)
                    if size > best:
                        best, how = size, 2
                row[j], move[j - from_] = best, how
            for j in range(to + 1, min(m, to + 1) + 1):
                row[j] = row[to]
            last = row
            moves.append((from_, move))
        if band >= n or last[m] >= total - sum(bounds[: band + 1]):
            break
        band *= 2
    pairs, i, j = [], n, m
    while i and j:
        from_, move = moves[i - 1]
        how = move[j - from_] if 0 <= j - from_ < len(move) else (1 if j >= from_ else 0)
        if how == 2:
            pairs.append((left[i - 1][0], right[j - 1][0]))
            i, j = i - 1, j - 1
        elif how == 1:
            j -= 1
        else:
            i -= 1
    return last[m], [(i, j) for j, i in pairs] if turned else pairs


def items_of(root: Node) -> Iterator[tuple[str, Node, list[Node]]]:
    """Every folded node of a tree: its path, itself, and the nodes that were folded."""
    stack = [("", [root])]
    while stack:
        path, items = stack.pop()
        node = merged(items)
        yield path, node, items
        seen: dict[str, int] = {}
        below = []
        for label, children in folded(node):
            n = seen[label] = seen.get(label, -1) + 1
            below.append((f"{path}/{label}#{n}", children))
        stack += reversed(below)


def nodes_of(root: Node) -> Iterator[tuple[str, Node]]:
    """Every folded node of a tree with its path."""
    for path, node, _ in items_of(root):
        yield path, node


@lru_cache(20_000)
def place(path: str) -> str:
    """The labels of a path, without the numbers that differ from page to page."""
    out = []
    for label in path.split("/")[1:]:
        tag, blank, names = label.rpartition("#")[0].partition(" ")
        out.append(tag + blank + _DIGITS.sub("0", names))
    return "/".join(out)


def number(text: str) -> int:
    """Signed 64-bit hash that is never 0."""
    return (xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) or 1) - (1 << 63) or 1


def block_key(path: str, own: str) -> int:
    return number(f"{place(path)}\n{own}")


def profile(root: Node) -> list[tuple[int, int]]:
    """The page's places, and its own texts by place, as (place, 0) and (place, block key)."""
    out = set()
    for path, node in nodes_of(root):
        own = own_text([node])
        if own and not path.startswith("/head#"):
            at = number(place(path))
            out |= {(at, 0), (at, block_key(path, own))}
    return sorted(out)


def layout(root: Node) -> int:
    """Which containers lie in which, down to an article or main: pages with the same are alike."""
    found, stack = set(), [("", root, 0)]
    while stack:
        path, node, depth = stack.pop()
        for label, items in folded(node) if depth < LAYOUT else ():
            if items[0].tag in SLOTS and not items[0].never:
                at = f"{path}/{label}#0"
                found.add(place(at))
                if items[0].tag not in ("article", "main"):
                    stack.append((at, merged(items), depth + 1))
    return number("\n".join(sorted(found)))


def slot(root: Node, varying: dict[str, int]) -> str:
    """The path below which most varying text lies; an article or main is gone no deeper."""
    path, node = "", root
    while node.tag not in ("article", "main"):
        total = varying.get(path, 0)
        seen: dict[str, int] = {}
        options = []
        for label, items in folded(node):
            n = seen[label] = seen.get(label, -1) + 1
            child = merged(items)
            if not child.never and child.tag in SLOTS:
                options.append((varying.get(f"{path}/{label}#{n}", 0), f"{path}/{label}#{n}", child))
        if not options:
            break
        size, at, child = max(options, key=lambda o: (o[2].tag in ("article", "main"), o[0]))
        if child.tag not in ("article", "main") and (not size or size < MOSTLY * total):
            break
        path, node = at, child
    return path


def _varying(
    pairs: list[tuple[str, Node, Node]], template: frozenset[int] | set[int], everything: bool = False
) -> dict[str, int]:
    """Characters of the right nodes' text that is not template, per path and all paths above it.

    Text in and below never-parts counts only if everything is asked for.
    """
    out: dict[str, int] = {}
    closed: set[str] = set()
    for path, node, other in pairs:
        above = path.rpartition("/")[0]
        if not everything and (node.never or (path and above in closed)):
            closed.add(path)
            continue
        own = own_text([other])
        size = len(own) if own and block_key(path, own) not in template else 0
        while size:
            out[path] = out.get(path, 0) + size
            if not path:
                break
            path = path.rpartition("/")[0]
    return out


def induce(pages: list[str], blocks: list[int] | None = None) -> dict:
    """The wrapper of pages of one layout: its content slot, template blocks and kept parts.

    blocks are the keys of the host's template blocks; if they aren't known, they are what
    most of the pages share. Pages whose text outside the never-parts is equal are copies and
    count once; all others are evidence, however much they share.
    """
    alike = {content(root): root for root in map(parse, sorted(set(pages), reverse=True))}
    roots = [alike[text] for text in sorted(alike)]
    if not roots:
        return {"slot": "", "blocks": [], "kept": []}
    aligned = [matching(roots[0], other)[1] for other in roots[1:]]
    if blocks is None:
        counts: dict[tuple[str, str], int] = {}
        for pairs in aligned:
            for key in [(p, t) for p, a, b in pairs if (t := own_text([a])) and t == own_text([b])]:
                counts[key] = counts.get(key, 0) + 1
        blocks = [block_key(p, t) for (p, t), n in counts.items() if 2 * n > len(aligned)]
    template = frozenset(blocks)
    kept: dict[str, int] = {}
    for root in roots:
        for path in large(root, template):
            kept[path] = kept.get(path, 0) + 1
    always = sorted(path for path, n in kept.items() if 2 * n > len(roots))
    release(roots[0], always)
    pivot = dict(nodes_of(roots[0]))
    varying: dict[str, int] = {}
    for pairs in ([(p, n, n) for p, n in pivot.items()], *aligned):
        for path, size in _varying([(p, pivot[p], b) for p, _, b in pairs], template).items():
            varying[path] = varying.get(path, 0) + size
    return {"slot": slot(roots[0], varying), "blocks": sorted(template), "kept": always}


def notices(
    nodes: dict[str, tuple[Node, list[Node]]], at: str, template: frozenset[int]
) -> set[int]:
    """Ids of the nodes in and below containers in the slot (path at) that are template as a whole.

    A block that recurs among others that vary is part of the article: only containers fall
    silent, and none that holds most of the slot's text.
    """
    below = [p for p in nodes if p == at or p.startswith(f"{at}/")]
    size: dict[str, int] = {}
    varying: set[str] = set()
    closed: set[str] = set()
    for path in below:
        node = nodes[path][0]
        above = path.rpartition("/")[0]
        if path != at and (node.never or above in closed):
            closed.add(path)
            continue
        own = own_text([node])
        fresh = bool(own) and block_key(path, own) not in template
        while own:
            size[path] = size.get(path, 0) + len(own)
            if fresh:
                varying.add(path)
            if path == at:
                break
            path = path.rpartition("/")[0]
    silent: set[int] = set()
    dropped: set[str] = set()
    for path in below:
        node, items = nodes[path]
        inside = path != at and path.rpartition("/")[0] in dropped
        whole = path in size and path not in varying and node.tag in CONTAINERS and path != at
        if inside or (whole and size[path] <= MAIN * size[at]):
            dropped.add(path)
            silent.update(id(x) for x in (node, *items))
    return silent


def extract(page: str | None, wrapper: dict | None, root: Node | None = None) -> str:
    """Blocks of the page's content slot, without notices, joined by an empty line."""
    root = root or parse(page or "")
    template = frozenset(wrapper["blocks"]) if wrapper else frozenset()
    release(root, wrapper["kept"] if wrapper else large(root, template))
    nodes = {path: (node, items) for path, node, items in items_of(root)}
    at = wrapper["slot"] if wrapper and wrapper["slot"] in nodes else None
    if at is None:
        at = slot(root, _varying([(p, n, n) for p, (n, _) in nodes.items()], template))
    silent = notices(nodes, at, template) if template else frozenset()
    return "\n\n".join(nodes[at][0].text(silent))


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wrappers = [
            json.dumps(induce(pages, blocks or []))
            for pages, blocks in zip(batch["pages"].to_pylist(), batch["blocks"].to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["host"], batch["layout"], pa.array(wrappers, pa.string())],
            names=["host", "layout", "wrapper"],
        )


def _read(raw: str | None) -> dict | None:
    wrapper = json.loads(raw) if raw else None
    return wrapper and wrapper | {"blocks": frozenset(wrapper["blocks"])}


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str | None, dict | None] = {}
    for batch in batches:
        texts = []
        for page, raw in zip(batch["html"], batch["wrapper"].to_pylist(), strict=True):
            if raw not in known:
                if len(known) > 1000:
                    known.clear()
                known[raw] = _read(raw)
            texts.append(extract(page.as_py(), known[raw]))
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def _extract_known(shared):
    """Texts of pages whose (host, layout) has a wrapper in shared; others with their layout."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {key: _read(raw) for key, raw in shared.value.items()}
        for batch in batches:
            texts, layouts = [], []
            for page, host in zip(batch["html"].to_pylist(), batch["host"].to_pylist(), strict=True):
                root = parse(page or "")
                at = layout(root) if page is not None and host is not None else None
                unread = at is not None and (host, at) not in known
                layouts.append(at if unread else None)
                texts.append(None if unread else extract(page, known.get((host, at)), root))
            unread = pa.array([t is None for t in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pc.if_else(unread, batch["html"], None),
                    batch["host"],
                    pa.array(layouts, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                names=["page_id", "url", "html", "host", "layout", "text"],
            )

    return run


_PROFILE = (
    "host string, layout bigint, content bigint, places array<bigint>, blocks array<bigint>, "
    "h bigint, html string"
)


def _references(best: dict[tuple, tuple[int, str]]) -> pa.RecordBatch:
    """The pages of a task that may be references, as rows without content."""
    none = pa.nulls(len(best), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([host for host, _, _ in best], pa.string()),
            pa.array([at for _, at, _ in best], pa.int64()),
            pa.nulls(len(best), pa.int64()),
            none,
            none,
            pa.array([h for h, _ in best.values()], pa.int64()),
            pa.array([page for _, page in best.values()], pa.string()),
        ],
        names=[field.split()[0] for field in _PROFILE.split(", ")],
    )


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Layout, content, places and blocks of each page, from one parse of it.

    Beside them come each task's candidates for the references of a layout: per remainder
    of the page's hash that with the least.
    """
    best: dict[tuple, tuple[int, str]] = {}
    held = 0
    numbers = pa.list_(pa.int64())
    for batch in batches:
        hosts = batch["host"].to_pylist()
        layouts, texts, places, blocks = [], [], [], []
        for host, page in zip(hosts, batch["html"].to_pylist(), strict=True):
            root = parse(page)
            layouts.append(at := layout(root))
            texts.append(number(content(root)))
            found = profile(root)
            places.append([at for at, _ in found])
            blocks.append([block for _, block in found])
            h = number(page)
            key = (host, at, h % REFERENCES)
            if key not in best or h < best[key][0]:
                held += len(page) - len(best[key][1] if key in best else "")
                best[key] = (h, page)
        nothing = pa.nulls(len(hosts), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch["host"],
                pa.array(layouts, pa.int64()),
                pa.array(texts, pa.int64()),
                pa.array(places, numbers),
                pa.array(blocks, numbers),
                nothing,
                pa.nulls(len(hosts), pa.string()),
            ],
            names=[field.split()[0] for field in _PROFILE.split(", ")],
        )
        if held > HELD:
            yield _references(best)
            best, held = {}, 0
    if best:
        yield _references(best)


def host_of(url: str = "url"):
    """Host of a URL in lower case, without user and port; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def template_blocks(profiles: DataFrame) -> DataFrame:
    """(host, blocks): keys of blocks on more than half of a host's distinct pages with their place.

    Counted over all pages; pages of equal content count once. Places and blocks are summed
    per task first, and a host has at most two template blocks a place of a page.
    """
    single = (
        profiles.where("content is not null")
        .groupBy("host", "content")
        .agg(F.min(F.struct("places", "blocks")).alias("p"))
    )
    pairs = single.select("host", F.explode(F.arrays_zip("p.places", "p.blocks")).alias("x")).select(
        "host", F.col("x.places").alias("place"), F.col("x.blocks").alias("block")
    )
    counts = written(
        pairs.groupBy("host", "place", "block").agg(F.count("*").alias("k")).where("k > 1"), "blocks"
    )
    places = counts.where("block = 0").select("host", "place", F.col("k").alias("n"))
    often = counts.where("block <> 0").join(places, ["host", "place"]).where("2 * k > n")
    return often.groupBy("host").agg(F.sort_array(F.collect_set("block")).alias("blocks"))


def wrappers(profiles: DataFrame) -> DataFrame:
    """(host, layout, n_pages, wrapper) from the profiles of all pages.

    Template blocks come from all pages of the host, the slot from at most REFERENCES pages
    of the layout: per remainder that with the least hash, summed per task first, so that a
    host with a third of all pages is no burden.
    """
    best = (
        profiles.where("content is null")
        .groupBy("host", "layout", F.pmod("h", F.lit(REFERENCES)).alias("k"))
        .agg(F.min_by("html", "h").alias("html"))
    )
    pages = best.groupBy("host", "layout").agg(F.collect_list("html").alias("pages"))
    found = pages.join(template_blocks(profiles), "host", "left").select(
        "host", "layout", "pages", "blocks"
    ).mapInArrow(_induce, "host string, layout bigint, wrapper string")
    sizes = profiles.where("content is not null").groupBy("host", "layout").agg(
        F.count("*").alias("n_pages")
    )
    return found.join(sizes, ["host", "layout"])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of pages (page_id, url, html).

    Null, empty and textless pages give an empty text. Pages without host, and hosts with
    one page or copies of one, are read by the page's own structure. Rows that repeat are
    read each time; ids may be null; other columns are not read.

    A page is parsed twice: once for its profile and once for its text. The wrappers of
    layouts with a thousandth of all pages, so of a thousand at most, are sent to all tasks,
    which leaves their pages where they are; pages of rarer layouts are written aside, joined
    with their wrappers by key and parsed once more.
    """
    id_ = f"page_id {dict(pages.dtypes)['page_id']}"
    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    told = rows.where("host is not null and html is not null").select("host", "html")
    profiles = written(told.mapInArrow(_profile, _PROFILE), "profiles")
    known = written(wrappers(profiles), "wrappers")
    total = known.agg(F.sum("n_pages")).first()[0] or 0
    common = known.where(F.col("n_pages") * HOT_SHARE >= F.lit(total)).collect()
    context = pages.sparkSession.sparkContext
    shared = context.broadcast({(r["host"], r["layout"]): r["wrapper"] for r in common})
    read = written(
        rows.mapInArrow(
            _extract_known(shared),
            f"{id_}, url string, html string, host string, layout bigint, text string",
        ),
        "texts",
    )
    rare = read.where("text is null").select("page_id", "url", "html", "host", "layout")
    others = rare.join(known, ["host", "layout"], "left").select("page_id", "url", "html", "wrapper")
    texts = read.where("text is not null").select("page_id", "url", "text").unionByName(
        others.mapInArrow(_extract, f"{id_}, url string, text string")
    )
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
