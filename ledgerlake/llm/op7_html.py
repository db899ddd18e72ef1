"""HTML extraction by wrapper induction: pages of a host are aligned with one of them by simple tree matching.

A page becomes a tree of block elements, every leaf a node of its own. Each page's tree is matched with the host's
reference page (the largest number of nodes paired in order, tag by tag; of equally large ones that with most equal
texts), and Spark counts for every reference node how many of the host's different pages pair with it and hold the same
text. Nodes that hold the same text on nearly all of them are the host's template; the others are slots. Content is
what stands in slots, inside the article (or the main part, or the body, whichever has text), and not in an element of
another role: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.

Roles come from element names, the ``hidden`` attributes and from class and id tokens; a token that denies or only
mentions a role (``no-sidebar``, ``with-sidebar``) names none, and html, body, article and main never take one from
tokens. Where no article is left, elements with role tokens that hold one are opened.

Trees hold tags and 32-bit text marks only, so the rows that meet by host are narrow; the html itself is joined with
its host's template once, and a host with very many pages is the skewed side of that join. The template of a host is
bounded by the nodes of one page. Nothing recurses into a tree, so nesting is bounded by memory alone. Equal beginnings
and ends of two child lists pair at once. What lies between is aligned by the best sum, however long the lists are: above
``CELLS`` pairs of children the same sums are made of one child and all children of the other page at a time, and rows of
the table are made again instead of kept, so that time grows with the product of both lists but memory with their length.

Defined cases: a null or empty html gives an empty text; a null url has the empty host; hosts with fewer than ``PAGES``
different pages have no template; where the template would take all, or more than half of an article, the page is a
copy rather than a filled form and keeps its blocks; equal rows get equal texts; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import read, written
from ledgerlake.llm.op3_url_filter import host_of

PAGES, SHARE = 5, 0.9
#: Pairs of children that are weighed one by one; more are weighed in rows, with the same result.
CELLS = 40_000
#: Numbers kept at once of a table that is made in rows.
KEPT = 4_000_000

# Element names and the words by which pages name roles.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("aside button dialog footer form head iframe input menu nav noscript object option select svg template textarea".split())
RAW = frozenset("script style title textarea noscript template iframe xmp".split())
ROLE_WORDS = frozenset("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent cookie cookies "
                       "disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices notification popup promo related reply replies respond "
                       "search share sharing sidebar signup social sponsor sponsored subscribe widget contentinfo alert reviews review discussion".split())
HEADS = frozenset("banner header masthead".split())
# Elements that end when another of the listed ones begins beside them.
ENDED_BY = {"p": BLOCKS - {"body", "html"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "tbody"}),
            "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"})}
BARRIERS = {"li": frozenset({"ul", "ol", "menu"}), "td": frozenset({"table"}), "th": frozenset({"table"}), "tr": frozenset({"table"}),
            "dt": frozenset({"dl"}), "dd": frozenset({"dl"}), "p": frozenset(), "option": frozenset({"select"})}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
# Words by which a token denies a role or tells that something else has it.
DENIALS = frozenset("no not non without with has have is open closed enabled disabled".split())
WHOLE = frozenset("html body article main".split())


class Block:
    """A block element: its own text pieces (outside child blocks) become blocks of text at its position.

    ``own`` is "skip" for an element that is none of the article by its name or because it is hidden, "word" if its
    class or id tokens say so; ``skip`` is what follows from that and from the elements around it.
    """

    __slots__ = ("tag", "kind", "own", "parent", "items", "node", "holds", "skip")

    def __init__(self, tag: str, kind: str, own: str, parent: "Block | None"):
        self.tag, self.kind, self.own, self.parent = tag, kind, own, parent
        self.items: list = []  # strings of text, or child blocks
        self.node, self.holds, self.skip = -1, False, False


def _role(tag: str, attributes: str, inside: bool) -> tuple[str, str]:
    """(kind for matching, "skip" or "word" if the element is none of the article)."""
    named, words, hidden = [], set(), False
    if attributes and not attributes.isspace():
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), values[0] or values[1] or values[2]
            if name in ("class", "id", "role"):
                named.append(value)
                for token in value.lower().split():
                    parts = set(re.split(r"[_-]+", token))
                    if not parts & DENIALS:
                        words |= parts
            elif name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden = hidden or value.strip().lower() == "true"
            elif name == "style":
                hidden = hidden or bool(_NO_DISPLAY.search(value))
    kind = f"{tag}.{'.'.join(named)}" if named else tag
    if hidden or (tag in SKIPPED) or (tag == "header" and not inside):
        return kind, "skip"
    if tag not in WHOLE and (words & (ROLE_WORDS - HEADS) or (words & HEADS and not inside)):
        return kind, "word"
    return kind, ""


def parse(source: str) -> Block:
    """The tree of block elements; inline elements leave only their text, skipped ones are kept as blocks with a role."""
    root = Block("html", "html", "", None)
    here, at, inside, links = root, 0, 0, 0
    pieces: list[str] = []

    def text(raw: str) -> None:
        if raw:
            pieces.append(raw)

    def end_block() -> None:
        if pieces:
            whole = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if whole:
                here.items.append(whole)

    def close(to: Block) -> None:
        nonlocal here, inside
        end_block()
        while here is not to:
            inside -= here.tag in ("article", "main")
            here = here.parent
        inside -= here.tag in ("article", "main")
        here = here.parent or root

    while True:
        token = _TOKEN.search(source, at)
        if token is None:
            text(source[at:])
            break
        text(source[at:token.start()])
        at = token.end()
        tag = (token.group(2) or token.group(5) or "").lower()
        if not tag:
            continue
        closing = bool(token.group(1) or token.group(4))
        attributes = token.group(3) or token.group(6) or ""
        if closing:
            if tag in BLOCKS or tag in SKIPPED:
                end = here
                while end is not root and end.tag != tag:
                    end = end.parent
                if end is not root:
                    close(end)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else len(source)
            if tag not in BLOCKS:
                text(" ") if tag in ("textarea", "iframe") else None
            continue
        if tag == "br" or tag in ("td", "th"):
            text(" ")
        if tag not in BLOCKS and tag not in SKIPPED:
            if tag == "body":
                end_block()
            continue
        if tag == "html":
            continue
        for open_tag, ended in ENDED_BY.items():
            if tag in ended:
                end = here
                while end is not root and end.tag != open_tag and end.tag not in BARRIERS[open_tag] and (open_tag != "p" or end.tag == "p"):
                    end = end.parent
                if end is not root and end.tag == open_tag:
                    close(end)
        if tag == "body" and here is not root:
            close(_child_of_root(here))
        end_block()
        kind, role = _role(tag, attributes, inside > 0)
        if tag in VOID:
            continue
        block = Block(tag, kind, role, here)
        here.items.append(block)
        here = block
        inside += tag in ("article", "main")
    end_block()
    return root


def _child_of_root(block: Block) -> Block:
    while block.parent is not None and block.parent.parent is not None:
        block = block.parent
    return block


def preorder(root: Block) -> list[Block]:
    out, stack = [], [root]
    while stack:
        block = stack.pop()
        out.append(block)
        stack += [x for x in reversed(block.items) if isinstance(x, Block)]
    return out


def tree(root: Block) -> dict:
    """Kinds, text marks and parents of all blocks in order; numbers every block."""
    blocks = preorder(root)
    marks = []
    for number, block in enumerate(blocks):
        block.node, mark = number, 0
        for x in block.items:
            if isinstance(x, str):
                mark = zlib.crc32(x.encode("utf-8", "replace"), mark)
        marks.append(mark)
    return {"k": [b.kind for b in blocks], "m": marks, "p": [-1 if b is root else b.parent.node for b in blocks]}


class _Tree:
    """A tree's nodes in order, with children, sizes and a number that equal subtrees (texts included) share."""

    def __init__(self, flat: dict, same: dict):
        self.kinds, self.marks, self.parents = flat["k"], flat["m"], flat["p"]
        n = len(self.kinds)
        self.children: list[list[int]] = [[] for _ in range(n)]
        for node, parent in enumerate(flat["p"]):
            if parent >= 0:
                self.children[parent].append(node)
        self.sizes, self.equal = [1] * n, [0] * n
        for node in range(n - 1, -1, -1):
            inner = self.children[node]
            self.sizes[node] += sum(self.sizes[c] for c in inner)
            key = (self.kinds[node], self.marks[node], tuple(self.equal[c] for c in inner))
            self.equal[node] = same.setdefault(key, len(same))
        self.depth = [0] * n
        for node in range(1, n):
            self.depth[node] = self.depth[self.parents[node]] + 1
        self.told: list[int] = []
        self.alike: list[int] = []

    def compare(self, other: "_Tree", other_text: int) -> None:
        """Marks and numbers of subtrees where texts that the other tree doesn't hold are all one text."""
        if not self.told:
            shared, numbers = set(other.marks), {}
            self.told = [m if m in shared else other_text for m in self.marks]
            self.alike = [0] * len(self.kinds)
            for node in range(len(self.kinds) - 1, -1, -1):
                key = (self.kinds[node], self.told[node], tuple(self.alike[c] for c in self.children[node]))
                self.alike[node] = numbers.setdefault(key, len(numbers))


def _flat(node: list) -> dict:
    """A nested [kind, mark, children] list as :func:`tree` gives it."""
    kinds, marks, parents, stack = [], [], [], [(node, -1)]
    while stack:
        (kind, mark, inner), parent = stack.pop()
        stack += [(c, len(kinds)) for c in reversed(inner)]
        kinds.append(kind)
        marks.append(mark)
        parents.append(parent)
    return {"k": kinds, "m": marks, "p": parents}


def _middle(a: _Tree, b: _Tree, x: int, y: int) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """Equal children at both ends, and the children between them."""
    first, second, ends = a.children[x], b.children[y], []
    low, top = 0, min(len(first), len(second))
    while low < top and a.equal[first[low]] == b.equal[second[low]]:
        ends.append((first[low], second[low]))
        low += 1
    i, j = len(first), len(second)
    while i > low and j > low and a.equal[first[i - 1]] == b.equal[second[j - 1]]:
        i, j = i - 1, j - 1
        ends.append((first[i], second[j]))
    return ends, first[low:i], second[low:j]


class _Level:
    """Different subtrees at one depth below a list of children: tags, texts and where the children of each lie."""

    def __init__(self, kinds: list[int], marks: list[int], inner: list[list[int]], most: int):
        self.kinds, self.marks = np.array(kinds, np.int64), np.array(marks, np.int64)
        counts = np.array([len(i) for i in inner], np.int64)
        # One place for every child and one behind the last, whose sum is 0.
        ends = np.cumsum(counts + 1)
        self.starts, self.places = ends - counts - 1, int(ends[-1])
        self.real = np.setdiff1d(np.arange(self.places), ends - 1)
        self.child = np.array([c for i in inner for c in i], np.int64)
        # Sums are told apart by subtree while their running maximum goes from the last place to the first.
        self.apart = np.repeat(np.arange(len(counts) - 1, -1, -1, dtype=np.int64) * most, counts + 1)

    def step(self, sums: np.ndarray | None, gains: np.ndarray) -> np.ndarray:
        """Best sums of the children from each place on, with one more child of the other tree before those summed."""
        if sums is None:
            sums = np.zeros(self.places, np.int64)
        new = sums + self.apart
        new[self.real] = np.maximum(new[self.real], new[self.real + 1] + gains[self.child])
        return np.maximum.accumulate(new[::-1])[::-1] - self.apart


class _Rows:
    """The table of best sums of two long child lists, made row by row."""

    def __init__(self, a: _Tree, b: _Tree, first: list[int], second: list[int], unit: int):
        self.a, self.first, self.unit = a, first, unit
        most = (max(a.sizes[p] for p in first) + 1) * (unit + 1)
        codes: dict[str, int] = {}
        self.kinds = [codes.setdefault(k, len(codes)) for k in a.kinds]
        self.levels: list[_Level] = []
        deepest = max(a.depth[n] - a.depth[p] for p in first for n in range(p, p + a.sizes[p]))
        number = {c: i for i, c in enumerate(dict.fromkeys(b.alike[q] for q in second))}
        self.column = np.array([number[b.alike[q]] for q in second])
        nodes = {b.alike[q]: q for q in second}
        while number and len(self.levels) <= deepest:
            here = [nodes[c] for c in number]
            below = {b.alike[c]: c for n in here for c in b.children[n]} if len(self.levels) < deepest else {}
            inside = {c: i for i, c in enumerate(below)}
            inner = [[inside[b.alike[c]] for c in b.children[n]] if inside else [] for n in here]
            self.levels.append(_Level([codes.get(b.kinds[n], -1) for n in here], [b.told[n] for n in here], inner, most))
            number, nodes = inside, below
        self.known: dict[tuple[int, int], np.ndarray] = {}
        self.room = KEPT

    def _remember(self, key: tuple[int, int], gains: np.ndarray) -> None:
        if self.room >= len(gains):
            self.room -= len(gains)
            self.known[key] = gains

    def weigh(self, p: int) -> np.ndarray:
        """What pairing ``p`` with each different subtree of the other list is worth."""
        a, sums = self.a, {}
        gains = self.known.get((0, a.alike[p]))
        if gains is not None:
            return gains
        for node in range(p + a.sizes[p] - 1, p - 1, -1):
            depth = a.depth[node] - a.depth[p]
            if depth >= len(self.levels):
                continue
            level, inner = self.levels[depth], sums.pop(node, None)
            key = (depth, a.alike[node])
            gains = self.known.get(key)
            if gains is None:
                gains = self.unit + (level.marks == a.told[node])
                if inner is not None:
                    gains = gains + inner[level.starts]
                gains = np.where(level.kinds == self.kinds[node], gains, 0)
                if node == p or not a.children[node]:
                    self._remember(key, gains)
            if node != p:
                parent = a.parents[node]
                sums[parent] = self.levels[depth - 1].step(sums.get(parent), gains)
        return gains

    def _table(self, low: int, high: int, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows low to high - 1 of the table, with their gains, from the row behind them; few are kept at once."""
        step = -(-(high - low) // max(2, KEPT // len(last)))
        kept, row = [], last
        for i in range(high - 1, low - 1, -1):
            gains = self.weigh(self.first[i])[self.column]
            new = np.zeros_like(row)
            new[:-1] = np.maximum.accumulate(np.maximum(row[:-1], row[1:] + gains)[::-1])[::-1]
            row = new
            if (i - low) % step == 0:
                kept.append((row, gains) if step == 1 else row)
        if step == 1:
            while kept:
                yield kept.pop()
            return
        kept.pop()
        for start in range(low, high, step):
            yield from self._table(start, min(start + step, high), kept[-1] if kept else last)
            if kept:
                kept.pop()

    def best(self) -> tuple[int, list[tuple[int, int]]]:
        """The best sum, and the places in both lists that pair for it."""
        many = len(self.column)
        rows = self._table(0, len(self.first), np.zeros(many + 1, np.int64))
        row, gains = next(rows)
        total, out, j = int(row[0]), [], 0
        for i in range(len(self.first)):
            below, following = next(rows, (np.zeros(many + 1, np.int64), None))
            while j < many:
                if gains[j] and row[j] == below[j + 1] + gains[j]:
                    out.append((i, j))
                    j += 1
                    break
                if row[j] == below[j]:
                    break
                j += 1
            row, gains = below, following
        return total, out


def match(one: dict | list, two: dict | list) -> list[tuple[int, int]]:
    """Simple tree matching: the largest set of paired nodes that keeps tags, order and parents; numbers in order.

    Trees come from ``tree()``, or as nested lists; a pair's numbers count each tree's nodes from 0, parents first.
    """
    same: dict = {}
    a, b = (_Tree(t if isinstance(t, dict) else _flat(t), same) for t in (one, two))
    if a.kinds[0] != b.kinds[0]:
        return []
    # Paired nodes count before equal texts.
    unit = min(len(a.kinds), len(b.kinds)) + 1
    worth: dict[tuple[int, int], int] = {}
    plans: dict[tuple[int, int], tuple] = {}

    def gain(p: int, q: int) -> int:
        if a.equal[p] == b.equal[q]:
            return a.sizes[p] * (unit + 1)
        if a.kinds[p] != b.kinds[q]:
            return 0
        if a.children[p] and b.children[q]:
            return worth[p, q]
        return unit + (a.marks[p] == b.marks[q])

    def table(first: list[int], second: list[int]) -> list[list[int]]:
        most = [[0] * (len(second) + 1) for _ in range(len(first) + 1)]
        for i in range(len(first) - 1, -1, -1):
            row, below, p = most[i], most[i + 1], first[i]
            for j in range(len(second) - 1, -1, -1):
                got = gain(p, second[j])
                row[j] = max(below[j], row[j + 1], below[j + 1] + got if got else 0)
        return most

    def settle(pair: tuple[int, int]) -> None:
        """Plans and worth of a pair and of all pairs that are weighed one by one for it."""
        order, todo = [], [pair]
        while todo:
            x, y = todo.pop()
            if (x, y) in plans or (x, y) in worth:
                continue
            if a.equal[x] == b.equal[y]:
                worth[x, y] = a.sizes[x] * (unit + 1)
                continue
            ends, first, second = plans[x, y] = _middle(a, b, x, y)
            order.append((x, y))
            if len(first) * len(second) <= CELLS:
                # Where one of two has no children there is nothing to weigh.
                inner = [q for q in second if b.children[q]]
                todo += [(p, q) for p in first if a.children[p] for q in inner if a.kinds[p] == b.kinds[q]]
        # Inner pairs lie deeper, so they are weighed before the pairs around them.
        for x, y in sorted(order, key=lambda pair: -a.depth[pair[0]]):
            ends, first, second = plans[x, y]
            inner = 0
            if len(first) * len(second) > CELLS:
                a.compare(b, -1)
                b.compare(a, -2)
                inner, chosen = _Rows(a, b, first, second, unit).best()
                plans[x, y] = ends + [(first[i], second[j]) for i, j in chosen], [], []
            elif first and second:
                inner = table(first, second)[0][0]
            worth[x, y] = unit + (a.marks[x] == b.marks[y]) + sum(a.sizes[p] * (unit + 1) for p, _ in ends) + inner

    out, todo = [], [(0, 0)]
    while todo:
        x, y = todo.pop()
        if a.equal[x] == b.equal[y]:
            out += zip(range(x, x + a.sizes[x]), range(y, y + b.sizes[y]))
            continue
        out.append((x, y))
        if not (a.children[x] and b.children[y]):
            continue
        settle((x, y))
        ends, first, second = plans[x, y]
        todo += ends
        if first and second:
            most, i, j = table(first, second), 0, 0
            while i < len(first) and j < len(second):
                got = gain(first[i], second[j])
                if got and most[i][j] == most[i + 1][j + 1] + got:
                    todo.append((first[i], second[j]))
                    i, j = i + 1, j + 1
                elif most[i][j] == most[i + 1][j]:
                    i += 1
                else:
                    j += 1
    return sorted(out)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [json.dumps(tree(parse(source or ""))) for source in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(trees, pa.string())], ["host", "tree"])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different pages that pair with a reference node, and those equal in it, summed per batch."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        known: dict[str, dict] = {}
        for host, page, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "tree", "reference"))):
            if reference not in known:
                known = {reference: json.loads(reference)}
            template, own = known[reference], json.loads(page)
            for r, p in match(template, own):
                # A node without text has none to be kept or left out.
                if template["m"][r]:
                    vote = sums.setdefault((host, r), [0, 0])
                    vote[0] += 1
                    vote[1] += template["m"][r] == own["m"][p]
        if sums:
            hosts, nodes = zip(*sums)
            paired, same = zip(*sums.values())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(nodes, pa.int32()), pa.array(paired, pa.int64()), pa.array(same, pa.int64())], ["host", "node", "paired", "same"])


def _settle_roles(blocks: list[Block], opened: bool) -> None:
    """Which blocks are left out; with ``opened`` those with role tokens that hold an article stay in."""
    for block in reversed(blocks):
        if block.parent is not None and (block.holds or block.tag in ("article", "main")):
            block.parent.holds = True
    for block in blocks:
        named = block.own == "word" or (block.own == "skip" and block.tag == "form")
        mine = (block.own != "" and not named) or (named and not (opened and block.holds))
        block.skip = mine or (block.parent is not None and block.parent.skip)


def _texts(block: Block) -> list[tuple[int, str]]:
    """(node, text) of all blocks of text below ``block`` that are not left out, in page order."""
    out, stack = [], [(block, iter(block.items))]
    while stack:
        at, items = stack[-1]
        for x in items:
            if isinstance(x, str):
                out.append((at.node, x))
            elif not x.skip:
                stack.append((x, iter(x.items)))
                break
        else:
            stack.pop()
    return out


def _tops(blocks: list[Block], tag: str) -> list[Block]:
    """Outermost blocks with ``tag`` that are not left out and have text."""
    inside, found = set(), []
    for block in blocks:
        if block.parent is not None and id(block.parent) in inside:
            inside.add(id(block))
        elif block.tag == tag and not block.skip:
            inside.add(id(block))
            found.append(block)
    return [b for b in found if _texts(b)]


def _content(root: Block, blocks: list[Block]) -> tuple[list[Block], bool]:
    """The blocks that hold the main text, and whether the page marks them as such."""
    for opened in (False, True):
        _settle_roles(blocks, opened)
        articles, mains = _tops(blocks, "article"), _tops(blocks, "main")
        # A main part with several articles, or with text beside them, is taken as a whole.
        if mains and len(articles) != 1:
            return mains, True
        if articles:
            return articles, True
    _settle_roles(blocks, False)
    return [root], False


def main_text(source: str, reference: dict | None, template: set[int]) -> str:
    """The page's text: blocks of its article in slots, roles left out, joined by empty lines."""
    root = parse(source)
    fixed: set[int] = set()
    if reference is not None and template:
        fixed = {p for r, p in match(reference, tree(root)) if r in template}
    chosen, marked = _content(root, preorder(root))
    told = [t for b in chosen for t in _texts(b)]
    varying = [t for node, t in told if node not in fixed]
    if not varying or (marked and 2 * sum(map(len, varying)) < sum(len(t) for _, t in told)):
        varying = [t for _, t in told]
    return "\n\n".join(varying)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, list] = {}
        out = []
        for source, reference, template in zip(*(batch.column(c).to_pylist() for c in ("html", "reference", "template"))):
            if reference is not None and reference not in known:
                known = {reference: json.loads(reference)}
            out.append(main_text(source or "", known[reference] if reference is not None else None, set(template or ())))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, reference, template): a host's reference tree and its nodes that hold the same text on nearly all pages."""
    shape = "host string, tree string"
    trees = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_trees, shape)
    # Copies of a page say nothing new about its host: equal trees are matched and counted once.
    trees = written(trees.groupBy("host", "tree").agg(F.count("*").alias("pages")), "html-trees")
    chosen = trees.groupBy("host").agg(F.min_by("tree", F.struct(F.xxhash64("tree"), F.col("tree"))).alias("reference"), F.count("*").alias("n")).where(F.col("n") >= PAGES)
    paired = trees.join(chosen, "host").select("host", "tree", "reference").mapInArrow(_votes, "host string, node int, paired long, same long")
    fixed = paired.groupBy("host", "node").agg(F.sum("paired").alias("paired"), F.sum("same").alias("same")).join(chosen.select("host", "n"), "host")
    fixed = fixed.where((F.col("same") >= F.col("n") * SHARE)).groupBy("host").agg(F.collect_set("node").alias("template"))
    return chosen.select("host", "reference").join(fixed, "host")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    found = written(templates(pages), "html-templates").withColumnRenamed("host", "_host")
    joined = pages.select("page_id", "url", "html").join(found, host_of(F.col("url")) == F.col("_host"), "left")
    shape = pages.select("page_id", "url").schema.add("text", "string")
    texts = joined.select("page_id", "url", "html", "reference", "template").mapInArrow(_extracted, shape)
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_wrapper_induction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract(read(spark, folder, "pages"))
