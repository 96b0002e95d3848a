"""Main text of web pages by wrapper induction.

Each page becomes a small tree of its elements, in which runs of like siblings
(paragraphs, list items) count as one repeated node. A host's pages are clustered
by simple tree matching, one cluster for each layout, and every distinct tree is
aligned with its cluster's commonest tree; a node without a partner there is known
by its way from the nearest node that has one. Over the cluster's pages that have
text at such a slot, text that is the same nearly everywhere is template; nodes
whose text varies are content slots. A page's main text is the blocks in its content slots, without the
elements whose tag, role or class says menu, advert, form, comment and so on, and
inside its article or main elements if these hold most of that text. A form or
fieldset that has an article or main element, or most of the page's text, is no noise.

Plan: pages are parsed twice rather than kept (parsing is cheap, the html is
large). Template statistics are counts per (host, node, text) with partial
aggregation, so a hot host spreads; trees are matched once per (host, distinct
tree). Copies of a page count once in a host's statistics: a text is template
only if it stands in ``SHARE`` of at least ``LEAST`` different pages that have its
slot. Clustering takes rounds: in each, a host's commonest trees that no cluster
holds found new ones, twice as many as in the round before, until the rest are
too few pages for a template. Trees outside clusters of ``LEAST`` different pages
take the likest cluster's template but do not count in it; a host without such a
cluster is one. The
template list meets the pages in a broadcast if its checked size allows, else in
a join that the adaptive skew join splits.

Defined cases: null html counts as empty, text "" and 0 characters. A null url
is the host "". Markup that is cut off or badly nested is read as far as it goes.
Repeated rows give repeated rows. An empty table gives an empty result. Only id,
url and html are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: A text is template if it stands at its node in this share of the host's different pages.
SHARE = 0.9
#: Slots that fewer different pages have are no template.
LEAST = 5
#: Trees are of one layout if this share of their nodes match.
ALIKE = 0.7
#: New clusters of a host in the first round, and the largest clusters that other trees are compared with.
PIVOTS, LARGEST = 4, 16
#: Bytes of the template list that are broadcast at most.
BROADCAST_BYTES = 8 << 20
#: A block with this part of its characters in links is a menu, outside articles.
LINKS = 0.8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul""".split())
NOISE = frozenset("""applet audio aside button canvas dialog embed fieldset footer form head iframe input label legend
    map menu meter nav noscript object option output progress script select style svg template textarea title video""".split())
#: Noise that may wrap a page's body.
WRAPPER = frozenset("fieldset form label object".split())
#: Those that stay if they hold most of the page's text.
MOSTLY = frozenset(("fieldset", "form"))
NOISE_ROLE = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    status toolbar""".split())
NOISE_WORD = frozenset("""ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs byline-share
    comment comments consent cookie cookies discussion disqus footer gdpr header login masthead menu modal nav navbar
    navigation newsletter notice notices pager pagination popup promo promos promotion recommended related replies
    respond sharing share sidebar signup skip-link social sponsor sponsored subscribe subscription toolbar widget""".split())
#: Words that say so anywhere in a class or id.
NOISE_ANYWHERE = frozenset("advert advertisement breadcrumb breadcrumbs comment comments cookie cookies disqus newsletter sponsored".split())
#: What a paragraph of an article may be called and stay; of words with a hyphen only
#: those of NOISE_ANYWHERE make it noise (share-price, notice-of-meeting, ad-hoc).
PARAGRAPH = frozenset("related share sharing social promo header login navigation recommended".split())
#: Form elements whose text is part of a sentence when text stands beside them in one of these.
IN_SENTENCE = frozenset("button label output".split())
SENTENCE = frozenset("b blockquote dd em figcaption h1 h2 h3 h4 h5 h6 i li p span strong td th".split())
MAIN = frozenset(("article", "main"))
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag ends these open elements.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
FENCE = frozenset("article body div main section table ul ol dl td th blockquote form aside nav header footer".split())
_SPLIT = re.compile(r"[-_]+")


class Node:
    #: number: its place in the page's tree; same, runs: what ``shape`` notes of it.
    __slots__ = ("tag", "attrs", "children", "parent", "number", "same", "runs")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children, self.number = tag, attrs, parent, [], -1


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)
        self.open: dict[str, int] = {}  # open elements by tag: none of a tag, and no search goes up for it

    def updatepos(self, i, j):
        return j  # lines are not counted

    def _pop(self, to: "Node") -> None:
        while self.at is not to:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def _end(self, tags, fence=FENCE) -> None:
        left = 0
        for t in tags:
            left += self.open.get(t, 0)
        if not left:
            return
        n, to = self.at, self.at
        while n.parent is not None and n.tag not in fence and left:
            if n.tag in tags:
                to, left = n.parent, left - 1
            n = n.parent
        if n.parent is not None and n.tag in tags:
            to = n.parent
        self._pop(to)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._end(CLOSES[tag], FENCE - {"td", "th"} if tag == "tr" else FENCE)
        if tag in BLOCK:
            self._end(("p", *HEADING) if tag in HEADING else ("p",))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.open[tag] = self.open.get(tag, 0) + 1
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path"):
            self._pop(self.at.parent)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        n = self.at
        while n.tag != tag:
            n = n.parent
        self._pop(n.parent)

    def handle_data(self, data):
        self.at.children.append(data)


#: A tag that the page's end cuts off.
_CUT_OFF = re.compile(r"<[a-zA-Z/!][^<>]*\Z")


def tree(html: str | None) -> Node:
    b = _Builder()
    b.feed(_CUT_OFF.sub("", html or "") if (html or "").rfind("<") > (html or "").rfind(">") else html or "")
    b.close()
    return b.root


def _classes(node: Node) -> list[str]:
    return f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split()


def _has_main(node: Node) -> bool:
    todo = [node]
    while todo:
        n = todo.pop()
        if n.tag in MAIN:
            return True
        todo += [c for c in n.children if isinstance(c, Node)]
    return False


def _in_sentence(node: Node) -> bool:
    """Whether the element's text goes on from, or into, text of its own paragraph."""
    paragraph = node.parent
    if paragraph is None or paragraph.tag not in SENTENCE:
        return False
    k = next(i for i, c in enumerate(paragraph.children) if c is node)
    return any(isinstance(c, str) and c.strip() for c in paragraph.children[max(0, k - 1):k + 2])


def _noise(node: Node, inside: bool, held: frozenset[int] = frozenset()) -> bool:
    """Whether the element and all below it is not main text; ``held`` are wrappers
    that stay, by id()."""
    tag, attrs = node.tag, node.attrs
    if not attrs and tag not in NOISE and tag != "header":
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return tag != "label" or not _has_main(node)
    if tag in NOISE and id(node) not in held:
        if inside and tag in IN_SENTENCE and _in_sentence(node):
            return False
        return tag not in WRAPPER or not _has_main(node)
    if tag in MAIN or tag in ("html", "body", "#root"):
        return any(w in ("comment", "comments", "reply") for w in _classes(node)) and tag == "article"
    if tag == "header" and not inside:
        return not _has_main(node)
    if attrs.get("role", "").lower() in NOISE_ROLE or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return not _has_main(node)
    for word in _classes(node):
        parts = _SPLIT.split(word)
        if inside and tag == "p" and (word in PARAGRAPH or word not in NOISE_WORD and NOISE_ANYWHERE.isdisjoint(parts)):
            continue
        if word in NOISE_WORD or parts[0] in NOISE_WORD or parts[-1] in NOISE_WORD or not NOISE_ANYWHERE.isdisjoint(parts):
            return not (inside and tag in HEADING) and not _has_main(node)
    return False


def _label(node: Node) -> str:
    names = node.attrs.get("class")
    return ".".join([node.tag, *sorted(names.split())]) if names else node.tag


def shape(root: Node) -> tuple:
    """The page's tree as (label, children), runs of like siblings as one; numbers
    the nodes in preorder, repeated siblings alike."""
    made: list[tuple] = []
    numbers: dict[tuple, int] = {}  # equal shapes have one number: deep tuples are not compared
    order: list[Node] = []
    todo = [root]
    while todo:  # iterative: pages may nest deeply
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if c.__class__ is Node]
    for n in reversed(order):
        runs: list[list[Node]] = []
        last = -1
        for c in n.children:
            if c.__class__ is Node and (c.tag in BLOCK or c.children):
                if c.same == last:
                    runs[-1].append(c)
                else:
                    runs.append([c])
                    last = c.same
        n.runs = runs
        key = (_label(n), *[r[0].same for r in runs])
        if key not in numbers:
            numbers[key] = len(made)
            made.append((key[0], tuple([made[k] for k in key[1:]])))
        n.same = numbers[key]
    next_number = 0
    stack = [[root]]
    while stack:
        run = stack.pop()
        for n in run:
            n.number = next_number
        next_number += 1
        if len(run) == 1:
            stack += reversed(run[0].runs)
        else:
            lists = [n.runs for n in run]
            stack += [[x for runs in lists for x in runs[k]] for k in reversed(range(len(lists[0])))]
    return made[root.same]


def _blocks(root: Node, held: frozenset[int]) -> list[tuple[int, str, bool, float, tuple[int, ...]]]:
    """The blocks that are not noise, with the ``held`` wrappers around them."""
    out: list[tuple[int, str, bool, float, tuple[int, ...]]] = []
    text: list[str] = []
    linked = [0]
    state: dict = {"node": 0, "inside": False, "around": (), "blank": True}

    def flush():
        if not state["blank"]:
            s = " ".join("".join(text).split())
            out.append((state["node"], s, state["inside"], linked[0] / len(s), state["around"]))
            state["blank"] = True
        text.clear()
        linked[0] = 0

    stack: list = [(root, False, False, False, 0, ())]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
            continue
        n, inside, in_link, only_headings, number, around = item
        if n.__class__ is str:
            if not only_headings:
                chars = len(n.strip())
                if state["blank"]:
                    state["node"], state["inside"], state["around"], state["blank"] = number, inside, around, not chars
                text.append(n)
                linked[0] += chars * in_link
            continue
        if n.tag != "#root" and _noise(n, inside, held):
            continue
        if n.tag == "br":
            text.append(" ")
            continue
        if n.tag == "header" and inside:
            only_headings = True
        if n.tag in HEADING:
            only_headings = False
        number = n.number if n.number >= 0 else number
        if id(n) in held:
            around = (*around, id(n))
        below = [(c, inside or n.tag in MAIN, in_link or n.tag == "a", only_headings, number, around) for c in reversed(n.children)]
        if n.tag in BLOCK:
            flush()
            stack.append(None)
        stack += below
    flush()
    return out


def _holders(root: Node) -> frozenset[int]:
    """The forms and fieldsets that hold most of the page's text."""
    todo, held = [root], set()
    while todo:
        n = todo.pop()
        if n.tag in MOSTLY:
            held.add(id(n))
        todo += [c for c in n.children if isinstance(c, Node)]
    if not held:
        return frozenset()
    total, chars = 0, dict.fromkeys(held, 0)
    for _, text, inside, links, around in _blocks(root, frozenset(held)):
        if inside or links < LINKS:
            total += len(text)
            for x in around:
                chars[x] += len(text)
    return frozenset(x for x, c in chars.items() if 2 * c > total)


def blocks(root: Node) -> list[tuple[int, str, bool, float]]:
    """(node, text, inside an article, part of it in links) of the blocks that are not noise."""
    return [b[:4] for b in _blocks(root, _holders(root))]


def text_blocks(root: Node) -> list[tuple[int, str, bool]]:
    """(node, text, inside an article) of the blocks that are no menus."""
    return [b[:3] for b in blocks(root) if b[2] or b[3] < LINKS]


def main_of(found: list[tuple[int, str, bool]]) -> list[tuple[int, str]]:
    """Those inside articles if they hold most of the text."""
    inside = sum(len(t) for _, t, within in found if within)
    most = 2 * inside > sum(len(t) for _, t, _ in found)
    return [(n, t) for n, t, within in found if within or not most]


def main_blocks(root: Node) -> list[tuple[int, str]]:
    return main_of(text_blocks(root))


def host_of(url: str | None) -> str:
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", url or "")
    return m[1].rpartition("@")[2].lower() if m else ""


def text_hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


_UNSAFE = re.compile(r"[()\s]")


def _write_shape(s: tuple) -> str:
    out, todo = [], [s]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            out.append("(" + (_UNSAFE.sub("_", x[0]) if _UNSAFE.search(x[0]) else x[0]))
            todo.append(")")
            todo += reversed(x[1])
    return " ".join(out)


def read_shape(s: str) -> tuple:
    stack: list[list] = [["", []]]
    for w in s.split():
        if w == ")":
            label, children = stack.pop()
            stack[-1][1].append((label, tuple(children)))
        else:
            stack.append([w[1:], []])
    return stack[0][1][0]


class Matcher:
    """Simple tree matching over trees whose equal subtrees share a number; no
    recursion, as pages may nest deeply."""

    #: Subtrees and matched pairs that are remembered.
    MEMORY = 200_000

    def __init__(self):
        self.ids: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.found: dict[tuple[int, int], int] = {}

    def add(self, s: tuple) -> int:
        """The number of a tree of (label, children)."""
        done: list[int] = []
        todo: list[tuple] = [(s, False)]
        while todo:
            x, below = todo.pop()
            if not below:
                todo.append((x, True))
                todo += [(c, False) for c in reversed(x[1])]
                continue
            cut = len(done) - len(x[1])
            key = (x[0], tuple(done[cut:]))
            del done[cut:]
            if key not in self.ids:
                self.ids[key] = len(self.label)
                self.label.append(x[0])
                self.kids.append(key[1])
                self.size.append(1 + sum(self.size[c] for c in key[1]))
            done.append(self.ids[key])
        return done[0]

    def known(self, a: int, b: int) -> int | None:
        if a == b:
            return self.size[a]
        return 0 if self.label[a] != self.label[b] else self.found.get((a, b))

    def match(self, a: int, b: int) -> int:
        """The number of pairs of the largest order-keeping top-down matching."""
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if self.known(x, y) is None:
                missing = {(c, d) for c in self.kids[x] for d in self.kids[y] if self.known(c, d) is None}
                if missing:
                    todo += missing
                    continue
                row = [0] * (len(self.kids[y]) + 1)
                for c in self.kids[x]:
                    before, row = row, [0] * len(row)
                    for j, d in enumerate(self.kids[y]):
                        row[j + 1] = max(row[j], before[j + 1], before[j] + self.known(c, d))
                self.found[x, y] = row[-1] + 1
            todo.pop()
        return self.known(a, b)

    def likeness(self, a: int, b: int) -> float:
        """The share of both trees' nodes that match."""
        return 2 * self.match(a, b) / (self.size[a] + self.size[b])

    def slots(self, a: int, b: int) -> dict[int, int]:
        """Like ``align``; a node without a partner has the slot, below 0, of its label below its parent's slot."""
        out, todo, pairs = {}, [(b, 0, 0)], self.align(a, b)
        while todo:
            x, number, above = todo.pop()
            out[number] = own = pairs[number] if number in pairs else -1 - abs(text_hash(f"{above} {self.label[x]}") >> 1)
            number += 1
            for c in self.kids[x]:
                todo.append((c, number, own))
                number += self.size[c]
        return out

    def align(self, a: int, b: int) -> dict[int, int]:
        """Preorder numbers of b's nodes to those of the nodes of a that they match."""
        out: dict[int, int] = {}
        self.match(a, b)
        todo = [(a, b, 0, 0)]
        while todo:
            a, b, na, nb = todo.pop()
            if self.label[a] != self.label[b]:
                continue
            if a == b:
                out.update(zip(range(nb, nb + self.size[b]), range(na, na + self.size[a])))
                continue
            out[nb] = na
            above, below = self.kids[a], self.kids[b]
            m, n = len(above), len(below)
            best = [[0] * (n + 1) for _ in range(m + 1)]
            for i in range(m):
                for j in range(n):
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + self.match(above[i], below[j]))
            starts = []
            for at, x in ((na, above), (nb, below)):
                s = [at + 1]
                for c in x:
                    s.append(s[-1] + self.size[c])
                starts.append(s)
            i, j, pairs = m, n, {}
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs[j] = i
            near = 0
            for j in range(n):  # one node may stand for a run: what is left over joins the nearest of its label
                if j not in pairs and (like := [i for i in range(m) if self.label[above[i]] == self.label[below[j]]]):
                    pairs[j] = min(like, key=lambda i: (abs(i - near), i))
                near = pairs.get(j, near)
                if j in pairs:
                    todo.append((above[pairs[j]], below[j], starts[0][pairs[j]], starts[1][j]))
        return out

    def full(self) -> bool:
        return max(len(self.label), len(self.found)) > self.MEMORY


def simple_tree_match(a: tuple, b: tuple) -> int:
    m = Matcher()
    return m.match(m.add(a), m.add(b))


def align(a: tuple, b: tuple) -> dict[int, int]:
    m = Matcher()
    return m.align(m.add(a), m.add(b))


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str, with_text: bool) -> DataFrame:
    """(page_id, url, host, tree, shape, page_hash, blocks of (node, th[, inside, text])); ``tree``
    is a hash of the page's shape, which is itself only written without texts.
    Whether articles win is only known without the template: all blocks are kept here."""
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    block = [("node", pa.int32()), ("th", pa.int64())] + [("inside", pa.bool_()), ("text", pa.string())] * with_text
    schema = (f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, host string, tree long, shape string, page_hash long, "
              "blocks array<struct<node:int,th:long" + ",inside:boolean,text:string" * with_text + ">>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, trees, shapes, hashes, found = [], [], [], [], []
            for url, html in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
                root = tree(html)
                hosts.append(host_of(url))
                written = _write_shape(shape(root))
                trees.append(text_hash(written))
                shapes.append(None if with_text else written)
                own = text_blocks(root)
                hashes.append(None if with_text else text_hash("\n".join(t for _, t in main_of(own))))
                found.append([{"node": n, "th": text_hash(t)} | ({"inside": i, "text": t} if with_text else {}) for n, t, i in own])
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(hosts, pa.string()), pa.array(trees, pa.int64()), pa.array(shapes, pa.string()),
                 pa.array(hashes, pa.int64()), pa.array(found, pa.list_(pa.struct(block)))],
                names=["page_id", "url", "host", "tree", "shape", "page_hash", "blocks"])

    return d.mapInArrow(run, schema)


def _assigned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of the pivots, in their order, that each tree is like."""
    m = Matcher()
    for b in rows:
        out = []
        for shape_, pivots in zip(b.column("shape").to_pylist(), b.column("pivots").to_pylist()):
            if m.full():
                m = Matcher()
            own = m.add(read_shape(shape_))
            out.append(next((p["tree"] for p in pivots if m.likeness(m.add(read_shape(p["shape"])), own) >= ALIKE), None))
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("tree"), pa.array(out, pa.int64())], names=["host", "tree", "cluster"])


def _aligned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of each tree's nodes in the likest of its pivots' clusters."""
    m = Matcher()
    for b in rows:
        for host, own, shape_, votes, pivots in zip(*(b.column(c).to_pylist() for c in ("host", "tree", "shape", "votes", "pivots"))):
            if m.full():
                m = Matcher()
            x = m.add(read_shape(shape_))
            trees = [(p["tree"], m.add(read_shape(p["shape"]))) for p in pivots]
            cluster, pivot = trees[0] if len(trees) == 1 else max(trees, key=lambda t: m.likeness(t[1], x))
            pairs = m.slots(pivot, x)
            n = len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([host] * n), pa.array([own] * n, pa.int64()), pa.array([cluster] * n, pa.int64()), pa.array([votes] * n, pa.bool_()),
                 pa.array(list(pairs), pa.int32()), pa.array(list(pairs.values()), pa.int64())],
                names=["host", "tree", "cluster", "votes", "node", "slot"])


def _commonest(trees: DataFrame, k: int) -> DataFrame:
    """(host, pivots): each host's k commonest trees as (tree, shape), the commonest first."""
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "tree"))
    return trees.select("host", F.struct(place.alias("place"), "tree", "shape").alias("p")).where(F.col("p.place") <= k) \
        .groupBy("host").agg(F.array_sort(F.collect_list("p")).alias("pivots"))


def _clusters(shapes: DataFrame, least: int) -> DataFrame:
    """(host, tree, cluster), the cluster as its pivot's tree; trees of too few pages for a cluster are not in it."""
    out, rest, k = None, shapes, PIVOTS
    while True:
        enough = rest.groupBy("host").agg(F.sum("n").alias("pages")).where(F.col("pages") >= least).select("host")
        rest = staged(rest.join(staged(enough, "open_hosts"), "host", "left_semi"), "open_trees")
        if rest.isEmpty():
            return out if out is not None else shapes.select("host", "tree", F.col("tree").alias("cluster")).limit(0)
        pivots = staged(_commonest(rest, k), "pivots")
        got = staged(rest.join(pivots, "host").select("host", "tree", "shape", "pivots")
                     .mapInArrow(_assigned, "host string, tree long, cluster long"), "clusters")
        found = got.where("cluster IS NOT NULL")
        out = found if out is None else out.unionByName(found)
        rest, k = rest.join(got.where("cluster IS NULL").select("host", "tree"), ["host", "tree"], "left_semi"), 2 * k


def _slots(seen: DataFrame, shapes: DataFrame, least: int) -> DataFrame:
    """(host, tree, cluster, votes, node, slot) of all trees; votes: the tree counts in its cluster."""
    found = _clusters(shapes, least)
    pages = seen.select("host", "tree", "page_hash").distinct().join(found, ["host", "tree"]) \
        .select("host", "cluster", "page_hash").distinct().groupBy("host", "cluster").agg(F.count("*").alias("n"))
    layouts = staged(pages.where(F.col("n") >= least), "layouts")
    large = layouts.join(shapes.select("host", F.col("tree").alias("cluster"), "shape"), ["host", "cluster"]) \
        .select("host", F.col("cluster").alias("tree"), "n", "shape")
    large = staged(large, "layout_pivots")
    of_none = shapes.join(large.select("host").distinct(), "host", "left_anti")
    likest = staged(_commonest(large, LARGEST).withColumn("votes", F.lit(False))
                    .unionByName(_commonest(of_none, 1).withColumn("votes", F.lit(True))), "likest")
    member = found.join(large.select("host", F.col("tree").alias("cluster"), F.col("shape").alias("pivot")), ["host", "cluster"])
    member = staged(member.select("host", "tree", "cluster", "pivot"), "members")
    own = F.array(F.struct(F.lit(1).alias("place"), F.col("cluster").alias("tree"), F.col("pivot").alias("shape")))
    inner = shapes.join(member, ["host", "tree"]).select("host", "tree", "shape", F.lit(True).alias("votes"), own.alias("pivots"))
    outer = shapes.join(member.select("host", "tree"), ["host", "tree"], "left_anti").join(likest, "host") \
        .select("host", "tree", "shape", "votes", "pivots")
    return staged(inner.unionByName(outer).mapInArrow(
        _aligned, "host string, tree long, cluster long, votes boolean, node int, slot long"), "slots")


def template(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(host, tree, drop): for each tree of a host its constant blocks, as (node, th)."""
    seen = staged(_parsed(pages, id_col, url_col, html_col, False).select("host", "tree", "shape", "page_hash", "blocks"), "page_trees")
    shapes = staged(seen.groupBy("host", "tree").agg(F.count("*").alias("n"), F.min("shape").alias("shape")), "shapes")
    slots = _slots(seen, shapes, least)
    texts = seen.select("host", "tree", "page_hash", F.explode("blocks").alias("b")) \
        .select("host", "tree", "page_hash", "b.node", "b.th").distinct()
    stands = staged(texts.join(slots.where("votes"), ["host", "tree", "node"]).select("host", "cluster", "slot", "th", "page_hash").distinct(), "stands")
    many = stands.select("host", "cluster", "slot", "page_hash").distinct().groupBy("host", "cluster", "slot") \
        .agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    often = stands.groupBy("host", "cluster", "slot", "th").agg(F.count("*").alias("n")).where(F.col("n") >= share * least)
    fixed = often.join(many, ["host", "cluster", "slot"]).where(F.col("n") >= share * F.col("pages")).select("host", "cluster", "slot", "th")
    return slots.join(staged(fixed, "fixed"), ["host", "cluster", "slot"]).groupBy("host", "tree").agg(F.collect_set(F.struct("node", "th")).alias("drop"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(id, url, text, n_chars): each page's main text, blocks joined by line ends."""
    fixed = staged(template(pages, id_col, url_col, html_col, share, least), "template")
    size = fixed.agg(F.sum(F.octet_length("host") + 32 + 16 * F.size("drop"))).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        fixed = F.broadcast(fixed)
    d = _parsed(pages, id_col, url_col, html_col, True).join(fixed, ["host", "tree"], "left")
    drop = F.coalesce("drop", F.array().cast("array<struct<node:int,th:bigint>>"))
    kept = F.filter("blocks", lambda b: ~F.array_contains(drop, F.struct(b["node"].alias("node"), b["th"].alias("th"))))
    chars = lambda bs: F.aggregate(bs, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))
    d = d.select("page_id", "url", kept.alias("kept")).withColumn("within", F.filter("kept", lambda b: b["inside"]))
    own = F.when(2 * chars(F.col("within")) > chars(F.col("kept")), F.col("within")).otherwise(F.col("kept"))
    text = F.array_join(F.transform(own, lambda b: b["text"]), "\n")
    return d.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), text.alias("text")) \
        .withColumn("n_chars", F.char_length("text").cast("long"))
