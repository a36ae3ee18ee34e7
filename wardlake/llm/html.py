"""Main text of web pages by wrapper induction.

Pages of one host are taken in chunks of CHUNK at most. A page whose tree is like those of most others is the
wrapper of a layout: the DOM trees of the layout's pages are aligned with it by simple tree matching (equal labels,
children in order, as many matched nodes as possible). A wrapper block that keeps its text on most of them is
template, one whose text varies is a content slot. Pages that share most blocks of their content vote once, as a
group, so copies and near copies of one page do not turn into template. A page's text is that of its article (or
main, or body) without template nodes and without parts that serve the site: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import work

CHUNK, MIN_VOTES, CONSTANT = 128, 5, 0.8
_HOST_BUCKETS, _SALT_LEAST = 1 << 16, 512
#: Cells of a table of children, and pairs of shapes remembered, before memory is saved by working twice.
CELLS, GAINS = 1 << 21, 1 << 20

#: Elements without content, raw text elements, block elements, parts that serve the site.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style title textarea noscript iframe template svg math".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
SERVICE = frozenset("head nav footer aside form button select option dialog menu object audio video canvas label input".split()) | RAW_TEXT
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
SERVICE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner|sponsor\w*|promo\w*|comment\w*|respond|disqus\w*|repl(?:y|ies)|cookie\w*|consent|gdpr|"
    r"notice\w*|alert|sidebar\w*|side|widget\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|pagination|pager|footer|header|masthead|topbar|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscri\w*|signup|login|popup|modal|overlay|toolbar|skip|search\w*)(?=$|[\s_-])")
COMMENT_NAME = re.compile(r"(?:^|\s)(?:comments?|reply|replies|ad|ads|advert\w*)(?=$|\s)")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOP = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?<=\s)(hidden)(?=[\s/]|\Z)")


class Words:
    """All words of a page in order, and the letters before each."""

    __slots__ = ("list", "letters")

    def __init__(self):
        self.list: list[str] = []
        self.letters = [0]


_NO_WORDS = Words()


class Node:
    """An element. Its text is a run of the page's words, so a page of any depth holds its text once."""

    __slots__ = ("tag", "name", "hidden", "parts", "kids", "blocks", "shape", "words", "start", "end")

    def __init__(self, tag: str, name: str = "", hidden: bool = False):
        self.tag, self.name, self.hidden = tag, name, hidden
        self.parts: list[Node | str] = []
        self.kids: list[Node] = []
        self.blocks: list[Node] = []
        self.shape = -1
        self.words, self.start, self.end = _NO_WORDS, 0, 0

    @property
    def filled(self) -> bool:
        return self.end > self.start

    @property
    def chars(self) -> int:
        return self.words.letters[self.end] - self.words.letters[self.start] + max(self.end - self.start - 1, 0)

    @property
    def text(self) -> str:
        return " ".join(self.words.list[self.start:self.end])

    def same_text(self, other: Node) -> bool:
        return (self.end - self.start == other.end - other.start
                and self.words.list[self.start:self.end] == other.words.list[other.start:other.end])

    def add(self, node: Node) -> Node:
        self.parts.append(node)
        self.kids.append(node)
        return node


def parse(page: str) -> Node:
    """DOM tree of a page; unclosed and misplaced tags end where HTML lets them end."""
    root = Node("html")
    stack, at, n = [root], 0, len(page)
    while at < n:
        found = _TAG.search(page, at)
        if not found:
            stack[-1].parts.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            stack[-1].parts.append(html.unescape(page[at:found.start()]))
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        names, hidden = [], False
        for key, *values, bare in _ATTR.findall(found[3]) if found[3].strip() else ():
            value = "".join(values).lower()
            key = (key or bare).lower()
            if key in ("class", "id", "role"):
                names.append(f"role={value}" if key == "role" else value)
            hidden |= key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "")
        _make_room(stack, tag)
        if tag == "html":
            continue
        node = stack[-1].add(Node(tag, " ".join(names), hidden))
        if tag in RAW_TEXT and not found[0].endswith("/>"):
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID:
            stack.append(node)
    _gather(root)
    return root


def _make_room(stack: list[Node], tag: str) -> None:
    """Ends the elements that a start tag ends."""
    if tag in BLOCKS:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in BLOCKS:
                break
    if tag in _CLOSES:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in _CLOSES[tag]:
                del stack[i:]
                break
            if stack[i].tag in _STOP[tag]:
                break


def _gather(root: Node) -> None:
    """Sets every node's run of words and its nearest blocks below."""
    words = Words()
    around = [root]
    todo: list[Node | str | None] = [root]
    open_nodes: list[Node] = []
    while todo:
        part = todo.pop()
        if part is None:
            node = open_nodes.pop()
            node.end = len(words.list)
            if around[-1] is node:
                around.pop()
        elif isinstance(part, str):
            words.list.extend(part.split())
        else:
            part.words, part.start = words, len(words.list)
            if part is not root and (part.tag in BLOCKS or is_main(part)):
                around[-1].blocks.append(part)
                around.append(part)
            open_nodes.append(part)
            todo.append(None)
            todo.extend(reversed(part.parts))
    words.letters.extend(accumulate(map(len, words.list)))


def serves_by_kind(node: Node) -> bool:
    """Whether tag, role or visibility tell that a node serves the site."""
    if node.tag in SERVICE or node.hidden:
        return True
    return "role=" in node.name and node.tag not in ("body", "html") and any(f"role={r}" in node.name for r in ROLES)


def serves_site(node: Node) -> bool:
    if serves_by_kind(node):
        return True
    if node.tag in ("body", "html"):
        return False
    return bool((COMMENT_NAME if node.tag in ("article", "main") else SERVICE_NAME).search(node.name))


def named_whole(node: Node) -> bool:
    """Whether a whole class or id, not a part of one with hyphens, is a service name."""
    return any("-" not in x and SERVICE_NAME.search(x) for x in node.name.split())


def is_main(node: Node) -> bool:
    return node.tag == "main" or "role=main" in node.name


def holders(root: Node) -> set[int]:
    """Ids of the nodes around the page's longest article and around its mains: no name rejects these."""
    above: dict[int, Node] = {}
    found: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if (node.tag == "article" or is_main(node)) and not serves_site(node):
            found.append(node)
        for kid in node.kids:
            if not serves_by_kind(kid):
                above[id(kid)] = node
                todo.append(kid)
    articles = [n for n in found if n.tag == "article"]
    best = max((n.chars for n in articles), default=0)
    out: set[int] = set()
    for node in found:
        if is_main(node) or node.chars == best:
            while id(node) in above and id(above[id(node)]) not in out:
                node = above[id(node)]
                out.add(id(node))
    return out


def content_roots(root: Node) -> list[Node]:
    """The outermost articles, or mains, or the body."""
    free = holders(root)

    def outermost(wanted) -> list[Node]:
        out, todo = [], [root]
        while todo:
            node = todo.pop()
            if wanted(node) and not serves_site(node):
                out.append(node)
            elif id(node) in free or not serves_site(node):
                todo.extend(reversed(node.kids))
        return out

    for wanted in (lambda n: n.tag == "article", is_main):
        if found := outermost(wanted):
            return found
    return [root]


def _trim(xs: list, ys: list, equal) -> tuple[int, int]:
    """Lengths of the equal head and of the equal tail after it. Some best match pairs both in order."""
    short = min(len(xs), len(ys))
    head = 0
    while head < short and equal(xs[head], ys[head]):
        head += 1
    tail = 0
    while tail < short - head and equal(xs[-1 - tail], ys[-1 - tail]):
        tail += 1
    return head, tail


def _best_row(gains: np.ndarray, xs: np.ndarray, ys: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Most matched nodes of all ``xs`` with each head of ``ys``; ``keep`` takes the rows of every head of ``xs``."""
    row = np.zeros(len(ys) + 1, np.int64)
    for x in xs:
        if keep is not None:
            keep.append(row)
        best = np.maximum(row[1:], row[:-1] + gains[x][ys])
        row = np.concatenate([row[:1], np.maximum.accumulate(best)])
    if keep is not None:
        keep.append(row)
    return row


def _best_pairs(gains: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> list[tuple[int, int]]:
    """Places of a best match of children in order. Wide parents are halved, so a table has CELLS cells at most."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(xs), 0, len(ys))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a > 1 and (b - a) * (d - c) > CELLS:
            middle = (a + b) // 2
            head = _best_row(gains, xs[a:middle], ys[c:d])
            tail = _best_row(gains, xs[middle:b][::-1], ys[c:d][::-1])[::-1]
            cut = c + int((head + tail).argmax())
            todo += [(a, middle, c, cut), (middle, b, cut, d)]
            continue
        rows: list[np.ndarray] = []
        _best_row(gains, xs[a:b], ys[c:d], rows)
        i, j = b - a, d - c
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((a + i, c + j))
    return out


class Shapes:
    """Numbers of block trees, equal for equal trees, and simple tree matching between them.

    A pair of shapes is matched once, whatever the number of nodes that have them. Nothing recurs, so
    trees may be of any depth.
    """

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.kids: list[tuple[int, ...]] = []
        self.labels: list[tuple[str, str]] = []
        self.sizes: list[int] = []
        self.gains: dict[tuple[int, int], int] = {}

    def number(self, root: Node) -> None:
        """Sets the shape of every block of a page."""
        order, todo = [], [root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo.extend(node.blocks)
        for node in reversed(order):
            label, kids = (node.tag, node.name), tuple(x.shape for x in node.blocks)
            node.shape = self.numbers.setdefault((label, kids), len(self.kids))
            if node.shape == len(self.kids):
                self.kids.append(kids)
                self.labels.append(label)
                self.sizes.append(1 + sum(self.sizes[x] for x in kids))

    def plain(self, a: int, b: int) -> int | None:
        """Matched nodes of two shapes, None if their children must be matched first."""
        if a == b:
            return self.sizes[a]
        if self.labels[a] != self.labels[b]:
            return 0
        return self.gains.get((a, b)) if self.kids[a] and self.kids[b] else 1

    def table(self, xs: list[int], ys: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | list[tuple[int, int]]:
        """Matched nodes of all different pairs and the places of ``xs`` and ``ys`` in it, or the pairs still unknown."""
        rows, columns = {x: i for i, x in enumerate(dict.fromkeys(xs))}, {y: i for i, y in enumerate(dict.fromkeys(ys))}
        found = [[self.plain(x, y) for y in columns] for x in rows]
        unknown = [(x, y) for x, own in zip(rows, found) for y, n in zip(columns, own) if n is None]
        return unknown or (np.array(found, np.int64), np.array([rows[x] for x in xs]), np.array([columns[y] for y in ys]))

    def match(self, pairs: list[tuple[int, int]]) -> None:
        """Fills ``gains`` for pairs of shapes and all that they rest on."""
        todo = list(pairs)
        while todo:
            a, b = todo[-1]
            if (a, b) in self.gains:
                todo.pop()
                continue
            xs, ys = self.kids[a], self.kids[b]
            head, tail = _trim(xs, ys, int.__eq__)
            total = 1 + sum(self.sizes[x] for x in xs[:head]) + sum(self.sizes[x] for x in xs[len(xs) - tail:])
            xs, ys = xs[head:len(xs) - tail], ys[head:len(ys) - tail]
            if xs and ys:
                known = self.table(xs, ys)
                if isinstance(known, list):
                    todo.extend(known)
                    continue
                total += int(_best_row(*known)[-1])
            self.gains[a, b] = total
            todo.pop()

    def align(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """Pairs of blocks that simple tree matching maps to each other, roots first."""
        if len(self.gains) > GAINS:
            self.gains.clear()
        pairs, todo = [], [(a, b)]
        while todo:
            x, y = todo.pop()
            pairs.append((x, y))
            xs, ys = x.blocks, y.blocks
            head, tail = _trim(xs, ys, lambda p, q: p.shape == q.shape)
            todo.extend(zip(xs[:head], ys[:head]))
            todo.extend(zip(xs[len(xs) - tail:], ys[len(ys) - tail:]))
            xs, ys = xs[head:len(xs) - tail], ys[head:len(ys) - tail]
            if not xs or not ys:
                continue
            shapes = [n.shape for n in xs], [n.shape for n in ys]
            known = self.table(*shapes)
            if isinstance(known, list):
                self.match(known)
                known = self.table(*shapes)
            todo.extend((xs[i], ys[j]) for i, j in _best_pairs(*known))
        return pairs


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    shapes = Shapes()
    shapes.number(a)
    shapes.number(b)
    return shapes.align(a, b)


def content_blocks(tree: Node) -> dict[str, int]:
    """Texts of the innermost blocks of a page's content with their lengths."""
    out: dict[str, int] = {}
    todo = list(content_roots(tree))
    while todo:
        node = todo.pop()
        inner = [x for x in node.kids if x.filled and x.tag in BLOCKS]
        if inner or node.tag not in BLOCKS:
            todo.extend(node.kids)
        if node.filled and node.tag in BLOCKS and not inner:
            out[node.text] = node.chars
    return out


def near_groups(trees: list[Node]) -> list[int]:
    """Group of each page: pages that share most blocks of their content, by number or by length, are one group."""
    blocks = [content_blocks(t) for t in trees]
    sums = [sum(b.values()) for b in blocks]
    holders: dict[str, list[int]] = {}
    for i, own in enumerate(blocks):
        for text in own:
            holders.setdefault(text, []).append(i)
    number, length = np.zeros((len(trees), len(trees))), np.zeros((len(trees), len(trees)))
    for text, ids in holders.items():
        if len(ids) > 1:
            at = np.ix_(ids, ids)
            number[at] += 1
            length[at] += len(text)
    label = list(range(len(trees)))
    whole = [" ".join(r.text for r in content_roots(t)) for t in trees]
    for j in range(len(trees)):
        for i in range(j):
            near = whole[i] == whole[j] or 2 * number[i, j] > max(len(blocks[i]), len(blocks[j])) or 2 * length[i, j] > max(sums[i], sums[j])
            if near and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def layouts(trees: list[Node]) -> list[tuple[int, list[int]]]:
    """Wrappers and the pages that each is aligned with: a wrapper's tree is like that of most pages not yet dealt."""
    kinds: dict[tuple, int] = {}
    held = []
    for tree in trees:
        own, todo = set(), [tree]
        while todo:
            node = todo.pop()
            own |= {kinds.setdefault((node.tag, node.name, k.tag, k.name), len(kinds)) for k in node.kids}
            todo.extend(node.kids)
        held.append(own)
    table = np.zeros((len(trees), max(len(kinds), 1)), np.float32)
    for i, own in enumerate(held):
        table[i, list(own)] = 1
    common = table @ table.T
    size = table.sum(1)
    like = common / np.maximum(size[:, None] + size - common, 1)
    close = (like >= 0.5) & (size[:, None] > 0)
    wrappers: list[int] = []
    rest = np.ones(len(trees), bool)
    while True:
        n = (close & rest).sum(1) * rest
        if n.max() <= MIN_VOTES and wrappers or not n.max():
            break
        best = np.flatnonzero(n == n.max())
        wrappers.append(int(best[np.argmax(like[best][:, rest].sum(1))]))
        rest &= ~close[wrappers[-1]]
    if not wrappers:
        return []
    mine = like[wrappers].argmax(0)
    return [(w, np.flatnonzero(mine == k).tolist()) for k, w in enumerate(wrappers)]


def template(trees: list[Node]) -> list[set[int]]:
    """Per page, the ids of its nodes that are template: same place and same text on most pages of its layout.

    Near copies vote once, as a group, and the share is that of all groups which have the part of the page (its
    article, or all of it) that holds the block.
    """
    out: list[set[int]] = [set() for _ in trees]
    if len(trees) <= MIN_VOTES:
        return out
    label = near_groups(trees)
    shapes = Shapes()
    for tree in trees:
        shapes.number(tree)
    for first, pages in layouts(trees):
        wrapper = trees[first]
        place: dict[int, int] = {}
        for top in content_roots(wrapper):
            todo = [top]
            while todo:
                node = todo.pop()
                place[id(node)] = id(top)
                todo.extend(node.kids)
        aligned = {i: shapes.align(wrapper, trees[i]) for i in pages if i != first}
        voters: dict[int, list[int]] = {}
        for i in aligned:
            if label[i] != label[first]:
                voters.setdefault(label[i], []).append(i)
        agree: dict[int, int] = {}
        met: dict[int, int] = {}
        for members in voters.values():
            equal: dict[int, int] = {}
            seen: set[int] = set()
            for i in members:
                for x, y in aligned[i]:
                    seen.add(id(x))
                    if x.filled and x.tag in BLOCKS and x.same_text(y):
                        equal[id(x)] = equal.get(id(x), 0) + 1
            for x in seen:
                met[x] = met.get(x, 0) + 1
            for x, n in equal.items():
                agree[x] = agree.get(x, 0) + (2 * n > len(members))
        fixed = {x for x, n in agree.items() if n >= MIN_VOTES and n >= CONSTANT * met[place.get(x, id(wrapper))]}
        for i, pairs in aligned.items():
            out[i] = {id(y) for x, y in pairs if id(x) in fixed and x.same_text(y)}
        out[first] = fixed
    return out


def text_of(root: Node, dropped: set[int]) -> str:
    """Blocks of the content in page order, one a line. A header is content only as the head of an article.

    A part of a class or id with hyphens does not reject a node that holds most of the text which is no template.
    """
    sums: dict[int, int] = {}

    def add_up() -> None:
        """Characters of every node without template and without parts that surely serve the site."""
        order, todo = [], [root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo.extend(node.kids)
        for node in reversed(order):
            sums[id(node)] = sum(len(x.strip()) if isinstance(x, str) else sums[id(x)]
                                 if id(x) not in dropped and not serves_by_kind(x) and not named_whole(x) else 0
                                 for x in node.parts)

    def rejected(node: Node, top: Node) -> bool:
        if node is top or serves_by_kind(node):
            return serves_by_kind(node)
        if node.tag == "header":
            return top.tag != "article"
        if not serves_site(node):
            return False
        if named_whole(node):
            return True
        if not sums:
            add_up()
        return 2 * sums[id(node)] <= sums[id(top)]

    blocks: list[str] = []
    held: list[str] = []

    def end() -> None:
        words = " ".join("".join(held).split())
        held.clear()
        if words:
            blocks.append(words)

    for top in content_roots(root):
        todo: list[Node | str | None] = [top]
        while todo:
            part = todo.pop()
            if part is None:
                end()
            elif isinstance(part, str):
                held.append(part)
            elif part.tag == "br":
                held.append(" ")
            elif id(part) not in dropped and not rejected(part, top):
                if part.tag in BLOCKS:
                    end()
                    todo.append(None)
                todo.extend(reversed(part.parts))
        end()
    return "\n".join(blocks)


def extract(pages: list[str]) -> list[str]:
    """Main texts of pages of one host."""
    trees = [parse(p) if p else Node("html") for p in pages]
    return [text_of(tree, drop) for tree, drop in zip(trees, template(trees))]


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` for every row of ``pages``.

    A null or empty page has an empty text. Pages may be of any depth and width: nothing recurs, equal
    neighbours are matched without a table and tables are halved. Rows without a host form one host. Repeated rows are
    extracted each. Hosts are hashed to a fixed number of buckets; the pages of buckets far above
    the mean are dealt over several tasks, so a hot host is split while each part still has hundreds of pages.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id"), F.col("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    bucket = F.pmod(F.xxhash64("host"), F.lit(_HOST_BUCKETS)).cast("int")

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        total += np.bincount(batch.column(0).to_numpy(), minlength=len(total))

    counts = work.dense_sums(rows.select(bucket.alias("bucket")), add, _HOST_BUCKETS)
    salts = np.maximum(counts // (4 * counts.mean() + _SALT_LEAST), 1).astype(np.int64)

    @F.pandas_udf("long")
    def salt_of(bucket: pd.Series, spread: pd.Series) -> pd.Series:
        return pd.Series(spread.to_numpy() % salts[bucket.to_numpy()])

    salted = rows.withColumn("salt", salt_of(bucket, F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40))))
    dealt = (salted.select(F.xxhash64("host", "salt").alias("part"), "page_id", "url", "html")
             .repartition("part").sortWithinPartitions("part", "page_id", "url"))
    schema = dealt.select("page_id", "url").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in (1, 2)]
            for start in range(0, batch.num_rows, CHUNK):
                for row in zip(*(batch.column(i).slice(start, CHUNK).to_pylist() for i in range(4))):
                    if held and held[0][0] != row[0]:
                        yield from last(held, kinds)
                        held = []
                    elif len(held) == 2 * CHUNK:
                        yield finish(held[:CHUNK], kinds)
                        held = held[CHUNK:]
                    held.append(row)
        if held:
            yield from last(held, kinds)

    def last(held: list[tuple], kinds: list) -> Iterator[pa.RecordBatch]:
        """The end of a host: one chunk, or two equal ones, so no small rest is left without a template."""
        half = len(held) if len(held) <= CHUNK else (len(held) + 1) // 2
        for i in range(0, len(held), half):
            yield finish(held[i:i + half], kinds)

    def finish(held: list[tuple], kinds: list) -> pa.RecordBatch:
        texts = extract([row[3] for row in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([row[1] for row in held], kinds[0]), pa.array([row[2] for row in held], kinds[1]), pa.array(texts, pa.string())],
            ["page_id", "url", "text"])

    return dealt.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(work.table(spark, sf_dir, "pages"))
