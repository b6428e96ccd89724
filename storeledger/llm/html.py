"""Main text of web pages: a wrapper is induced from the pages of a host, what varies between them is content."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from html import unescape
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.store import small, staged
from storeledger.llm.text import slices

MIN_PAGES = 4  # distinct ones, for a wrapper
FEW_PAGES = 8  # below that a text is template only if all of them have it
MAX_DEPTH = 200  # elements nested deeper become siblings, their texts stay
KNOWN_SHAPES = 100_000  # pairs of shapes remembered, and then found again
HELD_CHARS = 1 << 22  # of the examples of which a task keeps what it made
COUNTED_ROWS = 100_000  # of marks and elements counted, after which a task hands on its counts
CONSTANT_SHARE = 0.5  # of the distinct pages of a layout that must have a text in the same place for it to be template
MINOR_SHARE = 0.2  # of the varying text beside it, below which a container is no part of the content
NAMED_WEIGHT = 0.125  # of varying text in an element that its name calls furniture, when content is looked for
FEW_CELLS = 4096  # of a table of pairs of siblings, up to which it is held whole
SKETCH = 3  # children of a kind that stand for all of them in a wrapper

# The last group of a token tells its kind: "text", "rest" of an element's start or end, or what is left out.
_TOKEN = re.compile(
    r"(?P<text>[^<]+)"
    r"|<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|iframe|textarea|title|template|svg|xmp)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>"
    r"(?P<held>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|(?P<lone><)",
    re.DOTALL | re.IGNORECASE,
)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.DOTALL | re.IGNORECASE)
_STATE_WORDS = frozenset("has with without no is".split())  # a name with one of these tells what its element has
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

# Fixed values of HTML: elements without content, elements that end a paragraph, elements that end their own kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_PARAGRAPH, _NO_WORDS = frozenset(["p"]), frozenset()
_ENDS_ITSELF = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_LAYOUT = ("article", "main", "section", "aside", "header", "form", "table")  # what tells the layouts of a host apart
_FRAMES = frozenset("html body div section article main form center table tbody tr td".split())  # what may hold the content
_SIDES = _FRAMES | frozenset("aside nav header footer ul ol dl".split())  # what may stand beside it
_HOLDERS = frozenset("ul ol dl table tbody thead tfoot select div article section main body".split())

# What never is an article's text, by element and by words in class, id and role.
_FURNITURE = frozenset("head nav footer aside form button select menu dialog object canvas audio video map".split())
_FURNITURE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary"
    " consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr login masthead menu menubar modal nav navbar"
    " navigation newsletter notice notices notification paginate pagination pager popup promo promotion promoted related"
    " replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags teaser toolbar widget".split()
)


class Node:
    """An element with its children, or a text (tag "#text")."""

    __slots__ = ("children", "ink", "part", "print", "shape", "tag", "text", "up", "words")

    def __init__(self, tag: str, text: str = "", words: frozenset[str] = frozenset()) -> None:
        self.tag, self.text, self.words, self.children = tag, text, words, []
        self.ink = 0  # characters of text below, once measured
        self.print = 0  # a fingerprint of the whole subtree, once made
        self.shape = 0  # a fingerprint of the tags below, once made
        self.part = ""  # in a wrapper: "content" or "beside" it
        self.up: Node | None = None  # the element around, in a parsed page

    def add(self, child: Node) -> None:
        child.up = self
        self.children.append(child)


def parse(html: str | None) -> Node:
    """The elements of a page, forgiving of missing and misplaced ends. Scripts, styles and comments are left out."""
    root = Node("#page")
    stack = [root]
    for found in _TOKEN.finditer(html or ""):
        kind = found.lastgroup
        if kind == "text" or kind == "lone":
            top = stack[-1].children
            if top and top[-1].tag == "#text":
                top[-1].text += found[0]
            else:
                stack[-1].add(Node("#text", found[0]))
            continue
        if kind != "rest":
            continue
        close, tag, rest = found.group("close", "tag", "rest")
        tag = tag.lower()
        if close:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in _BLOCK:
            _close(stack, _PARAGRAPH)
        if tag in _ENDS_ITSELF:
            _close(stack, _ENDS_ITSELF[tag])
        node = Node(tag, words=_words(rest) if "=" in rest else _NO_WORDS)
        stack[-1].add(node)
        if tag not in _VOID and not rest.endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(node)
    return root


def _close(stack: list[Node], tags: frozenset[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in _HOLDERS:
            return


_SEEN_WORDS: dict[str, frozenset[str]] = {}  # of a task, as functions travel by value


def _words(attributes: str) -> frozenset[str]:
    """What class, id and role call an element: whole names, and the last part of names in several parts ("site-footer")."""
    if attributes not in _SEEN_WORDS:
        if len(_SEEN_WORDS) >= 4096:
            _SEEN_WORDS.clear()
        names = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)).lower().split()
        parts = [[part for part in re.split(r"[^a-z]+", name) if part] for name in names]
        _SEEN_WORDS[attributes] = frozenset([*names, *(p[-1] for p in parts if p and not _STATE_WORDS & set(p))])
    return _SEEN_WORDS[attributes]


def _measure(node: Node) -> int:
    """Characters of text in and below a node, without blanks at the ends of texts."""
    total = len(node.text.strip()) if node.text else 0
    for child in node.children:
        total += _measure(child)
    node.ink = total
    return total


def _named_furniture(node: Node) -> bool:
    return node.tag in _FURNITURE or bool(node.words & _FURNITURE_WORDS)


def content(page: Node, held: frozenset[int] = frozenset(), beside: frozenset[int] = frozenset()) -> Node:
    """The page without furniture, cut down to its article or main elements where these hold most of what is left.

    What a wrapper says of an element, that it holds the content (`held`) or stands beside it, goes before its name.
    """
    articles = Node("#page")
    ink = _measure(page)

    def is_furniture(node: Node, inside: bool) -> bool:
        """By the wrapper, then by name. What holds the page cannot be: its root elements, or a form around most of the text."""
        if id(node) in held:
            return False
        if id(node) in beside:
            return True
        if node.tag in ("html", "body", "main", "article") or node.tag == "form" and 2 * node.ink > ink:
            return False
        if _named_furniture(node):
            return True
        page_head = node.tag == "header" or "header" in node.words
        return page_head and not inside

    def collect(node: Node, into: Node) -> None:
        for child in node.children:
            if child.tag in ("article", "main") and id(child) not in beside:
                into.children.append(child)
            elif child.tag != "#text" and not is_furniture(child, True):
                collect(child, into)

    collect(page, articles)

    def cleaned(node: Node, inside: bool) -> Node:
        kept = Node(node.tag, node.text, node.words)
        for child in node.children:
            if child.tag == "#text":
                kept.children.append(child)
            elif not is_furniture(child, inside):
                kept.children.append(cleaned(child, inside or child.tag in ("article", "main")))
        return kept

    def left(node: Node, inside: bool) -> int:
        """The ink that cleaning leaves."""
        if not node.children:
            return node.ink
        kept = (child for child in node.children if child.tag == "#text" or not is_furniture(child, inside))
        return sum(left(child, inside or child.tag in ("article", "main")) for child in kept)

    if articles.children and 2 * left(articles, True) > left(page, False):
        return cleaned(articles, True)
    return cleaned(page, False)


def places(root: Node) -> list[tuple[str, Node]]:
    """Each text with ink, and the elements it stands in."""
    out = []

    def walk(node: Node, path: str) -> None:
        for child in node.children:
            if child.tag == "#text":
                if not child.text.isspace():
                    out.append((path, child))
            else:
                walk(child, f"{path}/{child.tag}")

    walk(root, "")
    return out


def mark(path: str, text: str) -> int:
    """A 64-bit fingerprint of a text in its place."""
    held = f"{path}\n{' '.join(unescape(text).split())}".encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(held, digest_size=8).digest(), "little", signed=True)


def matching(a: Node, b: Node, weights: _Weights | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the largest top-down matching that keeps the order of siblings, and its pairs of texts.

    Nodes match only if their tags are equal and their parents match. Siblings that are equal from either end on, texts
    included, match each other, which loses nothing. Those between are matched whole, in rows of any length: how much of two
    nodes matches depends on their shapes alone, so it is found once for each pair of shapes, and the table of all pairs of
    siblings is filled line by line; of its lines some are kept, from which the others are made again (all of them where rows
    are short). `weights` keeps what was found from one page to the next.
    """
    weights = weights or _Weights()
    weights.forget()
    return weights(a, b), weights.texts(a, b)


def _fingerprint(node: Node) -> int:
    """Equal for equal subtrees of one task: tags, order and texts."""
    if not node.print:
        node.print = hash((node.tag, node.text, *map(_fingerprint, node.children))) or 1
    return node.print


def _shape(node: Node) -> int:
    """Equal for subtrees of equal tags in equal order, within one task."""
    if not node.shape:
        node.shape = hash((node.tag, *map(_shape, node.children))) or 1
    return node.shape


class _Weights:
    """Sizes of the largest matchings of subtrees, by their shapes."""

    def __init__(self) -> None:
        self.sizes: dict[int, int] = {}
        self.known: dict[tuple[int, int], int] = {}

    def size(self, node: Node) -> int:
        shape = _shape(node)
        if shape not in self.sizes:
            self.sizes[shape] = 1 + sum(map(self.size, node.children))
        return self.sizes[shape]

    def __call__(self, a: Node, b: Node) -> int:
        if a.tag != b.tag:
            return 0
        key = _shape(a), _shape(b)
        if key[0] == key[1]:
            return self.size(a)
        if key not in self.known:
            if len(self.known) >= KNOWN_SHAPES:
                self.known.clear()
            low, high = _equal_ends(a.children, b.children, _shape)
            rows, columns = a.children[low : len(a.children) - high], b.children[low : len(b.children) - high]
            total = 1 + sum(map(self.size, a.children[:low])) + sum(map(self.size, a.children[len(a.children) - high :]))
            if len(rows) * len(columns) <= FEW_CELLS:
                total += self.table(rows, columns)[0][-1][-1]
            else:
                for line in self.lines(rows, columns, np.zeros(len(columns) + 1, np.int32)):
                    pass
                total += int(line[-1])
            self.known[key] = total
        return self.known[key]

    def forget(self) -> None:
        if len(self.known) + len(self.sizes) > KNOWN_SHAPES:
            self.known.clear()
            self.sizes.clear()

    def table(self, rows: list[Node], columns: list[Node]) -> tuple[list[list[int]], list[list[int]]]:
        """All lines of the table of best matchings of the first rows with the first columns, and what each pair weighs."""
        lines, weights = [[0] * (len(columns) + 1)], []
        kinds = [(_shape(node), node) for node in columns]
        of_shape: dict[int, list[int]] = {}
        for node in rows:
            shape, line = _shape(node), lines[-1]
            if shape not in of_shape:
                known = {other: self(node, column) for other, column in dict(kinds).items()}
                of_shape[shape] = [known[other] for other, _ in kinds]
            weights.append(of_shape[shape])
            best, below = 0, [0]
            for before, above, weight in zip(line, line[1:], weights[-1]):
                if above > best:
                    best = above
                if weight and before + weight > best:
                    best = before + weight
                below.append(best)
            lines.append(below)
        return lines, weights

    def row(self, node: Node, kinds: list[Node], kind: np.ndarray) -> np.ndarray:
        """What a node's matching with each of a row of siblings weighs; `kinds` has one of each shape among them."""
        return np.array([self(node, other) for other in kinds], np.int32)[kind]

    def lines(self, rows: list[Node], columns: list[Node], line: np.ndarray) -> Iterator[np.ndarray]:
        """The lines below `line` of the table of best matchings of the first rows with the first columns."""
        kinds, kind = _kinds(columns)
        for node in rows:
            weight = self.row(node, kinds, kind)
            below = np.zeros_like(line)
            np.maximum.accumulate(np.maximum(line[1:], line[:-1] + weight), out=below[1:])
            line = below
            yield line

    def texts(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The pairs of texts of the matching."""
        pairs, todo = [], [(a, b)] if a.tag == b.tag else []
        while todo:
            x, y = todo.pop()
            rows, columns = x.children, y.children
            if x.tag == "#text":
                pairs.append((x, y))
            elif _shape(x) == _shape(y):
                todo += zip(rows, columns)
            else:
                low, high = _equal_ends(rows, columns, _fingerprint)
                after = len(rows) - high, len(columns) - high
                todo += [*zip(rows[:low], columns[:low]), *zip(rows[after[0] :], columns[after[1] :])]
                todo += self.siblings(rows[low : after[0]], columns[low : after[1]])
        return pairs

    def siblings(self, rows: list[Node], columns: list[Node]) -> list[tuple[Node, Node]]:
        """The siblings that match, from the last to the first. Every so many lines one is kept, as many as lie between two."""
        if not rows or not columns:
            return []
        if len(rows) * len(columns) <= FEW_CELLS:
            return self.few(rows, columns)
        step = isqrt(len(rows) - 1) + 1
        line = np.zeros(len(columns) + 1, np.int32)
        kept = [line]
        for i, line in enumerate(self.lines(rows, columns, line), 1):
            if i % step == 0:
                kept.append(line)
        kinds, kind = _kinds(columns)
        out, i, j = [], len(rows), len(columns)
        while i and j:
            start = (i - 1) // step * step
            best = [kept[start // step], *self.lines(rows[start:i], columns, kept[start // step])]
            while i > start and j:
                node, value = rows[i - 1], best[i - start][j]
                weight = self(node, kinds[kind[j - 1]])
                if weight and value == best[i - start - 1][j - 1] + weight:
                    out.append((node, columns[j - 1]))
                    i, j = i - 1, j - 1
                elif value == best[i - start - 1][j]:
                    i -= 1
                else:
                    j -= 1
        return out

    def few(self, rows: list[Node], columns: list[Node]) -> list[tuple[Node, Node]]:
        """The same siblings, from the whole table."""
        lines, weights = self.table(rows, columns)
        out, i, j = [], len(rows), len(columns)
        while i and j:
            value, weight = lines[i][j], weights[i - 1][j - 1]
            if weight and value == lines[i - 1][j - 1] + weight:
                out.append((rows[i - 1], columns[j - 1]))
                i, j = i - 1, j - 1
            elif value == lines[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return out


def _equal_ends(rows: list[Node], columns: list[Node], of: Callable[[Node], int]) -> tuple[int, int]:
    """How many siblings are equal from the start on, and how many of the rest from the end on."""
    shorter, low, high = min(len(rows), len(columns)), 0, 0
    while low < shorter and of(rows[low]) == of(columns[low]):
        low += 1
    while high < shorter - low and of(rows[-1 - high]) == of(columns[-1 - high]):
        high += 1
    return low, high


def _kinds(nodes: list[Node]) -> tuple[list[Node], np.ndarray]:
    """One node of each shape, and which of them each node is like."""
    first: dict[int, int] = {}
    kinds, kind = [], []
    for node in nodes:
        shape = _shape(node)
        if shape not in first:
            first[shape] = len(kinds)
            kinds.append(node)
        kind.append(first[shape])
    return kinds, np.array(kind, np.int64)


def blocks(root: Node, dropped: set[int]) -> list[str]:
    """Texts between block boundaries, in page order, with character references decoded and white space made one space."""
    out, held = [], []

    def end() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    def walk(node: Node) -> None:
        for child in node.children:
            if child.tag == "#text":
                if id(child) not in dropped:
                    held.append(unescape(child.text))
            elif child.tag == "br":
                held.append(" ")
            elif child.tag in _BLOCK:
                end()
                walk(child)
                end()
            else:
                walk(child)

    walk(root)
    end()
    return out


def elements(root: Node) -> list[Node]:
    """All elements in page order; an element's place in this list is its number in a wrapper."""
    out = [root]
    for node in out[0].children:
        if node.tag != "#text":
            out += elements(node)
    return out


def _around(pairs: list[tuple[Node, Node]]) -> list[tuple[Node, Node]]:
    """The matched elements around matched texts: parents of matched nodes match."""
    out, seen = [], set()
    for a, b in pairs:
        while a.up is not None and id(a.up) not in seen:
            a, b = a.up, b.up
            seen.add(id(a))
            out.append((a, b))
    return out


def wrapper(example: str, varied: tuple[tuple[int, float, bool], ...]) -> Node:
    """The example page's tree as a pattern: what holds the content and what stands beside it are marked.

    `varied` lists elements by number, with their varying text outside links, summed over pages, and whether most pages
    have them. From the root on, the way leads into the container with more than half of the varying text, as far as there
    is one or to an article or main element. Containers beside that way that most pages have and that hold little varying
    text are not content. Where names call an element furniture its text counts an eighth, so that they decide between
    elements with similar amounts. Of equal children in a row the first few stay, to be recognised by.
    """
    root = parse(example)
    numbered = elements(root)
    ink = {id(numbered[i]): amount for i, amount, _ in varied}
    usual = {id(numbered[i]) for i, _, most in varied if most}
    weight = {at: amount * (NAMED_WEIGHT if _named_furniture(node) else 1) for node in numbered if (at := id(node)) in ink and (amount := ink[at])}
    node = root
    while node.tag not in ("article", "main"):
        inner = [child for child in node.children if child.tag != "#text"]
        whole = ink.get(id(node), 0) + sum(weight.get(id(c), 0) - ink.get(id(c), 0) for c in inner)
        best = max((c for c in inner if c.tag in _FRAMES), key=lambda c: weight.get(id(c), 0), default=None)
        if best is None or 2 * weight.get(id(best), 0) <= whole or not whole:
            break
        best.part = "content"
        for child in inner:
            if child.tag in _SIDES and child is not best and id(child) in usual and weight.get(id(child), 0) < MINOR_SHARE * weight[id(best)]:
                child.part = "beside"
        node = best
    for each in numbered:
        kinds: Counter = Counter()
        kept = []
        for child in each.children:
            kinds[child.tag] += 1
            if child.part or kinds[child.tag] <= SKETCH:
                kept.append(child)
        each.children = kept
    return root


def main_text(
    html: str | None, template: frozenset[int] = frozenset(), pattern: Node | None = None, weights: _Weights | None = None
) -> str:
    """The page's content without its template texts, blocks joined by a line feed.

    With a wrapper as `pattern`, elements that match what stands beside the content go, and those that match what holds it
    stay, whatever they are called; but none goes that has over half of this page's text.
    """
    page = parse(html)
    constant = {id(node) for path, node in places(page) if mark(path, node.text) in template} if template else set()
    held, beside = set(), set()
    if pattern is not None:
        ink = _measure(page)
        for a, b in _around(matching(pattern, page, weights)[1]):
            if a.part == "content":
                held.add(id(b))
            elif a.part == "beside" and 2 * b.ink <= ink:
                beside.add(id(b))
    return "\n".join(blocks(content(page, frozenset(held), frozenset(beside)), constant))


def _layout(html: str) -> Column:
    """A number for the kinds of containers that a page has."""
    flags = (F.when(F.contains(F.col(html), F.lit(f"<{tag}")), 1 << i).otherwise(0) for i, tag in enumerate(_LAYOUT))
    return reduce(lambda a, b: a + b, flags)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = CONSTANT_SHARE) -> DataFrame:
    """host, layout, example, marks, varied: wrappers of the layouts of hosts with `min_pages` distinct pages (host, html).

    One page of each layout of a host, that of the smallest hash, is matched whole with every page of it. A text of that
    page is template if more than `share` of the distinct pages (below FEW_PAGES: all) have the same text in the matched
    place; pages of equal title and longest text are copies and count once. Only counts leave the tasks, so a host of a
    third of all pages is matched wherever its pages lie.
    """
    known = pages.where(F.col("host").isNotNull() & F.col("html").isNotNull())
    known = known.withColumns({"hash": F.xxhash64("html"), "layout": _layout("html")})
    key = ["host", "layout"]
    picked = known.groupBy(key).agg(F.min("hash").alias("hash"), F.count("*").alias("pages"))
    picked = picked.where(F.col("pages") >= min_pages).drop("pages")
    example = known.join(small(picked, F.octet_length("host") + 16), [*key, "hash"]).groupBy(key)
    example = small(example.agg(F.max("html").alias("example")), F.octet_length("example") + 64)
    matched = known.select("host", "layout", "html").join(example, key).select("host", "layout", "html", "example")
    found = staged(matched.mapInArrow(_agreements, "host string, layout int, voice long, mark long, node int, pages long, ink double"))
    voices = found.where(F.col("voice").isNotNull() & F.col("mark").isNull()).groupBy(key).agg(F.countDistinct("voice").alias("voices"))
    voices = staged(voices.where(F.col("voices") >= min_pages))
    wanted = F.when(F.col("voices") < FEW_PAGES, F.col("voices")).otherwise(F.floor(share * F.col("voices")) + 1)
    agreed = found.where(F.col("mark").isNotNull()).groupBy(*key, "mark").agg(F.countDistinct("voice").alias("agreeing"))
    agreed = agreed.join(voices, key).where(F.col("agreeing") >= wanted).groupBy(key).agg(F.collect_list("mark").alias("marks"))
    seen = found.where(F.col("node").isNotNull()).groupBy(*key, "node").agg(F.sum("pages").alias("pages"), F.sum("ink").alias("ink"))
    root = seen.where("node = 0").select(*key, F.col("pages").alias("all"))
    most = F.struct("node", "ink", (2 * F.col("pages") > F.col("all")).alias("most"))
    varied = seen.join(root, key).groupBy(key).agg(F.collect_list(most).alias("varied"))
    return voices.select(key).join(example, key).join(varied, key, "left").join(agreed, key, "left")


_COUNTED = ("host", "layout", "voice", "mark", "node", "pages", "ink")
_COUNTED_KINDS = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64())


class _Recent:
    """What `make` makes of the wrapper columns of a row, once for each layout of a host and not for each row.

    The layouts used last stay, as many as have `HELD_CHARS` characters of examples; the very last one stays in any case.
    """

    def __init__(self, make: Callable, *columns: str) -> None:
        self.make, self.columns, self.chars = make, columns, 0
        self.held: dict[tuple, tuple] = {}

    def __call__(self, part: pa.RecordBatch, row: int, key: tuple[str, int]) -> tuple:
        if key in self.held:
            self.held[key] = self.held.pop(key)
            return self.held[key][1]
        given = [part.column(name)[row].as_py() for name in self.columns]
        size = len(given[0] or "") + 1024
        self.chars += size
        while self.held and self.chars > HELD_CHARS:
            self.chars -= self.held.pop(next(iter(self.held)))[0]
        self.held[key] = size, self.make(*given)
        return self.held[key][1]


def _agreements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page its voice (title and longest text), the template's texts it has, and what varies below each element."""

    def example(html: str) -> tuple[Node, dict[int, int], dict[int, str]]:
        root = parse(html)
        return root, {id(node): i for i, node in enumerate(elements(root))}, {id(node): where for where, node in places(root)}

    made, weights = _Recent(example, "example"), _Weights()
    said: set[tuple] = set()
    pages: Counter = Counter()
    inks: Counter = Counter()

    def counted() -> pa.RecordBatch:
        rows = [(*row, None, None, None) for row in said]
        rows += [(host, layout, None, None, node, count, float(inks[host, layout, node])) for (host, layout, node), count in pages.items()]
        columns = list(zip(*rows)) if rows else [[] for _ in _COUNTED]
        for held in (said, pages, inks):
            held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _COUNTED_KINDS)], list(_COUNTED))

    for batch in batches:
        for part in slices(batch, "html"):
            for i, (host, layout, html) in enumerate(zip(*(part.column(name).to_pylist() for name in ("host", "layout", "html")))):
                key = host, layout
                (pattern, number, path), page = made(part, i, key), parse(html)
                texts = places(page)
                longest = max((node.text for _, node in texts), key=len, default="")
                title = " ".join(_TITLE.findall(html)[:1])
                voice = mark(title, longest)
                said.add((*key, voice, None))
                pairs = matching(pattern, page, weights)[1]
                equal = [(a, b) for a, b in pairs if id(a) in path and _same(a.text, b.text)]
                said.update((*key, voice, mark(path[id(a)], a.text)) for a, _ in equal)
                varying = _varying(page, {id(b) for _, b in equal})
                for a, b in _around(pairs):
                    pages[*key, number[id(a)]] += 1
                    inks[*key, number[id(a)]] += varying.get(id(b), 0)
                if len(said) + len(pages) >= COUNTED_ROWS:
                    yield counted()
    yield counted()


def _varying(page: Node, equal: set[int]) -> dict[int, int]:
    """For each element the characters of text below it that are neither template nor in links."""
    out: dict[int, int] = {}

    def below(node: Node) -> int:
        total = 0
        for child in node.children:
            if child.tag == "#text":
                total += 0 if id(child) in equal else len(child.text.strip())
            elif child.tag != "a":
                total += below(child)
        out[id(node)] = total
        return total

    below(page)
    return out


def _same(a: str, b: str) -> bool:
    return a == b or a.lstrip()[:1] == b.lstrip()[:1] and a.split() == b.split()


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`pages` with `text`, the main text of the whole page, in place of the html.

    The text is empty for null or empty html and for pages without an article. Hosts come from the url in lower case; pages
    without one, and layouts of fewer than four distinct pages, have no wrapper and are cleared of furniture only: menus,
    footers, sidebars, forms, adverts and comments known by element or by class, id and role. All rows and other columns
    stay; a given `text` is replaced.
    """
    names = [c for c in pages.columns if c not in (html, "text")]
    host = F.lower(F.expr(f"try_parse_url(`{url}`, 'HOST')"))
    wrappers = templates(pages.select(host.alias("host"), F.col(html).alias("html")))
    size = F.octet_length("example") + F.coalesce(F.size("marks"), F.lit(0)) * 8 + F.coalesce(F.size("varied"), F.lit(0)) * 16 + 64
    rows = pages.select(
        *[F.col(c).alias(f"given{i}") for i, c in enumerate(names)], F.col(html).alias("html"), host.alias("host"), _layout(html).alias("layout")
    )
    joined = rows.join(small(wrappers, size), ["host", "layout"], "left")
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(example: str | None, marks: list[int] | None, varied: list[dict] | None) -> tuple[frozenset[int], Node | None]:
            numbers = tuple(sorted((v["node"], v["ink"], v["most"]) for v in varied or ()))
            return frozenset(marks or ()), wrapper(example, numbers) if example else None

        held, weights = _Recent(made, "example", "marks", "varied"), _Weights()
        for batch in batches:
            for part in slices(batch, "html"):
                out = []
                for i, (host, layout, html) in enumerate(zip(*(part.column(name).to_pylist() for name in ("host", "layout", "html")))):
                    template, pattern = held(part, i, (host, layout))
                    out.append(main_text(html, template, pattern if html else None, weights))
                kept = part.select([f"given{i}" for i in range(len(names))]).columns
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string())], [*names, "text"])

    return joined.mapInArrow(texts, f"{fields}, text string")
