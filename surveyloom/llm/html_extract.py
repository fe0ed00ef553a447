"""HTML extraction by wrapper induction over the pages of a host.

Pages of one layout of a host are made by one program, so their DOM trees align. The wrapper of a
layout is a tree grown over several of its pages; every page is aligned with it by simple tree
matching: two nodes match if their elements do, and their children are matched in order so that as
many nodes as possible match, those of equal class names first. A text slot of the wrapper that holds
the same text on (nearly) all pages is template; slots that vary are content. What a slot's place
says stands beside that: menus, page headers, footers, sidebars, notices, adverts, forms, comments and
the like vary too, and are left out by element, class, id or role. Where a page has an article or
main element, content is looked for there.

**Layouts.** Pages of a host are grouped by the elements and names at the top of their trees (names
of html and body apart, which tell sections). Groups of fewer than ``LEAST_PAGES`` other pages are put
together by elements alone, and what is left by host. A wrapper starts from the page of least hash
and grows by the least page of each of ``GROWN - 1`` shares of the group: nodes that do not match are
put in where they stand.

**Trees** hold block elements only; formatting within a line belongs to the text of its block, and
neighbours of one label are one node, the repeated item of a list. A page's tree is a few dozen
labels and text hashes, so matching ships these and not the pages: trees are joined with the wrapper
of their layout (a skewed join that adaptive execution splits for a large host), counts per slot are
combined before they are shuffled, and only pages that do hold template text get a row back.
Equal subtrees are one class, and classes are compared, not nodes; lists of children lose their
common begin and end first, and long rests are divided (Hirschberg), so memory follows the page.

**When nothing is template.** Equal pages are counted once, and pages that equal the wrapper in all
their text say nothing. A slot is template only if at least ``LEAST_PAGES`` pages and ``SHARE`` of the
layout's pages hold it and ``CONSTANT`` of these agree; headings never are, since near copies share
them. A page alone on its host is judged by its elements only.

**Forms** are left out unless an article or main element stands in them or more than half of the
page's text does: some servers put a form around the whole page.

Null or empty html gives an empty text; a null url is a host of its own kind (the empty host).
Null page ids and repeated rows are passed through. Other columns are ignored. Elements may be
nested and nodes be wide to any extent: both are aligned exactly.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.batches import map_batches
from surveyloom.sources.workspace import written

LEAST_PAGES = 3
CONSTANT = 0.95
#: Share of a layout's pages that a template slot stands on.
SHARE = 0.2
#: Pages that a wrapper is grown from.
GROWN = 16
#: Depth down to which elements tell a layout; the children of body are at 3.
LAYOUT_DEPTH = 3
#: Cells up to which children of two nodes are aligned by a table; beyond, lists are divided.
TABLE = 1 << 20
#: Weight of a matched node; class names decide among as many nodes.
NODE = 1 << 24

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img ruby rt rp".split()
)
LEFT_OUT = frozenset(
    "head script style title noscript template nav footer aside button select option "
    "textarea input iframe object embed svg math canvas audio video menu dialog fieldset map "
    "noembed noframes xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Opening one of these closes an open element of the same kind (or a paragraph).
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
#: Words of classes, ids and roles that say what a part is.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside "
    "cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup "
    "login search share sharing social related recommended comment comments respond replies "
    "disqus widget pagination pager toolbar copyright contentinfo complementary toc commentlist "
    "usercomments adsense adslot adbox sidenav subnav topnav mainnav submenu cookiebar "
    "cookiebanner gdpr sitefooter".split()
)
#: Words and the element of a page's head; inside an article they may hold its title.
HEADS = frozenset("header masthead topbar siteheader pageheader".split())
#: Words that beside those above leave a name what it is: a "main-nav" is one, a "no-sidebar" is not.
NEUTRAL = frozenset(
    "site main page global top left right bottom upper lower primary secondary first second wrapper "
    "wrap container holder box block area section inner outer list item items bar panel group row "
    "col column region zone unit slot link links button buttons icon icons title head form menu "
    "fixed sticky mobile desktop small large dark light policy message media the my js".split()
)
NAMED = NEUTRAL | BOILERPLATE | HEADS
#: Their names tell the state of a page, not what they are.
WHOLE = frozenset(["html", "body"])
BODIES = frozenset(["main", "article"])
#: Characters that can't follow the angle bracket of a tag.
NO_NAME = frozenset(["", *"<> \t\n\r=0123456789&.,;:-+*\"'"])
_WORDS = re.compile(r"[A-Za-z]+")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(
    r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
)
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)


class Page(NamedTuple):
    """Block elements of a page and its pieces of text.

    ``labels`` and ``parents`` are by node; ``left_out`` and ``in_article`` hold for the node and
    what lies below. ``pieces`` are ``(node, text)`` in page order, one for each block of text.
    """

    labels: list[str]
    parents: list[int]
    left_out: list[bool]
    in_article: list[bool]
    pieces: list[tuple[int, str]]


def _says(token: str, words: frozenset[str]) -> bool:
    """Whether a class, id or role is one of the words, or a compound of one and neutral words."""
    found = _WORDS.findall(token)
    return not words.isdisjoint(found) and NAMED.issuperset(found)


def _label(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Label of an element, whether it says that it is no content, and whether it is a page's head."""
    names: list[str] = []
    tokens: list[str] = []
    hidden = False
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id", "role"):
            if key != "id" or not any(c.isdigit() for c in value):
                tokens += value.split()
                names += _WORDS.findall(value)
        elif key == "hidden" or (key == "style" and _NOT_SHOWN.search(value)):
            hidden = hidden or tag not in WHOLE
        elif key == "aria-hidden" and value.strip() == "true":
            hidden = hidden or tag not in WHOLE | BODIES
    if tag in WHOLE:
        other = head = False
    elif tag in BODIES:
        other, head = not BOILERPLATE.isdisjoint(tokens), False
    else:
        other = any(_says(t, BOILERPLATE) for t in tokens)
        head = tag in HEADS or any(_says(t, HEADS) for t in tokens)
    return ".".join([tag, *names]), other or hidden, head


def parse(html: str) -> Page:
    """The blocks of a page. Never fails: what is no markup is text."""
    page = Page(["#"], [-1], [False], [False], [])
    stack, tags = [0], ["#"]
    forms: list[int] = []
    open_at: dict[str, list[int]] = {}  # places of open elements by tag, innermost last
    text: list[str] = []

    def flush() -> None:
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                page.pieces.append((stack[-1], joined))
            text.clear()

    def close(until: int) -> None:
        flush()
        for tag in tags[until:]:
            open_at[tag].pop()
        del stack[until:], tags[until:]

    def innermost(*wanted: str) -> int:
        return max((open_at[t][-1] for t in wanted if open_at.get(t)), default=0)

    tag_pattern, at, n = _TAG, 0, len(html)
    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            text.append(html[at:])
            break
        if mark > at:
            text.append(html[at:mark])
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = end + 3 if end >= 0 else n
            continue
        if html.startswith(("<!", "<?"), mark):
            end = html.find(">", mark)
            at = end + 1 if end >= 0 else n
            continue
        found = tag_pattern.match(html, mark) if html[mark + 1 : mark + 2] not in NO_NAME else None
        if found is None:
            if html.find(">", mark) < 0:
                text.append(html[mark:])  # no tag can end any more
                break
            if tag_pattern is _TAG and _PLAIN_TAG.match(html, mark):
                tag_pattern = _PLAIN_TAG  # a quote is never closed: from here on they mean nothing
                continue
            text.append("<")
            at = mark + 1
            continue
        at = found.end()
        closing, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
        if tag == "br":
            text.append(" ")
        elif tag in INLINE:
            continue
        elif closing:
            if open_at.get(tag):
                close(innermost(tag))
            else:
                flush()
        elif tag in VOID:
            flush()
        else:
            flush()
            if tag in SIBLINGS:
                sibling = innermost(*SIBLINGS[tag])
                if sibling > innermost("ul", "ol", "dl", "table", "select"):
                    close(sibling)
            elif tags[-1] == "p":
                close(len(tags) - 1)
            label, other, head = _label(tag, attributes)
            parent = stack[-1]
            inside = page.in_article[parent]
            out = tag in LEFT_OUT or other or (not inside and head)
            page.labels.append(label)
            page.parents.append(parent)
            page.left_out.append(page.left_out[parent] or out)
            page.in_article.append(inside or tag in BODIES)
            if tag == "form":
                forms.append(len(page.labels) - 1)
            if tag in RAW:
                end = re.compile(f"</{tag}", re.I).search(html, at)
                stop = html.find(">", end.start()) if end else -1
                at = stop + 1 if stop >= 0 else n
            elif not attributes.endswith("/"):
                open_at.setdefault(tag, []).append(len(tags))
                stack.append(len(page.labels) - 1)
                tags.append(tag)
    flush()
    if forms:
        _leave_out_forms(page, forms)
    return page


def _leave_out_forms(page: Page, forms: list[int]) -> None:
    """Marks forms that do not hold the page itself."""
    chars, holds = [0] * len(page.labels), [False] * len(page.labels)
    for node, text in page.pieces:
        chars[node] += 0 if page.left_out[node] else len(text)
    for node in range(len(page.labels) - 1, 0, -1):
        body = page.labels[node].split(".", 1)[0] in BODIES and not page.left_out[node]
        holds[page.parents[node]] |= holds[node] or body
        chars[page.parents[node]] += chars[node]
    out = {n for n in forms if not holds[n] and 2 * chars[n] <= chars[0]}
    if out:
        for node in range(1, len(page.labels)):
            page.left_out[node] |= node in out or page.left_out[page.parents[node]]


class Tree(NamedTuple):
    """A collapsed tree in document order, with a hash of the text of each node (0: none)."""

    labels: list[str]
    parents: list[int]
    texts: list[int]


def collapse(page: Page) -> tuple[Tree, list[int]]:
    """Neighbours of one label become one node; also the collapsed node of each node."""
    children: list[list[int]] = [[] for _ in page.labels]
    for node, parent in enumerate(page.parents):
        if parent >= 0:
            children[parent].append(node)
    own: list[list[str]] = [[] for _ in page.labels]
    for node, text in page.pieces:
        own[node].append(text)
    tree, of = Tree([], [], []), [0] * len(page.labels)
    todo: list[tuple[list[int], int]] = [([0], -1)]
    while todo:
        group, parent = todo.pop()
        number = len(tree.labels)
        tree.labels.append(page.labels[group[0]])
        tree.parents.append(parent)
        texts = [t for node in group for t in own[node]]
        digest = xxhash.xxh64_intdigest("\n".join(texts)) >> 1 if texts else 0
        tree.texts.append(digest or (1 if texts else 0))
        below: list[list[int]] = []
        for node in group:
            of[node] = number
            for child in children[node]:
                if below and page.labels[below[-1][0]] == page.labels[child]:
                    below[-1].append(child)
                else:
                    below.append([child])
        todo += [(g, number) for g in reversed(below)]
    return tree, of


class Shapes:
    """Classes of equal subtrees, numbered so that what lies below has smaller numbers."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[str, tuple[int, ...]], int] = {}
        self.labels: list[str] = []
        self.tags: list[str] = []
        self.below: list[tuple[int, ...]] = []
        self.weights: list[int] = []

    def of(self, tree: Tree, children: list[list[int]]) -> list[int]:
        """The class of each node of a tree."""
        out = [0] * len(tree.labels)
        for node in range(len(tree.labels) - 1, -1, -1):
            key = (tree.labels[node], tuple([out[c] for c in children[node]]))
            number = self.numbers.get(key)
            if number is None:
                number = self.numbers[key] = len(self.labels)
                self.labels.append(key[0])
                self.tags.append(key[0].split(".", 1)[0])
                self.below.append(key[1])
                self.weights.append(NODE + 1 + sum(self.weights[c] for c in key[1]))
            out[node] = number
        return out


class Matching:
    """Weights of the best matchings of classes, each computed once."""

    def __init__(self, shapes: Shapes) -> None:
        self.shapes = shapes
        self.known: dict[tuple[int, int], int] = {}

    def prepare(self, x: int, y: int) -> None:
        """Weights of all pairs that can be met below a pair, smallest first."""
        below, tags = self.shapes.below, self.shapes.tags
        todo, met = [(x, y)], {(x, y)}
        while todo:
            a, b = todo.pop()
            by_tag: dict[str, set[int]] = {}
            for j in below[b]:
                by_tag.setdefault(tags[j], set()).add(j)
            for i in set(below[a]) if by_tag else ():
                new = {(i, j) for j in by_tag.get(tags[i], ()) if i != j} - met
                met |= new
                todo += new
        for a, b in sorted(met):
            if a != b and (a, b) not in self.known:
                same = self.shapes.labels[a] == self.shapes.labels[b]
                self.known[a, b] = NODE + same + self.total(list(below[a]), list(below[b]))

    def weight(self, a: int, b: int) -> int:
        """Of two classes; 0 where their elements differ."""
        if a == b:
            return self.shapes.weights[a]
        return self.known.get((a, b), 0) if self.shapes.tags[a] == self.shapes.tags[b] else 0

    def _ends(self, left: list[int], right: list[int]) -> tuple[int, int]:
        """Lengths of the common begin and end: equal ones are best matched with each other."""
        shorter = min(len(left), len(right))
        first = next((k for k in range(shorter) if left[k] != right[k]), shorter)
        last = next((k for k in range(shorter - first) if left[-1 - k] != right[-1 - k]), shorter - first)
        return first, last

    def _row(self, left: list[int], right: list[int]) -> np.ndarray:
        """Best weight of all of ``left`` with each beginning of ``right``."""
        row = np.zeros(len(right) + 1, np.int64)
        kinds, places = np.unique(np.array(right), return_inverse=True)
        weights: dict[int, np.ndarray] = {}
        for a in left:
            if a not in weights:
                weights[a] = np.array([self.weight(a, int(b)) for b in kinds], np.int64)[places]
            row[1:] = np.maximum(row[1:], row[:-1] + weights[a])
            np.maximum.accumulate(row, out=row)
        return row

    def total(self, left: list[int], right: list[int]) -> int:
        first, last = self._ends(left, right)
        same = sum(self.shapes.weights[c] for c in left[:first] + left[len(left) - last :])
        left, right = left[first : len(left) - last], right[first : len(right) - last]
        if not left or not right:
            return same
        return same + int(self._row(left, right)[-1])

    def pairs(self, left: list[int], right: list[int]) -> list[tuple[int, int]]:
        """Places that the best matching of two lists of classes puts together."""
        out: list[tuple[int, int]] = []
        todo = [(0, len(left), 0, len(right))]
        while todo:
            a, b, c, d = todo.pop()
            first, last = self._ends(left[a:b], right[c:d])
            out += [(a + k, c + k) for k in range(first)]
            out += [(b - 1 - k, d - 1 - k) for k in range(last)]
            a, b, c, d = a + first, b - last, c + first, d - last
            if a == b or c == d:
                continue
            if b - a == 1 or (b - a) * (d - c) <= TABLE:
                out += [(a + i, c + j) for i, j in self._table(left[a:b], right[c:d])]
                continue
            middle = (a + b) // 2
            forth = self._row(left[a:middle], right[c:d])
            back = self._row(left[middle:b][::-1], right[c:d][::-1])
            cut = c + int((forth + back[::-1]).argmax())
            todo += [(a, middle, c, cut), (middle, b, cut, d)]
        return out

    def _table(self, left: list[int], right: list[int]) -> list[tuple[int, int]]:
        kinds, places = np.unique(np.array(right), return_inverse=True)
        rows = np.zeros((len(left) + 1, len(right) + 1), np.int64)
        for i, a in enumerate(left):
            weights = np.array([self.weight(a, int(b)) for b in kinds], np.int64)[places]
            rows[i + 1] = rows[i]
            rows[i + 1, 1:] = np.maximum(rows[i, 1:], rows[i, :-1] + weights)
            np.maximum.accumulate(rows[i + 1], out=rows[i + 1])
        out = []
        i, j = len(left), len(right)
        while i and j:
            if rows[i, j] == rows[i - 1, j]:
                i -= 1
            elif rows[i, j] == rows[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((i, j))
        return out


def align(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Matching pairs of nodes by simple tree matching, so that as many as possible match."""
    below_a, below_b = _children(a), _children(b)
    shapes = Shapes()
    kind_a, kind_b = shapes.of(a, below_a), shapes.of(b, below_b)
    if shapes.tags[kind_a[0]] != shapes.tags[kind_b[0]]:
        return []
    matching = Matching(shapes)
    matching.prepare(kind_a[0], kind_b[0])
    out: list[tuple[int, int]] = []
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        left, right = below_a[x], below_b[y]
        if kind_a[x] == kind_b[y]:
            todo += zip(left, right)
        elif left and right:
            found = matching.pairs([kind_a[i] for i in left], [kind_b[j] for j in right])
            todo += [(left[i], right[j]) for i, j in found]
    return out


def grow(wrapper: Tree, page: Tree) -> Tree:
    """The wrapper with the nodes of a page that match none of its own, each where it stands."""
    below, below_page = [list(c) for c in _children(wrapper)], _children(page)
    labels, texts = list(wrapper.labels), list(wrapper.texts)
    partner = {y: x for x, y in align(wrapper, page)}

    def copied(node: int) -> int:
        """Adds a subtree; its nodes are numbered after those of the wrapper."""
        number, todo = len(labels), [(node, -1)]
        while todo:
            old, parent = todo.pop()
            labels.append(page.labels[old])
            texts.append(page.texts[old])
            below.append([])
            if parent >= 0:
                below[parent].append(len(labels) - 1)
            todo += [(c, len(labels) - 1) for c in reversed(below_page[old])]
        return number

    for y, x in partner.items():
        texts[x] = texts[x] or page.texts[y]
        at = 0
        for child in below_page[y]:
            if child in partner:
                at = below[x].index(partner[child], at) + 1
            else:
                below[x].insert(at, copied(child))
                at += 1
    # Document order again.
    out, todo = Tree([], [], []), [(0, -1)]
    while todo:
        node, parent = todo.pop()
        out.labels.append(labels[node])
        out.parents.append(parent)
        out.texts.append(texts[node])
        todo += [(c, len(out.labels) - 1) for c in reversed(below[node])]
    return out


def layouts_of(tree: Tree) -> tuple[int, int]:
    """Digests of the top of a tree: with names (but those of html and body), and without."""
    named, plain = {""}, {""}
    paths = [("", "", 0)]
    for node in range(1, len(tree.labels)):
        above, above_plain, depth = paths[tree.parents[node]]
        label = tree.labels[node]
        tag = label.split(".", 1)[0]
        own = (f"{above}/{tag if tag in WHOLE else label}", f"{above_plain}/{tag}", depth + 1)
        paths.append(own)
        if own[2] <= LAYOUT_DEPTH:
            named.add(own[0])
            plain.add(own[1])
    return tuple(xxhash.xxh64_intdigest("\n".join(sorted(x))) >> 1 for x in (named, plain))


def _children(tree: Tree) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in tree.labels]
    for node, parent in enumerate(tree.parents):
        if parent >= 0:
            out[parent].append(node)
    return out


def content(page: Page, template: frozenset[int], of: list[int]) -> str:
    """Text of a page: the blocks that are neither left out nor template, in page order."""
    usable = [
        (node, text) for node, text in page.pieces
        if not page.left_out[node] and of[node] not in template
    ]
    if any(page.in_article[node] for node, _ in usable):
        usable = [(node, text) for node, text in usable if page.in_article[node]]
    return " ".join([text for _, text in usable])


def host_of(url: Column) -> Column:
    """Host of a url in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)),
                      F.lit(""))


TREE = "labels array<string>, parents array<int>, texts array<long>"
LAYOUT = "host string, named long, plain long"


def page_trees(pages: DataFrame) -> DataFrame:
    """``page_key``, host, layout digests and the collapsed tree of each page; equal pages once."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            trees = [collapse(parse(h or ""))[0] for h in batch.column("html").to_pylist()]
            layouts = [layouts_of(t) for t in trees]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("host"), pa.array([n for n, _ in layouts], pa.int64()),
                    pa.array([p for _, p in layouts], pa.int64()), batch.column("page_key"),
                    *_columns(trees),
                ],
                names=["host", "named", "plain", "page_key", "labels", "parents", "texts"],
            )

        return run

    trees = map_batches(
        pages.select("host", "page_key", "html"), make, f"{LAYOUT}, page_key long, {TREE}"
    )
    return trees.dropDuplicates(["page_key"])


def _columns(trees: list[Tree]) -> list[pa.Array]:
    return [
        pa.array([t.labels for t in trees], pa.list_(pa.string())),
        pa.array([t.parents for t in trees], pa.list_(pa.int32())),
        pa.array([t.texts for t in trees], pa.list_(pa.int64())),
    ]


def layout_groups(trees: DataFrame) -> DataFrame:
    """``host, named, plain, layout``: the group in which the pages of a layout get their wrapper.

    ``layout`` is null where even the rest of a host is too small for one.
    """
    counted = trees.groupBy("host", "named", "plain").agg(F.count(F.lit(1)).alias("pages"))
    enough = F.col("pages") > LEAST_PAGES
    small = counted.where(~enough)
    by_plain = small.groupBy("host", "plain").agg(F.sum("pages").alias("of_plain"))
    rest = by_plain.where(F.col("of_plain") <= LEAST_PAGES).groupBy("host").agg(
        F.sum("of_plain").alias("of_host")
    )
    layout = (
        F.when(enough, F.concat_ws("|", F.lit("named"), "host", "named"))
        .when(F.col("of_plain") > LEAST_PAGES, F.concat_ws("|", F.lit("plain"), "host", "plain"))
        .when(F.col("of_host") > LEAST_PAGES, F.concat_ws("|", F.lit("host"), "host"))
    )
    joined = counted.join(by_plain, ["host", "plain"], "left").join(rest, "host", "left")
    return joined.select("host", "named", "plain", layout.alias("layout"))


def wrappers_of(trees: DataFrame) -> DataFrame:
    """``w_layout`` and the wrapper of each layout, grown from the least page of each share of it."""
    tree = F.struct("page_key", "labels", "parents", "texts")
    least = trees.groupBy("layout", F.pmod("page_key", F.lit(GROWN)).alias("share")).agg(
        F.min_by(tree, "page_key").alias("t")
    )
    some = least.groupBy("layout").agg(F.sort_array(F.collect_list("t")).alias("trees"))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            grown = []
            for pages in batch.column("trees"):
                found = [Tree(p["labels"], p["parents"], p["texts"]) for p in pages.as_py()]
                wrapper = found[0]
                for page in found[1:]:
                    wrapper = grow(wrapper, page)
                grown.append(wrapper)
            return pa.RecordBatch.from_arrays(
                [batch.column("layout"), *_columns(grown)],
                names=["w_layout", "w_labels", "w_parents", "w_texts"],
            )

        return run

    named = ", ".join(f"w_{part}" for part in TREE.split(", "))
    return map_batches(some, make, f"w_layout string, {named}")


#: Stands for the pages of a layout in counts of slots.
_ALL = -1


def _slot_counts(paired: DataFrame) -> DataFrame:
    """``layout, slot, same, pages``: how often a wrapper slot holds the wrapper's own text.

    Pages whose texts all equal the wrapper's are left out. Counts are combined in each batch.
    """

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[tuple[str, int], list[int]] = {}
            for row in batch.to_pylist():
                wrapper, tree = _both(row)
                pairs = align(wrapper, tree)
                slots = [(x, wrapper.texts[x] == tree.texts[y]) for x, y in pairs if tree.texts[y]]
                if all(same for _, same in slots) and len(pairs) == len(tree.labels):
                    continue
                for slot, same in [*slots, (_ALL, False)]:
                    count = counts.setdefault((row["layout"], slot), [0, 0])
                    count[0] += same
                    count[1] += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _ in counts], pa.string()),
                    pa.array([s for _, s in counts], pa.int32()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                ],
                names=["layout", "slot", "same", "pages"],
            )

        return run

    return map_batches(paired, make, "layout string, slot int, same long, pages long")


def _both(row: dict) -> tuple[Tree, Tree]:
    wrapper = Tree(row["w_labels"], row["w_parents"], row["w_texts"])
    return wrapper, Tree(row["labels"], row["parents"], row["texts"])


def _template_nodes(paired: DataFrame) -> DataFrame:
    """``page_key, template``: nodes of a page that hold template text, where there are any."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, nodes = [], []
            for row in batch.to_pylist():
                wrapper, tree = _both(row)
                slots = set(row["slots"])
                found = [
                    y for x, y in align(wrapper, tree)
                    if x in slots and tree.texts[y] == wrapper.texts[x]
                ]
                if found:
                    keys.append(row["page_key"])
                    nodes.append(sorted(found))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(nodes, pa.list_(pa.int32()))],
                names=["page_key", "template"],
            )

        return run

    return map_batches(paired, make, "page_key long, template array<int>")


def induce_templates(trees: DataFrame) -> DataFrame:
    """``page_key, template`` of the pages that hold template text."""
    groups = written(layout_groups(trees).where("layout IS NOT NULL"), "page-layouts")
    grouped = trees.join(groups, ["host", "named", "plain"]).select(
        "layout", "page_key", "labels", "parents", "texts"
    )
    wrappers = written(wrappers_of(grouped), "wrappers")
    own = F.col("layout") == F.col("w_layout")
    counts = written(
        _slot_counts(grouped.join(wrappers, own).drop("w_layout"))
        .groupBy("layout", "slot").agg(F.sum("same").alias("same"), F.sum("pages").alias("pages")),
        "slot-counts",
    )
    pages = counts.where(F.col("slot") == _ALL).select(
        F.col("layout").alias("p_layout"), F.col("pages").alias("all_pages")
    )
    tag = F.substring_index(F.element_at("w_labels", F.col("slot") + 1), ".", 1)
    slots = (
        counts.where((F.col("slot") != _ALL) & (F.col("pages") >= LEAST_PAGES))
        .where(F.col("same") >= CONSTANT * F.col("pages"))
        .join(pages, F.col("layout") == F.col("p_layout"))
        .where(F.col("pages") >= SHARE * F.col("all_pages"))
        .join(wrappers, own)
        .where(~tag.isin(*HEADINGS))
        .groupBy(F.col("layout").alias("s_layout"))
        .agg(F.collect_set("slot").alias("slots"),
             *[F.first(f"w_{c}").alias(f"w_{c}") for c in ("labels", "parents", "texts")])
    )
    marked = written(slots, "template-slots")
    same_layout = F.col("layout") == F.col("s_layout")
    return _template_nodes(grouped.join(marked, same_layout).drop("s_layout"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    keyed = pages.select(
        F.col("page_id").cast("long"), url.alias("url"), html.alias("html"),
        host_of(url).alias("host"), F.xxhash64(host_of(url), html).alias("page_key"),
    )
    trees = written(page_trees(keyed), "page-trees")
    templates = written(induce_templates(trees), "page-templates").withColumnRenamed(
        "page_key", "t_key"
    )
    joined = keyed.join(templates, F.col("page_key") == F.col("t_key"), "left")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for source, template in zip(
                batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True
            ):
                page = parse(source or "")
                of = collapse(page)[1] if template else [-1] * len(page.labels)
                texts.append(content(page, frozenset(template or ()), of))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

        return run

    return map_batches(
        joined.select("page_id", "url", "html", "template"), make,
        "page_id long, url string, text string, n_chars long",
    )
