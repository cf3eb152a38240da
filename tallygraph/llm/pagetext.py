"""Main text of web pages, without the templates that the pages of a site share.

Each page is parsed once into a tree whose subtrees are hashed from the leaves up in two ways: with
their texts, and by shape, which is tags, names and the shapes inside. Spark counts on how many pages
of a host each hash occurs; what recurs on many of them outside of the page's main part is the frame of the site
and is deleted. What is left loses the elements that are furniture by name or class, and the text of the
article remains.
"""

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.joins import join_sums
from tallygraph.llm.lattice import values
from tallygraph.staging import Staging

# Element names of HTML by what they are to a reader.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CODE = frozenset(
    "script style noscript template head title iframe object svg math canvas audio video".split()
)
FURNITURE = CODE | frozenset("nav footer aside form button select textarea dialog menu datalist".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
# Inside an article only these may be templates; every other block that is no furniture is its text.
BOXES = frozenset(["div"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset(
    "p ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address".split()
)
ROOTS = frozenset("html body main article".split())
# An opening tag closes open elements of the same line of work.
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
LIMITS = frozenset("ul ol dl table body html article main section div td th".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
# Words in class, id and role that name furniture.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|"
    r"overlay|sidebar|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|comments?|disqus|respond|"
    r"replies|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|pagination|pager|"
    r"skip|toolbar|hidden|teasers?|alert|complementary|contentinfo|dialog)(?:$|[\s_-])",
    re.I,
)
HEADER = re.compile(r"(?:^|[\s_-])(?:header|topbar)(?:$|[\s_-])", re.I)
DIGITS = re.compile(r"[0-9]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(frozen=True)
class PageParams:
    """A subtree is a template of a host if it is on ``min_pages`` of its pages or more, and on
    ``min_share`` of them or more, pages with the same main part counting once. One with more than
    ``max_share`` of a page's text is none there, nor a shape whose elements have more than that of its
    running text together; and where all of one kind have more than that of what is said, they stay.
    Without ``by_name``, elements are no furniture by tag and names; only what is counted goes."""

    min_pages: int = 5
    min_share: float = 0.5
    max_share: float = 0.5
    by_name: bool = True


@dataclass
class Node:
    """``said`` and ``linked`` are the characters of its text outside and inside of links; a node is
    ``prose`` if it holds a paragraph or the like, ``solid`` if it holds text in a block that is no box."""

    tag: str
    names: str = ""
    unseen: bool = False
    parent: "Node | None" = None
    parts: list = field(default_factory=list)
    said: int = 0
    linked: int = 0
    prose: bool = False
    solid: bool = False
    digest: int = 0
    shape: int = 0

    @property
    def chars(self) -> int:
        return self.said + self.linked

    def close(self) -> None:
        """Hash of the element, its texts without white space at their ends, and its subtrees; and
        of its shape, in which equal neighbours are one and digits in names are alike."""
        h = blake2b(self.tag.encode(), digest_size=8)
        shape = blake2b(f"shape {self.tag} {DIGITS.sub('0', self.names)}".encode("utf-8", "replace"), digest_size=8)
        before = None
        for part in self.parts:
            if isinstance(part, Node):
                h.update(b"<" + part.digest.to_bytes(8, "big", signed=True))
                self.said += part.said
                self.linked += part.linked
                self.prose |= part.prose or part.tag in PROSE
                self.solid |= part.solid
                if (part.tag == "a" or part.tag not in INLINE) and part.tag not in VOID and part.shape != before:
                    before = part.shape
                    shape.update(before.to_bytes(8, "big", signed=True))
            elif bare := " ".join(part.split()):
                h.update(b">" + bare.encode("utf-8", "replace"))
                self.said += len(bare)
        if self.tag in CODE or self.unseen:
            self.said = self.linked = 0
            self.prose = self.solid = False
        elif self.tag == "a":
            self.said, self.linked = 0, self.chars
        self.solid |= bool(self.chars) and self.tag not in INLINE and self.tag not in BOXES
        self.digest = int.from_bytes(h.digest(), "big", signed=True)
        self.shape = int.from_bytes(shape.digest(), "big", signed=True)


class _Tree(HTMLParser):
    """Builds the tree; elements that are not closed end with their parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("html")
        self.closed: list[Node] = []
        self.n_open: defaultdict[str, int] = defaultdict(int)

    def _close_to(self, parent: Node) -> None:
        while self.open is not parent:
            self.open.close()
            self.n_open[self.open.tag] -= 1
            self.closed.append(self.open)
            self.open = self.open.parent

    def _find(self, tags: frozenset[str], limits: frozenset[str]) -> Node | None:
        if not any(self.n_open[tag] for tag in tags):
            return None
        node = self.open
        while node.parent is not None and node.tag not in limits:
            if node.tag in tags:
                return node
            node = node.parent
        return node if node.parent is not None and node.tag in tags else None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P and (p := self._find(frozenset(["p"]), LIMITS)):
            self._close_to(p.parent)
        elif tag in CLOSED_BY and (same := self._find(CLOSED_BY[tag], LIMITS - CLOSED_BY[tag])):
            self._close_to(same.parent)
        if tag == "body" and self._find(frozenset(["head"]), frozenset()):
            self._close_to(self.root)
        given = dict(attrs)
        names = " ".join(filter(None, (given.get("class"), given.get("id"), given.get("role"))))
        unseen = "hidden" in given or given.get("aria-hidden") == "true" or bool(UNSEEN.search(given.get("style") or ""))
        node = Node(tag, names, unseen, self.open)
        self.open.parts.append(node)
        if tag in VOID:
            node.close()
        else:
            self.open = node
            self.n_open[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" or tag in INLINE:
            # These end in the block they began in, or not at all.
            node = self._find(frozenset([tag]), LIMITS)
        else:
            node = self._find(frozenset([tag]), frozenset())
        if node is not None:
            self._close_to(node.parent)

    def handle_data(self, data: str) -> None:
        self.open.parts.append(data)


def parse(html: str | None) -> tuple[Node, list[Node]]:
    """The root of a page's tree, and its elements from the leaves up."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    tree._close_to(tree.root)
    tree.root.close()
    return tree.root, tree.closed


def _is_furniture(node: Node, in_article: bool, by_name: bool) -> bool:
    if node.tag in CODE or node.unseen:
        return True
    if not by_name or node.tag in ("body", "main"):
        return False
    if node.tag in FURNITURE or node.names and NAMED.search(node.names):
        return True
    return not in_article and (node.tag == "header" or bool(node.names and HEADER.search(node.names)))


def _articles(root: Node, by_name: bool) -> list[Node]:
    """The outermost articles, or else the first main part, or else the body."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "body": []}
    stack = [root]
    while stack:
        node = stack.pop()
        kind = "main" if node.names == "main" or node.tag == "main" else node.tag
        if kind in found:
            found[kind].append(node)
            if kind == "article":
                continue
        stack += [p for p in reversed(node.parts) if isinstance(p, Node) and not _is_furniture(p, False, by_name)]
    if found["article"]:
        return found["article"]
    return found["main"][:1] or found["body"][:1] or [root]


def _main_parts(articles: list[Node], by_name: bool) -> list[Node]:
    """The articles, or in a body without any the innermost box that has more than half of its
    running text; the body itself if none has."""
    if articles[0].tag not in ("body", "html"):
        return articles
    node, running = articles[0], articles[0].said
    while True:
        boxes = [p for p in node.parts if isinstance(p, Node) and not _is_furniture(p, False, by_name)]
        inner = max(boxes, key=lambda p: p.said, default=None)
        if inner is None or 2 * inner.said <= running or inner.tag in PROSE or inner.tag in INLINE:
            return [node]
        node = inner


def _is_telling(node: Node) -> bool:
    """Whether the shape of an element says what it is for. That of a paragraph or a plain box says
    nothing; that of a list of links does, or of a named box without paragraphs, or of an element with a
    purpose of its own."""
    if 2 * node.linked > node.chars:
        return True
    if node.tag in PROSE or "-" in node.tag:
        return False
    return bool(node.names) and not node.prose if node.tag in ("div", "section") else True


@dataclass(frozen=True)
class Mark:
    """An element of a page that may go: the mark around it or -1, its hashes if they count, and
    whether it is furniture by name, the outermost."""

    up: int
    by_text: int | None
    by_shape: int | None
    named: bool


def page_marks(root: Node, main: list[Node], params: PageParams) -> tuple[list[Mark], dict[int, int]]:
    """The marks of a page, outer ones first, and the mark of each element that has one.

    Outside of the main part every block with text may go by its text, and by its shape if that is
    telling; inside of it only boxes without other blocks, by their text. What is around the main part stays.
    """
    around = set()
    for node in main:
        while node is not None and id(node) not in around:
            around.add(id(node))
            node = node.parent
    shielded = {id(n) for n in main if n.tag not in ("body", "html")}
    found: list[tuple[Node, int, bool, bool, bool]] = []
    mark_of: dict[int, int] = {}
    running: defaultdict[int, int] = defaultdict(int)
    stack = [(root, -1, False, False, False, False)]
    while stack:
        node, up, inside, in_article, own, furnished = stack.pop()
        inside = inside or id(node) in shielded
        in_article = in_article or node.tag == "article"
        for part in reversed(node.parts):
            if not isinstance(part, Node) or not part.chars:
                continue
            inline = part.tag in INLINE
            own_text = own or (inside and not inline and part.tag not in BOXES)
            named = not furnished and _is_furniture(part, in_article, params.by_name)
            at = up
            if not inline and part.tag not in ROOTS and id(part) not in around:
                by_text = part.chars <= params.max_share * root.chars
                if inside:
                    by_text = by_text and not (own_text or part.solid or named or furnished)
                by_shape = not inside and _is_telling(part)
                if by_text or by_shape or named:
                    at = len(found)
                    mark_of[id(part)] = at
                    found.append((part, up, by_text, by_shape, named))
                    if by_shape:
                        running[part.shape] += part.said
            stack.append((part, at, inside, in_article, own_text, furnished or named))
    marks = [
        Mark(
            up,
            n.digest if by_text else None,
            n.shape if by_shape and running[n.shape] <= params.max_share * root.said else None,
            named,
        )
        for n, up, by_text, by_shape, named in found
    ]
    return marks, mark_of


def text_parts(articles: list[Node], mark_of: dict[int, int], by_name: bool = True) -> list[tuple[str, int]]:
    """The text of the articles in parts, each with the mark that it stands in, or -1. Blocks are in page
    order, one space between them, with white space inside a block turned into one space; a part
    ends where an element that may go begins or ends."""
    parts: list[tuple[list[str], int]] = []

    def say(text: str, within: int) -> None:
        if not parts or parts[-1][1] != within:
            parts.append(([], within))
        parts[-1][0].append(text)

    for article in articles:
        in_article = article.tag == "article"
        # Of a header inside the article only the headings are text.
        say(" ", -1)
        stack: list[tuple[Node | str, bool, int]] = [(p, False, -1) for p in reversed(article.parts)]
        while stack:
            part, headings_only, within = stack.pop()
            if isinstance(part, str):
                if not headings_only:
                    say(part, within)
                continue
            if _is_furniture(part, in_article, by_name):
                continue
            if part.tag in HEADINGS:
                headings_only = False
            elif part.tag == "header":
                headings_only = True
            if part.tag not in INLINE:
                say(" ", within)
                stack.append((" ", False, within))
                within = mark_of.get(id(part), within)
            stack += [(p, headings_only, within) for p in reversed(part.parts)]
    joined = ((" ".join("".join(texts).split()), within) for texts, within in parts)
    return [(text, within) for text, within in joined if text]


def main_text(root: Node) -> str:
    """The text of the article, templates included."""
    return " ".join(text for text, _ in text_parts(_articles(root, True), {}))


def page_record(html: str | None, params: PageParams) -> tuple[int, list[Mark], list[tuple[str, int]]]:
    """All that is kept of a page after its one parse: a hash of the text of its main part, by which
    copies are told, whatever their scripts and menus; its marks; and its text in parts."""
    root, _ = parse(html)
    articles = _articles(root, params.by_name)
    main = _main_parts(articles, params.by_name)
    marks, mark_of = page_marks(root, main, params)
    parts = text_parts(articles, mark_of, params.by_name)
    main_said = parts if main == articles else text_parts(main, {}, params.by_name)
    h = blake2b(" ".join(text for text, _ in main_said).encode("utf-8", "replace"), digest_size=8)
    return int.from_bytes(h.digest(), "big", signed=True), marks, parts


def candidates(root: Node, nodes: list[Node], params: PageParams) -> set[int]:
    """Hashes of the elements that may be templates by their text."""
    main = _main_parts(_articles(root, params.by_name), params.by_name)
    return {m.by_text for m in page_marks(root, main, params)[0] if m.by_text is not None}


def what_stays(
    marks: Sequence[Mark], parts: Sequence[tuple[str, int]], often: set[int], max_share: float
) -> tuple[str, int, int, int]:
    """The text of a page without the templates of its host, and how many of its blocks went by
    text, by shape, and by name; of nested ones the outermost counts."""
    shapes, texts = bytearray(len(marks) + 1), bytearray(len(marks) + 1)
    for i, m in enumerate(marks):
        # The last place is that of no mark.
        shapes[i] = shapes[m.up] or m.by_shape in often
        texts[i] = texts[m.up] or m.by_text in often
    said, gone = list(parts), bytearray(len(marks) + 1)
    for kind in (shapes, texts):
        left = [(text, at) for text, at in said if not kind[at]]
        if sum(len(t) for t, _ in left) >= (1 - max_share) * sum(len(t) for t, _ in said):
            said, gone = left, bytearray(map(max, gone, kind))
        else:
            kind[:] = bytes(len(kind))
    outer = [i for i, m in enumerate(marks) if gone[i] and not gone[m.up]]
    by_text = sum(texts[i] for i in outer)
    by_name = sum(m.named and not gone[i] for i, m in enumerate(marks))
    return " ".join(text for text, _ in said), by_text, len(outer) - by_text, by_name


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without port or user; null and odd ones give what is there."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(found != "", found).otherwise(F.coalesce(url, F.lit("")))


TREE = (
    "main_key long, up array<int>, by_text array<long>, by_shape array<long>, named array<boolean>, "
    "texts array<string>, within array<int>"
)
TREE_TYPES = {
    "main_key": pa.int64(),
    "up": pa.list_(pa.int32()),
    "by_text": pa.list_(pa.int64()),
    "by_shape": pa.list_(pa.int64()),
    "named": pa.list_(pa.bool_()),
    "texts": pa.list_(pa.string()),
    "within": pa.list_(pa.int32()),
}
LEFT = "text string, n_by_text long, n_by_shape long, n_by_name long"


def _structs(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.Array:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], [*types])


def _trees(html: Column, params: PageParams) -> Column:
    """What is kept of a page, its marks and parts in columns."""

    @F.arrow_udf(TREE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for sources in batches:
            rows = []
            for source in values(sources):
                main_key, marks, parts = page_record(source, params)
                rows.append(
                    (
                        main_key,
                        [m.up for m in marks],
                        [m.by_text for m in marks],
                        [m.by_shape for m in marks],
                        [m.named for m in marks],
                        [text for text, _ in parts],
                        [at for _, at in parts],
                    )
                )
            yield _structs(rows, TREE_TYPES)

    return run(html)


def _left(tree: DataFrame, params: PageParams) -> Column:
    """What stays of a page beside the templates of its host."""
    kinds = dict(text=pa.string(), n_by_text=pa.int64(), n_by_shape=pa.int64(), n_by_name=pa.int64())

    @F.arrow_udf(LEFT)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for up, by_text, by_shape, named, texts, within, often in zip(*map(values, batch), strict=True):
                marks = list(map(Mark, up, by_text, by_shape, named))
                parts = list(zip(texts, within, strict=True))
                rows.append(what_stays(marks, parts, set(often or ()), params.max_share))
            yield _structs(rows, kinds)

    return run(*(tree[c] for c in [*list(TREE_TYPES)[1:], "often"]))


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    params: PageParams = PageParams(),
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row, and how many of its blocks went: ``n_by_text`` and
    ``n_by_shape`` as templates of the host, ``n_by_name`` of the rest as furniture.

    Templates are found per host, by their share of its pages, pages with an equal main part
    counting as one, so that copies of an article are none, whatever their scripts and menus. The main
    part is the ``article`` or ``main``, else the box with most of the running text; of its blocks only
    plain boxes are ever templates, and only by their text. Each page is parsed once; its hashes and its text
    in parts are written to the shared folder. Counting reads the hashes only and sums in the tasks first. A
    template is on half of its host's pages, so a host has at most twice as many as a page has blocks
    on average: one row a host, broadcast by Spark if their file is small. A null page is an empty one:
    its text is empty. Rows that repeat an id are pages of their own, and a tied share counts as
    reached. Very long and deep pages cost time and memory in proportion. Other columns are ignored; an
    empty table gives an empty result.
    """
    area = Staging(pages.sparkSession)
    keyed = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.xxhash64(host_of(F.col(url_col))).alias("host"),
        _trees(F.coalesce(F.col(html_col), F.lit("")), params).alias("tree"),
    )
    trees = area.table(keyed.select("page_id", "url", "host", "tree.*"), "trees")
    sizes = trees.select("host", "main_key").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    hashes = F.array_distinct(F.array_compact(F.concat("by_text", "by_shape")))
    often = (
        trees.select("host", "main_key", F.explode(hashes).alias("subtree"))
        .distinct()
        .groupBy("host", "subtree")
        .agg(F.count("*").alias("n_pages"))
        .where(F.col("n_pages") >= params.min_pages)
    )
    frames = area.table(
        join_sums(often, sizes, "host")
        .where(F.col("n_pages") >= params.min_share * F.col("host_pages"))
        .groupBy("host")
        .agg(F.collect_list("subtree").alias("often")),
        "frames",
    )
    framed = trees.join(frames, "host", "left")
    left = framed.select("page_id", "url", _left(framed, params).alias("left")).select("page_id", "url", "left.*")
    return left.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_by_text", "n_by_shape", "n_by_name"
    )
