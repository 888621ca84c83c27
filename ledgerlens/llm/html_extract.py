"""Main text of HTML pages with site template removal.

Pages are parsed into element trees (tag soup allowed). Every block element's
subtree is hashed (tags and texts); Spark counts per host on how many different
pages each subtree occurs. Subtrees on at least ``MIN_PAGES`` pages are that site's
template when they stand on ``MIN_SHARE`` of the host's different pages or on
``MANY_PAGES`` of them, however many the host has: they are deleted from its pages.
Table cells, list items and the like recur as values, so for them only the share
counts. Exact copies of a page count once, and the elements that hold the article
itself are never template; inside an explicit article only containers can be, as
paragraphs, headings and table cells there are content even when they recur. A
host's templates may be many: beyond a checked number the pages find theirs by
joining (host, hash), a page at a time.

Elements whose tag, role, class or id says menu, header, footer, sidebar, notice,
advert, form, script, style or reader comments are deleted as well (a page seen
once has no recurring subtrees). A class or an id says so as a whole: each of its
words names furniture or its place or shape ("site-footer", not "has-sidebar" or
"related-work"); headings are never judged by it, and inside an article single-word
ids are section names (but for the div of reader comments). What holds an outermost article or main is not deleted by
role, class, id or as a form or header. The text is that of all outermost
``article`` and ``main`` elements, else of the body.

Character references are decoded; white space inside a block becomes one space;
blocks are trimmed and joined in page order by one space; nothing else goes.

Defined cases: null or empty html = empty text; null url = a host of its own (the
empty one); repeated rows are extracted each; an empty table = an empty result;
further columns are ignored; a page without the elements above = its whole body."""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import BROADCAST_ROWS, written

MIN_PAGES = 4
MIN_SHARE = 0.3
MANY_PAGES = 12

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
                  "option select button label legend".split())
#: Content by its own right within an article, even when it recurs.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li td th tr tbody thead table dt dd dl blockquote pre figcaption caption br hr ul ol".split())
#: Elements whose texts are values: the same ones recur without being template.
VALUES = frozenset("td th tr dt dd li caption".split())
HOLDERS = frozenset("html body main article".split())
DROP_TAGS = frozenset("head title script style noscript template nav footer aside form button select textarea input iframe object embed svg canvas dialog "
                      "menu xmp noembed noframes audio video".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promotion promotions banner banners cookie cookies consent gdpr "
    "notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup sidebar sidebars aside rail menu menus nav navbar "
    "navigation navigations breadcrumb breadcrumbs masthead topbar toolbar header footer colophon copyright comment comments disqus reply replies respond responses "
    "share sharing social related recommended recommendations widget widgets pagination pager login search searchbox skip toc-nav".split())
#: Words beside these in a class or id that say place or shape only.
SHAPE_WORDS = frozenset(
    "a area bar block bottom box btn button buttons center col column container content desktop fixed floating form global group html icon icons inner item items "
    "js left level line link links list main media mobile module outer page panel posts primary right row secondary section site slot sticky sub text thread title "
    "toggle tool tools top unit us wrap wrapper zone body articles stories".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Deleted even when an article stands in them.
HARD_TAGS = DROP_TAGS - {"form"}
# An opening tag closes open elements of these kinds up to the named container.
CLOSES = {t: (frozenset(["p"]), frozenset("button td th li article section div main aside header footer nav body table dd dt form blockquote".split()))
          for t in ("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
                    "menu nav ol p pre section table ul").split()}
CLOSES |= {"li": (frozenset(["li", "p"]), frozenset("ul ol menu dir".split())), "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
           "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])), "td": (frozenset(["td", "th", "p"]), frozenset(["tr", "table"])),
           "th": (frozenset(["td", "th", "p"]), frozenset(["tr", "table"])), "tr": (frozenset(["tr", "td", "th", "p"]), frozenset(["table"])),
           "tbody": (frozenset("tbody thead tfoot tr td th p".split()), frozenset(["table"])), "option": (frozenset(["option"]), frozenset(["select"]))}

_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.S)
_TAG = re.compile(r"</?+([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
#: The same without regard to quotes, for pages in which a tag's quotes do not close.
_PLAIN = re.compile(r"</?+([a-zA-Z][^\s/>]*+)([^>]*+)>")
_OPENS = re.compile(r"</?+[a-zA-Z]")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "attrs", "children", "digest", "holds")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children, self.digest, self.holds = tag, attrs, [], 0, False


class _Open:
    """The open elements, and for each tag the places of those it has, topmost last."""

    def __init__(self, root: Node):
        self.stack, self.at = [root], {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def close(self, place: int) -> None:
        """Close the element at ``place`` and all above it."""
        for node in self.stack[place:]:
            self.at[node.tag].pop()
        del self.stack[place:]

    def top(self, tags) -> int:
        """Place of the topmost open element of these tags; 0 if there is none."""
        return max((places[-1] for t in tags if (places := self.at.get(t))), default=0)


def parse(page: str) -> Node:
    """Tree of a page: children are Nodes or decoded texts.

    Linear in the page: a tag whose quotes never close is read without regard to quotes, as
    are all after it; behind the last ``>`` all is text; open elements are looked up by tag."""
    root = Node("html")
    elements = _Open(root)
    stack = elements.stack
    pos, size, last = 0, len(page), page.rfind(">")
    quoted = True
    while pos < size:
        if page[pos] != "<":
            until = page.find("<", pos)
            until = size if until < 0 else until
            text, pos = page[pos:until], until
            stack[-1].children.append(html_lib.unescape(text) if "&" in text else text)
            continue
        ends = page.startswith("</", pos)
        if not _OPENS.match(page, pos):
            if page.startswith("<!--", pos):
                pos = _COMMENT.match(page, pos).end()
            elif ends or page[pos + 1:pos + 2] in ("!", "?"):
                pos = page.find(">", pos) + 1 or size
            else:  # a "<" that opens no tag is text
                stack[-1].children.append("<")
                pos += 1
            continue
        m = _TAG.match(page, pos) if quoted and pos < last else None
        if m is None and pos < last:
            quoted, m = False, _PLAIN.match(page, pos)
        if m is None:
            if ends:
                break
            stack[-1].children.append("<")
            pos += 1
            continue
        pos = m.end()
        tag = m.group(1)
        tag = tag.lower()
        if ends:
            place = elements.top((tag,))
            if place:
                elements.close(place)
            elif tag == "p":
                stack[-1].children.append(Node("p"))
            continue
        if tag in ("html", "body") and (tag == "html" or elements.top((tag,))):
            continue
        if tag in CLOSES:
            kinds, stop = CLOSES[tag]
            place = elements.top(kinds)
            while place and (place == len(stack) - 1 or place > elements.top(stop)):
                elements.close(place)
                place = 0 if kinds == {"p"} else elements.top(kinds)
        node = Node(tag, m.group(2))
        stack[-1].children.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(page, pos)
            stop_at = end.start() if end else size
            node.children.append(page[pos:stop_at])
            pos = page.find(">", stop_at) + 1 if end else size
            pos = pos or size
        elif tag not in VOID:
            elements.push(node)
    return root


def _furniture(name: str, in_article: bool) -> bool:
    """Does a whole class token or id name page furniture? An article's own header is no page header."""
    words = _WORDS.findall(name)
    telling = DROP_WORDS.intersection(words)
    return bool(telling - {"header"} if in_article else telling) and all(w in DROP_WORDS or w in SHAPE_WORDS for w in words)


def _named(tag: str, attrs: str, in_article: bool, holds: bool) -> bool:
    """Do role, class or id name page furniture?"""
    for name, a, b, c in [] if holds else _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "role" and value in DROP_ROLES:
            return True
        if tag in HEADINGS:
            continue
        if name == "class" and any(_furniture(x, in_article) for x in value.split()):
            return True
        if name == "id" and _furniture(value, in_article):
            if not in_article or len(_WORDS.findall(value)) > 1 or tag == "div" and value in ("comments", "respond", "disqus"):
                return True
    return False


def says_drop(node: Node, in_article: bool) -> bool:
    """Does the element's tag, role, class or id name page furniture?"""
    if node.tag in ("html", "body", "main"):
        return False
    if node.tag in HARD_TAGS or not node.holds and (node.tag == "form" or node.tag == "header" and not in_article):
        return True
    return bool(node.attrs) and _named(node.tag, node.attrs, in_article, node.holds)


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(node.attrs and re.search(r"\brole\s*=\s*[\"']?main\b", node.attrs))


def mark_holders(root: Node) -> None:
    """Set ``holds`` on what has an outermost article or a main below it that is not furniture itself."""
    todo: list[tuple[Node, Node | None]] = [(root, None)]
    above: dict[int, Node | None] = {}
    while todo:
        x, parent = todo.pop()
        above[id(x)] = parent
        if (x.tag == "article" or _is_main(x)) and not says_drop(x, False):
            while parent is not None and not parent.holds:
                parent.holds = True
                parent = above[id(parent)]
        if x.tag != "article":
            todo += [(c, x) for c in x.children if isinstance(c, Node)]


def hash_tree(node: Node, out: list[tuple[Node, bool]], in_article: bool = False) -> int:
    """Hash every subtree; ``out`` gets the block elements that may be template, with
    whether they stand in an article. Iterative, as tag soup may nest deeply."""
    todo: list[tuple[Node, bool, int]] = [(node, in_article, 0)]
    while todo:
        n, art, state = todo.pop()
        inside = art or n.tag in ("article", "main")
        if not state:
            todo.append((n, art, 1))
            todo += [(c, inside, 0) for c in n.children if isinstance(c, Node)]
            continue
        h = xxhash.xxh64(n.tag)
        some = False
        for c in n.children:
            if isinstance(c, Node):
                h.update(c.digest.to_bytes(8, "little"))
                some = some or bool(c.digest)
            else:
                t = " ".join(c.split())
                if t:
                    h.update(b"t" + t.encode("utf-8", "surrogatepass"))
                    some = True
        n.digest = h.intdigest() if some else 0
        if some and n.tag in BLOCK and n.tag not in HOLDERS and not (art and n.tag in LEAF):
            out.append((n, art))
    return node.digest


def _texts(node: Node, template: frozenset | set, in_article: bool, out: list[str]) -> None:
    """Texts and block breaks (newlines) below a node, furniture and template left out."""
    todo: list = [(node, in_article)]
    while todo:
        x, art = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x is not node and (says_drop(x, art) or (x.digest in template and x.tag not in HOLDERS and not (art and x.tag in LEAF))):
            if x.tag in BLOCK:
                out.append("\n")
            continue
        block = x.tag in BLOCK
        inside = art or x.tag in ("article", "main")
        if block:
            out.append("\n")
            todo.append(("\n", inside))
        todo += [(c, inside) for c in reversed(x.children)]


def _main_nodes(root: Node, template: frozenset | set) -> list[Node]:
    """The outermost articles and main elements that are not furniture, else the page."""
    found: list[Node] = []
    todo = [root]
    while todo:
        x = todo.pop()
        if x is not root and (says_drop(x, False) or x.digest in template and x.tag not in HOLDERS):
            continue
        if x.tag == "article" or _is_main(x):
            found.append(x)
            continue
        todo += [c for c in reversed(x.children) if isinstance(c, Node)]
    return found or [root]


def main_text(page: str | None, template: frozenset | set = frozenset()) -> str:
    root = parse(page or "")
    mark_holders(root)
    if template:
        hash_tree(root, [])
    out: list[str] = []
    for node in _main_nodes(root, template):
        _texts(node, template, node is not root, out)
        out.append("\n")
    return " ".join("".join(out).split())


def subtrees(page: str | None) -> dict[int, bool]:
    """Hashes (signed) of the block elements of a page that may be template, with whether they are values."""
    out: list[tuple[Node, bool]] = []
    hash_tree(parse(page or ""), out)
    return {n.digest - (1 << 64) if n.digest >> 63 else n.digest: n.tag in VALUES for n, _ in out}


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """host, hash, value, page (a hash of its html) for every page and possible template; hash 0 counts the pages themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, hashes, values, copies = [], [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = page.as_py() or ""
                own = {**subtrees(page), 0: False}
                hosts += [host] * len(own)
                hashes += own
                values += own.values()
                copies += [page_hash(page)] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(values, pa.bool_()), pa.array(copies, pa.int64())],
                                             ["host", "hash", "value", "page"])

    return pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, hash long, value boolean, page long").distinct()


def page_hash(page: str | None) -> int:
    return xxhash.xxh64_intdigest((page or "").encode("utf-8", "surrogatepass")) - (1 << 63)


def with_page_hash(rows: DataFrame) -> DataFrame:
    """``rows`` with page: the hash of their html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([page_hash(x.as_py()) for x in batch.column("html")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, "page"])

    return rows.mapInArrow(run, ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes) + ", page long")


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """host, hash: the recurring subtrees of each host that has any."""
    counts = page_subtrees(pages).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))
    counts = written(counts.filter(F.col("n") >= min_pages), "subtree-counts")
    of_host = counts.filter("hash = 0").select("host", F.col("n").alias("pages"))
    often = (F.col("n") >= min_share * F.col("pages")) | ~F.col("value") & (F.col("n") >= many_pages)
    return counts.filter("hash <> 0").join(of_host, "host").filter(often).select("host", "hash")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES,
            broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    templates = written(site_templates(pages, min_pages, min_share, many_pages), "site-templates")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    # Hosts with templates are broadcast only up to a checked number of hashes; beyond it every page gets its own.
    if templates.limit(broadcast_rows + 1).count() <= broadcast_rows:
        rows = rows.join(F.broadcast(templates.groupBy("host").agg(F.collect_set("hash").alias("hashes"))), "host", "left")
    else:
        own = page_subtrees(pages).join(templates, ["host", "hash"]).groupBy("host", "page").agg(F.collect_set("hash").alias("hashes"))
        rows = with_page_hash(rows).join(written(own, "page-templates"), ["host", "page"], "left")
    rows = rows.select("page_id", "url", "html", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, hashes in zip(batch.column(2), batch.column(3), strict=True):
                own = hashes.as_py()
                texts.append(main_text(page.as_py(), {h & (1 << 64) - 1 for h in own} if own else frozenset()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
