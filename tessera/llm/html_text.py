"""Main text of web pages, with site templates removed.

Element subtrees are hashed (tag, classes, text and children). Spark counts on how many
different pages of a host each hash occurs; a subtree that recurs on at least
``MIN_PAGES`` pages is template and is deleted from its pages, however many pages the host
has: the sections of a large host have templates of their own. Templates whose text differs
from page to page do not recur; they are known by what they are: menus, headers, footers,
sidebars, forms, scripts and containers that call themselves adverts, notices, comments and
the like. Paragraphs and headings are never judged by a class or id; inside an article or
main part a container is only if a whole class or id says so (``related-posts``, not
``related-work``); and no menu, form or named container is dropped that holds an article, no
form that holds more than half of the page's text and no named container with three quarters.

The text comes from the page's articles (else its main part, else its body). Paragraphs,
headings and the like inside an article are never template, so a sentence that a site
repeats in many articles stays; neither is a subtree that holds most of the page's text.

Pages are parsed once. That pass writes the hashes, and the article's text in segments, each
with the place of its innermost subtree that may be template; the html itself is never
shuffled. Hashes are counted and joined back to pages as lists, and a text is put together
from the segments whose subtrees stay.

Edge cases: a page is parsed whole, whatever its length, in one task; a null html and a page without text give ""; broken markup is read as
browsers do in the common cases (implied ends, stray ends, unclosed elements and
comments); pages of equal html count once, equal rows are all returned; a null url is
a host of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pick, written

MIN_PAGES = 5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                    "label mark q rp rt ruby s samp small span strike strong sub sup time tt u "
                    "var wbr").split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr tbody figcaption".split())
DROPPED = frozenset(("head script style noscript template button select option textarea iframe "
                     "object svg canvas audio video title input noembed noframes").split())
SOFTLY_DROPPED = frozenset("nav footer aside menu dialog".split())
ROLES = frozenset(("navigation banner contentinfo complementary search form dialog alert menu "
                   "menubar alertdialog").split())
# words of class and id that name what is no article
HINTS = frozenset(("nav navbar navigation menu sidebar footer ad ads advert adverts advertisement "
                   "advertising banner promo promoted sponsor sponsored cookie cookies consent gdpr "
                   "notice notices popup modal newsletter subscribe subscription share sharing "
                   "social related breadcrumb breadcrumbs pagination pager comment comments "
                   "disqus reply replies respond widget login signup masthead").split())
# words that may stand beside them in a class or id without naming anything else
GENERIC = frozenset(("site page main top bottom left right header head bar box boxes block list "
                     "lists links link item items section area wrapper wrap container inner outer "
                     "content panel slot group row col buttons button icons icon form posts post "
                     "articles stories thread js the primary secondary global local inline").split())
# text that is judged by what it says, not by a class or id
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd figure table ul ol dl".split())
# how an element is dropped: always; unless it holds an article or main part; likewise or more
# than half of the page's text (forms); likewise or more than three quarters (named containers)
FIRM, SOFT, FORM, NAMED = 1, 2, 3, 4
# an opening tag ends these open elements, up to the nearest of the limits
BLOCK_ENDS_P = frozenset(("address article aside blockquote details div dl fieldset figcaption "
                          "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
                          "section table ul").split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
        "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# what follows a tag's name, read once without going back: blanks and slashes, names with a
# quoted, bare or no value; a quote that is never closed is an ordinary character
TAG_REST = re.compile(r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?)?)*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")


class Node:
    __slots__ = ("tag", "mark", "drop", "kids", "digest", "size")

    def __init__(self, tag: str, mark: str = "", drop: int = 0):
        self.tag, self.mark, self.drop = tag, mark, drop
        self.kids: list = []                # nodes and strings
        self.digest = self.size = 0


def _named(name: str, inside: bool) -> bool:
    """Whether a class or id names what is no article: by any of its words, inside an
    article only if all of its words do or are generic."""
    words = set(re.split(r"[_-]+", name)) - {""}
    return bool(words & HINTS) and (not inside or words <= HINTS | GENERIC)


def _attributes(tag: str, text: str, inside: bool) -> tuple[str, int]:
    """What tells an element apart (class, id, role) and whether it is no article;
    ``inside`` an article or main part."""
    found = {}
    for m in ATTRIBUTE.finditer(text):
        name = m[1].lower()
        if name in ("class", "id", "role", "hidden", "aria-hidden", "itemprop"):
            found.setdefault(name, entities.unescape((m[2] or "").strip("\"'")).lower())
    firm = FIRM if tag in DROPPED else 0
    soft = SOFT if tag in SOFTLY_DROPPED else FORM if tag == "form" else 0
    if not found:
        return "", firm or soft
    mark = " ".join(f"{k}={found[k]}" for k in sorted(found))
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    if tag in ("html", "body", "article", "main"):
        comment = tag == "article" and any({"comment", "reply"} & set(re.split(r"[_-]+", x))
                                           for x in found.get("class", "").split())
        return mark, FIRM if comment else 0
    if firm or "hidden" in found or found.get("aria-hidden") == "true":
        return mark, FIRM
    if soft or found.get("role") in ROLES:
        return mark, soft or SOFT
    if (tag not in TEXTUAL or not inside and tag in ("ul", "ol", "dl", "table", "figure")) and any(
            _named(x, inside) for x in names):
        return mark, NAMED
    return mark, 0


def _tag_end(page: str, at: int) -> int:
    """Index of the ``>`` that ends the tag at ``at`` (-1: none); one inside quotes does not."""
    rest = TAG_REST.match(page, at)
    return rest.end() - 1 if rest else -1


def parse(page: str) -> Node:
    """The element tree; text is kept with its character references decoded."""
    root = Node("#")
    stack, at, n = [root], 0, len(page)
    parts = 0                       # open articles and main parts

    def is_part(node: Node) -> bool:
        return node.tag in ("article", "main") or "role=main" in node.mark

    def close(tags, limits=frozenset()) -> None:
        nonlocal parts
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                parts -= sum(map(is_part, stack[i:]))
                del stack[i:]
                return
            if stack[i].tag in limits:
                return

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            stack[-1].kids.append(entities.unescape(page[at:lt]))
        if lt == n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page[lt + 1:lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        ending = page[lt + 1:lt + 2] == "/"
        name = NAME.match(page, lt + 1 + ending)
        if not name:
            stack[-1].kids.append("<")
            at = lt + 1
            continue
        tag = name[0].lower()
        end = _tag_end(page, name.end())
        if end < 0:
            break
        at = end + 1
        if ending:
            if tag == "p" and not any(x.tag == "p" for x in stack):
                continue
            close({tag}, frozenset() if tag not in INLINE else {"td", "th", "article", "body"})
            continue
        if tag in BLOCK_ENDS_P:
            close({"p"}, {"table", "button", "article", "td", "th"})
        if tag in ENDS:
            close(*ENDS[tag])
        mark, drop = _attributes(tag, page[name.end():end], parts > 0)
        node = Node(tag, mark, drop)
        stack[-1].kids.append(node)
        if tag in RAW and page[end - 1] != "/":
            stop = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            if tag in ("textarea", "title"):
                node.kids.append(entities.unescape(page[at:stop.start() if stop else n]))
            at = n if not stop else (page.find(">", stop.start()) + 1 or n)
        elif tag not in VOID and page[end - 1] != "/" or tag in ("p", "div", "article", "section"):
            if tag not in VOID:
                stack.append(node)
                parts += is_part(node)
    return root


def _walk(root: Node) -> list[Node]:
    """All nodes, parents first; no recursion, as pages nest as deep as they like."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(k for k in node.kids if not isinstance(k, str))
    return out


def digest(root: Node) -> list[Node]:
    """Fills every node's subtree hash and its text length, keeps what is dropped only
    softly and holds the article; returns all nodes."""
    nodes = _walk(root)
    for node in reversed(nodes):
        h = xxhash.xxh64(f"{node.tag} {node.mark}".encode("utf-8", "surrogatepass"))
        for k in node.kids:
            if isinstance(k, str):
                text = " ".join(k.split())
                if text:
                    h.update(b"\0" + text.encode("utf-8", "surrogatepass"))
                    node.size += len(text)
            else:
                h.update(k.digest.to_bytes(8, "little"))
                node.size += k.size
        node.digest = h.intdigest()
    holds = set()                           # nodes that are or hold an article or main part
    for node in reversed(nodes):
        if node.tag in ("article", "main") and node.size and not node.drop or any(
                id(k) in holds for k in node.kids):
            holds.add(id(node))
        if node.drop > FIRM and (id(node) in holds or node.drop == FORM and 2 * node.size > root.size
                                 or node.drop == NAMED and 4 * node.size > 3 * root.size):
            node.drop = 0
    return nodes


def _roots(root: Node) -> list[Node]:
    """The outermost articles, else main parts, else the whole page."""
    for wanted in (lambda x: x.tag == "article",
                   lambda x: x.tag == "main" or "role=main" in x.mark
                   or "itemprop=articlebody" in x.mark):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.drop:
                continue
            if wanted(node) and node.size:
                found.append(node)
                continue
            todo.extend(k for k in reversed(node.kids) if not isinstance(k, str))
        if found:
            return found
    return [root]


def removable(root: Node) -> list[Node]:
    """The subtrees of a digested page that may be template: all block elements outside
    the article; inside it those that are no prose and hold less than half of the text."""
    roots = _roots(root)
    whole = roots[0] is root
    inside: dict[int, int] = {}
    for r in roots:
        for node in _walk(r):
            inside[id(node)] = sum(x.size for x in roots)
    out = []
    for node in _walk(root):
        if node.tag in INLINE or node.tag in ("#", "html", "body", "head") or not node.size:
            continue
        total = inside.get(id(node))
        if total is None or (2 * node.size < total and (whole or node.tag not in PROSE)):
            out.append(node)
    return out


BREAK = "\n"               # ends a block; in the text itself every white space is a blank
_SPACES = re.compile(r"\s+")


def segments(root: Node) -> tuple[list[tuple[int, int]], list[tuple[int, str]]]:
    """A digested page's article as text in page order.

    Returns ``(digest, parent)`` of the subtrees that may be template and hold some of the
    text (``parent``: the place of the next such subtree around it, else -1), and
    ``(place, text)`` segments, place -1 for text in no such subtree.
    """
    may = {id(x) for x in removable(root)}
    around: list[tuple[int, int]] = []
    out: list[tuple[int, list[str]]] = []

    def put(place: int, text: str) -> None:
        if out and out[-1][0] == place:
            out[-1][1].append(text)
        else:
            out.append((place, [text]))

    for top in _roots(root):
        put(-1, BREAK)
        todo: list = [(top, -1)]
        while todo:
            node, place = todo.pop()
            if node is None:
                put(place, BREAK)
            elif isinstance(node, str):
                put(place, _SPACES.sub(" ", node))
            elif node.tag == "br":
                put(place, " ")
            elif not node.drop and not (node.tag == "header" and top is root):
                if id(node) in may:
                    around.append((node.digest, place))
                    place = len(around) - 1
                if node.tag not in INLINE:
                    put(place, BREAK)
                    todo.append((None, place))
                todo.extend((k, place) for k in reversed(node.kids))
    return around, [(p, "".join(t)) for p, t in out]


def join_segments(around, parts, template) -> str:
    """The blocks, one a line, of the segments whose subtrees are no template."""
    gone: list[bool] = []
    for value, parent in around:
        gone.append(value in template or parent >= 0 and gone[parent])
    text = "".join(t for p, t in parts if p < 0 or not gone[p])
    lines = (" ".join(b.split()) for b in text.split(BREAK))
    return "\n".join(x for x in lines if x)


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """The blocks of the article, one a line, without subtrees whose hash is template."""
    if not page:
        return ""
    root = parse(page)
    digest(root)
    return join_segments(*segments(root), template)


def _host(url):
    """Host of a url, null for none."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


PARSED = ("around array<struct<subtree:long,parent:int>>, parts array<struct<place:int,text:string>>, "
          "subtrees array<long>")


def parsed(rows: DataFrame) -> DataFrame:
    """``page_id, url, host, page`` and what the page is made of: ``subtrees``, the hashes of
    all subtrees that may be template, and the article's segments (see ``segments``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.struct([("subtree", pa.int64()), ("parent", pa.int32())])),
                 pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())])),
                 pa.list_(pa.int64())]
        for batch in batches:
            made: list[list] = [[], [], []]
            for text in batch.column(4).to_pylist():
                root = parse(text or "")
                digest(root)
                around, parts = segments(root)
                made[0].append([{"subtree": _signed(d), "parent": p} for d, p in around])
                made[1].append([{"place": p, "text": t} for p, t in parts])
                made[2].append(sorted({_signed(x.digest) for x in removable(root)}))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *[pa.array(m, k) for m, k in zip(made, kinds)]],
                names=["page_id", "url", "host", "page", "around", "parts", "subtrees"])

    kind = dict(rows.dtypes)["page_id"]
    return rows.select("page_id", "url", "host", "page", "html").mapInArrow(
        run, f"page_id {kind}, url string, host long, page long, {PARSED}")


def templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, subtree)`` of the subtrees that recur across a host's pages; ``found`` has a
    row ``(host, page, subtree)`` for each, once or more."""
    return found.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n")).filter(
        F.col("n") >= min_pages).select("host", "subtree")


def extract(table: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    rows = pick(table, "page_id", "url", "html").withColumn(
        "host", F.xxhash64(_host(F.col("url")))).withColumn("page", F.xxhash64("html"))
    whole = written(parsed(rows), "html-parsed")
    template = templates(whole.select("host", "page", F.explode("subtrees").alias("subtree")), min_pages)
    # hashes to delete, page by page: no more than the article itself holds
    held = whole.select("host", "page", F.explode("around.subtree").alias("subtree")).distinct()
    gone = written(held.join(written(template, "html-templates"), ["host", "subtree"])
                   .groupBy("host", "page").agg(F.collect_list("subtree").alias("gone")), "html-gone")
    joined = whole.drop("subtrees").join(gone, ["host", "page"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [join_segments([(a["subtree"], a["parent"]) for a in around],
                                   [(p["place"], p["text"]) for p in parts], frozenset(g or ()))
                     for around, parts, g in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)["page_id"]
    return joined.select("page_id", "url", "around", "parts", "gone").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
