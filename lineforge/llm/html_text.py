"""Main text of web pages by site template removal.

A page is parsed into its tree of elements.  What the markup itself calls boilerplate (menus,
footers, scripts, forms, adverts, comments ...) goes by tag, role and class.  For the rest, the
subtrees are hashed and Spark counts, for each host, on how many different pages each occurs; a
subtree that recurs on many of a host's pages is site template and is deleted too.  Paragraphs,
headings and other plain text blocks inside a marked article must recur on more pages than others:
an author repeats sentences too.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, table

MIN_PAGES, MIN_SHARE = 5, 0.3  # of a host's different pages, for a subtree to be template
PLAIN_PAGES, PLAIN_SHARE = 20, 0.5  # the same for plain blocks inside a marked article

# HTML element names by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
GONE = set("""head script style noscript template iframe noembed noframes object embed applet canvas svg math audio video map
    title textarea nav footer aside form fieldset button select option input label datalist dialog menu""".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table
    tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
PLAIN = set("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd figcaption caption td th tr hgroup summary address".split())
INLINE = set("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var time".split())
# an element ends open ones of these kinds, up to the bound
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words of class and id that name boilerplate, and the main text.
NAMES = set("""ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promos promotion
    nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside footer masthead cookie cookies
    consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social
    related recommended recommendations comment comments disqus replies respond login search searchbox toolbar pagination
    pager widget widgets skip copyright""".split())
COMMENTS = set("comment comments disqus replies respond comment-list comments-area comment-body".split())
MAIN_NAMES = set("article content entry main post story maincontent".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Element:
    __slots__ = ("tag", "attrs", "parts", "hash")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.parts, self.hash = tag, attrs, [], 0


def parse(html: str) -> Element:
    """The tree of a page, however broken: parts are elements and text."""
    root = Element("html")
    stack, at = [root], 0
    open_ = Counter()  # elements on the stack by tag: what is not there is not looked for

    def close(k: int):
        open_.subtract(e.tag for e in stack[k:])
        del stack[k:]

    def text(s: str):
        if s:
            stack[-1].parts.append(unescape(s) if "&" in s else s)

    while True:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            return root
        text(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in ("body", "html") or not open_[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag in INLINE and stack[k].tag in BLOCK or stack[k].tag in ("article", "main") and tag in ("p", "li", "div"):
                    break  # an inline end tag does not reach out of its block
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P and open_["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in ENDS:
            kinds, bound = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1) if any(open_[x] for x in kinds) else ():
                if stack[k].tag in bound:
                    break
                if stack[k].tag in kinds:
                    close(k)
                    if tag not in ("tr", "tbody"):
                        break
        if tag == "body":
            for k in range(1, len(stack)):
                if stack[k].tag == "head":
                    close(k)
                    break
        e = Element(tag, m[3])
        stack[-1].parts.append(e)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            e.parts.append(html[at:end.start()] if end else html[at:])
            at = end.end() if end else len(html)
        elif tag not in VOID and not (m[3].endswith("/") and tag not in BLOCK and tag not in INLINE):
            stack.append(e)
            open_[tag] += 1


def _attributes(e: Element) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(e.attrs)} if e.attrs.strip() else {}


def _names(attrs: dict[str, str]) -> set[str]:
    return {w.lower() for w in _NAME.findall(attrs.get("class", "") + " " + attrs.get("id", ""))}


def _tokens(attrs: dict[str, str]) -> set[str]:
    return set((attrs.get("class", "") + " " + attrs.get("id", "")).lower().split())


def _is_gone(e: Element, attrs: dict[str, str], in_main: bool, around) -> bool:
    """around(): the elements around the main text, which sites wrap in forms and hide until loaded."""
    if e.tag in ("html", "body", "article", "main") and not attrs:
        return False
    if e.tag in GONE - {"form"} or e.tag == "header" and not in_main:
        return True
    if e.tag in ("html", "body", "main"):
        return False
    return _is_cover(e, attrs) and id(e) not in around()


def _is_cover(e: Element, attrs: dict[str, str]) -> bool:
    return (e.tag == "form" or "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES
            or "style" in attrs and re.search(r"display\s*:\s*none", attrs["style"]) is not None)


def _around(root: Element):
    """The elements that hold the page's longest article (or main element, comments apart); without
    any, those that hold most of its text.  Worked out when first asked for."""
    found: list[set[int]] = []

    def look() -> set[int]:
        marked, todo = {"article": [], "main": []}, [(root, ())]
        while todo:
            e, path = todo.pop()
            attrs = _attributes(e)
            if e.tag in GONE - {"form"} or e.tag not in ("html", "body", "main") and _tokens(attrs) & COMMENTS:
                continue
            if e.tag in marked and not _is_cover(e, attrs):
                marked[e.tag].append((_length(e), len(marked[e.tag]), path))
            todo.extend((x, (e, path)) for x in e.parts if isinstance(x, Element))
        best = max(marked["article"] or marked["main"], default=None)
        if best is None:
            size: dict[int, int] = {}
            for e in reversed(list(_walk(root))):
                size[id(e)] = sum(size[id(x)] if isinstance(x, Element) else 0 if x.isspace() else len(x) for x in e.parts)
            return {k for k, n in size.items() if 2 * n > size[id(root)]}
        held, path = set(), best[2]
        while path:
            held.add(id(path[0]))
            path = path[1]
        return held

    def around() -> set[int]:
        if not found:
            found.append(look())
        return found[0]

    return around


def _is_named(e: Element, attrs: dict[str, str], in_main: bool) -> bool:
    if not attrs or e.tag in ("html", "body", "main"):
        return False
    if e.tag == "article":  # layout classes of an article name what is beside it: only whole ones count
        return bool(_tokens(attrs) & NAMES)
    names = _names(attrs)
    return bool(names & NAMES) or not in_main and "header" in names


def _spared(root: Element, around):
    """A test whether an element holds the main element or most of the text, so no name drops it."""
    size: dict[int, int] = {}  # text of each element, less what goes whatever its names
    order, articles, mains = [], [], []
    todo = [(root, (), False, False)]
    while todo:
        e, path, inside, comments = todo.pop()
        order.append(e)
        attrs = _attributes(e)
        if e is not root and _is_gone(e, attrs, inside, around):
            size[id(e)] = 0
            continue
        comments = comments or e.tag not in ("html", "body", "main") and bool(_tokens(attrs) & COMMENTS)
        path = (e, path)
        if e.tag in ("article", "main") and not comments:
            (articles if e.tag == "article" else mains).append((e, path))
        inside = inside or e.tag in ("article", "main")
        todo.extend((x, path, inside, comments) for x in e.parts if isinstance(x, Element))
    for e in reversed(order):
        if id(e) not in size:
            size[id(e)] = sum(size[id(x)] if isinstance(x, Element) else 0 if x.isspace() else len(x) for x in e.parts)
    best, path = max(articles or mains, key=lambda x: size[id(x[0])], default=(root, ()))
    holds = set()
    while path:
        holds.add(id(path[0]))
        path = path[1]
    below = set(map(id, _walk(best)))
    return lambda x, attrs: id(x) in holds or (id(x) in below and 2 * size.get(id(x), 0) > size[id(best)]
                                               and (best is root or not _tokens(attrs) & COMMENTS))


def prune(e: Element, in_main: bool = False) -> None:
    """Drops what the markup calls boilerplate (walks without recursion: pages can be deep)."""
    root, spared, around = e, None, _around(e)
    todo = [(e, in_main)]
    while todo:
        e, inside = todo.pop()
        kept = []
        for x in e.parts:
            if isinstance(x, Element):
                attrs = _attributes(x)
                now = inside or x.tag in ("article", "main")
                gone = _is_gone(x, attrs, inside, around)
                if not gone and _is_named(x, attrs, inside):
                    spared = spared or _spared(root, around)  # before anything named goes
                    gone = not spared(x, attrs)
                if gone:
                    kept.append(Element("#gone") if x.tag in BLOCK else " ")
                    continue
                todo.append((x, now))
            kept.append(x)
        e.parts = kept


def _walk(e: Element):
    """Elements below ``e`` in page order, itself first."""
    todo = [e]
    while todo:
        e = todo.pop()
        yield e
        todo.extend(x for x in reversed(e.parts) if isinstance(x, Element))


def _length(e: Element) -> int:
    return sum(len(x) for y in _walk(e) for x in y.parts if isinstance(x, str) and not x.isspace())


def main_element(root: Element) -> tuple[Element, bool]:
    """The element that holds the main text (of several the longest), and whether it is marked so."""
    every = list(_walk(root))
    for kind in ("article", "main"):
        found = [e for e in every if e.tag == kind]
        if found:
            return max(found, key=_length), True
    marked = [e for e in every if e.attrs and e.tag not in ("html", "body") and e.tag in BLOCK
              and (_attributes(e).get("role") == "main" or _names(_attributes(e)) & MAIN_NAMES)]
    if marked:
        best = max(marked, key=_length)
        if 2 * _length(best) >= _length(root):
            return best, True
    return root, False


def hash_subtrees(root: Element) -> None:
    """Sets each element's hash: of its tag and what is in it, white space levelled."""
    for e in reversed(list(_walk(root))):
        h = blake2b(e.tag.encode(), digest_size=8)
        for x in e.parts:
            h.update(b"\x01" + x.hash.to_bytes(8, "little", signed=True) if isinstance(x, Element)
                     else b"\x02" + " ".join(x.split()).encode("utf-8", "replace"))
        e.hash = int.from_bytes(h.digest(), "little", signed=True) or 1


def counted(root: Element, main: Element, marked: bool) -> list[Element]:
    """The subtrees that may be template: not what holds the main text, no cells and no parts of
    blocks in it.  The lowest bit of their hashes is set to tell plain blocks inside from others."""
    inside = set(map(id, _walk(main))) if marked else set()
    holds = set()
    todo = [(root, (root,))]
    while todo:
        e, path = todo.pop()
        if e is main:
            holds.update(map(id, path))
            break
        todo += [(x, (*path, x)) for x in e.parts if isinstance(x, Element)]
    part = {id(x) for e in _walk(main) if e.tag in PLAIN or e.tag in INLINE for x in e.parts if isinstance(x, Element)} if marked else ()
    out = []
    for e in _walk(root):
        if id(e) in holds or e.tag in ("body", "#gone", "br", "hr"):
            continue
        plain = id(e) in inside and (e.tag in PLAIN or e.tag in INLINE)
        if plain and (e.tag in ("td", "th") or e.tag in INLINE and id(e) in part):
            continue
        e.hash = e.hash | 1 if plain else e.hash & ~1 or 2
        out.append(e)
    return out


def block_text(main: Element, template=frozenset(), spared=frozenset()) -> str:
    """Blocks in page order, one a line, white space levelled, less the template's subtrees."""
    lines, now = [], []

    def flush():
        line = " ".join("".join(now).split())
        if line:
            lines.append(line)
        now.clear()

    todo: list = [main]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            now.append(x)
        elif x.hash in template and id(x) not in spared:
            (flush() if x.tag in BLOCK else now.append(" "))
        else:
            block = x.tag in BLOCK or x.tag == "#gone"
            if block:
                flush()
                todo.append(None)
            elif x.tag == "br":
                now.append(" ")
            todo.extend(reversed(x.parts))
    flush()
    return "\n".join(lines)


def _read(html: str):
    root = parse(html)
    prune(root)
    main, marked = main_element(root)
    hash_subtrees(root)
    return root, main, marked


def main_text(html: str, template=frozenset()) -> str:
    """Main text of a page, less the subtrees whose hash is in ``template``."""
    root, main, marked = _read(html)
    if not template:
        return block_text(main)
    may = set(map(id, counted(root, main, marked)))
    return block_text(main, template, {id(e) for e in _walk(root) if id(e) not in may})


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, template): for each host the hashes of the subtrees that recur, on ``min_pages`` and
    on the share ``min_share`` of its pages with different main texts; plain blocks inside a marked
    article on PLAIN_PAGES and the share PLAIN_SHARE.

    pages: _host, _html.  A host's list is short, as each of its subtrees is on a share of its
    pages: at most mean subtrees a page / min_share."""
    def subtrees(batches):
        for b in batches:
            host, main_, tree = [], [], []
            for h, html in zip(b.column("_host").to_pylist(), b.column("_html").to_pylist()):
                root, main, marked = _read(html or "")
                got = {e.hash for e in counted(root, main, marked)} | {0}  # 0 stands for the page
                own = _digest(block_text(main))
                host += [h] * len(got)
                main_ += [own] * len(got)
                tree += got
            yield pa.RecordBatch.from_pydict({"host": pa.array(host, pa.string()), "main": pa.array(main_, pa.int64()),
                                              "tree": pa.array(tree, pa.int64())})

    seen = pages.select("_host", "_html").mapInArrow(subtrees, "host string, main long, tree long")
    counts = materialise(seen.groupBy("host", "tree").agg(F.countDistinct("main").alias("n")).where(F.col("n") >= min_pages),
                         "subtrees")
    whole = counts.where("tree = 0").select("host", F.col("n").alias("all"))
    plain = F.col("tree").bitwiseAND(1) == 1
    found = counts.where("tree <> 0").join(whole, "host").where(
        F.when(plain, (F.col("n") >= PLAIN_PAGES) & (F.col("n") >= F.col("all") * PLAIN_SHARE)).otherwise(F.col("n") >= F.col("all") * min_share))
    return materialise(found.groupBy("host").agg(F.collect_list("tree").alias("template")), "templates")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row of ``pages``.

    Nulls and odd input: a null or empty html has an empty text; a null url, or one without a host,
    belongs to the host ''; markup is read however broken; null and repeated ids are kept row by
    row.  Hosts with fewer than ``MIN_PAGES`` different pages have no template.  An empty table
    gives no rows.  Other columns are not read, whatever their names."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).cast("string").alias("_html"),
                        host.alias("_host"))
    templates = site_templates(rows).select(F.col("host").alias("_h"), "template")
    joined = rows.join(templates, rows["_host"] == templates["_h"], "left").select("_id", "_url", "_html", "template")

    def texts(batches):
        for b in batches:
            out = [main_text(h, frozenset(t or ())) if h else "" for h, t in
                   zip(b.column("_html").to_pylist(), b.column("template").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_url"), pa.array(out, pa.string())],
                                             names=["_id", "_url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = joined.mapInArrow(texts, f"_id {kinds['_id']}, _url {kinds['_url']}, text string")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text")


def html_query(spark, sf_dir: str) -> DataFrame:
    out = extract_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
