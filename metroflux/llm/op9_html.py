"""Main text of web pages by consensus container paths per host.

Pages of a host share a template.  Each page's containers are scored by the
text they hold outside links and boilerplate, and the page votes for its best
container's path of tags and classes, with digits generalised.  The best one is
found from the page down, never below an article, and no further where a heading or
much text stands beside.  Spark counts the votes per host, and every page is extracted
anew at its host's winning path; a page without such a container uses its own best
one, and so does a page that holds less than ``SHARE`` of its text there, not counting
containers that at least half of the pages with that vote have beside it.

Left out everywhere: scripts, styles, menus, forms, adverts, notices, sidebars,
footers, reader comments and the like, by tag or by words of class, id and role.  A name
that has other words too (has-sidebar) does not count for an element that holds most
of the page's text and all its articles.  Inside an article a word alone (id='share' on a
section about shares) does not decide either, but for reader comments: where the host has ``ASKED`` pages
or more, such an element goes only if ``USUAL`` of them have one at the same path.

Paths are digests along the tree, so that a page nested ten thousand deep costs no more than
a flat one.  The winning paths are written first; where they are small, Spark sends them to
the pages instead of dealing the pages by host.

Defined results: NULL or blank html gives empty text; NULL or odd urls share one
host; broken markup is read as far as it goes (unclosed elements end with their
parent, a cut tag at the end is dropped); pages of any length and depth are read whole;
repeated rows are extracted each; ties among paths go to more text, then to the greater
digest; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import map_rows, stage

#: Element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe title textarea xmp noembed noframes".split())
DROPPED = frozenset("""nav footer aside form button select option menu dialog svg canvas object audio video
    script style noscript template iframe title textarea xmp noembed noframes head""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr
    q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
CONTAINERS = frozenset("body main article section div td".split())
#: An open element that a start tag ends implicitly, up to the element that bounds the search.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table article section div main body td th blockquote".split())
ENDS_P = frozenset("""address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav
    ol p pre section table ul""".split())
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer cookie cookies consent gdpr notice notices alert
    popup modal overlay comment comments reply replies disqus share sharing social related recommended newsletter
    subscribe subscription signup login pagination pager toolbar widget skip masthead topbar disclaimer""".split())
COMMENTS = frozenset("comment comments reply replies disqus".split())
PAGE_HEADER = frozenset("header masthead".split())
#: Pages a host must have to be asked about an element inside an article, and the share of them that makes it usual.
ASKED, USUAL = 5, 0.2
#: A container is left for an article or main that holds this share of its text, for another child at the greater share.
SHARE, NEARLY_ALL = 0.6, 0.9

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)


def digest(above: str, label: str) -> str:
    return hashlib.blake2b(f"{above}>{label}".encode(), digest_size=12).hexdigest()


class Element:
    __slots__ = ("tag", "label", "parent", "dropped", "suspect", "children", "own", "linked", "path", "blocks", "articles")

    def __init__(self, tag: str, label: str, parent: Element | None, dropped: bool, suspect: bool = False):
        self.tag, self.label, self.parent, self.dropped, self.suspect = tag, label, parent, dropped, suspect
        self.children: list[Element] = []
        self.own = 0  # characters outside links whose nearest container is this
        self.linked = tag == "a" or (parent is not None and parent.linked)
        above = parent.path if parent is not None else ""
        self.path = digest(above, label) if tag in CONTAINERS else above  # of the containers down to here
        # Blocks and articles among this and its ancestors.
        self.blocks = (tag not in INLINE) + (parent.blocks if parent is not None else 0)
        self.articles = (tag == "article") + (parent.articles if parent is not None else 0)


def describe(tag: str, attributes: str, inside_article: bool) -> tuple[str, bool, bool, bool]:
    """The element's generalised label (tag and classes), whether it is boilerplate, whether part of a name hints at it,
    and whether its host is to be asked."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    classes = sorted({re.sub(r"\d+", "0", c.lower()) for c in found.get("class", "").split()})
    label = ".".join([tag, *classes])
    if tag in DROPPED or (tag == "header" and not inside_article):
        return label, True, False, False
    if tag in ("body", "html", "article", "main"):
        return label, False, False, False
    words = BOILERPLATE if inside_article else BOILERPLATE | PAGE_HEADER
    names = [set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) for name in " ".join(found.values()).split()]
    whole = [name for name in names if name and name <= words]
    hidden = bool(attributes and HIDDEN.search(attributes))
    ask = inside_article and bool(whole) and not hidden and not any(name & COMMENTS for name in whole)
    return label, hidden or bool(whole), any(name & words for name in names), ask


def settle(root: Element, texts: list[tuple[Element, str | None]]) -> list[tuple[Element, str | None]]:
    """The texts without those of suspect elements; one stays that holds most of the page's text and all its articles."""
    order = [root]
    for e in order:
        order.extend(c for c in e.children if not c.dropped)
    if not any(e.suspect for e in order):
        return texts
    size, articles, above = dict.fromkeys(order, 0), dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    for e, text in texts:
        if text is not None and not e.linked:
            size[e] += len(text.strip())
    semantic = lambda e: e.tag in ("article", "main") and size[e] > 0
    for e in reversed(order):
        articles[e] += semantic(e)
        if e.parent is not None:
            size[e.parent] += size[e]
            articles[e.parent] += articles[e]
    for e in order[1:]:
        above[e] = above[e.parent] + semantic(e.parent)
        most = 2 * size[e] > size[root] and above[e] + articles[e] == articles[root]
        e.dropped = e.parent.dropped or (e.suspect and not most)
    return [(e, text) for e, text in texts if text is None or not e.dropped]


def parse(page: str, spared: Callable[[str], bool] | None = None,
          asked: set[str] | None = None) -> tuple[Element, list[tuple[Element, str | None]]]:
    """The tree, and its text in page order: (element, raw text), or None for a block border.

    ``spared`` tells by its path which element inside an article stays although a name of it is boilerplate;
    the paths asked about are added to ``asked``.
    """
    root = Element("html", "html", None, False)
    at, stack, texts = root, [root], []
    opened: Counter[str] = Counter()
    pos = 0
    end = len(page)

    def add(text: str) -> None:
        if text and not at.dropped:
            texts.append((at, text))

    def close(k: int) -> None:
        nonlocal at
        if stack[-1].blocks > stack[k - 1].blocks:
            texts.append((at, None))
        for e in stack[k:]:
            opened[e.tag] -= 1
        del stack[k:]
        at = stack[-1]

    while pos < end:
        m = TOKEN.search(page, pos)
        if m is None:
            rest = page[pos:]
            cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)  # a tag cut off at the page's end
            add(rest[:cut.start()] if cut else rest)
            break
        add(page[pos:m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag or not m[4]:
            continue
        if m[1]:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag == "p":
                texts.append((at, None))
            continue
        if tag in ("html", "head", "body") and opened[tag]:
            continue
        for ended, bounds in ((("p",), BOUNDS) if tag in ENDS_P else ((), ()), (ENDED_BY.get(tag, ()), BOUNDS - {"td", "th"} if tag in ("tr", "td", "th") else BOUNDS)):
            if not any(opened[t] for t in ended):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ended:
                    close(i)
                    break
                if stack[i].tag in bounds:
                    break
        if tag == "body" and opened["head"]:
            close(next(i for i in range(1, len(stack)) if stack[i].tag == "head"))
        if tag not in INLINE:
            texts.append((at, None))
        if tag in VOID:
            continue
        label, boilerplate, suspect, ask = describe(tag, m[3], at.articles > 0)
        if ask and not at.dropped:
            key = digest(at.path, label)
            if asked is not None:
                asked.add(key)
            if spared is not None and spared(key):
                boilerplate = suspect = False
        child = Element(tag, label, at, at.dropped or boilerplate, suspect)
        at.children.append(child)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, pos)
            pos = page.find(">", stop.start()) + 1 or end if stop else end
            continue
        if not m[3].endswith("/") or tag in CONTAINERS:
            stack.append(child)
            opened[tag] += 1
            at = child
    return root, settle(root, texts)


def holds_blocks(e: Element) -> bool:
    """Whether a container element contains blocks; one with plain text only is a paragraph."""
    return e.tag in ("body", "main", "article") or (e.tag in CONTAINERS and any(c.tag not in INLINE for c in e.children))


def container_of(e: Element) -> Element:
    while e.parent is not None and not holds_blocks(e):
        e = e.parent
    return e


def containers(e: Element) -> Iterator[Element]:
    """The nearest container elements below."""
    todo = list(e.children)
    for c in todo:
        if not c.dropped:
            if holds_blocks(c):
                yield c
            else:
                todo.extend(c.children)


def tally(root: Element, texts: list[tuple[Element, str | None]]) -> tuple[dict[Element, int], dict[Element, int]]:
    """The characters and the main headings that each element holds."""
    order, total, heads = [root], {}, {}
    for e in order:
        e.own = 0
        order.extend(c for c in e.children if not c.dropped)
    for e, text in texts:
        if text is not None and not e.linked:
            container_of(e).own += len(text.split()) and len(text)
    for e in reversed(order):
        below = [c for c in e.children if not c.dropped]
        total[e] = e.own + sum(total[c] for c in below)
        heads[e] = (e.tag in ("h1", "h2")) + sum(heads[c] for c in below)
    return total, heads


def score(root: Element, total: dict[Element, int], heads: dict[Element, int]) -> Element:
    """The page's best container."""
    best = root
    while best.tag != "article":
        child = max(containers(best), key=total.__getitem__, default=None)
        if child is None or not total[best]:
            break
        semantic = child.tag in ("article", "main") and best.tag != "main"
        if total[child] < (1 if best.tag == "main" else SHARE if semantic else NEARLY_ALL) * total[best]:
            break
        if not semantic and heads[best] and not heads[child]:
            break
        best = child
    return best


def text_of(texts: list[tuple[Element, str | None]], chosen: set[Element] | None) -> str:
    """Text below the chosen elements (None: all): blocks trimmed and joined by one space."""
    inside = set(chosen or ())
    todo = list(inside)
    for e in todo:
        new = [c for c in e.children if c not in inside]
        inside.update(new)
        todo.extend(new)
    parts = [" " if text is None else html.unescape(text) for e, text in texts if text is None or chosen is None or e in inside]
    return " ".join("".join(parts).split())


def vote(page: str | None) -> tuple[str | None, int, list[str], list[str]]:
    """The best container's path, the characters it holds, the paths of the containers beside it and its ancestors, and the
    paths inside articles that the host is asked about."""
    if not page or not page.strip():
        return None, 0, [], []
    asked: set[str] = set()
    root, texts = parse(page, asked=asked)
    total, heads = tally(root, texts)
    best = score(root, total, heads)
    if not total[best]:
        return None, 0, [], sorted(asked)
    above, e = {best}, best
    while e.parent is not None:
        e = e.parent
        above.add(e)
    beside = {c.path for e in above if e is not best and (holds_blocks(e) or e.parent is None)
              for c in containers(e) if total[c] and c not in above}
    return best.path, total[best], sorted(beside - {best.path}), sorted(asked)


def extract(page: str | None, path: str | None, beside: list[str] | None = None, usual_asked: list[str] | None = None,
            pages: int | None = None) -> str:
    """The page's text at the path, or at its own best container where the path holds less than its share of it.

    ``beside`` has the paths of containers that the host's pages usually have outside the path, ``usual_asked`` those
    of elements inside articles that ``USUAL`` of its ``pages`` have.
    """
    if not page:
        return ""
    common = frozenset(usual_asked or ())
    root, texts = parse(page, (lambda key: key not in common) if (pages or 0) >= ASKED else None)
    if path is not None:
        chosen: set[Element] = set()
        usual: list[Element] = []
        todo = [root]
        for e in todo:
            if not e.dropped:
                at = e.path if holds_blocks(e) else None
                if at == path:
                    chosen.add(e)
                elif at is not None and beside and at in beside:
                    usual.append(e)
                else:
                    todo.extend(e.children)
        if chosen and (text := text_of(texts, chosen)):
            total, heads = tally(root, texts)
            held = sum(total[e] for e in chosen)
            if held >= SHARE * (total[root] - sum(total[e] for e in usual)):
                return text
            for e in usual:
                e.dropped = True
                usual.extend(e.children)
            rest = [(e, t) for e, t in texts if t is None or not e.dropped]
            total, heads = tally(root, rest)
            best = score(root, total, heads)
            return text_of(rest, {best}) if total[best] > held else text
    return text_of(texts, {score(root, *tally(root, texts))})


def host_of(url: Column) -> Column:
    """The url's host in lower case, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path, beside, asked, pages): the path that most pages of the host vote for; ``pages`` has host and html.

    ``beside`` has the paths of the containers outside it that at least half of these pages have, ``asked`` the paths
    inside articles that ``USUAL`` of the host's pages have; both are bounded by what a page has.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        votes = [vote(p) for p in batch.column(1).to_pylist()]
        paths = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([v[k] for v in votes], t) for k, t in enumerate((pa.string(), pa.int64(), paths, paths)))],
            ["host", "path", "chars", "beside", "asked"])

    votes = stage(map_rows(pages.select("host", "html"), run,
                           "host string, path string, chars long, beside array<string>, asked array<string>", rows=256), "html-votes")
    cast = votes.where("path is not null")
    best = (cast.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
            .groupBy("host").agg(F.max(F.struct("n", "chars", "path")).alias("best")).select("host", "best.path", "best.n"))
    usual = (cast.select("host", "path", F.explode("beside").alias("other")).groupBy("host", "path", "other").agg(F.count("*").alias("m"))
             .join(best, ["host", "path"]).where("2 * m >= n").groupBy("host").agg(F.sort_array(F.collect_list("other")).alias("beside")))
    hosts = votes.groupBy("host").agg(F.count("*").alias("pages"))
    asked = (votes.select("host", F.explode("asked").alias("key")).groupBy("host", "key").agg(F.count("*").alias("m")).join(hosts, "host")
             .where(F.col("m") >= USUAL * F.col("pages")).groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("asked")))
    return hosts.join(best.drop("n"), "host", "left").join(usual, "host", "left").join(asked, "host", "left")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Query op9: (page_id, url, text, n_chars) per row."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    # Written first, so that Spark knows their size when it chooses the join.
    paths = stage(winning_paths(src), "html-paths")
    joined = src.join(paths, "host", "left").select("page_id", "url", "html", "path", "beside", "asked", "pages")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [extract(*row) for row in zip(*(batch.column(k).to_pylist() for k in range(2, 7)))]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                                          ["page_id", "url", "text", "n_chars"])

    return map_rows(joined, run, f"page_id {src.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long", rows=256)
