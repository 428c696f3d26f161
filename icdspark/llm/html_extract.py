"""Main text of web pages with a site style tree.

Each page is parsed into blocks of text and *branches*: containers such as
``div`` or ``ul`` and the blocks themselves, with a style path (tags and classes
from the body down).  The pages of a host are merged into one tree by these paths.

What a branch's presentation says about it is weighed on its own page.  Elements
that are menus, footers, asides, forms or code by their tag go.  A class, id or
role that is a known word as a whole is a vote against its element, which
doesn't count where the page's only article lies inside or nothing would be
left; lists that are all links go likewise.  Where the marked articles hold most
of the text, only they and headings in front of them stay.

The host's tree judges the rest by content: the entropy of a container's texts
over the host's pages, as a share of the largest possible one.  A container that
shows the same text page after page has a low entropy; what it repeats is
removed from each of them, and text that only one page has there stays.  A
heading or paragraph that nearly all of a host's pages repeat in one place goes
too, inside the article or not.

Pages that hold the same main text count once, so copies of one article don't
make it look like a template.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import map_rows, need_columns, stored, work_folder

#: What a branch with a smaller share of the possible entropy repeats is removed ...
MIN_IMPORTANCE = 0.3
#: ... if at least so many different pages of the host have it.
MIN_PAGES = 4

#: A block's text goes if so many different pages of the host, and this share of them, have it in one place.
SHARED_PAGES, SHARED_PART = 8, 0.9
#: Share of linked text, and of blocks with it, from which a container outside the article is a menu.
LINKED, LINKED_BLOCKS = 0.9, 3
#: Share of the page's text from which marked articles are taken to be its main text.
MAIN_PART = 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
#: Raw elements that run to the end of the page where their end tag is missing; others then lose only their tag.
_CODE = frozenset({"script", "style"})
_NOISE_TAGS = frozenset("nav footer aside form button dialog menu head".split())
_MAIN_TAGS = frozenset({"article", "main"})
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
    .split())
_CONTAINERS = frozenset("div section ul ol dl table header figure details blockquote fieldset center".split())
_CLOSES_P = _BLOCKS - {"body", "html"}
#: Classes, ids and roles that say, as a whole, what an element is.
_NOISE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget notice cookie cookies "
    "consent gdpr banner ad ads advert adverts advertisement advertising sponsor sponsored promo popup modal overlay form "
    "login signup newsletter subscribe comment comments reply replies respond disqus share sharing social related "
    "recommended pagination pager toolbar skip complementary contentinfo search "
    "main-nav site-nav nav-bar nav-menu main-menu site-header page-header site-footer page-footer left-sidebar right-sidebar "
    "sidebar-left sidebar-right cookie-notice cookie-banner cookie-bar cookie-consent ad-container ad-slot ad-banner "
    "ad-wrapper google-ad share-buttons social-links social-share comment-list comments-area comment-form related-posts "
    "search-form login-form newsletter-signup skip-link".split())
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_CLASS = re.compile(r"""(?:^|\s)class\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SEPARATORS = re.compile(r"[\"'\s]+")
_MASK = (1 << 64) - 1
#: Base of the rolling hash over a page's blocks.
_BASE = 0x9E3779B97F4A7C15


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


class _Element:
    __slots__ = ("tag", "path", "gone", "main", "vote", "branch")

    def __init__(self, tag, path, gone, main, vote, branch):
        self.tag, self.path, self.gone, self.main, self.vote, self.branch = tag, path, gone, main, vote, branch


class Page:
    """The blocks of a page, the branches around them and the votes against some; linear in the page, however deep it is.

    ``blocks``: text, path, whether in a marked article, vote (-1: none),
    characters of links, heading.  ``branches``: path, first block, end, whether
    in a marked article; a branch is a range of blocks, so none lists its
    ancestors, and a path is a hash.  ``votes``: the vote around it, whether it
    holds a marked article.
    """

    def __init__(self, source: str | None):
        self.blocks: list[tuple[str, int, bool, int, int, bool]] = []
        self.branches: list[list] = []
        self.votes: list[list] = []
        self._free_main = False  # a marked article that no vote is against
        self._stack = [_Element("", 0, False, False, -1, -1)]
        self._open_tags: dict[str, int] = {}
        self._text: list[str] = []
        self._linked = 0
        self._parse(source or "")

    def _add(self, text: str) -> None:
        self._text.append(text)
        if self._open_tags.get("a"):
            self._linked += len(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(entities.unescape("".join(self._text)).split())
            top, linked = self._stack[-1], self._linked
            self._text, self._linked = [], 0
            if text and not top.gone:
                heading = bool(self._open_tags.get("h1"))
                self.blocks.append((text, top.path, top.main, top.vote, min(linked, len(text)), heading))

    def _push(self, tag: str, attributes: str) -> None:
        top = self._stack[-1]
        named = _CLASS.search(attributes) if attributes else None
        classes = sorted(named[1].strip("\"'").lower().split()) if named else []
        gone = top.gone or tag in _NOISE_TAGS or (tag == "header" and not top.main)
        vote = top.vote
        if attributes and not gone and tag not in ("html", "body"):
            gone = bool(_HIDDEN.search(attributes))
            words = _SEPARATORS.split(" ".join(_NAMES.findall(attributes)).lower())
            if not gone and not _NOISE_WORDS.isdisjoint(words):
                vote = len(self.votes)
                self.votes.append([top.vote, False])
        path = _hash(f"{top.path}/{'.'.join([tag, *classes])}") if tag in _BLOCKS else top.path
        main = not gone and (top.main or (tag in _MAIN_TAGS and vote == top.vote))
        if main and not top.main:
            self._free_main |= vote < 0
            at = vote
            while at >= 0 and not self.votes[at][1]:
                self.votes[at][1] = True
                at = self.votes[at][0]
        branch = -1
        if tag in _CONTAINERS and not gone:
            branch = len(self.branches)
            self.branches.append([path, len(self.blocks), -1, main])
        self._stack.append(_Element(tag, path, gone, main, vote, branch))
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1

    def _pop(self) -> None:
        e = self._stack.pop()
        self._open_tags[e.tag] -= 1
        if e.branch >= 0:
            self.branches[e.branch][2] = len(self.blocks)

    def _close(self, tag: str) -> None:
        if self._open_tags.get(tag):
            while self._stack[-1].tag != tag:
                self._pop()
            self._pop()

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        never_closed: set[str] = set()  # from here to the end of the page
        while at < size:
            start = source.find("<", at)
            if start < 0:
                self._add(source[at:])
                break
            if start > at:
                self._add(source[at:start])
            m = _TAG.match(source, start)
            if not m:  # a sign, not a tag
                self._add("<")
                at = start + 1
                continue
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in _BLOCKS:
                self._flush()
            if m[1]:
                self._close(tag)
                continue
            if tag in _RAW:
                if tag in never_closed or (tag in ("svg", "math") and m[3].endswith("/")):
                    continue
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                if end:
                    at = end.end()
                elif tag in _CODE:
                    at = size
                else:
                    never_closed.add(tag)
                continue
            if tag == "br":
                self._add(" ")
            if tag in _VOID:
                continue
            if tag in _CLOSES_P:
                self._close("p")
            if m[3].endswith("/") and tag not in _BLOCKS:
                continue
            self._push(tag, m[3])
        self._flush()
        while len(self._stack) > 1:
            self._pop()

    def _voted_out(self) -> list[bool]:
        """Which votes count: those that don't hold the page's only article, and what lies inside such ones."""
        out: list[bool] = []
        for around, holds in self.votes:  # a vote comes after the one around it
            out.append((around >= 0 and out[around]) or self._free_main or not holds)
        return out

    def kept(self) -> list[int]:
        """The numbers of the blocks that presentation leaves."""
        out = self._voted_out()
        left = [i for i, b in enumerate(self.blocks) if b[3] < 0 or not out[b[3]]] or list(range(len(self.blocks)))
        sums = [0]
        for b in self.blocks:
            sums.append(sums[-1] + len(b[0]))
        inside = [i for i in left if self.blocks[i][2]]
        titles = [i for i in left if inside and i < inside[0] and self.blocks[i][5]]
        length = lambda chosen: sum(len(self.blocks[i][0]) for i in chosen)
        if inside and length(inside) >= MAIN_PART * (length(left) - length(titles)):
            return titles + inside
        links, linked = [0], [0]
        for b in self.blocks:
            links.append(links[-1] + b[4])
            linked.append(linked[-1] + (b[4] >= LINKED * len(b[0])))
        menu = [0] * (len(self.blocks) + 1)
        for _, a, b, main in self.branches:
            if not main and linked[b] - linked[a] >= LINKED_BLOCKS and links[b] - links[a] >= LINKED * (sums[b] - sums[a]):
                menu[a] += 1
                menu[b] -= 1
        for i in range(1, len(menu)):
            menu[i] += menu[i - 1]
        return [i for i in left if not menu[i]] or left


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def parse(source: str | None) -> tuple[list[str], list[int], list[int], list[int], list[int], list[bool]]:
    """Block texts of one page, and its branches: path, first block, end, hash of the content, whether a single block.

    A path that a page has several times is one branch in each place, with the
    content of all of them.
    """
    page = Page(source)
    kept = page.kept()
    number = {at: n for n, at in enumerate(kept)}
    texts = [page.blocks[i][0] for i in kept]
    codes = [_hash(t) for t in texts]
    sums = [0]
    for c in codes:  # a range's content is a difference of these, moved to the front
        sums.append((sums[-1] * _BASE + c) & _MASK)
    powers = [1]
    for _ in codes:
        powers.append(powers[-1] * _BASE & _MASK)
    before = [0]
    for i in range(len(page.blocks)):
        before.append(before[-1] + (i in number))
    found = [(path, before[a], before[b], False) for path, a, b, _ in page.branches if before[a] < before[b]]
    found += [(_hash(str(page.blocks[at][1]), 1), n, n + 1, True) for at, n in number.items()]
    content: dict[int, int] = {}
    for path, a, b, block in found:
        if not block:
            own = (sums[b] - sums[a] * powers[b - a]) & _MASK
            content[path] = (content.get(path, 0) * _BASE + own + b - a) & _MASK
    return (
        texts, [_signed(x[0]) for x in found], [x[1] for x in found], [x[2] for x in found],
        [_signed(codes[x[1]] if x[3] else content[x[0]]) for x in found], [x[3] for x in found])


def low_branches(branches: DataFrame, min_importance: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, path, content``: what the style tree's branches with little content of their own repeat.

    ``branches`` has ``host, path, content, main`` (hashes of the branch's and
    of the page's text).  Importance is the entropy of ``content`` over the
    different pages of the host that have the path, divided by its largest
    possible value; entropies come from grouped counts, so a host of any size
    is summed up before it is shuffled.  A content that one page alone has
    isn't returned, however low its branch is.
    """
    texts = branches.distinct().groupBy("host", "path", "content").count()
    low = (
        texts.groupBy("host", "path")
        .agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.log2("count")).alias("s"))
        .filter(F.col("n") >= min_pages)
        .filter((F.log2("n") - F.col("s") / F.col("n")) / F.log2("n") < min_importance)
        .select("host", "path")
    )
    return texts.filter("count > 1").drop("count").join(low, ["host", "path"], "left_semi")


def shared_blocks(
    blocks: DataFrame, min_pages: int = SHARED_PAGES, part: float = SHARED_PART
) -> DataFrame:
    """``host, path, content``: block texts that nearly all different pages of a host have in one place."""
    texts = blocks.distinct().groupBy("host", "path", "content").count()
    pages = blocks.select("host", "main").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return texts.filter(F.col("count") >= min_pages).join(pages, "host").filter(
        F.col("count") >= part * F.col("pages")).select("host", "path", "content")


def extract(pages: DataFrame, min_importance: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES,
            id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree: bool = True) -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.

    Blocks are joined by line feeds; white space inside one is a single space,
    character references are decoded.  Null and empty pages have an empty
    text.  A null or broken url makes pages of one nameless host.  Repeated
    rows and null ids get a row each; an empty table gives an empty one; other
    columns are ignored.  ``tree=False`` leaves the host's tree out.
    """
    need_columns(pages, id_col, url_col, html_col)
    folder = work_folder(pages.sparkSession)
    texts, longs, numbers = pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())
    fields = {"texts": texts, "paths": longs, "starts": numbers, "ends": numbers, "contents": longs, "single": pa.list_(pa.bool_()),
              "host": pa.string()}
    parsed = map_rows(
        pages, {"page_id": F.col(id_col), "url": F.col(url_col)}, [F.col(url_col), F.col(html_col)], fields,
        lambda urls, sources: [(*parse(s), host_of(u)) for u, s in zip(urls, sources, strict=True)])
    plain = F.concat_ws("\n", "texts")
    if not tree:
        return parsed.select("page_id", "url", plain.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
    # the row numbers are written with the rows, so they stay the same from here on
    found = stored(parsed.withColumn("row", F.monotonically_increasing_id()), folder, "parsed")
    branches = found.filter(F.size("paths") > 0).select(
        "row", "host", F.xxhash64(plain).alias("main"),
        F.explode(F.arrays_zip("paths", "starts", "ends", "contents", "single")).alias("b")
    ).select("row", "host", "main", F.col("b.paths").alias("path"), F.col("b.contents").alias("content"),
             F.col("b.starts").alias("start"), F.col("b.ends").alias("end"), F.col("b.single").alias("single"))
    seen = ["host", "path", "content", "main"]
    low = low_branches(branches.filter(~F.col("single")).select(seen), min_importance, min_pages)
    gone = low.unionByName(shared_blocks(branches.filter("single").select(seen)))
    removed = (
        branches.select("row", "host", "path", "content", "start", "end").join(gone, ["host", "path", "content"])
        .groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("removed"))
    )
    removed = stored(removed, folder, "removed")
    kept = F.filter("texts", lambda t, i: ~F.exists("removed", lambda r: (r["start"] <= i) & (i < r["end"])))
    text = F.when(F.col("removed").isNull(), plain).otherwise(F.concat_ws("\n", kept))
    return found.join(removed, "row", "left").select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
