"""Main text of web pages by differencing each page with the one nearest by URL.

A page becomes text blocks in page order. Structure decides what it can: blocks inside an article are its text, blocks in
menus, adverts, footers, forms and the like are not, by their elements or by whole names in class, id and role; reader
comments never are, articles among them included. Names on the body do not count, and furniture that holds the main element or all
the page has is none. For the rest the page is compared with its nearest neighbour of
the same host by URL path that has other content: the blocks outside articles are aligned by a longest common subsequence,
and blocks both pages share are the site's and go. Copies of a page share every line, so they count as one page. Articles are
not differenced: copies of an article on one host share every line, too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, materialize, prepare, table

# Elements and names that say what a part of a page is.
DROPPED_TAGS = {
    "aside", "button", "dialog", "footer", "form", "head", "iframe", "menu", "nav", "noscript", "object", "script", "select", "style", "svg",
    "template", "textarea", "title",
}
ARTICLE_TAGS = {"article", "main"}
BLOCK_TAGS = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "option", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HEAD_TAGS = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noscript", "script", "style", "template", "title"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CELL_ENDS = {"td", "th", "tr", "tbody", "thead", "tfoot"}
#: Elements whose end tag may be left out, and the start tags that end them.
IMPLIED_ENDS = {
    "p": BLOCK_TAGS,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "td": _CELL_ENDS,
    "th": _CELL_ENDS,
    "tr": _CELL_ENDS - {"td", "th"},
    "tbody": {"tbody", "thead", "tfoot"},
    "thead": {"tbody", "thead", "tfoot"},
    "tfoot": {"tbody", "thead", "tfoot"},
}
#: By the tag that starts: the open elements outside of which it ends nothing; for the others, the nearest block.
ENDS_WITHIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, **dict.fromkeys(_CELL_ENDS, {"table"})}
#: Whole values of class, id or role.
FURNITURE = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "footer", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo",
    "related", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
COMMENTS = {"comment", "comments", "disqus", "disqus_thread"}
#: First or last words of a name that say it all.
TELLING = {"advert", "advertisement", "breadcrumb", "breadcrumbs", "consent", "cookie", "cookies", "navbar", "newsletter", "pagination", "sponsored"}
#: First words that turn a name around: what the page has or lacks, not what the element is.
ABOUT = {"has", "hide", "is", "no", "show", "with", "without"}

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[-_]+")
_CUT_TAG = re.compile(r"<[/!?]?[a-zA-Z-]")
ARTICLE, PLAIN, DROPPED = "a", "p", "d"
_HARD, _SOFT = "hard", "soft"


def _named(attrs: list[tuple[str, str | None]]) -> str | None:
    """What an element's names make it: dropped for good (comments, hidden ones), dropped unless it holds the page, or nothing."""
    found = None
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return _HARD
        if name not in ("class", "id", "role") or not value:
            continue
        for one in value.lower().split():
            words = [w for w in _NAME.split(one) if w]
            ends = {words[0], words[-1]} if words and words[0] not in ABOUT else set()
            if one in COMMENTS or ends & {"comment", "comments"}:
                return _HARD
            if one in FURNITURE or ends & TELLING:
                found = _SOFT
    return found


class _Blocks(HTMLParser):
    """Blocks of a page as (role, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self._open: list[tuple[str, str | int | None]] = []  # tag, and its role or the number of its mark
        self._found: list[tuple[str, tuple[int, ...], str]] = []
        self._text: list[str] = []
        self._marks, self._void = 0, set()

    def _flush(self) -> None:
        if not self._text:
            return
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        self._text = []
        if text:
            kinds = [kind for _, kind in self._open]
            # What is dropped stays dropped, whatever it holds: an article among comments is a comment.
            role = DROPPED if _HARD in kinds else ARTICLE if ARTICLE in kinds else PLAIN
            self._found.append((role, tuple(k for k in kinds if isinstance(k, int)), text))

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self._text.append("\n")
        kind = self._kind(tag, attrs)
        if tag in BLOCK_TAGS or kind:
            self._flush()
        if tag not in HEAD_TAGS and any(t == "head" for t, _ in self._open):
            # The first element of the body ends a head without an end tag.
            del self._open[next(i for i, (t, _) in enumerate(self._open) if t == "head") :]
        if tag in BLOCK_TAGS:
            self._end_what_is_implied(tag)
        if tag in VOID_TAGS:
            return
        if tag == "main":
            self._void.update(k for _, k in self._open if isinstance(k, int))
        if tag in BLOCK_TAGS or kind:
            self._open.append((tag, kind))

    def _end_what_is_implied(self, tag: str) -> None:
        border = ENDS_WITHIN.get(tag, BLOCK_TAGS)
        for at in range(len(self._open) - 1, -1, -1):
            opened = self._open[at][0]
            if tag in IMPLIED_ENDS.get(opened, ()):
                # A cell ends, and then its row: go on outward.
                del self._open[at:]
            elif opened in border:
                return

    def _kind(self, tag: str, attrs) -> str | int | None:
        if tag in ("html", "body"):
            return None
        if tag in DROPPED_TAGS or tag == "header" and not any(k == ARTICLE for _, k in self._open):
            return _HARD
        named = _named(attrs)
        if named == _SOFT and tag != "main":
            self._marks += 1
            return self._marks
        return named if named == _HARD else ARTICLE if tag in ARTICLE_TAGS else None

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self._text.append("\n")
        elif tag in BLOCK_TAGS:
            self._flush()
            self._end_what_is_implied(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self._open) - 1, -1, -1) if self._open[i][0] == tag), None)
        if tag in BLOCK_TAGS or at is not None:
            self._flush()
        if at is not None:
            del self._open[at:]

    def handle_data(self, data):
        self._text.append(data)

    def close(self):
        # A tag that the page ends in is markup.
        if _CUT_TAG.match(self.rawdata):
            self.rawdata = ""
        super().close()
        self._flush()

    def blocks(self) -> list[tuple[str, str]]:
        """Furniture goes, unless it holds the page's main element or all that the page has."""
        void = self._void
        if all(role == DROPPED or not void.issuperset(marks) for role, marks, _ in self._found):
            void = set(range(1, self._marks + 1))
        return [(role if void.issuperset(marks) else DROPPED, text) for role, marks, text in self._found]


def blocks_of(html: str) -> list[tuple[str, str]]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    return parser.blocks()


def common_subsequence(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence, by bit-parallel rows."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    mid_a, mid_b = a[start : len(a) - end], b[start : len(b) - end]
    where: dict = {}
    for j, x in enumerate(mid_b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(mid_b)) - 1
    row, rows = full, []  # a zero bit at j: the subsequence with b[: j + 1] is one longer than with b[:j]
    for x in mid_a:
        rows.append(row)
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    picked, j = [], len(mid_b)
    for i in range(len(mid_a) - 1, -1, -1):
        before = rows[i]
        after = rows[i + 1] if i + 1 < len(rows) else row
        mask = (1 << j) - 1
        if (~after & mask).bit_count() > (~before & mask).bit_count():
            picked.append(i)
            # Back to the last element of b that ends a subsequence of this length.
            j = (~after & mask).bit_length() - 1
    return [*range(start), *(start + i for i in reversed(picked)), *range(len(a) - end, len(a))]


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(``id_column``, ``url_column``, text) of every page.

    White space inside a block is one space, blocks are joined by an empty line. Null and empty pages have an empty text.
    Pages without a host, or whose host has no page with other content, are not differenced. Of two pages equally near the one
    before counts. A page of any length is taken whole. Rows of one host that are equal in
    all blocks but those tags and classes drop (repeated rows, one page under several URLs) are one page to the differencing, at
    the first of its URLs, and each give a row. Other columns are ignored; an empty table gives an empty result.
    """
    prepare(pages.sparkSession)
    row = F.xxhash64(id_column, url_column, html_column)
    narrow = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"), row.alias("row"))

    def parse(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            found = blocks_of(row.pop("html") or "")
            outside = [(r, xxhash.xxh64_intdigest(t) >> 1) for r, t in found if r != ARTICLE]
            kept = [(r, t) for r, t in found if r != DROPPED]
            host, path = _place(row["url"])
            roles, texts = "".join(r for r, _ in kept), [t for _, t in kept]
            yield row | {
                "host": host, "path": path, "page": xxhash.xxh3_128_digest("\0".join([host, roles, *texts])),
                "outside": [h for _, h in outside],
                "plain": [i for i, (r, _) in enumerate(outside) if r == PLAIN],
                "roles": roles, "texts": texts,
            }

    id_type = narrow.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, url string, row bigint, host string, path string, page binary, outside array<bigint>, plain array<int>, roles string, texts array<string>"
    parsed = materialize(map_rows(narrow, parse, schema), "parsed-pages")
    shared = map_rows(_neighbours(parsed.where("host <> ''")), _shared, "page binary, shared array<int>")
    texts = parsed.select("id", "url", "page", "plain", "roles", "texts")
    # Only pages with undecided blocks wait for an answer; the texts of the others go nowhere.
    asking = texts.where(F.size("plain") > 0).join(materialize(shared, "shared-blocks"), "page", "left")
    met = asking.unionByName(texts.where(F.size("plain") == 0), allowMissingColumns=True)

    def write(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            gone, at, out = set(row["shared"] or ()), 0, []
            for role, text in zip(row["roles"], row["texts"]):
                if role == ARTICLE:
                    out.append(text)
                    continue
                if at not in gone:
                    out.append(text)
                at += 1
            yield {"id": row["id"], "url": row["url"], "text": "\n\n".join(out)}

    done = map_rows(met.select("id", "url", "roles", "texts", "shared"), write, f"id {id_type}, url string, text string")
    return done.withColumnsRenamed({"id": id_column, "url": url_column})


def _place(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return "", ""


def _neighbours(parsed: DataFrame) -> DataFrame:
    """Each page that has undecided blocks, once, with the pages of other content before and after it by host and path.

    Copies would be each other's nearest pages, so of each group of them only the one with the first URL is ordered.
    Ranges of (host, path) are dealt to tasks, so a large host is spread; ranges' first and last pages, one row per
    task, close the gaps between them.
    """
    order = ["host", "path", "row"]
    fields = ["host", "path", "outside"]
    first = F.min(F.struct(*order, "plain", "outside")).alias("first")
    keys = parsed.groupBy("page").agg(first).select("page", "first.*")
    ranged = materialize(keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "page-ranges")
    page = F.struct(*fields)
    within = Window.partitionBy("range").orderBy(*order)
    near = ranged.withColumn("before", F.lag(page).over(within)).withColumn("after", F.lead(page).over(within))
    ends = ranged.groupBy("range").agg(F.min_by(page, F.struct(*order)).alias("first"), F.max_by(page, F.struct(*order)).alias("last"))
    across = Window.orderBy("range")
    ends = ends.select("range", F.lag("last").over(across).alias("earlier"), F.lead("first").over(across).alias("later"))
    met = near.where(F.size("plain") > 0).join(ends, "range", "left")
    same = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.col(c))
    met = met.withColumn("before", F.coalesce("before", "earlier")).withColumn("after", F.coalesce("after", "later"))
    return met.select("page", "path", "outside", "plain", same("before").alias("before"), same("after").alias("after"))


def _shared(rows: Iterator[dict]) -> Iterator[dict]:
    """Of each page's undecided blocks, by number, those the nearest page has too."""
    for row in rows:
        near = max((n for n in (row["before"], row["after"]) if n), key=lambda n: _alike(n["path"], row["path"]), default=None)
        if near:
            common = set(common_subsequence(row["outside"], near["outside"]))
            yield {"page": row["page"], "shared": [k for k, at in enumerate(row["plain"]) if at in common]}


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    done = extract(table(spark, sf_dir, "pages"))
    return done.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
