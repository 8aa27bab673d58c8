"""Main text of web pages by differencing each page with its nearest page by URL.

Pages are ordered by host, path and id; of its two neighbours on the same host a page is paired with the one
whose path shares more leading characters. Both pages are cut into text lines (one per block), the lines are
aligned by a longest common subsequence, and shared lines are deleted. What marks itself as something else
(menus, footers, adverts, comments and so on, by element, class, id or role) goes in any case, as does what
stands outside the article of a page that names one. Shared lines inside a named article, and those of a page that
shares most of its text with its neighbour, may be copies of content: they go only if the host shows them to be
templates, beside three different bodies, and stay otherwise.

The pairing moves line digests only; the pages themselves are read again where they lie.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import stored

# Elements whose text is never page text, elements around the main text, elements and names of page parts that are not main text, and elements inside a line.
SILENT = {"script", "style", "noscript", "template", "head", "title", "iframe", "svg", "canvas", "object", "math", "select", "option", "textarea", "button", "audio", "video", "datalist"}
MAIN = {"article", "main"}
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "header"}
ASIDE_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "overlay", "pagination", "popup", "promo", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget",
}
COMMENT_NAMES = {"comment", "comments", "disqus", "replies", "reply"}
# Words before a name that say something of another element, and words behind one that leave its meaning.
MODIFIERS = {"has", "have", "hide", "hides", "is", "no", "non", "not", "show", "shows", "with", "without"}
BOX_NAMES = {"area", "bar", "block", "body", "box", "button", "buttons", "container", "content", "group", "inner", "item", "items", "link", "links", "list", "panel", "section", "slot", "unit", "wrap", "wrapper"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_RAW = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in ("script", "style", "title", "textarea", "noscript", "iframe")}
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
REOPENED, IN_ARTICLE, ELSEWHERE, APART, PART, COMMENTS, SILENCED = 2, 1, 0, -1, -2, -3, -4  # outside of cut_lines the second to fourth only
EACH = pa.struct([("line", pa.int64()), ("body", pa.int64()), ("size", pa.int32()), ("shared", pa.bool_())])


def named_apart(token: str) -> bool:
    """Whether a class, id or role says that an element is such a part: alone, at its end, or with words for a box behind it."""
    words = [w.lower() for w in _WORD.findall(token)]
    if not words or words[0] in MODIFIERS and len(words) > 1:
        return False
    return words[-1] in ASIDE_NAMES or words[0] in ASIDE_NAMES and BOX_NAMES.issuperset(words[1:])


def standing(tag: str, attributes: str, in_article: bool) -> int:
    """Where an element puts its text: ELSEWHERE if it changes nothing, PART by its element, APART by its name or as a form, COMMENTS."""
    if tag in ("body", "html"):
        return ELSEWHERE
    tokens = [t for found in _NAMES.findall(attributes) for t in "".join(found).split()]
    if any(named_apart(t) and not COMMENT_NAMES.isdisjoint(w.lower() for w in _WORD.findall(t)) for t in tokens):
        return COMMENTS
    if tag in ASIDE and tag != "form":
        return ELSEWHERE if tag == "header" and in_article else PART
    if tag in MAIN:
        return ELSEWHERE
    return APART if tag == "form" or any(map(named_apart, tokens)) else ELSEWHERE


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """The text lines of a page in order, each with where it stands. Unclosed and cut tags are borne.

    A page without article keeps forms and named elements that hold three quarters of its text, links and menus apart.
    An article inside an element that stands apart is then the page's if it is no comment, no other article is there and
    the text elsewhere is not longer.
    """
    page = page or ""
    lines, parts, size = cut_lines(page, frozenset())
    if all(w != IN_ARTICLE for _, w in lines):
        wrappers = frozenset(at for at, begin, end in parts if end > begin and 4 * (end - begin) >= 3 * size)
        if wrappers:
            lines = cut_lines(page, wrappers)[0]
        inside, open_, named = (sum(len(t) for t, w in lines if w == place) for place in (REOPENED, ELSEWHERE, IN_ARTICLE))
        if inside >= open_ and not named:
            lines = [(t, IN_ARTICLE if w == REOPENED else w) for t, w in lines]
    return [(t, w if w in (IN_ARTICLE, ELSEWHERE) else APART) for t, w in lines]


def cut_lines(page: str, wrappers: frozenset[int]) -> tuple[list[tuple[str, int]], list[list[int]], int]:
    """Lines with where they stand; forms and named elements with the text before their begin and end; all text. Elements at `wrappers` change nothing."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int, int]] = []  # open elements that change where text stands, and others of the same name inside
    parts: list[list[int]] = []
    where, at, size, link = ELSEWHERE, 0, 0, False

    def close_line() -> None:
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            out.append((line, where))
        text.clear()

    def leave() -> int:
        _, before, part = stack.pop()
        if part >= 0:
            parts[part][2] = size
        return before

    while at < len(page):
        tag = _TAG.search(page, at)
        chunk = page[at : tag.start() if tag else len(page)]
        text.append(chunk)
        if not link and where > PART:
            size += len(chunk.strip())
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if name == "a":
            link = not tag[1]
        if not name or name in INLINE and not stack and "=" not in (tag[3] or ""):
            continue
        if tag[1]:
            if any(n == name for n, *_ in stack):
                close_line()
                while stack[-1][0] != name:
                    leave()
                where = leave()
            elif name not in INLINE:
                close_line()
            continue
        if name in SILENT:
            close_line()
            if name in _RAW:
                end = _RAW[name].search(page, at)
                at = end.end() if end else len(page)
                continue
            stack.append((name, where, -1))
            where = SILENCED
        elif name in VOID:
            if name not in INLINE:
                close_line()
        elif where > COMMENTS and tag.start() not in wrappers and (place := standing(name, tag[3] or "", where in (IN_ARTICLE, REOPENED))) != ELSEWHERE:
            close_line()
            stack.append((name, where, len(parts) if place == APART else -1))
            if place == APART:
                parts.append([tag.start(), size, -1])
            where = min(where, place)
        elif where > COMMENTS and name in MAIN:
            close_line()
            stack.append((name, where, -1))
            where = REOPENED if name == "article" and where in (APART, PART, REOPENED) else IN_ARTICLE
        else:
            if name not in INLINE:
                close_line()
            if any(n == name for n, *_ in stack):  # so that its end does not close the outer one
                stack.append((name, where, -1))
    close_line()
    return out, [[at, begin, size if end < 0 else end] for at, begin, end in parts], size


def shared_lines(mine: list[int], other: list[int]) -> list[int]:
    """Positions in `mine` of a longest common subsequence with `other`."""
    places: dict[int, list[int]] = {}
    for j in range(len(other) - 1, -1, -1):
        places.setdefault(other[j], []).append(j)
    ends: list[int] = []  # least end in `other` of a common subsequence of each length
    chains: list[tuple] = []
    for i, line in enumerate(mine):
        for j in places.get(line, ()):
            n = bisect_left(ends, j)
            chain = (i, chains[n - 1] if n else None)
            if n == len(ends):
                ends.append(j), chains.append(chain)
            elif j < ends[n]:
                ends[n], chains[n] = j, chain
    out, chain = [], chains[-1] if chains else None
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return out[::-1]


def main_place(where: list[int]) -> int:
    """Where a page's text stands: in its article if it names one."""
    return IN_ARTICLE if IN_ARTICLE in where else ELSEWHERE


def deletions(lines: list[int], where: list[int], sizes: list[int], shared: list[int], templates: set[int]) -> list[int]:
    """Shared lines that the difference deletes. In an article, and where most of a page is shared, only templates go."""
    place = main_place(where)
    if place == ELSEWHERE and 2 * sum(sizes[i] for i in shared) <= sum(n for n, w in zip(sizes, where, strict=True) if w == place):
        return shared
    return [i for i in shared if lines[i] in templates]


def paired(lines: DataFrame) -> DataFrame:
    """`(row, other)`: each row's partner, the neighbour in (host, path, row) order on the same host with the longer common start of the path."""
    order = ["host", "path", "row"]
    keys = stored(lines.select(*order).dropDuplicates().repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    row = F.struct("host", "path", "row")
    near = keys.select("*", F.lag(row).over(inside).alias("before"), F.lead(row).over(inside).alias("after"))
    # A range's first and last rows look into the ranges beside it: two rows a range, in order.
    edges = keys.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    beside = Window.partitionBy(F.lit(1)).orderBy("part")
    edges = edges.select("part", F.lag("last").over(beside).alias("left"), F.lead("first").over(beside).alias("right"))
    near = near.join(edges, "part").withColumn("before", F.coalesce("before", "left")).withColumn("after", F.coalesce("after", "right"))

    def common(side: str):
        same = F.col(f"{side}.host") == F.col("host")
        width = F.least(F.length("path"), F.length(f"{side}.path"))
        start = F.aggregate(
            F.sequence(F.lit(1), width + 1), F.lit(0), lambda n, i: F.when((n == i - 1) & (i <= width) & (F.substring("path", i, F.lit(1)) == F.substring(F.col(f"{side}.path"), i, F.lit(1))), i).otherwise(n)
        )
        return F.when(same, start)

    scored = near.select("row", F.col("before.row").alias("b"), F.col("after.row").alias("a"), common("before").alias("nb"), common("after").alias("na"))
    other = F.when(F.col("nb").isNull() & F.col("na").isNull(), None).when(F.col("na").isNull() | (F.col("nb") >= F.col("na")), F.col("b")).otherwise(F.col("a"))
    return scored.select("row", other.alias("other")).where("other is not null")


def templates(met: DataFrame) -> DataFrame:
    """`(row, templates)`: the lines of a page that are the host's and not the page's.

    A page's body is its longest line that most pages of the host do not have, without digits. A line is a template if
    three different bodies stand beside it and most pages of the host have it, or at least eight pages share it with
    their neighbour, which are half of those that have it: a part of the host.
    """
    each = met.select("row", "site", F.explode("each").alias("x")).select("row", "site", "x.*")
    counts = each.groupBy("site", "line").agg(F.count(F.lit(1)).alias("holders"), F.count_if("shared").alias("sharers")).where("sharers > 0")
    counts = stored(counts).join(stored(met.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))), "site")
    most, part = 2 * F.col("holders") > F.col("pages"), (2 * F.col("sharers") >= F.col("holders")) & (F.col("sharers") >= 8)
    counts = stored(counts.select("site", "line", most.alias("most"), (most | part).alias("common")))
    met_lines = each.join(counts, ["site", "line"], "left")
    body = F.max(F.when(~F.coalesce("most", F.lit(False)), F.struct("size", "body")))["body"].alias("body")
    lines = F.collect_list(F.when(F.col("shared") & F.col("common"), F.col("line"))).alias("lines")
    judged = stored(met_lines.groupBy("row", "site").agg(body, lines).where("size(lines) > 0"))
    beside = judged.select("row", "site", "body", F.explode("lines").alias("line"))
    found = beside.select("site", "line", "body").where("body is not null").distinct().groupBy("site", "line").count().where("count > 2").select("site", "line")
    return beside.join(stored(found), ["site", "line"]).groupBy("row").agg(F.collect_list("line").alias("templates"))


def main_text(pages: DataFrame) -> DataFrame:
    """`(page_id, url, text)`: the main text of every page, '' if there is none.

    Null html counts as empty. Page ids and urls may be null or repeat; rows equal in id, url and html get the same
    text. Pages without a host form a host of their own. Other columns are not read; an empty table gives no rows.
    """
    # The key of a row, from its columns alone, so that a second reading finds it again.
    row = F.xxhash64("page_id", "url", "html").alias("row")
    address = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://|[?#].*$", "")
    host = F.lower(F.substring_index(address, "/", 1))
    path = F.substring(address, F.length(host) + 1, F.length(address))
    source = pages.select(row, host.alias("host"), path.alias("path"), "html")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [lines_of(p) for p in batch.column("html").to_pylist()]
            digests = [np.array([xxhash.xxh64_intdigest(t) for t, _ in p], np.uint64).view(np.int64) for p in parsed]
            bodies = [np.array([xxhash.xxh64_intdigest(_DIGITS.sub("", t)) for t, _ in p], np.uint64).view(np.int64) for p in parsed]
            arrays = [pa.array(digests, pa.list_(pa.int64())), pa.array([[w for _, w in p] for p in parsed], pa.list_(pa.int32())), pa.array([[len(t) for t, _ in p] for p in parsed], pa.list_(pa.int32())), pa.array(bodies, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("host"), batch.column("path"), *arrays], ["row", "host", "path", "lines", "places", "sizes", "bodies"])

    lines = stored(source.mapInArrow(cut, "row bigint, host string, path string, lines array<bigint>, places array<int>, sizes array<int>, bodies array<bigint>"))
    once = lines.dropDuplicates(["row"]).select("row", F.xxhash64("host").alias("site"), "lines", "places", "sizes", "bodies")
    pairs = paired(lines).dropDuplicates(["row"])
    met = pairs.join(once, "row").join(once.select(F.col("row").alias("other"), F.col("lines").alias("beside")), "other")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, each = [], []
            for mine, where, sizes, bodies, beside in zip(*(batch.column(c).to_pylist() for c in ("lines", "places", "sizes", "bodies", "beside")), strict=True):
                place = main_place(where)
                shared.append([i for i in shared_lines(mine, beside) if where[i] == place])
                both = {mine[i] for i in shared[-1]}
                own = {mine[i]: {"line": mine[i], "body": bodies[i], "size": sizes[i], "shared": mine[i] in both} for i, w in enumerate(where) if w == place}
                each.append(list(own.values()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "site", "lines", "places", "sizes")), pa.array(shared, pa.list_(pa.int32())), pa.array(each, pa.list_(EACH))], ["row", "site", "lines", "places", "sizes", "shared", "each"])

    columns = "row bigint, site bigint, lines array<bigint>, places array<int>, sizes array<int>, shared array<int>"
    met = met.select("row", "site", "lines", "places", "sizes", "bodies", "beside")
    met = stored(met.mapInArrow(differ, f"{columns}, each array<struct<line:bigint,body:bigint,size:int,shared:boolean>>"))
    settled = met.where("size(shared) > 0").join(templates(met), "row", "left").select("row", "lines", "places", "sizes", "shared", "templates")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lines", "places", "sizes", "shared", "templates"))
            found = [deletions(*x, set(t or ())) for *x, t in zip(*columns, strict=True)]
            some = [i for i, f in enumerate(found) if f]
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(some, pa.int64())), pa.array([found[i] for i in some], pa.list_(pa.int32()))], ["row", "gone"])

    gone = stored(settled.mapInArrow(settle, "row bigint, gone array<int>"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, deleted in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                found = lines_of(page)
                best = max((w for _, w in found), default=ELSEWHERE)
                out = set(deleted or ())
                texts.append(" ".join(t for i, (t, w) in enumerate(found) if w == best != APART and i not in out))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    again = pages.select("page_id", "url", "html", row).join(gone, "row", "left").select("page_id", "url", "html", "gone")
    return again.mapInArrow(extract, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")
