"""Main text of web pages by differencing each page with its nearest by URL.

A page is cut into block lines; each knows whether the markup puts it in the
page's main element (``article`` or ``main``), marks it as surrounding matter
(menus, headers, footers, sidebars, notices, adverts, forms, comments), or says
neither. Pages are sorted by host and URL path, and each is paired with the
neighbour on its host that shares the longer beginning of the path. The lines of
both are aligned by a longest common subsequence; a shared line is template and
is deleted, unless it stands in the main element, where two pages share lines
because they carry the same article. An exact check by markup follows: what it
marks as surrounding goes even if no neighbour shares it, and where a page has a
main element, lines outside of it go.

Sorting is by ranges, so a host with a third of all pages is spread over many
tasks; only hashes of lines are sorted and paired.

Defined cases: a null or empty page gives an empty text; a page without
neighbours on its host loses nothing by differencing; copies of a page on one
host count as one page there, so their nearest is a page with other lines, and
equal rows give equal results; marks of a wrapper yield to the main element in
it where a page has no other; cut-off pages end where they end; a null URL is a host of its own; extra columns
are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import drop, hash_words, keep

#: Elements whose start and end break a line.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without an end tag.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
RAW = frozenset("script style textarea title noscript template iframe svg select xmp noembed noframes".split())
#: Elements and class, id or role words of surrounding matter.
AROUND = frozenset("nav header footer aside form menu dialog button head".split())
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login "
    "masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo related reply replies share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget contentinfo complementary search alert".split()
)
#: Marks that what belongs to an article may bear.
OF_ARTICLES = frozenset(["header", "alert", "search"])
MAIN = frozenset(["article", "main"])
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")
INSIDE, PLAIN, AROUND_LINE = 2, 1, 0


def marked(name: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is surrounding matter by its name or its marks."""
    if name in AROUND and not (in_main and name == "header"):
        return True
    if "=" not in attributes or name in ("html", "body"):
        return False
    # A main element and what is inside it are marked by whole names only
    # ("comment", not "has-comments"; "share", not "share-price").
    marks = MARKS - OF_ARTICLES if in_main else MARKS
    for found in NAMED.finditer(attributes):
        value = (found[1] or found[2] or found[3] or "").lower()
        if not marks.isdisjoint(value.split() if in_main or name in MAIN else WORD.findall(value)):
            return True
    return False


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(text, place) of the page's block lines, in order.

    Where every main element stands in surrounding matter, the marks of what is
    around it yield: a wrapper named "with-sidebar" is not a sidebar.
    """
    lines, hidden = _lines_of(page or "", False)
    if hidden and not any(place == INSIDE for _, place in lines):
        lines, _ = _lines_of(page or "", True)
    return lines


def _lines_of(page: str, yielding: bool) -> tuple[list[tuple[str, int]], bool]:
    """The lines, and whether a main element stands in surrounding matter by its marks alone."""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # (element, in main, surrounding, by name)
    in_main = around = named = hidden = False

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            lines.append((text, AROUND_LINE if around else INSIDE if in_main else PLAIN))

    at = 0
    while at < len(page):
        tag = MARKUP.search(page, at)
        if tag is None:
            parts.append(unescape(page[at:]))
            break
        if tag.start() > at:
            parts.append(unescape(page[at : tag.start()]))
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            parts.append(" ")
        if tag[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    _, in_main, around, named = stack[depth]
                    del stack[depth:]
                    break
        elif name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in EMPTY and not tag[3].endswith("/"):
            if name == "p" and stack and stack[-1][0] == "p":
                _, in_main, around, named = stack.pop()
            stack.append((name, in_main, around, named))
            if name in MAIN and around and not named and not in_main and not marked(name, tag[3], in_main):
                hidden, around = True, not yielding
            around = around or marked(name, tag[3], in_main)
            named = named or (name in AROUND and not (in_main and name == "header"))
            in_main = in_main or name in MAIN
    flush()
    return lines, hidden


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Equal beginnings and ends belong to it. Between them, matches of ``a``'s
    lines, later places of ``b`` first, are fed to a longest increasing
    subsequence, so the cost follows the number of matches.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    between = _common(a[head : len(a) - tail], b[head : len(b) - tail])
    return [*range(head), *[head + i for i in between], *range(len(a) - tail, len(a))]


def _common(a: list[int], b: list[int]) -> list[int]:
    places: dict[int, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    ends: list[int] = []
    chains: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[k] = j
                chains[k] = link
    found, link = [], chains[-1] if chains else None
    while link:
        found.append(link[0])
        link = link[1]
    return found[::-1]


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # A line's words are run together, so that each line is one word to hash.
        keys = [hash_words("\n".join(text.replace(" ", "_") for text, _ in lines_of(page))).view(np.int64) for page in batch["html"]]
        yield batch[["version", "host", "path"]].assign(lines=keys)


def located(pages: DataFrame) -> DataFrame:
    """(page_id, url, version, host, path, html): scheme, query and fragment of the URL are left out of the path.

    ``version`` is the MD5 digest of the page.
    """
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", ""), r"[?#].*$", "")
    page = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", F.md5(page).alias("version"), host.alias("host"), path.alias("path"), page.alias("html"))


def shared_lines(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, version, shared): numbers of the lines each page shares with its nearest.

    Pages of a host with the same lines are copies of one page and count once,
    at the first of their paths, so a page's nearest has other lines.
    """
    rows = located(pages).drop("page_id", "url")
    hashed = rows.mapInPandas(_hashed, "version string, host string, path string, lines array<bigint>")
    copies = hashed.withColumn("content", F.md5(F.array_join("lines", ",")))
    copies, _ = keep(spark, copies.groupBy("host", "version", "content").agg(F.min("path").alias("path"), F.any_value("lines").alias("lines")), "page-copies")
    single = copies.groupBy("host", "content").agg(F.min("path").alias("path"), F.any_value("lines").alias("lines"))
    order = ["host", "path", "content"]
    ranged = single.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    keys, keys_path = keep(spark, ranged, "page-lines")
    page = F.struct("host", "path", "lines")
    inside = Window.partitionBy("part").orderBy(*order)
    near = keys.withColumn("before", F.lag(page).over(inside)).withColumn("after", F.lead(page).over(inside))
    near, near_path = keep(spark, near, "page-neighbours")
    # The first and last page of each range find the neighbour they lack among
    # themselves: two rows a range, whatever the number of pages.
    edge = near.where("before is null or after is null")
    across = Window.orderBy(*order)
    edge = edge.withColumn("b2", F.lag(page).over(across)).withColumn("a2", F.lead(page).over(across))
    edge = edge.withColumn("before", F.coalesce("before", "b2")).withColumn("after", F.coalesce("after", "a2")).drop("b2", "a2")
    paired = near.where("before is not null and after is not null").unionByName(edge)

    @F.pandas_udf("array<int>")
    def shared(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for path, lines, *others in batches:
            out = []
            for i in range(len(path)):
                best: tuple[int, list[int]] = (-1, [])
                for other_path, other_lines in (others[:2], others[2:]):
                    if other_path.iloc[i] is not None and len(lines.iloc[i]):
                        alike = _alike(path.iloc[i], other_path.iloc[i])
                        if alike > best[0]:
                            best = (alike, list(other_lines.iloc[i]))
                out.append(common_lines(list(lines.iloc[i]), best[1]))
            yield pd.Series(out, dtype=object)

    def beside(name: str, field: str):
        return F.when(F.col(f"{name}.host") == F.col("host"), F.col(f"{name}.{field}"))

    settled = paired.select(
        "host",
        "content",
        shared("path", "lines", beside("before", "path"), beside("before", "lines"), beside("after", "path"), beside("after", "lines")).alias("shared"),
    )
    settled, _ = keep(spark, settled, "page-shared")
    drop(spark, [keys_path, near_path])
    return copies.select("host", "version", "content").join(settled, ["host", "content"]).select("host", "version", "shared")


def _alike(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def main_text(page: str, shared: list[int]) -> str:
    """The lines left after differencing and the check by markup, one below the other."""
    lines = lines_of(page)
    template = set(shared)
    has_main = any(place == INSIDE for _, place in lines)
    return "\n".join(
        text
        for number, (text, place) in enumerate(lines)
        if place == INSIDE or (place == PLAIN and not has_main and number not in template)
    )


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    shared = shared_lines(spark, pages)
    joined = located(pages).join(shared, ["host", "version"], "left")

    @F.pandas_udf("string")
    def text_of(pages_of: pd.Series, numbers: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, [] if s is None else list(s)) for p, s in zip(pages_of, numbers)], dtype=object)

    return joined.select("page_id", "url", text_of("html", "shared").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
