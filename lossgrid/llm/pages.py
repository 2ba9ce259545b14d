"""Main text of web pages: each page is set against its neighbours in URL order, and lines they share are deleted.

Pages are sorted by URL path within their host; a page's text lines are aligned with those of the page before and after
it by longest common subsequence.  Shared lines go, unless they stand inside the page's article: neighbouring articles
may quote the same line, and that is text.  Containers that say what they are (menus, headers, footers, adverts,
forms, comments and the like) go whether shared or not, since sites vary them from page to page.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, free_names, text_of
from lossgrid.operators.scale import distributed_lag

# fixed values: elements by their part in a page
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
RAW = frozenset("script style noscript template textarea iframe noembed noframes xmp".split())
FURNITURE = frozenset(
    "head nav header footer aside form menu dialog button select option label svg canvas object audio video map".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: words in class, id or role of an element that is not the article
SIGNS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo "
    "promoted related reply replies respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")

FREE, KEPT, OUT = 0, 1, 2

Line = tuple[str, int]


def _furniture(tag: str, attributes: str) -> bool:
    if tag in FURNITURE:
        return True
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return False
    for name, a, b, c in _NAMED.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif not SIGNS.isdisjoint(_PART.findall(value)):
            return True
    return False


def page_lines(source: str) -> list[Line]:
    """Lines of a page in order, each kept (inside the article), out (inside furniture) or free.

    One pass over the markup.  White space in a block is one space, and character references are decoded.  A furniture
    element that is never closed ends where the article begins.
    """
    lines: list[Line] = []
    text: list[str] = []
    inside, skipping, depth = 0, "", 0
    at, n, last_gt = 0, len(source), source.rfind(">")

    def flush() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line:
                lines.append((line, OUT if skipping else KEPT if inside else FREE))

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            text.append(source[at:])
            break
        if lt > at:
            text.append(source[at:lt])
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if lt > last_gt:  # nothing closes any more
            text.append(source[lt:])
            break
        found = _TAG.match(source, lt)
        if not found:
            if source.startswith(("<!", "<?"), lt):
                end = source.find(">", lt)
                at = n if end < 0 else end + 1
            elif source[lt + 1 : lt + 2].isalpha() or source.startswith("</", lt):
                end = source.find(">", lt)  # quotes that do not pair
                at = n if end < 0 else end + 1
            else:
                text.append("<")
                at = lt + 1
            continue
        at = found.end()
        tag, closing = found.group(1).lower(), source[lt + 1] == "/"
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\b", re.I).search(source, at)
            at = n if end is None else end.start()
            continue
        if tag == "br":
            text.append(" ")
        if tag in BLOCKS:
            flush()
        if tag in ("article", "main"):
            if not closing:
                if not _furniture(tag, found.group(2)) and (not skipping or not inside):
                    skipping, depth = "", 0
                    inside += 1
                    continue
            elif not skipping:
                inside = max(0, inside - 1)
                continue
        if skipping:
            if tag == skipping:
                depth += -1 if closing else 1
                if not depth:
                    flush()
                    skipping = ""
        elif not closing and tag not in VOID and _furniture(tag, found.group(2)):
            flush()
            skipping, depth = tag, 1
    flush()
    return lines


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists: increasing places over the equal pairs."""
    places = defaultdict(list)
    for j, x in enumerate(b):
        places[x].append(j)
    tails: list[int] = []
    nodes: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(tails, j)
            node = (i, j, nodes[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                nodes.append(node)
            else:
                tails[k], nodes[k] = j, node
    out, node = [], nodes[-1] if nodes else None
    while node:
        out.append(node[:2])
        node = node[2]
    return out[::-1]


def _key(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def shared_lines(own: list[int], free: list[bool], other: list[int]) -> list[int]:
    """Keys of the free lines that the alignment shares with the other page; none if the pages are copies."""
    pairs = common_lines(own, other)
    shared = {own[i] for i, _ in pairs if free[i]}
    if len(pairs) == len(own) == len(other) and shared:
        return []
    return sorted(shared)


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` without ``html_col`` and with ``out_col``, the main text ("" if there is none).

    Pages with equal URL are ordered by a hash of their source; exact repeats of a page count once as neighbours and
    each get the text.  A null URL is an empty one, null source an empty page.  Pages alone on their host only lose
    furniture.  Other columns pass through; ``out_col`` is replaced.
    """
    id1, id2, gone = free_names(pages, "_id1", "_id2", "_shared")
    source, url = text_of(html_col), text_of(url_col)
    rows = pages.select(
        "*",
        F.xxhash64(F.lit(0), url, source).alias(id1),
        F.xxhash64(F.lit(1), url, source).alias(id2),
    )

    @F.pandas_udf("struct<keys:array<bigint>,free:array<boolean>>")
    def keyed(sources: pd.Series) -> pd.DataFrame:
        out = []
        for text in sources:
            lines = page_lines(text)
            out.append(([_key(x) for x, _ in lines], [zone == FREE for _, zone in lines]))
        return pd.DataFrame(out, columns=["keys", "free"])

    @F.pandas_udf("array<bigint>")
    def shared(own: pd.Series, free: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([shared_lines(list(a), list(f), list(b)) for a, f, b in zip(own, free, other)], dtype=object)

    @F.pandas_udf("string")
    def rest(sources: pd.Series, shared: pd.Series) -> pd.Series:
        out = []
        for text, keys in zip(sources, shared):
            drop = set() if keys is None else set(keys)
            lines = page_lines(text)
            out.append("\n".join(x for x, zone in lines if zone == KEPT or zone == FREE and _key(x) not in drop))
        return pd.Series(out, dtype=object)

    narrow = rows.select(
        F.lower(F.regexp_extract(url, r"^[^/?#]*//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[^/?#]*//[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.col(id1).alias("a"),
        F.col(id2).alias("b"),
        keyed(source).alias("p"),
    ).dropDuplicates(["host", "path", "a", "b"])
    narrow = narrow.select("host", "path", "a", "b", F.struct("a", "b", "p").alias("page"))
    pairs = distributed_lag(narrow, ["host"], ["path", "a", "b"], {"before": "page"}).where(F.col("before").isNotNull())
    both = pairs.select(F.explode(F.array(F.struct("page", F.col("before").alias("other")), F.struct(F.col("before").alias("page"), F.col("page").alias("other")))).alias("x")).select("x.*")
    found = both.select(
        F.col("page.a").alias("a"), F.col("page.b").alias("b"),
        shared(F.col("page.p.keys"), F.col("page.p.free"), F.col("other.p.keys")).alias("keys"),
    )
    drops = found.where(F.size("keys") > 0).groupBy("a", "b").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    kept = [col(c) for c in pages.columns if c.lower() not in (html_col.lower(), out_col.lower())]
    joined = rows.join(drops.toDF(id1, id2, gone), [id1, id2], "left")
    return joined.select(*kept, rest(source, F.col(gone)).alias(out_col))
