"""Main text of web pages by differencing each page with its nearest neighbour in URL order.

A page is cut into text lines at its block elements. Pages stand in the order of host and URL
path; of the pages just before and after it on the same host, the one whose path shares the longer
beginning is a page's nearest (the one before on ties). The longest common subsequence of their lines is
the shared furniture, and its lines are deleted. A check by markup follows: lines inside an `article` or `main` element
are the page's own even if shared (pages may repeat an article), and lines the markup
gives to menus, headers, footers, sidebars, notices, adverts, forms or comments go even if not shared. On pages
without such marks, differencing alone decides.

Blocks are joined in page order by one space; white space runs become one space; character
references are decoded. Null and empty pages have an empty text. A null URL counts as an
empty one; pages without a neighbour on their host share nothing, and neither do pages all of whose lines
are shared: they are copies, as repeated rows are. Only the named columns are read. An empty table gives no rows.

One shuffle moves the lines. Pages are dealt by ranges of (host, path, id) whose limits, one per partition, are
taken from the URLs first, and the pages next to a limit go to both its sides, so a host of any size spreads over many
tasks and the result does not depend on the limits.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp
small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
FURNITURE = frozenset("""nav header footer aside form menu dialog button select head object""".split())
OWN = frozenset(("article", "main"))
MARKS = frozenset("""ad ads advert advertisement adverts sponsor sponsored promo banner sidebar menu nav navbar navigation
header masthead footer notice cookie cookies consent alert breadcrumb breadcrumbs comment comments reply replies
related share social subscribe newsletter widget popup modal""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>?)|[^<]+|<",
                    re.S)
_MARK = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")


def _is_furniture(name: str, attributes: str) -> bool:
    if name in FURNITURE:
        return True
    if "=" in attributes and name not in ("body", "html") and name not in OWN:
        for key, value in _MARK.findall(attributes):
            words = _WORD.findall(value.lower())
            if any(w in (ROLES if key.lower() == "role" else MARKS) for w in words):
                return True
    return False


def lines_of(html: str) -> list[tuple[int, str]]:
    """(zone, line) of the page's text lines in order; zone 1 is inside an article, -1 furniture, 0 neither."""
    out: list[tuple[int, str]] = []
    words: list[str] = []
    open_, skipped, own = [], 0, 0  # open furniture and article elements with their depth among equal names

    def flush():
        line = " ".join(unescape("".join(words)).split())
        if line:
            out.append((-1 if skipped else 1 if own else 0, line))
        words.clear()

    at, size = 0, len(html)
    while at < size:
        found = _TOKEN.match(html, at)
        at = found.end()
        name = found.group(2)
        if name is None:
            token = found.group()
            if token[0] != "<" or len(token) == 1:
                words.append(token)
            elif token.startswith("<![CDATA["):
                words.append(token[9:].removesuffix("]]>"))
            continue
        name, closing = name.lower(), found.group(1)
        if name not in INLINE:
            flush()
        if closing:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    open_[k][1] -= 1
                    if not open_[k][1]:
                        flush()
                        for gone in open_[k:]:
                            skipped, own = skipped - (gone[2] < 0), own - (gone[2] > 0)
                        del open_[k:]
                    break
            continue
        attributes = found.group(3)
        if name in VOID or attributes.endswith("/>"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if name in OWN and skipped and not own:
            # an article never stands in furniture: an element before it was left open
            open_, skipped = [], 0
        kind = 1 if name in OWN else -1 if _is_furniture(name, attributes) else 0
        if kind:
            flush()
            open_.append([name, 1, kind])
            skipped, own = skipped + (kind < 0), own + (kind > 0)
        else:
            for element in reversed(open_):
                if element[0] == name:
                    element[1] += 1
                    break
    flush()
    return out


def shared_lines(ours: list[str], theirs: list[str]) -> set[int]:
    """Places in `ours` of a longest common subsequence with `theirs`, by bit-parallel rows."""
    head = 0
    while head < min(len(ours), len(theirs)) and ours[head] == theirs[head]:
        head += 1
    tail = 0
    while tail < min(len(ours), len(theirs)) - head and ours[-1 - tail] == theirs[-1 - tail]:
        tail += 1
    found = set(range(head)) | set(range(len(ours) - tail, len(ours)))
    a, b = ours[head:len(ours) - tail], theirs[head:len(theirs) - tail]
    common = set(a) & set(b)  # other lines are in no common subsequence
    places = [i for i, x in enumerate(a) if x in common]
    b = [x for x in b if x in common]
    return found | {head + i for i in _subsequence([a[i] for i in places], b, places)}


ROW_BITS = 1 << 28


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    match: dict[str, int] = {}
    for j, x in enumerate(b):
        match[x] = match.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & match.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _subsequence(a: list[str], b: list[str], names: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > ROW_BITS and len(a) > 1:  # too many rows to keep: halve, and find where the halves part
        half = len(a) // 2
        for down in _rows(a[:half], b):
            pass
        for up in _rows(a[:half - 1:-1], b[::-1]):
            pass
        n, lead, best, cut = len(b), 0, -1, 0
        behind = (up ^ ((1 << n) - 1)).bit_count()
        bits_down, bits_up = bin(down | 1 << n)[:2:-1], bin(up | 1 << n)[3:]
        for j in range(n + 1):
            if lead + behind > best:
                best, cut = lead + behind, j
            if j < n:
                lead, behind = lead + (bits_down[j] == "0"), behind - (bits_up[j] == "0")
        return _subsequence(a[:half], b[:cut], names[:half]) + _subsequence(a[half:], b[cut:], names[half:])
    rows, out = list(_rows(a, b)), []
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append(names[i])
            i, j = i - 1, j - 1
    return out


_URL = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)(.*)$", re.S)


def split_url(url: str | None) -> tuple[str, str]:
    found = _URL.match(url or "")
    return (found.group(1).lower(), found.group(2)) if found else ("", url or "")


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


LINES = "bucket int, core boolean, host string, path string, page_id bigint, tie bigint, url string, zones array<tinyint>, lines array<string>"
KEY = ("host", "path", "page_id", "tie")


def _key(host, path, page, tie):
    return host, path, -(1 << 63) if page is None else page, tie


def _parse(limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, edges = limits.value
        for batch in batches:
            out = [[] for _ in range(9)]
            for page, url, html, tie in zip(*(c.to_pylist() for c in batch.columns)):
                host, path = split_url(url)
                key = _key(host, path, page, tie)
                zones, lines = zip(*found) if (found := lines_of(html or "")) else ((), ())
                own = max(bisect.bisect_right(lows, key) - 1, 0)
                for bucket in {own, *edges.get(key, ())}:
                    for x, v in zip(out, (bucket, bucket == own, host, path, page, tie, url, zones, lines)):
                        x.append(v)
            kinds = (pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int8()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)],
                                             names=["bucket", "core", "host", "path", "page_id", "tie", "url", "zones", "lines"])

    return run


def _diff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order -> their main text; each needs the page before and the page after it only."""
    def judged(before, row, after):
        near = [r for r in (before, after) if r is not None and r["bucket"] == row["bucket"] and r["host"] == row["host"]]
        shared: set[int] = set()
        if near:
            other = max(near, key=lambda r: _common(r["path"], row["path"]))  # the first of equals
            shared = shared_lines(row["lines"], other["lines"])
            if len(shared) == len(row["lines"]):  # a copy of its neighbour tells nothing apart
                shared = set()
        marked = any(z > 0 for z in row["zones"])
        kept = [line for k, (zone, line) in enumerate(zip(row["zones"], row["lines"]))
                if zone > 0 or (zone == 0 and not marked and k not in shared)]
        return row["page_id"], row["url"], " ".join(kept), len(shared)

    def batch_of(rows):
        out = list(zip(*rows)) or [(), (), (), ()]
        kinds = pa.int64(), pa.string(), pa.string(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["page_id", "url", "text", "n_shared"])

    before = row = None
    for batch in batches:
        done = []
        for after in batch.to_pylist():
            if row is not None and row["core"]:
                done.append(judged(before, row, after))
            before, row = row, after
        yield batch_of(done)
    yield batch_of([judged(before, row, None)] if row is not None and row["core"] else [])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_shared (lines shared with its nearest page)."""
    spark = pages.sparkSession
    plain = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    plain = plain.withColumn("tie", F.xxhash64("html"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = "(?s)^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)(.*)$"
    url = F.coalesce("url", F.lit(""))
    is_url = url.rlike(place)
    keys = plain.select(
        F.when(is_url, F.lower(F.regexp_extract(url, place, 1))).otherwise("").alias("host"),
        F.when(is_url, F.regexp_extract(url, place, 2)).otherwise(url).alias("path"),
        F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_id"), "tie")
    ranged = keys.repartitionByRange(parts, *KEY).groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(F.struct(*KEY)).alias("lo"), F.max(F.struct(*KEY)).alias("hi"))
    limits = sorted((tuple(r["lo"]), tuple(r["hi"])) for r in ranged.collect())  # one row per partition
    lows = [lo for lo, _ in limits]
    edges: dict[tuple, set[int]] = {}
    for k, (lo, hi) in enumerate(limits):
        if k:
            edges.setdefault(lo, set()).add(k - 1)
        if k + 1 < len(limits):
            edges.setdefault(hi, set()).add(k + 1)
    lines = plain.select("page_id", "url", "html", "tie").mapInArrow(_parse(spark.sparkContext.broadcast((lows, edges))), LINES)
    return lines.repartition(parts, "bucket").sortWithinPartitions("bucket", *KEY).mapInArrow(
        _diff, "page_id bigint, url string, text string, n_shared bigint")
