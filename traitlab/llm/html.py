"""Main text of web pages by nearest-URL page differencing (operator 7).

A scan of the markup cuts every page into text lines (blocks), each with a
mark of the region it stands in: the article, a region that markup names as
boilerplate (navigation, header, footer, sidebar, notice, advert, form,
comments), or neither.  Pages of one host are sorted by URL path; each is
paired with the neighbour whose path shares the longer prefix.  The two pages'
lines are aligned by longest common subsequence, and lines that both have are
deleted.  A neighbour that shares nearly all lines (``ALIKE``) is a copy and
passed over for the next different page, so a page and its copy keep their
text.  The markup is a check: of a page with an article only that is kept, and
there a shared line goes only if the host shows it to be boilerplate: it stands,
in any region, on over half of the host's different pages (at least
``LEAST_PAGES``).  So prose that two neighbours happen to share stays.  An
article of which nothing would be left stays whole.

Lines travel as 64-bit hashes for the pairing; the sorted order is a range
partitioning with no task per host, and the first and last page of each
partition, and the nearest with other lines, are handed to the partitions
beside it.  Near copies that are not equal and fill a partition hide the pages
beyond it; such pages take the partner on their other side, if any.

Edge cases: null html counts as empty and gives an empty text; a null or odd
url is a host of its own and has no partner unless another row has the same
text there; a null id has no partner; repeated rows and copies of a url are
neighbours like others, and of two neighbours with equally long prefixes the
earlier one is the partner; very long pages are aligned in memory that follows
their lines, not the product; other columns, whatever their names, are ignored;
truncated tags and references are handled as at the end of input; an empty
table gives an empty result."""

from __future__ import annotations

import html as _html
import re
from os.path import commonprefix

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import BROADCAST_ROWS, lists, map_batches, parts_for, small, written

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|$)""", re.S)
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "video", "audio", "math"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_BOILER = {"nav", "footer", "aside", "form", "button", "select", "textarea", "menu", "dialog", "head", "title", "label", "fieldset", "header", *_RAW}
_BLOCK = set("address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_MAIN = {"article", "main"}
#: share of common lines from which two pages are copies
ALIKE = 0.9
#: different pages a host must have for a line on most of them to be boilerplate
LEAST_PAGES = 3
#: pages of a range of neighbours
RANGE_ROWS = 50_000
#: cells of an alignment table that is filled as a whole
CELLS = 1 << 20
_NAMED = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_BOILER_NAME = re.compile(r"^(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|sidebar|side|aside|complementary|footer|header|masthead|contentinfo|cookie\w*|consent|notices?|gdpr|popup|modal|alert|newsletter|subscribe|subscription|signup|login|search|form|share|sharing|social|related|recommend\w*|comments?|commentlist|replies|reply|respond|discussion|disqus\w*|widget|toolbar|pagination|pager|copyright|legal|skip)$", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_MAIN_NAME = re.compile(r"^(?:article|main|content|post|entry|story|articlebody|main-?content|post-?content|entry-?content|article-?body)$", re.I)
_WORD = re.compile(r"[a-zA-Z0-9]+(?:-[a-zA-Z0-9]+)*")
SPACES = " \t\n\r\x0b\x0c"
#: region marks
ARTICLE, BOILER, OTHER = 2, 1, 0


def _region(tag: str, attrs: str, inside: int) -> int:
    """Mark of the region an element opens inside a region ``inside``."""
    if inside == BOILER:
        return BOILER
    if tag == "header" and inside == ARTICLE:  # an article's own heading block
        return inside
    if tag in _BOILER or (attrs and _HIDDEN.search(attrs)):
        return BOILER
    if attrs and tag not in ("html", "body"):
        names = [x for m in _NAMED.finditer(attrs) for v in m.groups() if v for x in _WORD.findall(v)]
        parts = [p for x in names for p in (x, *x.split("-"))]
        if any(_BOILER_NAME.match(p) for p in parts) and not (tag in _MAIN or any(_MAIN_NAME.match(x) for x in names)):
            return BOILER
        if any(_MAIN_NAME.match(x) for x in names):
            return ARTICLE
    return ARTICLE if tag in _MAIN else inside


def text_lines(page: str) -> tuple[list[str], list[int]]:
    """Text lines of a page, white space folded, with their region marks."""
    lines, marks, buffer = [], [], []
    stack: list[tuple[str, int]] = []
    region = OTHER

    def flush():
        if buffer:
            line = " ".join(_html.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                lines.append(line)
                marks.append(region)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        if m.start() > at:
            buffer.append(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:  # comment, doctype, instruction
            continue
        tag, attrs = m.group(2).lower(), m.group(3)
        if tag in _BLOCK:
            flush()
        if m.group(1):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                if tag not in _BLOCK and any(t in _BLOCK and t != "p" for t, _ in stack[depth + 1 :]):
                    continue  # an inline end tag does not close blocks
                flush_region = stack[depth - 1][1] if depth else OTHER
                if flush_region != region:
                    flush()
                del stack[depth:]
                region = flush_region
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in _VOID or attrs.endswith("/"):
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            region = stack[-2][1] if len(stack) > 1 else OTHER
            stack.pop()
        new = _region(tag, attrs, region)
        if new != region:
            flush()
        stack.append((tag, new))
        region = new
    flush()
    return lines, marks


def lcs_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mask of ``a``'s places in a longest common subsequence with ``b``.
    Equal ends are taken first; what is left is halved by Hirschberg's method
    until a table of ``CELLS`` holds a part, so memory is linear."""
    out = np.zeros(len(a), dtype=bool)
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        out[lo] = True
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
        out[ea] = True
    x, y = a[lo:ea], b[lo:eb]
    where = np.flatnonzero(np.isin(x, y))  # lines of one page alone are in no common subsequence
    x, y = x[where], y[np.isin(y, x)]
    mask = np.zeros(len(x), dtype=bool)
    open_parts = [(0, len(x), 0, len(y))]
    while open_parts:
        i, j, k, m = open_parts.pop()
        if j - i <= 1 or m == k or (j - i) * (m - k) <= CELLS:
            mask[i:j] = _lcs_table(x[i:j], y[k:m])
            continue
        half = (i + j) // 2
        cut = k + int(np.argmax(_lcs_lengths(x[i:half], y[k:m]) + _lcs_lengths(x[half:j][::-1], y[k:m][::-1])[::-1]))
        open_parts += [(i, half, k, cut), (half, j, cut, m)]
    out[lo + where[mask]] = True
    return out


def _lcs_lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``x`` and each prefix of
    ``y``.  A row of the table is one long integer: a bit is 0 where the length
    grows by one."""
    places: dict[int, list[int]] = {}
    for j, line in enumerate(y.tolist()):
        places.setdefault(line, []).append(j)
    full = (1 << len(y)) - 1
    row = full
    for line in x.tolist():
        at = places.get(line)
        if at:
            hit = row & _bits(at, len(y))
            row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(y) // 8), "little"), dtype=np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _bits(at: list[int], n: int) -> int:
    if len(at) <= 16:
        return sum(1 << j for j in at)
    flags = np.zeros(n, dtype=np.uint8)
    flags[at] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _lcs_table(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Mask of ``x`` by the whole table, filled one row at a time."""
    out = np.zeros(len(x), dtype=bool)
    if not len(x) or not len(y):
        return out
    table = np.zeros((len(x) + 1, len(y) + 1), dtype=np.int32)
    for i in range(len(x) - 1, -1, -1):
        table[i, :-1] = np.maximum.accumulate(np.maximum(table[i + 1, :-1], np.where(y == x[i], table[i + 1, 1:] + 1, 0))[::-1])[::-1]
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j] and table[i, j] == table[i + 1, j + 1] + 1:
            out[i] = True
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def _line_hashes(lines: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in lines], dtype=np.uint64).view(np.int64)


def _keys(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (m.group(1).lower(), m.group(2)) if m else ("", url or "")


def _beyond(edge: list, end: str) -> dict[int, list[tuple]]:
    """By partition, the nearest page of those before it in ``edge`` and the
    nearest one whose lines differ from that one's."""
    out, last = {}, []
    for r in edge:
        out[r["part"]] = last
        first, second = r[end], r[end + "2"]
        if second is None:  # a partition of copies
            second = next((x for x in last if x[4] != first["hashes"]), None)
        last = [tuple(first)] + ([tuple(second)] if second is not None else [])
    return out


def _different(chain: list[tuple], sets: list[frozenset], places: range, step: int) -> list[int | None]:
    """For each place of the chain the nearest one in the direction ``step``
    that is of the same host and no copy."""
    out: list[int | None] = [None] * len(chain)
    for i in places:
        j = i + step if 0 <= i + step < len(chain) else None
        while j is not None and chain[j][0] == chain[i][0] and len(sets[i] & sets[j]) >= ALIKE * len(sets[i] | sets[j]):
            j = out[j]
        out[i] = j if j is not None and chain[j][0] == chain[i][0] else None
    return out


def shared_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(outlines, (id, host, main, place, hash) of the lines that a page shares
    with its nearest different neighbour).  Only lines of the region that the
    page's text is taken from are given; ``main`` says that it is an article."""

    def outline(batches):
        for cols in batches:
            hosts, paths, hashes, regions, ids = [], [], [], [], []
            for key, url, page in zip(cols["id"], cols["url"], cols["html"]):
                lines, marks = text_lines(page or "")
                host, path = _keys(url)
                ids.append(key)
                hosts.append(host)
                paths.append(path)
                regions.append(np.array(marks, dtype=np.int8))
                hashes.append(_line_hashes(lines))
            import pyarrow as pa

            yield {"id": ids, "host": hosts, "path": paths, "marks": lists(regions, pa.int8()) if regions else [], "hashes": lists(hashes) if hashes else []}

    picked = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    outlines = map_batches(picked, outline, "id long, host string, path string, marks array<tinyint>, hashes array<long>").where("size(marks) > 0")
    order = ["host", "path", "id"]
    ranges = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts_for(pages.count(), RANGE_ROWS))
    ranged = written(outlines.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "outlines")
    # the first and last page of each partition, and those nearest to them with other lines, given to the ones beside it
    row = F.struct(*order, "marks", "hashes")
    ends = written(ranged.groupBy("part").agg(F.min(row).alias("lo"), F.max(row).alias("hi")), "ends")
    if (n := ends.count()) > BROADCAST_ROWS:
        raise ValueError(f"{n} partitions; use fewer")
    other = ranged.join(F.broadcast(ends), "part").groupBy("part").agg(F.min(F.when(F.col("hashes") != F.col("lo.hashes"), row)).alias("lo2"), F.max(F.when(F.col("hashes") != F.col("hi.hashes"), row)).alias("hi2"))
    edge = sorted(ends.join(other, "part").collect(), key=lambda r: r["part"])
    before, after = _beyond(edge, "hi"), _beyond(edge[::-1], "lo")
    extra = {r["part"]: (before[r["part"]][::-1], after[r["part"]]) for r in edge}
    shared = pages.sparkSession.sparkContext.broadcast(extra)

    def pair(key, table):
        import pyarrow as pa

        before, after = shared.value[key[0].as_py()]
        rows = sorted(zip(*(table.column(c).to_pylist() for c in (*order, "marks", "hashes"))), key=lambda r: r[:3])
        chain = [*before, *rows, *after]
        sets = [frozenset(r[4]) for r in chain]
        previous = _different(chain, sets, range(len(chain)), -1)
        following = _different(chain, sets, range(len(chain) - 1, -1, -1), 1)
        out: dict[str, list] = {"id": [], "host": [], "main": [], "place": [], "hash": []}
        for i, (host, path, id_, marks, hashes) in enumerate(rows, len(before)):
            beside = [chain[j] for j in (previous[i], following[i]) if j is not None]
            if not beside:
                continue
            other = max(beside, key=lambda x: len(commonprefix([x[1], path])))
            mask = lcs_shared(np.array(hashes, dtype=np.int64), np.array(other[4], dtype=np.int64))
            region = ARTICLE if ARTICLE in marks else OTHER
            for p in np.flatnonzero(mask & (np.array(marks) == region)).tolist():
                for name, value in zip(out, (id_, host, region == ARTICLE, p, hashes[p])):
                    out[name].append(value)
        return pa.table({"id": pa.array(out["id"], pa.int64()), "host": pa.array(out["host"], pa.string()), "main": pa.array(out["main"], pa.bool_()), "place": pa.array(out["place"], pa.int32()), "hash": pa.array(out["hash"], pa.int64())})

    return ranged, written(ranged.groupBy("part").applyInArrow(pair, "id long, host string, main boolean, place int, hash long"), "shared")


def boilerplate(outlines: DataFrame, shared: DataFrame) -> DataFrame:
    """(host, hash) of the shared article lines that the host shows to be
    boilerplate: they stand, in any region, on over half of its different
    pages, of which there are at least ``LEAST_PAGES``."""
    asked = written(shared.where("main").select("host", "hash").distinct(), "asked")
    pages = outlines.select("host", F.xxhash64("hashes").alias("page"), "hashes")
    pages = pages.join(small(written(asked.select("host").distinct(), "hosts")), "host", "left_semi")
    n_pages = written(pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("n_pages")), "host-pages")
    flat = pages.select("host", "page", F.explode("hashes").alias("hash")).join(small(asked), ["host", "hash"], "left_semi").distinct()
    uses = flat.groupBy("host", "hash").agg(F.count("*").alias("n")).join(small(n_pages), "host")
    return uses.where((F.col("n_pages") >= LEAST_PAGES) & (2 * F.col("n") > F.col("n_pages"))).select("host", "hash")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    outlines, found = shared_lines(pages, id_col, url_col, html_col)
    proven = small(written(boilerplate(outlines, found), "boilerplate"))
    gone = found.where("not main").unionByName(found.where("main").join(proven, ["host", "hash"], "left_semi"))
    shared = written(gone.groupBy("id").agg(F.collect_set("place").alias("shared")), "gone")

    def extract(batches):
        for cols in batches:
            out = []
            for page, gone in zip(cols["html"], cols["shared"]):
                lines, marks = text_lines(page or "")
                drop, region = set(gone or ()), ARTICLE if ARTICLE in marks else OTHER
                main = [i for i, m in enumerate(marks) if m == region]
                kept = [i for i in main if i not in drop]
                out.append(" ".join(lines[i] for i in (kept or (main if region == ARTICLE else []))))
            yield {"page_id": cols["page_id"], "url": cols["url"], "text": out, "n_chars": [len(x) for x in out]}

    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    joined = picked.join(small(shared), F.col("page_id") == F.col("id"), "left").select("page_id", "url", "html", "shared")
    return map_batches(joined, extract, "page_id long, url string, text string, n_chars long")
