"""Main text of web pages, by differencing pages with near URLs.

Pages of a host that lie side by side in the order of their paths mostly share a
template. Each page is paired with the neighbour whose path has more in common with
its own and that is no near copy of it, the text lines of both are aligned by their longest common subsequence, and
the lines they share are deleted. What no neighbour shares but markup names as menu,
advert, form and the like is left out too. Lines in an explicit article are content
even if the neighbour has them: copies and quoted passages are no template.
"""

from __future__ import annotations

import html
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import checked, text_udf
from voxloom.llm.urlrules import host_and_path
from voxloom.session import cut_lineage

#: Elements that begin and end a line of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is never shown as text.
SILENT = frozenset("head script style template noscript iframe object svg math canvas audio video".split())
#: Elements around the text rather than in it.
AROUND = frozenset("nav aside footer form menu button select textarea input dialog".split())
#: Classes, ids and roles that say the same. Only whole ones: of others, differencing decides.
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent contentinfo disqus footer header masthead menu modal nav navbar navigation newsletter notice "
    "notices popup promo promoted related replies search share sharing sidebar skip social sponsor "
    "sponsored subscribe toolbar widget".split()
)
#: Those of them whose elements hold articles that are not the page's own.
OTHERS = frozenset("comment comments disqus related replies".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(["article", "main"])
#: Pages that have this share of each other's characters, by equal lines, are near copies.
COPY = 0.75

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_RAW_END = {n: re.compile(rf"</{n}\b[^>]*(?:>|\Z)", re.I) for n in ("script", "style", "textarea", "title")}
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Page:
    """Lines of a page: text, how surely it is left out by markup, whether in an article."""

    key: tuple = ()
    lines: list[str] = field(default_factory=list)
    left_out: list[int] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)


def _tokens(text: str) -> list[tuple[str, str, str]]:
    """(kind, name, rest): kinds are text, open and close; raw texts and comments go."""
    found, at = [], 0
    while at < len(text):
        m = _TOKEN.search(text, at)
        if m is None:
            found.append(("text", "", text[at:]))
            break
        if m.start() > at:
            found.append(("text", "", text[at : m.start()]))
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, rest = name.lower(), m["rest"] or m["rest2"] or ""
        if m["end"] or m["end2"]:
            found.append(("close", name, ""))
            continue
        found.append(("open", name, rest))
        if name in _RAW_END:
            end = _RAW_END[name].search(text, at)
            at = end.end() if end else len(text)
            found.append(("close", name, ""))
    return found


def _marks(rest: str) -> set[str]:
    names = {x for a, b, c in _NAMED.findall(rest) for x in (a or b or c).lower().split()}
    return names & MARKS


def _closings(tokens: list) -> dict[int, int]:
    """The token that closes each opened element, where there is one."""
    opened: dict[str, list[int]] = {}
    found = {}
    for i, (kind, name, _) in enumerate(tokens):
        if kind == "open":
            opened.setdefault(name, []).append(i)
        elif kind == "close" and opened.get(name):
            found[opened[name].pop()] = i
    return found


#: How surely a line is left out: named so by a class or a form, or by its element.
NAMED, SURE = 1, 2


def page_of(text: str) -> Page:
    """The lines of a page. An element left out that never closes ends with its line.

    An article or main element is never left out by a mark or a form on it or around it,
    unless the mark says that it holds what others wrote.
    """
    page, tokens = Page(), _tokens(text)
    closings = _closings(tokens)
    articles = [i for i, (kind, name, _) in enumerate(tokens) if kind == "open" and name in ARTICLE]
    mains = [i for i in articles if tokens[i][1] == "main"]
    parts: list[str] = []
    out_until, out, article_until, line_out = -1, 0, [], 0
    outer: list[tuple[int, int]] = []

    def holds(places: list[int], end: int | None) -> bool:
        k = bisect_left(places, at)
        return end is not None and k < len(places) and places[k] < end

    def left_out(name: str, rest: str, end: int | None) -> int:
        own_header = name == "header" and article_until
        if name == "header" and not own_header or name in AROUND and name != "form":
            return 0 if holds(mains, end) else SURE
        marks = set() if name in ("html", "body") or own_header else _marks(rest)
        if not marks and name != "form":
            return 0
        own = mains if marks & OTHERS and name not in ARTICLE else articles
        return 0 if holds(own, end) or name in ARTICLE else NAMED

    def flush() -> None:
        nonlocal line_out
        line = " ".join(html.unescape("".join(parts)).split())
        if line:
            page.lines.append(line)
            page.left_out.append(max(line_out, out if at <= out_until else 0))
            page.inside.append(bool(article_until))
        parts.clear()
        line_out = 0

    at = 0
    while at < len(tokens):
        while outer and at > out_until:
            out_until, out = outer.pop()
        kind, name, rest = tokens[at]
        if kind == "text":
            parts.append(rest)
        elif name == "br":
            parts.append(" ")
        else:
            if name in BLOCKS or name in SILENT:
                flush()
            end = closings.get(at)
            if kind == "open" and name in SILENT:
                at = at + 1 if end is None else end + 1
                continue
            while article_until and at >= article_until[-1]:
                article_until.pop()
            # Within what is only named so, elements that are surely left out still are.
            if kind == "open" and name not in VOID and (at > out_until or out == NAMED):
                found = left_out(name, rest, end)
                if found > (out if at <= out_until else 0):
                    if end is None:
                        line_out = found
                    elif at <= out_until:
                        # The rest of the outer element is looked at again after it.
                        outer.append((out_until, out))
                        out_until, out = end, found
                    else:
                        out_until, out = end, found
                elif name in ARTICLE and at > out_until:
                    article_until.append(len(tokens) if end is None else end)
        at += 1
    flush()
    # A page of which nothing else is left was named by its wrapper: differencing decides.
    if page.left_out and 0 not in page.left_out:
        page.left_out = [0 if n == NAMED else n for n in page.left_out]
    return page


#: Matches per line up to which all of them are listed; beyond that rows of bits stand for them.
LISTED = 16
#: Bits of the rows that are kept at once to go back over; larger tables are halved.
ROW_BITS = 1 << 26


def shared_lines(lines: list[str], others: list[str]) -> set[int]:
    """Places of the lines in a longest common subsequence with the other page's lines.

    What both begin and end with is taken off first. Where lines repeat little, it is the
    longest increasing run of matches, in as many steps as there are matches. Where they
    repeat much, a row of the table is a number with a bit per line, and tables too
    large to keep are halved, so memory stays linear in the lines.
    """
    start, stop = 0, min(len(lines), len(others))
    while start < stop and lines[start] == others[start]:
        start += 1
    end = 0
    while end < stop - start and lines[-1 - end] == others[-1 - end]:
        end += 1
    found = {*range(start), *range(len(lines) - end, len(lines))}
    places: dict[str, list[int]] = {}
    for j in range(start, len(others) - end):
        places.setdefault(others[j], []).append(j)
    inner = [i for i in range(start, len(lines) - end) if lines[i] in places]
    if sum(len(places[lines[i]]) for i in inner) <= LISTED * (len(lines) + len(others)):
        return found | _by_matches(inner, [places[lines[i]] for i in inner])
    known = {lines[i] for i in inner}
    names = {line: k for k, line in enumerate(known)}
    ours = [names[lines[i]] for i in inner]
    theirs = [names[x] for x in others[start : len(others) - end] if x in known]
    return found | {inner[k] for k in _by_bits(ours, theirs)}


def _by_matches(inner: list[int], places: list[list[int]]) -> set[int]:
    """Alignment as the longest increasing run of the places of each line on the other side."""
    ends: list[int] = []
    last: list[tuple] = []
    for i, at in zip(inner, places, strict=True):
        # From the last place to the first, so that a line takes one of them.
        for j in reversed(at):
            k = bisect_left(ends, j)
            node = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(node)
            else:
                ends[k], last[k] = j, node
    found: set[int] = set()
    node = last[-1] if last else None
    while node:
        found.add(node[0])
        node = node[1]
    return found


def _bit_rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Per line of ``a``, the row of the table: bit j is zero where line j of ``b`` lengthens it."""
    marks: dict[int, bytearray] = {x: bytearray((len(b) + 7) // 8) for x in set(a)}
    for j, x in enumerate(b):
        if x in marks:
            marks[x][j >> 3] |= 1 << (j & 7)
    at = {x: int.from_bytes(m, "little") for x, m in marks.items()}
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & at[x]
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the alignment of all of ``a`` with every beginning of ``b``."""
    row = 0
    for row in _bit_rows(a, b):
        pass
    packed = np.frombuffer(row.to_bytes((len(b) + 7) // 8, "little"), dtype=np.uint8)
    bits = np.unpackbits(packed, bitorder="little", count=len(b))
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _by_bits(ours: list[int], theirs: list[int]) -> set[int]:
    """Places in ``ours`` of a longest common subsequence."""
    found: set[int] = set()
    todo = [(0, len(ours), 0, len(theirs))]
    while todo:
        s, e, t, f = todo.pop()
        a, b = ours[s:e], theirs[t:f]
        if not a or not b:
            continue
        if len(a) > 1 and len(a) * len(b) > ROW_BITS:
            half = len(a) // 2
            ends = _lengths(a[:half], b) + _lengths(a[:half - 1 : -1], b[::-1])[::-1]
            cut = int(ends.argmax())
            todo += [(s, s + half, t, t + cut), (s + half, e, t + cut, f)]
            continue
        rows = list(_bit_rows(a, b))
        i, j = len(a), len(b)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            # Lengthened here already by the lines before, so this one is not needed.
            if not i or rows[i - 1] >> (j - 1) & 1:
                found.add(s + i)
                j -= 1
    return found


def main_text(page: Page, other: Page | None) -> str:
    """The lines that the other page does not share, and all of an article.

    Without another page nothing tells template from text but the article, if there is
    one.
    """
    shared = shared_lines(page.lines, other.lines) if other else set()
    shown = [i for i, out in enumerate(page.left_out) if not out]
    kept = [i for i in shown if page.inside[i] or (other and i not in shared)]
    # Of a page that the other repeats line by line nothing would be left.
    return "\n".join(page.lines[i] for i in kept or shown)


def nearest(page: Page, before: Page | None, after: Page | None) -> Page | None:
    """The neighbour of the same host with more path in common; the one after, if equal."""
    same = [p for p in (after, before) if p and p.key[0] == page.key[0]]
    common = [len(os.path.commonprefix([p.key[1], page.key[1]])) for p in same]
    return same[common.index(max(common))] if same else None


def near_copy(page: Page, other: Page) -> bool:
    """Whether each page has most of the other's text that markup does not leave out."""
    a, b = ([x for x, out in zip(p.lines, p.left_out, strict=True) if not out] for p in (page, other))
    known = set(b)
    most = max(sum(map(len, a)), sum(map(len, b)))
    return sum(len(x) for x in a if x in known) >= COPY * most


def zipped(html_: bytes) -> bytes:
    """A page as it is shuffled and kept: equal pages have equal bytes."""
    return zstandard.compress(html_, 3)


def _unzipped(data: bytes, host: str, path: str) -> Page:
    return replace(page_of(zstandard.decompress(data).decode()), key=(host, path))


@dataclass
class _Row:
    id: object
    url: str | None
    html: bytes
    key: tuple


#: Texts that are held before they are handed on, in characters.
HANDED_ON = 4 << 20
#: What a range gives: finished pages, those with a neighbour in another range, and its edges.
_PARTS = "part string, side string, pos int, bin int, host string, path string, html binary, text string"


def _in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the pages between the first and the last run of copies in a range.

    Pages of these two runs are open; edges are the heads of the first two runs and the
    last pages of the last two, at 0 to 3. Of a run only its head and its latest page
    are held parsed; the others are held compressed, equal ones once.
    """
    run: list[_Row] = []
    head = latest = before = None
    latest_html = before_html = b""
    count, bin_, held = 0, 0, {}
    kinds: list = []
    out: list[tuple] = []

    def edge(html_: bytes, key: tuple, pos: int) -> None:
        out.append((None, None, "edge", None, pos, bin_, *key, html_, None))

    def open_(r: _Row, side: str) -> None:
        out.append((r.id, r.url, "open", side, None, bin_, *r.key, r.html, None))

    def done(after: Page) -> Iterator[pa.RecordBatch]:
        size, known, page = 0, None, None
        for r in run:
            if r.html is not known:
                known, page = r.html, head if r.html is run[0].html else _unzipped(r.html, *r.key)
            own = replace(page, key=r.key)
            text = main_text(own, nearest(own, before, after))
            out.append((r.id, r.url, "done", None, None, bin_, None, None, None, text))
            size += len(text)
            if size > HANDED_ON:
                yield flush()
                size = 0

    def flush() -> pa.RecordBatch:
        names = ["id", "url", "part", "side", "pos", "bin", "host", "path", "html", "text"]
        types = [*kinds, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary(), pa.string()]
        columns = [pa.array([r[i] for r in out], type=t) for i, t in enumerate(types)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        kinds = [batch.schema.field(0).type, pa.string()]
        for i in range(batch.num_rows):
            id_, url, html_, host, path, bin_ = (batch.column(k)[i].as_py() for k in range(6))
            same = run and html_ == latest_html
            page = replace(latest, key=(host, path)) if same else _unzipped(html_, host, path)
            if run and not (head.key[0] == host and near_copy(page, head)):
                if count == 1:
                    edge(run[0].html, run[0].key, 0)
                    edge(html_, page.key, 1)
                    for r in run:
                        open_(r, "first")
                else:
                    yield from done(page)
                before, before_html, run, held = latest, run[-1].html, [], {}
            if not run:
                count, head = count + 1, page
            html_ = held.setdefault(html_, html_)
            run.append(_Row(id_, url, html_, page.key))
            latest, latest_html = page, html_
        if out:
            yield flush()
    if run:
        if count == 1:
            edge(run[0].html, run[0].key, 0)
        else:
            edge(before_html, before.key, 2)
        edge(latest_html, latest.key, 3)
        for r in run:
            open_(r, "only" if count == 1 else "last")
        yield flush()


_AROUND = "bin int, side string, " + ", ".join(f"{n} struct<host: string, path: string, html: binary>" for n in ("before", "after"))


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The neighbours of the open pages of each range, from the edges of all ranges in order."""
    edges: dict[int, dict[int, tuple]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            page = _unzipped(r["html"], r["host"], r["path"])
            edges.setdefault(r["bin"], {})[r["pos"]] = page, r["html"]
    bins = sorted(edges)

    def beyond(own: Page, others: Iterator[int], order: tuple[int, int]) -> tuple | None:
        for b in others:
            for pos in order:
                if pos in edges[b]:
                    page, text = edges[b][pos]
                    if page.key[0] != own.key[0]:
                        return None
                    if not near_copy(page, own):
                        return page, text
        return None

    def struct(found: tuple | None) -> dict | None:
        return found and {"host": found[0].key[0], "path": found[0].key[1], "html": found[1]}

    rows = []
    for k, b in enumerate(bins):
        own = edges[b]
        before = beyond(own[0][0], (bins[j] for j in range(k - 1, -1, -1)), (3, 2))
        after = beyond(own[3][0], (bins[j] for j in range(k + 1, len(bins))), (0, 1))
        if 1 in own:
            rows += [(b, "first", before, own[1]), (b, "last", own[2], after)]
        else:
            rows.append((b, "only", before, after))
    kind = pa.struct([("host", pa.string()), ("path", pa.string()), ("html", pa.binary())])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], type=pa.int32()),
            pa.array([r[1] for r in rows], type=pa.string()),
            pa.array([struct(r[2]) for r in rows], type=kind),
            pa.array([struct(r[3]) for r in rows], type=kind),
        ],
        ["bin", "side", "before", "after"],
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of open pages beside their neighbours."""

    def known(r: dict | None) -> Page | None:
        return r and _unzipped(r["html"], r["host"], r["path"])

    for batch in batches:
        texts = []
        for r in batch.select(["host", "path", "html", "before", "after"]).to_pylist():
            page = known(r)
            texts.append(main_text(page, nearest(page, known(r["before"]), known(r["after"]))))
        columns = [batch.column("id"), batch.column("url"), pa.array(texts, type=pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text"])


def extract(df: DataFrame, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html") -> DataFrame:
    """``id_column``, ``url_column``, ``text`` and ``n_chars`` (code points) per row.

    White space within a block becomes one space, character references are decoded and
    blocks are joined by line feeds. Null and empty pages have the empty text; so have
    pages without any. Pages without a host are neighbours of each other. Repeated
    rows come back as often; an empty table stays empty. Other columns are not
    returned.

    Pages are dealt by range of host, path and id, so a host of any size spreads over
    tasks, which stream them. Pages beside each other that are near copies form a run,
    and neighbours are those of the run. Runs at the edges of a range find theirs in
    other ranges: edges are read in one task, a few pages of each range. Pages are shuffled
    compressed one by one, and a task holds a run of copies compressed.
    """
    checked(df, id_column, url_column, html_column)
    host, path = host_and_path(F.col(f"`{url_column}`"))
    rows = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        text_udf(zipped, pa.binary(), "binary")(F.col(f"`{html_column}`")).alias("html"),
        host.alias("host"),
        path.alias("path"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.repartitionByRange("host", "path", "id").sortWithinPartitions("host", "path", "id")
    rows = rows.withColumn("bin", F.spark_partition_id())
    # The written table fixes the ranges.
    parts = rows.mapInArrow(_in_range, f"id {kind}, url string, {_PARTS}")
    parts = cut_lineage(df.sparkSession, parts, "pages", "zstd")
    edges = parts.where("part = 'edge'").select("bin", "pos", "host", "path", "html")
    around = edges.repartition(1).sortWithinPartitions("bin", "pos").mapInArrow(_around, _AROUND)
    around = cut_lineage(df.sparkSession, around, "neighbours")
    opened = parts.where("part = 'open'").select("id", "url", "bin", "side", "host", "path", "html")
    opened = opened.join(around, ["bin", "side"], "left")
    found = parts.where("part = 'done'").select("id", "url", "text").unionAll(
        opened.mapInArrow(_joined, f"id {kind}, url string, text string")
    )
    return found.select(
        F.col("id").alias(id_column), F.col("url").alias(url_column), "text",
        F.length("text").cast("long").alias("n_chars"),
    )
