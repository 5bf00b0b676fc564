"""Main text of web pages by structure and by differencing with the nearest page of the host.

A page is cut into blocks once. Blocks inside menus, headers, footers, sidebars, notices, adverts, forms and comments
go by their markup; of a page that marks its article the blocks of the article are left. Every page is then
compared with the pages next to it in the order of URL paths on its host: blocks are aligned by a longest
common subsequence, and shared ones, the frame that a site repeats, are deleted. Copies of a page tell nothing about the frame: on
either side the nearest page with other blocks counts, and one that holds all blocks of the page is not used.
A check by the markup follows: what a marked article shares with a neighbour is its own text and comes back, unless
an element inside it has a class that hints at frame without saying so.

Only hashes of blocks meet those of other pages. The order of pages is found by a range partition, neighbours
inside a partition by a window, and those across partitions from two pages of each, so a host with a
third of all pages is many partitions.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.llm.arrow import batches_of, bounded_batches
from riskloom.llm.member import with_candidates
from riskloom.session import stage

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
_DROPPED = frozenset(
    "nav footer aside form script style noscript iframe svg canvas button select textarea template head title object "
    "audio video menu dialog".split())
_MAIN = frozenset(("article", "main"))
#: An element of the first kind ends an open one of the second when it begins.
_ENDS = {
    **dict.fromkeys(("p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "aside",
                     "nav", "footer", "header", "form", "blockquote", "pre", "hr", "main", "figure", "address"), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
_BOUNDS = frozenset("article main section div table td th ul ol dl body html aside nav footer header form".split())
_HINTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer header masthead sidebar banner ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments disqus "
    "respond reply pagination pager toolbar widget copyright disclaimer alert".split())
#: Words that say where or in what a hint stands; a class of other words too, as "has-sidebar", is about something else.
_NEUTRAL = frozenset(
    "area bar block body bottom box btn button buttons container content div element fixed global group icons inner item items link "
    "links list main module outer page panel primary row secondary section site slot sticky text top unit wrap wrapper".split())
#: Frame even if an article is inside: comments, and lists of other articles.
_CLOSED = frozenset("nav navbar navigation menu footer comment comments disqus respond reply related recommended".split())
#: Words that mark comments whatever words they stand with, unless one says that a page merely has or lacks them.
_COMMENTS = frozenset("comment comments disqus respond reply replies".split())
_STATES = frozenset("no not has with without open closed enabled disabled".split())
_HINTED = frozenset("div section ul ol dl p span table tbody tr td li header figure details a center article".split())


def _dropped(tag: str, attributes: str, inside_main: bool) -> int:
    """0 for an element that stays, 1 for frame unless an article is inside, 2 for frame with all that is inside."""
    if tag in _DROPPED:
        return 2
    level = int(tag == "header" and not inside_main)
    if "=" not in attributes and "hidden" not in attributes or tag in ("html", "body", "main"):
        return level
    found = {name.lower(): next((v for v in values if v), "") for name, *values in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return 2
    role = found.get("role", "").lower()
    if role in ("navigation", "contentinfo", "complementary", "search", "dialog", "alert"):
        return 2
    if role == "banner":
        level = 1
    if tag not in _HINTED:
        return level
    for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
        words = {word for word in re.split(r"[^a-z0-9]+", name) if word and not word.isdigit()}
        hints = words & _HINTS
        if words & _COMMENTS and words.isdisjoint(_STATES):
            level = 2
        elif hints and words <= _HINTS | _NEUTRAL:
            level = max(level, 1 if hints.isdisjoint(_CLOSED) else 2)
    return level


def _doubtful(tag: str, attributes: str) -> bool:
    """Whether a class or id has a hint beside words that are about something else, so that markup alone cannot tell."""
    if tag not in _HINTED or "=" not in attributes:
        return False
    found = {name.lower(): next((v for v in values if v), "") for name, *values in _ATTRIBUTE.findall(attributes)}
    named = (set(re.split(r"[^a-z0-9]+", name)) for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split())
    return any(words & _HINTS and words.isdisjoint(_STATES) for words in named)


def blocks(page: str) -> tuple[list[str], list[str]]:
    """Blocks of the marked article, and of the rest; what markup gives away as frame is in neither."""
    return parts(page)[:2]


def parts(page: str) -> tuple[list[str], list[str], list[int]]:
    """The ``blocks``, and which ones of the article stand in an element that may be frame."""
    main: list[str] = []
    rest: list[str] = []
    doubts: list[int] = []
    held: list[str] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, dropped (as told by _dropped), inside the article, in doubt
    at, n = 0, len(page)

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                if stack and stack[-1][3]:
                    doubts.append(len(main))
                (main if stack and stack[-1][2] else rest).append(text)
            held.clear()

    def text(upto: int) -> None:
        if upto > at and not (stack and stack[-1][1]):
            held.append(page[at:upto])

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue  # inside raw text that was passed over
        text(m.start())
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        if tag in _BLOCK:
            flush()
        if m.group(1) or m.group(4):
            if tag in _VOID:
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    # a block that an end tag closes by the way ends here too; an inline element ends no block
                    if any(name in _BLOCK for name, *_ in stack[i:]):
                        flush()
                    del stack[i:]
                    break
                if stack[i][0] in _BOUNDS and tag not in _BOUNDS:
                    break  # a stray end tag does not reach over a section
            continue
        for name in _ENDS.get(tag, ()):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    flush()
                    del stack[i:]
                    break
                if stack[i][0] in _BOUNDS:
                    break
        attributes = m.group(3) or m.group(6) or ""
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
            continue
        out, inside, doubt = stack[-1][1:] if stack else (0, False, False)
        if out == 1 and tag in _MAIN and not inside:
            out = 0  # what is around an article is no frame
        out = max(out, _dropped(tag, attributes, inside))
        doubt = doubt or inside and not out and _doubtful(tag, attributes)
        inside = inside or tag in _MAIN and not out
        if tag in _RAW and out:
            end = _RAW[tag].search(page, at)
            at = end.end() if end else n
            continue
        stack.append((tag, out, inside, doubt))
    text(n)
    flush()
    return main, rest, doubts


def _rows(one: Sequence[int], two: Sequence[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``one`` with every beginning of ``two``, by bits of one long number."""
    where: dict[int, int] = defaultdict(int)
    for j, value in enumerate(two):
        where[value] |= 1 << j
    every = (1 << len(two)) - 1
    state = every
    for value in one:
        hit = state & where[value] if value in where else 0
        if hit:
            state = (state + hit | state - hit) & every
    bits = np.unpackbits(np.frombuffer(state.to_bytes(len(two) // 8 + 1, "little"), np.uint8), count=len(two), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common(one: Sequence[int], two: Sequence[int]) -> list[int]:
    """Places in ``one`` of a longest common subsequence with ``two``.

    What both begin and end with is taken first, and what only one has is left out. The middle is halved where the two halves
    have most in common, so memory is linear, and lengths are counted for 64 places at once.
    """
    mine, its = set(one), set(two)
    places = [i for i, value in enumerate(one) if value in its]
    one, two = [one[i] for i in places], [value for value in two if value in mine]
    found: list[int] = []
    parts = [(0, len(one), 0, len(two))]
    while parts:
        a, b, c, d = parts.pop()
        while a < b and c < d and one[a] == two[c]:
            found.append(a)
            a, c = a + 1, c + 1
        while a < b and c < d and one[b - 1] == two[d - 1]:
            b, d = b - 1, d - 1
            found.append(b)
        if a == b or c == d:
            continue
        if b - a == 1:
            if one[a] in two[c:d]:
                found.append(a)
            continue
        half = (a + b) // 2
        ahead, behind = _rows(one[a:half], two[c:d]), _rows(one[half:b][::-1], two[c:d][::-1])[::-1]
        cut = c + int((ahead + behind).argmax())
        parts += [(a, half, c, cut), (half, b, cut, d)]
    return [places[i] for i in sorted(found)]


def frame_places(own: list[int], neighbours: list[list[int] | None]) -> set[int]:
    """Places of the blocks that a neighbour shares; one that shares all of them is a copy and not counted."""
    gone: set[int] = set()
    for other in neighbours:
        if other:
            shared = common(own, other)
            if len(shared) < len(own):
                gone.update(shared)
    return gone


def checked_places(gone: set[int], marked: bool, doubts: list[int]) -> list[int]:
    """The places that stay deleted: in a marked article only those that its markup leaves in doubt."""
    return sorted(gone.intersection(doubts) if marked else gone)


def _hash(line: str) -> int:
    value = xxhash.xxh64_intdigest(line)
    return value - (1 << 64) if value >> 63 else value


def address(url: str | None) -> tuple[str, str]:
    """Host and path: without scheme, query and fragment."""
    rest = re.split(r"[?#]", re.sub(r"^\w+://", "", url or ""), maxsplit=1)[0]
    host, _, path = rest.partition("/")
    return host.lower(), path.rstrip("/")


_SEEN = {
    "page_id": pa.int64(), "url": pa.string(), "host": pa.string(), "path": pa.string(), "marked": pa.bool_(),
    "doubts": pa.list_(pa.int32()), "lines": pa.list_(pa.string()), "hashes": pa.list_(pa.int64()),
}
_SEEN_DDL = (
    "page_id long, url string, host string, path string, marked boolean, doubts array<int>, lines array<string>, hashes array<long>")


def _turns(rows: DataFrame, page: Column, order, part: list[str], name: str) -> DataFrame:
    """``rows`` with the nearest earlier ``page`` in the given order whose host or blocks differ; NULL where all are alike."""
    within = W.partitionBy(*part).orderBy(*order)
    differs = (F.col("_last.host") != F.col("host")) | (F.col("_last.blocks") != F.col("blocks"))
    return (
        rows.withColumn("_last", F.lag(page).over(within))
        .withColumn(name, F.last(F.when(differs, F.col("_last")), ignorenulls=True).over(within.rowsBetween(W.unboundedPreceding, 0)))
        .drop("_last")
    )


def _nearest(ordered: DataFrame, name: str, forward: bool, *more: str) -> DataFrame:
    """``row, more, name``: hashes of the nearest page on one side that is no copy, if it is of the same host."""
    def way(*columns: str) -> list[Column]:
        return [F.col(c).asc() if forward else F.col(c).desc() for c in columns]

    page = F.struct("host", "blocks", "hashes")
    inside = stage(_turns(ordered, page, way("at"), ["part"], "near"))
    first, last = (F.min_by, F.max_by) if forward else (F.max_by, F.min_by)
    # two pages of each partition, the last one and the nearest to it that differs
    ends = inside.groupBy("part").agg(
        first(F.struct("host", "blocks"), "at").alias("first"), last(page, "at").alias("last"), last("near", "at").alias("near"))
    told = ends.select("part", F.inline(F.array(
        F.struct(F.lit(0 if forward else 1).alias("k"), F.col("near").alias("page")), F.struct(F.lit(1 if forward else 0).alias("k"), F.col("last").alias("page")))))
    told = told.where("page IS NOT NULL").select("part", "k", "page.*")
    told = _turns(told, page, way("part", "k"), [], "near").where(F.col("k") == int(forward)).select(
        "part", F.struct("host", "blocks", "hashes").alias("last"), "near")
    before = W.orderBy(*way("part"))
    entering = told.select("part", F.lag("last").over(before).alias("last"), F.lag("near").over(before).alias("near")).join(ends.select("part", "first"), "part")
    differs = (F.col("last.host") != F.col("first.host")) | (F.col("last.blocks") != F.col("first.blocks"))
    entering = stage(entering.select("part", F.when(differs, F.col("last")).otherwise(F.col("near")).alias("entering")))
    found = inside.where(F.size("hashes") > 0).join(entering, "part").withColumn("near", F.coalesce("near", "entering"))
    return found.select("row", *more, F.when(F.col("near.host") == F.col("host"), F.col("near.hashes")).alias(name))


def _neighbours(seen: DataFrame) -> DataFrame:
    """``row, marked, doubts, hashes, before, after`` of every page with blocks: the last two are hashes of the nearest pages of
    its host that are no copies of it."""
    ordered = stage(
        seen.select("row", "host", "path", F.xxhash64("hashes").alias("blocks"), "hashes", "marked", "doubts")
        .repartitionByRange("host", "path", "row").sortWithinPartitions("host", "path", "row")
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)).drop("path")
    )
    return _nearest(ordered, "before", True, "marked", "doubts", "hashes").join(_nearest(ordered, "after", False), "row")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; ``text`` is empty if nothing is left.

    NULL pages count as empty; NULL URLs share one nameless host; a page alone on its host keeps all that its markup
    does not give away. Rows with a NULL or repeated id are extracted one by one; other columns are ignored; an
    empty table gives an empty table. Pages of one path are ordered as the table gives them.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                main, rest, doubts = parts(page)
                lines = main or rest
                yield (page_id, url, *address(url), bool(main), doubts, lines, list(map(_hash, lines)))

        for batch in batches:
            yield from batches_of(_SEEN, rows(), 2000)

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            few = (batch.column(c).to_pylist() for c in ("row", "marked", "doubts", "hashes", "before", "after"))
            for row, marked, doubts, own, before, after in zip(*few):
                gone = checked_places(frame_places(own, [before, after]), marked, doubts)
                if gone:
                    yield row, gone

        for batch in batches:
            yield from batches_of({"row": pa.int64(), "gone": pa.list_(pa.int32())}, rows(), 2000)

    def subtract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            few = (batch.column(c).to_pylist() for c in ("page_id", "url", "lines", "gone"))
            kept = ((page_id, url, lines, set(places or ())) for page_id, url, lines, places in zip(*few))
            yield from batches_of(
                {"page_id": pa.int64(), "url": pa.string(), "text": pa.string()},
                ((page_id, url, "\n".join([line for i, line in enumerate(lines) if i not in gone])) for page_id, url, lines, gone in kept), 2000)

    read = bounded_batches(pages).select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    seen = stage(read.mapInArrow(parse, _SEEN_DDL).withColumn("row", F.monotonically_increasing_id()))
    gone = stage(_neighbours(seen).mapInArrow(difference, "row long, gone array<int>"))
    # only pages that lose blocks are shuffled
    told = with_candidates(seen.select("row", "page_id", "url", "lines"), gone, "row", F.col("row"), "_cut")
    whole = told.where(~F.col("_cut")).select("page_id", "url", "lines")
    cut = told.where("_cut").join(gone, "row", "left").select("page_id", "url", "lines", "gone")
    texts = whole.select("page_id", "url", F.array_join("lines", "\n").alias("text")).unionByName(
        cut.mapInArrow(subtract, "page_id long, url string, text string"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
