"""Removal of repeated passages by winnowing.

Texts are compared by stretches of a few words: a stretch ends with its line, with a sentence, or after a word that its
bytes pick, so a passage falls into the same stretches wherever in a line it stands. "Lines" below are such stretches;
lines without a word have none. A gram is the shortest run of lines from a line on with ``gram_words`` words;
a window is the shortest run with ``window_words`` words, and the gram of smallest hash that lies wholly in a window
is a fingerprint. Two texts that share a run of ``window_words`` words share a whole window, and so a fingerprint.

Every place of a repeated fingerprint carries the lines behind it and those before it, a window's worth on either side. Sorted by
fingerprint and lines, places that go on alike lie together, and how far a place goes on like any earlier one is told by the
nearest earlier places above and below it. One pass over a sorted partition finds them, with the earliest place for each
number of shared lines at hand; what reaches over the borders of partitions is one such short list for each. So a passage in a third of all
texts costs a row for each occurrence, over as many partitions as it fills. What a later occurrence shares with any earlier one is deleted.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.llm.arrow import batches_of, giving_back, text_columns
from riskloom.llm.member import with_candidates
from riskloom.session import stage

#: One word in so many ends a stretch, besides the last ones of sentences and lines.
STRETCH_WORDS = 16
_SPACE, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP[list(b".!?")] = True
#: A hash is so many bytes long.
_UNIT = 8

_RECORD = {"gram": pa.int64(), "place": pa.binary(), "lines": pa.int32(), "before": pa.binary(), "behind": pa.binary()}
_RECORD_DDL = "gram long, place binary, lines int, before binary, behind binary"
_REACH = {
    "part": pa.int32(), "place": pa.binary(), "lines": pa.int32(), "units": pa.int32(), "lead": pa.int32(), "trail": pa.int32(),
    "first": pa.binary(), "last": pa.binary(), "begin": pa.list_(pa.binary()), "end": pa.list_(pa.binary()),
}
_REACH_DDL = (
    "part int, place binary, lines int, units int, lead int, trail int, first binary, last binary, begin array<binary>, end array<binary>")
_RUN = {"doc_id": pa.int64(), "text_hash": pa.int64(), "first": pa.int32(), "last": pa.int32()}
_RUN_DDL = "doc_id long, text_hash long, first int, last int"


#: Bytes of text whose words are hashed at once, and whose stretches are found at once (but for longer single texts).
_PIECE = 1 << 20


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers, each spread over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=8)
def _table(kind: int, size: int) -> np.ndarray:
    return _mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind)) | np.uint64(1)


def _factors(kind: int, size: int) -> np.ndarray:
    """An odd factor for each place in a sequence; what is hashed is the sum of items times their factors."""
    return _table(kind, 1 << max(6, int(size - 1).bit_length()))


_WORD, _STRETCH, _GRAM = 1, 2, 3


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    found = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _PIECE)))
        low, high = int(starts[i]), int(ends[j - 1])
        begin, end = starts[i:j] - low, ends[i:j] - low
        longest = int((end - begin).max())
        place = np.arange(high - low) - np.repeat(begin, np.diff(np.append(begin, high - low)))
        sums = _running((raw[low:high].astype(np.uint64) + np.uint64(1)) * _factors(_WORD, longest)[np.minimum(place, longest - 1)])
        found[i:j] = sums[end] - sums[begin]
        i = j
    return _mixed(found)


@dataclass(frozen=True)
class Stretches:
    """The stretches of some texts: words as byte ranges, and the number of words up to the end of each stretch."""

    data: bytes  # of all texts, with a line feed between them
    bounds: np.ndarray  # where each text begins, and one behind the last
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray  # hashes
    breaks: np.ndarray  # places of line feeds
    upto: np.ndarray
    first: np.ndarray  # the first stretch of each text, and one behind the last

    def first_words(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int64), self.upto[:-1]])[: len(self.upto)]


def stretches(texts: list[bytes]) -> Stretches:
    data = b"\n".join(texts)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    raw = np.frombuffer(data, np.uint8)
    space = np.ones(len(raw) + 2, np.int8)
    space[1:-1] = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    breaks = np.flatnonzero(raw == 10)
    words = _word_hashes(raw, starts, ends)
    # whether a stretch ends with a word does not depend on what is around the word, but for the end of its line
    line = np.searchsorted(breaks, starts)
    stop = (words % np.uint64(STRETCH_WORDS) == 0) | _STOP[raw[ends - 1]]
    stop |= np.concatenate([line[1:] != line[:-1], [True]])[: len(line)]
    upto = np.flatnonzero(stop) + 1
    first = np.searchsorted(starts[np.concatenate([np.zeros(1, np.int64), upto[:-1]])[: len(upto)]], bounds)
    return Stretches(data, bounds, starts, ends, words, breaks, upto, first)


def worded_lines(text: str) -> list[bytes]:
    """The stretches of all lines of a text, their words parted by one space."""
    found = stretches([text.encode("utf-8")])
    spans = zip(found.first_words().tolist(), found.upto.tolist())
    words = [found.data[a:b] for a, b in zip(found.starts.tolist(), found.ends.tolist())]
    return [b" ".join(words[a:b]) for a, b in spans]


@dataclass(frozen=True)
class Prints:
    """Fingerprints of some texts: hashes of all stretches, and gram, first and last stretch of each fingerprint."""

    hashes: np.ndarray
    upto: np.ndarray
    first: np.ndarray
    gram: np.ndarray
    at: np.ndarray
    to: np.ndarray


def fingerprints(texts: list[bytes], gram_words: int, window_words: int) -> Prints:
    found = stretches(texts)
    upto, first, n = found.upto, found.first, len(found.upto)
    none = np.zeros(0, np.int64)
    if not n:
        return Prints(np.zeros(0, np.uint64), upto, first, none, none, none)
    starts = found.first_words()
    place = np.arange(len(found.words)) - np.repeat(starts, upto - starts)
    sums = _running(found.words * _factors(_STRETCH, int(place.max()) + 1)[place])
    hashes = _mixed(sums[upto] - sums[starts])
    # the last line of the shortest run with so many words from each line on; it must be of the same text
    behind = np.repeat(first[1:], np.diff(first))
    gram_end, window_end = np.searchsorted(upto, starts + gram_words), np.searchsorted(upto, starts + window_words)
    grams, windows = np.flatnonzero(gram_end < behind), np.flatnonzero(window_end < behind)
    if not len(windows):
        return Prints(hashes, upto, first, none, none, none)
    value = np.zeros(n, np.uint64)
    left, k = grams, 0
    factor = _factors(_GRAM, gram_words + 1)
    while len(left):
        value[left] += hashes[left + k] * factor[k]
        k += 1
        left = left[gram_end[left] >= left + k]
    value = _mixed(value).view(np.int64)
    # the leftmost least gram of each window, which holds those that end within it
    wide = np.searchsorted(gram_end, window_end[windows], side="right") - windows
    best, least = windows.copy(), value[windows]
    for k in range(1, int(wide.max())):
        more = np.flatnonzero(wide > k)
        other = value[windows[more] + k]
        lower = other < least[more]
        best[more[lower]], least[more[lower]] = windows[more[lower]] + k, other[lower]
    at = np.unique(best)
    return Prints(hashes, upto, first, value[at], at, gram_end[at])


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], slice]]:
    """The texts of a batch, some at a time."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _PIECE or i + 1 == len(texts):
            yield texts[at : i + 1], slice(at, i + 1)
            at, size = i + 1, 0


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte strings of the given lengths, one behind the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _records(doc_ids: pa.Array, text_hashes: pa.Array, found: Prints, window_words: int) -> pa.RecordBatch:
    """A row of ``_RECORD`` for each fingerprint; the lines before it are nearest first."""
    at, to, upto, first = found.at, found.to, found.upto, found.first
    text = np.searchsorted(first, at, side="right") - 1
    starts = np.concatenate([np.zeros(1, np.int64), upto[:-1]])[: len(upto)]
    low = np.maximum(first[text], np.searchsorted(upto, starts[at] - window_words, side="right"))
    high = np.minimum(first[text + 1], np.searchsorted(upto, upto[to] + window_words) + 1)
    place = np.zeros(len(at), [("nameless", "u1"), ("id", ">u8"), ("text", ">u8"), ("at", ">u4")])
    flip = np.uint64(1 << 63)
    place["nameless"] = np.asarray(doc_ids.is_null())[text]
    place["id"] = np.asarray(pc.fill_null(doc_ids, 0)).astype(np.int64).view(np.uint64)[text] ^ flip
    place["text"] = np.asarray(text_hashes).astype(np.int64).view(np.uint64)[text] ^ flip
    place["at"] = at - first[text]

    def keys(count: np.ndarray, way: int, begin: np.ndarray) -> pa.Array:
        ends = np.cumsum(count + 1)
        step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count - 1, count + 1)
        units = found.hashes[np.repeat(begin, count + 1) + way * step]
        units[step == 0] = found.gram.view(np.uint64)
        return _binary(units, (count + 1) * _UNIT)

    return pa.RecordBatch.from_arrays([
        pa.array(found.gram), _binary(place, np.full(len(at), place.itemsize)), pa.array((to - at + 1).astype(np.int32)),
        keys(at - low, -1, at), keys(high - 1 - to, 1, to)], list(_RECORD))


def _shared(one: bytes, two: bytes) -> int:
    """How many units two keys have in common from the start."""
    n = min(len(one), len(two))
    if one[:n] == two[:n]:
        return n // _UNIT
    differ = int.from_bytes(one[:n], "big") ^ int.from_bytes(two[:n], "big")
    return (n - (differ.bit_length() + 7) // 8) // _UNIT


def _nearest(group: list[tuple], joints: list[int]) -> tuple[list[int], list[bytes]]:
    """For each ``(place, depth, ...)`` the units it shares with any earlier place that stands before it in the list, and for the
    last one the earliest place for each number of units; ``joints`` are the units each shares with the one before it."""
    least: list[bytes] = []  # earliest place that shares so many units and one
    units = []
    for (place, depth, *_), joint in zip(group, joints):
        del least[joint:]
        found = bisect_left(least, place)
        units.append(found)
        least[found:] = [place] * (depth - found)
    return units, least


@giving_back
def _sorted_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How far each place goes on like an earlier one of this partition, and what the neighbouring partitions need.

    Rows of the first and last fingerprint may have their match over the border; they say how much they share with the first
    and the last key. A row without a place has the partition's first and last keys and the earliest places beside them.
    """
    part = TaskContext.get().partitionId()
    border: dict = {}

    def close(group: list[tuple], joints: list[int], key: bytes, trails: bool) -> Iterator[tuple]:
        leads = not border
        on, end = _nearest(group, joints)
        back, begin = _nearest(group[::-1], [0, *joints[:0:-1]])
        back.reverse()
        if leads:
            border.update(first=group[0][2], begin=begin)
        if trails:
            border.update(last=key, end=end)
        lead = trail = [0] * len(group)
        if leads:
            lead = [group[0][1]]
            for joint in joints[1:]:
                lead.append(min(lead[-1], joint))
        if trails:
            trail = [group[-1][1]]
            for joint in joints[:0:-1]:
                trail.append(min(trail[-1], joint))
            trail.reverse()
        for (place, _, _, lines), a, b, c, d in zip(group, on, back, lead, trail):
            if a or b or c or d:
                yield part, place, lines, max(a, b), c, d, None, None, None, None

    def rows() -> Iterator[tuple]:
        group: list[tuple] = []
        joints: list[int] = []
        before = b""
        for batch in batches:
            for key, place, lines in zip(*(batch.column(c).to_pylist() for c in ("key", "place", "lines"))):
                joint = _shared(before, key)
                if not joint and group:
                    yield from close(group, joints, before, False)
                    group, joints = [], []
                # only the first key is asked for later
                group.append((place, len(key) // _UNIT, None if group or border else key, lines))
                joints.append(joint)
                before = key
        if group:
            yield from close(group, joints, before, True)
            yield part, None, None, None, None, None, border["first"], border["last"], border["begin"], border["end"]

    return batches_of(_REACH, rows())


def _least(one: list[bytes], two: list[bytes]) -> list[bytes]:
    longer, shorter = (one, two) if len(one) >= len(two) else (two, one)
    return [min(a, b) for a, b in zip(longer, shorter)] + longer[len(shorter):]


def _over_borders(parts: list) -> dict[int, tuple[list[bytes], list[bytes]]]:
    """For each partition the earliest places of those before it and of those behind it, by units shared with its first and last key."""
    parts = sorted(parts, key=lambda r: r["part"])
    into: dict[int, list] = {r["part"]: [[], []] for r in parts}
    for way, (near, far, ends) in enumerate((("first", "last", "end"), ("last", "first", "begin"))):
        chain = parts if way == 0 else parts[::-1]
        for here, there in zip(chain, chain[1:]):
            through = into[here["part"]][way][: _shared(here["first"], here["last"])]
            into[there["part"]][way] = _least(here[ends], through)[: _shared(here[far], there[near])]
    return {part: (ahead, behind) for part, (ahead, behind) in into.items() if ahead or behind}


def _reached(records: DataFrame, side: str) -> DataFrame:
    """``doc_id, text_hash, first, last``: each place as far as it goes on like any earlier one, on one side."""
    ordered = records.select(F.col(side).alias("key"), "place", "lines").repartitionByRange("key", "place").sortWithinPartitions("key", "place")
    found = stage(ordered.mapInArrow(_sorted_pass, _REACH_DDL))
    # one row a partition
    borders = _over_borders(found.where("place IS NULL").select("part", "first", "last", "begin", "end").collect())
    sent = records.sparkSession.sparkContext.broadcast(borders)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = sent.value

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for part, place, lines, units, lead, trail in zip(
                    *(batch.column(c).to_pylist() for c in ("part", "place", "lines", "units", "lead", "trail"))
                ):
                    if (lead or trail) and part in into:
                        ahead, behind = into[part]
                        units = max(units, bisect_left(ahead[:lead], place), bisect_left(behind[:trail], place))
                    if units:
                        nameless, doc_id, text_hash, at = struct.unpack(">BQQI", place)
                        first, last = (at, at + lines + units - 2) if side == "behind" else (at - units + 1, at + lines - 1)
                        yield None if nameless else doc_id - (1 << 63), text_hash - (1 << 63), first, last

        return batches_of(_RUN, rows())

    return found.where("place IS NOT NULL").drop("first", "last", "begin", "end").mapInArrow(settle, _RUN_DDL)


def repeated_runs(
    docs: DataFrame, gram_words: int = 25, window_words: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_hash, first, last``: runs of stretches (as numbered by ``worded_lines``) that occurred before.

    The order is that of ids (NULL last), then of text hashes, then of lines.
    """
    @giving_back
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, _ in _pieces(batch):
                yield pa.RecordBatch.from_arrays([pa.array(fingerprints(texts, gram_words, window_words).gram)], ["gram"])

    @giving_back
    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, rows in _pieces(batch):
                doc_ids, text_hashes = (batch.column(c)[rows.start : rows.stop] for c in ("doc_id", "text_hash"))
                yield _records(doc_ids, text_hashes, fingerprints(texts, gram_words, window_words), window_words)

    texts = text_columns(docs, id_col, text_col, _text_hash(text_col))
    repeated = stage(
        texts.select("text").mapInArrow(scan, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"))
    # told by a filter, so few rows besides those of repeated fingerprints are stored; the others match nothing
    records = stage(with_candidates(texts.mapInArrow(around, _RECORD_DDL), repeated, "gram", F.col("gram"), "may").where("may").drop("gram", "may"))
    return _reached(records, "before").unionByName(_reached(records, "behind"))


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("text_hash")


def _cut(found: Stretches, text: int, runs: list[tuple[int, int]]) -> tuple[bytes, int]:
    """One of the texts without the stretches of the runs (counted from its first one), and how many lines lost any."""
    begin_at, end_at = int(found.bounds[text]), int(found.bounds[text + 1]) - 1
    low, high = int(found.first[text]), int(found.first[text + 1])
    data, breaks = found.data, found.breaks
    change = np.zeros(high - low + 1, np.int64)
    for first, last in runs:
        change[first] += 1
        change[last + 1] -= 1
    gone = np.cumsum(change[:-1]) > 0
    upto = found.upto[low:high]
    starts = found.starts[np.concatenate([[found.upto[low - 1] if low else 0], upto[:-1]])[: len(upto)]]
    line = np.searchsorted(breaks, starts)
    touched = np.unique(line[gone]).tolist()
    kept = bytearray()
    at = begin_at
    for number in touched:
        begin = max(begin_at, int(breaks[number - 1]) + 1 if number else 0)
        end = min(end_at, int(breaks[number]) if number < len(breaks) else end_at)
        kept += data[at:begin]
        low, high = np.searchsorted(line, [number, number + 1]).tolist()
        stays = ~gone[low:high]
        if stays.any():
            edges = [*starts[low:high].tolist(), end]
            left = b"".join(data[edges[k] : edges[k + 1]] for k in np.flatnonzero(stays).tolist())
            kept += data[begin : edges[0]] + (left if stays[-1] else left.rstrip())
            at = end
        else:
            at = end + 1
            if end == end_at and kept:
                del kept[-1]  # a last line goes with the line feed before it
    kept += data[at:end_at]
    return bytes(kept), len(touched)


def cut_lines(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the stretches of the runs, and how many lines lost any."""
    left, touched = _cut(stretches([text.encode("utf-8")]), 0, runs)
    return left.decode("utf-8"), touched


def dedup_lines(
    docs: DataFrame, gram_words: int = 25, window_words: int = 50, id_col: str = "doc_id", text_col: str = "text",
    count_as: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` with later repeated passages cut out of the text, also from inside lines; no row is dropped.

    Runs of at least ``gram_words`` words that match an earlier occurrence of a fingerprint go, and so does every run of
    ``window_words`` words that occurred before, as it has a fingerprint; both are counted in whole stretches. Of any stretch, the first
    occurrence always stays. Words are compared without the white space around them; a line of which all words are cut goes,
    a line without a word is never cut. A text of which all is
    cut is the empty string, or the blank lines it had. NULL texts stay NULL. Rows with a NULL id come last in the order;
    rows equal in id and text are one place, so they are cut alike. Other columns are kept whatever their
    names; an empty table stays empty. ``count_as`` names a column to add with the number of lines that lost words.
    """
    runs = stage(repeated_runs(docs, gram_words, window_words, id_col, text_col))
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no column of the table can clash
    own_id, text_at = F.col(f"c{names.index(id_col)}").cast("long"), f"c{names.index(text_col)}"
    inner = inner.withColumn(text_at, F.col(text_at).cast("string"))
    columns = inner.columns
    marked = with_candidates(inner, runs, "doc_id", own_id, "touched")
    touched, untouched = (marked.where(c).drop("touched") for c in (F.col("touched"), ~F.col("touched")))
    out = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]

    def shown(df: DataFrame, count) -> DataFrame:
        return df.select(*out, *([count.alias(count_as)] if count_as else []))

    cuts = runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("runs")).select(
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), "text_hash", "runs",
    )
    joined = touched.withColumns({
        "nameless": own_id.isNull(), "id": F.coalesce(own_id, F.lit(0).cast("long")), "text_hash": F.xxhash64(F.coalesce(text_at, F.lit(""))),
    }).join(cuts, ["nameless", "id", "text_hash"], "left").select(*columns, "runs")

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, runs = batch.column(text_at), batch.column("runs")
            hit = runs.is_valid()
            some = pa.RecordBatch.from_arrays([text.filter(hit), runs.filter(hit)], ["text", "runs"])
            changed = []
            for texts, rows in _pieces(some):
                found, own = stretches(texts), some.column("runs")[rows.start : rows.stop].to_pylist()
                changed += [_cut(found, i, [(r["first"], r["last"]) for r in rs]) for i, rs in enumerate(own)]
            new = pc.replace_with_mask(text, hit, pa.array([t for t, _ in changed], pa.binary()).cast(text.type))
            cut_n = pc.replace_with_mask(pa.array(np.zeros(len(text), np.int64)), hit, pa.array([n for _, n in changed], pa.int64()))
            kept = [new if c == text_at else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, cut_n], [*columns, "cut"])

    done = joined.mapInArrow(cut, T.StructType([*inner.schema.fields, T.StructField("cut", T.LongType())]))
    return shown(done, F.col("cut")).unionByName(shown(untouched, F.lit(0).cast("long")))
