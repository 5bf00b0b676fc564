"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in at most d bits agree wholly on one of d + 1 parts of their bits. Distinct fingerprints
are dealt by each part; inside a bucket they are sorted by Gray rank, leaves of neighbours are built, and upper nodes
hold the bit pattern that everything below shares, with its mask. Pairs of nodes are followed from the top only while
the differences of their shared patterns stay within d. A bucket gives a spanning forest of its links, never
all pairs; a bucket above ``BUCKET_ROWS`` is dealt again by parts of its remaining bits, so no task holds more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from riskloom.llm.arrow import giving_back, text_columns
from riskloom.llm.components import components
from riskloom.llm.member import with_candidates
from riskloom.session import stage

#: Distinct fingerprints of a bucket that one index takes; larger buckets are dealt again by more bits.
BUCKET_ROWS = 4096
_LEAF, _FAN = 64, 8
#: Pairs that are compared at once.
_AT_ONCE = 1 << 19
_SHINGLES_AT_ONCE = 1 << 16
_ALL = (1 << 64) - 1


def fingerprint(text: str, shingle: int) -> int:
    """Bits set in over half of the shingles' XXH64 (seed 42); 0 without a word."""
    words = text.encode("utf-8").lower().split()  # both know ASCII only, as asked
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, _SHINGLES_AT_ONCE):
        to = min(n, at + _SHINGLES_AT_ONCE)
        hashes = b"".join([
            digest(joined[s:e], 42) for s, e in zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist())
        ])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shared patterns and masks of the nodes, leaves first; ``codes`` are in Gray order."""
    levels = []
    every, some = codes, codes
    width = _LEAF
    while True:
        starts = np.arange(0, len(every), width)
        every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
        levels.append((every, ~(every ^ some)))
        if len(every) == 1:
            return levels
        width = _FAN


def _children(pairs: np.ndarray, fan: int, below: int) -> Iterator[np.ndarray]:
    """Pairs (left <= right) of what lies below each pair of nodes, a bounded number at once."""
    per = max(1, _AT_ONCE // (fan * fan))
    one, two = (x.ravel() for x in np.meshgrid(np.arange(fan), np.arange(fan), indexing="ij"))
    for at in range(0, len(pairs), per):
        some = pairs[at : at + per]
        left = (some[:, :1] * fan + one).ravel()
        right = (some[:, 1:] * fan + two).ravel()
        fits = (left <= right) & (right < below) & (left < below)
        yield np.stack([left[fits], right[fits]], axis=1)


def links(codes: np.ndarray, distance: int) -> np.ndarray:
    """For each distinct code the place of the first of its group; codes must be in Gray order."""
    root = np.arange(len(codes))
    levels = _levels(codes)

    def down(level: int, pairs: np.ndarray) -> None:
        if level < 0:
            compare(pairs)
            return
        pattern, mask = levels[level]
        left, right = pairs[:, 0], pairs[:, 1]
        apart = np.bitwise_count((pattern[left] ^ pattern[right]) & mask[left] & mask[right])
        pairs = pairs[apart <= distance]
        fan, below = (_FAN, len(levels[level - 1][0])) if level else (_LEAF, len(codes))
        for some in _children(pairs, fan, below):
            if len(some):
                down(level - 1, some)

    def compare(pairs: np.ndarray) -> None:
        pairs = pairs[root[pairs[:, 0]] != root[pairs[:, 1]]]
        left, right = pairs[:, 0], pairs[:, 1]
        near = np.bitwise_count(codes[left] ^ codes[right]) <= distance
        left, right = left[near], right[near]
        while len(left):  # hook the larger root to the smaller, then flatten
            a, b = root[left], root[right]
            differ = a != b
            left, right, a, b = left[differ], right[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                flat = root[root]
                if (flat == root).all():
                    break
                root[:] = flat

    down(len(levels) - 1, np.zeros((1, 2), np.int64))
    return root


def _forest(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Star edges of each bucket; rows come sorted by bucket and Gray rank."""
    held: list[np.ndarray] = []
    key = None

    def star() -> pa.RecordBatch | None:
        codes = np.concatenate(held)
        root = links(codes, distance)
        own = np.flatnonzero(root != np.arange(len(root)))
        if not len(own):
            return None
        return pa.RecordBatch.from_arrays([pa.array(codes[root[own]].view(np.int64)), pa.array(codes[own].view(np.int64))], ["a", "b"])

    for batch in batches:
        fixed = batch.column("fixed").to_numpy()
        value = batch.column("value").to_numpy()
        codes = batch.column("code").to_numpy().view(np.uint64)
        cuts = np.flatnonzero((fixed[1:] != fixed[:-1]) | (value[1:] != value[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(codes)]):
            if start == end:
                continue
            if (fixed[start], value[start]) != key:
                if sum(map(len, held)) > 1 and (found := star()) is not None:
                    yield found
                held, key = [], (fixed[start], value[start])
            held.append(codes[start:end])
    if sum(map(len, held)) > 1 and (found := star()) is not None:
        yield found


def _parts(fixed: int, count: int) -> list[int]:
    """``fixed`` with one of ``count`` parts of the remaining bits added, for each part."""
    free = [b for b in range(64) if not fixed >> b & 1]
    bounds = [len(free) * i // count for i in range(count + 1)]
    return [fixed | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(codes: DataFrame, distance: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``a, b`` that join every two distinct ``code``s within ``distance`` bits, directly or over others."""
    spark = codes.sparkSession
    masks = [0]
    rows = codes.select("code", F.lit(0).cast("long").alias("fixed"))
    found = None
    while True:
        finer = {m: _parts(m, distance + 1) for m in masks}
        masks = sorted({p for parts in finer.values() for p in parts})
        # a few rows for each mask, whatever the data
        deal = spark.createDataFrame([(_signed(m), [_signed(p) for p in parts]) for m, parts in finer.items()], "fixed long, finer array<long>")
        keyed = (
            rows.join(F.broadcast(deal), "fixed").select("code", F.explode("finer").alias("fixed"))
            .withColumn("value", F.col("code").bitwiseAND(F.col("fixed"))).distinct()
            if found is not None else
            rows.select("code", F.explode(F.array(*[F.lit(_signed(p)) for p in finer[0]])).alias("fixed"))
            .withColumn("value", F.col("code").bitwiseAND(F.col("fixed")))
        )
        crowded = stage(keyed.groupBy("fixed", "value").count().where(F.col("count") > bucket_rows).select("fixed", "value"))
        more = not crowded.isEmpty()
        light = keyed.join(crowded, ["fixed", "value"], "left_anti") if more else keyed
        rank = F.col("code")
        for shift in (1, 2, 4, 8, 16, 32):
            rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
        edges = stage(
            light.withColumn("rank", rank).repartition("fixed", "value").sortWithinPartitions("fixed", "value", F.col("rank") < 0, "rank")
            .mapInArrow(lambda batches: _forest(batches, distance), "a long, b long")
        )
        found = edges if found is None else found.unionByName(edges)
        if not more:
            return found
        rows = stage(keyed.join(crowded, ["fixed", "value"], "left_semi").select("code", "fixed"))


def simhash_groups(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, text_hash`` for every row.

    Lower-cased A-Z, words between ASCII white space, shingles of ``shingle`` words with repeats. Documents link at
    ``distance`` or fewer differing bits; a component carries its smallest id. NULL and wordless texts have
    fingerprint zero and link like any other. Rows with a NULL id take part; the id of a component is NULL only
    if all its ids are. Repeated rows come back once each. An empty table gives an empty table.
    """
    @giving_back
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.fromiter((fingerprint(t, shingle) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(codes.view(np.int64))], ["doc_id", "text_hash", "code"])

    text_hash = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("text_hash")
    signed = stage(text_columns(docs, id_col, text_col, text_hash).mapInArrow(sign, "doc_id long, text_hash long, code long"))
    codes = stage(signed.groupBy("code").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(codes, distance, bucket_rows))
    rooted = stage(
        codes.join(roots.withColumnRenamed("node", "code"), "code", "left")
        .select("code", "least", F.coalesce("root", "code").alias("root"))
    )
    # stored, so that the join shuffles both sides and the engine can split a hot group
    named = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    by_code = rooted.join(named, "root").select("code", "root", "component_id")
    return signed.join(by_code, "code").select(
        "doc_id",
        F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"),
        "component_id", "text_hash", F.col("root").alias("group_code"),
    )


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one row of each near-duplicate group does: that of the smallest id.

    Rows of that id are told apart by a hash of their text; of wholly equal rows one stays. Where a group has no id
    at all, the row of the smallest text hash stays.
    """
    groups = simhash_groups(docs, shingle, distance, id_col, text_col)
    places = stage(
        groups.groupBy("group_code", F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    place = F.struct("nameless", "doc_id", "text_hash")
    stays = stage(places.groupBy("group_code").agg(F.min(place).alias("first")))
    # all that is not simply kept: rows that go, and rows that have equals
    cases = stage(
        places.join(stays, "group_code").withColumn("stays", place.eqNullSafe(F.col("first")))
        .where(~F.col("stays") | (F.col("copies") > 1))
        .select("nameless", "doc_id", F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), "text_hash", "stays")
    )
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no column of the table can clash
    own, text = F.col(f"c{names.index(id_col)}").cast("long"), F.col(f"c{names.index(text_col)}").cast("string")
    marked = with_candidates(inner, cases, "doc_id", own, "touched")
    touched, untouched = (marked.where(c).drop("touched") for c in (F.col("touched"), ~F.col("touched")))
    copies = W.partitionBy("id", "nameless", "text_hash").orderBy(F.lit(0))
    looked_up = (
        touched.withColumns({
            "nameless": own.isNull(), "id": F.coalesce(own, F.lit(0).cast("long")),
            "text_hash": F.xxhash64(F.coalesce(text, F.lit(""))),
        })
        .join(cases.drop("doc_id"), ["nameless", "id", "text_hash"], "left")
        .where(F.coalesce("stays", F.lit(True)))
        .withColumn("copy", F.row_number().over(copies)).where(F.col("stays").isNull() | (F.col("copy") == 1))
    )
    out = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return untouched.select(*out).unionByName(looked_up.select(*out))
