"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are read in chunks of bounded size. A chunk cuts its texts into words, at single spaces, where a pre-token always
begins; it lists its distinct words, dealt by a hash into buckets, and writes its texts as positions in that list.
The lists are shuffled by bucket, so all chunks' copies of a word meet in one task, which splits each distinct word
into pre-tokens and merges them once; the ids go back to their chunks, where they are joined to the positions,
reassembled in order, and decoded through the token-byte table.

Words and positions travel packed, a row for each chunk and bucket, since a row for every occurrence would cost many
times the text. A word that every chunk holds travels once per chunk, whatever its frequency.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from itertools import batched, chain, groupby
from struct import pack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from riskloom.llm import bpe
from riskloom.llm.arrow import giving_back, text_columns

#: Code points of text that make up a chunk; a longer text is a chunk of its own.
CHUNK_CHARS = 6_000_000
#: Buckets for the words of a chunk, at least; as many as shuffle partitions if those are more.
BUCKETS = 64
#: Distinct words of a bucket that a task remembers; beyond, a word may be merged again.
REMEMBERED = 300_000
#: Lists of one bucket whose new words are merged at once.
_LISTS = 8
_ENDINGS = ".,;:!?\"')"

#: Numbers packed or unpacked at once.
_AT_ONCE = 1 << 17

_LIST = "chunk string, bucket int, n long, packed binary"
_OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def library_fixes(content: bytes) -> dict[int, str]:
    """Code points the tiktoken library puts in other character classes than ``regex`` does."""
    import tiktoken

    def members(expression: str, text: str) -> set[str]:
        probe = tiktoken.Encoding("probe", pat_str=expression, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        return set(bytes(probe.encode_ordinary(text)).decode("utf-8"))

    return bpe.class_fixes(members)


@functools.lru_cache(maxsize=2)
def _splitter(pattern: str, fixes: tuple) -> bpe.Splitter:
    return bpe.Splitter(pattern, dict(fixes))


@functools.lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> tuple[dict[bytes, int], dict[bpe.Pair, int], dict[int, bytes]]:
    ranks = bpe.read_ranks(content)
    return ranks, bpe.pair_ranks(ranks), {i: token for token, i in ranks.items()}


@functools.lru_cache(maxsize=2)
def _merger(content: bytes) -> bpe.Merger:
    return bpe.Merger(*_vocabulary(content)[:2])


@functools.lru_cache(maxsize=2)
def _spaced(content: bytes) -> dict[int, bytes]:
    """Every id in decimal behind a space."""
    return {i: b" %d" % i for i in _vocabulary(content)[2]}


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers under 2**28 as one to four bytes of seven bits each, low bits first."""
    return b"".join(_packed(numbers[at : at + _AT_ONCE]) for at in range(0, len(numbers), _AT_ONCE))


def _packed(numbers: np.ndarray) -> bytes:
    n = numbers.astype(np.uint32)
    cells = np.stack([(n >> s) & 0x7F for s in (0, 7, 14, 21)], axis=1).astype(np.uint8)
    used = np.stack([np.ones(len(n), bool), n >= 1 << 7, n >= 1 << 14, n >= 1 << 21], axis=1)
    cells[:, :3] |= (used[:, 1:] << 7).astype(np.uint8)
    return cells[used].tobytes()


def unpack_numbers(packed: bytes) -> np.ndarray:
    cells = np.frombuffer(packed, np.uint8)
    found, at = [np.zeros(0, np.int64)], 0
    while at < len(cells):
        to = min(len(cells), at + _AT_ONCE)
        while cells[to - 1] >= 0x80:  # not inside a number
            to += 1
        found.append(_unpacked(cells[at:to]))
        at = to
    return np.concatenate(found)


def _unpacked(cells: np.ndarray) -> np.ndarray:
    last = cells < 0x80
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    sizes = np.diff(np.append(starts, len(cells)))
    shifts = 7 * (np.arange(len(cells)) - np.repeat(starts, sizes))
    return np.add.reduceat((cells & 0x7F).astype(np.int64) << shifts, starts)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[int | None], list[str]]]:
    """Name, ids and texts of chunk after chunk. The name follows from the content alone."""
    ids: list[int | None] = []
    texts: list[str] = []
    size, name = 0, xxhash.xxh3_128()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if ids and size + len(text) > CHUNK_CHARS:
                yield name.hexdigest(), ids, texts
                ids, texts, size, name = [], [], 0, xxhash.xxh3_128()
            name.update(f"{doc_id} {len(text)} ")
            name.update(text.encode("utf-8"))
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if ids:
        yield name.hexdigest(), ids, texts


def _distinct(splitter: bpe.Splitter, texts: list[str], buckets: int) -> tuple[list[int], list[str], np.ndarray, np.ndarray]:
    """Number of words of each text; the chunk's distinct words by falling count, so that frequent ones have short numbers; their
    buckets; the places of all words.

    Words that differ only in what ends them share a bucket, where their common pre-token is merged once.
    """
    lengths, number, codes = splitter.units(texts)
    order = np.argsort(-np.bincount(codes, minlength=len(number)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    own = list(number)
    words = [own[i] for i in order.tolist()]
    bucket = np.fromiter((xxhash.xxh32_intdigest(w.rstrip(_ENDINGS)) % buckets for w in words), np.int32, len(words))
    return lengths, words, bucket, place[codes]


def encode_decode(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row.

    ``docs`` should be a stored table: it is read twice, for words and for positions, and the job stops with an
    error if both readings do not give the same chunks. NULL texts count as empty (0 tokens, digests of the empty
    string); rows with a NULL or repeated id are kept one by one; other columns are ignored; an empty table gives
    an empty table. Special strings are ordinary text.
    """
    spark = docs.sparkSession
    content = bpe.read_local(vocabulary_path)
    buckets = max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    split_by = spark.sparkContext.broadcast((pattern, tuple(sorted(library_fixes(content).items()))))
    vocabulary = spark.sparkContext.broadcast(content)

    @giving_back
    def word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _splitter(*split_by.value)
        for chunk, _, texts in _chunks(batches):
            _, words, bucket, _ = _distinct(splitter, texts, buckets)
            for b in range(buckets):
                own = [words[i].encode("utf-8") for i in np.flatnonzero(bucket == b).tolist()]
                if own:
                    lengths = pack_numbers(np.fromiter(map(len, own), np.int64, len(own)))
                    packed = zlib.compress(lengths + b"".join(own), 3)
                    yield pa.RecordBatch.from_pylist(
                        [{"chunk": chunk, "bucket": b, "n": len(own), "packed": packed}], schema=_arrow(_LIST))
            del texts, words, bucket  # before the next chunk is read

    @giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary.value)
        splitter = _splitter(*split_by.value)
        cut = splitter.pattern.findall

        def pieces(word: bytes) -> list[bytes]:
            text = word.decode("utf-8")
            return list(map(str.encode, cut(text) if word.isascii() else chain.from_iterable(splitter.pieces(text))))

        def learn(words: list[bytes]) -> None:
            parted = list(map(pieces, words))
            new = [piece for piece in dict.fromkeys(chain.from_iterable(parted)) if piece not in merged]
            merged.update((piece, pack("<%dI" % len(ids), *ids)) for piece, ids in zip(new, merger.ids(new)))
            known.update((word, b"".join(map(merged.__getitem__, own))) for word, own in zip(words, parted))

        def listed(row: dict) -> list[bytes]:
            raw = zlib.decompress(row["packed"])
            lengths, at = _head(raw, row["n"])
            ends = (at + np.cumsum(lengths)).tolist()
            return [raw[i:j] for i, j in zip([at, *ends], ends)]

        known: dict[bytes, bytes] = {}
        merged: dict[bytes, bytes] = {}
        bucket = chunk = None
        for batch in batches:
            for bucket_of, rows in groupby(batch.to_pylist(), key=lambda row: row["bucket"]):
                if bucket_of != bucket:
                    known, bucket, chunk = {}, bucket_of, None
                    merged.clear()
                for some in batched(rows, _LISTS):  # words of a few chunks are learned together
                    if len(known) > REMEMBERED:
                        known = {}
                        merged.clear()
                    held = []
                    for row in some:
                        if row["chunk"] != chunk:  # chunks of one name hold the same texts
                            held.append((row, listed(row)))
                        chunk = row["chunk"]
                    learn([w for w in dict.fromkeys(chain.from_iterable(words for _, words in held)) if w not in known])
                    for row, words in held:
                        out = list(map(known.__getitem__, words))
                        sizes = np.fromiter((len(x) // 4 for x in out), np.int64, len(out))
                        ids = np.frombuffer(b"".join(out), "<u4")
                        packed = zlib.compress(pack_numbers(sizes) + pack_numbers(ids), 3)
                        yield pa.RecordBatch.from_pylist(
                            [{"chunk": row["chunk"], "bucket": row["bucket"], "n": row["n"], "packed": packed}],
                            schema=_arrow(_LIST))

    @giving_back
    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _splitter(*split_by.value)
        for chunk, ids, texts in _chunks(batches):
            lengths, words, bucket, where = _distinct(splitter, texts, buckets)
            del texts, words
            yield pa.RecordBatch.from_pylist([{
                "chunk": chunk,
                "ids": ids,
                "lengths": lengths,
                "positions": pack_numbers(where),
                "buckets": pack_numbers(bucket),
            }], schema=_arrow(_TEXTS))
            del ids, lengths, bucket, where  # before the next chunk is read

    def reassemble(texts: pa.Table, lists: pa.Table) -> pa.Table:
        of, shown_as = _vocabulary(vocabulary.value)[2], _spaced(vocabulary.value)
        by_bucket = {row["bucket"]: row for row in lists.to_pylist()}
        out = []
        for text in texts.to_pylist():  # chunks of one name hold the same texts
            bucket = unpack_numbers(text["buckets"])
            shown: list[bytes] = [b""] * len(bucket)
            decoded: list[bytes] = [b""] * len(bucket)
            counts = np.zeros(len(bucket), np.int64)
            for b in np.unique(bucket).tolist():
                places = np.flatnonzero(bucket == b)
                if b not in by_bucket or by_bucket[b]["n"] != len(places):
                    raise RuntimeError("the table changed between its two readings; store it first")
                numbers = unpack_numbers(zlib.decompress(by_bucket[b]["packed"]))
                lengths, tokens = numbers[: len(places)], numbers[len(places) :].tolist()
                counts[places] = lengths
                start = 0
                for place, length in zip(places.tolist(), lengths.tolist()):
                    own = tokens[start : start + length]
                    start += length
                    shown[place] = b"".join([shown_as[t] for t in own])
                    decoded[place] = b"".join([of[t] for t in own])
            where = unpack_numbers(text["positions"])
            start = 0
            for doc_id, length in zip(text["ids"], text["lengths"]):
                own = where[start : start + length]
                start += length
                places = own.tolist()
                out.append((
                    doc_id,
                    int(counts[own].sum()),
                    hashlib.sha256(memoryview(b"".join(map(shown.__getitem__, places)))[1:]).hexdigest(),
                    hashlib.sha256(b"".join(map(decoded.__getitem__, places))).hexdigest(),
                ))
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 4, _arrow(_OUT))], schema=_arrow(_OUT))

    texts = text_columns(docs, id_col, text_col)
    encoded = (
        texts.mapInArrow(word_lists, _LIST)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "chunk")
        .mapInArrow(encode, _LIST)
    )
    return (
        texts.mapInArrow(positions, _TEXTS).groupBy("chunk")
        .cogroup(encoded.groupBy("chunk"))
        .applyInArrow(reassemble, _OUT)
    )


_TEXTS = "chunk string, ids array<long>, lengths array<int>, positions binary, buckets binary"


@functools.lru_cache(maxsize=4)
def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


def _head(raw: bytes, n: int) -> tuple[np.ndarray, int]:
    """The first ``n`` packed numbers, and where they end."""
    cells = np.frombuffer(raw, np.uint8)
    # lengths are nearly always single bytes, so a little more than n bytes is enough to look at
    look = n
    while True:
        ends = np.flatnonzero(cells[:look] < 0x80)
        if len(ends) >= n:
            end = int(ends[n - 1]) + 1
            return unpack_numbers(raw[:end]), end
        look = min(len(cells), look * 2)
