"""Token counts with the whole-token shortcut.

Offline, every vocabulary string is merged on its own; those that end as a single token are whole tokens.
In the job, each pre-token that is a whole token counts one without any merging, and only the rest is merged,
once per distinct string and task. Documents are counted where they are read: nothing is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from riskloom.llm import bpe
from riskloom.llm.arrow import batches_of, text_columns

#: Merged strings a task remembers besides the whole tokens; then it starts anew.
REMEMBERED = 800_000


def whole_tokens(vocabulary: list[bytes], pairs: dict[bpe.Pair, int]) -> set[str]:
    """The vocabulary strings that encode alone as one token, proven by merging each of them."""
    proven = set()
    for token in vocabulary:
        if len(bpe.merge(token, pairs)) == 1:
            try:
                proven.add(token.decode("utf-8"))
            except UnicodeDecodeError:
                continue  # part of a character: never a pre-token by itself
    return proven


def library_fixes(content: bytes) -> dict[int, str]:
    """Code points the tokenizers library puts in other character classes than ``regex`` does."""
    from tokenizers import Regex, pre_tokenizers

    def members(expression: str, text: str) -> set[str]:
        kept = pre_tokenizers.Split(Regex(expression), "removed").pre_tokenize_str(text)
        return set(text).difference(*[s for s, _ in kept])

    return bpe.class_fixes(members)


class _Lengths(dict):
    """Token counts by pre-token; an unknown one is merged when first asked for."""

    def __init__(self, whole: set[str], pairs: dict[bpe.Pair, int]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.pairs, self.room = whole, pairs, REMEMBERED

    def __missing__(self, piece: str) -> int:
        n = len(bpe.merge(piece.encode("utf-8"), self.pairs))
        if len(piece) <= 64:
            if self.room == 0:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
                self.room = REMEMBERED
            self[piece] = n
            self.room -= 1
        return n


@functools.lru_cache(maxsize=2)
def _prepared(content: bytes, pattern: str, fixes: tuple) -> tuple[bpe.Splitter, _Lengths, regex.Pattern | None]:
    """Kept by the worker process, so that its later tasks start with what it has merged before."""
    vocabulary, pairs, specials = bpe.read_json_vocabulary(content)
    special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
    return bpe.Splitter(pattern, dict(fixes)), _Lengths(whole_tokens(vocabulary, pairs), pairs), special


def count_tokens(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row, as the library of the vocabulary file counts them.

    Special strings inside a text count as one token each, none are added. NULL texts count as empty
    (0 bytes, 0 tokens); rows with a NULL or repeated id are counted one by one; other columns are ignored;
    an empty table gives an empty table. Texts of any length are split in stretches of bounded size.
    """
    spark = docs.sparkSession
    content = bpe.read_local(vocabulary_path)
    sent = spark.sparkContext.broadcast((content, pattern, tuple(sorted(library_fixes(content).items()))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, lengths, special = _prepared(*sent.value)

        def tokens(text: str) -> int:
            parts = special.split(text) if special else [text]
            return len(parts) - 1 + sum(map(lengths.__getitem__, chain.from_iterable(
                chain.from_iterable(map(splitter.pieces, parts)))))

        for batch in batches:
            ids, texts, sizes = (batch.column(c).to_pylist() for c in ("doc_id", "text", "n_bytes"))
            yield from batches_of(
                {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64()},
                zip(ids, sizes, map(tokens, texts)),
            )

    texts = text_columns(docs, id_col, text_col, F.octet_length(
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).cast("long").alias("n_bytes"))
    return texts.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
