"""Token counts and BPE coding against the libraries themselves."""

import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import SMALL, awkward, pairs
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from riskloom.llm import bpe, bpe_codec, token_count

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = Tokenizer.from_file(JSON)
ENCODING = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.read_local(RANKS)), special_tokens={})


def counted(df):
    return token_count.count_tokens(df, JSON, public_tokenizers.PATTERN)


def coded(df):
    return bpe_codec.encode_decode(df, RANKS, public_tokenizers.PATTERN)


def expected_code(text):
    ids = ENCODING.encode_ordinary(text)
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_counts_equal_the_library(spark):
    special = spark.createDataFrame([(900, "<|endoftext|>a <|endoftext|> b<|endoftext|>")], "doc_id long, text string")
    for df in (awkward(spark), spark.read.parquet(f"{SMALL}/documents.parquet"), special):
        want = sorted((i is None, i or 0, len(t.encode()), len(LIBRARY.encode(t, add_special_tokens=False).ids)) for i, t in pairs(df))
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counted(df).collect())
        assert got == want


def test_codes_equal_the_library_and_decode_to_the_text(spark):
    for df in (awkward(spark), spark.read.parquet(f"{SMALL}/documents.parquet")):
        want = sorted((str(i), *expected_code(t)) for i, t in pairs(df))
        assert sorted((str(r[0]), *r[1:]) for r in coded(df).collect()) == want


def test_empty_tables(spark):
    empty = awkward(spark).limit(0)
    assert counted(empty).collect() == [] and coded(empty).collect() == []


def test_whole_tokens_are_proven():
    vocabulary, pairs_, _ = bpe.read_json_vocabulary(bpe.read_local(JSON))
    whole = token_count.whole_tokens(vocabulary, pairs_)
    assert " the" in whole and len(whole) > 40_000
    sample = sorted(whole)[::997]
    assert all(len(LIBRARY.encode(t, add_special_tokens=False).ids) == 1 for t in sample)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab 'st\n\t 1٣é漢!?　\x1c\x00", max_size=300))
def test_units_are_cut_where_pretokens_begin(text):
    splitter = bpe.Splitter(public_tokenizers.PATTERN, {})
    lengths, number, codes = splitter.units([text, "x y"])
    names = list(number)
    units = [names[c] for c in codes.tolist()]
    assert "".join(units[: lengths[0]]) == text
    want = regex.findall(public_tokenizers.PATTERN, text)
    assert [p for u in units[: lengths[0]] for some in splitter.pieces(u) for p in some] == want
    assert [p for some in splitter.pieces(text) for p in some] == want


def test_long_texts_are_split_alike(monkeypatch):
    text = ("word and  more\n " * 300) + "y" * 500
    splitter = bpe.Splitter(public_tokenizers.PATTERN, {})
    whole = [p for some in splitter.pieces(text) for p in some]
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    assert [p for some in splitter.pieces(text) for p in some] == whole


def test_heap_and_scan_merge_alike(monkeypatch):
    pairs_ = bpe.pair_ranks(bpe.read_ranks(bpe.read_local(RANKS)))
    pieces = [w.encode() for w in ("antidisestablishment", "aaaaaaaaaaaaaaaaaaa", "日本語日本語", "x", "")] + [b"abab" * 400]
    short = [bpe.merge(p, pairs_) for p in pieces[:-1]]
    monkeypatch.setattr(bpe, "_SHORT", 0)
    assert [bpe.merge(p, pairs_) for p in pieces[:-1]] == short
    assert len(bpe.merge(pieces[-1], pairs_)) == len(ENCODING.encode_ordinary("abab" * 400))


def test_numbers_pack_and_unpack():
    import numpy as np

    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1])
    assert bpe_codec.unpack_numbers(bpe_codec.pack_numbers(numbers)).tolist() == numbers.tolist()
    assert bpe_codec.unpack_numbers(b"").tolist() == []


def test_codepoint_classes_follow_the_library():
    fixes = bpe_codec.library_fixes(b"")
    if not fixes:
        pytest.skip("both know the same Unicode version")
    text = "a" + chr(min(fixes)) + "b"
    splitter = bpe.Splitter(public_tokenizers.PATTERN, fixes)
    ids = [i for some in splitter.pieces(text) for p in some for i in ENCODING.encode_ordinary(p)]
    assert b"".join(ENCODING.decode_single_token_bytes(i) for i in ids).decode() == text


def test_pieces_merged_side_by_side_as_one_by_one():
    import random

    from riskloom.llm import bpe

    rng = random.Random(6)
    tokens = [bytes([b]) for b in range(256)]
    tokens += sorted({bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(150)}, key=lambda t: (rng.random(), t))
    ranks = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
    pairs = bpe.pair_ranks(ranks)
    pieces = [bytes(rng.choices(b"abcd\xff", weights=(5, 5, 5, 1, 1), k=rng.randint(1, 12))) for _ in range(3000)] + [b"", b"ab" * 300, b"a", b"\xfe"]
    assert bpe.Merger(ranks, pairs).ids(pieces) == [[ranks[p]] if p in ranks else [ranks[t] for t in bpe.merge(p, pairs)] for p in pieces]


def test_a_bounded_memory_of_words_changes_no_ids(spark, monkeypatch):
    rows = [(i, f"word{i % 7} other{i}. word{i % 7}, naïve  gap\n{'x' * (i % 5)} don't " * 20) for i in range(60)] + [(None, None), (3, " ")]
    monkeypatch.setattr(bpe_codec, "CHUNK_CHARS", 900)
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in bpe_codec.encode_decode(df.cache(), RANKS, public_tokenizers.PATTERN).fillna({"doc_id": -1}).collect())
    df.unpersist()
    assert got == sorted((-1 if i is None else i, *expected_code(t or "")) for i, t in rows)


def test_chunks_of_a_task_are_not_held_together():
    import tracemalloc

    splitter = bpe.Splitter(public_tokenizers.PATTERN, {})

    def peak(words):
        texts = [" ".join(f"w{i}" for i in range(at, at + 1000)) for at in range(0, words, 1000)]
        tracemalloc.start()
        bpe_codec._distinct(splitter, texts, 64)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most / sum(map(len, texts))

    # bytes for a code point of the least favourable text, only new words: a chunk's peak is bounded by its size
    assert peak(50_000) * bpe_codec.CHUNK_CHARS < 250e6
