"""Threshold-scaled sketches and the comparison of edits against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from helpers import SMALL, awkward, words
from pyspark.sql import functions as F

from riskloom.llm import sketch


def hashes(text, k=5):
    own = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    found = set()
    for i in range(max(1, len(own) - k + 1) if own else 0):
        state = 42
        for w in own[i : i + k]:
            state = xxhash.xxh64_intdigest(w, state)
        found.add(state >> 1)
    return found


def slow_sketch(text, scale=8):
    every = hashes(text)
    return sorted(h for h in every if h < (1 << 63) // scale) or sorted(every)[:1]


def share(one, two):
    return len(one & two) / len(one | two) if one | two else 1.0


def slow_compare(rows):
    """Of documents told apart by id and text, in descending order of ids, NULL last."""
    def text_hash(t):
        value = xxhash.xxh64_intdigest(t.encode(), 42)
        return value - (1 << 64) if value >> 63 else value

    order = sorted({(i is None, -(i or 0), text_hash(t or ""), t or "") for i, t in rows})
    out = {}
    for at, key in enumerate(order):
        text, following = key[3], order[(at + 1) % len(order)][3]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = (set(slow_sketch(t)) for t in (text, edited, following))
        out[key] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), ",".join(map(str, sorted(a))), ",".join(map(str, sorted(b))), share(a, b), share(a, c))
    return sorted((repr(i), *out[i is None, -(i or 0), text_hash(t or ""), t or ""]) for i, t in rows)


def found(df):
    return sorted((repr(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
                  for r in sketch.compare_edits(df).collect())


def test_edits_equal_brute_force(spark):
    for df in (awkward(spark), spark.read.parquet(f"{SMALL}/documents.parquet")):
        assert found(df) == slow_compare([(r.doc_id, r.text) for r in df.collect()])


def test_few_rows_and_many_partitions(spark):
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    assert found(one) == slow_compare([(5, "a b c d e f")])
    assert found(one.limit(0)) == []
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(0, 40))) for i in range(90)]
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == slow_compare(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_sketches_merge(spark):
    rng = random.Random(4)
    rows = [(words(rng, rng.choice([0, 1, 3, 60, 400])), words(rng, rng.choice([0, 2, 50, 300]))) for _ in range(40)]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = sketch.sketch(F.col("a")), sketch.sketch(F.col("b"))
    for (one, two), r in zip(rows, df.select(sketch.merged(a, b).alias("m"), a.alias("a"), b.alias("b")).collect()):
        both = hashes(one) | hashes(two)
        assert r.a == slow_sketch(one) and r.b == slow_sketch(two)
        assert r.m == (sorted(h for h in both if h < (1 << 63) // 8) or sorted(both)[:1])


def test_containment_of_unequal_texts(spark):
    rng = random.Random(6)
    part = words(rng, 2_000, "abcdefghijklmnop")
    whole = words(rng, 9_000, "abcdefghijklmnop") + " " + part + " " + words(rng, 9_000, "abcdefghijklmnop")
    row = spark.createDataFrame([(part, whole)], "a string, b string").select(
        sketch.containment(sketch.sketch(F.col("a")), sketch.sketch(F.col("b"))).alias("c"),
        sketch.likeness(sketch.sketch(F.col("a")), sketch.sketch(F.col("b"))).alias("l")).first()
    assert row.c == pytest.approx(1.0, abs=0.02) and row.l == pytest.approx(0.1, abs=0.04)


def test_the_main_path_is_native(spark):
    plan = sketch.compare_edits(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
