"""The Merkle manifest against a tree built row by row."""

import hashlib
import zlib
from collections import Counter

import pytest
from helpers import SMALL, awkward
from pyspark.sql import functions as F

from riskloom.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text=...):
    values = [row[c] if c != "text" or text is ... else text for c in FIELDS]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(leaves, arity):
    """The root, and for each leaf the siblings to its left and right on each level."""
    paths = [[] for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        upper = []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for k, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
            upper.append((h("".join(d for d, _ in run)), [i for _, below in run for i in below]))
        nodes = upper
    return nodes[0][0], paths


def slow_manifest(rows, arity, tamper):
    groups = {}
    for row in rows:
        groups.setdefault((row["lang"] is not None, (row["lang"] or "").encode()), []).append(row)
    names = sorted(groups)
    done = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        done.append((own, *climb([leaf(r) for r in own], arity)))
    root, above = climb([sub for _, sub, _ in done], arity)
    out = Counter()
    for (own, sub, paths), top in zip(done, above):
        for row, path in zip(own, paths):
            changed = tamper(row)
            state = leaf(row) if changed is None else changed
            for left, right in path + top:
                state = h(left + state + right)
            proof = h("".join(left + right for left, right in path + top))
            out[row["doc_id"], leaf(row), sub, root, proof, state, state == root] += 1
    return out


def tampered(row):
    if row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 3:
        return None
    return leaf(row, lowered(row["text"]))


def found(df, arity=8):
    fields = {c: F.col(c) for c in FIELDS}
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                     merkle.leaf(*{**fields, "text": merkle.lower_ascii(F.col("text"))}.values()))
    return Counter(map(tuple, merkle.manifest(df, FIELDS, arity=arity, claimed=claimed).collect()))


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_awkward_rows_equal_brute_force(spark, arity):
    df = awkward(spark).withColumn("lang", F.when(F.col("doc_id") == 8, "").when(F.col("doc_id") == 9, "é").otherwise(F.col("lang")))
    rows = df.collect()
    got = found(df, arity)
    assert got == slow_manifest(rows, arity, tampered) and sum(got.values()) == len(rows)


def test_given_documents_equal_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = found(df)
    assert got == slow_manifest(df.collect(), 8, tampered)
    # lower-casing shows wherever there was something to lower
    for row in df.collect():
        changed = tampered(row) not in (None, leaf(row))
        assert all(verified != changed for doc_id, *_, verified in got if doc_id == row["doc_id"])


def test_many_partitions_and_one_hot_group(spark):
    df = spark.range(700).selectExpr("id AS doc_id", "'s' AS source", "IF(id % 97 = 0, concat('g', id), 'hot') AS lang", "id AS n_chars", "concat('T', id) AS text")
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert found(df.repartition(5)) == slow_manifest(df.collect(), 8, tampered)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_row_none_and_other_fields(spark):
    df = awkward(spark)
    assert merkle.manifest(df.limit(0), FIELDS).collect() == []
    (one,) = merkle.manifest(df.where("doc_id = 3"), ["text"]).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root == h("3:one") and one.verified
    assert one.proof_sha256 == h("")
    with pytest.raises(ValueError):
        merkle.manifest(df, FIELDS, arity=1)
