"""Merkle manifest of a table: a digest of every row, one root over all, and for each row a proof and its check.

Rows are leaves; the leaves of a group (a language, say) stand in the order of their ids and make a tree of their own, and the
groups' roots make the tree above them. Each level equijoins the nodes with themselves at computed sibling indices: a node goes to
its own index with the slot moved on by 1, 2, ... round its run of ``arity`` consecutive nodes (in a binary tree this is the index
XOR 1). The row in slot zero then has its run in order and emits the parent.

Paths to the root are handed down from the top, so each level is one equijoin of nodes with parents and no node is a hot key.
Digests travel as 32 bytes; hashing is over their lowercase hex. Indices come from a range partition by group and id, with the
counts of earlier partitions added, so a group with a third of all rows is many partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.session import stage

_BYTES = 32


def digest(text: Column) -> Column:
    """SHA-256 as bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def shown(packed: Column) -> Column:
    """Digests as they enter the next hash: lowercase hex, one behind the other."""
    return F.lower(F.hex(packed))


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields: each as ``-`` if NULL, else as its UTF-8 byte count, a colon and the value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, letters, letters.lower())


@dataclass(frozen=True)
class Tree:
    """The levels of one tree a group, from the leaves up, and for each level the groups that end there."""

    levels: list[DataFrame]  # group, index, size, digest, siblings, and on the lowest what was kept
    tops: list[DataFrame]  # group, digest
    keep: list[str]


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``index``, from 0 in each group by ``order``, and the ``size`` of the group; stored."""
    ordered = stage(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
    )
    # one row a partition, and one more for each group that begins inside one
    pieces = ordered.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(group)
    pieces = stage(pieces.select(
        group, "_part", "_first", F.sum("_n").over(whole).alias("size"),
        (F.sum("_n").over(whole.orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
    ))
    return stage(
        ordered.join(pieces, [group, "_part"]).withColumn("index", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_part", "_first", "_before")
    )


def with_siblings(nodes: DataFrame, arity: int, keep: list[str]) -> DataFrame:
    """``nodes (group, index, size, digest, ...)`` with ``siblings``: the digests of the run's other nodes, left to right."""
    slot = F.col("index") % arity
    base = F.col("index") - slot
    length = F.least(F.lit(arity).cast("long"), F.col("size") - base)
    # every node goes to the indices of its siblings; a run of one has none
    shifted = nodes.where(length > 1).select("group", "digest", slot.alias("slot"), base.alias("base"), length.alias("length")).select(
        "group", F.struct("slot", "digest").alias("sibling"),
        F.explode(F.transform(F.sequence(F.lit(1).cast("long"), F.col("length") - 1), lambda k: F.col("base") + (F.col("slot") + k) % F.col("length"))).alias("index"))
    # joined rows lie as the next grouping wants them, so it adds no shuffle
    own = ["group", "index", "size", "digest", *keep]
    met = nodes.select(*own).join(shifted, ["group", "index"], "left")
    found = met.groupBy("group", "index").agg(
        *[F.first(c).alias(c) for c in own[2:]], F.array_sort(F.collect_list("sibling")).alias("met"))
    return found.withColumn("siblings", F.unhex(F.array_join(F.transform("met", lambda s: F.hex(s["digest"])), ""))).drop("met")


def build(leaves: DataFrame, arity: int, keep: list[str]) -> Tree:
    """Trees over ``leaves (group, index, size, digest)`` and further columns ``keep`` that stay with the leaves."""
    if arity < 2:
        raise ValueError("a node needs two children at least")
    most = leaves.agg(F.max("size")).first()[0] or 0
    levels, tops = [], []
    nodes = leaves.select("group", "index", "size", "digest", *keep)
    while True:
        # a lone node is what remains of its group
        tops.append(nodes.where("size = 1").select("group", "digest", *(keep if not levels else [])))
        if most <= 1:
            return Tree(levels, tops, keep)
        level = stage(with_siblings(nodes.where("size > 1"), arity, keep if not levels else []))
        levels.append(level)
        # who is in slot zero has its run in order
        nodes = level.where(F.col("index") % arity == 0).select(
            "group", F.floor(F.col("index") / arity).cast("long").alias("index"), F.ceil(F.col("size") / arity).cast("long").alias("size"),
            digest(shown(F.concat("digest", "siblings"))).alias("digest"))
        most = -(-most // arity)


def paths(tree: Tree, arity: int, above: DataFrame) -> DataFrame:
    """The leaves (``digest`` and what was kept) with ``path``: siblings to the left and right, level by level to the root.

    ``above (group, subroot, path)`` is how it goes on from each group's top.
    """
    cut = (F.col("index") % arity).cast("int") * _BYTES
    here = F.struct(F.col("siblings").substr(F.lit(1), cut).alias("left"), F.col("siblings").substr(cut + 1, F.lit(arity * _BYTES)).alias("right"))
    found = None
    for i in range(len(tree.levels), -1, -1):
        kept = ["digest", *tree.keep] if i == 0 else []
        ended = tree.tops[i].join(above, "group").select("group", F.lit(0).cast("long").alias("index"), "subroot", "path", *kept)
        if i < len(tree.levels):
            level = tree.levels[i].withColumn("parent", F.floor(F.col("index") / arity).cast("long"))
            onward = found.select("group", F.col("index").alias("parent"), "subroot", F.col("path").alias("onward"))
            inner = level.join(onward, ["group", "parent"]).select(
                "group", "index", "subroot", F.concat(F.array(here), "onward").alias("path"), *kept)
            ended = ended.unionByName(inner)
        found = ended
    return found


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: shown(F.concat(step["left"], step["right"]))), ""), 256)


def fold(own: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path give."""
    return F.aggregate(path, own, lambda state, step: digest(shown(F.concat(step["left"], state, step["right"]))))


def manifest(
    docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", arity: int = 8, claimed: Column | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``fields`` are hashed in their order. ``claimed`` is the digest (see ``leaf``) of the row as someone else has it; where it is
    NULL the row's own is taken. It is folded with the siblings of the true tree, and ``verified`` says whether that gives the root.

    Groups stand in the UTF-8 order of their names, NULL first; leaves in that of their ids, NULL first, and of their digests where
    ids repeat. Equal rows are leaves of their own. Empty and very long texts are fields like any other; other columns are
    ignored whatever their names; an empty table has no leaf and gives an empty result.
    """
    named = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.when(named.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), named)).alias("group"),
        leaf(*[F.col(f"`{c}`") for c in fields]).alias("digest"),
        (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed"),
    )
    keep = ["doc_id", "claimed"]
    below = build(numbered(leaves, "group", "doc_id", "digest"), arity, keep)
    subroots = below.tops[0].select("group", "digest")
    for tops in below.tops[1:]:
        subroots = subroots.unionByName(tops)
    # the groups' roots are the leaves of one more tree
    upper = build(
        numbered(subroots.select(F.lit("").alias("all"), F.col("group").alias("name"), "digest"), "all", "name").withColumnRenamed("all", "group"),
        arity, ["name"])
    last = upper.tops[-1].select("digest").first()
    root = F.lit(bytes(last[0]) if last else b"")
    ends = F.array().cast("array<struct<left: binary, right: binary>>")
    top = docs.sparkSession.createDataFrame([("",)], "group string").select("group", F.lit(None).cast("binary").alias("subroot"), ends.alias("path"))
    above = paths(upper, arity, top).select(F.col("name").alias("group"), F.col("digest").alias("subroot"), "path")
    folded = fold(F.coalesce("claimed", "digest"), F.col("path"))
    return (
        paths(below, arity, stage(above)).withColumn("folded", folded)
        .select(
            "doc_id", shown(F.col("digest")).alias("leaf"), shown(F.col("subroot")).alias("subroot"), shown(root).alias("root"),
            proof_digest(F.col("path")).alias("proof_sha256"), shown(F.col("folded")).alias("folded_root"),
            (F.col("folded") == root).alias("verified"),
        )
    )
