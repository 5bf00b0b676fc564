"""Mixing of sources to target weights by temperature, with DataFrame functions only.

Token shares of the sources are raised to an exponent and normalised. The exponent, 1 for the natural mixture and 0 for
equal weights, is bisected down until the weights have the wanted entropy, unless the natural mixture has it, and
raised again if a source would be repeated more than allowed. A source's weight of the token
budget is then spent as whole passes over it and a last pass over its blocks in a permuted order: whole blocks as far as
they fit, and of the block where the budget ends its documents in a permuted order up to it.

Documents are dealt into blocks of bounded size by a hash, so a source with a third of all documents is many
blocks: totals are made per block, running sums over blocks, and only one block per source is ever ordered by document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.session import stage

#: Documents of a block, on average.
BLOCK_DOCS = 4096
_CUTS, _ROUNDS = 16, 8


@dataclass(frozen=True)
class Target:
    """What the weights should be like; ``entropy`` is a share of the largest one, ln(sources)."""

    entropy: float | None = 0.97
    max_repeats: float | None = 4.0
    budget_tokens: int | None = None  # as many as the table holds


def word_count(text: Column) -> Column:
    """Words between ASCII white space; they stand for tokens here."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def digest_number(*parts: Column) -> Column:
    """A number below 2**28 from an MD5 digest: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 7), 16, 10).cast("long")


def find_exponent(totals: DataFrame, target: Target, budget: int) -> float:
    """The exponent for sources with ``tokens`` each. Every step is one aggregate that halves the interval four times."""
    n, whole, least = totals.agg(F.count(F.lit(1)), F.sum("tokens"), F.min("tokens")).first()
    if not n:
        return 1.0
    share = F.col("tokens") / F.lit(float(whole))

    def measured(exponents: list[float]) -> list[tuple[float, float]]:
        """Entropy and repeats of the most repeated source, for each exponent."""
        columns = []
        for a in exponents:
            power = F.pow(share, F.lit(a))
            columns += [F.sum(power), F.sum(power * F.log(share))]
        row = totals.agg(*columns).first()
        found = []
        for i, a in enumerate(exponents):
            z, s = row[2 * i], row[2 * i + 1]
            most = (least / whole) ** (a - 1) / z * budget / whole  # the smallest source is repeated most
            found.append((math.log(z) - a * s / z, most))
        return found

    def bisect(low: float, high: float, too_low) -> float:
        for _ in range(_ROUNDS):
            inner = [low + (high - low) * i / _CUTS for i in range(1, _CUTS)]
            below = [x for x, m in zip(inner, measured(inner)) if too_low(*m)]
            low, high = (below[-1] if below else low), (inner[len(below)] if len(below) < len(inner) else high)
        return round((low + high) / 2, 6)

    exponent = 1.0
    if target.entropy is not None and n > 1:
        wanted = target.entropy * math.log(n)
        if measured([1.0])[0][0] < wanted:
            exponent = bisect(0.0, 1.0, lambda entropy, _: entropy > wanted)
    if target.max_repeats is not None and exponent < 1:
        if budget > target.max_repeats * whole:
            raise ValueError(f"{budget} tokens are more than {target.max_repeats} passes over all sources")
        if measured([exponent])[0][1] > target.max_repeats:
            exponent = bisect(exponent, 1.0, lambda _, most: most > target.max_repeats)
    return exponent


def source_weights(totals: DataFrame, target: Target) -> DataFrame:
    """``source, tokens, docs, weight, budget`` for every source with tokens; ``budget`` in whole tokens."""
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = whole if target.budget_tokens is None else target.budget_tokens
    exponent = find_exponent(totals, target, budget)
    power = F.pow(F.col("tokens") / F.lit(float(whole or 1)), F.lit(exponent))
    norm = totals.agg(F.sum(power)).first()[0] or 1.0
    return totals.withColumn("weight", power / F.lit(norm)).withColumn("budget", F.round(F.col("weight") * F.lit(budget)).cast("long"))


def draw(sized: DataFrame, target: Target = Target(), seed: int = 1, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``sized (name, source, tokens)`` with ``passes``: how often each row is used; rows used never are left out.

    ``name`` must tell rows apart. Sources without a token have no weight.
    """
    totals = stage(sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).where("tokens > 0"))
    plan = stage(
        source_weights(totals, target)
        .withColumn("whole", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
        .withColumn("blocks", F.ceil(F.col("docs") / F.lit(float(block_docs))).cast("long"))
        .select("source", "whole", "rest", "blocks")
    )
    # one row a source; the engine broadcasts it only if it is small, and splits a hot source otherwise
    dealt = sized.join(plan, "source").withColumn("block", digest_number(F.lit(str(seed)), F.lit("block"), F.col("name")) % F.col("blocks"))
    totals_by_block = dealt.groupBy("source", "rest", "block").agg(F.sum("tokens").alias("size"))
    order = W.partitionBy("source").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), "source", F.col("block").cast("string"))), "block")
    begins = totals_by_block.select(
        "source", "block", "size",
        (F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("begin"),
    )
    placed = dealt.join(begins, ["source", "block"])
    ends = (F.col("begin") < F.col("rest")) & (F.col("begin") + F.col("size") > F.col("rest"))
    within = W.partitionBy("source", "block").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("row"), "name")), "name")
    whole_blocks = placed.where(~ends).select("name", "source", "tokens", (F.col("whole") + (F.col("begin") < F.col("rest")).cast("long")).alias("passes"))
    cut_blocks = placed.where(ends).withColumn(
        "before", F.col("begin") + F.sum("tokens").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("tokens")
    ).select("name", "source", "tokens", (F.col("whole") + (F.col("before") < F.col("rest")).cast("long")).alias("passes"))
    return whole_blocks.unionByName(cut_blocks).where("passes > 0")


def mix(
    docs: DataFrame, target: Target = Target(), seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", block_docs: int = BLOCK_DOCS, pass_as: str | None = None,
    tokens_as: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` as the mixture uses them: a row comes once for every pass that holds it.

    ``pass_as`` and ``tokens_as`` name columns to add: the number of the pass, from 0, and the row's tokens. A NULL source is a source of its own,
    as is the empty string; NULL and wordless texts have no tokens, go with whatever block they are dealt
    to, and a source of only such texts is left out. Rows with a NULL id are told apart by their text; rows equal in
    id, source and text share one decision and count once each. A budget ends with the document that reaches it.
    Other columns are kept whatever their names; an empty table stays empty.
    """
    names = docs.columns
    # plain inner names, so that no column of the table can clash and unused ones are never shuffled
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, source = (F.col(f"c{names.index(c)}").cast("string") for c in (id_col, source_col))
    text = F.col(f"c{names.index(text_col)}").cast("string")
    inner = inner.withColumns({
        # the id and the text make the name; a mark keeps NULL apart from any source name
        "name": F.concat_ws(":", F.coalesce(doc_id, F.lit("")), F.md5(text)),
        "source": F.concat(F.when(source.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(source, F.lit(""))),
    })
    sized = stage(
        inner.select("name", "source", word_count(text).alias("tokens"))
        .groupBy("name", "source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    )
    drawn = draw(sized, target, seed, block_docs).join(sized.select("name", "source", "rows"), ["name", "source"])
    used = inner.join(drawn, ["name", "source"]).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    out = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    more = [F.col("pass").alias(pass_as)] if pass_as else []
    if tokens_as:
        more.append((F.col("tokens") / F.col("rows")).cast("long").alias(tokens_as))
    return used.select(*out, *more)
