"""Document fingerprints by a threshold-scaled sketch, with DataFrame functions only.

A text is the set of its shingles of a few words. Of their 63-bit hashes every one below a fixed fraction of the range is kept,
so a sketch grows with its text, and sketches of very unequal texts still compare: a shingle is kept in both or in neither.
Where no hash lies below the fraction the least one is kept, so that a text with a word never has an empty sketch.
Sketches merge: that of several texts together is the union of theirs, less what only stood in as a least hash.

``compare_edits`` puts this to use on a whole table. Only ids and lengths are ordered, to tell each document its next one;
the texts are then shuffled once, and of each text the beginning that the document before it takes over once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.session import stage

SHINGLE = 5
#: One in so many hashes is kept.
SCALE = 8
_SPACE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words between ASCII white space; an empty array if there are none."""
    bare = F.btrim(text, F.lit(_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """The kept hashes in ascending order. Fewer words than a shingle are one shingle; NULL is as empty."""
    own = words(F.coalesce(text, F.lit("")))

    def hashes(found: Column) -> Column:
        last = F.greatest(F.size(found) - (shingle - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(found, i, shingle)), 1))

    def kept(all_: Column) -> Column:
        low = F.filter(all_, lambda h: h < F.lit((1 << 63) // scale))
        return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).otherwise(F.array(F.array_min(all_)))

    # arrays of one, so that words and hashes are worked out once each
    none = F.array().cast("array<long>")
    return F.transform(F.array(own), lambda w: F.when(F.size(w) == 0, none).otherwise(
        F.element_at(F.transform(F.array(hashes(w)), kept), 1)))[0]


def merged(one: Column, two: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts together."""
    both = F.array_sort(F.array_union(one, two))
    low = F.filter(both, lambda h: h < F.lit((1 << 63) // scale))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(one: Column, two: Column) -> Column:
    """Estimated share of the shingles of both texts that they have in common; 1 if neither has any."""
    shared = F.size(F.array_intersect(one, two))
    every = F.size(one) + F.size(two) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def containment(one: Column, two: Column) -> Column:
    """Estimated share of the first text's shingles that the second has; 1 if the first has none."""
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, two)) / F.size(one))


def written(found: Column) -> Column:
    """A sketch as a string: its hashes in decimal, parted by commas."""
    return F.array_join(found.cast("array<string>"), ",")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``doc_id, sketch`` for every row; a NULL text has an empty sketch, repeated and NULL ids are taken row by row."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       sketch(F.col(f"`{text_col}`").cast("string"), shingle, scale).alias("sketch"))


def _neighbours(places: DataFrame) -> DataFrame:
    """For each place (nameless, id, text_hash, chars) the one before it in descending order, as ``for_*``; the first's is the last."""
    order = [F.col("nameless"), F.col("id").desc(), F.col("text_hash")]
    ordered = stage(
        places.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    )
    place = F.struct("nameless", "id", "text_hash", "chars")
    within = W.partitionBy("part").orderBy("at")
    # one row a partition
    ends = ordered.groupBy("part").agg(F.max_by(place, "at").alias("last"))
    round_ = W.orderBy("part")
    ends = stage(ends.select("part", F.coalesce(F.lag("last").over(round_), F.last("last").over(
        round_.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("before")))
    before = ordered.withColumn("own", F.lag(place).over(within)).join(ends, "part")
    taker = F.coalesce("own", "before")
    return before.select("nameless", "id", "text_hash", *[taker[c].alias(f"for_{c}") for c in ("nameless", "id", "text_hash", "chars")])


def compare_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, scale: int = SCALE, share: int = 3
) -> DataFrame:
    """Every row's fingerprint, and how it holds against an edit of the text and against the next document.

    The edit replaces the last ``1/share`` of the code points (rounded down) by as many from the beginning of the next document
    in descending order of ids (all, if it has fewer); the first document comes after the last. Columns: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, within_edited, within_next``; the last two are how much of the text
    is contained in the other.

    NULL texts are empty. NULL ids come last; texts of one id follow each other by their hashes; rows equal in id and text are one
    document, which comes back once a row. The next of an only document is itself. Other columns are ignored whatever their
    names; an empty table stays empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own_id = F.col(f"`{id_col}`").cast("long")
    key = ["nameless", "id", "text_hash"]
    keyed = docs.select(
        own_id.isNull().alias("nameless"), F.coalesce(own_id, F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("text_hash"),
        text.alias("text"))
    places = keyed.select(*key, F.length("text").alias("chars")).distinct()
    asked = stage(_neighbours(places))
    # the shuffle of texts and sketches is the same for both uses
    held = keyed.withColumn("sketch", sketch(F.col("text"), shingle, scale)).repartition(*key)
    given = (
        held.dropDuplicates(key).join(asked, key)
        .select(*[F.col(f"for_{c}").alias(c) for c in key],
                F.substring("text", F.lit(1), F.floor(F.col("for_chars") / share).cast("int")).alias("beginning"),
                F.col("sketch").alias("next_sketch"))
    )
    taken = F.floor(F.col("n_chars") / share).cast("int")
    edited = (
        held.join(given, key).withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - taken).cast("int")), "beginning"))
        .withColumn("edited_sketch", sketch(F.col("edited"), shingle, scale))
    )
    mine, its, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited.select(
        F.when(~F.col("nameless"), F.col("id")).alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(mine).alias("fingerprint"), written(its).alias("edited_fingerprint"),
        likeness(mine, its).alias("near_edited"), likeness(mine, following).alias("near_next"),
        containment(mine, its).alias("within_edited"), containment(mine, following).alias("within_next"),
    )
