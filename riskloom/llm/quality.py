"""Quality rules by divergence from language references.

Every document gives counts (words, symbols, repeated lines and words) and two histograms: of character classes, and
of the common words of its language. The references are the sums of these histograms over all documents of a language
that pass the plain rules; a document is dropped if its histograms are too far from them in Jensen-Shannon distance.
Texts are read once; everything after that works on one narrow row per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.arrow import batches_of, text_columns
from riskloom.session import stage

#: Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on are as with be by this at from or an have not which but they his he "
          "has were their been had will would its can all more",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
          "dass sie nach wird bei einer um am sind noch wie einem über",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la avec ou son "
          "mais comme on lui nous cette aux ses elle entre",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ha me o si sin "
          "sobre este ya entre cuando todo esta ser son",
}
_BINS = 1 + max(len(set(w.split())) for w in COMMON_WORDS.values())

#: Classes of characters, by their bytes in UTF-8; all others are left out.
_CLASSES = (
    bytes(range(0x61, 0x7B)),  # small letters
    bytes(range(0x41, 0x5B)),  # capitals
    bytes(range(0x30, 0x3A)),  # digits
    b".,;:",
    b"!?",
    b"'\"()-",
    b"#$%&*@",
    b"|<>[\\]^_`{}~+=/",
    bytes(range(0xC2, 0xF5)),  # one for each character beyond ASCII
)
_SPACES, _SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
_STRIPPED = bytes(b for b in range(128) if not chr(b).isalnum())

#: Largest distances that pass, and the least words for which a distance is trusted.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.17, 0.42
MIN_WORDS = 50
#: So many references are broadcast, under 4 MB; more, as of a column that holds no languages, are joined by shuffles.
MOST_LANGUAGES = 5000
#: Histograms of few words stray further by chance: the allowance grows by this over the root of the words.
MORE_FOR_SHORT = 2.0


def _bin_of() -> dict[str, dict[bytes, int]]:
    return {lang: {w.encode(): i + 1 for i, w in enumerate(dict.fromkeys(words.split()))} for lang, words in COMMON_WORDS.items()}


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in windows of ``width`` words which the text holds twice or more."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    key = ids[: n - width + 1]
    for shift in range(1, width):
        key = key * (len(number) + 1) + ids[shift : n - width + 1 + shift]
        if shift + 1 < width:  # keep the key small, however long the text
            key = np.unique(key, return_inverse=True)[1]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(n, bool)
    for shift in range(width):
        covered[shift : n - width + 1 + shift] |= twice
    return int(covered.sum())


def measure(text: str, bin_of: dict[bytes, int]) -> tuple:
    """Words, their code points, symbols, repeated lines and words, and both histograms."""
    raw = text.encode("utf-8")
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    worded = [line for line in raw.split(b"\n") if line.strip()]
    common = [0] * _BINS
    if words:
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        for w, n in counts.items():
            common[bin_of.get(w.lower().strip(_STRIPPED), 0)] += n
    return (
        len(words),
        len(text) - int(by_byte[list(_SPACES)].sum()),
        int(by_byte[list(_SYMBOLS)].sum()),
        len(worded) - len(set(worded)),
        repeated_words(words),
        [int(by_byte[list(c)].sum()) for c in _CLASSES],
        common,
    )


def _share(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(counts, lambda x: F.coalesce(x / F.nullif(total, F.lit(0.0)), F.lit(0.0)))


def jensen_shannon(one: Column, two: Column) -> Column:
    """Distance of two histograms, 0 to 1: the root of the divergence in bits. Empty ones are at distance 0."""
    def term(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / F.nullif(middle, F.lit(0.0)))).otherwise(F.lit(0.0))

    parts = F.zip_with(_share(one), _share(two), lambda p, q: (term(p, q) + term(q, p)) / 2)
    some = (F.aggregate(one, F.lit(0.0), lambda s, x: s + x) > 0) & (F.aggregate(two, F.lit(0.0), lambda s, x: s + x) > 0)
    return F.when(some, F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)))).otherwise(F.lit(0.0))


def _far() -> Column:
    allowed = F.lit(1.0) + F.lit(MORE_FOR_SHORT) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    return (F.col("n_words") >= MIN_WORDS) & (
        (F.col("class_distance") > MAX_CLASS_DISTANCE * allowed) | (F.col("word_distance") > MAX_WORD_DISTANCE * allowed))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance, kept`` for every row.

    NULL texts count as empty and fail the plain rules, as all texts under 50 words do. NULL is a language of its
    own; a language without a list of common words is judged by character classes alone, and one of which no
    document passes the plain rules has no reference, so its documents are judged by those rules alone.
    Repeated and NULL ids are judged row by row; an empty table gives an empty table.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _bin_of()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")))
            yield from batches_of(
                {"doc_id": pa.int64(), "lang": pa.string()}
                | dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), pa.int64())
                | dict.fromkeys(("classes", "common"), pa.list_(pa.int64())),
                ((doc_id, lang, *measure(text, bins.get(lang, {}))) for doc_id, lang, text in rows))

    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang")
    measured = stage(text_columns(docs, id_col, text_col, lang).mapInArrow(
        scan, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, classes array<long>, common array<long>"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)

    def compared(trusted: DataFrame) -> DataFrame:
        references = stage(trusted.groupBy("lang").agg(
            F.array(*[F.sum(F.col("classes")[i]) for i in range(len(_CLASSES))]).alias("ref_classes"),
            F.array(*[F.sum(F.col("common")[i]) for i in range(_BINS)]).alias("ref_common"),
        ))
        # a few numbers a language; a join by so few keys would deal all rows to as many tasks
        if references.count() <= MOST_LANGUAGES:
            references = F.broadcast(references)
        return measured.join(references, "lang", "left").withColumns({
            "class_distance": F.coalesce(jensen_shannon(F.col("classes"), F.col("ref_classes")), F.lit(0.0)),
            "word_distance": F.coalesce(jensen_shannon(F.col("common"), F.col("ref_common")), F.lit(0.0)),
        })

    # the first references still hold odd documents; the second are made of what the first let pass
    told = compared(compared(measured.where(~failed)).where(~failed & ~_far()))
    far = _far()
    return told.withColumn("kept", ~F.col("base_failed") & ~far).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "word_distance", "kept")
