"""Secret scans with corpus-wide ownership frequency.

Each text is scanned once for three fixed kinds of secrets and for further candidates: values of known issuers, key
blocks, and high-entropy strings. The values travel as hashes only. For each hash the distinct repositories and owners
that hold it are counted over the whole corpus: a value that many owners hold is an example that people copy, one
that fewer owners hold and that looks random is theirs. Further candidates become spans if they look live;
the fixed kinds are always spans and are labelled the same way.

Counts are made by two aggregations that combine before they shuffle, so one value in a third of all texts costs a
row per task and owner; the labels come back by a join whose skewed keys the engine splits.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.arrow import batches_of, text_columns
from riskloom.session import stage

#: Values held by this many owners are examples, in however many repositories of fewer owners they are.
EXAMPLE_OWNERS = 3
#: Bits a character that a value must have at least to look random.
LIVE_ENTROPY = 3.0

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_MORE = (
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    ("google", re.compile(r"AIza[A-Za-z0-9_-]{35}")),
    ("stripe", re.compile(r"[sr]k_live_[A-Za-z0-9]{16,}")),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("key", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")),
    ("random", re.compile(r"[A-Za-z0-9+_-]{20,}")),
)
#: The order of kinds that begin at one place.
KINDS = ("assign", "access", "hex", *(kind for kind, _ in _MORE))


def entropy(value: str) -> float:
    """Bits a character by the value's own frequencies."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``kind, start, end, value`` of the fixed kinds; leftmost and not overlapping within a kind."""
    found = [("assign", *m.span(), m.group(2)) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", *m.span(), m.group()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span(), m.group()) for m in _HEX.finditer(text)]
    return found


def _covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover, in order and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def more_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Further candidates that do not touch a span that is there already."""
    found: list[tuple[str, int, int, str]] = []
    held = [(s, e) for _, s, e, _ in taken]
    for kind, pattern in _MORE:
        starts, ends = _covered(held)
        for m in pattern.finditer(text):
            value = m.group()
            if kind == "random" and not (re.search(r"[0-9]", value) and re.search(r"[a-z]", value) and re.search(r"[A-Z]", value)):
                continue
            # of what begins before the match ends, the last one reaches furthest
            before = bisect_left(starts, m.end())
            if not before or ends[before - 1] <= m.start():
                found.append((kind, *m.span(), value))
                held.append(m.span())
    return found


def in_order(spans: list[tuple]) -> list[tuple]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    repository: Column | None = None, owner: Column | None = None,
) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, labels, n_live, n_example, repositories`` for every
    row.

    ``spans`` lists ``kind:start:end`` in code points, by start, then kind; ``labels`` says of each span in that order
    whether its value is ``live``, an ``example`` or ``unclear`` (held by few owners, but not random), and ``repositories`` in
    how many repositories it is, which decides nothing. By default a document
    is a repository of its own and ``source`` its owner; a NULL owner is one owner. NULL texts count as empty; rows with
    a NULL or repeated id are kept one by one; other columns are ignored; an empty table gives an empty table.
    """
    if owner is None:
        owner = F.col("source") if "source" in docs.columns else F.lit("")
    if repository is None:
        repository = F.col(f"`{id_col}`")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batches_of({
                "doc_id": pa.int64(), "repository": pa.string(), "owner": pa.string(),
                "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(),
                "found": pa.list_(_FOUND),
            }, (_scanned(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "repository", "owner", "text")))))

    # one narrow row per text, with a number of its own that later joins can rely on
    scanned = stage(
        text_columns(docs, id_col, text_col,
                     F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
                     F.coalesce(owner.cast("string"), F.lit("")).alias("owner"))
        .mapInArrow(scan, "doc_id long, repository string, owner string, n_assign long, n_access long, n_hex long, "
                    "base_sha256 string, found array<struct<kind:string,start:int,end:int,hash:string,random:boolean>>")
        .withColumn("row", F.monotonically_increasing_id())
    )
    held = scanned.where(F.size("found") > 0).select("row", "repository", "owner", F.posexplode("found").alias("place", "f"))
    # stored, so that the join shuffles both sides and the engine can split a value that a third of all texts hold
    holders = stage(
        held.groupBy(F.col("f.hash").alias("hash"), "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    )
    example = F.col("owners") >= EXAMPLE_OWNERS
    label = F.when(example, "example").when(F.col("random"), "live").otherwise("unclear")
    labelled = (
        held.select("row", "place", F.col("f.hash").alias("hash"), F.col("f.random").alias("random"),
                    F.col("f.kind").alias("kind"), F.col("f.start").alias("start"), F.col("f.end").alias("end"))
        .join(holders, "hash").withColumn("label", label)
        .where(F.col("kind").isin("assign", "access", "hex") | (F.col("label") == "live"))
        .groupBy("row").agg(
            F.sort_array(F.collect_list(F.struct("place", "kind", "start", "end", "label", "repositories"))).alias("s"),
            F.sum((F.col("label") == "live").cast("long")).alias("n_live"),
            F.sum((F.col("label") == "example").cast("long")).alias("n_example"))
    )
    span = F.transform("s", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return scanned.drop("found", "owner", "repository").join(labelled, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(F.array_join(span, ","), F.lit("")).alias("spans"),
        F.coalesce(F.array_join(F.transform("s", lambda x: x["label"]), ","), F.lit("")).alias("labels"),
        F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
        F.coalesce("n_example", F.lit(0).cast("long")).alias("n_example"),
        F.coalesce(F.array_join(F.transform("s", lambda x: x["repositories"].cast("string")), ","), F.lit("")).alias("repositories"),
    )


_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string()), ("random", pa.bool_())])


def _scanned(doc_id: int | None, repository: str, owner: str, text: str) -> tuple:
    base = in_order(base_spans(text))
    counts = Counter(kind for kind, *_ in base)
    found = [
        {"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode("utf-8")).hexdigest()[:32], "random": entropy(v) >= LIVE_ENTROPY}
        for k, s, e, v in in_order(base + more_spans(text, base))
    ]
    return (doc_id, repository, owner, counts["assign"], counts["access"], counts["hex"],
            hashlib.sha256(written(base).encode()).hexdigest(), found)
