"""SimHash groups, components, line runs and the id filter against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import SMALL, awkward, pairs, words
from pyspark.sql import functions as F

from riskloom.llm import components, line_dedup, member, simhash


def slow_fingerprint(text, k=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    tokens = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not tokens:
        return 0
    k = min(k, len(tokens))
    hashes = [xxhash.xxh64_intdigest(" ".join(tokens[i : i + k]).encode(), 42) for i in range(len(tokens) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(codes, distance):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_simhash_groups_equal_brute_force(spark):
    for df in (awkward(spark), spark.read.parquet(f"{SMALL}/documents.parquet")):
        rows = pairs(df)
        codes = [slow_fingerprint(t) for _, t in rows]
        group = slow_groups(codes, 4)
        least = defaultdict(lambda: None)
        for (i, _), g in zip(rows, group):
            if i is not None:
                least[g] = i if least[g] is None else min(i, least[g])
        want = Counter((i, f"{c:016x}", least[g]) for (i, _), c, g in zip(rows, codes, group))
        got = simhash.simhash_groups(df)
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == want
        again = simhash.simhash_groups(df, bucket_rows=3)  # crowded buckets are dealt again
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in again.collect()) == want


def test_one_row_of_each_group_stays(spark):
    df = awkward(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    groups = simhash.simhash_groups(df).select("group_code").distinct().count()
    rows = kept.collect()
    assert len(rows) == groups
    assert simhash.keep_one(df.limit(0)).collect() == []
    assert simhash.simhash_groups(df.limit(0)).collect() == []


@pytest.mark.parametrize("spread", [2, 30])
def test_index_finds_every_group(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)[:, None]
    flips = np.uint64(1) << rng.integers(0, 64, (40, spread, 3), dtype=np.uint64)
    codes = np.unique((centres ^ np.bitwise_xor.reduce(flips, axis=2)).ravel())
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    want = slow_groups([int(c) for c in codes], 4)
    got = simhash.links(codes, 4)
    # the same groups, whatever they are called
    assert len(set(want)) == len(set(got.tolist())) == len(set(zip(want, got.tolist())))


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(64, dtype=np.uint64) ^ (np.arange(64, dtype=np.uint64) >> np.uint64(1))
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (3, 4), (4, 3), (3, 4)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {3: 3, 4: 3}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_filter_never_misses_a_member(spark):
    members = spark.createDataFrame([(i,) for i in [*range(0, 3000, 7), None, -5]], "m long")
    asked = spark.createDataFrame([(i,) for i in [*range(3000), None, -5]], "a long")
    marked = member.with_candidates(asked, members, "m", F.col("a"), "maybe")
    assert marked.columns == ["a", "maybe"]
    found = {r.a for r in marked.where("maybe").collect()}
    assert {r.m for r in members.collect()} <= found and len(found) < 600


# ---- lines


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def summed(items, kind):
    """Items times an odd factor for each place, spread over all bits."""
    return mixed(sum(v * (mixed(((i + 1) * 0x9E3779B97F4A7C15 + kind) % 2**64) | 1) for i, v in enumerate(items)) % 2**64)


def word_hash(word):
    return summed([b + 1 for b in word], 1)


def slow_lines(text):
    """Stretches word by word: they end with a line, a sentence, or a word that its hash picks."""
    found = []
    for raw in text.split("\n"):
        held = []
        for word in re.findall(rb"[^\x20\x09-\x0D]+", raw.encode()):
            held.append(word)
            if word_hash(word) % 16 == 0 or word[-1] in b".!?":
                found.append(b" ".join(held))
                held = []
        if held:
            found.append(b" ".join(held))
    return found


def slow_prints(lines, gram_words, window_words):
    """``gram, at, lines`` of the grams that some window selects."""
    sizes = [line.count(b" ") + 1 for line in lines]

    def last(i, words):
        for e in range(i, len(lines)):
            words -= sizes[e]
            if words <= 0:
                return e
        return None

    value = {}
    for i in range(len(lines)):
        if (e := last(i, gram_words)) is not None:
            h = summed([summed([word_hash(w) for w in x.split()], 2) for x in lines[i : e + 1]], 3)
            value[i] = (h - (1 << 64) if h >> 63 else h, e)
    chosen = set()
    for i in range(len(lines)):
        if (end := last(i, window_words)) is not None:
            chosen.add(min((value[j][0], j) for j in range(i, len(lines)) if j in value and value[j][1] <= end)[1])
    return [(value[j][0], j, value[j][1] - j + 1) for j in sorted(chosen)]


def _hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def slow_cut(text, gone):
    """The text without some stretches, and how many lines lost any."""
    kept, at, touched = [], 0, 0
    for line in text.split("\n"):
        own = slow_lines(line)
        stays = [at + k not in gone for k in range(len(own))]
        at += len(own)
        if all(stays):
            kept.append(line)
            continue
        touched += 1
        if any(stays):
            rest, pieces = line.encode(), []
            for k, stretch in enumerate(own):
                here = re.match(rb"\s*" + rb"[\x20\x09-\x0D]+".join(map(re.escape, stretch.split())) + rb"[\x20\x09-\x0D]*", rest).group()
                lead = here[: len(here) - len(here.lstrip())]
                if k == 0:
                    pieces.append(lead)
                if stays[k]:
                    pieces.append(here[len(lead):])
                rest = rest[len(here):]
            left = b"".join(pieces[1:])
            kept.append((pieces[0] + (left if stays[-1] else left.rstrip())).decode())
    return "\n".join(kept), touched


def test_cutting_equals_brute_force(spark):
    rng = random.Random(8)
    texts = [t for _, t in pairs(awkward(spark))] + ["", "\n", "a\nb\nc", "a\n\nb", "  x. y  z! \n\n q\t r. s "]
    for text in texts:
        n = len(slow_lines(text))
        for _ in range(6):
            runs = [(a, min(n - 1, a + rng.randint(0, 4))) for a in rng.sample(range(n), min(n, rng.randint(0, 3)))]
            gone = {i for a, b in runs for i in range(a, b + 1)}
            assert line_dedup.cut_lines(text, runs) == slow_cut(text, gone)
        assert line_dedup.cut_lines(text, [(0, n - 1)] if n else []) == slow_cut(text, set(range(n)))


def planted(spark):
    rng = random.Random(3)
    passage = "\n".join(words(rng, 11) for _ in range(6))
    long_line = words(rng, 60)
    rows = []
    for i in range(60):
        own = [words(rng, rng.randint(1, 14)) for _ in range(rng.randint(0, 12))]
        if i % 3 == 0:
            own.insert(rng.randint(0, len(own)), passage)
        if i % 4 == 0:
            own.insert(rng.randint(0, len(own)), "  " + long_line + " ")
        if i % 5 == 0:
            own.insert(rng.randint(0, len(own)), "short common line\n")
        rows.append((i, "\n".join(own)))
    rows += [(100, rows[3][1]), (101, rows[3][1] + "\n" + rows[3][1]), (None, rows[9][1]), (50, rows[50][1])]
    return spark.createDataFrame(rows, "doc_id long, text string"), passage, long_line


def test_planted_passages_stay_once(spark):
    df, passage, long_line = planted(spark)
    cut = {r.doc_id: r for r in line_dedup.dedup_lines(df, count_as="n").collect()}
    assert sum(passage in r.text for r in cut.values()) == 1
    assert sum(long_line in r.text for r in cut.values()) == 1
    assert "short common line" in cut[10].text and cut[1].n == 0
    assert not slow_lines(cut[100].text)


def test_stretches_equal_brute_force(spark):
    for _, text in pairs(awkward(spark)) + pairs(spark.read.parquet(f"{SMALL}/documents.parquet")):
        assert line_dedup.worded_lines(text) == slow_lines(text)


def all_cuts(rows, window_words):
    """Lines inside a run of so many words that any earlier place holds, by comparing all pairs of places."""
    order = sorted({(i is None, i or 0, _hash(t), t) for i, t in rows})
    lines = [slow_lines(key[3]) for key in order]
    gone = defaultdict(set)
    for c, mine in enumerate(lines):
        for x, other in enumerate(lines[: c + 1]):
            for i in range(len(mine)):
                for j in range(i if x == c else len(other)):
                    n = 0
                    while i + n < len(mine) and j + n < len(other) and mine[i + n] == other[j + n]:
                        n += 1
                    if sum(len(line.split()) for line in mine[i : i + n]) >= window_words:
                        gone[order[c][:3]].update(range(i, i + n))
    return gone


def any_cuts(rows, gram_words, window_words):
    """Every place of a fingerprint against every earlier one, line by line, as far as a window's worth of lines."""
    order = sorted({(i is None, i or 0, _hash(t), t) for i, t in rows})
    lines = {key: slow_lines(key[3]) for key in order}
    places, gone = defaultdict(list), defaultdict(set)
    for key in order:
        for gram, at, n in slow_prints(lines[key], gram_words, window_words):
            places[gram].append((key, at, n))
    for held in places.values():
        for c, (key, at, n) in enumerate(held):
            for other, from_, _ in held[:c]:
                low, high, mine, its = 0, n, lines[key], lines[other]
                while at > low and from_ > low and mine[at - low - 1] == its[from_ - low - 1]:
                    low += 1
                while at + high < len(mine) and from_ + high < len(its) and mine[at + high] == its[from_ + high]:
                    high += 1
                gone[key[:3]].update(range(at - low, at + high))
    return gone


def found_runs(table, *sizes):
    got = defaultdict(set)
    for r in line_dedup.repeated_runs(table, *sizes).collect():
        got[r.doc_id is None, r.doc_id or 0, r.text_hash].update(range(r.first, r["last"] + 1))
    return got


def test_line_runs_equal_all_earlier_occurrences(spark):
    df, *_ = planted(spark)
    for table, sizes in ((df, (25, 50)), (df, (10, 20)), (awkward(spark), (25, 50)), (spark.read.parquet(f"{SMALL}/documents.parquet"), (25, 50))):
        # the records carry a window's worth of lines; what is further off is reached from other fingerprints
        assert found_runs(table, *sizes) == any_cuts(pairs(table), *sizes)


def test_matches_over_the_borders_of_partitions(spark):
    rng = random.Random(23)
    common = [words(rng, 12) for _ in range(9)]
    rows = []
    for i in range(150):  # one passage in all texts, whole or in part, between lines that a few texts share
        own = [words(random.Random(i % 7), 6), *common[: rng.randint(5, 9)], words(random.Random(i % 5), 9), words(rng, 4)]
        rows.append((i, "\n".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = any_cuts(rows, 25, 50)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for parts in (1, 3, 60):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            assert found_runs(df, 25, 50) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_runs_shared_with_any_earlier_text_go(spark):
    rng = random.Random(11)
    parts = [[words(rng, rng.randint(4, 35)) for _ in range(rng.randint(1, 4))] for _ in range(8)]
    rows = []
    for i in range(60):  # parts meet in ever other company, so the first text with a fingerprint rarely shares all
        own = [line for _ in range(rng.randint(1, 4)) for line in rng.choice(parts)] + [words(rng, 5)]
        rows.append((i, "\n".join(own)))
    got = found_runs(spark.createDataFrame(rows, "doc_id long, text string"), 25, 50)
    for key, want in all_cuts(rows, 50).items():
        assert want <= got[key]


def test_passages_inside_lines_go(spark):
    rng = random.Random(5)
    first, second = words(rng, 150), words(rng, 160)
    rows = [(i, f"{words(rng, 30)} {first} {words(rng, 20 + i)}\n{words(rng, 9)}") for i in range(4)]
    rows += [(i, f"  {words(rng, 40)}. {second}.  {words(rng, 7)} ") for i in range(4, 7)]
    cut = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), count_as="n").collect()}
    for i, text in rows:
        passage = first if i < 4 else second
        if i in (0, 4):
            assert cut[i].text == text and cut[i].n == 0
            continue
        before, behind = text.split(passage)
        left = cut[i].text
        # what is the text's own stays, and of the passage just the ends that share a stretch with it
        assert cut[i].n == 1 and left.startswith(before.rstrip()) and left.endswith(behind.split("\n")[-1].strip(".").lstrip())
        begin, at, ends = len(before.split()), 0, 0
        for stretch in slow_lines(text):
            n = len(stretch.split())
            if at < begin < at + n or at < begin + len(passage.split()) < at + n:
                ends += min(at + n, begin + len(passage.split())) - max(at, begin)
            at += n
        assert len(left.split()) - len(before.split()) - len(behind.strip(".").split()) <= ends < len(passage.split()) - 50
        assert all(w in left for w in behind.split()[1:])


def test_first_occurrence_of_every_line_stays(spark):
    df, *_ = planted(spark)
    before = {line for _, t in pairs(df) for line in slow_lines(t)}
    after = {line for r in line_dedup.dedup_lines(df).collect() for line in slow_lines(r.text)}
    assert before == after


def test_line_dedup_of_awkward_rows(spark):
    df = awkward(spark)
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == df.count()
    assert sum(r.text is None for r in out.collect()) == sum(r.text is None for r in df.collect())
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []
