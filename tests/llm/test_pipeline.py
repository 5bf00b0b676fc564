"""Every stage of the pipeline against a brute-force version of it, and the registration."""

from collections import Counter, defaultdict

import pytest
from helpers import SMALL
from test_near_duplicates import _hash, any_cuts, slow_cut, slow_fingerprint, slow_groups
from test_rules import slow_mix
from test_tokens import expected_code

import __spark_entry__ as entry_points
import corpus_pipeline
from riskloom.llm import mixing, toxicity
from riskloom.session import stage


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL))
        found.append(docs)
    return found


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "bpe_encoding"]
    assert all(df.dtypes == steps[0].dtypes for df in steps[:-1])


def test_stages_equal_brute_force(spark, steps):
    docs, clean, cut, single, mixed, coded = [df.collect() for df in steps]
    model = toxicity.train(steps[0], spark.read.parquet(f"{SMALL}/labels.parquet"))
    gone = {r.doc_id for r in toxicity.score(steps[0], model).collect() if r.predicted}
    assert {r.doc_id for r in clean} == {r.doc_id for r in docs} - gone and Counter(clean) <= Counter(docs)

    runs = any_cuts([(r.doc_id, r.text) for r in clean], 25, 50)
    want = {r.doc_id: slow_cut(r.text, runs.get((False, r.doc_id, _hash(r.text)), ()))[0] for r in clean}
    assert {r.doc_id: r.text for r in cut} == want and all(r.n_chars == len(r.text) for r in cut)

    groups = defaultdict(list)
    for r, g in zip(cut, slow_groups([slow_fingerprint(r.text) for r in cut], 4)):
        groups[g].append(r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(map(min, groups.values())) and Counter(single) <= Counter(cut)

    rows = [(r.doc_id, r.source, r.text) for r in single]
    assert Counter((r.doc_id, r.source, r.text) for r in mixed) == slow_mix(rows, mixing.Target(), mixing.BLOCK_DOCS)
    assert Counter(map(tuple, coded)) == Counter((r.doc_id, *expected_code(r.text)) for r in mixed)


def test_run_gives_the_last_stage(spark, steps):
    assert Counter(corpus_pipeline.run(spark, SMALL).collect()) == Counter(steps[-1].collect())


def test_one_query_for_each_operator():
    names = entry_points.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
