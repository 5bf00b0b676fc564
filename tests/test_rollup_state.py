"""Rollup state: deliveries merged give what one rollup of all rows gives."""

import numpy as np
import pandas as pd
import pytest

from riskloom.operators.rollup import RollupSpec, rollup
from riskloom.operators.rollup_state import finish, load_state, merge_states, rollup_state, state_contract
from riskloom.operators.state import fit_levels, fit_modes

SPEC = RollupSpec(
    "k", "T",
    {"x": ["count", "mean", "sum", "var", "min", "max", "nunique"], "n": ["sum", "nunique", "max"], "s": ["nunique", "min"]},
    {"s": ["a", "b", "c"]}, {"s": "a"},
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    out = []
    for i in range(3000):
        key = None if i % 50 == 0 else (0 if i % 3 == 0 else int(rng.integers(1, 40)))  # one key holds a third
        x = None if rng.random() < 0.1 else float(rng.choice([0.0, -0.0, 1e9 + rng.normal(), 7.5]))
        out.append((i, key, x, None if rng.random() < 0.2 else int(rng.integers(0, 6)), rng.choice(["a", "b", "c", None])))
    out += [(3000, 77, None, None, None), (3001, 78, 2.0, 1, "b")]
    return spark.createDataFrame(out, "i int, k long, x double, n long, s string").cache()


def frame(df):
    got = df.toPandas().set_index("k").sort_index()
    return got.astype({c: float for c in got if c != "T_s_MIN"})


def same(got, want):
    assert got.columns == want.columns
    pd.testing.assert_frame_equal(frame(got), frame(want), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_merged_deliveries_equal_one_rollup(spark, rows, parts):
    states = [rollup_state(rows.where(f"i % {parts} = {p}"), SPEC) for p in range(parts)]
    same(finish(merge_states(states)), rollup(rows, SPEC))


def test_state_of_one_delivery(rows):
    same(finish(rollup_state(rows, SPEC)), rollup(rows, SPEC))


def test_order_and_grouping_of_merges_do_not_matter(rows):
    a, b, c = (rollup_state(rows.where(f"i % 3 = {p}"), SPEC) for p in range(3))
    same(finish(merge_states([merge_states([c, a]), b])), finish(merge_states([a, merge_states([b, c])])))


def test_variance_far_from_zero_does_not_cancel(spark):
    df = spark.createDataFrame([(i, 1, 1e9 + (i % 4)) for i in range(400)], "i int, k int, x double")
    spec = RollupSpec("k", "T", {"x": ["var"]})
    merged = merge_states([rollup_state(df.where(f"i % 7 = {p}"), spec) for p in range(7)])
    # doubles near 1e9 lie 1.2e-7 apart, and so may a mean be off; a difference of sums of squares would be off by hundreds
    assert finish(merged).first()["T_x_VAR"] == pytest.approx(np.var([i % 4 for i in range(400)], ddof=1), rel=1.2e-7)


def test_saved_state_is_read_back(spark, rows, tmp_path):
    rollup_state(rows.where("i < 1000"), SPEC).save(str(tmp_path / "day1"))
    day1 = load_state(spark, str(tmp_path / "day1"), SPEC)
    merged = merge_states([day1, rollup_state(rows.where("i >= 1000"), SPEC)])
    merged.save(str(tmp_path / "day2"))
    same(finish(load_state(spark, str(tmp_path / "day2"), SPEC)), rollup(rows, SPEC))
    with pytest.raises(FileNotFoundError):
        load_state(spark, str(tmp_path / "none"), SPEC)


def test_contract_grows_with_the_deliveries(spark, rows):
    more = spark.createDataFrame([(9000 + i, 5, 1.0, 1, "new") for i in range(5000)], "i int, k long, x double, n long, s string")
    both = rows.unionByName(more)
    merged = merge_states([rollup_state(rows, SPEC), rollup_state(more, SPEC)])
    spec = state_contract(merged)
    keyed = both.where("k IS NOT NULL")
    assert spec.levels == fit_levels(keyed, ["s"], 10) and spec.fills == fit_modes(keyed, ["s"])
    same(finish(merged, spec), rollup(both, spec))
    with pytest.raises(ValueError):
        state_contract(merged, max_levels=2)


def test_empty_delivery_and_other_rollups(rows):
    whole = rollup_state(rows, SPEC)
    same(finish(merge_states([whole, rollup_state(rows.limit(0), SPEC)])), rollup(rows, SPEC))
    assert finish(rollup_state(rows.limit(0), SPEC)).count() == 0
    other = rollup_state(rows, RollupSpec("k", "T", {"x": ["sum"]}))
    with pytest.raises(ValueError):
        merge_states([whole, other])
    with pytest.raises(ValueError):
        finish(other, SPEC)
    with pytest.raises(ValueError):
        merge_states([])


def test_only_levels(rows):
    spec = RollupSpec("k", "", {}, {"s": ["a", "b"]}, {"s": "b"})
    got = finish(merge_states([rollup_state(rows.where("i < 100"), spec), rollup_state(rows.where("i >= 100"), spec)]))
    same(got, rollup(rows, spec))
