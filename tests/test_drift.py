import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.scalars import normalise_missing
from riskloom.operators import drift


def frame(spark, **columns):
    data = pd.DataFrame({n: pd.Series(v, dtype=float) for n, v in columns.items()})
    return normalise_missing(spark.createDataFrame(data)).repartition(4)


def psi_by_hand(ref, cur, bins=10, eps=1e-6):
    edges = np.histogram(ref, bins=bins)[1]
    edges[0], edges[-1] = -np.inf, np.inf
    r = (np.histogram(ref, edges)[0] + eps) / (len(ref) + eps * bins)
    c = (np.histogram(cur, edges)[0] + eps) / (len(cur) + eps * bins)
    return ((c - r) * np.log(c / r)).sum()


def cdf_gap(ref, cur):
    at = np.unique(np.concatenate([ref, cur]))
    gap = np.abs(np.searchsorted(np.sort(ref), at, "right") / len(ref) - np.searchsorted(np.sort(cur), at, "right") / len(cur))
    return gap.max(), (gap[:-1] * np.diff(at)).sum()


@pytest.fixture(scope="module")
def sides():
    rng = np.random.default_rng(2)
    ref = {"a": rng.normal(size=2000), "b": rng.integers(0, 5, 2000).astype(float), "c": np.full(2000, 4.0)}
    cur = {"a": rng.normal(0.4, 1.2, 900), "b": rng.integers(0, 6, 900).astype(float), "c": np.full(900, 4.0)}
    return ref, cur


def test_report_matches_definitions(spark, sides):
    ref, cur = sides
    rows = {r["feature"]: r for r in drift.drift_report(frame(spark, **ref), frame(spark, **cur), ["a", "b", "c"]).collect()}
    for f in ("a", "b"):
        ks, w1 = cdf_gap(ref[f], cur[f])
        assert rows[f]["psi"] == pytest.approx(psi_by_hand(ref[f], cur[f]))
        assert rows[f]["ks_statistic"] == pytest.approx(ks)
        assert rows[f]["wasserstein_distance"] == pytest.approx(w1)
    assert rows["c"]["psi"] == pytest.approx(psi_by_hand(ref["c"], cur["c"])) and rows["c"]["psi_status"] == "stable"
    assert (rows["c"]["ks_statistic"], rows["c"]["wasserstein_distance"]) == (0, 0)
    assert (rows["a"]["reference_n"], rows["a"]["current_n"]) == (2000, 900)
    assert rows["a"]["ks_significant"] and not rows["c"]["ks_significant"]


def test_identity_shift_and_symmetry(spark, sides):
    a = sides[0]["a"]
    same = drift.drift_report(frame(spark, x=a), frame(spark, x=a), ["x"]).first()
    assert (same["psi"], same["ks_statistic"], same["wasserstein_distance"]) == pytest.approx((0, 0, 0))
    assert same["ks_p_value_asymptotic"] == 1.0
    moved = drift.two_sample_distances(frame(spark, x=a), frame(spark, x=a + 2.5), ["x"]).first()
    assert moved["wasserstein_distance"] == pytest.approx(2.5)
    back = drift.two_sample_distances(frame(spark, x=a + 2.5), frame(spark, x=a), ["x"]).first()
    assert moved["ks_statistic"] == back["ks_statistic"]


def test_empty_and_tiny_sides(spark):
    ref = frame(spark, x=[1, 2, None], y=[None, None, None])
    cur = frame(spark, x=[3, None, None], y=[1, 2, 3])
    rows = {r["feature"]: r for r in drift.drift_report(ref, cur, ["x", "y"]).collect()}
    assert rows["y"]["psi"] is None and rows["y"]["psi_status"] == "insufficient_data"
    assert rows["y"]["ks_statistic"] is None and rows["y"]["wasserstein_distance"] is None
    # one current value: no KS test, but a distance
    assert rows["x"]["ks_statistic"] is None and not rows["x"]["ks_significant"]
    assert rows["x"]["wasserstein_distance"] == pytest.approx(1.5)


def test_skipped_and_absent_features(spark):
    ref = spark.createDataFrame([("u", 1.0, 2.0), ("v", 2.0, 3.0)], "s string, x double, only_ref double")
    cur = spark.createDataFrame([("u", 1.0)], "s string, x double")
    rows = {r["feature"]: r["psi_status"] for r in drift.drift_report(ref, cur, ["s", "x", "only_ref"]).collect()}
    assert set(rows) == {"s", "x"} and rows["s"] == "skipped_non_numeric"


def test_p_value_series(spark):
    xs = [0.01, 0.3, 0.7, 0.999999, 1.0, 1.36, 2.0, 6.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(drift.kolmogorov_tail(F.col("x"))).collect()]
    k = np.arange(1, 200)
    want = [1.0 if x < 0.1 else float(np.clip(2 * ((-1.0) ** (k - 1) * np.exp(-2 * k**2 * x**2)).sum(), 0, 1)) for x in xs]
    np.testing.assert_allclose(got, want, atol=1e-9)


def paths_that_meet(n, m, least):
    """Orders of two samples whose largest gap times n m is at least ``least``, counted one by one in whole numbers."""
    inside = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * m - j * n) < least:
                before = (inside[i - 1][j] if i else 0) + (inside[i][j - 1] if j else 0)
                inside[i][j] = before if i or j else 1
    return math.comb(n + m, n) - inside[n][m]


def test_exact_p_values_equal_a_direct_count():
    for n in range(1, 31):
        for m in range(1, 31):
            gaps = {abs(i * m - j * n) for i in range(n + 1) for j in range(m + 1)}
            for least in sorted(gaps)[:: max(1, len(gaps) // 6)] + [n * m]:
                want = paths_that_meet(n, m, least) / math.comb(n + m, n)
                assert drift.exact_tail(least / (n * m), n, m) == pytest.approx(want, rel=1e-9, abs=1e-300)


def test_exact_p_values_near_the_limit_distribution(spark):
    n = 5000
    x = 1.3
    far = spark.createDataFrame([(x,)], "x double").select(drift.kolmogorov_tail(F.col("x"))).first()[0]
    gap = math.ceil(x / math.sqrt(n / 2) * n) / n
    assert drift.exact_tail(gap, n, n) == pytest.approx(far, rel=0.05)


def test_exact_up_to_a_size(spark):
    rng = np.random.default_rng(8)
    rows = [(float(v), None if i < 3 else float(v) + (i % 2), i % 2) for i, v in enumerate(rng.normal(size=60))]
    df = spark.createDataFrame([(*r, None) for r in rows], "x double, y double, side int, nothing double")
    ref, cur = df.where("side = 0"), df.where("side = 1")
    names = ["x", "y", "nothing"]
    distances, counts = drift.two_sample_distances(ref, cur, names), drift.population_stability(ref, cur, names)
    exact = {r["feature"]: r for r in drift.exact_significance(distances, counts).collect()}
    for name, column in (("x", 0), ("y", 1)):
        a, b = ([r[column] for r in rows if r[2] == s and r[column] is not None] for s in (0, 1))
        gap = max(abs(sum(v <= t for v in a) * len(b) - sum(v <= t for v in b) * len(a)) for t in a + b)
        want = paths_that_meet(len(a), len(b), gap) / math.comb(len(a) + len(b), len(a))
        assert exact[name]["ks_p_value"] == pytest.approx(want, rel=1e-9) and exact[name]["ks_p_exact"]
        assert exact[name]["ks_significant"] == (want < 0.05)
    assert exact["nothing"]["ks_p_value"] is None and not exact["nothing"]["ks_significant"] and not exact["nothing"]["ks_p_exact"]
    beyond = {r["feature"]: r for r in drift.exact_significance(distances, counts, exact_rows=29).collect()}
    assert beyond["x"]["ks_p_value"] == beyond["x"]["ks_p_value_asymptotic"] and not beyond["x"]["ks_p_exact"]


def test_alerts(spark):
    report = spark.createDataFrame(
        [("a", 0.3, "significant_shift"), ("b", 0.5, "significant_shift"), ("c", 0.01, "stable"), ("d", None, "skipped_non_numeric")],
        "feature string, psi double, psi_status string",
    )
    rows = {r["psi_status"]: r["features"] for r in drift.drift_alerts(report).collect()}
    assert rows == {"significant_shift": ["b", "a"], "stable": ["c"]}


def test_weekly_monitor(spark):
    rng = np.random.default_rng(4)
    rows = []
    for week in range(4):
        scores = np.clip(rng.normal(0.3 + (0.25 if week == 3 else 0), 0.1, 400), 0, 1)
        for i, s in enumerate(scores):
            day = datetime.datetime(2024, 1, 1) + datetime.timedelta(weeks=week, hours=i % 160)
            rows.append((day, float(s), int(rng.random() < s)))
    df = spark.createDataFrame(rows, "ts timestamp, s double, y int").repartition(5)
    out = [r for r in drift.weekly_monitor(df, "ts", "s", "y").orderBy("week").collect()]
    scores = [np.array([r[1] for r in rows[w * 400:(w + 1) * 400]]) for w in range(4)]
    for w, r in enumerate(out):
        assert r["volume"] == 400 and r["mean_score"] == pytest.approx(scores[w].mean())
        assert r["psi"] == pytest.approx(psi_by_hand(scores[0], scores[w]))
        assert r["ks_statistic"] == pytest.approx(cdf_gap(scores[0], scores[w])[0])
    assert [r["alert"] for r in out] == [("drift_detected" if r["psi"] > 0.1 else None) for r in out]
    assert out[0]["alert"] is None and out[3]["alert"] == "drift_detected"
    assert all(r["roc_auc"] > 0.4 and r["ece"] >= 0 for r in out)


def test_stability_ignores_nan_and_survives_far_values(spark):
    base = [(float(i % 20) / 20,) for i in range(200)]
    reference = spark.createDataFrame(base + [(float("nan"),), (None,)], "x double")
    same = {r.feature: r for r in drift.population_stability(reference, spark.createDataFrame(base, "x double"), ["x"]).collect()}["x"]
    assert (same.psi, same.reference_n, same.current_n) == (0.0, 200, 200)
    far = spark.createDataFrame(base + [(1e12,), (-1e300,), (float("inf"),)], "x double")
    shifted = drift.population_stability(reference, far, ["x"]).first()
    assert shifted.current_n == 203 and 0 < shifted.psi < 0.1


def test_stability_of_a_constant_reference(spark):
    for value in (3.0, 1e20):
        reference = spark.createDataFrame([(value,)] * 50, "x double")
        moved = spark.createDataFrame([(value,)] * 25 + [(value * 1e9,)] * 25, "x double")
        assert drift.population_stability(reference, reference, ["x"]).first().psi == 0.0
        assert drift.population_stability(reference, moved, ["x"]).first().psi > 1


def test_weekly_gap_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(f"2024-01-{1 + 7 * w + d:02d} 10:00:00", float(np.round(rng.beta(2, 3 + w), 2))) for w in range(4) for d in range(5) for _ in range(40)]
    df = spark.createDataFrame(rows, "t string, s double").withColumn("t", F.col("t").cast("timestamp"))
    got = {str(r.week): r.ks_statistic for r in drift.weekly_monitor(df, "t", "s").collect()}
    weeks = {}
    for t, s in rows:
        weeks.setdefault((int(t[8:10]) - 1) // 7, []).append(s)
    for w, values in weeks.items():
        grid = np.unique(np.concatenate([weeks[0], values]))
        share = lambda v: np.searchsorted(np.sort(v), grid, side="right") / len(v)
        assert got[f"2024-01-{1 + 7 * w:02d}"] == pytest.approx(np.abs(share(weeks[0]) - share(values)).max())


@pytest.mark.parametrize("kind", ["same", "shifted", "ties", "far", "one_sided", "short"])
def test_distances_equal_all_values_in_order(spark, kind, monkeypatch):
    """Ranges that are not opened give the same distances as every value would."""
    rng = np.random.default_rng(6)
    one, two = rng.normal(size=4000), rng.normal(size=3000)
    if kind == "shifted":
        two = two * 2 + 1
    elif kind == "ties":
        one, two = np.round(one, 1), np.round(two, 0)
    elif kind == "far":
        two[:3] = [1e12, -1e9, 5e5]
    elif kind == "one_sided":
        two = np.abs(two) + 10
    elif kind == "short":
        one, two = one[:3], two[:2]
    monkeypatch.setattr(drift, "RANGES", 60)
    frames = [spark.createDataFrame([(float(v), None if i % 3 else float(v)) for i, v in enumerate(x)], "a double, b double").repartition(3) for x in (one, two)]
    got = {r.feature: r for r in drift.two_sample_distances(*frames, ["a", "b"]).collect()}
    for name, (x, y) in {"a": (one, two), "b": (one[::3], two[::3])}.items():
        every = np.unique(np.concatenate([x, y]))
        gap = np.abs(np.searchsorted(np.sort(x), every, "right") / len(x) - np.searchsorted(np.sort(y), every, "right") / len(y))
        if min(len(x), len(y)) >= 2:
            assert got[name].ks_statistic == pytest.approx(gap.max(), abs=1e-12)
        assert got[name].wasserstein_distance == pytest.approx((gap[:-1] * np.diff(every)).sum(), rel=1e-9)


def test_few_values_leave_their_task(spark):
    """On continuous columns hardly any range is opened."""
    one = spark.range(100_000).select(F.randn(1).alias("v"))
    two = spark.range(100_000).select((F.randn(2) * 1.2 + 0.3).alias("v"))
    cuts = drift._cuts(one, two, ["v"])
    pieces = drift._by_range(one, ["v"], cuts, None, True)
    assert pieces.groupBy("bucket").count().count() <= drift.RANGES
    seen = []
    held = drift._by_range

    def count(df, features, cuts, opened, side):
        out = held(df, features, cuts, opened, side)
        if opened is not None:
            seen.append(out.count())
        return out

    drift._by_range = count
    try:
        got = drift.two_sample_distances(one, two, ["v"]).first()
    finally:
        drift._by_range = held
    assert 0 < sum(seen) < 0.05 * 200_000 and got.ks_statistic > 0.1
