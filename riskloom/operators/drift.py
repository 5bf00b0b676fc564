"""Distribution drift between a reference and a current table.

All features go through one plan: each task adds up counts and sums of ranges of values,
and only values of ranges that can decide a distance are ever exchanged and ordered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.functions.binning import histogram_bin, histogram_edges
from riskloom.functions.scalars import numeric_columns
from riskloom.operators.evaluate import calibration_error, full_metrics
from riskloom.operators.ordered import BUCKET, running, with_buckets
from riskloom.operators.profile import score_distribution
from riskloom.session import stage

# ---- fixed values: interpretation of the stability index, significance level
STABLE_BELOW = 0.1
MODERATE_BELOW = 0.25
EPSILON = 1e-6
SIGNIFICANCE = 0.05
#: Rows of either sample up to which a p-value is worked out exactly.
EXACT_ROWS = 10_000


def psi_status(psi: Column) -> Column:
    return (
        F.when(psi.isNull(), "insufficient_data")
        .when(psi < STABLE_BELOW, "stable")
        .when(psi < MODERATE_BELOW, "moderate_shift")
        .otherwise("significant_shift")
    )


def _known(c: str) -> Column:
    """The column as a number; NaN is missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def reference_edges(reference: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Equal-width edges per feature over the finite reference range; none without values."""
    def finite(c: str) -> Column:
        return F.when(F.abs(_known(c)) < float("inf"), _known(c))

    row = reference.agg(*[F.struct(F.min(finite(c)), F.max(finite(c))).alias(c) for c in features]).first()
    return {c: histogram_edges(*row[c], bins) for c in features if row[c][0] is not None}


def _psi_terms(ref: Column, cur: Column, ref_n: Column, cur_n: Column, bins: int, epsilon: float) -> Column:
    expected = (ref + epsilon) / (ref_n + epsilon * bins)
    actual = (cur + epsilon) / (cur_n + epsilon * bins)
    return (actual - expected) * F.log(actual / expected)


def population_stability(
    reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, epsilon: float = EPSILON
) -> DataFrame:
    """``feature, psi, psi_status, reference_n, current_n``.

    Bins ``[a, b)`` are equal-width over the reference; the outer ones reach to
    infinity. NaN is missing. A feature that is empty on either side has NULL and
    ``insufficient_data``. Counting needs one pass over each side and exchanges
    only (features x bins) rows.
    """
    edges = reference_edges(reference, features, bins)
    spark = reference.sparkSession

    def counts(df: DataFrame, name: str) -> DataFrame:
        placed = df.select(*[
            histogram_bin(_known(c), edges[c]).alias(c) for c in edges
        ]).unpivot([], list(edges), "feature", "bin")
        return placed.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias(name))

    # a feature without reference values still gets its row
    shell = spark.createDataFrame([(c, b) for c in features for b in range(bins)], "feature string, bin int")
    if edges:
        on = ["feature", "bin"]
        table = shell.join(F.broadcast(counts(reference, "ref")), on, "left")
        table = table.join(F.broadcast(counts(current, "cur")), on, "left").na.fill(0, ["ref", "cur"])
    else:
        table = shell.select("*", F.lit(0).alias("ref"), F.lit(0).alias("cur"))
    # (features x bins) rows, so the totals can be a window over each feature
    per_feature = W.partitionBy("feature")
    table = table.select(
        "*", F.sum("ref").over(per_feature).alias("reference_n"), F.sum("cur").over(per_feature).alias("current_n")
    )
    term = _psi_terms(F.col("ref"), F.col("cur"), F.col("reference_n"), F.col("current_n"), bins, epsilon)
    both = (F.col("reference_n") > 0) & (F.col("current_n") > 0)
    psi = table.groupBy("feature", "reference_n", "current_n").agg(F.sum(F.when(both, term)).alias("psi"))
    return psi.select("feature", "psi", psi_status(F.col("psi")).alias("psi_status"), "reference_n", "current_n")


def kolmogorov_tail(x: Column, terms: int = 20) -> Column:
    """Limit distribution of the two-sample statistic: ``2 * sum (-1)^(k-1) exp(-2 k^2 x^2)``.

    Below 1 the series in 1/x converges faster; the two agree where they meet.
    """
    sq = x * x
    far = sum((F.lit(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * sq) for k in range(1, terms + 1)), F.lit(0.0))
    near_sum = sum(
        (F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8) / sq) for k in range(1, terms + 1)), F.lit(0.0)
    )
    near = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * near_sum
    return F.when(x <= 0.05, F.lit(1.0)).when(x < 1, near).otherwise(F.greatest(F.least(far, F.lit(1.0)), F.lit(0.0)))


#: Ranges that the values of a feature are cut into; more of them open less of the data.
RANGES = 2048
_PIECES = "feature int, bucket int, ref long, cur long, ref_sum double, cur_sum double, low double, high double"


def exact_tail(gap: float, reference_n: int, current_n: int) -> float:
    """Share of all orders of the two samples whose largest gap is at least ``gap``, when the samples are alike.

    An order is a path over a grid of reference_n by current_n steps. All paths to a point are equally likely, so the share
    of them that have met such a gap is the mean of the shares at its two predecessors, weighted by the steps taken in
    either direction. The points of one diagonal are worked out at once; memory is one diagonal.
    """
    n, m = int(reference_n), int(current_n)
    least = round(gap * n * m)  # gaps are whole numbers of 1 / (n m)
    met = np.array([1.0 if least <= 0 else 0.0])
    low = 0
    for steps in range(1, n + m + 1):
        first, last = max(0, steps - m), min(n, steps)
        i = np.arange(first, last + 1)
        padded = np.zeros(last - first + 3)
        padded[low - first + 1 : low - first + 1 + len(met)] = met  # met[k] belongs to point low + k
        share = (padded[:-2] * i + padded[1:-1] * (steps - i)) / steps
        met = np.where(np.abs(i * m - (steps - i) * n) >= least, 1.0, share)
        low = first
    return float(met[0])


def _exact_tails(gap: pd.Series, reference_n: pd.Series, current_n: pd.Series, limit: pd.Series) -> pd.Series:
    def one(d: float, n: float, m: float, most: float) -> float | None:
        return exact_tail(d, int(n), int(m)) if d == d and 2 <= min(n, m) and max(n, m) <= most else None

    return pd.Series([one(*row) for row in zip(gap, reference_n, current_n, limit)], dtype="float64")


def _cuts(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Ascending cut points of each feature over both sides, by a sketch of fixed size; any cuts give the same distances."""
    shares = [i / RANGES for i in range(1, RANGES)]
    both = reference.select(*[_known(c).alias(str(i)) for i, c in enumerate(features)]).unionByName(
        current.select(*[_known(c).alias(str(i)) for i, c in enumerate(features)]))
    row = both.agg(*[F.approx_percentile(f"`{i}`", shares, 2 * RANGES).alias(str(i)) for i in range(len(features))]).first()
    return [np.unique(np.array(row[str(i)] or [], np.float64)) for i in range(len(features))]


def _by_range(df: DataFrame, features: Sequence[str], cuts: list[np.ndarray], opened: list[np.ndarray] | None, is_reference: bool) -> DataFrame:
    """Counts, sums and ends of each feature's ranges, added up by each task; or the values, with their counts, of opened ranges.

    Columns are read side by side as Arrow batches: no row is taken apart.
    """
    sent = df.sparkSession.sparkContext.broadcast((cuts, opened))
    schema = pa.schema([("feature", pa.int32()), ("bucket", pa.int32()), ("ref", pa.int64()), ("cur", pa.int64()),
                        ("ref_sum", pa.float64()), ("cur_sum", pa.float64()), ("low", pa.float64()), ("high", pa.float64())])

    def rows(feature: int, bucket: np.ndarray, n: np.ndarray, total: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        none, zero = np.zeros(len(n), np.int64), np.zeros(len(n))
        columns = [np.full(len(n), feature, np.int32), bucket.astype(np.int32), n, none, total, zero, low, high]
        if not is_reference:
            columns[2:6] = [none, n, zero, total]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, opened = sent.value
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i, name in enumerate(batch.schema.names):
                values = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                if not len(values):
                    continue
                bucket = np.searchsorted(cuts[i], values)
                if opened is not None:
                    inside = opened[i][bucket]
                    if inside.any():
                        distinct, n = np.unique(values[inside], return_counts=True)
                        yield rows(i, np.searchsorted(cuts[i], distinct), n, distinct * n, distinct, distinct)
                    continue
                size = len(cuts[i]) + 1
                if i not in held:
                    held[i] = [np.zeros(size, np.int64), np.zeros(size), np.full(size, np.inf), np.full(size, -np.inf)]
                n, total, low, high = held[i]
                n += np.bincount(bucket, minlength=size)
                total += np.bincount(bucket, values, minlength=size)
                np.minimum.at(low, bucket, values)
                np.maximum.at(high, bucket, values)
        for i, (n, total, low, high) in held.items():
            there = np.flatnonzero(n)
            yield rows(i, there, n[there], total[there], low[there], high[there])

    return df.select(*[_known(c).alias(f"f{i}") for i, c in enumerate(features)]).mapInArrow(read, _PIECES)


def two_sample_distances(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, ks_statistic, ks_p_value_asymptotic, ks_significant, wasserstein_distance``, both distances exact.

    The values of a feature are cut into ranges, and only each range's counts, sums and ends are exchanged. They give the gap of the two
    shares at the ends of the range and bound it inside. Where it cannot change its sign, the range's part of the Wasserstein
    distance is the difference of two sums; where it cannot exceed the largest gap at an end, it does not decide the KS
    statistic. Only the values of ranges that may do either are exchanged, and ordered, in a second pass.
    """
    spark = reference.sparkSession
    cuts = _cuts(reference, current, features)

    def both(opened: list[np.ndarray] | None) -> DataFrame:
        return _by_range(reference, features, cuts, opened, True).unionByName(_by_range(current, features, cuts, opened, False))

    pieces = both(None).groupBy("feature", "bucket").agg(
        *[F.sum(c).alias(c) for c in ("ref", "cur", "ref_sum", "cur_sum")], F.min("low").alias("low"), F.max("high").alias("high"))
    order = W.partitionBy("feature").orderBy("bucket")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("feature")
    ranges = pieces.select(
        "*", F.sum("ref").over(upto).alias("upto_ref"), F.sum("cur").over(upto).alias("upto_cur"),
        F.sum("ref").over(whole).alias("n_ref"), F.sum("cur").over(whole).alias("n_cur"), F.lead("low").over(order).alias("next"))
    n_ref, n_cur = F.nullif(F.col("n_ref"), F.lit(0)), F.nullif(F.col("n_cur"), F.lit(0))
    end = F.col("upto_ref") / n_ref - F.col("upto_cur") / n_cur
    start = (F.col("upto_ref") - F.col("ref")) / n_ref - (F.col("upto_cur") - F.col("cur")) / n_cur
    least, most = start - F.col("cur") / n_cur, start + F.col("ref") / n_ref
    to = F.coalesce("next", "high")
    area = F.abs(start * (to - F.col("low")) + (F.col("ref") * to - F.col("ref_sum")) / n_ref - (F.col("cur") * to - F.col("cur_sum")) / n_cur)
    single = F.col("low") == F.col("high")
    ranges = ranges.select("*", F.abs(end).alias("end_gap"), area.alias("area"), F.greatest(F.abs(least), F.abs(most)).alias("bound"),
                           ((least < 0) & (most > 0)).alias("crosses"), start.alias("start"))
    ranges = ranges.withColumn("best", F.max("end_gap").over(whole))
    finite = (F.abs("low") < float("inf")) & (F.abs("high") < float("inf")) & (F.abs(to) < float("inf"))
    # a range of one value has nothing inside: its gap is that at its end up to the next range
    told = stage(ranges.select(
        "feature", "bucket", "n_ref", "n_cur", "start", "next", "end_gap",
        F.when(single, F.col("end_gap") * (F.coalesce("next", "low") - F.col("low"))).otherwise(F.col("area")).alias("area"),
        F.coalesce(~single & ((F.col("bound") > F.col("best")) | F.col("crosses") | ~finite), F.lit(False)).alias("opened")))
    # a flag for each range, whatever the number of rows
    opened = [np.zeros(len(c) + 1, bool) for c in cuts]
    for r in told.where("opened").select("feature", "bucket").collect():
        opened[r["feature"]][r["bucket"]] = True
    values = both(opened).groupBy("feature", "bucket", F.col("low").alias("value")).agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    within = W.partitionBy("feature", "bucket").orderBy("value")
    run = within.rowsBetween(W.unboundedPreceding, 0)
    inner = values.select("feature", "bucket", "value", F.sum("ref").over(run).alias("ref"), F.sum("cur").over(run).alias("cur"), F.lead("value").over(within).alias("following"))
    inner = inner.join(told.where("opened").select("feature", "bucket", "start", "next", "n_ref", "n_cur"), ["feature", "bucket"])
    gap = F.abs(F.col("start") + F.col("ref") / n_ref - F.col("cur") / n_cur)
    step = F.coalesce("following", "next", "value") - F.col("value")
    parts = told.select("feature", "n_ref", "n_cur", F.col("end_gap").alias("gap"), F.when(~F.col("opened"), F.col("area")).alias("area")).unionByName(
        inner.select("feature", "n_ref", "n_cur", gap.alias("gap"), (gap * step).alias("area")))
    summed = parts.groupBy("feature").agg(
        F.max("gap").alias("_d"), F.sum("area").alias("_w"),
        F.max("n_ref").cast("double").alias("_ref"), F.max("n_cur").cast("double").alias("_cur"))
    names = spark.createDataFrame(list(enumerate(features)), "feature int, name string")
    ref, cur = F.col("_ref"), F.col("_cur")
    enough = (ref >= 2) & (cur >= 2)
    p = kolmogorov_tail(F.col("_d") * F.sqrt(ref * cur / (ref + cur)))
    # one row per feature on both sides
    return names.join(F.broadcast(summed), "feature", "left").select(
        F.col("name").alias("feature"),
        F.when(enough, F.col("_d")).alias("ks_statistic"),
        F.when(enough, p).alias("ks_p_value_asymptotic"),
        F.coalesce(enough & (p < SIGNIFICANCE), F.lit(False)).alias("ks_significant"),
        F.when((ref > 0) & (cur > 0), F.coalesce("_w", F.lit(0.0))).alias("wasserstein_distance"),
    )


def exact_significance(distances: DataFrame, counts: DataFrame, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Distances of ``two_sample_distances`` with ``ks_p_value`` and ``ks_p_exact``; ``ks_significant`` follows the former.

    ``counts`` has ``feature, reference_n, current_n``, such as the rows of ``population_stability``. The p-value is exact where
    neither sample has more than ``exact_rows`` known values, and that of the limit distribution beyond. Both tables have a row
    a feature; an exact value takes as many array steps as there are rows, whatever the size of the table they came from.
    """
    both = distances.join(F.broadcast(counts.select("feature", "reference_n", "current_n")), "feature", "left")
    exact = F.pandas_udf(_exact_tails, "double")(
        "ks_statistic", F.coalesce("reference_n", F.lit(0)).cast("double"), F.coalesce("current_n", F.lit(0)).cast("double"),
        F.lit(float(exact_rows)))
    told = both.withColumn("_exact", exact)
    p = F.coalesce(F.nanvl("_exact", F.lit(None).cast("double")), "ks_p_value_asymptotic")
    return told.withColumns({
        "ks_p_value": p,
        "ks_p_exact": F.col("_exact").isNotNull() & ~F.isnan("_exact"),
        "ks_significant": F.coalesce(p < SIGNIFICANCE, F.lit(False)),
    }).select(*distances.columns, "reference_n", "current_n", "ks_p_value", "ks_p_exact")


def drift_report(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """One row per feature present on both sides; non-numeric ones are marked as skipped."""
    shared = [c for c in features if c in reference.columns and c in current.columns]
    numeric = set(numeric_columns(reference))
    measured = [c for c in shared if c in numeric]
    skipped = [c for c in shared if c not in numeric]
    spark = reference.sparkSession
    schema = (
        "feature string, psi double, psi_status string, reference_n long, current_n long, ks_statistic double, "
        "ks_p_value_asymptotic double, ks_significant boolean, wasserstein_distance double"
    )
    rest = spark.createDataFrame([(c, None, "skipped_non_numeric") + (None,) * 6 for c in skipped], schema)
    if not measured:
        return rest
    psi = population_stability(reference, current, measured, bins)
    # one row per feature on both sides of the join
    report = psi.join(F.broadcast(two_sample_distances(reference, current, measured)), "feature", "left")
    return report.select(*rest.columns).unionByName(rest)


def prediction_drift(reference: DataFrame, current: DataFrame, score: str) -> DataFrame:
    """One row: the drift measures of the score and both of its distributions."""
    report = drift_report(reference, current, [score]).withColumnRenamed("feature", "score")
    stats = score_distribution(
        reference.select(F.col(score).alias("reference"), F.lit(None).cast("double").alias("current")).unionByName(
            current.select(F.lit(None).cast("double").alias("reference"), F.col(score).alias("current"))
        ),
        {"reference": F.col("reference"), "current": F.col("current")},
    )
    fields = [c for c in stats.columns if c != "score"]
    wide = stats.agg(*[
        F.max(F.when(F.col("score") == side, F.col(c))).alias(f"{side}_{c}") for side in ("reference", "current") for c in fields
    ]).withColumn("score", F.lit(score))
    return report.drop("reference_n", "current_n").join(F.broadcast(wide), "score")


def drift_alerts(report: DataFrame) -> DataFrame:
    """Features per status, the strongest drift first within each."""
    ranked = report.where(F.col("psi").isNotNull())
    listed = ranked.groupBy("psi_status").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sort_array(F.collect_list(F.struct((-F.col("psi")).alias("o"), F.col("feature")))).alias("_f"),
    )
    return listed.select("psi_status", "n_features", F.col("_f.feature").alias("features"))


def weekly_monitor(
    df: DataFrame,
    timestamp: str,
    score: str,
    label: str | None = None,
    threshold: float = 0.5,
    bins: int = 10,
) -> DataFrame:
    """One row per week against the first week: volume, scores, PSI, KS, alert.

    With a label, the week's quality and calibration error follow. A week's
    largest gap to the first week lies at one of its own scores or just before
    one, so only its own distinct scores are looked up in the first week's
    running share; neither side is repeated for the other. Rows without a score
    (NULL or NaN) are left out.
    """
    weekly = df.where(_known(score).isNotNull()).select(
        F.date_trunc("week", F.col(timestamp)).cast("date").alias("week"),
        _known(score).alias("score"),
        *([F.col(label).alias("label")] if label else []),
    )
    volumes = weekly.groupBy("week").agg(
        F.count(F.lit(1)).alias("volume"),
        F.avg("score").alias("mean_score"),
        F.avg((F.col("score") >= threshold).cast("int")).alias("predicted_positive_rate"),
    )
    weeks = sorted((r["week"], r["volume"]) for r in volumes.select("week", "volume").collect())
    if not weeks:
        raise ValueError("no scored rows")
    first = weeks[0][0]

    edges = reference_edges(weekly.where(F.col("week") == F.lit(first)), ["score"], bins)["score"]
    binned = weekly.groupBy("week", histogram_bin(F.col("score"), edges).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(w, n, b) for w, n in weeks for b in range(bins)], "week date, cur_n long, bin int")
    base = binned.where(F.col("week") == F.lit(first)).select("bin", F.col("n").alias("ref"))
    psi = (
        grid.join(F.broadcast(binned), ["week", "bin"], "left")
        .join(F.broadcast(base), "bin", "left")
        .na.fill(0, ["n", "ref"])
        .groupBy("week")
        .agg(
            F.sum(_psi_terms(F.col("ref"), F.col("n"), F.lit(weeks[0][1]), F.col("cur_n"), bins, EPSILON)).alias("psi")
        )
    )

    # one row per distinct score with its counts by week, then one per score and week
    counts = weekly.groupBy("score", "week").agg(F.count(F.lit(1)).alias("n"))
    by_score = counts.groupBy("score").agg(
        F.sum(F.when(F.col("week") == F.lit(first), F.col("n")).otherwise(0)).alias("ref"),
        F.collect_list(F.struct("week", "n")).alias("weeks"),
    )
    bucketed = with_buckets(by_score, "score", sketch_from=weekly)
    ranked = running(bucketed, ["score"], {"cum_ref": F.col("ref")})
    own = ranked.select("score", BUCKET, "ref", "cum_ref", F.inline("weeks"))
    own = running(own, ["score"], {"cum": F.col("n")}, ["week"])
    share, ref_share = F.lit(1.0) / F.col("volume"), F.lit(1.0 / weeks[0][1])
    at = F.abs(F.col("cum") * share - F.col("cum_ref") * ref_share)
    before = F.abs((F.col("cum") - F.col("n")) * share - (F.col("cum_ref") - F.col("ref")) * ref_share)
    sizes = spark.createDataFrame(weeks, "week date, volume long")
    ks = own.join(F.broadcast(sizes), "week").groupBy("week").agg(F.max(F.greatest(at, before)).alias("ks_statistic"))

    out = volumes.join(F.broadcast(psi), "week").join(F.broadcast(ks), "week").select(
        "week",
        "volume",
        "mean_score",
        "predicted_positive_rate",
        "psi",
        psi_status(F.col("psi")).alias("psi_status"),
        "ks_statistic",
        F.when(F.col("psi") > STABLE_BELOW, F.lit("drift_detected")).alias("alert"),
    )
    if not label:
        return out
    quality = full_metrics(weekly, "label", "score", threshold, keys=["week"]).select(
        "week", "roc_auc", "pr_auc", "f1", "precision", "recall", "brier_score"
    )
    ece = calibration_error(weekly, "label", "score", bins, keys=["week"])
    # one row per week on every side
    return out.join(F.broadcast(quality), "week", "left").join(F.broadcast(ece), "week", "left")
