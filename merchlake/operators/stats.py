"""Model quality figures and population-stability drift."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions.ordering import running_weight
from merchlake.functions.scalars import money
from merchlake.functions.selection import with_percentiles

BINS = 10
EMPTY_SHARE = 0.0001
MIN_ROWS = 10
HIGH_DRIFT = 0.2
MODERATE_DRIFT = 0.1


def classifier_quality(
    scored: DataFrame, label: str, score: str, threshold: float = 0.5, pieces: int | None = None
) -> DataFrame:
    """AUC, precision and recall in one row, rounded to four places.

    AUC is the share of (positive, negative) pairs ranked rightly, ties
    counting half. Rows are merged per score first; the count of negatives
    below each score is then carried from range to range. 0 where one class
    is missing.
    """
    merged = (
        scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("_score"))
        .agg(
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_neg"),
        )
    )
    ranked = running_weight(merged, [], ["_score"], "_neg", before="_below", total="_all_neg", pieces=pieces)
    hit = F.col("_score") > threshold
    sums = ranked.agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)).alias("_won"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
        F.coalesce(F.sum(F.when(hit, F.col("_pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(hit, F.col("_pos") + F.col("_neg"))), F.lit(0)).alias("_called"),
    )
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    pairs = F.col("_p").cast("double") * F.col("_n")
    return sums.select(
        _or_zero(F.when(both, F.col("_won") / F.nullif(pairs, F.lit(0)))).alias("auc"),
        _or_zero(F.col("_tp") / F.nullif(F.col("_called"), F.lit(0))).alias("precision"),
        _or_zero(F.col("_tp") / F.nullif(F.col("_p"), F.lit(0))).alias("recall"),
    )


def _or_zero(value: Column) -> Column:
    return F.coalesce(F.round(F.round(value, 10), 4), F.lit(0.0))


def regression_quality(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE and RMSE (two places) and R² (four places) in one pass."""
    rows = scored.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(actual) - F.col(predicted)
    sums = rows.agg(
        F.avg(F.abs(error)).alias("_mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(actual).alias("_var"),
    )
    return sums.select(
        money("_mae").alias("mae"),
        money(F.sqrt("_mse")).alias("rmse"),
        F.round(F.round(1 - F.col("_mse") / F.nullif(F.col("_var"), F.lit(0.0)), 10), 4).alias("r2"),
    )


def drift_windows(df: DataFrame, loaded: str, cutoff: date | datetime, as_of: datetime, days: int = 30) -> DataFrame:
    """Mark baseline rows (loaded before the cutoff) and current rows (last days); a row may be both."""
    base = F.coalesce(F.col(loaded) < F.lit(cutoff), F.lit(False))
    current = F.coalesce(F.col(loaded) >= F.lit(as_of - timedelta(days=days)), F.lit(False))
    return df.withColumns({"is_baseline": base, "is_current": current}).where("is_baseline OR is_current")


def population_stability(windows: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """PSI and drift verdict per feature from rows marked by `drift_windows`.

    Bin edges are the baseline's interpolated percentiles, left-closed, with
    the outer ones widened beyond both samples. The edges are looked up from
    counts (`selection.with_percentiles`) and the rows counted against them as
    they lie: all features in one scan, no value is shuffled.
    """
    values = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    long = windows.select("is_baseline", "is_current", F.inline(F.array(*values))).where("value IS NOT NULL")
    names = {f"e{i}": i / bins for i in range(1, bins)}
    edges = with_percentiles(long.where("is_baseline"), ["feature"], "value", names).select(
        F.col("feature").alias("_feature"), F.array(*names).alias("_inner")
    )
    # One row per feature name of the call, hence safe to broadcast.
    placed = long.join(F.broadcast(edges), F.col("feature") == F.col("_feature"), "left")
    bin_no = F.size(F.filter("_inner", lambda e: e <= F.col("value")))
    counts = placed.groupBy("feature", bin_no.alias("bin")).agg(
        F.count(F.when(F.col("is_baseline"), 1)).alias("n_base"), F.count(F.when(F.col("is_current"), 1)).alias("n_current")
    )
    per_feature = counts.groupBy("feature").agg(
        F.sum("n_base").alias("baseline_rows"),
        F.sum("n_current").alias("current_rows"),
        F.collect_list(F.struct("n_base", "n_current")).alias("_bins"),
    )

    def share(n: Column, total: str) -> Column:
        return F.when(n == 0, F.lit(EMPTY_SHARE)).otherwise(n / F.col(total))

    def part(b: Column) -> Column:
        e, a = share(b["n_base"], "baseline_rows"), share(b["n_current"], "current_rows")
        return (a - e) * F.log(a / e)

    enough = (F.col("baseline_rows") >= MIN_ROWS) & (F.col("current_rows") >= MIN_ROWS)
    value = F.aggregate("_bins", F.lit(0.0), lambda acc, b: acc + part(b))
    wanted = windows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    result = wanted.join(per_feature, "feature", "left").withColumn(
        "psi", F.when(enough, F.round(F.round(value, 8), 4))
    )
    return result.select(
        "feature",
        F.coalesce("baseline_rows", F.lit(0)).alias("baseline_rows"),
        F.coalesce("current_rows", F.lit(0)).alias("current_rows"),
        "psi",
        drift_level(F.col("psi")).alias("drift"),
    )


def drift_level(psi: Column) -> Column:
    return (
        F.when(psi.isNull(), "insufficient_data")
        .when(psi > HIGH_DRIFT, "high")
        .when(psi > MODERATE_DRIFT, "moderate")
        .otherwise("none")
    )


def retrain_decision(stability: DataFrame) -> DataFrame:
    """One row: retrain when any feature drifts highly, and which ones."""
    high = F.col("drift") == "high"
    return stability.agg(
        F.coalesce(F.bool_or(high), F.lit(False)).alias("retrain"),
        F.array_join(F.array_sort(F.collect_list(F.when(high, F.col("feature")))), ",").alias("drifted_features"),
    )
