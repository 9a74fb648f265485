"""Time-series features over daily tables.

A daily table holds one row per day (and series), so a window over one series
is short however many orders lie behind it. Series of any length are handled
with `spread=True`: they are cut into ranges that each know the rows just before
them, so one series may span all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.functions.ordering import HALO, PIECE, with_halo
from merchlake.functions.scalars import in_period, money, ratio

# The model's feature set.
LAGS = (1, 2, 3, 7, 14)
ROLLING = (7, 14, 30)
CALENDAR = ("day_of_week", "day_of_month", "month", "week_of_year")
FEATURES = [*CALENDAR, *[f"lag_{k}" for k in LAGS], *[f"rolling_mean_{n}" for n in ROLLING]]
HISTORY = 30


def calendar(day: str) -> dict[str, Column]:
    """Monday is 0; weeks are ISO weeks."""
    return {
        "day_of_week": F.weekday(day),
        "day_of_month": F.dayofmonth(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
    }


def _series(series: Sequence[str], day: str):
    return Window.partitionBy(*series).orderBy(day)


def _framed(daily: DataFrame, columns: Callable, reach: int, day: str, series: Sequence[str], spread: bool, pieces: int | None):
    """Columns over frames that reach back at most `reach` rows; `columns` makes them from a window."""
    if not spread:
        return daily.withColumns(columns(_series(series, day)))
    cut = with_halo(daily, list(series), [day], reach, pieces)
    inside = Window.partitionBy(*series, PIECE).orderBy(day)
    return cut.withColumns(columns(inside)).where(~F.col(HALO)).drop(PIECE, HALO)


def revenue_anomalies(
    daily: DataFrame,
    period: str,
    as_of,
    threshold_pct: float = 30.0,
    value: str = "total_revenue",
    day: str = "order_date",
    series: Sequence[str] = (),
    spread: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Days of the period whose value is more than threshold_pct below the trailing 14-row mean.

    The mean includes the day itself and is taken over the whole table; the
    period only filters afterwards.
    """
    with_mean = _framed(
        daily.select(*series, day, value), lambda w: {"_mean": F.avg(value).over(w.rowsBetween(-13, 0))}, 13, day, series, spread, pieces
    )
    low = F.col(value) < F.col("_mean") * F.lit(1 - threshold_pct / 100.0)
    return (
        with_mean.where(in_period(day, period, as_of) & low)
        .orderBy(F.desc(day), *series)
        .select(
            *series,
            F.col(day).cast("string").alias("day"),
            money(value).alias("revenue_eur"),
            money("_mean").alias("rolling_avg_14d_eur"),
            money(ratio(F.lit(100.0) * (F.col("_mean") - F.col(value)), F.col("_mean")), 1).alias("pct_below_avg"),
        )
    )


def _lag_columns(value: str, lags: Sequence[int]) -> Callable:
    return lambda w: {f"lag_{k}": F.lag(value, k).over(w) for k in lags}


def _rolling_columns(value: str, sizes: Sequence[int]) -> Callable:
    def columns(w) -> dict[str, Column]:
        frames = {n: w.rowsBetween(-n, -1) for n in sizes}
        return {
            f"rolling_mean_{n}": F.when(F.count(value).over(f) == n, F.avg(value).over(f)) for n, f in frames.items()
        }

    return columns


def with_lags(daily: DataFrame, value: str, day: str = "order_date", series: Sequence[str] = (),
              lags: Sequence[int] = LAGS, spread: bool = False, pieces: int | None = None) -> DataFrame:
    """Values k rows (not calendar days) earlier."""
    return _framed(daily, _lag_columns(value, lags), max(lags), day, series, spread, pieces)


def with_rolling(daily: DataFrame, value: str, day: str = "order_date", series: Sequence[str] = (),
                 sizes: Sequence[int] = ROLLING, spread: bool = False, pieces: int | None = None) -> DataFrame:
    """Means of the n rows before each row, the row itself left out; NULL until n such values exist."""
    return _framed(daily, _rolling_columns(value, sizes), max(sizes), day, series, spread, pieces)


def forecast_features(daily: DataFrame, value: str = "net_revenue", day: str = "order_date",
                      series: Sequence[str] = (), spread: bool = False, pieces: int | None = None) -> DataFrame:
    """Calendar, lags and rolling means; rows with any gap are dropped."""
    lags, rolling = _lag_columns(value, LAGS), _rolling_columns(value, ROLLING)
    base = daily.select(*series, day, value)
    framed = _framed(base, lambda w: {**lags(w), **rolling(w)}, max(*LAGS, *ROLLING), day, series, spread, pieces)
    return framed.withColumns(calendar(day)).select(*series, day, value, *FEATURES).dropna()


def time_split(features: DataFrame, day: str = "order_date", test_share: float = 0.2,
               series: Sequence[str] = ()) -> DataFrame:
    """Mark the last max(1, ⌊share·n⌋) rows of each series as test rows (`is_test`)."""
    newest_first = Window.partitionBy(*series).orderBy(F.desc(day))
    n = F.count(F.lit(1)).over(Window.partitionBy(*series))
    test_rows = F.greatest(F.lit(1), F.floor(n * F.lit(test_share)))
    return features.withColumn("is_test", F.row_number().over(newest_first) <= test_rows)


def tail(daily: DataFrame, n: int, day: str = "order_date", series: Sequence[str] = ()) -> DataFrame:
    """Last n rows of each series."""
    if not series:
        return daily.orderBy(F.desc(day)).limit(n)
    rank = F.row_number().over(Window.partitionBy(*series).orderBy(F.desc(day)))
    return daily.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def horizon_features(
    daily: DataFrame,
    as_of: date,
    horizon: int = 7,
    value: str = "net_revenue",
    day: str = "order_date",
    series: Sequence[str] = (),
) -> DataFrame:
    """Feature rows for the `horizon` days after `as_of`, all built on the same last 30 values.

    Lags beyond the history fall back to its oldest value; rolling means use
    what exists. Predictions are not fed back.
    """
    days = int(horizon)
    if days < 1:
        raise ValueError("horizon must be positive")
    last = tail(daily.select(*series, day, value).where(F.col(value).isNotNull()), HISTORY, day, series)
    ordered = F.sort_array(F.collect_list(F.struct(day, value)))
    history = last.groupBy(*series).agg(F.transform(ordered, lambda r: r[value].cast("double")).alias("_h"))
    start = F.lit(as_of)
    future = F.explode(F.sequence(F.date_add(start, 1), F.date_add(start, days))).alias("forecast_date")
    rows = history.where(F.size("_h") > 0).select(*series, "_h", future)
    n = F.size("_h")
    lag = {f"lag_{k}": F.element_at("_h", F.greatest(F.lit(-k), -n)) for k in LAGS}
    mean = {f"rolling_mean_{w}": _mean(F.slice("_h", -F.least(F.lit(w), n), F.least(F.lit(w), n))) for w in ROLLING}
    return rows.withColumns({**calendar("forecast_date"), **lag, **mean}).drop("_h")


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)
