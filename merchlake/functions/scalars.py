"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of incoming times (yyyy-MM-ddTHH:mm:ss) and dates
# (yyyy-MM-dd), and the end of an open version.
ORDER_TS_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
OPEN_END = "9999-12-31 00:00:00"

# Named periods as days back from today. The two month names are
# calendar based and handled in period_start.
PERIOD_DAYS = {
    "today": 0,
    "yesterday": 1,
    "last 7 days": 7,
    "last 14 days": 14,
    "last 30 days": 30,
}
FALLBACK_DAYS = 7


def money(value: Column | str, digits: int = 2) -> Column:
    """Half-up rounding that does not depend on the order in which doubles were added.

    A sum of doubles wobbles in its last bits with the partition order, so a
    value on an exact half could round either way. Snapping to six decimals
    first removes the wobble.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.round(F.round(column, 6), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def as_day(moment: date | datetime) -> date:
    return moment.date() if isinstance(moment, datetime) else moment


def period_start(period: str | None, as_of: date | datetime) -> date:
    """First day of a named period. Unknown names mean the last seven days."""
    name = (period or "").strip().lower()
    day = as_day(as_of)
    if name == "this month":
        return day.replace(day=1)
    if name == "last month":
        return (day.replace(day=1) - timedelta(days=1)).replace(day=1)
    return day - timedelta(days=PERIOD_DAYS.get(name, FALLBACK_DAYS))


def period_end(period: str | None, as_of: date | datetime) -> date:
    """First day after a named period, for callers who want closed periods."""
    name = (period or "").strip().lower()
    day = as_day(as_of)
    if name == "yesterday":
        return day
    if name == "last month":
        return day.replace(day=1)
    return day + timedelta(days=1)


def in_period(column: str, period: str | None, as_of, bounded: bool = False) -> Column:
    """Rows from the start of the period on; open to the right unless `bounded`.

    The column is compared bare with literals, so the predicate reaches the scan.
    """
    keep = F.col(column) >= F.lit(period_start(period, as_of))
    if bounded:
        keep = keep & (F.col(column) < F.lit(period_end(period, as_of)))
    return keep


def since(column: str, as_of: datetime, **back) -> Column:
    """Rows not older than `back` (timedelta arguments) before `as_of`."""
    return F.col(column) >= F.lit(as_of - timedelta(**back))


def order_ts(column: str) -> Column:
    """Time of an ISO text without zone, NULL for anything else.

    A shape check and a cast: faster than a pattern parser, and unreadable
    text costs no exception. The text is used once, so a computed column is
    not computed twice.
    """
    return F.regexp_extract(column, ORDER_TS_SHAPE, 0).try_cast("timestamp")


def plain_date(column: str) -> Column:
    """Date of a yyyy-MM-dd text, NULL for anything else."""
    return F.regexp_extract(column, DATE_SHAPE, 0).try_cast("date")


def fingerprint(columns: list[str], null_token: str | None = "\u0000") -> Column:
    """SHA-256 over the listed columns.

    Each value takes part with its length in front, NULL as `null_token`, so
    different rows never give the same text to hash. With `null_token=None`
    the values are joined by `|` and NULLs skipped, which is what a bare concat_ws
    does; values that contain `|` can then look alike.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is None:
        return F.sha2(F.concat_ws("|", *parts), 256)
    sized = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit(null_token)) for p in parts]
    return F.sha2(F.concat(*sized), 256)


def blank_trim(column: Column) -> Column:
    """Strip every kind of white space, not just spaces."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def words(column: Column) -> Column:
    """White-space separated words, no empty ones."""
    return F.filter(F.split(column, r"(?U)\s+"), lambda w: w != "")
