"""Time and calendar column expressions (UTC months).

``month_range`` is the predicate to use when a job needs a slice of months:
a plain range on the timestamp reaches the Parquet scan as a pushed filter
(and prunes ``year``/``month`` partitions when present), while
``year(ts) = y`` or ``date_trunc(...) = x`` is not pushed down.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The customer grid covers these months, both ends included.
DEFAULT_SPINE_START = dt.date(2018, 1, 1)
DEFAULT_SPINE_END = dt.date(2024, 12, 1)

# Wire form of event timestamps, ISO text plus " UTC".
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss' UTC'"
WIRE_TIMESTAMP_FRACTION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS' UTC'"
MONTH_YEAR_FORMAT = "yyyy-MM"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(ts) -> Column:
    """EXTRACT(YEAR FROM TIMESTAMP_TRUNC(ts, MONTH)); truncation cannot change it."""
    return F.year(_col(ts))


def month_of(ts) -> Column:
    return F.month(_col(ts))


def day_of(ts) -> Column:
    """Truncate to the day; the result stays a timestamp."""
    return F.date_trunc("DAY", _col(ts))


def month_year(d) -> Column:
    """FORMAT_DATE('%Y-%m', d) / FORMAT_DATETIME('%Y-%m', t)."""
    return F.date_format(_col(d), MONTH_YEAR_FORMAT)


def to_wire_text(ts) -> Column:
    """Timestamp -> ISO text + ' UTC' as published on the topics; microseconds
    are written only when there are any (as Python's isoformat does)."""
    c = _col(ts)
    return F.when(F.unix_micros(c) % 1_000_000 == 0, F.date_format(c, WIRE_TIMESTAMP_FORMAT)
                  ).otherwise(F.date_format(c, WIRE_TIMESTAMP_FRACTION_FORMAT))


def month_sequence(start, end) -> Column:
    """GENERATE_DATE_ARRAY(start, end, INTERVAL 1 MONTH), both ends included."""
    return F.sequence(_lit_date(start), _lit_date(end), F.expr("INTERVAL 1 MONTH"))


def month_rows(start, end) -> Column:
    """The months of [start, end] as a constant array of (year, month, month_year).

    Built from the bounds as literals, so Catalyst folds it into a single
    constant and exploding it per user copies precomputed values instead of
    evaluating year/month/date_format once per grid row.
    """
    if isinstance(start, Column) or isinstance(end, Column):
        # Bounds known only at run time: whole months, fields per element.
        first_c, last_c = F.trunc(_lit_date(start), "month"), F.trunc(_lit_date(end), "month")
        return F.transform(month_sequence(first_c, last_c), lambda d: F.struct(
            F.year(d).alias("year"), F.month(d).alias("month"), month_year(d).alias("month_year")))
    first, last = month_start(_as_date(start)), month_start(_as_date(end))
    items = []
    d = first
    while d <= last:
        items.append(f"named_struct('year', {d.year}, 'month', {d.month}, "
                     f"'month_year', '{d.year:04d}-{d.month:02d}')")
        d = next_month(d)
    # One SQL expression (a single call into the JVM), folded to a constant.
    return F.expr(f"array({', '.join(items)})")


def _as_date(d) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def day_sequence(start, end) -> Column:
    """Every day from start to end, both ends included."""
    return F.sequence(_lit_date(start), _lit_date(end), F.expr("INTERVAL 1 DAY"))


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def month_start(d: dt.date) -> dt.date:
    return dt.date(d.year, d.month, 1)


def next_month(d: dt.date) -> dt.date:
    return dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)


def month_range(ts, first_month: dt.date, last_month: dt.date) -> Column:
    """Rows whose timestamp falls in [first_month, last_month] (whole months).

    Emitted as ``ts >= a AND ts < b`` so it is pushed to the Parquet reader.
    """
    lo = dt.datetime.combine(month_start(first_month), dt.time())
    hi = dt.datetime.combine(next_month(month_start(last_month)), dt.time())
    c = _col(ts)
    return (c >= F.lit(lo)) & (c < F.lit(hi))
