"""Column expressions (F1-F9 and helpers).

Every function returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen; none of them is a Python UDF. Time parts are
derived from epoch milliseconds with integer arithmetic, so they are UTC
regardless of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (CANCEL_PAGE, CLASS_CANCEL, CLASS_DOWNGRADE, CLASS_OTHER,
                      DOWNGRADE_PAGE)

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def churn_label(page: str | Column = "page") -> Column:
    """2 for a cancellation, 1 for a downgrade, 0 otherwise (int)."""
    p = _col(page)
    return (F.when(p == CANCEL_PAGE, F.lit(CLASS_CANCEL))
            .when(p == DOWNGRADE_PAGE, F.lit(CLASS_DOWNGRADE))
            .otherwise(F.lit(CLASS_OTHER)).cast("int"))


def epoch_ms_date(ts: str | Column = "ts") -> Column:
    """UTC calendar date of epoch milliseconds, exact integer arithmetic."""
    t = _col(ts)
    days = (t - F.pmod(t, F.lit(MS_PER_DAY))) / F.lit(MS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def epoch_ms_year(ts: str | Column = "ts") -> Column:
    """F2."""
    return F.year(epoch_ms_date(ts))


def epoch_ms_month(ts: str | Column = "ts") -> Column:
    """F3."""
    return F.month(epoch_ms_date(ts))


def epoch_ms_day(ts: str | Column = "ts") -> Column:
    """F4."""
    return F.dayofmonth(epoch_ms_date(ts))


def epoch_ms_hour(ts: str | Column = "ts") -> Column:
    """UTC hour of day."""
    t = _col(ts)
    return (F.pmod(t, F.lit(MS_PER_DAY)) / F.lit(MS_PER_HOUR)).cast("int")


def state_of(location: str | Column = "location") -> Column:
    """second comma piece, trimmed; the whole string when there is no comma."""
    loc = _col(location)
    return F.when(F.instr(loc, ",") > 0, F.trim(F.get(F.split(loc, ","), 1))).otherwise(loc)


def split_states(state: str | Column = "state") -> Column:
    """states joined by ``-`` as an array."""
    return F.split(_col(state), "-")


def prediction_correct(page: str | Column = "page", pred: str | Column = "churn_pred") -> Column:
    """the flagged class matches the page (cancel -> 2, downgrade -> 1)."""
    p, y = _col(page), _col(pred)
    hit = (((p == CANCEL_PAGE) & (y == CLASS_CANCEL))
           | ((p == DOWNGRADE_PAGE) & (y == CLASS_DOWNGRADE)))
    return F.coalesce(hit, F.lit(False))


def hash_bucket(keys: list[str | Column], salt: str, buckets: int = 10_000) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from integer/string keys.

    First 8 hex digits of ``md5(concat_ws('|', keys..., salt))`` as an integer.
    Independent of partitioning and of the engine (SQL engines compute the
    same number), unlike ``sample``/``randomSplit``. Keys must not be doubles:
    their text forms differ between engines.
    """
    parts = [_col(k).cast("string") for k in keys] + [F.lit(salt)]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


#: ``hash_fraction_bits`` values lie in ``[0, HASH_RANGE)``.
HASH_RANGE = 1 << 60


def hash_fraction_bits(keys: list[str | Column], salt: str) -> Column:
    """Sixty bits of the same digest, for keep fractions of any size without a floor."""
    parts = [_col(k).cast("string") for k in keys] + [F.lit(salt)]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
