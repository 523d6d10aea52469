"""Cleaning operators: casts, imputation, projection, null and duplicate removal.

Covers P1-P6, P10, A1, J1 and A7. Each is ``DataFrame -> DataFrame`` and
composes with ``df.transform``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, Tuning
from ..schema import SOURCE_CASTS
from .joins import attach_by_key


def cast_columns(df: DataFrame, casts: Mapping[str, str] = SOURCE_CASTS) -> DataFrame:
    """Cast columns by a ``{name: type}`` map.

    ``try_cast``: an empty or malformed user id becomes null instead of failing
    the job under ANSI mode (the reference relied on non-ANSI ``cast``).
    """
    present = {c: t for c, t in casts.items() if c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in present.items()})


def user_means(df: DataFrame, key: str = "userId", value: str = "length") -> DataFrame:
    """A1: mean of ``value`` per key (nulls skipped) plus the key's row count.

    The count rides along in the same aggregation and tells the join which
    keys are hot; partial aggregation happens map-side before the shuffle.
    """
    return df.groupBy(key).agg(F.avg(value).alias("mean_length"),
                               F.count(F.lit(1)).alias("__rows"))


def impute_length(df: DataFrame, key: str = "userId", value: str = "length",
                  tuning: Tuning = DEFAULT, keep: Column | None = None) -> DataFrame:
    """A1 + J1 + P5: fill a null ``value`` with the mean of its key.

    Null keys never match, so their rows stay null (and a user with no
    non-null value keeps nulls). Column order follows the reference: the key
    first, then the other columns, then the filled value last.

    ``keep`` filters the rows that go through the join (e.g. rows a later
    ``dropna`` would drop anyway); the means still come from every row.
    """
    means = user_means(df, key, value)
    big = df if keep is None else df.where(keep)
    joined = attach_by_key(big, means, key, "__rows", tuning, name="user-means")
    others = [c for c in df.columns if c not in (key, value)]
    return joined.select(key, *others,
                         F.coalesce(F.col(value), F.col("mean_length")).alias(value))


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P2."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P3 (absent names are ignored)."""
    return df.drop(*cols)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """P4."""
    return df.withColumnRenamed(old, new)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``cols`` (default: all)."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct value of ``cols`` (default: all columns).

    A hash aggregate with a map-side partial step, so a large group of copies
    collapses before the shuffle; the shuffle key is all columns, so one hot
    user does not land in one task.
    """
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def lower_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P10 as an explicit opt-in: lower-case the values of string columns.

    The reference's loop discards its result, so its pipelines are unaffected;
    ours do not call this either.
    """
    targets = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.lower(F.col(c)) for c in targets})


def clean(df: DataFrame, cols: Sequence[str], tuning: Tuning = DEFAULT,
          value: str = "length", casts: Mapping[str, str] = SOURCE_CASTS) -> DataFrame:
    """P1 -> A1/J1/P5 -> P2 -> P6 -> A7: the shared cleaning prefix.

    Same result as dropping incomplete rows after the imputation join, but
    the null checks on columns the join does not change run before it, so
    rows that will be dropped (e.g. logged-out users) never reach the join.
    Only the imputed ``value`` is checked after it.
    """
    cast = cast_columns(df, casts)
    floats = {f.name for f in cast.schema.fields
              if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    checks = [(F.col(c).isNotNull() & ~F.isnan(F.col(c))) if c in floats else F.col(c).isNotNull()
              for c in cols if c != value]
    keep = reduce(lambda a, b: a & b, checks) if checks else None
    return (impute_length(cast, value=value, tuning=tuning, keep=keep)
            .select(*cols)
            .transform(drop_incomplete, [value] if value in cols else None)
            .transform(dedupe))
