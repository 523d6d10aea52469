"""Profiling: null counts, numeric summary, distinct values, a peek, density.

The reference pulls the whole table into pandas for each of these
(``toPandas``); here each is a distributed aggregate whose result is small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PEEK_SALT
from .checkpoint import materialize
from .quantiles import exact_quantiles

_HALF = 1 << 32  # a difference of two longs is below its square

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3 + A4: per column, rows that are null (or NaN) and their percentage.

    One aggregation pass for all columns, unpivoted to
    ``(column_name, null_count, null_pct)``.
    """
    cols = list(cols or df.columns)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}

    def is_missing(c: str):
        col = F.col(c)
        return (col.isNull() | F.isnan(col)) if c in floats else col.isNull()

    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(is_missing(c)).alias(c) for c in cols])
    long = wide.unpivot("__n", cols, "column_name", "null_count")
    return long.select("column_name", "null_count",
                       (F.col("null_count").cast("double") * F.lit(100.0)
                        / F.col("__n").cast("double")).alias("null_pct"))


def null_profile_stages(cast: DataFrame, impute, value: str = "length") -> DataFrame:
    """A3/A4 before and after imputation in one pass (only ``value`` differs).

    ``impute`` is the imputation step (``DataFrame -> DataFrame``); the raw
    values ride along as an extra column, so one aggregation gives both.
    Output: ``stage`` (raw, imputed), ``column_name``, ``null_count``, ``null_pct``.
    """
    raw_col = f"{value}_raw"
    prof = null_profile(impute(cast.withColumn(raw_col, F.col(value))))
    cols = cast.columns
    raw = (prof.where(F.col("column_name").isin([c for c in cols if c != value] + [raw_col]))
               .withColumn("column_name", F.regexp_replace("column_name", f"^{raw_col}$", value))
               .withColumn("stage", F.lit("raw")))
    imp = prof.where(F.col("column_name").isin(cols)).withColumn("stage", F.lit("imputed"))
    return raw.unionByName(imp)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None,
                     probs: Sequence[float] = (0.25, 0.5, 0.75), digits: int = 10) -> DataFrame:
    """A5: count, mean, std, min, quartiles, max per numeric column (exact).

    The numeric projection is materialised once; then one pass gives count,
    min and max, a second the moments, and ``exact_quantiles`` the quartiles
    (bounded driver traffic: at most its ``buckets`` rows a probe). NaN counts
    as missing, as in A3 and P6. For integral columns the moments are exact:
    ``d = x - min`` is cut into two 32-bit parts, whose sums and sums of
    products fit 38-digit decimals for the whole range of a long, so the mean
    and the sample standard deviation do not depend on summation order (large
    epoch values lose digits in double sums). Floating columns use Spark's
    double aggregates. Mean and std are rounded to ``digits`` significant digits.
    """
    cols = list(cols or numeric_columns(df))
    spark = df.sparkSession
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    base = materialize(df.select(*[F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in floats else F.col(c)
                                   for c in cols]), "describe")
    integral = {f.name for f in base.schema.fields
                if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
    first = base.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
                     *[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                     *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    moments = []
    for i, c in enumerate(cols):
        if c in integral and first[f"lo{i}"] is not None:
            d = f"(cast(`{c}` AS decimal(20,0)) - cast('{first[f'lo{i}']}' AS decimal(20,0)))"
            high, low = (F.expr(f"cast({d} {op} {_HALF}BD AS decimal(18,0))") for op in ("div", "%"))
            moments += [F.sum(high).alias(f"h{i}"), F.sum(low).alias(f"l{i}"), F.sum(high * high).alias(f"hh{i}"),
                        F.sum(high * low).alias(f"hl{i}"), F.sum(low * low).alias(f"ll{i}")]
        else:
            v = F.col(c).cast("double")
            moments += [F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}")]
    second = base.agg(*moments).first()
    q = exact_quantiles(base, cols, probs, stats=first)
    rows = []
    for i, c in enumerate(cols):
        n, lo, hi = first[f"n{i}"], first[f"lo{i}"], first[f"hi{i}"]
        if c in integral and lo is not None:
            h, l, hh, hl, ll = (int(second[f"{k}{i}"]) for k in ("h", "l", "hh", "hl", "ll"))
            s1, s2 = h * _HALF + l, hh * _HALF ** 2 + 2 * hl * _HALF + ll
            mean = (lo * n + s1) / n
            std = math.sqrt((n * s2 - s1 * s1) / (n * (n - 1))) if n > 1 else None
        else:
            mean, std = second[f"mean{i}"], second[f"std{i}"]
        qc = q.get(c, {})
        rows.append((c, n, _round(mean, digits), _round(std, digits),
                     None if lo is None else float(lo),
                     *[qc.get(p) for p in probs], None if hi is None else float(hi)))
    names = (["column_name", "count", "mean", "std", "min"]
             + [f"q{int(round(p * 100))}" for p in probs] + ["max"])
    types = ["string", "bigint"] + ["double"] * (len(names) - 2)
    # At most one row per column: the summary itself, assembled from the passes
    # above as literals (a JVM-side local relation; no Python worker involved).
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _round(x: float | None, digits: int) -> float | None:
    """Half-up rounding of the exact binary value to ``digits`` significant digits."""
    if x is None or x == 0 or math.isnan(x) or math.isinf(x):
        return x
    exact = Decimal(x)
    return float(exact.quantize(Decimal(1).scaleb(exact.adjusted() - digits + 1), rounding=ROUND_HALF_UP))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A6."""
    return df.select(col).distinct()


def random_rows(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """L1: ``n`` pseudo-random rows, reproducible and partition-independent.

    Orders by ``md5`` of the row keys and takes ``n`` (a top-k: each task
    keeps ``n`` rows, the driver merges ``n`` per task). The limit is the
    feature here.
    """
    order = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(PEEK_SALT)))
    return df.withColumn("__peek", order).orderBy("__peek").limit(n).drop("__peek")


def density(df: DataFrame, x: str = "length", y: str = "itemInSession", x_width: float = 500.0,
            y_width: float = 10.0, by: Sequence[str] = ("level", "churn")) -> DataFrame:
    """2-D histogram of ``x`` by ``y`` per group, in place of scatter plots.

    Cells are ``floor(x / x_width)``, ``floor(y / y_width)``; output is one row
    per non-empty cell with its count, so it grows with the cell count, not
    the rows.
    """
    return (df.groupBy(*by, F.floor(F.col(x) / F.lit(x_width)).alias("x_cell"),
                       F.floor(F.col(y) / F.lit(y_width)).alias("y_cell"))
              .agg(F.count(F.lit(1)).alias("n")))
