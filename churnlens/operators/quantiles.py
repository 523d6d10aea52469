"""Exact quantiles with bounded memory, by histogram refinement.

Spark's exact ``percentile`` keeps a value->count map of every distinct value
in the final (single) task of a global aggregate, which does not survive a
near-unique column such as ``ts`` at scale; ``percentile_approx`` is bounded
but not exact. Here each round is one distributed pass that counts rows per
(probe, bucket) -- at most ``buckets`` rows per probe reach the driver -- and
narrows every target rank to the one bucket that holds it. Once a probe's
interval holds at most ``fetch_max`` rows, the next pass counts its distinct
values instead, which resolves the rank exactly. Result: linear
interpolation between the two closest ranks (the pandas/``quantile_cont``
definition).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rank_targets(n: int, probs: Sequence[float]) -> dict[float, tuple[int, int, float]]:
    out = {}
    for p in probs:
        pos = p * (n - 1)
        lo = math.floor(pos)
        out[p] = (lo, math.ceil(pos), pos - lo)
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    buckets: int = 1024, fetch_max: int = 1024,
                    stats=None) -> dict[str, dict[float, float]]:
    """``{col: {p: value}}`` for non-null values of each numeric column.

    NaN must be null already. Infinite values are set apart in a round of their
    own, so that the finite ones keep a finite interval.

    ``stats``: an already computed row with ``n{i}``, ``lo{i}``, ``hi{i}``
    (count, min, max of column ``i``) saves the first pass.
    """
    vals = {c: F.col(c).cast("double") for c in cols}
    if stats is None:
        stats = df.agg(*[F.count(vals[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                       *[F.min(vals[c]).alias(f"lo{i}") for i, c in enumerate(cols)],
                       *[F.max(vals[c]).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    targets = {}
    # state per (col, rank): [low, high, rows below low, rows in [low, high]]
    state: dict[tuple[str, int], list] = {}
    for i, c in enumerate(cols):
        n = stats[f"n{i}"]
        if not n:
            continue
        targets[c] = _rank_targets(n, probs)
        for lo, hi, _ in targets[c].values():
            for r in (lo, hi):
                state[(c, r)] = [float(stats[f"lo{i}"]), float(stats[f"hi{i}"]), 0, n]
    found: dict[tuple[str, int], float] = {}
    while True:
        for key, (a, b, _, _) in list(state.items()):
            if a == b:
                found[key] = a
                del state[key]
        if not state:
            break
        # Targets with the same interval share one probe.
        probes: dict[tuple[str, float, float, bool], list[tuple[str, int]]] = defaultdict(list)
        for key, (a, b, _, cnt) in state.items():
            probes[(key[0], a, b, cnt <= fetch_max)].append(key)
        plist = list(probes)
        items = []
        for pid, (c, a, b, exact) in enumerate(plist):
            v = vals[c]
            if exact:
                slot = v
            elif math.isinf(a) or math.isinf(b):
                slot = (F.when(v == F.lit(-math.inf), F.lit(-1.0)).when(v == F.lit(math.inf), F.lit(1.0))
                        .otherwise(F.lit(0.0)))
            else:  # halves, so that the width of the interval cannot overflow
                slot = F.least(F.floor((v / 2 - F.lit(a / 2)) / F.lit(b / 2 - a / 2) * F.lit(buckets)),
                               F.lit(buckets - 1)).cast("double")
            items.append(F.when(v.between(a, b), F.struct(F.lit(pid).alias("p"), slot.alias("s"),
                                                          v.alias("v"))))
        rows = (df.select(F.explode(F.array(*items)).alias("x")).where(F.col("x").isNotNull())
                  .groupBy(F.col("x.p").alias("p"), F.col("x.s").alias("s"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("vmin"),
                       F.max("x.v").alias("vmax"))
                  .collect())  # <= buckets rows per probe, or <= fetch_max distinct values
        by_probe = defaultdict(list)
        for r in rows:
            by_probe[r["p"]].append(r)
        for pid, probe in enumerate(plist):
            groups = sorted(by_probe[pid], key=lambda r: r["s"])
            for key in probes[probe]:
                st = state[key]
                need = key[1] - st[2]
                before = 0
                for g in groups:
                    if before + g["n"] > need:
                        st[0], st[1], st[2], st[3] = g["vmin"], g["vmax"], st[2] + before, g["n"]
                        break
                    before += g["n"]
    result: dict[str, dict[float, float]] = {}
    for c, per_p in targets.items():
        result[c] = {}
        for p, (lo, hi, frac) in per_p.items():
            vlo, vhi = found[(c, lo)], found[(c, hi)]
            result[c][p] = vlo if vlo == vhi or not frac else vlo + (vhi - vlo) * frac
    return result
