"""Prediction-side operators: flagged rows, their precision, weighted metrics.

P9, F9, A8 and the DataFrame form of M11-M13. ``rule_prediction`` is a fixed
feature rule (not a model) used to check the metric code against SQL and to
exercise scoring without a fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import prediction_correct
from ..schema import AT_RISK_CLASSES, LABEL, PREDICTION


def rule_prediction(df: DataFrame, out: str = PREDICTION) -> DataFrame:
    """A fixed rule on the features: fractional length -> 1, or 2 on even items.

    Only song rows carry a whole-number length in the fixture, so the rule
    leans on the imputation leak described in the README; it is a check
    fixture, not a recommendation.
    """
    frac = F.col("length") != F.floor(F.col("length"))
    return df.withColumn(out, F.when(frac & (F.pmod(F.col("itemInSession"), F.lit(2)) == 0), F.lit(2.0))
                              .when(frac, F.lit(1.0)).otherwise(F.lit(0.0)))


def flagged_rows(scored: DataFrame, pred: str = PREDICTION, page: str = "page") -> DataFrame:
    """P9 + F9: rows predicted at risk (class 1 or 2) and whether the page agrees."""
    keep = [c for c in scored.columns if c not in ("features", "rawPrediction", "probability")]
    return (scored.select(*keep)
                  .where(F.col(pred).isin(*[float(k) for k in AT_RISK_CLASSES]))
                  .withColumn("correct_prediction", prediction_correct(page, pred)))


def flag_precision(flagged: DataFrame) -> DataFrame:
    """Percentage of flagged rows that were right (null if none flagged)."""
    return flagged.agg(
        F.count(F.lit(1)).alias("n_flagged"),
        F.count_if(F.col("correct_prediction")).alias("n_correct"),
        (F.avg(F.col("correct_prediction").cast("double")) * F.lit(100.0)).alias("flag_precision"))


def weighted_metrics(pred: DataFrame, label: str = LABEL, prediction: str = PREDICTION,
                     digits: int | None = 9, by: str | None = None) -> DataFrame:
    """M11-M13 as aggregates: weighted F1, precision and recall, one row (or one per value of ``by``).

    Same definitions as MLlib's ``MulticlassMetrics``: classes are the label
    values, weights are label counts, a class never predicted right scores 0
    (so only diagonal cells contribute). The data is first reduced to the
    confusion cells (at most classes squared rows, times the values of ``by``);
    the rest runs on them. Also returns the row count and the rows flagged at
    risk (class 1 or 2).
    """
    group = [by] if by else []
    cells = pred.groupBy(*group, F.col(label).cast("double").alias("l"),
                         F.col(prediction).cast("double").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(*group)
    cells = (cells.withColumn("label_n", F.sum("n").over(Window.partitionBy(*group, "l")))
                  .withColumn("pred_n", F.sum("n").over(Window.partitionBy(*group, "p")))
                  .withColumn("total", F.sum("n").over(everything))
                  .withColumn("flagged", F.sum(F.when(F.col("p").isin(*[float(k) for k in AT_RISK_CLASSES]),
                                                      F.col("n")).otherwise(F.lit(0))).over(everything)))
    diag = F.col("l") == F.col("p")
    prec = F.col("n") / F.col("pred_n")
    rec = F.col("n") / F.col("label_n")
    f1 = F.lit(2.0) * prec * rec / (prec + rec)

    def weighted(metric):
        v = F.coalesce(F.sum(F.when(diag, metric * F.col("label_n") / F.col("total"))), F.lit(0.0))
        return F.round(v, digits) if digits is not None else v

    return (cells.groupBy(*group) if group else cells).agg(
        weighted(f1).alias("f1"), weighted(prec).alias("weighted_precision"),
        weighted(rec).alias("weighted_recall"), F.max("total").alias("n_rows"),
        F.max("flagged").alias("flagged_rows"))
