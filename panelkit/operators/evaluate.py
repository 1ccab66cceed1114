"""Evaluation of predictions against labels (A3, E1-E6) as one aggregation.

Thresholds turn scores into 0/1 classes (E2); every metric is a conditional
sum, so a whole panel evaluates in one partial-aggregate + merge.  The
reference passes (prediction, truth) to functions that expect (truth,
prediction); both the reference's value (``ref_*``) and the correctly named
one are emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Score threshold and the truth threshold factor.
THRESHOLD = 0.7
TRUTH_FACTOR = 0.75


def threshold(pred: str = "prediction", truth: str = "truth", t: float = THRESHOLD):
    """(predicted class, true class) columns."""
    return ((F.col(pred) > t).cast("int").alias("pred_class"),
            (F.col(truth) > TRUTH_FACTOR * t).cast("int").alias("true_class"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def metrics(df: DataFrame, pred: str = "prediction", truth: str = "truth",
            group=()) -> DataFrame:
    """A3, E1, E3-E5 over rows with both values present (optionally per group)."""
    p1, t1 = threshold(pred, truth)
    base = df.filter(F.col(pred).isNotNull() & F.col(truth).isNotNull()).select(
        *group, F.col(pred).alias("_p"), F.col(truth).alias("_t"), p1, t1)
    g = base.groupBy(*group) if group else base.groupBy()
    a = g.agg(F.count(F.lit(1)).alias("n"),
              F.avg(F.abs(F.col("_p") - F.col("_t"))).alias("mae"),
              F.avg((F.col("_p") - F.col("_t")) * (F.col("_p") - F.col("_t"))).alias("_mse"),
              F.sum("pred_class").alias("n_pred1"), F.sum("true_class").alias("n_true1"),
              F.sum(F.col("pred_class") * F.col("true_class")).alias("both1"),
              F.sum((1 - F.col("pred_class")) * (1 - F.col("true_class"))).alias("both0"))
    n, np1, nt1, b1, b0 = (F.col(c) for c in ("n", "n_pred1", "n_true1", "both1", "both0"))
    np0, nt0 = n - np1, n - nt1
    pres1 = ((np1 + nt1) > 0).cast("int")
    pres0 = ((np0 + nt0) > 0).cast("int")
    classes = pres1 + pres0
    ref_prec = (_ratio(b1, nt1) * pres1 + _ratio(b0, nt0) * pres0) / classes
    prec = (_ratio(b1, np1) * pres1 + _ratio(b0, np0) * pres0) / classes
    f1_1 = _ratio(F.lit(2.0) * b1, np1 + nt1)
    f1_0 = _ratio(F.lit(2.0) * b0, np0 + nt0)
    return a.select(*group, "n", "mae", F.sqrt("_mse").alias("rmse"),
                    ref_prec.alias("ref_precision"), prec.alias("precision"),
                    ((np1 * f1_1 + np0 * f1_0) / n).alias("ref_f1_weighted"),
                    ((nt1 * f1_1 + nt0 * f1_0) / n).alias("f1_weighted"),
                    F.when(np1 > 0, b1 / np1).alias("topacc"))


def series_long(df: DataFrame, series, key=("symbol", "trade_date")) -> DataFrame:
    """The overlay table in long form (key..., series, value)."""
    return df.unpivot(list(key), list(series), "series", "value")
