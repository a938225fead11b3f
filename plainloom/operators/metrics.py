"""Evaluation metrics as tables, always as (truth, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators.ordering import running_total
from plainloom.operators.textstats import top_per_group


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    hit = (F.col(truth) == F.col(predicted)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts per (truth, prediction) and their share of the true class."""
    cells = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = cells.groupBy("truth").agg(F.sum("n").alias("_t"))
    return cells.join(totals, "truth").select("truth", "predicted", "n", (F.col("n") / F.col("_t")).alias("share"))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class; a ratio without cases is 0.

    Every row counts once as its true and once as its predicted class, in one aggregation.
    """
    cells = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    same = F.col("t") == F.col("p")
    sides = F.array(
        F.struct(F.col("t").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("named"), F.when(same, F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("named"), F.lit(0).cast("long").alias("hit")),
    )
    sums = cells.select(F.explode(sides).alias("s")).groupBy(F.col("s.c").alias("class")).agg(
        *[F.sum(f"s.{c}").alias(c) for c in ("support", "named", "hit")]
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hit", "named"), zero)
    recall = F.coalesce(F.try_divide("hit", "support"), zero)
    f1 = F.coalesce(F.try_divide(2 * F.col("hit"), F.col("named") + F.col("support")), zero)
    return sums.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def log_loss(df: DataFrame, truth: str, probability: str, eps: float = 1e-15) -> DataFrame:
    """Mean negative log of the probability given to the true class (0/1 truth), clipped by ``eps``."""
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    return df.agg((-F.avg(F.log(F.when(F.col(truth) == 1, p).otherwise(1 - p)))).alias("log_loss"))


def auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under ROC as the rank-sum statistic, ties counted half.

    Scores are counted first; the running total over them is range-partitioned.
    """
    counts = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum((F.col(truth) == 1).cast("long")).alias("_pos"),
        F.sum((F.col(truth) != 1).cast("long")).alias("_neg"),
    )
    cum = running_total(counts, [], ["_s"], "_neg", "_below", "_negs")
    won = F.sum(F.col("_pos") * (F.col("_below") - F.col("_neg") / 2))
    return cum.agg((won / F.nullif(F.sum("_pos") * F.max("_negs"), F.lit(0))).alias("auc"))


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """MSE, RMSE, MAE and R squared in one pass."""
    error = F.col(truth) - F.col(predicted)
    mse = F.avg(error * error)
    return df.agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - mse / F.nullif(F.var_pop(truth), F.lit(0.0))).alias("r2"),
    )


def masked_accuracy(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """Accuracy over sequence positions whose true label is above 0 (0 is padding)."""
    pairs = df.select(F.explode(F.arrays_zip(truth.alias("t"), predicted.alias("p"))).alias("_z"))
    real = pairs.where(F.col("_z.t") > 0).select("_z.t", "_z.p")
    return accuracy(real, "t", "p")


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def cluster_samples(df: DataFrame, cluster: str, order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows per cluster under ``order``."""
    return top_per_group(df, [cluster], order, n)
