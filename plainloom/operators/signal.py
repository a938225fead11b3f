"""Vibration-style time features per group: one aggregation over all channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators.ordering import join_null_safe, lookup

FEATURES = ("mean", "std", "skew", "kurtosis", "rms", "max", "p2p")


def sample_skewness(x: Column) -> Column:
    """Bias-corrected skewness; null below 3 values, 0 for a constant."""
    n, g = F.count(x).cast("double"), F.skewness(x)
    corrected = F.sqrt(n * (n - 1)) / (n - 2) * g
    return F.when(n > 2, F.when(F.var_pop(x) == 0, 0.0).otherwise(corrected))


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis; null below 4 values, 0 for a constant."""
    n, g = F.count(x).cast("double"), F.kurtosis(x)
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6)
    return F.when(n > 3, F.when(F.var_pop(x) == 0, 0.0).otherwise(corrected))


def feature_columns(channel: str) -> list[Column]:
    """Aggregates of one channel, named <channel>_<feature>.

    rms divides by all rows, nulls included; p2p is |max| + |min|.
    """
    x = F.col(channel).cast("double")
    made = {
        "mean": F.avg(F.abs(x)),
        "std": F.stddev_samp(x),
        "skew": sample_skewness(x),
        "kurtosis": sample_kurtosis(x),
        "rms": F.sqrt(F.sum(x * x) / F.count(F.lit(1))),
        "max": F.max(F.abs(x)),
        "p2p": F.abs(F.max(x)) + F.abs(F.min(x)),
    }
    return [made[f].alias(f"{channel}_{f}") for f in FEATURES]


def histogram_entropy(df: DataFrame, by: Sequence[str], channels: Sequence[str], bins: int = 500) -> DataFrame:
    """Entropy in nats of an equal-width histogram per (group, channel).

    Bins are open on the left and closed on the right. Groups may be of any size:
    range, bin counts and entropy are three aggregations combined before the shuffle.
    """
    keys = [*by, "column"]
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(channels)])
    edges = [f(f"_x{i}").alias(f"_{n}{i}") for i in range(len(channels)) for n, f in (("lo", F.min), ("hi", F.max))]
    # One row of ranges a group meets the readings as they stand; they are binned in place.
    placed = lookup(rows, rows.groupBy(*by).agg(*edges), by, null_safe=True)
    bins_of = []
    for i, c in enumerate(channels):
        x, lo, hi = F.col(f"_x{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        scaled = (x - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins
        index = F.coalesce(F.greatest(F.ceil(scaled) - 1, F.lit(0)), F.lit(0))
        bins_of.append(F.struct(F.lit(c).alias("column"), F.when(x.isNotNull(), index).alias("_bin")))
    binned = placed.select(*by, F.inline(F.array(*bins_of))).where(F.col("_bin").isNotNull())
    counts = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).cast("double").alias("_c"))
    total = F.sum("_c")
    entropy = F.log(total) - F.sum(F.col("_c") * F.log("_c")) / total
    return counts.groupBy(*keys).agg(entropy.alias("entropy"))


def time_features(df: DataFrame, by: Sequence[str], channels: Sequence[str], bins: int = 500) -> DataFrame:
    """All features of all channels, one row per group, columns <channel>_<feature>."""
    wide = df.groupBy(*by).agg(*[c for ch in channels for c in feature_columns(ch)])
    entropy = histogram_entropy(df, by, channels, bins).groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == c, F.col("entropy"))).alias(f"{c}_entropy") for c in channels]
    )
    return join_null_safe(wide, entropy, list(by), "left")
