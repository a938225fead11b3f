"""Sensor files arriving one per time point: the batch time features as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plainloom.functions.dates import file_time
from plainloom.operators.signal import FEATURES, feature_columns


def snapshot_stream(
    spark: SparkSession, path: str, channels: Sequence[str], files_per_batch: int = 1000
) -> DataFrame:
    """(file_ts, channels...) of every sensor file that appears under ``path``."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in channels])
    rows = (
        spark.readStream.schema(schema)
        .option("sep", "\t")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    return rows.select(file_time(F.col("_metadata.file_name")).cast("timestamp").alias("file_ts"), *channels)


def windowed_features(
    stream: DataFrame, time: str, channels: Sequence[str], window: str, watermark: str
) -> DataFrame:
    """Time features per tumbling window; only running moments are kept as state.

    Times must be ``timestamp``: a watermark refuses zone-less ones.
    """
    features = [c for ch in channels for c in feature_columns(ch)]
    grouped = stream.withWatermark(time, watermark).groupBy(F.window(time, window))
    return grouped.agg(*features).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[f"{ch}_{f}" for ch in channels for f in FEATURES],
    )


def write_features(features: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows to Parquet, processing what has arrived and then stopping."""
    return (
        features.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
