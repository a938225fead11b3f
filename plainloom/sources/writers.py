"""Writers: CSV tables and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = ",",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    encoding: str = "UTF-8",
) -> None:
    """One file per task; ``partition_by`` makes folders that later reads can skip."""
    writer = df.write.mode(mode).option("header", header).option("sep", sep).option("encoding", encoding)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def save_model(model: Model, path: str) -> None:
    """Save a fitted model, wrapped so that any kind loads the same way."""
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
    wrapped.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
