"""A saved model on a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import model as models
from . import sinks


def score_stream(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The batch scoring transform, unchanged, on a streaming feature table."""
    return models.score(model, features)


def score_to_parquet(model: PipelineModel, features: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return sinks.append_parquet(score_stream(model, features), path, checkpoint)
