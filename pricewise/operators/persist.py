"""Stored models: a fitted pipeline, encoders and learner, written to the shared folder and
loaded again by any session. A stored pipeline scores batches and streams alike."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.sql import SparkSession


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> str:
    """``path`` is in a folder that driver and executors share; an existing model there is an
    error, unless it is to be overwritten."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(spark: SparkSession, path: str, last: type[Model] | None = None) -> PipelineModel:
    """The pipeline at ``path``; ``last`` is the kind of model that its last stage must be."""
    model = PipelineModel.read().session(spark).load(path)
    if last is not None and not isinstance(model.stages[-1], last):
        raise TypeError(f"{path} holds a {type(model.stages[-1]).__name__}, not a {last.__name__}")
    return model
