"""Fitted pipelines and other models on storage, published version by version.

A save writes a new folder below ``versions`` and, once that is whole, an empty file below ``published`` whose name
is a number and the version. The highest one counts. So a save that breaks off leaves the published
version as it was, and a job that loads meanwhile reads a whole model. The version before the
published one is kept for jobs that have just looked it up; older ones are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from stayrate.sources.storage import create_marker, names_in, path_exists, remove_path, require_path

KEPT = 2


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new version's folder, then make that the published one."""
    version = uuid.uuid4().hex
    write(f"{path}/versions/{version}")
    markers = names_in(spark, f"{path}/published")
    number = int(markers[-1].partition("-")[0]) + 1 if markers else 1
    create_marker(spark, f"{path}/published/{number:08d}-{version}")
    for marker in markers[: len(markers) + 1 - KEPT]:
        remove_path(spark, f"{path}/published/{marker}")
        remove_path(spark, f"{path}/versions/{marker.partition('-')[2]}")
    return f"{path}/versions/{version}"


def published(spark: SparkSession, path: str) -> str | None:
    """Folder of the published version; None where nothing was published."""
    markers = names_in(spark, f"{path}/published")
    return f"{path}/versions/{markers[-1].partition('-')[2]}" if markers else None


def model_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}_best"


def save_model(model: PipelineModel, root: str, name: str) -> str:
    """Save and publish; returns the folder of the new version."""
    return publish(SparkSession.active(), model_path(root, name), lambda folder: model.write().save(folder))


def has_model(spark: SparkSession, root: str, name: str) -> bool:
    path = model_path(root, name)
    return published(spark, path) is not None or path_exists(spark, f"{path}/metadata")


def load_model(spark: SparkSession, root: str, name: str) -> PipelineModel:
    """The published version, or a pipeline that was saved right into the model's folder."""
    path = model_path(root, name)
    version = published(spark, path)
    if version is None:
        require_path(spark, f"{path}/metadata", "saved pipeline model")
    return PipelineModel.load(version or path)
