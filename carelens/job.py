"""The whole job as one call: features, clusters, and both tables written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelens.config import FeatureConfig
from carelens.plans import model
from carelens.plans.features import build_features
from carelens.sources import versions
from carelens.sources.inputs import Sources
from carelens.sources.sinks import release, scratch_mark


def run_job(
    spark: SparkSession,
    src: Sources,
    features_path: str,
    clusters_path: str,
    cfg: FeatureConfig | None = None,
    *,
    fmt: str = "parquet",
    k: int = 5,
    seed: int = 100,
    clip_infinite: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Build the features once and publish them as the next version of the
    table at ``features_path``, fit the segments on what was written, publish
    the labelled table at ``clusters_path``, and delete the staged tables.
    Returns both tables as read back; ``versions.read`` finds them again.  A run
    that fails leaves the versions before it as they were.

    ``clip_infinite`` replaces infinite ratios by their column's largest (or
    smallest) finite value before clustering; otherwise an infinite value
    blanks its column, as in the reference."""
    mark = scratch_mark()
    try:
        built = build_features(src, cfg)
        features = versions.read(spark, features_path, versions.publish(built, features_path, fmt))
        points = model.clip_infinite(features) if clip_infinite else features
        labelled = model.clusters(spark, points, k, seed)
        return features, versions.read(spark, clusters_path, versions.publish(labelled, clusters_path, fmt))
    finally:
        release(spark, mark)
