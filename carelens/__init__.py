"""carelens: customer features and segmentation for after-sales service data,
built on Spark DataFrames."""

from carelens.config import FeatureConfig  # noqa: F401
from carelens.plans.features import CATALOGUE, FEATURE_NAMES, build_features, feature_table  # noqa: F401
from carelens.sources.inputs import Sources  # noqa: F401
