"""propensity: binary-outcome modelling on wide event tables, as Spark jobs."""

from .spec import FeatureSpec, FoldSpec, GridSpec, SplitSpec

__version__ = "0.1.0"
__all__ = ["FeatureSpec", "SplitSpec", "FoldSpec", "GridSpec"]
