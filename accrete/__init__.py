"""Feature columns on large tables, computed once and kept beside the raw rows."""

from accrete.operators.feature import FeatureDef, feature
from accrete.operators.table import FeatureTable

__all__ = ["FeatureDef", "FeatureTable", "feature"]
