"""Features with labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.session import join_large


def training_matrix(
    features: DataFrame,
    labels: DataFrame,
    *,
    keys: Sequence[str] = ("split_id", "entity_id"),
    discard: Sequence[str] = (),
) -> DataFrame:
    """Features with the label of the same split and entity; unlabeled rows keep NULL."""
    return join_large(features, labels.select(*keys, "label"), keys).drop(*discard)


def labeled(matrix: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose label is 0 or 1."""
    return matrix.where(F.col(label).isin(0, 1))
