"""Small helpers over whole frames."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row frames side by side, without a join."""
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))
