"""Union and branching."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame


def union_all(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, columns matched by name."""
    return reduce(DataFrame.unionByName, inputs)


def branch_union(df: DataFrame, *branches: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Send one input through several branches and bring the results together."""
    return union_all(*[branch(df) for branch in branches])
