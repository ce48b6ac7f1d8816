"""Unions and small set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame], evolve: bool = False) -> DataFrame:
    """By name; ``evolve`` fills columns a frame does not have with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=evolve), frames)
