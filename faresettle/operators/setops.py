"""Positional unions; names come from the first frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)
