"""Stacking frames by column name (G1)."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns are matched by name, and one that a frame
    lacks is NULL there."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
