"""Samples by hash, for models that are fitted on a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LARGEST = (1 << 63) - 1


def in_sample(key: Column, share: float) -> Column:
    """Whether a 64-bit hash falls into the first ``share`` of its range; no share is too small to be told from 0."""
    return key.bitwiseAND(F.lit(LARGEST)) <= F.lit(min(LARGEST, int(share * LARGEST)))
