"""Frequency arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_FREQ = 5000


def compress(freq: Column, top: Column, max_freq: int = MAX_FREQ) -> Column:
    """Log scale from 1 to ``max_freq``; 1 where the frequency is not positive or the top is at most 1."""
    scaled = (F.lit(max_freq) * F.log10(freq) / F.log10(top)).cast("int")
    return F.when((freq <= 0) | (top <= 1), 1).otherwise(F.greatest(F.lit(1), F.least(F.lit(max_freq), scaled)))


def boosted(freq: Column, multiplier: Column) -> Column:
    """Truncated product; no multiplier leaves the frequency as it is."""
    return F.when(multiplier.isNull(), freq).otherwise((freq * multiplier).cast("bigint"))


def demoted(freq: Column, divisor: Column) -> Column:
    """Truncated quotient; no divisor leaves the frequency as it is."""
    return F.when(divisor.isNull(), freq).otherwise((freq / divisor).cast("bigint"))
