"""Scalar score expressions: clipping, NaN handling, thresholding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: clip bound of submitted probabilities.
CLIP_EPS = 1e-6


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_score(p, eps: float = CLIP_EPS) -> Column:
    """Clip to [eps, 1-eps]; NaN and null stay as they are.

    ``least/greatest`` alone would turn NaN into 1-eps (Spark orders NaN last)
    and null into eps (both skip nulls): a missing prediction must stay missing.
    """
    p = _col(p)
    clipped = F.least(F.greatest(p, F.lit(float(eps))), F.lit(1.0 - eps))
    return F.when(p.isNull() | F.isnan(p), p).otherwise(clipped)


def nan_to_null(p) -> Column:
    """Missing scores are null inside the engine (``avg``/``max`` propagate NaN)."""
    p = _col(p)
    return F.when(F.isnan(p), F.lit(None).cast("double")).otherwise(p)


def is_missing(p) -> Column:
    p = _col(p)
    return p.isNull() | F.isnan(p)


def threshold_class(p, t: float = 0.5) -> Column:
    """1 when the score reaches the threshold (``>=``), else 0."""
    return (_col(p) >= F.lit(float(t))).cast("int")
