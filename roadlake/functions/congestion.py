"""Speed ratio, congestion class and derived per-row values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def speed_ratio(speed="speed", free_flow="free_flow_speed") -> Column:
    """speed / free-flow speed; null when free-flow is null or <= 0."""
    ffs = _c(free_flow)
    return F.when(ffs > 0, _c(speed) / ffs).cast("double")


def congestion_class(ratio="speed_ratio",
                     free_flow: float = S.FREE_FLOW_THRESHOLD,
                     heavy: float = S.HEAVY_THRESHOLD) -> Column:
    """F8: null -> null, >= 0.67 -> 0, >= 0.40 -> 1, else 2."""
    r = _c(ratio)
    return (
        F.when(r.isNull(), F.lit(None))
        .when(r >= free_flow, F.lit(0))
        .when(r >= heavy, F.lit(1))
        .otherwise(F.lit(2))
        .cast("int")
    )


def congestion_trend(current="current_congestion", past="past_congestion_15min") -> Column:
    """class change over the last 15 minutes."""
    return (_c(current) - _c(past)).cast("int")


def speed_ratio_trend(current="speed_ratio", past="past_speed_ratio_15min") -> Column:
    """ratio change over the last 15 minutes."""
    return (_c(current) - _c(past)).cast("double")


def holiday_flag(matched_col) -> Column:
    """1 when the holiday join matched, else 0."""
    return F.when(_c(matched_col).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("int")


def class_label(cls_col) -> Column:
    """class number -> display text."""
    c = _c(cls_col)
    out = F.lit(None).cast("string")
    expr = None
    for k, text in S.CLASS_LABELS.items():
        expr = (F.when(c == k, F.lit(text)) if expr is None else expr.when(c == k, F.lit(text)))
    return expr.otherwise(out)


def round_value(col, digits: int) -> Column:
    """F13."""
    return F.round(_c(col), digits)
