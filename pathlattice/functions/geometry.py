"""Map geometry of the edge layer as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edge_key(src: Column | str = "src", dst: Column | str = "dst") -> Column:
    """``"src-dst"``."""
    return F.concat_ws("-", F.col(src).cast("string") if isinstance(src, str) else src.cast("string"),
                       F.col(dst).cast("string") if isinstance(dst, str) else dst.cast("string"))


def midpoint(a: Column, b: Column) -> Column:
    """P10: where the weight label sits."""
    return (a + b) / 2


def direction_anchors(a: Column, b: Column) -> tuple[Column, Column]:
    """The two points of the direction arrow, at 5/8 and 7/8 of the way from ``a`` to ``b``."""
    return (a * 3 + b * 5) / 8, (a + b * 7) / 8
