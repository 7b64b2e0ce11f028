"""Column-present masks of partial row images (MINIMAL binlog row images).

A row event carries a bitmap of the columns present in each image; bit ``i``
(least significant first) marks the image's ``i``-th column.  An absent column
is not the same as a present NULL, so the mask travels beside the image.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_present(mask, ordinal: int) -> Column:
    """Is the column at 0-based ``ordinal`` present in the image?"""
    m = F.col(mask) if isinstance(mask, str) else mask
    return m.cast("long").bitwiseAND(F.lit(1 << ordinal)) != 0


def present_fields(mask, names: list[str]) -> Column:
    """Names of the present columns, in image order."""
    return F.array_compact(F.array(*[F.when(is_present(mask, i), F.lit(n)) for i, n in enumerate(names)]))
