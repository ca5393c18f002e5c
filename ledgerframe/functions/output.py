"""Output normalisation for results that are compared across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType


def comparable(df: DataFrame, decimals: dict[str, int] | None = None) -> DataFrame:
    """Money stays DECIMAL, at its own scale and one common width, as engines differ in
    the width they give to sums. Columns named in ``decimals`` are ratios and averages,
    whose last bits depend on summation order: they leave as DOUBLE, rounded to so many
    places."""
    decimals = decimals or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in decimals:
            c = F.round(c, decimals[f.name]).cast("double")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast(f"decimal(38,{f.dataType.scale})")
        cols.append(c.alias(f.name))
    return df.select(*cols)
