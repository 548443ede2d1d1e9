"""Row shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, keep: list[str], array: Column, name: str) -> DataFrame:
    """One row per non-null entry of a computed array.

    A plain explode makes the optimiser filter on the array's size first, which
    computes the array twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
