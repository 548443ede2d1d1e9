"""Measured size bounds, and joins that stay balanced beyond them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Bound:
    """What a bounded count of a lookup found."""

    max_rows: int = BROADCAST_ROWS
    max_bytes: int = BROADCAST_BYTES

    def holds(self, df: DataFrame) -> bool:
        """True if ``df`` is counted to be within the bound; two numbers per task reach the last one."""
        return self.rows_within(df) is not None

    def rows_within(self, df: DataFrame) -> int | None:
        """The rows of ``df`` if they are counted to be within the bound, else None."""
        rows, used = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
        return rows if rows <= self.max_rows and used <= self.max_bytes else None


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(16).cast("bigint")
    for name, kind in df.dtypes:
        text = F.col(f"`{name}`") if kind == "string" else F.to_json(F.struct(F.col(f"`{name}`")))
        size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def salt_count(spark: SparkSession) -> int:
    """How many parts a hot key is split into: more on a cluster with more partitions."""
    return max(32, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def salted_join(many: DataFrame, few: DataFrame, on: Sequence[str], spread: Column,
                how: str = "inner", salts: int | None = None) -> DataFrame:
    """Join where some keys of ``many`` may hold a large share of its rows.

    The rows of a key in ``many`` are spread over ``salts`` partitions by
    ``spread`` (a column that varies inside the key); ``few`` is repeated once
    per salt. ``how`` may be inner, left, left_semi or left_anti.
    """
    salts = salts or salt_count(many.sparkSession)
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
