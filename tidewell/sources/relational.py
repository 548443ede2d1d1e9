"""The relational edge: JDBC reads, staging writes, flattened rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType


def read_dim(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """A table, or a sub-query in brackets with an alias."""
    return spark.read.jdbc(url=url, table=table, properties=properties)


def stage(df: DataFrame, url: str, table: str, properties: dict[str, str],
          batch_rows: int = 10_000) -> None:
    """Overwrite a staging table; ``truncate`` keeps its definition."""
    df.write.option("batchsize", batch_rows).option("truncate", True) \
        .jdbc(url=url, table=table, mode="overwrite", properties=properties)


def flatten_for_rdbms(df: DataFrame) -> DataFrame:
    """Nested values as JSON text, NaN as null."""
    def plain(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            return F.to_json(column).alias(field.name)
        if isinstance(field.dataType, (DoubleType, FloatType)):
            return F.when(~F.isnan(column), column).alias(field.name)
        return column
    return df.select(*[plain(f) for f in df.schema.fields])
