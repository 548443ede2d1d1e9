"""Lookups: code to name, conditional keys, lists of codes, tall metadata."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.dedup import first_per_key
from tidewell.operators.inplace import IN_PLACE, in_place
from tidewell.operators.sizing import Bound


def make_lookup(metadata: DataFrame, dimension: str, alias: str) -> DataFrame:
    """(id, alias) slice of tall metadata; names that are no numbers give null."""
    return metadata.filter(F.lower("dimension") == dimension).select(
        "id", F.col("name").try_cast("bigint").alias(alias))


def lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str,
           columns: Sequence[str]) -> DataFrame:
    """Left join on one key. ``table`` holds one row per key.

    Rows without a key match nothing. So that they do not all meet in one task
    where the table is shuffled, they are spread by the task they come from.
    """
    slim = table.select(F.col(table_key).alias("_lookup_key"), (F.hash(table_key) * 0).alias("_lookup_spread"), *columns)
    keyed = df.withColumn("_key", key).withColumn("_spread", F.when(F.col("_key").isNull(), F.spark_partition_id()).otherwise(0))
    same = (F.col("_key") == F.col("_lookup_key")) & (F.col("_spread") == F.col("_lookup_spread"))
    return keyed.join(slim, same, "left").drop("_key", "_spread", "_lookup_key", "_lookup_spread")


def lookup_when(df: DataFrame, condition: Column, key: str, table: DataFrame, table_key: str,
                columns: Sequence[str]) -> DataFrame:
    """Left join in which rows that fail ``condition`` never match."""
    return lookup(df, F.when(condition, F.col(key)), table, table_key, columns)


def unmapped(df: DataFrame, source: str, mapped: str, condition: Column | None = None) -> DataFrame:
    """Distinct source values whose lookup came back null."""
    missing = F.col(mapped).isNull()
    if condition is not None:
        missing = missing & condition
    return df.filter(missing).select(source).distinct()


def map_list(df: DataFrame, key: str, column: str, table: DataFrame, source: str, target: str,
             out: str, keep_unmapped: bool = True, bound: Bound = IN_PLACE) -> DataFrame:
    """(key, out): the list ``column`` with each entry replaced through ``table``.

    An entry may map to several targets; order follows the list, then the
    target. ``key`` is unique in ``df``; rows with no list get an empty one.
    A table within ``bound`` is applied inside the row; beyond it, entries are
    joined and regrouped.
    """
    find = in_place(table, source, target, bound)
    if find is not None:
        def each(entry: Column) -> Column:
            found = F.coalesce(find(entry), F.array(F.struct(F.lit(None).alias("v"))))
            return F.array_sort(F.transform(found, lambda t: F.coalesce(t["v"], entry) if keep_unmapped else t["v"]))
        hits = F.array_compact(F.flatten(F.transform(column, each)))
        return df.select(key, F.coalesce(hits, F.array()).alias(out))
    entries = df.select(key, F.posexplode_outer(column).alias("_pos", "_entry"))
    pairs = table.select(F.col(source).alias("_entry"), F.col(target).alias("_target")).distinct()
    value = F.coalesce("_target", "_entry") if keep_unmapped else F.col("_target")
    hits = F.filter(F.array_sort(F.collect_list(F.struct("_pos", value.alias("v")))),
                    lambda x: x["v"].isNotNull())
    return (
        entries.join(pairs, "_entry", "left").groupBy(key)
        .agg(F.transform(hits, lambda x: x["v"]).alias(out))
    )


def id_name_pairs(columns: Sequence[str]) -> list[str]:
    """Base names that have both a ``_id`` and a ``_name`` column."""
    return [c[:-3] for c in columns if c.endswith("_id") and f"{c[:-3]}_name" in columns]


def extract_dimensions(df: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Distinct (dimension, id, name) over all id/name column pairs, in one pass.

    An id with several names keeps the first in name order. Location names
    become ISO-3 codes where ``countries`` knows them.
    """
    entries = F.array(*[
        F.struct(F.lit(base).alias("dimension"), F.col(f"{base}_id").cast("bigint").alias("id"),
                 F.col(f"{base}_name").alias("name"))
        for base in id_name_pairs(df.columns)
    ])
    # Distinct rows first: they are hashed map-side, so few reach the minimum over names.
    rows = df.select(F.inline(entries)).distinct() \
             .groupBy("dimension", "id").agg(F.min("name").alias("name"))
    if countries is None:
        return rows
    places = F.col("dimension") == "location"
    found = lookup_when(rows, places, "name", countries, "name", ["iso3"])
    return found.select("dimension", "id", F.coalesce("iso3", "name").alias("name"))


def static_rows(spark: SparkSession, pairs: Mapping, dimension: str) -> DataFrame:
    """A small fixed map as (id, name, dimension) rows."""
    rows = [(str(k), str(v), dimension) for k, v in pairs.items()]
    return spark.createDataFrame(rows, "id string, name string, dimension string")


def append_swapped(metadata: DataFrame, other: DataFrame, dimension: str = "location",
                   new_dimension: str = "gho_ihme_country") -> DataFrame:
    """Add the (name, id) of ``other``'s locations as (id, name) of a new dimension.

    Rows already present are not added again.
    """
    swapped = other.filter(F.col("dimension") == dimension).select(
        F.col("name").cast("string").alias("id"), F.col("id").cast("string").alias("name"),
        F.lit(new_dimension).alias("dimension"))
    fresh = swapped.join(metadata, ["dimension", "id"], "left_anti")
    return metadata.unionByName(first_per_key(fresh, ["dimension", "id"], [F.col("name")]))


def with_matching(df: DataFrame, pattern: str, kind: str,
                  change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to every column of type ``kind`` whose name matches ``pattern``."""
    import re

    chosen = re.compile(pattern)
    return df.select(*[
        change(F.col(f"`{name}`")).alias(name) if dtype == kind and chosen.search(name)
        else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ])


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in its order; scalars are cast, failing casts give null."""
    nested = ("array", "struct", "map")
    return df.select(*[
        F.col(f.name) if f.dataType.simpleString().startswith(nested)
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def distinct_sets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the sorted distinct values of each column."""
    return df.agg(*[F.array_sort(F.collect_set(c)).alias(f"available_{c}") for c in columns])


def with_parent(df: DataFrame, code: str, name: str, parent: str) -> DataFrame:
    """Add the parent's name to each row of a code table; the parent code if unknown."""
    parents = df.select(F.col(code).alias("_parent"), F.col(name).alias("_parent_name"))
    return (
        df.join(parents, F.col(parent) == F.col("_parent"), "left")
        .withColumn("parent_name", F.coalesce("_parent_name", parent))
        .drop("_parent", "_parent_name")
    )
