"""Small lookups as one value, applied to lists inside the row: no join, and no regrouping of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.sizing import Bound

#: A lookup that travels with the plan to every task.
IN_PLACE = Bound(max_rows=20_000, max_bytes=1024 * 1024)
#: Keys in one bucket of a lookup; a bucket is searched from its start.
BUCKET_KEYS = 8


def in_place(table: DataFrame, key: str, value: str, bound: Bound = IN_PLACE) -> Callable[[Column], Column] | None:
    """A function from a key to its sorted distinct values, as structs with a field ``v``; null for an unknown key.

    The table is counted first; None if it is not within ``bound``. Its pairs
    become one constant, an array of maps that are found by a hash of the key.
    Keys are compared as text. Rows without a key are left out; a null value is
    a value.
    """
    pairs = table.select(F.col(key).cast("string").alias("k"), F.col(value).alias("v")).where("k IS NOT NULL").distinct()
    rows = bound.rows_within(pairs)
    if rows is None:
        return None
    buckets = max(1, rows // BUCKET_KEYS)

    def bucket(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int")

    listed = pairs.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("v"))).alias("values"))
    maps = listed.groupBy(bucket(F.col("k")).alias("at")).agg(F.map_from_entries(F.collect_list(F.struct("k", "values"))).alias("held"))
    # A subquery may not stand inside a lambda, so what is within the bound becomes a literal.
    held = dict(maps.select("at", F.to_json("held")).collect())
    kind = f"array<map<string, array<struct<v: {pairs.schema['v'].dataType.simpleString()}>>>>"
    whole = F.from_json(F.lit("[" + ",".join(held.get(at, "{}") for at in range(buckets)) + "]"), kind)
    return lambda k: F.try_element_at(F.get(whole, bucket(k.cast("string"))), k.cast("string"))


def mapped(entries: Column, find: Callable[[Column], Column], change: Callable[[Column, Column], Column]) -> Column:
    """The concatenation, over all entries, of ``change(entry, v)`` for each value found; ``v`` is null where there is none."""
    def each(entry: Column) -> Column:
        found = F.coalesce(find(entry), F.array(F.struct(F.lit(None).alias("v"))))
        return F.transform(found, lambda one: change(entry, one["v"]))
    return F.flatten(F.transform(entries, each))
