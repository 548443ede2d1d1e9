"""Versioned upsert with provenance, and the dimension and fact variants of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.session import cut_lineage

STATUS = "_status"
NEW, UPDATED, SOURCE_ONLY, UNTOUCHED = "new", "updated", "source_only", "untouched"


def collapse_incoming(incoming: DataFrame, key: str, date_col: str, source_col: str | None = None,
                      tie_break: Sequence[str] = ()) -> DataFrame:
    """One incoming row per key: the newest one, with the sources of all of them.

    Ties go to the largest ``tie_break``, else to the largest row hash. Rows
    without a key are dropped.
    """
    names = incoming.columns
    ties = [F.col(c) for c in tie_break] or [F.xxhash64(*[F.col(f"`{c}`") for c in names])]
    wanted = [c for c in names if c not in (key, source_col, "first_seen_at", "last_seen_at")]
    aggs = [F.max_by(F.struct(*wanted), F.struct(F.col(date_col), *ties)).alias("_row")]
    if source_col:
        aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(source_col))))
                    .alias(source_col))
    if "first_seen_at" in names:
        aggs.append(F.min("first_seen_at").alias("first_seen_at"))
    if "last_seen_at" in names:
        aggs.append(F.max("last_seen_at").alias("last_seen_at"))
    return (
        incoming.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
        .select("*", "_row.*").select(*names)
    )


def merge_with_status(existing: DataFrame, incoming: DataFrame, key: str, date_col: str,
                      source_col: str | None = None) -> DataFrame:
    """Upsert with a ``_status`` column: new, updated, source_only or untouched.

    ``existing`` and ``incoming`` hold one row per key. The result has the
    columns of ``existing``. Rules per key:

    * only incoming: incoming content, version 1;
    * incoming date later than stored (or stored date null): incoming content,
      version + 1, sources united;
    * incoming date not later: stored content, sources united, last_seen_at moves;
    * no incoming row or no incoming date: nothing changes.
    """
    old = existing.select(F.col(key), F.struct(*existing.columns).alias("o"))
    new = incoming.select(F.col(key), F.struct(*incoming.columns).alias("i"))
    both = old.join(new, key, "full")

    stored, arriving = F.col(f"o.{date_col}"), F.col(f"i.{date_col}")
    status = (
        F.when(F.col("o").isNull(), NEW)
        .when(F.col("i").isNull() | arriving.isNull(), UNTOUCHED)
        .when(stored.isNull() | (arriving > stored), UPDATED)
        .otherwise(SOURCE_ONLY)
    )
    both = both.withColumn(STATUS, status)
    is_new = F.col(STATUS) == NEW
    replaces = F.col(STATUS).isin(NEW, UPDATED)
    touched = F.col(STATUS) != UNTOUCHED

    def column(name: str) -> Column:
        before = F.col(f"o.`{name}`")
        if name == key:
            return F.col(key)
        if name == "version":
            kind = existing.schema["version"].dataType
            return F.when(is_new, F.lit(1)).when(F.col(STATUS) == UPDATED, before + 1) \
                    .otherwise(before).cast(kind)
        if name not in incoming.columns:
            return before
        after = F.col(f"i.`{name}`")
        if name == "first_seen_at":
            return F.when(is_new, after).otherwise(before)
        if name == "last_seen_at":
            return F.when(touched, after).otherwise(before)
        if name == source_col:
            empty = F.array().cast(existing.schema[name].dataType)
            united = F.array_union(F.coalesce(before, empty), F.coalesce(after, empty))
            return F.when(touched, united).otherwise(before)
        return F.when(replaces, after).otherwise(before)

    return both.select(*[column(c).alias(c) for c in existing.columns], STATUS)


def upsert_by_date(existing: DataFrame | None, incoming: DataFrame, key: str, date_col: str,
                   source_col: str | None = None, tie_break: Sequence[str] = (),
                   unique_incoming: bool = False) -> DataFrame:
    """Merge ``incoming`` into ``existing``; see :func:`merge_with_status`.

    Pass ``unique_incoming=True`` to skip the reduction to one row per key.
    """
    if not unique_incoming:
        incoming = collapse_incoming(incoming, key, date_col, source_col, tie_break)
    if existing is None:
        return incoming
    return merge_with_status(existing, incoming, key, date_col, source_col).drop(STATUS)


def status_counts() -> list[Column]:
    """Aggregates over ``_status``; also usable with ``DataFrame.observe``."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(STATUS) == NEW).alias("new"),
        F.count_if(F.col(STATUS) == UPDATED).alias("updated"),
        F.count_if(F.col(STATUS) == SOURCE_ONLY).alias("source_only"),
    ]


def upsert_stats(merged: DataFrame) -> DataFrame:
    """One row: total, new, updated, source_only."""
    return merged.agg(*status_counts())


def upsert_dim(old: DataFrame, new: DataFrame, keys: Sequence[str],
               overwrite: Sequence[str], keep_if_null: Sequence[str] = ()) -> DataFrame:
    """Insert or update a dimension.

    ``overwrite`` columns take the new value, ``keep_if_null`` columns take it
    unless it is null; all other columns of an existing row stay.
    """
    a = old.withColumn("_in_old", F.lit(True)).alias("a")
    b = new.withColumn("_in_new", F.lit(True)).alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    has_old, has_new = F.col("a._in_old").isNotNull(), F.col("b._in_new").isNotNull()

    def column(name: str) -> Column:
        before = F.col(f"a.{name}")
        if name not in new.columns:
            return before
        after = F.col(f"b.{name}")
        if name in keys:
            return F.coalesce(before, after)
        if name in overwrite:
            return F.when(has_new, after).otherwise(before)
        if name in keep_if_null:
            return F.coalesce(after, before)
        return F.when(has_old, before).otherwise(after)

    return a.join(b, on, "full").select(*[column(c).alias(c) for c in old.columns])


def insert_missing(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows plus the new rows whose key is absent."""
    fresh = new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def upsert_fact(old: DataFrame, new: DataFrame, keys: Sequence[str], measures: Sequence[str],
                loaded_at: Column) -> DataFrame:
    """Insert or update facts: measures overwritten, ``loaded_at`` set on change."""
    a = old.select(*keys, F.struct(*old.columns).alias("o"))
    b = new.select(*keys, F.struct(*measures).alias("n"))
    both = a.join(b, list(keys), "full")
    arrived = F.col("n").isNotNull()

    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        before = F.col(f"o.`{name}`")
        if name in measures:
            return F.when(arrived, F.col(f"n.`{name}`")).otherwise(before)
        if name == "loaded_at":
            return F.when(arrived, loaded_at).otherwise(before)
        return before

    return both.select(*[column(c).alias(c) for c in old.columns])


def enrich_fact(fact: DataFrame, values: DataFrame, key: str, column: str,
                reset: bool = False) -> DataFrame:
    """Set ``column`` from ``values`` (one row per key).

    Rows without a match keep their value, or lose it with ``reset``.
    """
    found = values.select(key, F.col(column).alias("_value"), F.lit(True).alias("_hit"))
    joined = fact.join(found, key, "left")
    before = F.lit(None) if reset or column not in fact.columns else F.col(column)
    kept = [c for c in fact.columns if c != column]
    return joined.select(
        *kept, F.when(F.col("_hit"), F.col("_value")).otherwise(before).alias(column)
    )


def assign_keys(df: DataFrame, old: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Number rows that are not in ``old`` from ``max(key) + 1`` on, without gaps, in the order of ``natural``.

    Rows are dealt into ranges and numbered inside each; a range starts where
    the counts of the ranges before it end, one row per range. Existing rows
    keep their key. ``df`` holds one row per natural key.
    """
    known = old.select(*natural, F.col(key).cast("bigint").alias("_old"))
    tagged = df.drop(key).join(known, list(natural), "left")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that a row stays in its range if a task runs again.
    fresh = cut_lineage(tagged.where("_old IS NULL").repartitionByRange(ranges, *natural).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = fresh.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    top = old.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).scalar()
    numbered = fresh.withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy(*natural))).join(
        F.broadcast(starts), "_range").withColumn(key, (top + F.col("_start") + F.col("_rank")).cast("bigint"))
    columns = [key, *[c for c in df.columns if c != key]]
    return numbered.select(*columns).unionByName(tagged.where("_old IS NOT NULL").withColumn(key, F.col("_old")).select(*columns))
