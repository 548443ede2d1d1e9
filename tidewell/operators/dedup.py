"""One row per key: latest, first, and first across overlapping sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.session import cut_lineage


def _as_columns(columns: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order`` (sort columns, nulls as they say).

    ``row_number() = 1`` is cut to one row per key before the shuffle, so a
    key that holds most rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], date_col: str,
                   tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Newest row of each key; ties by ``tie_break`` descending, else by a row hash."""
    ties = _as_columns(tie_break) or [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    return first_per_key(df, keys, [F.col(date_col).desc_nulls_last(), *[t.desc() for t in ties]])


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                    k: int) -> DataFrame:
    """The first ``k`` rows of each group in ``order``."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order``."""
    return df.orderBy(*order).limit(k)


def dedup_first(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``; rows without a key all stay."""
    keyed = first_per_key(df.filter(F.col(key).isNotNull()), [key], order)
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def keep_first(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows win over new rows of the same key; sorted by key."""
    both = old.withColumn("_origin", F.lit(0)).unionByName(new.withColumn("_origin", F.lit(1)))
    rest = [F.col(c).asc_nulls_last() for c in old.columns if c not in keys]
    return first_per_key(both, keys, [F.col("_origin"), *rest]).drop("_origin").orderBy(*keys)


def merge_categories(df: DataFrame, key: str, category: str,
                     order: Sequence[Column]) -> DataFrame:
    """One row per key: fields of the first row, categories of all rows.

    ``category`` is a text column; the result holds the sorted distinct list.
    """
    rest = [c for c in df.columns if c not in (key, category)]
    return (
        df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(key)
        .agg(
            F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"),
            F.array_sort(F.collect_set(category)).alias(category),
        )
        .select(key, "_first.*", category)
    )


#: Share of the open rows that a round has to settle, or else chains of waiting rows are followed to their ends.
ENOUGH = 0.125


def dedup_id_or_url(df: DataFrame, id_col: str, url_col: str, order: Sequence[str]) -> DataFrame:
    """Rows a first-come reader would keep: a row is dropped if an earlier kept
    row has its id or its url. Empty ids and urls count as absent. ``order``
    must be unique.

    Works in rounds, each written to the shared folder. A round keeps the rows
    that come first under both of their keys and drops what these cover. Where
    that settles too few rows, they wait for each other in long chains, which
    :func:`_follow_chains` contracts by doubling, so that rounds grow with the
    logarithm of a chain. No group of rows meets in one task: of each key its
    first two rows are enough.
    """
    def present(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name).cast("string"))

    # Of the copies of one (id, url) pair only the first can ever be kept.
    rows = df.withColumn("_ord", F.struct(*order)).withColumn("_id", present(id_col)).withColumn("_url", present(url_col))
    bare = rows.filter(F.col("_id").isNull() & F.col("_url").isNull()).select("_ord")
    pairs = cut_lineage(rows.filter(F.col("_id").isNotNull() | F.col("_url").isNotNull())
                        .groupBy("_id", "_url").agg(F.min("_ord").alias("_ord")))
    winners = reduce(DataFrame.unionByName, [bare, *_settle_in_rounds(pairs)])
    return rows.join(winners, "_ord", "left_semi").drop("_ord", "_id", "_url")


def _settle_in_rounds(open_rows: DataFrame) -> list[DataFrame]:
    """``_ord`` of the rows kept, one table per round."""
    kept, count, follow = [], open_rows.count(), False
    while count:
        first = _first_in_line(open_rows)
        if follow:
            first = cut_lineage(first)
            won = first.where("waits_for IS NULL").drop("waits_for").unionByName(_follow_chains(first))
        else:
            won = first.where("waits_for IS NULL").drop("waits_for")
        for key in ("_id", "_url"):
            # Rows without this key are dealt out by their order, not all to one task.
            lane = F.when(F.col(key).isNull(), F.xxhash64("_ord")).otherwise(F.lit(0).cast("long"))
            covered = won.filter(F.col(key).isNotNull()).select(key, F.lit(0).cast("long").alias("_lane"))
            open_rows = open_rows.withColumn("_lane", lane).join(covered, [key, "_lane"], "left_anti").drop("_lane")
        settled = cut_lineage(won.withColumn("kept", F.lit(True)).unionByName(open_rows.select("_ord", "_id", "_url", F.lit(False).alias("kept"))))
        kept.append(settled.where("kept").select("_ord"))
        open_rows = settled.where("NOT kept").drop("kept")
        before, count = count, open_rows.count()
        follow = before - count < ENOUGH * before
    return kept


def _first_in_line(open_rows: DataFrame) -> DataFrame:
    """Rows that come first under both keys, and rows that come first under one and second under the other.

    The latter name in ``waits_for`` the row before them: they are kept exactly
    if that row is dropped.
    """
    def first_two(key: str, other: str) -> DataFrame:
        line = Window.partitionBy(key).orderBy("_ord")
        placed = open_rows.filter(F.col(key).isNotNull()).withColumn(f"at{key}", F.row_number().over(line)).where(F.col(f"at{key}") <= 2)
        return placed.withColumns({f"before{key}": F.first("_ord").over(line), f"at{other}": F.lit(None).cast("int"),
                                   f"before{other}": F.lit(None).cast(open_rows.schema["_ord"].dataType)})

    places = first_two("_id", "_url").unionByName(first_two("_url", "_id")).groupBy("_ord", "_id", "_url").agg(
        *[F.max(c).alias(c) for c in ("at_id", "at_url", "before_id", "before_url")])
    leads = {key: F.col(key).isNull() | F.coalesce(F.col(f"at{key}") == 1, F.lit(False)) for key in ("_id", "_url")}
    waits_for = F.when(leads["_id"] & (F.col("at_url") == 2), F.col("before_url")).when(leads["_url"] & (F.col("at_id") == 2), F.col("before_id"))
    return places.withColumn("waits_for", waits_for).where((leads["_id"] & leads["_url"]) | F.col("waits_for").isNotNull()).select(
        "_ord", "_id", "_url", "waits_for")


def _follow_chains(first: DataFrame) -> DataFrame:
    """The waiting rows at an even distance from a row that is kept, along the rows they wait for.

    Each step joins a row's pointer to the pointer found there, so distances
    double. A row is waited for by at most one other but for the chain's ends,
    and those at an end are joined no more.
    """
    ends = first.where("waits_for IS NULL").select(F.col("_ord").alias("to"), F.lit(True).alias("rooted"))
    links = first.where("waits_for IS NOT NULL").select("_ord", "_id", "_url", F.col("waits_for").alias("to"), F.lit(True).alias("odd"))
    links = cut_lineage(links.join(ends, "to", "left").withColumn("rooted", F.coalesce("rooted", F.lit(False))).withColumn("moves", ~F.col("rooted")))
    while not links.where("moves").isEmpty():
        there = links.select(F.col("_ord").alias("to"), F.col("to").alias("next"), F.col("odd").alias("next_odd"),
                             F.col("rooted").alias("next_rooted"), F.col("moves").alias("next_moves"))
        moved = links.where("moves").drop("rooted", "moves").join(there, "to", "left").select(
            "_ord", "_id", "_url", F.coalesce("next", "to").alias("to"), (F.col("odd") != F.coalesce("next_odd", F.lit(False))).alias("odd"),
            F.coalesce("next_rooted", F.lit(False)).alias("rooted"), F.coalesce("next_moves", F.lit(False)).alias("moves"))
        links = cut_lineage(links.where("NOT moves").unionByName(moved))
    return links.where("rooted AND NOT odd").select("_ord", "_id", "_url")
