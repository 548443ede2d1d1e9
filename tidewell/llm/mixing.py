"""Mix sources to target weights by weighted fair queueing.

Every document waits in its source's queue in shuffled order, once per pass.
Its virtual finish time is the number of source tokens up to and with it,
divided by the source's target. All queues are served in the order of finish
times until the total budget is spent, so that each source comes near its
target together with all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut_lineage

#: Weights of the sources by code point, repeating; the mix's size and a document's most copies.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
PASSES = 2


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of rows (source, size).

    The budget is shared by weight; a target stops at PASSES times its source's
    size and what is over is shared anew. The level at which that settles is
    the highest that any number of full sources leaves to the rest. One row per
    source meets in one task.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", F.get(weights, (F.row_number().over(ordered) - 1) % len(WEIGHTS)).alias("weight"))
    everything = Window.partitionBy()
    before = (Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("source_size").over(everything)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * PASSES
    shares = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = sources.withColumn("level", (total * BUDGET - full) / shares)
    return level.select("source", "source_size", F.least(
        (F.col("source_size") * PASSES).cast("double"), F.max("level").over(everything) * F.col("weight")).alias("target"))


def _running(rows: DataFrame, within: list[str], order: list, size: str, into: str) -> DataFrame:
    """Running sum of ``size`` over ``order``, in each group of ``within`` (columns that ``order`` begins with).

    The rows are dealt into ranges, so that a group may fill any number of
    tasks; sums of the ranges, one row per range and group, are carried over.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(rows.repartitionByRange(n, *order).withColumn("range_no", F.spark_partition_id()))
    here = Window.partitionBy("range_no", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    past = Window.partitionBy(*within).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ranged.groupBy("range_no", *within).agg(F.sum(size).alias("range_sum"))
               .select("range_no", *within, F.coalesce(F.sum("range_sum").over(past), F.lit(0)).alias("carried")))
    same = F.lit(True)
    for c in ["range_no", *within]:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
    return (ranged.withColumn("here", F.sum(size).over(here)).alias("r").join(carried.alias("c"), same)
            .select("r.*", (F.col("c.carried") + F.col("r.here")).alias(into)).drop("here", "range_no"))


def mix_sources(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the document in the mix, repeats counted).

    Size is the number of ``[^\\x20\\x09-\\x0D]+`` in the text; null and empty
    texts have size 0 and take nothing. Whole documents are taken, none more
    than PASSES times; the one at which the budget ends is taken if at least
    half of it fits. The shuffle is a hash of doc_id and pass, so reruns agree.
    Rows equal in doc_id, source and size move together. Null doc_ids and null
    sources are values like others, the null source the last. No rows give no
    rows. Other columns do not matter.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text")).alias("size"))
    items = cut_lineage(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")))
    targets = cut_lineage(source_targets(items.select("source", (F.col("size") * F.col("copies")).alias("size"))))
    joined = items.alias("i").join(F.broadcast(targets).alias("t"), F.col("i.source").eqNullSafe(F.col("t.source"))).select(
        "i.*", "t.source_size", "t.target")
    queued = (joined.where("size > 0").withColumn("pass", F.explode(F.array(*map(F.lit, range(PASSES)))))
              .withColumn("place", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("pass").cast("string"))))
              .withColumn("words", F.col("size") * F.col("copies")))
    own = [F.col("source").asc_nulls_last(), F.col("pass"), F.col("place"), F.col("size")]
    finish = _running(queued, ["source"], own, "words", "served").withColumn("finish", F.col("served") / F.col("target"))
    served = _running(finish, [], [F.col("finish"), *own], "words", "running")
    all_words = targets.agg(F.sum("source_size")).first()[0] or 0
    taken = (served.where(F.col("running") * 2 - F.col("words") <= F.lit(all_words * 2 * BUDGET))
             .groupBy("doc_id", "source", "size").agg(F.sum("size").alias("taken")))
    same = F.lit(True)
    for c in ("doc_id", "source", "size"):
        same = same & F.col(f"j.{c}").eqNullSafe(F.col(f"k.{c}"))
    return joined.alias("j").join(taken.alias("k"), same, "left").select(
        "j.doc_id", "j.source", "j.size", "j.source_size", "j.target",
        F.coalesce("k.taken", F.lit(0)).alias("taken"),
        F.explode(F.array_repeat(F.lit(0), F.col("j.copies").cast("int"))).alias("copy")).drop("copy")


def repeat_as_taken(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` (of ``mix_sources``) takes them, columns as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumns({
        "own_id": F.col("row.doc_id").cast("long"), "own_source": F.col("row.source").cast("string"), "own_size": word_count(F.col("row.text"))})
    times = mix.where("taken > 0").groupBy("doc_id", "source", "size").agg(F.max(F.expr("taken div size")).cast("int").alias("times"))
    same = (rows.own_id.eqNullSafe(times.doc_id) & rows.own_source.eqNullSafe(times.source) & (rows.own_size == times.size))
    return rows.join(times, same).select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("row.*")
