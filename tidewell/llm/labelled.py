"""Labelled texts for fitting classifiers, and the held-out rows that are never among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on, at most.
SAMPLE_ROWS = 20_000


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all doc_ids that no model may learn from; null counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, label and text of up to ``rows`` labelled documents that are not held out.

    The documents are those with the lowest hash of doc_id, so reruns agree.
    Rows without a label or a doc_id teach nothing; of several labels of a
    document the highest counts.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most ``rows`` pairs of numbers.
    return own.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
