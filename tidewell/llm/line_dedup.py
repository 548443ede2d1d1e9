"""Lines that repeat across documents stay in one document only.

The distinct hashes of repeated lines are indexed once: shards of a minimal
perfect hash over arrays of fingerprints, document counts and last holders.
Documents send only hashes of their lines to the shards and get back the line
numbers to drop; no line text is shuffled or joined.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import perfect_hash
from tidewell.session import cut_lineage

#: Repeated lines in one shard: about 2 MB of arrays.
SHARD_KEYS = 65_536

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INDEX = ["words", "ranks", "sizes", "prints", "counts", "holders", "held"]


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Hashes of every line long enough: doc_id, text hash, line number, two hashes of the line's key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id", F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(F.translate(text, _UPPER, _LOWER), "\n", -1)).alias("line_no", "line"),
    )
    key = F.btrim("line", F.lit(_BLANKS))
    return split.where(F.char_length(key) >= min_chars).select(
        "doc_id", "text_hash", "line_no", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """h1, h2, n_docs, holder (largest doc_id) of every line key found in ``min_docs`` documents or more."""
    held = _lines(docs, min_chars).groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    return (held.groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("holder"))
            .where(F.col("n_docs") >= min_docs))


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    h1 = pdf["h1"].to_numpy(np.int64).view(np.uint64)
    h2 = pdf["h2"].to_numpy(np.int64).view(np.uint64)
    words, ranks, sizes = perfect_hash.build(h1, h2)
    order = np.empty(len(h1), np.int64)
    order[perfect_hash.slots(words, ranks, sizes, h1, h2)] = np.arange(len(h1))
    holders = pdf["holder"].fillna(0).to_numpy(np.int64)[order]
    held = pdf["holder"].notna().to_numpy()[order]
    arrays = [words, ranks, sizes, h2[order], pdf["n_docs"].to_numpy(np.int64)[order].astype(np.uint32), holders, held]
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "load": [int(pdf["n_docs"].sum())],
                         **{name: [a.tobytes()] for name, a in zip(_INDEX, arrays)}})


def build_index(repeated: DataFrame, n_shards: int) -> DataFrame:
    """One row of arrays per shard; shard, load (documents that hold its lines) and the arrays."""
    return (repeated.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int")).groupBy("shard")
            .applyInPandas(_build_shard, "shard int, load long, " + ", ".join(f"{c} binary" for c in _INDEX)))


def _probe(batches):
    """Rows of a partition by shard, the arrays before the lines that ask for them."""
    dtypes = dict(zip(_INDEX, (np.uint64, np.uint32, np.uint32, np.uint64, np.uint32, np.int64, np.bool_)))
    loaded, arrays = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(shards)]):
            part = batch.slice(start, end - start)
            built = np.flatnonzero(part.column("words").is_valid().to_numpy(zero_copy_only=False))
            if len(built):
                row = int(built[0])
                arrays = {c: np.frombuffer(part.column(c)[row].as_py(), t) for c, t in dtypes.items()}
                loaded = shards[start]
            if loaded != shards[start]:
                continue
            part = part.filter(part.column("words").is_null())
            if not part.num_rows:
                continue
            h1 = part.column("h1").to_numpy().view(np.uint64)
            h2 = part.column("h2").to_numpy().view(np.uint64)
            slot = perfect_hash.slots(arrays["words"], arrays["ranks"], arrays["sizes"], h1, h2)
            hit = (slot >= 0) & (arrays["prints"][slot] == h2)
            ids, known = part.column("doc_id").fill_null(0).to_numpy(), part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            stays = (arrays["held"][slot] == known) & ((arrays["holders"][slot] == ids) | ~known)
            yield part.select(["doc_id", "text_hash", "line_no"]).filter(pa.array(hit & ~stays))


def _dropped(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """doc_id, text_hash and the numbers of the lines that go."""
    spark = docs.sparkSession
    repeated = cut_lineage(repeated_lines(docs, min_chars, min_docs))
    n_shards = max(1, -(-repeated.count() // SHARD_KEYS))
    index = cut_lineage(build_index(repeated, n_shards))
    # One row per shard. A shard whose lines fill many documents is asked by as many tasks.
    even = max(1, (index.agg(F.sum("load")).first()[0] or 0) // (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    index = index.withColumn("tasks", F.ceil(F.col("load") / even) + 4)
    asked = (
        _lines(docs, min_chars).withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int"))
        .join(F.broadcast(index.select("shard", "tasks")), "shard")
        .withColumn("task", F.pmod(F.xxhash64("doc_id", "line_no"), "tasks"))
    )
    told = index.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    rows = (asked.unionByName(told, allowMissingColumns=True).repartition("shard", "task")
            .sortWithinPartitions("shard", F.col("words").isNull()))
    return (rows.select("shard", "doc_id", "text_hash", "line_no", "h1", "h2", *_INDEX)
            .mapInArrow(_probe, "doc_id long, text_hash long, line_no int")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("dropped")))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``row`` (the input row), ``n_lines``, ``n_dropped`` and ``kept`` (the text left) per document.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with
    A-Z in lower case. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` documents go, all lines of them, except in the largest
    doc_id that holds the key. Null text is empty: one empty line. Documents
    are told apart by doc_id; null doc_ids count as one document, the smallest.
    Repeated rows are treated alike. Columns of the input stay inside ``row``,
    so no name can clash. An empty table gives an empty result.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dropped = _dropped(own, min_chars, min_docs)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumns(
        {"own_id": F.col("row.doc_id").cast("long"), "own_hash": F.xxhash64(text)})
    lines = F.split(text, "\n", -1)
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    return (
        rows.join(dropped, rows.own_id.eqNullSafe(dropped.doc_id) & (rows.own_hash == dropped.text_hash), "left")
        .select(
            "row", F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
            # The outer transform holds the split lines, which the inner one would split anew for every number.
            F.when(F.col("dropped").isNull(), text).otherwise(F.transform(F.array(lines), lambda held: F.array_join(
                F.transform(F.array_except(numbers, "dropped"), lambda i: F.get(held, i)), "\n"))[0]).alias("kept"),
        )
    )
