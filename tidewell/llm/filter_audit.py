"""What each of several filters removes, in every order they could be applied in.

A document is a mask of the filters it fails; documents are counted per part
and mask. A walk over all sets of filters in Gray-code order toggles one filter
at a time and keeps, for each mask, how many active filters it fails; those
that fail none survive. Any step of any order is the difference of two sets.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrays import text_batches
from tidewell.llm.terms import split_terms
from tidewell.session import cut_lineage

FILTERS = "ABCDE"
BLANKS = r"[\x20\x09-\x0D]+"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
TEXT_BYTES = 1 << 21


def text_failures(texts: pa.Array) -> np.ndarray:
    """Which of the filters A to D each text fails, as bits from A = 1."""
    n = len(texts)
    owner, words = split_terms(texts, BLANKS)
    n_words = np.bincount(owner.to_numpy(), minlength=n)
    distinct = pa.table({"owner": owner, "code": words.indices}).group_by(["owner", "code"]).aggregate([]).column("owner")
    n_distinct = np.bincount(distinct.to_numpy(), minlength=n)
    capitals = pc.count_substring_regex(texts, "[A-Z]").to_numpy().astype(np.int64)
    chars = pc.utf8_length(texts).to_numpy().astype(np.int64)
    symbols = pc.match_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False)
    fails = [n_words < MIN_WORDS, 100 * n_distinct < DISTINCT_PERCENT * n_words, 100 * capitals > CAPITAL_PERCENT * chars, symbols]
    return sum(f.astype(np.int32) << bit for bit, f in enumerate(fails))


def _masks(batches):
    for batch in text_batches(batches, "text", TEXT_BYTES):
        texts = pc.fill_null(batch.column(2), "")
        digests = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.fill_null(batch.column(1), ""), pa.array(text_failures(texts), pa.int32()), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "mask", "digest"])


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask, copies: equal rows counted, with the bit of E where a smaller doc_id has the same text.

    Texts are the same if their SHA-256 digests are. Rows of one text reach the
    shuffles as one row per task, and meet the first row of their text by text
    and doc_id together, so a text that many rows share is no hot key.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    seen = cut_lineage(own.mapInArrow(_masks, "doc_id long, part string, mask int, digest binary")
                       .groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("copies")))
    firsts = seen.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "digest", F.lit(0).alias("repeats"))
    met = seen.where("doc_id IS NOT NULL").join(firsts, ["doc_id", "digest"], "left")
    masked = met.select("doc_id", "part", (F.col("mask") + F.coalesce("repeats", F.lit(1)) * 16).alias("mask"), "copies")
    return masked.unionByName(seen.where("doc_id IS NULL").select("doc_id", "part", "mask", "copies"))


def count_cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents per mask, and those labelled good or toxic; of several labels the highest counts."""
    known = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .where("good = 1 OR toxic = 1"))
    # Rows without an id have no label and stay out of the join.
    joined = masked.where("doc_id IS NOT NULL").join(known, "doc_id", "left").select("part", "mask", "copies", "good", "toxic")
    bare = masked.where("doc_id IS NULL").selectExpr("part", "mask", "copies", "0 AS good", "0 AS toxic")
    return joined.unionByName(bare).groupBy("part", "mask").agg(
        F.sum("copies").alias("n"), F.sum(F.col("copies") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("copies") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def walk_subsets(masks: np.ndarray, counts: np.ndarray, n_filters: int) -> np.ndarray:
    """Counts of the documents that survive each set of filters; row number = set as bits.

    One filter is toggled per step. ``failing`` says of each mask how many
    active filters it fails; masks that come to their first failure leave the
    running survivors, masks that lose their last one return.
    """
    states = np.zeros((1 << n_filters, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    surviving, active = counts.sum(axis=0), 0
    states[0] = surviving
    for step in range(1, 1 << n_filters):
        bit = (step & -step).bit_length() - 1
        active ^= 1 << bit
        hit = masks >> bit & 1 == 1
        if active >> bit & 1:
            surviving = surviving - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            surviving = surviving + counts[hit & (failing == 0)].sum(axis=0)
        states[active] = surviving
    return states


def _steps(table: pa.Table) -> pa.Table:
    """All orders and steps of one part, from its cells: 32 rows at most."""
    masks = table.column("mask").to_numpy().astype(np.int64)
    counts = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1).astype(np.int64)
    states = walk_subsets(masks, counts, len(FILTERS))
    orders = ["".join(o) for o in permutations(FILTERS)]
    bits = np.array([[FILTERS.index(c) for c in o] for o in orders])
    after = np.cumsum(1 << bits, axis=1)
    before = after - (1 << bits)
    removed, good_lost, toxic_lost = np.moveaxis(states[before] - states[after], -1, 0)
    fails = np.array([counts[masks >> b & 1 == 1, 0].sum() for b in range(len(FILTERS))])
    only = np.array([counts[masks == 1 << b, 0].sum() for b in range(len(FILTERS))])
    shapley = np.array([removed[bits == b].sum() for b in range(len(FILTERS))])
    flat = {"kept": states[after][..., 0], "removed": removed, "redundant": fails[bits] - removed, "unique_fails": only[bits],
            "good_lost": good_lost, "toxic_lost": toxic_lost, "shapley": shapley[bits]}
    steps = len(FILTERS)
    return pa.table({
        "part": pa.repeat(table.column("part")[0], bits.size), "filter_order": pa.array(np.repeat(orders, steps).tolist()),
        "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders))), **{k: v.ravel() for k, v in flat.items()}})


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs`` has doc_id, text and source; ``labels`` has doc_id, quality and
    toxic. A document fails A with under 200 words, B if under half of its
    words are distinct, C if over 2% of its characters are A-Z, D if it holds
    one of ``#$%&*|``, E if a row with a smaller doc_id has the same text. Parts
    are sources. For each part, each order of the five filters and each step
    there is one row: documents kept after the step, removed in it, failing its
    filter but removed earlier, failing only it, removed with label quality = 1
    or toxic = 1, and removed by its filter summed over all orders and steps.

    Null text is empty and a null source ''. A row without a doc_id has no label
    and neither fails E nor makes others fail; rows of one doc_id and text do
    not fail E by each other. Repeated rows count each time; of several labels
    of a document the highest counts. Other columns play no part. An empty
    table gives no rows; empty labels give zeros.
    """
    cells = count_cells(failure_masks(docs), labels)
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return cells.groupBy("part").applyInArrow(_steps, schema)
