"""Exact top-k by inner product in three phases with a uniform threshold.

Components are split into parts; each part of each tile of vectors is a list of
local scores, and a vector's score is the sum over its parts. (1) Each list
sends its highest k; their exact sums give a score that k vectors surely reach.
(2) Whoever reaches it reaches its share, the cutoff divided by the number of
parts, in some list: lists send all entries from there on. (3) What was sent is
resolved by the scores of the other parts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut_lineage

#: Parts of a vector; vectors in a tile; queries in a group (what a task holds: about 1 MB each at 64 components).
PARTS = 2
TILE = 2_048
GROUP = 2_048


def whole_components(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or holds a null or non-finite one.

    Components beyond 64 bits are the nearest number of 64 bits.
    """
    edge = float((1 << 63) - 1024)
    scaled = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-edge)), F.lit(edge))))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(F.coalesce(sound, F.lit(False)), scaled)


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of one tile or group as matrices: ids, components (parts of equal width), and cutoffs where there are any."""
    pdf = pdf.sort_values("id")
    matrix = np.stack(pdf["part"].to_numpy()).astype(np.int64)
    cutoffs = pdf["cutoff"].astype(np.float64).fillna(-np.inf).to_numpy()
    return pd.DataFrame({"no": [pdf["no"].iloc[0]], "list": [pdf["list"].iloc[0]], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                         "matrix": [matrix.tobytes()], "cutoffs": [cutoffs.tobytes()]})


def _packed(rows: DataFrame, size: int, count: int) -> DataFrame:
    """(no, list, ids, matrix, cutoffs) of (id, parts, cutoff): about ``size`` rows of one list in each."""
    lists = rows.select("id", "cutoff", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-count // size)))).alias("no"),
                        F.posexplode("parts").alias("list", "part"))
    return lists.groupBy("no", "list").applyInPandas(_pack, "no long, list int, ids binary, matrix binary, cutoffs binary")


def _scored(tiles: DataFrame, groups: DataFrame, n_groups: int, n_tiles: int, k: int | None) -> DataFrame:
    """Entries (query_id, id, list, score) of every list: its ``k`` highest, or all that reach the query's cutoff.

    Tiles meet groups of queries as whole matrices, each pair in some task.
    Scores are null where products are too large for exact floats: such lists
    send what may reach the cutoff, give or take the rounding.
    """
    width = max(16, n_tiles // 4)
    tiled = tiles.select("list", F.pmod("no", F.lit(width)).alias("lane"), "ids", "matrix",
                         F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)).cast("array<long>")).alias("group"))
    asked = groups.select(F.col("no").alias("group"), "list", F.col("ids").alias("query_ids"), F.col("matrix").alias("queries"), "cutoffs",
                          F.explode(F.sequence(F.lit(0), F.lit(width - 1)).cast("array<long>")).alias("lane"))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in ("list", "ids", "matrix", "query_ids", "queries", "cutoffs")}
                ids, queries = np.frombuffer(get["ids"], np.int64), np.frombuffer(get["query_ids"], np.int64)
                a = np.frombuffer(get["queries"], np.int64).reshape(len(queries), -1).astype(np.float64)
                b = np.frombuffer(get["matrix"], np.int64).reshape(len(ids), -1).T.astype(np.float64)
                exact = len(b) * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 1 << 53
                cutoffs = np.frombuffer(get["cutoffs"], np.float64) / PARTS
                for start in range(0, len(queries), 256):
                    some = a[start: start + 256]
                    scores = some @ b
                    if k is None:
                        slack = 0 if exact else (np.abs(some) @ np.abs(b)) * (len(b) + 8) * 2.0 ** -52
                        q, v = np.nonzero((scores + slack >= cutoffs[start: start + 256, None]) & (queries[start: start + 256, None] != ids))
                    else:
                        best = np.argpartition(-scores, min(k, len(ids) - 1), axis=1)[:, : k + 1]
                        q, v = np.repeat(np.arange(len(some)), best.shape[1]), best.ravel()
                        other = queries[start + q] != ids[v]
                        q, v = q[other], v[other]
                    found = pa.array(scores[q, v].astype(np.int64)) if exact else pa.nulls(len(q), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(queries[start + q]), pa.array(ids[v]), pa.array(np.full(len(q), get["list"], np.int32)), found],
                        names=["query_id", "id", "list", "score"])

    return (tiled.join(asked, ["list", "group", "lane"]).select("list", "ids", "matrix", "query_ids", "queries", "cutoffs")
            .mapInArrow(run, "query_id long, id long, list int, score long"))


def _resolved(entries: DataFrame, vectors: DataFrame, queries: DataFrame, components: int) -> DataFrame:
    """(query_id, id, vec_id, score) of every vector that was sent, missing parts computed; scores are exact decimals."""
    sent = entries.groupBy("query_id", "id").agg(F.map_from_entries(F.collect_set(F.struct("list", "score"))).alias("known"))
    asking = queries.select(F.col("id").alias("query_id"), F.col("vec_id").alias("query_vec_id"), F.col("parts").alias("asked"), F.col("largest").alias("asked_largest"))
    joined = sent.join(vectors.select("id", "vec_id", "parts", "largest"), "id").join(asking, "query_id")
    small = F.col("largest").cast("double") * F.col("asked_largest").cast("double") * components < float(1 << 62)

    def product_sum(i, kind):
        products = F.zip_with(F.col("parts")[i], F.col("asked")[i], lambda x, y: (x.cast(kind) * y.cast(kind)))
        total = "long" if kind == "long" else "decimal(38,0)"
        return F.aggregate(products, F.lit(0).cast(total), lambda s, x: (s + x).cast(total)).cast("decimal(38,0)")

    def part(i):
        computed = F.when(small, product_sum(i, "long")).otherwise(product_sum(i, "decimal(19,0)"))
        return F.coalesce(F.try_element_at("known", F.lit(i)).cast("decimal(38,0)"), computed)

    total = sum((part(i) for i in range(1, PARTS)), part(0)).cast("decimal(38,0)")
    return joined.select("query_id", "query_vec_id", "id", "vec_id", total.alias("score"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` other rows of highest integer inner product for each query row.

    ``vectors`` has vec_id and embedding; components become floor(1024 * x).
    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without a vec_id. Every other row is a candidate of every query
    but itself: rows that repeat a vec_id, or all of a row, count one by one,
    and each query row among them has its own ranks. Ties go to the smaller
    vec_id. Components beyond the shorter of two vectors count as 0. Fewer than
    k others give fewer rows; no other columns matter.

    Sums are exact: in floats where these hold them, in 64 bits or decimals of
    38 digits where they do not. Components so large that the sum of their
    products could need more digits (over 10^18 for 100 components) count as
    the largest that cannot. Ranks follow exact scores; a score beyond 64 bits
    is returned as the nearest number of 64 bits.
    """
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_components(F.col("embedding")).alias("whole"),
                         F.coalesce(is_query, F.lit(False)).alias("asks")).where("vec_id IS NOT NULL AND whole IS NOT NULL")
    # Numbers of rows are fixed once they are written.
    own = cut_lineage(own.withColumn("id", F.monotonically_increasing_id()))
    size = own.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("whole"))).first()
    count, n_queries, longest = size[0], size[1], max(PARTS, size[2] or 0)
    width = -(-longest // PARTS)
    edge = min((1 << 63) - 1024, math.isqrt(10 ** 38 // (width * PARTS)) - 1)
    whole = F.transform("whole", lambda x: F.least(F.greatest(x, F.lit(-edge)), F.lit(edge)))
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(width * PARTS) - F.size("whole")))
    rows = own.select("id", "vec_id", "asks", F.array(*[F.slice(filled, 1 + i * width, width) for i in range(PARTS)]).alias("parts"),
                      F.coalesce(F.array_max(F.transform(whole, F.abs)), F.lit(0)).alias("largest"), F.lit(None).cast("double").alias("cutoff"))
    queries = rows.where("asks")
    n_groups, n_tiles = max(1, -(-n_queries // GROUP)), max(1, -(-count // TILE))
    tiles = cut_lineage(_packed(rows, TILE, count))
    first = _resolved(_scored(tiles, _packed(queries, GROUP, n_queries), n_groups, n_tiles, k), rows, queries, width * PARTS)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "id")
    place = F.row_number().over(order)
    reached = F.col("score").cast("double")
    cutoffs = (first.withColumn("place", place).where(F.col("place") == k)
               .select(F.col("query_id").alias("id"), (reached - F.abs(reached) * 2.0 ** -50).alias("cutoff")))
    informed = queries.drop("cutoff").join(cutoffs, "id", "left")
    entries = _scored(tiles, _packed(informed, GROUP, n_queries), n_groups, n_tiles, None)
    score = F.least(F.greatest("score", F.lit(-(1 << 63) + 1).cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    return (_resolved(entries, rows, queries, width * PARTS).withColumn("rank", place).where(F.col("rank") <= k)
            .select(F.col("query_vec_id").alias("query_id"), "rank", "vec_id", score.alias("score")))
