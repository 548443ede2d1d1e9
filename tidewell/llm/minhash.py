"""Near-duplicates by ProbMinHash sketches of weighted word shingles, banding and exact verification."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrays import flat_text, mix, shingle_hashes, text_batches
from tidewell.operators.graph import stars
from tidewell.session import cut_lineage

WORDS = 5
THRESHOLD = 0.8
#: Similarities are sums of rounded terms: one that is exactly the threshold may come out this much below it.
ROUNDING = 1e-9
#: 64 slots in 16 bands of 4: a pair of similarity 0.8 shares a band with probability 0.9998.
SLOTS, ROWS = 64, 4
#: Slots, of one byte each, by which pairs within a bucket are sifted, and how far below the threshold a pair may be estimated.
FINE_SLOTS = 256
SIGMAS = 4
#: What one task compares of a bucket: so many rows that are still open with so many of all, or these bytes of either.
OPEN_ROWS, ALL_ROWS, TILE_BYTES = 1_024, 2_048, 16 << 20

_TICK = np.uint64(0xA0761D6478BD642F)
_PLACE = np.uint64(0xE7037ED1A0B428DB)


def normal_text(text: Column) -> Column:
    """Lower case, runs of ``[\\x20\\x09-\\x0D]`` as one space, none at the ends; null is empty."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+", " "))


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight, 1 + ln(occurrences), of the distinct shingles of each text, in order."""
    hashes, owner = shingle_hashes(data, offsets, words)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], hashes[at], 1 + np.log(np.diff(np.append(at, len(hashes))))


def sketch(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_texts: int, slots: int = SLOTS) -> np.ndarray:
    """ProbMinHash: for each text and slot, the shingle whose arrival there is the earliest.

    Every shingle arrives as a Poisson process of its weight's rate, each
    arrival at a random slot. A shingle's process ends at the first arrival
    later than the latest slot of its text. Two texts agree in a slot with the
    probability of their probability Jaccard similarity.
    """
    earliest = np.full(n_texts * slots, np.inf)
    clock, open_, seen, done = np.zeros(len(hashes)), np.arange(len(hashes)), [], 0
    while len(open_):
        step = 1 if done < 3 else 16
        tick = np.arange(done, done + step, dtype=np.uint64)[None, :]
        own = hashes[open_][:, None]
        uniform = ((mix(own + tick * _TICK) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        arrivals = clock[open_][:, None] + np.cumsum(-np.log(uniform) / weights[open_][:, None], axis=1)
        slot = owner[open_][:, None] * slots + (mix(own ^ mix(tick + _PLACE)) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(earliest, slot.ravel(), arrivals.ravel())
        seen.append((slot.ravel(), arrivals.ravel(), np.repeat(open_, step)))
        clock[open_] = arrivals[:, -1]
        done += step
        open_ = open_[arrivals[:, -1] < earliest.reshape(n_texts, slots).max(axis=1)[owner[open_]]]
    out = np.zeros(n_texts * slots, np.uint64)
    for slot, arrivals, who in seen:
        won = arrivals == earliest[slot]
        out[slot[won]] = hashes[who[won]]
    return out.reshape(n_texts, slots)


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = signature.reshape(len(signature), -1, rows)
    keys = np.broadcast_to(mix(np.arange(parts.shape[1], dtype=np.uint64)), parts.shape[:2])
    for r in range(rows):
        keys = mix(keys + parts[:, :, r])
    return keys.view(np.int64)


def probability_jaccard(a: np.ndarray, weight_a: np.ndarray, b: np.ndarray, weight_b: np.ndarray) -> float:
    """Sum over common shingles i of 1 / sum over all j of max(a_j / a_i, b_j / b_i); hashes are sorted."""
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 1.0 if not len(a) and not len(b) else 0.0
    x, y = weight_a[in_a], weight_b[in_b]
    only_a, only_b = weight_a.sum() - x.sum(), weight_b.sum() - y.sum()
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    up_to = np.cumsum(x) / x  # shingles whose ratio b_j / a_j is no larger count by a_j / a_i
    beyond = (y.sum() - np.cumsum(y)) / y
    return float(np.sum(1 / (only_a / x + up_to + beyond + only_b / y)))


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for batch in text_batches(batches, "normal"):
            data, offsets = flat_text(batch.column("normal"))
            signature = sketch(*weighted_shingles(data, offsets, words), batch.num_rows)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(signature).ravel()), SLOTS // ROWS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("node"), keys.cast(pa.list_(pa.int64()))], names=["doc_id", "node", "bands"])

    return docs.mapInArrow(run, "doc_id long, node binary, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose probability Jaccard similarity reaches the threshold."""
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("normal").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("normal").alias("text_a")), "a"))

    def run(batches):
        for batch in text_batches(text_batches(batches, "text_b"), "text_a"):
            sides = []
            for side in ("text_a", "text_b"):
                owner, hashes, weights = weighted_shingles(*flat_text(batch.column(side)), words)
                sides.append((hashes, weights, np.searchsorted(owner, np.arange(batch.num_rows + 1))))
            (ha, wa, ba), (hb, wb, bb) = sides
            near = [probability_jaccard(ha[ba[i]: ba[i + 1]], wa[ba[i]: ba[i + 1]], hb[bb[i]: bb[i + 1]], wb[bb[i]: bb[i + 1]]) >= threshold - ROUNDING
                    for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def _profiles(texts: DataFrame, words: int) -> DataFrame:
    """What a node is compared by: its bands, the low byte of FINE_SLOTS slots, and its shingles with their occurrences."""
    def run(batches):
        for batch in text_batches(batches, "normal"):
            owner, hashes, weights = weighted_shingles(*flat_text(batch.column("normal")), words)
            n = batch.num_rows
            bands = band_keys(sketch(owner, hashes, weights, n))
            fine = sketch(owner, hashes, weights, n, FINE_SLOTS).astype(np.uint8)
            cuts = np.searchsorted(owner, np.arange(n + 1))
            times = np.rint(np.exp(weights - 1)).astype(np.uint32)
            held = [[row.tobytes() for row in bands], [row.tobytes() for row in fine],
                    [hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], [times[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array(x, pa.binary()) for x in held)], names=["node", *_PROFILE])

    return texts.mapInArrow(run, "node binary, " + ", ".join(f"{c} binary" for c in _PROFILE))


_PROFILE = ["own_bands", "fine", "shingles", "times"]


def _weighted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a profile and their weights, the same to the last bit as those that were sketched."""
    return np.frombuffer(row["shingles"], np.uint64), 1 + np.log(np.frombuffer(row["times"], np.uint32).astype(np.int64))


def _tile_links(key: int, rows: list[dict], threshold: float):
    """Verified links between the open rows of a tile and all its rows, one to each component that a row reaches.

    Two nodes that share several bands meet in several buckets; they are
    compared in that of the least key.
    """
    left, right = [r for r in rows if r["is_open"]], [r for r in rows if not r["is_open"]]
    if not left or not right:
        return
    least = (threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / FINE_SLOTS)) * FINE_SLOTS
    ours, theirs = (np.frombuffer(b"".join(r["fine"] for r in side), np.uint8).reshape(len(side), -1) for side in (left, right))
    bands, other_bands = (np.frombuffer(b"".join(r["own_bands"] for r in side), np.int64).reshape(len(side), -1) for side in (left, right))
    names = {root: i for i, root in enumerate(dict.fromkeys(r["root"] for r in rows))}
    roots = np.array([names[r["root"]] for r in right])
    parts = [_weighted(r) for r in right]
    for i, row in enumerate(left):
        equal = (theirs == ours[i]).sum(axis=1)
        likely = np.flatnonzero((equal >= least) & (roots != names[row["root"]]))
        shared = np.where(other_bands[likely] == bands[i], bands[i], np.iinfo(np.int64).max).min(axis=1)
        likely = likely[shared == key]
        reached = set()
        mine = _weighted(row)
        for j in likely[np.argsort(-equal[likely], kind="stable")].tolist():
            if roots[j] not in reached and probability_jaccard(*mine, *parts[j]) >= threshold - ROUNDING:
                reached.add(roots[j])
                yield row["node"], right[j]["node"]


def _links_between(members: DataFrame, profiles: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between nodes of one bucket but different roots, enough to join all components that links join.

    ``members`` has key, node, root. In each bucket the rows of its most
    frequent root have each other already; only the others are open. Open rows
    meet all rows in tiles of bounded size, so a large bucket fills many tasks,
    and links alone leave them.
    """
    rows = members.join(profiles, "node").withColumn("bytes", F.length("shingles") * 2)
    held = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    main = held.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("n_all"), F.max("n").alias("n_main"),
                                   F.sum("bytes").alias("all_bytes"))
    rows = rows.join(main, "key").withColumns({
        "open_tiles": F.greatest(F.ceil((F.col("n_all") - F.col("n_main")) / OPEN_ROWS), F.ceil(F.col("all_bytes") / TILE_BYTES)),
        "all_tiles": F.greatest(F.ceil(F.col("n_all") / ALL_ROWS), F.ceil(F.col("all_bytes") / TILE_BYTES))})
    place, columns = F.xxhash64("node"), ["key", "node", "root", *_PROFILE]
    every = rows.select(*columns, F.lit(False).alias("is_open"), F.pmod(place, "all_tiles").alias("right"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("open_tiles") - 1)).alias("left"))
    some = rows.where("root != main").select(
        *columns, F.lit(True).alias("is_open"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_tiles") - 1)).alias("right"),
        F.pmod(place, "open_tiles").alias("left"))
    tiles = every.unionByName(some).repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")

    def run(batches):
        def links():
            now, held = None, []
            for batch in batches:
                for row in batch.to_pylist():
                    tile = row["key"], row["left"], row["right"]
                    if tile != now:
                        if held:
                            yield from _tile_links(now[0], held, threshold)
                        now, held = tile, []
                    held.append(row)
            if held:
                yield from _tile_links(now[0], held, threshold)

        found = links()
        while some_links := list(itertools.islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*some_links)], names=["a", "b"])

    return tiles.mapInArrow(run, "a binary, b binary")


def near_duplicate_classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node (digest of the normal text), root and class_id of every row.

    Rows are one class if a chain of links joins them: equal normal texts, or
    probability Jaccard similarity of their ``words``-word shingles, weighted
    1 + ln(occurrences), of ``threshold`` or more. class_id is the smallest
    doc_id of the class (null only if all are null), so classes may share it where
    doc_ids repeat; root, a node of the class, is its own. Null text is empty; all
    texts without words are one class; a text of fewer words is one shingle.

    Equal texts are one node. Nodes that share a band are a bucket, and are
    linked in two steps. (1) In each bucket the node with most neighbours
    leads, and all others are verified against it: a group of copies costs its
    size, not its square. (2) In buckets that still hold several components,
    the nodes outside the largest are sifted against all of the bucket by finer
    sketches. Pairs within SIGMAS standard deviations of the threshold are
    verified where they meet, until a node has a link to each component it can
    be linked to; further links to that component would change nothing.
    """
    own = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_text(F.col("text")).alias("normal"))
           .withColumn("node", F.unhex(F.md5("normal"))))
    sketches = cut_lineage(_sketched(own, words))
    nodes = sketches.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    rows = nodes.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = cut_lineage(rows.join(shared, "key"))
    popular = buckets.groupBy("node").agg(F.sum("size").alias("neighbours"))
    texts = cut_lineage(own.select("node", "normal").join(popular.select("node"), "node", "left_semi").dropDuplicates(["node"]))

    leaders = buckets.join(popular, "node").groupBy("key").agg(F.max_by("node", F.struct("neighbours", "node")).alias("leader"))
    led = cut_lineage(buckets.select("key", "node").join(leaders, "key").where("node != leader"))
    pairs = cut_lineage(led.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())
    tied = stars(_verified(pairs, texts, words, threshold))
    members = led.select("key", "node").join(tied.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    several = members.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one != other").select("key")
    members = cut_lineage(members.join(several, "key"))
    profiles = cut_lineage(_profiles(texts.join(members.select("node").distinct(), "node", "left_semi"), words))
    tied = stars(tied.unionByName(_links_between(members, profiles, threshold)))
    roots = nodes.select("node", "first_id").join(tied.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    classes = roots.join(roots.groupBy("root").agg(F.min("first_id").alias("class_id")), "root").select("node", "root", "class_id")
    return sketches.select("doc_id", "node").join(classes, "node").select("doc_id", "node", "root", "class_id")


def keep_one_of_each(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate class: the smallest doc_id (null the largest).

    Of rows equal in doc_id within a class, one stays.
    """
    found = cut_lineage(near_duplicate_classes(docs, words, threshold))
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "node")).alias("best")).select("best.doc_id", "best.node")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumns({
        "own_id": F.col("row.doc_id").cast("long"), "own_node": F.unhex(F.md5(normal_text(F.col("row.text"))))})
    return (rows.join(kept, (rows.own_node == kept.node) & rows.own_id.eqNullSafe(kept.doc_id), "left_semi")
            .groupBy("own_node", "own_id").agg(F.first("row").alias("row")).select("row.*"))
