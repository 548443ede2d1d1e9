"""Toxicity by a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrays import mix, text_batches
from tidewell.llm.labelled import SAMPLE_ROWS, labelled_texts

#: Lengths of the n-grams and bits of a feature's number.
SIZES = (3, 4, 5)
BITS = 20
#: A feature counts if its documents differ in label from all others by so many standard deviations, and by such a log ratio.
LEAST_SIGMAS = 6.0
LEAST_RATIO = 0.7
#: Documents of each label for the weights; their features come to the driver.
FIT_ROWS = 2_000


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, as one flat array and the n + 1 bounds of the texts in it."""
    padded = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in padded])]).astype(np.int64)
    grams, total = [], np.zeros(len(points), np.uint64)
    for k in range(max(SIZES)):
        total[: max(0, len(points) - k)] += mix(points[k:] + np.uint64(k << 32))
        if k + 1 in SIZES:
            grams.append((mix(total + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int32))
    out, counts, last = [], [], np.zeros(1 << BITS, np.int32)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        found = np.concatenate([g[a: max(a, b - size + 1)] for g, size in zip(grams, SIZES)])
        place = np.arange(len(found), dtype=np.int32)
        last[found] = place
        out.append(found[last[found] == place])  # the last of equal ones
        counts.append(len(out[-1]))
    return np.concatenate(out) if out else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _count(batches):
    """Documents of each label that hold a feature, summed over the partition."""
    sums = np.zeros((2, 1 << BITS), np.int32)
    for batch in text_batches(batches, "text"):
        found, bounds = features(batch.column("text").to_pylist())
        labels = np.repeat(batch.column("label").to_numpy() > 0, np.diff(bounds))
        for side, mine in ((0, ~labels), (1, labels)):
            sums[side] += np.bincount(found[mine], minlength=1 << BITS).astype(np.int32)
    held = np.flatnonzero(sums.any(axis=0)).astype(np.int32)
    for start in range(0, len(held), 50_000):
        some = held[start: start + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some].astype(np.int64)), pa.array(sums[1, some].astype(np.int64))],
                                         names=["feature", "clean", "toxic"])


def _fit(flat: np.ndarray, bounds: np.ndarray, labels: np.ndarray, share: float, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights of the columns present in ``flat`` (values already scaled to their ratio) by logistic regression."""
    columns, ratios = flat
    size = int(columns.max()) + 1 if len(columns) else 1
    owner = np.repeat(np.arange(len(labels)), np.diff(bounds))
    # Each label weighs as in all labelled rows, whatever its share of this sample.
    weight = np.where(labels > 0, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9)) / len(labels)
    w, bias = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(owner, w[columns] * ratios, len(labels))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        gradient = np.append(np.bincount(columns, error[owner] * ratios, size) + 1e-5 * w, error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        move = 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, fit_rows: int = FIT_ROWS) -> dict:
    """A model of fixed size: ``weights`` (one per feature number), ``bias``, and whether it has ``learned`` from both labels.

    Log-count ratios come from up to ``rows`` labelled documents that are not
    held out, the weights from up to ``fit_rows`` of each label among them. With no
    labels of one kind, all scores are the share of label 1 (0.5 without any).
    """
    known = labelled_texts(docs, labels, "toxic", rows)
    sizes = dict(known.groupBy("label").count().collect())
    toxic, clean = sum(n for k, n in sizes.items() if k > 0), sum(n for k, n in sizes.items() if k <= 0)
    total = toxic + clean
    share = toxic / total if total else 0.5
    weights = np.zeros(1 << BITS, np.float32)
    if not toxic or not clean:
        return {"weights": weights, "bias": 0.0 if not total else 30.0 * (2 * share - 1), "learned": False}
    counts = (known.mapInArrow(_count, "feature int, clean long, toxic long").groupBy("feature")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    held = F.col("clean") + F.col("toxic")
    sigmas = F.abs(F.col("toxic") - held * share) / F.sqrt(held * (share * (1 - share)))
    counts = counts.where(sigmas >= LEAST_SIGMAS).toArrow()  # fewer than 2^BITS rows
    feature, n_clean, n_toxic = (counts.column(c).to_numpy() for c in ("feature", "clean", "toxic"))
    ratio = np.log((n_toxic + share) / toxic) - np.log((n_clean + 1 - share) / clean)
    ratios = np.zeros(1 << BITS, np.float32)
    ratios[feature] = np.where(np.abs(ratio) >= LEAST_RATIO, ratio, 0)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def keep_scaled(batches):
        for batch in text_batches(batches, "text"):
            found, bounds = features(batch.column("text").to_pylist())
            kept = shared.value[found] != 0
            ends = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found[kept]))
            yield pa.RecordBatch.from_arrays([batch.column("label"), lists], names=["label", "found"])

    parts = [known.where(side).orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(fit_rows) for side in ("label > 0", "label <= 0")]
    fit = parts[0].unionByName(parts[1]).mapInArrow(keep_scaled, "label int, found array<int>").toArrow()
    lists = fit.column("found").combine_chunks()
    found, bounds = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
    names, columns = np.unique(found, return_inverse=True)
    w, bias = _fit((columns, ratios[found].astype(np.float64)), bounds, (fit.column("label").to_numpy() > 0).astype(float), share)
    weights[names] = w[: len(names)] * ratios[names]
    shared.unpersist()
    return {"weights": weights, "bias": float(bias), "learned": True}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``toxicity`` from 0 to 1; null and empty texts get what the bias gives.

    A column of that name is replaced; others are carried along untouched.
    """
    docs = docs.drop("toxicity")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = shared.value["weights"], shared.value["bias"]
        for batch in text_batches(batches, "text"):
            found, bounds = features([t or "" for t in batch.column("text").to_pylist()])
            sums = np.concatenate([[0], np.cumsum(weights[found], dtype=np.float64)])
            z = bias + sums[bounds[1:]] - sums[bounds[:-1]]
            yield batch.append_column("toxicity", pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500)))))

    return docs.mapInArrow(run, f"{schema}, toxicity double")
