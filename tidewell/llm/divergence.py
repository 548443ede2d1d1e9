"""How the sources of each language diverge in their terms, in exact integers.

Tasks count terms by Arrow kernels (lower-casing, splitting, dictionary codes,
hash group-by) and send partial counts. Merged counts are stored as shards of
(language, term) columns; each shard adds its part of every divergence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.arrays import text_batches
from tidewell.llm.terms import merged_counts, split_terms
from tidewell.session import cut_lineage

#: Characters that are not part of a term: all of ASCII but letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text worked on together; numbers (sources times terms) in one shard's matrix.
TEXT_BYTES = 1 << 19
SHARD_CELLS = 1 << 18
UNIT = 1_000_000_000


def _count_batches(batches):
    def partials():
        for batch in text_batches(batches, "text", TEXT_BYTES):
            lang, source = (pc.fill_null(batch.column(i), "").dictionary_encode() for i in (0, 1))
            owner, terms = split_terms(pc.ascii_lower(pc.fill_null(batch.column(2), "")), SEPARATORS)
            # One row per document and term first: its count of documents is 1.
            per_doc = pa.table({"owner": owner, "code": terms.indices, "n": pa.repeat(pa.scalar(1, pa.int64()), len(owner))})
            per_doc = per_doc.group_by(["owner", "code"]).aggregate([("n", "sum")])
            rows = per_doc.column("owner").combine_chunks()
            counted = pa.table({
                "lang": lang.take(rows), "source": source.take(rows),
                "term": pa.DictionaryArray.from_arrays(per_doc.column("code").combine_chunks(), terms.dictionary),
                "n": per_doc.column("n_sum"), "docs": pa.repeat(pa.scalar(1, pa.int64()), len(rows))})
            yield counted.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(counted.column_names)
            # A row without a term says that the group is there.
            groups = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"]).aggregate([])
            nothing = pa.repeat(pa.scalar(0, pa.int64()), groups.num_rows)
            yield pa.table({"lang": groups.column("lang"), "source": groups.column("source"),
                            "term": pa.nulls(groups.num_rows, pa.string()).dictionary_encode(), "n": nothing, "docs": nothing})

    yield from merged_counts(partials(), ["lang", "source", "term"], ["n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); each (lang, source) also has a row with a null term."""
    own = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    partial = own.mapInArrow(_count_batches, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / total), exact for any counts of 64 bits."""
    product = (n + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", product, total.cast("decimal(20,0)"))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shard_gaps(table: pa.Table) -> pa.Table:
    """Sums over a shard's terms of the gap of every two sources, from one matrix of shares."""
    column = {name: table.column(name).combine_chunks() for name in table.column_names}
    base = pc.is_null(column["term"])
    sources = column["source"].filter(base)
    order = pc.sort_indices(sources)
    sources = sources.take(order)
    floor = column["p"].filter(base).take(order).to_numpy()
    inside = pc.invert(base)
    terms = column["term"].filter(inside).dictionary_encode()
    row = pc.index_in(column["source"].filter(inside), sources).to_numpy()
    shares = np.repeat(floor[:, None], len(terms.dictionary), axis=1)
    shares[row, terms.indices.to_numpy()] = column["p"].filter(inside).to_numpy()
    one, other, total = [], [], []
    step = max(1, SHARD_CELLS // max(1, shares.shape[1]))
    for a in range(len(sources)):
        for start in range(a + 1, len(sources), step):
            p, q = shares[a], shares[start: start + step]
            total.append(((p - q) ** 2 // (p + q)).sum(axis=1))
            other.append(np.arange(start, start + len(q)))
            one.append(np.full(len(q), a))
    flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (one, other, total)]
    langs = pa.repeat(column["lang"][0], len(flat[0]))
    return pa.table({"lang": langs, "one": sources.take(pa.array(flat[0])), "other": sources.take(pa.array(flat[1])), "value": flat[2]})


def audit_sources(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: what sets the sources of each language apart.

    ``docs`` has text, lang and source; null counts as ''. A term is a run of
    ASCII letters and characters beyond ASCII, A-Z lower-cased; kept are those
    in ``min_docs`` documents (rows) of the language or more. The share of a
    term with n of a group's N occurrences is 1 + floor(10^9 (n + 2) / (N + 2V))
    for V kept terms, the gap of two shares floor((p - q)^2 / (p + q)).

    Part 'pair' holds for every source each other source of its language and
    the sum of gaps over the kept terms; part 'term' the ``top`` terms that the
    source has and uses more than the whole language does. Ranks start at 1 in
    each source and part, by value descending, then item in UTF-8 order. A
    language without kept terms gives pairs of value 0 and no terms; one with a
    single source gives no pairs. Repeated rows count each time; texts of any
    length are counted whole; other columns play no part. No documents, no rows.

    Sums stay exact up to 9 * 10^18; N + 2V may have 20 digits. Rows of one
    language, source or term are added up in tasks before they are shuffled.
    """
    counts = cut_lineage(term_counts(docs))
    found = counts.where("term IS NOT NULL")
    kept = cut_lineage(found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs))
    own = cut_lineage(found.select("lang", "source", "term", "n").join(kept.select("lang", "term", "lang_n"), ["lang", "term"]))
    # One row per source, and one per language.
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = (counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["source_total", "lang_total", "v"]))
    groups = cut_lineage(groups)

    shared = own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term",
        _share(F.col("n"), F.col("source_total") + F.col("v") * 2).alias("p"), _share(F.col("lang_n"), F.col("lang_total") + F.col("v") * 2).alias("q"))
    term_part = shared.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))

    shards = groups.groupBy("lang").agg(
        F.greatest(F.lit(1), F.ceil(F.max("v") * F.count(F.lit(1)) / SHARD_CELLS)).cast("int").alias("n_shards"))
    floor = F.when(F.col("v") > 0, _share(F.lit(0), F.greatest("source_total", F.lit(0)) + F.greatest(F.col("v"), F.lit(1)) * 2)).otherwise(0)
    bases = (groups.join(shards, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("shard"), "source",
                                                F.lit(None).cast("string").alias("term"), floor.alias("p")))
    cells = shared.join(shards, "lang").select("lang", F.pmod(F.xxhash64("term"), "n_shards").cast("int").alias("shard"), "source", "term", "p")
    gaps = (cells.unionByName(bases).groupBy("lang", "shard").applyInArrow(_shard_gaps, "lang string, one string, other string, value long")
            .groupBy("lang", "one", "other").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("way")
    pair_part = gaps.select("lang", both, "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pair_part, term_part)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
