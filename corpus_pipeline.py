"""A corpus from raw documents: toxic ones go, repeated lines go, one of each near-duplicate stays, sources are mixed, texts become tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import toxicity
from tidewell.llm.bpe import round_trip, share_tables
from tidewell.llm.line_dedup import dedup_lines
from tidewell.llm.minhash import keep_one_of_each
from tidewell.llm.mixing import mix_sources, repeat_as_taken
from tidewell.session import scratch_path

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows of ``docs``, calls toxic go.

    Where the labelled rows are not of both kinds, nothing tells toxic documents from others and all stay.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model["learned"]:
        return docs.drop("toxicity")
    return toxicity.score(docs, model).where(F.col("toxicity") < TOXIC).drop("toxicity")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the last one only; texts and n_chars change."""
    kept = dedup_lines(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    return kept.select("row.*", text.alias("left")).withColumns(
        {"text": F.col("left"), "n_chars": F.coalesce(F.char_length("left"), F.lit(0)).cast("long")}).drop("left")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the smallest doc_id."""
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take go."""
    return repeat_as_taken(docs, mix_sources(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their tokens and digests of tokens and of the decoded bytes."""
    shared = share_tables(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return round_trip(docs, shared).select(
        "doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix),
    ("byte_bpe", tokenise),
]

#: Classes of near-duplicates and a trained model are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
