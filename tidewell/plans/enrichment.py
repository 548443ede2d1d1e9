"""Text mentions, sentiment and scores on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.containment import mention_counts, mention_pairs
from tidewell.operators.sentiment import score_sentiment
from tidewell.operators.upsert import enrich_fact
from tidewell.session import cut_lineage

# A control character that no name holds keeps two texts apart in one scan.
_BETWEEN = "\u0000"


def trial_counts(trials: DataFrame, diseases: DataFrame) -> DataFrame:
    """(disease_key, trial_count): trials whose conditions mention the disease."""
    # Trials are counted by id: what several rows of one say is one text.
    texts = trials.filter(F.col("trial_id").isNotNull()).groupBy("trial_id").agg(
        F.array_join(F.array_sort(F.flatten(F.collect_list("conditions"))), " ; ").alias("text"))
    return mention_counts(texts, "trial_id", "text", diseases, "disease_key", "disease_name", "trial_count")


def media_counts(articles: DataFrame, diseases: DataFrame) -> DataFrame:
    """(disease_key, media_mention_count): articles with the disease in title or description."""
    texts = articles.select("url", F.concat(
        F.coalesce("title", F.lit("")), F.lit(_BETWEEN), F.coalesce("description", F.lit(""))).alias("text"))
    return mention_counts(texts, "url", "text", diseases, "disease_key", "disease_name",
                          "media_mention_count")


def publication_counts(publications: DataFrame, diseases: DataFrame) -> DataFrame:
    """(disease_key, publication_count): publications with the disease in the title."""
    return mention_counts(publications, "work_id", "title", diseases, "disease_key", "disease_name",
                          "publication_count")


def mean_sentiment(articles: DataFrame, diseases: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(disease_key, media_sentiment_score): mean over the articles that mention the disease."""
    texts = articles.filter(F.col("title").isNotNull()).select("url", F.concat(
        "title", F.lit(" "), F.coalesce("description", F.lit(""))).alias("text"))
    pairs = mention_pairs(texts, "url", "text", diseases, "disease_key", "disease_name")
    scores = score_sentiment(texts, "url", "text", lexicon)
    return pairs.join(scores, "url").groupBy("disease_key").agg(
        F.round(F.avg("media_sentiment_score"), 4).alias("media_sentiment_score"))


def norm_score(df: DataFrame, count: str) -> Column:
    """Share of the largest value; null where that is zero.

    The maximum is a scalar subquery, so no row has to meet all others.
    """
    top = df.agg(F.max(count)).scalar()
    return F.round(F.col(count) / F.nullif(top, F.lit(0)), 4)


def enrich_counts(fact: DataFrame, trials: DataFrame, articles: DataFrame, publications: DataFrame,
                  diseases: DataFrame, reset: bool = False) -> DataFrame:
    """Set the three counts. Diseases without mentions keep theirs unless ``reset``."""
    fact = enrich_fact(fact, trial_counts(trials, diseases), "disease_key", "trial_count", reset)
    fact = enrich_fact(fact, media_counts(articles, diseases), "disease_key",
                       "media_mention_count", reset)
    return enrich_fact(fact, publication_counts(publications, diseases), "disease_key",
                       "publication_count", reset)


def enrich_sentiment(fact: DataFrame, articles: DataFrame, diseases: DataFrame, lexicon: DataFrame,
                     reset: bool = False) -> DataFrame:
    return enrich_fact(fact, mean_sentiment(articles, diseases, lexicon), "disease_key",
                       "media_sentiment_score", reset)


def enrich_norms(fact: DataFrame) -> DataFrame:
    """Set both normalised scores; rows without a count keep theirs.

    ``fact`` is read twice, so it should be a stored table.
    """
    tops = fact.agg(F.struct(F.max("media_mention_count").alias("media"), F.max("publication_count").alias("research"))).scalar()

    def scored(count: str, old: str) -> Column:
        top = tops[{"media_mention_count": "media", "publication_count": "research"}[count]]
        share = F.round(F.col(count) / F.nullif(top, F.lit(0)), 4)
        return F.when(F.col(count).isNotNull(), share).otherwise(F.col(old)).alias(old)
    return fact.withColumns({
        "norm_media_score": scored("media_mention_count", "norm_media_score"),
        "norm_research_score": scored("publication_count", "norm_research_score")})


def enrich(fact: DataFrame, trials: DataFrame, articles: DataFrame, publications: DataFrame,
           diseases: DataFrame, lexicon: DataFrame, reset: bool = False) -> DataFrame:
    """The whole enrichment: counts, sentiment, then scores over the stored result."""
    counted = enrich_counts(fact, trials, articles, publications, diseases, reset)
    return enrich_norms(cut_lineage(enrich_sentiment(counted, articles, diseases, lexicon, reset)))


def flag_neglected(dim: DataFrame, scores: DataFrame, level: str = "Low",
                   burden: float = 10.0) -> DataFrame:
    """Reset the flag, then set it where attention is low and burden is high.

    ``scores`` has (disease_name, attention_level, norm_daly).
    """
    low = scores.filter((F.col("attention_level") == level) & (F.col("norm_daly") >= burden)) \
                .select("disease_name", F.lit(True).alias("_low")).distinct()
    return dim.drop("is_neglected").join(low, "disease_name", "left") \
              .withColumn("is_neglected", F.coalesce("_low", F.lit(False))).drop("_low")
