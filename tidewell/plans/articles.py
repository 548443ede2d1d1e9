"""News articles and health-agency news -> one article schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.dates import BLANK_OFFSET, ZULU, day_text, parse_time
from tidewell.functions.fixed_values import AUTHOR_PLACEHOLDER, CURRENTS_TOPICS
from tidewell.functions.text import absolute_url, blank_to_null, canonical_url, tag_topic
from tidewell.operators.sentiment import Rules, with_sentiment
from tidewell.operators.upsert import collapse_incoming
from tidewell.schemas import ARTICLES

_FIELDS = [f for f in ARTICLES.names if f != "media_sentiment_score"]


def _provenance(now: str) -> dict[str, Column]:
    return {
        "source_apis": F.array("source_api"), "first_seen_at": F.lit(now),
        "last_seen_at": F.lit(now), "version": F.lit(1),
    }


def normalise_articles(records: DataFrame, now: str) -> DataFrame:
    """Exploded article records (see ``read_envelope``) of either news service."""
    headlines = F.contains("source_api", F.lit("newsapi"))
    published = F.when(headlines, parse_time(F.col("published_at"), ZULU)) \
                 .otherwise(parse_time(F.col("published_at"), BLANK_OFFSET))
    language = F.when(headlines, F.lit("en")).otherwise(F.col("language"))
    return records.withColumns({
        "url": canonical_url(F.col("url")), "published_at": published, "language": language,
        "author": F.nullif("author", F.lit(AUTHOR_PLACEHOLDER)), **_provenance(now),
    }).select(*_FIELDS)


def who_description() -> Column:
    """The summary, else the labelled dates and rating that are known."""
    labelled = F.concat_ws(" ", *[
        part for label, name in (("Start Date", "start_date"), ("End Date", "end_date"), ("Rating", "rating"))
        for part in (F.when(F.col(name).isNotNull(), F.lit(label)), F.col(name))
    ])
    return F.coalesce("summary", labelled)


def _who_common(now: str, topic: str) -> dict[str, Column]:
    return {
        "url": canonical_url(F.col("url")), "topic": F.lit(topic),
        "author": F.lit(None).cast("string"), "image_url": F.lit(None).cast("string"),
        "language": F.lit("en"), "category": F.array(F.lit("health_emergency")),
        "published_at": parse_time(F.col("published"), ZULU), **_provenance(now),
    }


def normalise_who(emergencies: DataFrame, outbreaks: DataFrame, now: str) -> DataFrame:
    """Emergencies and outbreak news; general news is left out on purpose."""
    dated = emergencies.withColumns({
        "start_date": day_text(F.col("start_date")), "end_date": day_text(F.col("end_date")),
        "rating": blank_to_null(F.col("rating")), "summary": blank_to_null(F.col("summary")),
    })
    urgent = dated.withColumn("description", who_description()) \
                  .withColumns(_who_common(now, "emergencies"))
    news = outbreaks.withColumn("description", F.col("summary")) \
                    .withColumns(_who_common(now, "disease_outbreak"))
    return urgent.select(*_FIELDS).unionByName(news.select(*_FIELDS))


def score_articles(articles: DataFrame, lexicon: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row per url, with the sentiment of its title, by ``rules`` or as the word sum."""
    single = collapse_incoming(articles, "url", "published_at", "source_apis")
    return with_sentiment(single, "url", "title", lexicon, rules).select(*ARTICLES.names)


# ── flattening of raw service records ────────────────────────────────────────

def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def flatten_news(raw: DataFrame, topics: Mapping[str, Sequence[str]]) -> DataFrame:
    """Raw headline records (with their requested ``category``) -> article records."""
    topic = tag_topic(F.col("title"), F.col("description"), topics,
                      F.concat("category", F.lit("_general")))
    return raw.filter(_text("url") != "").select(
        topic.alias("topic"), "category", _text("source.name").alias("source"),
        "author", F.trim(_text("title")).alias("title"), "description", "url",
        F.col("urlToImage").alias("image_url"), F.col("publishedAt").alias("published_at"), "content")


def flatten_currents(raw: DataFrame, topics: Mapping[str, Sequence[str]] = CURRENTS_TOPICS) -> DataFrame:
    """Raw search records (with their requested ``search``) -> article records."""
    title = F.trim(_text("title"))
    topic = tag_topic(title, F.col("description"), topics, F.concat("search", F.lit("_general")))
    return raw.select(
        "id", topic.alias("topic"), title.alias("title"), "description", "url",
        F.col("image").alias("image_url"), F.col("published").alias("published_at"),
        "author", "category", "language")


def _either(first: str, second: str) -> Column:
    return F.coalesce(blank_to_null(F.col(first)), F.col(second), F.lit(""))


def flatten_who(raw: DataFrame, kind: str, base_url: str) -> DataFrame:
    """Raw agency records of one kind: general, outbreak or emergency."""
    title = F.trim(_text("Title")).alias("title")
    url = absolute_url(F.col("ItemDefaultUrl"), base_url).alias("url")
    provider = _text("Provider").alias("provider")
    if kind == "general":
        return raw.select(
            title, _text("NewsType").alias("news_type"),
            _either("FormatedDate", "PublicationDateAndTime").alias("published"), url,
            _text("SystemSourceKey").alias("source_key"), provider)
    if kind == "outbreak":
        return raw.select(
            title, _either("PublicationDateAndTime", "FormatedDate").alias("published"), url,
            _text("Summary").alias("summary"), provider)
    if kind == "emergency":
        return raw.select(
            title, _text("PublicationDate").alias("published"),
            _text("EmergencyStartDate").alias("start_date"),
            _text("EmergencyEndDate").alias("end_date"),
            _text("EmergencyRatingTextual").alias("rating"),
            _either("Summary", "Overview").alias("summary"), url, provider)
    raise ValueError(f"unknown kind {kind!r}")
