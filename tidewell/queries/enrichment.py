"""Mentions, sentiment, scores and flags on documents, parts and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import containment, lookups, sentiment
from tidewell.plans import enrichment
from tidewell.queries import dealt, query, table

LEXICON = {"idiot": -2.5, "pathetic": -1.9, "the": 0.2, "and": 0.1, "with": 0.4, "der": 0.3,
           "nicht": -1.1, "une": 0.5, "pour": 0.6, "por": -0.4, "license": 1.5, "spam": -1.3}


def lexicon(spark) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "word string, score double")


def part_terms(spark, sf) -> DataFrame:
    """Diseases stand-in: words of part names, and every two-word name."""
    part = table(spark, sf, "part")
    names = part.select(F.explode(F.split("p_name", " ")).alias("disease_name")).unionByName(
        part.select(F.upper("p_name").alias("disease_name"))).distinct()
    return names.select(F.col("disease_name").alias("disease_key"), "disease_name")


def passage_terms(spark, sf) -> DataFrame:
    """Diseases stand-in for long texts: words of the benchmark passages."""
    return table(spark, sf, "benchmark").select(
        F.explode(F.split("text", " ")).alias("disease_name")).distinct().select(
        F.col("disease_name").alias("disease_key"), "disease_name")


PART_TERMS_SQL = """
terms AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part
          UNION SELECT DISTINCT upper(p_name) FROM part)
"""


@query("""
WITH terms AS (SELECT DISTINCT term FROM (SELECT unnest(string_split(text, ' ')) AS term FROM benchmark) WHERE term <> ''),
low AS (SELECT DISTINCT lower(term) AS t FROM terms),
counts AS (SELECT t, count(*) AS n FROM low, documents WHERE contains(lower(text), t) GROUP BY t)
SELECT term AS disease_key, CAST(n AS BIGINT) AS publication_count FROM counts JOIN terms ON lower(term) = t
""")
def mention_counts(spark, sf):
    docs = dealt(spark, sf, "documents").select(F.col("doc_id").alias("work_id"), F.col("text").alias("title"))
    return enrichment.publication_counts(docs, passage_terms(spark, sf))


@query("WITH " + PART_TERMS_SQL + """
SELECT term AS disease_key, CAST(count(*) AS BIGINT) AS media_mention_count
FROM terms, (SELECT page_id, url, html, text FROM pages FULL JOIN documents ON page_id = doc_id)
WHERE contains(lower(coalesce(html, '')), lower(term)) OR contains(lower(coalesce(text, '')), lower(term)) GROUP BY term
""")
def media_counts(spark, sf):
    pages, docs = dealt(spark, sf, "pages"), dealt(spark, sf, "documents")
    articles = pages.join(docs, F.col("page_id") == F.col("doc_id"), "full").select(
        F.coalesce("page_id", "doc_id").alias("url"), F.col("html").alias("title"), F.col("text").alias("description"))
    return enrichment.media_counts(articles, part_terms(spark, sf))


@query("WITH " + PART_TERMS_SQL + """,
t AS (SELECT l_orderkey, lower(string_agg(p_name, ' ; ')) AS txt FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT term AS disease_key, CAST(count(*) AS BIGINT) AS trial_count FROM terms, t
WHERE contains(txt, lower(term)) GROUP BY term
""")
def trial_counts(spark, sf):
    items = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    # An order has a handful of lines, so its list of names is small.
    trials = items.groupBy(F.col("l_orderkey").alias("trial_id")).agg(
        F.collect_list("p_name").alias("conditions"))
    return enrichment.trial_counts(trials, part_terms(spark, sf))


@query("WITH " + PART_TERMS_SQL + """
SELECT doc_id, term FROM documents, terms WHERE contains(lower(text), lower(term))
""")
def mention_pairs(spark, sf):
    terms = part_terms(spark, sf).select(F.col("disease_key").alias("term"), "disease_name")
    return containment.mention_pairs(dealt(spark, sf, "documents"), "doc_id", "text", terms, "term", "disease_name")


LEXICON_SQL = "lex(word, score) AS (VALUES " + ", ".join(f"('{w}', {s})" for w, s in LEXICON.items()) + ")"
SCORE_SQL = LEXICON_SQL + r""",
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}](?:[\p{L}\p{N}''’-]*[\p{L}\p{N}])?')) AS word FROM documents),
sums AS (SELECT doc_id, sum(score) AS s FROM w JOIN lex USING (word) GROUP BY doc_id),
scored AS (SELECT doc_id, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 4) AS score
           FROM documents LEFT JOIN sums USING (doc_id) WHERE text <> '')
"""


@query("WITH " + SCORE_SQL + "SELECT doc_id, round(score, 3) AS score FROM scored")
def sentiment_scores(spark, sf):
    docs = dealt(spark, sf, "documents")
    return sentiment.score_sentiment(docs, "doc_id", "text", lexicon(spark)).select(
        "doc_id", F.round("media_sentiment_score", 3).alias("score"))


RULES = sentiment.Rules({"of": 0.293, "de": -0.293, "so": 0.293}, {"not", "nicht", "to", "never", "without"})
RULE_LEXICON = LEXICON | {"good": 1.9, "that": -0.9, "is": 0.7, "no": -1.2, "kind": 2.4, "la": 0.8, "in": -0.6, "was": 1.1}
_WORDS_SQL = ", ".join(f"('{w}', {s})" for w, s in RULE_LEXICON.items())
_BOOSTS_SQL = ", ".join(f"('{w}', {s})" for w, s in RULES.boosters.items())
_NEGATIONS_SQL = ", ".join(f"'{w}'" for w in sorted(RULES.negations))
_PUNCTUATION_SQL = "'" + sentiment.PUNCTUATION.replace("'", "''") + "'"


def rules_sql(source: str) -> str:
    """Tables ``texts`` to ``ruled`` (id, score): the rules by window functions over words, one fold step per table."""
    def step(n: int, damp: float, factor: str) -> str:
        loud = f"CASE WHEN c{n} AND mixed THEN CASE WHEN v > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0 END"
        boost = f"coalesce((CASE WHEN v < 0 THEN -b{n} ELSE b{n} END + {loud}) * {damp}::DOUBLE, 0)"
        return f"SELECT * REPLACE (CASE WHEN l{n} IS NOT NULL AND s{n} IS NULL THEN (v + {boost}) * ({factor})::DOUBLE ELSE v END AS v)"
    lags = ", ".join(f"lag(low, {n}) OVER o AS l{n}, lag(score, {n}) OVER o AS s{n}, lag(boost, {n}) OVER o AS b{n}, "
                     f"lag(caps, {n}) OVER o AS c{n}, coalesce(lag(negates, {n}) OVER o, false) AS n{n}" for n in (1, 2, 3))
    second = "CASE WHEN l2 = 'never' AND l1 IN ('so', 'this') THEN 1.25 WHEN l2 = 'without' AND l1 = 'doubt' THEN 1 WHEN n2 THEN -0.74 ELSE 1 END"
    third = ("CASE WHEN l3 = 'never' AND (l2 IN ('so', 'this') OR l1 IN ('so', 'this')) THEN 1.25 "
             "WHEN l3 = 'without' AND (l2 = 'doubt' OR l1 = 'doubt') THEN 1 WHEN n3 THEN -0.74 ELSE 1 END")
    return rf"""
lexicon(low, score) AS (SELECT w, s::DOUBLE FROM (VALUES {_WORDS_SQL}) t(w, s)),
boosters(low, boost) AS (SELECT w, s::DOUBLE FROM (VALUES {_BOOSTS_SQL}) t(w, s)),
texts AS ({source}),
tokens AS (
  SELECT id, unnest(found) AS token, generate_subscripts(found, 1) AS i
  FROM (SELECT id, regexp_extract_all(text, '[^\x09-\x0d\x20\x{{85}}\x{{a0}}\p{{Z}}]+') AS found FROM texts)),
bare AS (SELECT id, i, CASE WHEN length(trim(token, {_PUNCTUATION_SQL})) <= 2 THEN token ELSE trim(token, {_PUNCTUATION_SQL}) END AS word FROM tokens),
words AS (
  SELECT id, i, low, score, boost, upper(word) = word AND low <> word AS caps, low IN ({_NEGATIONS_SQL}) OR contains(low, 'n''t') AS negates
  FROM (SELECT *, lower(word) AS low FROM bare) LEFT JOIN lexicon USING (low) LEFT JOIN boosters USING (low)),
seen AS (
  SELECT *, {lags}, lead(low) OVER o AS next_low, lead(score) OVER o AS next_score,
    bool_or(caps) OVER (PARTITION BY id) AND NOT bool_and(caps) OVER (PARTITION BY id) AS mixed,
    min(i) FILTER (low = 'but') OVER (PARTITION BY id) AS but_at
  FROM words WINDOW o AS (PARTITION BY id ORDER BY i)),
own AS (
  SELECT *, CASE WHEN low = 'no' AND next_score IS NOT NULL THEN 0::DOUBLE
    WHEN l1 = 'no' OR l2 = 'no' OR (l3 = 'no' AND l1 IN ('or', 'nor')) THEN score * -0.74::DOUBLE ELSE score END AS v0
  FROM seen WHERE score IS NOT NULL AND boost IS NULL AND NOT (low = 'kind' AND coalesce(next_low, '') = 'of')),
shouted AS (SELECT *, v0 + CASE WHEN caps AND mixed THEN CASE WHEN v0 > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0 END AS v FROM own),
one AS ({step(1, 1.0, "CASE WHEN n1 THEN -0.74 ELSE 1 END")} FROM shouted),
two AS ({step(2, 0.95, second)} FROM one),
three AS ({step(3, 0.9, third)} FROM two),
strength AS (
  SELECT id, v * CASE WHEN l1 = 'least' AND s1 IS NULL AND coalesce(l2, '') NOT IN ('at', 'very') THEN -0.74::DOUBLE ELSE 1 END
    * CASE WHEN i < but_at THEN 0.5::DOUBLE WHEN i > but_at THEN 1.5::DOUBLE ELSE 1 END AS v
  FROM three),
totals AS (SELECT id, sum(v) AS total FROM strength GROUP BY id),
marks AS (SELECT id, length(text) - length(replace(text, '!', '')) AS calls, length(text) - length(replace(text, '?', '')) AS asks FROM texts WHERE text <> ''),
loud AS (
  SELECT id, coalesce(total, 0) AS s, least(calls, 4) * 0.292::DOUBLE
    + CASE WHEN asks > 3 THEN 0.96::DOUBLE WHEN asks > 1 THEN asks * 0.18::DOUBLE ELSE 0 END AS emphasis
  FROM marks LEFT JOIN totals USING (id)),
ruled AS (SELECT id, round((s + sign(s) * emphasis) / sqrt((s + sign(s) * emphasis) ** 2 + 15), 4) AS score FROM loud)
"""


@query("WITH " + rules_sql("SELECT doc_id AS id, text FROM documents") + "SELECT id AS doc_id, round(score, 3) AS score FROM ruled")
def sentiment_rules(spark, sf):
    """The full rules over whole texts; SQL has a window function for each word before."""
    words = spark.createDataFrame(list(RULE_LEXICON.items()), "word string, score double")
    return sentiment.score_by_rules(dealt(spark, sf, "documents"), "doc_id", "text", words, RULES).select(
        "doc_id", F.round("media_sentiment_score", 3).alias("score"))


@query("WITH " + SCORE_SQL + "," + PART_TERMS_SQL + """
SELECT term AS disease_key, round(avg(score), 3) AS score
FROM scored JOIN documents USING (doc_id), terms
WHERE contains(lower(source || ' ' || text), lower(term)) GROUP BY term
""")
def sentiment_by_term(spark, sf):
    docs = dealt(spark, sf, "documents").select(
        F.col("doc_id").alias("url"), F.col("source").alias("title"), F.col("text").alias("description"))
    # The source name holds no lexicon word, so it changes no score.
    return enrichment.mean_sentiment(docs, part_terms(spark, sf), lexicon(spark)).select(
        "disease_key", F.round("media_sentiment_score", 3).alias("score"))


@query("""
WITH c AS (SELECT o_custkey AS disease_key, count(*) AS n FROM orders GROUP BY 1)
SELECT disease_key, CAST(n AS BIGINT) AS n, round(n / nullif((SELECT max(n) FROM c), 0), 4) AS norm FROM c
""")
def norm_score(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("disease_key")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.withColumn("norm", enrichment.norm_score(counts, "n"))


@query("""
SELECT c_name AS disease_name, c_mktsegment = 'BUILDING' AND c_acctbal >= 4000 AS is_neglected FROM customer
""")
def flag_neglected(spark, sf):
    customer = table(spark, sf, "customer")
    dim = customer.select(F.col("c_name").alias("disease_name"), F.lit(True).alias("is_neglected"))
    scores = customer.select(
        F.col("c_name").alias("disease_name"), F.col("c_acctbal").alias("norm_daly"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Low").otherwise("High").alias("attention_level"))
    return enrichment.flag_neglected(dim, scores, burden=4000)


@query("""
WITH h AS (SELECT o_custkey AS disease_key, min(o_orderkey) AS first_order, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT c_custkey AS disease_key, CASE WHEN n IS NOT NULL THEN n END AS m,
             CASE WHEN first_order IS NOT NULL THEN first_order END AS p
      FROM customer LEFT JOIN h ON disease_key = c_custkey)
SELECT disease_key, round(m / (SELECT max(m) FROM f), 4) AS media, round(p / (SELECT max(p) FROM f), 4) AS research
FROM f
""")
def enrich_norms(spark, sf):
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("disease_key")).agg(
        F.count(F.lit(1)).alias("media_mention_count"), F.min("o_orderkey").alias("publication_count"))
    none = F.lit(None).cast("double")
    fact = table(spark, sf, "customer").select(F.col("c_custkey").alias("disease_key")) \
        .join(per, "disease_key", "left") \
        .withColumns({"norm_media_score": none, "norm_research_score": none})
    return enrichment.enrich_norms(fact).select(
        "disease_key", F.col("norm_media_score").alias("media"), F.col("norm_research_score").alias("research"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def count_by(spark, sf):
    return lookups.count_by(table(spark, sf, "events"), "event_type")


@query("""
SELECT string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses,
       string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders
""")
def distinct_sets(spark, sf):
    sets = lookups.distinct_sets(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    return sets.select(F.array_join("available_o_orderstatus", ",").alias("statuses"),
                       F.array_join("available_o_orderpriority", ",").alias("priorities"))


@query("WITH " + SCORE_SQL + "," + PART_TERMS_SQL + """,
t AS (SELECT l_orderkey, lower(string_agg(p_name, ' ; ')) AS txt FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
tc AS (SELECT term, count(*) AS n FROM terms, t WHERE contains(txt, lower(term)) GROUP BY term),
mc AS (SELECT term, count(*) AS n, avg(score) AS s FROM terms, documents LEFT JOIN scored USING (doc_id)
       WHERE contains(lower(source || ' ' || text), lower(term)) GROUP BY term),
pc AS (SELECT term, count(*) AS n FROM terms, documents WHERE contains(lower(text), lower(term)) GROUP BY term)
SELECT term AS disease_key, CAST(tc.n AS BIGINT) AS trial_count, CAST(mc.n AS BIGINT) AS media_mention_count,
       CAST(pc.n AS BIGINT) AS publication_count, round(mc.s, 2) AS sentiment,
       round(mc.n / (SELECT max(n) FROM mc), 4) AS norm_media_score, round(pc.n / (SELECT max(n) FROM pc), 4) AS norm_research_score
FROM terms LEFT JOIN tc USING (term) LEFT JOIN mc USING (term) LEFT JOIN pc USING (term)
""")
def enrich_fact_table(spark, sf):
    """Counts, sentiment and scores set on one fact table, as the enrichment job does."""
    terms = part_terms(spark, sf)
    docs = dealt(spark, sf, "documents")
    items = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    # One row per item: the job gathers the rows of a trial itself.
    trials = items.select(F.col("l_orderkey").alias("trial_id"), F.array("p_name").alias("conditions"))
    articles = docs.select(F.col("doc_id").alias("url"), F.col("source").alias("title"), F.col("text").alias("description"))
    works = docs.select(F.col("doc_id").alias("work_id"), F.col("text").alias("title"))
    whole, part_ = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    fact = terms.select("disease_key").withColumns({
        "trial_count": whole, "media_mention_count": whole, "publication_count": whole,
        "media_sentiment_score": part_, "norm_media_score": part_, "norm_research_score": part_})
    return enrichment.enrich(fact, trials, articles, works, terms, lexicon(spark)).select(
        "disease_key", "trial_count", "media_mention_count", "publication_count",
        F.round("media_sentiment_score", 2).alias("sentiment"), "norm_media_score", "norm_research_score")
