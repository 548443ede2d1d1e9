"""Source normalisers on records shaped from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import dates
from tidewell.functions.fixed_values import CURRENTS_TOPICS, NEWS_TOPICS, SPENDING_CATEGORIES
from tidewell.functions.text import absolute_url, canonical_url, null_tokens, row_key, tag_topic, title_case
from tidewell.operators import lookups
from tidewell.plans import articles, burden, publications
from tidewell.queries import dealt, query, table
from tidewell.queries.codes import EXPORT_SQL, burden_export
from tidewell.queries.enrichment import RULE_LEXICON, RULES, rules_sql

NOW = "2026-03-28T06:00:00+00:00"
DAY = "yyyy-MM-dd HH:mm:ss"


def text_of(name: str) -> F.Column:
    return F.col(name).cast("string")


# ── text and url helpers ─────────────────────────────────────────────────────

@query(r"""
SELECT page_id, regexp_replace(regexp_replace(url, '\?.*', ''), '/$', '') AS url,
       CASE WHEN starts_with(substring(url, 6), 'http') THEN substring(url, 6)
            WHEN substring(url, 6) = '' THEN '' ELSE 'https://base.example' || substring(url, 6) END AS absolute
FROM pages
""")
def canonical_urls(spark, sf):
    rest = F.expr("substring(url, 6)")
    return table(spark, sf, "pages").select(
        "page_id", canonical_url(F.col("url")).alias("url"),
        absolute_url(rest, "https://base.example").alias("absolute"))


TOPICS = {"licence": ["license", "public domain"], "insult": ["idiot", "pathetic"], "contact": ["@", "http"],
          "roman": [" les ", " por ", " una "], "german": [" der ", " nicht "]}
TOPIC_CASES = "".join(
    f"WHEN {' OR '.join(f'contains(hay, $t${p}$t$)' for p in phrases)} THEN '{label}' " for label, phrases in TOPICS.items())
NEWS_CASES = "".join(
    f"WHEN {' OR '.join(f'contains(hay, $t${p}$t$)' for p in phrases)} THEN '{label}' " for label, phrases in NEWS_TOPICS.items())


@query(f"""
WITH h AS (SELECT doc_id, lang, lower(source || ' ' || text) AS hay FROM documents)
SELECT doc_id, CASE {TOPIC_CASES} ELSE lang || '_general' END AS topic,
       CASE {NEWS_CASES} ELSE lang || '_general' END AS news_topic FROM h
""")
def tag_topics(spark, sf):
    fallback = F.concat("lang", F.lit("_general"))
    return dealt(spark, sf, "documents").select(
        "doc_id", tag_topic(F.col("source"), F.col("text"), TOPICS, fallback).alias("topic"),
        tag_topic(F.col("source"), F.col("text"), NEWS_TOPICS, fallback).alias("news_topic"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey || '|' || CASE WHEN l_returnflag = 'N' THEN '' ELSE l_suppkey || '|' END
         || l_linenumber || '|' || l_linestatus AS row_key,
       l_partkey || '|' || CASE WHEN l_returnflag = 'N' THEN '~' ELSE CAST(l_suppkey AS VARCHAR) END || '|'
         || l_linenumber || '|' || l_linestatus AS marked_key
FROM lineitem
""")
def row_keys(spark, sf):
    key = ["l_partkey", "supp", "l_linenumber", "l_linestatus"]
    rows = table(spark, sf, "lineitem").withColumn("supp", F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")))
    return rows.select("l_orderkey", "l_linenumber", row_key(key).alias("row_key"), row_key(key, "~").alias("marked_key"))


@query("""
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS completed,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed,
       strftime(o_orderdate, '%Y-%m-%d') AS day_first, year(o_orderdate) || '-01' AS year_month
FROM orders
""")
def partial_dates(spark, sf):
    month = dates.complete_date(F.date_format("o_orderdate", "yyyy-MM"))
    broken = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00XXX"))
    local = F.date_format("o_orderdate", "dd/MM/yyyy")
    return table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).select(
        "o_orderkey", dates.parse_day(month, dates.YEAR_FIRST).cast("string").alias("completed"),
        F.date_format(dates.parse_time(broken, dates.ZULU, dates.ISO_OFFSET), "yyyy-MM-dd").alias("parsed"),
        dates.parse_day(local, dates.DAY_FIRST).cast("string").alias("day_first"),
        dates.first_month(F.year("o_orderdate")).alias("year_month"))


@query("""
SELECT p_partkey, upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) || '_Gov' AS titled,
       CASE WHEN p_size > 40 THEN NULL ELSE p_brand END AS cleaned
FROM part
""")
def null_and_title(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", F.concat("p_type", F.lit("_GOV")).alias("titled"),
        F.when(F.col("p_size") > 45, "N/A").when(F.col("p_size") > 42, "NA").when(F.col("p_size") > 40, "")
        .otherwise(F.col("p_brand")).alias("cleaned"))
    return null_tokens(rows).withColumn("titled", title_case(F.col("titled")))


# ── news ─────────────────────────────────────────────────────────────────────

def article_records(spark, sf) -> DataFrame:
    """Documents, with their page's url if they have a page, as article records of two services, by language."""
    docs = dealt(spark, sf, "documents")
    pages = docs.join(table(spark, sf, "pages"), F.col("page_id") == F.col("doc_id"), "left").withColumns({
        "page_id": F.col("doc_id"), "url": F.coalesce("url", F.concat(F.lit("https://docs.example/"), text_of("doc_id")))})
    headlines = F.col("lang") == "en"
    published = F.timestamp_seconds(F.lit(1700000000) + F.col("page_id") * 86_399)
    return pages.select(
        F.when(headlines, "newsapi.org/v2").otherwise("api.currentsapi.services/v1").alias("source_api"),
        "url", F.concat(F.lit("t_"), "lang").alias("topic"), F.array("source").alias("category"),
        F.when(F.col("lang") == "de", "#author.fullName}").otherwise(F.col("source")).alias("author"),
        F.split_part("text", F.lit("."), F.lit(1)).alias("title"), F.col("text").alias("description"),
        F.lit(None).cast("string").alias("image_url"),
        F.when(F.col("lang") == "fr", "yesterday").when(headlines, F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(published, "yyyy-MM-dd HH:mm:ss '+0000'")).alias("published_at"),
        F.col("lang").alias("language"))


@query(r"""
WITH d AS (SELECT d.*, doc_id AS page_id, coalesce(url, 'https://docs.example/' || doc_id) AS url
           FROM documents d LEFT JOIN pages p ON p.page_id = doc_id)
SELECT regexp_replace(regexp_replace(url, '\?.*', ''), '/$', '') AS url, 't_' || lang AS topic,
       CASE WHEN lang <> 'de' THEN source END AS author, string_split(text, '.')[1] AS title,
       CASE WHEN lang <> 'fr' THEN strftime(to_timestamp(1700000000 + page_id * 86399) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS published_at,
       lang AS language, source AS category,
       CASE WHEN lang = 'en' THEN 'newsapi.org/v2' ELSE 'api.currentsapi.services/v1' END AS source_apis,
       '2026-03-28T06:00:00+00:00' AS first_seen_at, CAST(1 AS BIGINT) AS version
FROM d
""")
def normalise_articles(spark, sf):
    return articles.normalise_articles(article_records(spark, sf), NOW).select(
        "url", "topic", "author", "title", F.date_format("published_at", DAY).alias("published_at"), "language",
        F.array_join("category", ",").alias("category"), F.array_join("source_apis", ",").alias("source_apis"),
        "first_seen_at", F.col("version").cast("bigint").alias("version"))


ARTICLE_URL_SQL = r"regexp_replace(regexp_replace(coalesce(url, 'https://docs.example/' || doc_id), '\?.*', ''), '/$', '')"


@query("WITH " + rules_sql(f"SELECT {ARTICLE_URL_SQL} AS id, string_split(text, '.')[1] AS text FROM documents LEFT JOIN pages ON page_id = doc_id") + f"""
SELECT {ARTICLE_URL_SQL} AS url,
       CASE WHEN lang = 'en' THEN 'newsapi.org/v2' ELSE 'api.currentsapi.services/v1' END || CASE WHEN lang IN ('en', 'es') THEN ',who' ELSE '' END AS source_apis,
       round(score, 3) AS score
FROM documents LEFT JOIN pages ON page_id = doc_id LEFT JOIN ruled ON id = {ARTICLE_URL_SQL}
""")
def score_articles(spark, sf):
    """Articles of two services, some found by a third one as well: one row per url, sources united, titles scored."""
    found = articles.normalise_articles(article_records(spark, sf), NOW)
    again = found.where("language IN ('en', 'es')").withColumns({
        "source_apis": F.array(F.lit("who")), "published_at": F.lit(None).cast("timestamp")})
    words = spark.createDataFrame(list(RULE_LEXICON.items()), "word string, score double")
    return articles.score_articles(found.unionByName(again), words, RULES).select(
        "url", F.array_join("source_apis", ",").alias("source_apis"), F.round("media_sentiment_score", 3).alias("score"))


@query("""
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
SELECT o_orderkey || '' AS title, 'emergencies' AS topic,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'sum ' || o_custkey ELSE
         'Start Date ' || d || CASE WHEN o_orderstatus = 'F' THEN ' End Date ' || d ELSE '' END
         || CASE WHEN o_orderpriority <> '1-URGENT' THEN ' Rating ' || o_orderpriority ELSE '' END END AS description,
       d || ' 00:00:00' AS published_at, 'health_emergency' AS category, 'https://who.example/' || o_custkey AS url
FROM o
UNION ALL
SELECT c_name, 'disease_outbreak', c_mktsegment, NULL, 'health_emergency', 'https://who.example/c/' || c_custkey FROM customer
""")
def normalise_who(spark, sf):
    orders = table(spark, sf, "orders")
    stamp = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    emergencies = orders.select(
        F.lit("www.who.int").alias("source_api"), text_of("o_orderkey").alias("title"), stamp.alias("published"),
        stamp.alias("start_date"), F.when(F.col("o_orderstatus") == "F", stamp).otherwise("").alias("end_date"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).otherwise("").alias("rating"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("sum "), text_of("o_custkey"))).otherwise("").alias("summary"),
        F.concat(F.lit("https://who.example/"), text_of("o_custkey"), F.lit("/?lang=en")).alias("url"))
    outbreaks = table(spark, sf, "customer").select(
        F.lit("www.who.int").alias("source_api"), F.col("c_name").alias("title"), F.lit("soon").alias("published"),
        F.col("c_mktsegment").alias("summary"), F.concat(F.lit("https://who.example/c/"), text_of("c_custkey"), F.lit("/")).alias("url"))
    return articles.normalise_who(emergencies, outbreaks, NOW).select(
        "title", "topic", "description", F.date_format("published_at", DAY).alias("published_at"),
        F.array_join("category", ",").alias("category"), "url")


@query("""
SELECT c_name AS title, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'later' END AS published,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'http://x/' || c_custkey WHEN c_mktsegment = 'MACHINERY' THEN ''
            ELSE 'https://agency.example/' || c_custkey END AS url, CASE WHEN c_acctbal > 5000 THEN 'long' ELSE 'over' END AS summary
FROM customer
""")
def flatten_who(spark, sf):
    segment = F.col("c_mktsegment")
    raw = table(spark, sf, "customer").select(
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("Title"),
        F.when(F.col("c_acctbal") > 0, segment).otherwise("").alias("PublicationDateAndTime"), F.lit("later").alias("FormatedDate"),
        F.when(segment == "BUILDING", F.concat(F.lit("http://x/"), text_of("c_custkey"))).when(segment == "MACHINERY", "")
        .otherwise(F.concat(F.lit("/"), text_of("c_custkey"))).alias("ItemDefaultUrl"),
        F.when(F.col("c_acctbal") > 5000, "long").otherwise("").alias("Summary"), F.lit("over").alias("Overview"),
        F.lit("p").alias("Provider"), F.lit(None).cast("string").alias("PublicationDate"),
        F.lit("").alias("EmergencyStartDate"), F.lit("").alias("EmergencyEndDate"), F.lit("").alias("EmergencyRatingTextual"))
    base = "https://agency.example"
    outbreak = articles.flatten_who(raw, "outbreak", base).select("title", "published", "url")
    emergency = articles.flatten_who(raw, "emergency", base).select("title", "summary")
    return outbreak.join(emergency, "title").select("title", "published", "url", "summary")


@query(f"""
WITH h AS (SELECT coalesce(url, 'https://docs.example/' || doc_id) AS url, trim(' ' || source || ' ') AS title, text, lang,
                  lower(' ' || source || '  ' || text) AS hay
           FROM documents LEFT JOIN pages ON page_id = doc_id)
SELECT url, title, CASE {NEWS_CASES} ELSE lang || '_general' END AS topic, lang AS category, 'src' AS source FROM h
""")
def flatten_news(spark, sf):
    docs = dealt(spark, sf, "documents")
    url = F.coalesce("url", F.concat(F.lit("https://docs.example/"), text_of("doc_id")))
    raw = docs.join(table(spark, sf, "pages"), F.col("page_id") == F.col("doc_id"), "left").select(
        F.col("lang").alias("category"), F.struct(F.lit("src").alias("name")).alias("source"),
        F.lit(None).cast("string").alias("author"), F.concat(F.lit(" "), docs["source"], F.lit(" ")).alias("title"),
        F.col("text").alias("description"), url.alias("url"), F.lit(None).cast("string").alias("urlToImage"),
        F.lit(None).cast("string").alias("publishedAt"), F.lit(None).cast("string").alias("content"))
    return articles.flatten_news(raw, NEWS_TOPICS).select("url", "title", "topic", "category", "source")


@query("""
SELECT c_name AS title, CASE WHEN c_acctbal > 5000 THEN c_mktsegment ELSE '' END AS news_type,
       CASE WHEN c_acctbal > 0 THEN 'shown' ELSE c_mktsegment END AS published,
       'https://agency.example/' || c_custkey AS url, 'k' || c_nationkey AS source_key, '' AS provider
FROM customer
""")
def flatten_who_general(spark, sf):
    segment, none = F.col("c_mktsegment"), F.lit(None).cast("string")
    raw = table(spark, sf, "customer").select(
        F.concat("c_name", F.lit("  ")).alias("Title"), F.when(F.col("c_acctbal") > 5000, segment).alias("NewsType"),
        F.when(F.col("c_acctbal") > 0, "shown").otherwise("").alias("FormatedDate"), segment.alias("PublicationDateAndTime"),
        F.concat(F.lit("/"), text_of("c_custkey")).alias("ItemDefaultUrl"),
        F.concat(F.lit("k"), text_of("c_nationkey")).alias("SystemSourceKey"), none.alias("Provider"))
    return articles.flatten_who(raw, "general", "https://agency.example")


CURRENTS_CASES = "".join(
    f"WHEN {' OR '.join(f'contains(hay, $t${p}$t$)' for p in phrases)} THEN '{label}' " for label, phrases in CURRENTS_TOPICS.items())


@query(f"""
WITH phrases AS (SELECT unnest([{', '.join(f"$t${p}$t$" for group in CURRENTS_TOPICS.values() for p in group)}]) AS phrase,
                        unnest(range({sum(map(len, CURRENTS_TOPICS.values()))})) AS n),
h AS (SELECT o_orderkey, o_orderpriority, lower(trim('On ' || coalesce(phrase, 'nothing')) || ' ' || o_orderpriority) AS hay
      FROM orders LEFT JOIN phrases ON n = o_orderkey % 90)
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE {CURRENTS_CASES} ELSE o_orderpriority || '_general' END AS topic FROM h
""")
def flatten_currents_topics(spark, sf):
    """The service's own topics, each phrase of them in some titles."""
    phrases = [p for group in CURRENTS_TOPICS.values() for p in group]
    phrase = F.coalesce(F.get(F.array(*map(F.lit, phrases)), (F.col("o_orderkey") % 90).cast("int")), F.lit("nothing"))
    none = F.lit(None).cast("string")
    raw = table(spark, sf, "orders").select(
        text_of("o_orderkey").alias("id"), F.col("o_orderpriority").alias("search"), F.concat(F.lit("On "), phrase).alias("title"),
        F.col("o_orderpriority").alias("description"), none.alias("url"), none.alias("image"), none.alias("published"),
        none.alias("author"), F.array("o_orderstatus").alias("category"), F.lit("en").alias("language"))
    return articles.flatten_currents(raw).select("id", "topic")


@query(f"""
WITH h AS (SELECT doc_id, source, lang, lower(source || ' ' || text) AS hay FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, CASE {TOPIC_CASES} ELSE lang || '_general' END AS topic, lang AS language FROM h
""")
def flatten_currents(spark, sf):
    raw = dealt(spark, sf, "documents").select(
        text_of("doc_id").alias("id"), F.col("lang").alias("search"), F.concat(F.lit("  "), "source").alias("title"),
        F.col("text").alias("description"), F.lit("").alias("url"), F.lit("").alias("image"), F.lit("").alias("published"),
        F.lit("").alias("author"), F.array("lang").alias("category"), F.col("lang").alias("language"))
    return articles.flatten_currents(raw, TOPICS).select("id", "title", "topic", "language")


# ── publications and awards ──────────────────────────────────────────────────

def work_records(spark, sf) -> DataFrame:
    """Documents as work records; German ones have no id, French ones a null second one."""
    def ident(kind, value) -> F.Column:
        return F.struct(kind.alias("type"), value.alias("identifier"))
    doc = text_of("doc_id")
    return dealt(spark, sf, "documents").select(
        F.lit("api.core.ac.uk").alias("source_api"),
        F.array(ident(F.lit("OAI"), doc), ident(F.when(F.col("lang") == "de", "OTHER").otherwise("CORE_ID"), doc),
                ident(F.lit("DOI"), F.when(F.col("lang") != "fr", F.concat(F.lit("10.1/"), doc))),
                ident(F.lit("DOI"), F.concat(F.lit("10.2/"), doc))).alias("identifiers"),
        F.array(F.struct(F.col("source").alias("name")), F.struct(F.col("lang").alias("name"))).alias("authors"),
        F.array(F.struct(F.lit(None).cast("string").alias("title")), F.struct(F.concat(F.lit("J "), "lang").alias("title"))).alias("journals"),
        F.col("source").alias("title"), F.col("text").alias("abstract"),
        F.when(F.col("n_chars") > 100, F.date_format(F.timestamp_seconds(F.col("n_chars") * 100_000), "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise("n/a").alias("publishedDate"),
        F.col("n_chars").alias("yearPublished"), F.col("lang").alias("fieldOfStudy"), F.lit("").alias("downloadUrl"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS work_id, CASE WHEN lang <> 'fr' THEN '10.1/' ELSE '10.2/' END || doc_id AS doi,
       CAST(NULL AS VARCHAR) AS pubmed_id, source || ',' || lang AS authors, 'J ' || lang AS journal,
       CASE WHEN n_chars > 100 THEN strftime(to_timestamp(n_chars * 100000) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS published_at,
       n_chars AS year_published, length(text) AS abstract_length
FROM documents WHERE lang <> 'de'
""")
def normalise_works(spark, sf):
    return publications.normalise_works(work_records(spark, sf), NOW).select(
        "work_id", "doi", "pubmed_id", F.array_join("authors", ",").alias("authors"), "journal",
        F.date_format("published_at", DAY).alias("published_at"), F.col("year_published").cast("bigint").alias("year_published"),
        F.char_length("abstract").cast("bigint").alias("abstract_length"))


@query(f"""
WITH known(id, name) AS (VALUES {', '.join(f"({i}, $t${name}$t$)" for i, name in SPENDING_CATEGORIES.items())})
SELECT p_partkey AS appl_id, coalesce(a.name, 'Category ' || p_size) || '|' || coalesce(b.name, 'Category ' || (p_size + 100)) AS spending_categories
FROM part LEFT JOIN known a ON a.id = p_size LEFT JOIN known b ON b.id = p_size + 100
""")
def flatten_award_known(spark, sf):
    """Category ids by the service's own list."""
    none = F.lit(None).cast("string")
    people = F.lit(None).cast("array<struct<full_name: string>>")
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").alias("appl_id"), F.array("p_size", F.col("p_size") + 100).alias("spending_categories"),
        *[none.alias(c) for c in ("project_num", "project_title", "abstract_text", "phr_text", "project_start_date", "project_end_date",
                                  "org_name", "org_city", "org_state", "org_country", "agency_code", "activity_code", "funding_mechanism",
                                  "rcdc_terms", "project_terms", "award_notice_date", "budget_start", "budget_end", "project_detail_url",
                                  "spending_categories_desc")],
        F.lit(2020).alias("fiscal_year"), *[F.lit(0.0).alias(c) for c in ("award_amount", "direct_cost_amt", "indirect_cost_amt")],
        people.alias("principal_investigators"), people.alias("program_officers"))
    return publications.flatten_award(raw).select("appl_id", F.array_join("spending_categories", "|").alias("spending_categories"))


@query("""
SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS appl_id, o_orderpriority AS title,
       CASE WHEN o_orderstatus = 'F' THEN 'Aging,' || o_orderpriority
            WHEN o_orderstatus = 'O' THEN n_name || ',Category ' || (n_nationkey + 100)
            ELSE '' END AS spending_categories, c_name AS principal_investigators, round(o_totalprice, 2) AS award_amount
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
""")
def flatten_award(spark, sf):
    nation = table(spark, sf, "nation")
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .withColumn("nat", F.col("c_nationkey"))
    none, person = F.lit(None).cast("string"), "struct<full_name: string>"
    status = F.col("o_orderstatus")
    raw = rows.select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("appl_id"), none.alias("project_num"), F.concat(F.lit(" "), "o_orderpriority").alias("project_title"),
        none.alias("abstract_text"), none.alias("phr_text"), F.year("o_orderdate").alias("fiscal_year"),
        *[none.alias(c) for c in ("project_start_date", "project_end_date", "org_name", "org_city", "org_state", "org_country",
                                  "agency_code", "activity_code", "funding_mechanism", "rcdc_terms", "project_terms",
                                  "award_notice_date", "budget_start", "budget_end", "project_detail_url")],
        F.col("o_totalprice").alias("award_amount"), F.lit(0.0).alias("direct_cost_amt"), F.lit(0.0).alias("indirect_cost_amt"),
        F.array(F.struct(F.col("c_name").alias("full_name")), F.struct(F.lit("").alias("full_name"))).alias("principal_investigators"),
        F.lit(None).cast(f"array<{person}>").alias("program_officers"),
        F.when(status == "F", F.concat(F.lit("Aging; "), "o_orderpriority", F.lit(" ;")))
        .when(F.col("o_orderkey") % 2 == 0, "[]").otherwise("").alias("spending_categories_desc"),
        F.when(status == "P", F.lit(None)).otherwise(F.array(F.col("nat"), F.col("nat") + 100)).alias("spending_categories"))
    categories = nation.select(F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("category_name"))
    return publications.flatten_award(raw, categories).select(
        "appl_id", "title", F.array_join("spending_categories", ",").alias("spending_categories"),
        F.array_join("principal_investigators", ",").alias("principal_investigators"), F.round("award_amount", 2).alias("award_amount"))


# ── burden data ──────────────────────────────────────────────────────────────

@query("WITH " + EXPORT_SQL + """
SELECT l_partkey AS cause, n_nationkey AS location, yr AS year, l_quantity AS val, 'IHME' AS source_data,
       p_size || '|' || l_partkey || '|' || n_nationkey || '|2|1|1|3|' || yr AS row_key,
       '2026-03-28 06:00:00' AS last_updated
FROM x
""")
def gbd_cleanup(spark, sf):
    return burden.normalise_gbd(burden_export(spark, sf), NOW).select(
        "cause", "location", "year", "val", "source_data", "row_key", F.date_format("last_updated", DAY).alias("last_updated"))


def indicator_raw(spark, sf) -> DataFrame:
    """Orders as raw indicator values: countries, regions and other places, some sexes."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return rows.select(
        F.concat(F.lit("IND_"), "c_mktsegment").alias("IndicatorCode"),
        F.when(status == "F", "COUNTRY").when(status == "O", "REGION").otherwise("WORLD").alias("SpatialDimType"),
        F.col("n_name").alias("SpatialDim"), F.concat(F.lit("R"), text_of("n_regionkey")).alias("ParenLocationCode"),
        F.year("o_orderdate").alias("TimeDim"),
        F.when(priority == "5-LOW", "AGE").otherwise("SEX").alias("Dim1Type"),
        F.when(priority == "1-URGENT", "SEX_MLE").when(priority == "2-HIGH", "SEX_FMLE").otherwise("SEX_OTHER").alias("Dim1"),
        F.when(F.col("o_totalprice") > 400000, "n/a").otherwise(text_of("o_custkey")).alias("Value"),
        F.when(F.col("o_totalprice") < 200000, F.col("o_totalprice")).alias("NumericValue"), F.lit(0.0).alias("Low"),
        F.lit(1.0).alias("High"), text_of("o_orderkey").alias("Comments"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("Date"),
        F.lit("").alias("TimeDimensionBegin"), F.lit("").alias("TimeDimensionEnd"))


def indicator_metadata(spark, sf) -> DataFrame:
    """Ids for four market segments, for the nations of four regions, and for the sexes."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    causes = customer.filter("c_mktsegment <> 'BUILDING'").select("c_mktsegment").distinct().select(
        F.concat(F.lit("IND_"), "c_mktsegment").alias("id"),
        F.char_length("c_mktsegment").cast("string").alias("name"), F.lit("gho_ihme_cause").alias("dimension"))
    places = nation.filter("n_regionkey <> 2").select(
        F.col("n_name").alias("id"), text_of("n_nationkey").alias("name"), F.lit("gho_ihme_country").alias("dimension"))
    from tidewell.functions.fixed_values import SEX_ID
    return causes.unionByName(places).unionByName(lookups.static_rows(spark, SEX_ID, "gho_ihme_sex"))


INDICATOR_SQL = """
r AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'COUNTRY' WHEN 'O' THEN 'REGION' ELSE 'WORLD' END AS sdt,
             CASE WHEN c_mktsegment <> 'BUILDING' THEN length(c_mktsegment) END AS cause,
             CASE WHEN o_orderstatus = 'F' AND n_regionkey <> 2 THEN n_nationkey END AS location,
             CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END AS sex,
             CASE WHEN o_totalprice < 200000 THEN o_totalprice WHEN o_totalprice <= 400000 THEN CAST(o_custkey AS DOUBLE) END AS val,
             year(o_orderdate) AS yr
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
"""


@query("WITH " + INDICATOR_SQL + """
SELECT CAST(cause AS BIGINT) AS cause, CAST(location AS BIGINT) AS location, CAST(sex AS BIGINT) AS sex, yr AS year, val,
       concat_ws('|', 27, cause, location, 2, 3, 1, sex, yr) AS row_key, 'GHO' AS source_data,
       strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS last_updated
FROM r
""")
def normalise_gho(spark, sf):
    records = burden.clean_gho_record(indicator_raw(spark, sf))
    return burden.normalise_gho(records, indicator_metadata(spark, sf)).select(
        "cause", "location", "sex", "year", "val", "row_key", "source_data", F.date_format("last_updated", DAY).alias("last_updated"))


@query("WITH " + INDICATOR_SQL + """
SELECT DISTINCT 'cause' AS dimension, 'IND_' || c_mktsegment AS value FROM r WHERE cause IS NULL
UNION ALL SELECT DISTINCT 'location', n_name FROM r WHERE sdt = 'COUNTRY' AND location IS NULL
UNION ALL SELECT DISTINCT 'sex', 'SEX_OTHER' FROM r WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')
""")
def conditional_lookup(spark, sf):
    """Source values without an id, each under its own condition."""
    return burden.unmapped_report(burden.clean_gho_record(indicator_raw(spark, sf)), indicator_metadata(spark, sf))


@query("WITH " + INDICATOR_SQL + """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN sdt = 'COUNTRY' THEN n_name ELSE '' END AS country_code,
       CASE sdt WHEN 'COUNTRY' THEN 'R' || n_regionkey WHEN 'REGION' THEN n_name ELSE '' END AS region_code
FROM r WHERE yr IN (1996, 1999) AND n_name IN ('NATION_3', 'NATION_7', 'NATION_11', 'NATION_20') AND sdt <> 'WORLD'
  AND sdt = 'COUNTRY'
""")
def filter_gho(spark, sf):
    records = burden.clean_gho_record(indicator_raw(spark, sf))
    kept = burden.filter_gho(records, [1996, 1999], ["nation_3", "nation_7", "nation_11", "nation_20"], "country")
    return kept.select(F.col("comments").alias("id"), "country_code", "region_code")


@query("WITH " + INDICATOR_SQL + """
SELECT string_agg(DISTINCT yr, ',' ORDER BY yr) AS years, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS regions,
       string_agg(DISTINCT sdt, ',' ORDER BY sdt) AS types FROM r
""")
def gho_available(spark, sf):
    sets = burden.gho_available(burden.clean_gho_record(indicator_raw(spark, sf)))
    return sets.select(F.array_join("available_years", ",").alias("years"),
                       F.array_join("available_regions", ",").alias("regions"),
                       F.array_join("available_spatial_types", ",").alias("types"))
