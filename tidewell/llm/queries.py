"""One query per operator over its whole table, with SQL where SQL can state it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import crf, licences, toxicity
from tidewell.llm.bpe import round_trip, share_tables
from tidewell.llm.ctph import compare_with_next
from tidewell.llm.divergence import audit_sources
from tidewell.llm.filter_audit import audit_filters
from tidewell.llm.html_text import extract_text
from tidewell.llm.labelled import held_out
from tidewell.llm.line_dedup import dedup_lines
from tidewell.llm.minhash import near_duplicate_classes
from tidewell.llm.mixing import mix_sources
from tidewell.llm.topk import top_k
from tidewell.llm.url_rules import judge_urls

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


OP7_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS n,
    translate(trim(unnest(lines), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM docs),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT r, n, line, r2.key IS NOT NULL AND l.doc_id IS DISTINCT FROM r2.holder AS gone
  FROM lines l LEFT JOIN repeated r2 USING (key)),
kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN kept USING (r)
"""


@query(OP7_SQL)
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size) OVER b, 0) * 2)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM sources
  WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least((source_size * 2)::DOUBLE, max(level) OVER () * weight) AS target FROM levels),
grouped AS (SELECT doc_id, source, size, count(*) AS copies FROM sized GROUP BY ALL),
queued AS (
  SELECT g.*, target, pass, size * copies AS words,
    md5(coalesce(g.doc_id::VARCHAR, 'null') || ':' || pass) AS place
  FROM grouped g JOIN targets t ON g.source IS NOT DISTINCT FROM t.source, range(2) p(pass) WHERE size > 0),
finish AS (
  SELECT *, (sum(words) OVER (PARTITION BY source ORDER BY pass, place, size ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS finish
  FROM queued),
served AS (
  SELECT *, sum(words) OVER (ORDER BY finish, source NULLS LAST, pass, place, size ROWS UNBOUNDED PRECEDING) AS running FROM finish),
taken AS (
  SELECT doc_id, source, size, sum(size) AS taken FROM served
  WHERE running * 2 - words <= (SELECT sum(source_size) FROM targets) * 3 GROUP BY ALL)
SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
LEFT JOIN taken k ON s.doc_id IS NOT DISTINCT FROM k.doc_id AND s.source IS NOT DISTINCT FROM k.source AND s.size = k.size
"""


@query(OP9_SQL)
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_with_next(table(spark, folder, "documents"))


@query()
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    shared = share_tables(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return round_trip(docs, shared).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@query()
def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(table(spark, folder, "documents")).select("doc_id", "class_id", F.hex("root").alias("root"))


@query()
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = crf.train(docs, table(spark, folder, "labels"))
    return crf.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.3).cast("int").alias("predicted"))


@query()
def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))


OP4_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""


@query(OP4_SQL)
def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def _op2_sql() -> str:
    quoted = ", ".join(f"({i}, '{name}', '{wording}')" for i, (name, wording) in enumerate(licences.TEMPLATES))
    plain = "string_split(trim(regexp_replace(lower(words), '[^a-z0-9]+', ' ', 'g')), ' ')"
    pairs = "list_distinct(list_transform(list_zip(plain[:-2], plain[2:]), lambda p: p[1] || ' ' || p[2]))"
    return f"""
WITH templates(template, licence, words) AS (VALUES {quoted}),
t AS (SELECT template, licence, {pairs} AS pairs FROM (SELECT *, {plain} AS plain FROM templates)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT r, unnest(string_split(text, chr(10)) || list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: contains(p, chr(10)))) AS words,
    generate_subscripts(string_split(text, chr(10)) || list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: contains(p, chr(10))), 1) AS segment
  FROM docs),
s AS (SELECT r, segment, {pairs} AS pairs FROM (SELECT *, {plain} AS plain FROM cut)),
scored AS (
  SELECT r, segment, template, licence,
    2 * len(list_intersect(s.pairs, t.pairs))::DOUBLE / (len(s.pairs) + len(t.pairs)) AS dice
  FROM s JOIN t ON len(s.pairs) BETWEEN len(t.pairs) * 0.6 AND len(t.pairs) * 1.6),
best AS (
  SELECT * FROM scored WHERE dice >= 0.8
  QUALIFY row_number() OVER (PARTITION BY r, segment ORDER BY dice DESC, licence, template) = 1),
per_doc AS (
  SELECT r, count(*) AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, max(dice) AS best FROM best GROUP BY r)
SELECT doc_id, coalesce(n_notices, 0) AS n_notices, coalesce(licences, '') AS licences, best FROM docs LEFT JOIN per_doc USING (r)
"""


@query(_op2_sql())
def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_licences(table(spark, folder, "documents")).withColumn("licences", F.array_join("licences", ","))


RULES_SQL = "VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"

OP11_SQL = f"""
WITH rules(host, path, verdict) AS ({RULES_SQL}),
parts AS (
  SELECT row_number() OVER () AS r, page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT p.page_id, p.host, p.path, u.host || u.path AS rule, coalesce(u.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN rules u ON (p.host = u.host OR ends_with(p.host, '.' || u.host)) AND starts_with(p.path, u.path)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(u.host || u.path) DESC NULLS LAST, length(u.host) DESC) = 1
"""


@query(OP11_SQL)
def op11_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM ({RULES_SQL}) AS rules(host, path, verdict)")
    return judge_urls(table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
found AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 10),
used AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM used GROUP BY ALL) USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
    (1 + (1000000000 * (coalesce(u.n, 0) + 2)) // (g.total + 2 * l.v))::BIGINT AS p,
    (1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v))::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN used u ON (u.lang, u.source, u.term) = (g.lang, g.source, k.term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON (s.lang, s.source, s.item) = (a.lang, a.source, b.source)
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""


@query(OP12_SQL)
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(table(spark, folder, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(words) < 200)::INT + 2 * (100 * list_unique(words) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM docs JOIN firsts USING (text) LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask),
letters AS (SELECT substr('ABCDE', i + 1, 1) AS letter, 1 << i AS bit FROM range(5) r(i)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[:step])::INT AS after, list_sum(bits[:step])::INT - bits[step] AS before
  FROM orders, range(1, 6) s(step)),
counted AS (
  SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & after = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


@query(OP13_SQL)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))
