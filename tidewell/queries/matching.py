"""Text-to-code matching on documents, benchmark passages and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import clean_text, words
from tidewell.operators import containment, matching as m
from tidewell.plans import publications
from tidewell.queries import dealt, query, table
from tidewell.schemas import PUBLICATIONS

LANGUAGE_CODES = r"\b(DE|EN|ES|FR)\b"


def passage_catalogue(spark, sf) -> DataFrame:
    """Benchmark passages as a catalogue: the passage is the title, its sentences the terms."""
    return table(spark, sf, "benchmark").select(
        F.concat(F.lit("B"), F.col("item_id").cast("string")).alias("icd_code"),
        F.col("text").alias("title"), F.split("text", r"\.").alias("index_terms"),
        F.concat(F.lit("ch"), F.char_length("text").cast("string")).alias("chapter"))


def language_catalogue(spark, sf) -> DataFrame:
    """The document languages as catalogue codes."""
    return dealt(spark, sf, "documents").select(F.upper("lang").alias("icd_code")).distinct().select(
        "icd_code", F.concat(F.lit("Language "), "icd_code").alias("title"), F.lit("language").alias("chapter"))


CLEAN = "regexp_replace(lower({0}), '[^a-z0-9\\s]', ' ', 'g')"
WORDS = "list_distinct(list_filter(string_split(" + CLEAN + ", ' '), lambda w: length(w) >= 3))"

CODES_SQL = r"""
WITH found AS (
  SELECT p_partkey, unnest(list_distinct(list_concat(
           regexp_extract_all(t, '\bBRAND#[0-9]+'), regexp_extract_all(t, '\b[A-Z]{3,}\b')))) AS icd_code
  FROM (SELECT p_partkey, upper('order 12, part ' || p_brand || ' ' || p_name || ' ' || p_type) AS t FROM part)),
valid AS (SELECT DISTINCT 'BRAND#' || s_nationkey AS icd_code FROM supplier
          UNION SELECT DISTINCT upper(string_split(p_name, ' ')[1]) FROM part WHERE p_type = 'PROMO')
SELECT p_partkey, icd_code FROM found WHERE icd_code IN (SELECT icd_code FROM valid)
"""


@query(CODES_SQL)
def match_codes(spark, sf):
    part = table(spark, sf, "part")
    text = F.concat(F.lit("order 12, part "), "p_brand", F.lit(" "), "p_name", F.lit(" "), "p_type")
    brands = table(spark, sf, "supplier").select(
        F.concat(F.lit("BRAND#"), F.col("s_nationkey").cast("string")).alias("icd_code"))
    colours = part.filter("p_type = 'PROMO'").select(
        F.upper(F.get(F.split("p_name", " "), F.lit(0))).alias("icd_code"))
    return m.match_codes(part, "p_partkey", text, brands.unionByName(colours), "icd_code",
                         [r"\bBRAND#[0-9]+", r"\b[A-Z]{3,}\b"])


TERMS_SQL = rf"""
raw AS (SELECT 'B' || item_id AS icd_code, text AS term FROM benchmark
        UNION ALL SELECT 'B' || item_id, unnest(string_split(text, '.')) FROM benchmark),
terms AS (
  SELECT name, min(icd_code) AS icd_code, len(string_split(name, ' ')) AS wc,
         string_split(name, ' ')[1] AS first_word,
         CASE WHEN len(string_split(name, ' ')) = 1 THEN ' ' || name || ' ' ELSE name END AS search_name
  FROM (SELECT icd_code, trim({CLEAN.format('term')}) AS name FROM raw WHERE length(term) >= 5) GROUP BY name)
"""

DICTIONARY_SQL = rf"""
WITH {TERMS_SQL},
docs AS (SELECT doc_id, ' ' || trim({CLEAN.format('text')}) || ' ' AS t,
                ' ' || trim({CLEAN.format('source')}) || ' ' AS title FROM documents),
probe AS (SELECT doc_id, t, title, unnest(list_distinct(string_split(t, ' '))) AS first_word FROM docs),
hits AS (SELECT doc_id, icd_code, name, wc, contains(title, search_name) AS in_title
         FROM probe JOIN terms USING (first_word)
         WHERE length(first_word) >= 3 AND contains(t, search_name)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY wc DESC, in_title DESC, name) AS rn FROM hits)
"""


def passage_terms(spark, sf) -> DataFrame:
    return m.build_terms(passage_catalogue(spark, sf), clean_terms=True)


@query("WITH " + TERMS_SQL + """
SELECT name, icd_code, CAST(wc AS BIGINT) AS wc, first_word, search_name FROM terms
""")
def build_terms(spark, sf):
    return passage_terms(spark, sf).withColumn("wc", F.col("wc").cast("bigint"))


def dictionary_hits(spark, sf) -> DataFrame:
    docs = dealt(spark, sf, "documents")
    return m.match_dictionary(docs, "doc_id", F.col("source"), F.col("text"), passage_terms(spark, sf))


@query(DICTIONARY_SQL + "SELECT doc_id, icd_code, name FROM best WHERE rn = 1")
def match_dictionary(spark, sf):
    return dictionary_hits(spark, sf)


JACCARD_SQL = rf"""
d AS (SELECT doc_id, {WORDS.format('text')} AS toks FROM documents),
b AS (SELECT 'B' || item_id AS icd_code,
             {WORDS.format("(text || ' ' || array_to_string(string_split(text, '.'), ' '))")} AS toks FROM benchmark),
dt AS (SELECT doc_id, len(toks) AS n1, unnest(toks) AS token FROM d WHERE len(toks) >= 3),
bt AS (SELECT icd_code, len(toks) AS n2, unnest(toks) AS token FROM b),
shared AS (SELECT doc_id, icd_code, n1, n2, count(*) AS s FROM dt JOIN bt USING (token) GROUP BY ALL),
scored AS (SELECT doc_id, icd_code, s / (n1 + n2 - s) AS jaccard FROM shared),
fuzzy AS (SELECT doc_id, icd_code, jaccard FROM (
            SELECT *, max(jaccard) OVER (PARTITION BY doc_id) AS top FROM scored WHERE jaccard >= 0.2)
          WHERE jaccard = top)
"""


def jaccard_hits(spark, sf) -> DataFrame:
    tokens = m.code_tokens(passage_catalogue(spark, sf))
    return m.match_jaccard(dealt(spark, sf, "documents"), "doc_id", F.col("text"), tokens, min_score=0.2)


@query("WITH " + JACCARD_SQL + "SELECT doc_id, icd_code, round(jaccard, 6) AS jaccard FROM fuzzy")
def match_jaccard(spark, sf):
    return jaccard_hits(spark, sf).withColumn("jaccard", F.round("jaccard", 6))


RESOLVED_SQL = DICTIONARY_SQL + "," + JACCARD_SQL + r""",
lang AS (SELECT DISTINCT upper(lang) AS icd_code FROM documents),
regex AS (SELECT doc_id, icd_code FROM documents, lang
          WHERE regexp_matches(upper(text), '(^|[^\p{L}\p{M}\p{N}_])' || icd_code || '($|[^\p{L}\p{M}\p{N}_])')),
ranked AS (SELECT doc_id, icd_code, 0 AS r FROM regex
           UNION ALL SELECT doc_id, icd_code, 1 FROM best WHERE rn = 1
           UNION ALL SELECT doc_id, icd_code, 2 FROM fuzzy),
top AS (SELECT doc_id, icd_code, r FROM (SELECT *, min(r) OVER (PARTITION BY doc_id) AS lo FROM ranked) WHERE r = lo),
cat AS (SELECT 'B' || item_id AS icd_code, text AS title, 'ch' || length(text) AS chapter FROM benchmark
        UNION ALL SELECT icd_code, 'Language ' || icd_code, 'language' FROM lang),
per AS (SELECT doc_id, min(r) AS r, string_agg(icd_code, ',' ORDER BY icd_code) AS codes,
               string_agg(title, '|' ORDER BY icd_code) AS titles,
               string_agg(DISTINCT chapter, ',' ORDER BY chapter) AS chapters
        FROM top JOIN cat USING (icd_code) GROUP BY doc_id),
resolved AS (
  SELECT d.doc_id, coalesce(codes, '') AS codes, coalesce(titles, '') AS titles, coalesce(chapters, '') AS chapters,
         CASE r WHEN 0 THEN 'regex' WHEN 1 THEN 'substring' WHEN 2 THEN 'fuzzy' ELSE 'none' END AS match_method
  FROM documents d LEFT JOIN per USING (doc_id))
"""


def resolved(spark, sf) -> DataFrame:
    docs = dealt(spark, sf, "documents")
    languages = language_catalogue(spark, sf)
    by_code = m.match_codes(docs, "doc_id", F.col("text"), languages, "icd_code", [LANGUAGE_CODES])
    catalogue = passage_catalogue(spark, sf).select("icd_code", "title", "chapter").unionByName(languages)
    return m.resolve_codes(docs.select("doc_id"), "doc_id", by_code, dictionary_hits(spark, sf),
                           jaccard_hits(spark, sf), catalogue)


@query(RESOLVED_SQL + "SELECT * FROM resolved")
def resolve_codes(spark, sf):
    return resolved(spark, sf).select(
        "doc_id", F.array_join("icd_11_codes", ",").alias("codes"),
        F.array_join("icd_11_titles", "|").alias("titles"),
        F.array_join("icd_chapters", ",").alias("chapters"), "match_method")


@query(RESOLVED_SQL + "SELECT match_method, CAST(count(*) AS BIGINT) AS n FROM resolved GROUP BY 1")
def match_stats(spark, sf):
    return m.match_stats(resolved(spark, sf))


@query(r"""
WITH works AS (
  SELECT p_partkey, p_name AS title,
         CASE p_partkey % 4 WHEN 0 THEN 'Seen as ' || chr(CAST(65 + p_size % 26 AS INTEGER)) || lpad(CAST(p_size AS VARCHAR), 2, '0') || ' here'
              WHEN 1 THEN 'A case of supplier illness ' || (p_partkey % 120) || ' again' ELSE '' END AS abstract
  FROM part),
cat AS (
  SELECT chr(CAST(65 + s_suppkey % 26 AS INTEGER)) || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS code, s_suppkey,
         'supplier illness ' || s_suppkey AS title,
         CASE WHEN s_suppkey % 10 = 3 THEN 'x' ELSE 'chapter ' || s_nationkey END AS chapter
  FROM supplier),
usable AS (SELECT * FROM cat WHERE chapter <> 'x'),
regex AS (SELECT DISTINCT p_partkey, code FROM works JOIN usable
          ON abstract = 'Seen as ' || code || ' here'),
sub AS (
  SELECT p_partkey, code FROM (
    SELECT p_partkey, code, row_number() OVER (PARTITION BY p_partkey ORDER BY u.title) AS rn
    FROM works w JOIN usable u ON contains(' ' || w.title || ' ' || abstract || ' ', u.title)
    WHERE abstract LIKE 'A case%') WHERE rn = 1),
best AS (SELECT p_partkey, code, 'regex' AS how FROM regex
         UNION ALL SELECT p_partkey, code, 'substring' FROM sub WHERE p_partkey NOT IN (SELECT p_partkey FROM regex))
SELECT CAST(w.p_partkey AS VARCHAR) AS work_id, coalesce(string_agg(DISTINCT best.code, ',' ORDER BY best.code), '') AS codes,
       coalesce(string_agg(DISTINCT cat.title, '|' ORDER BY cat.title), '') AS titles, coalesce(min(how), 'none') AS match_method
FROM works w LEFT JOIN best USING (p_partkey) LEFT JOIN cat ON cat.code = best.code GROUP BY w.p_partkey
""")
def code_works(spark, sf):
    """The publication job: default patterns, excluded chapters and all three matches on one catalogue."""
    size, suppkey = F.col("p_size"), F.col("s_suppkey")
    def code(n, digits) -> F.Column:
        return F.concat(F.char((65 + n % 26).cast("int")), F.lpad(digits.cast("string"), 2, "0"))
    abstract = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("Seen as "), code(size, size), F.lit(" here"))).when(
        F.col("p_partkey") % 4 == 1, F.concat(F.lit("A case of supplier illness "), (F.col("p_partkey") % 120).cast("string"), F.lit(" again"))).otherwise("")
    works = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("work_id"), F.col("p_name").alias("title"), abstract.alias("abstract"))
    for field in PUBLICATIONS.fields:
        if field.name not in (*works.columns, "icd_11_codes", "icd_11_titles", "icd_chapters", "match_method"):
            works = works.withColumn(field.name, F.lit(None).cast(field.dataType))
    catalogue = table(spark, sf, "supplier").select(
        code(suppkey, suppkey % 100).alias("icd_code"), F.concat(F.lit("supplier illness "), suppkey.cast("string")).alias("title"),
        F.array().cast("array<string>").alias("index_terms"),
        F.when(suppkey % 10 == 3, "x").otherwise(F.concat(F.lit("chapter "), F.col("s_nationkey").cast("string"))).alias("chapter"))
    return publications.code_works(works, catalogue).select(
        "work_id", F.array_join("icd_11_codes", ",").alias("codes"), F.array_join(F.array_sort("icd_11_titles"), "|").alias("titles"), "match_method")


@query("""
WITH names AS (SELECT DISTINCT p_name AS a FROM part),
words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS b FROM part
          UNION SELECT DISTINCT p_name || ' ' || p_type FROM part)
SELECT a AS name, b AS term FROM names, words
WHERE contains(lower(a), lower(b)) OR contains(lower(b), lower(a))
""")
def theta_name_match(spark, sf):
    part = table(spark, sf, "part")
    names = part.select(F.col("p_name").alias("name")).distinct()
    terms = part.select(F.explode(F.split("p_name", " ")).alias("term")).unionByName(
        part.select(F.concat("p_name", F.lit(" "), "p_type").alias("term"))).distinct()
    return containment.name_match(names, "name", "name", terms, "term", "term")


@query("""
WITH d AS (SELECT s_suppkey, 'Nation_' || s_nationkey AS label FROM supplier)
SELECT DISTINCT label, n_name AS name FROM d, nation
WHERE contains(lower(label), lower(n_name)) OR contains(lower(n_name), lower(label))
""")
def name_match_codes(spark, sf):
    """Names that differ in case, one a prefix of the other (NATION_1, NATION_11)."""
    labels = table(spark, sf, "supplier").select(
        F.concat(F.lit("Nation_"), F.col("s_nationkey").cast("string")).alias("label")).distinct()
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    return containment.name_match(labels, "label", "label", nations, "name", "name")


@query(rf"""
SELECT doc_id, CAST(len({WORDS.format('text')}) AS BIGINT) AS n_words,
       array_to_string(list_sort({WORDS.format('text')}), ',') AS words
FROM documents
""")
def word_sets(spark, sf):
    toks = words(clean_text(F.col("text")))
    return dealt(spark, sf, "documents").select(
        "doc_id", F.size(toks).cast("bigint").alias("n_words"),
        F.array_join(F.array_sort(toks), ",").alias("words"))
