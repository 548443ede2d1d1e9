"""Crosswalks, catalogue links, hierarchies and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.fixed_values import INDICATOR_CAUSE, SEX_ID
from tidewell.functions.text import icd_chapter
from tidewell.operators import crosswalk, dedup, lookups
from tidewell.plans import burden, entities
from tidewell.queries import dealt, query, table
from tidewell.schemas import ICD_RECORD

# ── crosswalks: part and line -> suppliers as ICD-10 -> ICD-11 ────────────────────────


def code_maps(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(multi, one, reverse) maps from the line items, by return flag."""
    items = table(spark, sf, "lineitem")
    rows = items.select(
        F.concat_ws("-", F.lit("P"), "l_partkey", "l_linenumber").alias("icd10Code"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
        .otherwise("").alias("icd11Code"),
        F.col("l_linestatus").alias("icd11Chapter"), "l_returnflag")
    return tuple(rows.filter(F.col("l_returnflag") == flag) for flag in ("R", "A", "N"))


MAPS_SQL = """
rows AS (SELECT 'P-' || l_partkey || '-' || l_linenumber AS c10, CASE WHEN l_tax > 0 THEN 'S' || l_suppkey ELSE '' END AS c11,
                l_linestatus AS ch, l_returnflag AS flag FROM lineitem),
multi AS (SELECT * FROM rows WHERE flag = 'R' AND c11 <> ''),
one AS (SELECT * FROM rows WHERE flag = 'A' AND c11 <> '' AND c10 NOT IN (SELECT c10 FROM multi)),
pairs AS (SELECT c10, c11, ch FROM multi UNION ALL SELECT c10, c11, ch FROM one)
"""


@query("WITH " + MAPS_SQL + """
SELECT c10 AS "icd10Code", string_agg(DISTINCT c11, ',' ORDER BY c11) AS icd11_codes,
       string_agg(DISTINCT ch, ',' ORDER BY ch) AS icd11_chapter FROM pairs GROUP BY c10
""")
def crosswalk_nested(spark, sf):
    nested, _, _ = crosswalk.build_crosswalk(*code_maps(spark, sf))
    return nested.select("icd10Code", F.array_join("icd11_codes", ",").alias("icd11_codes"),
                         F.array_join("icd11_chapter", ",").alias("icd11_chapter"))


@query("WITH " + MAPS_SQL + 'SELECT DISTINCT c10 AS "icd10Code", c11 AS "icd11Code" FROM pairs')
def crosswalk_flat(spark, sf):
    _, flat, _ = crosswalk.build_crosswalk(*code_maps(spark, sf))
    return flat.select("icd10Code", "icd11Code")


@query("WITH " + MAPS_SQL + """
SELECT c11 AS "icd11Code", string_agg(DISTINCT c10, ',' ORDER BY c10) AS icd10_codes
FROM rows WHERE flag = 'N' GROUP BY c11
""")
def crosswalk_reverse(spark, sf):
    _, _, reverse = crosswalk.build_crosswalk(*code_maps(spark, sf))
    return reverse.select("icd11Code", F.array_join("icd10_codes", ",").alias("icd10_codes"))


# ── catalogue: regions, nations and customers as a code tree ─────────────────

BASE = "https://codes.example/mms/"


def code_records(spark, sf) -> DataFrame:
    """Flat code records; two codes share each nation's entity, one link leads nowhere."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customer = table(spark, sf, "customer")

    def uri(prefix: int, key: str) -> F.Column:
        return F.concat(F.lit(BASE), (F.col(key).cast("bigint") + prefix).cast("string"))

    def link(label, target) -> F.Column:
        return F.struct(label.alias("label"), target.alias("linearization_uri"), F.lit("").alias("foundation_uri"))

    nations = nation.select(
        F.concat(F.lit("1A"), F.col("n_nationkey").cast("string")).alias("icd_code"),
        uri(1000, "n_nationkey").alias("icd_uri"),
        F.concat("n_name", F.lit(" "), "r_name").alias("title"), F.lit("block").alias("class_kind"),
        F.array(uri(2000, "r_regionkey")).alias("parent_uris"),
        F.array(link(F.col("r_name"), uri(2000, "r_regionkey"))).alias("exclusion"))
    leaves = customer.select(
        F.concat(F.lit("KC"), F.col("c_custkey").cast("string")).alias("icd_code"),
        uri(100000, "c_custkey").alias("icd_uri"), F.col("c_name").alias("title"),
        F.lit("category").alias("class_kind"),
        F.array(uri(1000, "c_nationkey"), F.lit(BASE + "999")).alias("parent_uris"),
        F.array(link(F.concat(F.lit("see "), "c_mktsegment"), uri(1000, "c_nationkey")),
                link(F.lit("elsewhere"), F.lit(BASE + "998"))).alias("exclusion"))
    return conform_records(nations.unionByName(leaves))


def conform_records(df: DataFrame) -> DataFrame:
    """Fill the fields of the record schema that ``df`` lacks with null."""
    return df.select(*[
        F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in ICD_RECORD.fields])


@query("""
WITH links AS (
  SELECT 'KC' || c_custkey AS icd_code, c_name AS title, '1A' || c_nationkey || ',999' AS parents,
         'see ' || c_mktsegment || '|elsewhere' AS labels, '1A' || c_nationkey || '|-' AS codes, 'injury' AS chapter
  FROM customer
  UNION ALL
  SELECT '1A' || n_nationkey, n_name || ' ' || r_name, CAST(2000 + r_regionkey AS VARCHAR), r_name, '-', 'certain_infectious'
  FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT * FROM links
""")
def catalogue_links(spark, sf):
    built = crosswalk.build_catalogue(code_records(spark, sf))
    dash = F.transform("exclusion_codes", lambda x: F.coalesce(x, F.lit("-")))
    return built.select(
        "icd_code", "title", F.array_join("parent_codes", ",").alias("parents"),
        F.array_join("exclusion_labels", "|").alias("labels"), F.array_join(dash, "|").alias("codes"), "chapter")


@query("""
WITH pairs AS (SELECT DISTINCT l_suppkey, 'P' || l_partkey AS code FROM lineitem),
joined AS (SELECT l_suppkey, string_agg(code, '&' ORDER BY code) AS codes FROM pairs GROUP BY 1)
SELECT 'http://id/mms/' || s_suppkey AS icd_uri, 'no ' || s_name AS labels, coalesce(codes, '-') AS codes
FROM supplier LEFT JOIN joined ON l_suppkey = s_suppkey % 90 + 1
""")
def exclusions_of_many_codes(spark, sf):
    """Exclusions that name an entity with several codes get them joined by &."""
    uri = F.concat(F.lit("http://id/mms/"), F.col("l_suppkey").cast("string"))
    pairs = crosswalk.entity_codes(table(spark, sf, "lineitem").select(
        uri.alias("icd_uri"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("icd_code")))
    other = F.concat(F.lit("http://id/mms/"), (F.col("s_suppkey") % 90 + 1).cast("string"))
    raw = table(spark, sf, "supplier").select(
        F.concat(F.lit("http://id/mms/"), F.col("s_suppkey").cast("string")).alias("icd_uri"),
        F.array(F.struct(F.concat(F.lit("no "), "s_name").alias("label"), other.alias("linearization_uri"))).alias("exclusion"))
    dash = F.transform("exclusion_codes", lambda x: F.coalesce(x, F.lit("-")))
    return crosswalk.resolve_exclusions(raw, pairs).select(
        "icd_uri", F.array_join("exclusion_labels", "|").alias("labels"), F.array_join(dash, "|").alias("codes"))


@query("""
SELECT l_orderkey AS id, string_agg(CASE WHEN s_acctbal > 0 THEN s_name ELSE 'S' || l_suppkey END, ','
                                    ORDER BY pos) AS mapped
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) AS pos
      FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem))
LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1
""")
def map_list(spark, sf):
    """Lists of supplier codes through a lookup that lacks some of them."""
    lists = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.transform(F.array_sort(F.collect_set("l_suppkey")),
                    lambda s: F.concat(F.lit("S"), s.cast("string"))).alias("codes"))
    names = table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"), "s_name")
    return lookups.map_list(lists, "id", "codes", names, "code", "s_name", "mapped") \
                  .withColumn("mapped", F.array_join("mapped", ","))


@query("""
SELECT p_brand AS code, CASE lower(substring(p_brand, 1, 1)) WHEN 'b' THEN 'digestive' END AS chapter,
       p_type AS code2, CASE lower(substring(p_type, 1, 1)) WHEN 'e' THEN 'genitourinary' WHEN 's' THEN 'supplementary_populations'
         WHEN 'm' THEN 'factors_health' WHEN 'p' THEN 'supplementary_factors' WHEN 'l' THEN 'external' END AS chapter2
FROM part
""")
def code_chapter(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("code"), icd_chapter(F.col("p_brand")).alias("chapter"),
        F.col("p_type").alias("code2"), icd_chapter(F.col("p_type")).alias("chapter2"))


# ── hierarchy ────────────────────────────────────────────────────────────────

def tree_edges(spark, sf) -> DataFrame:
    """Region -> nation -> customer -> order."""
    def edge(df, parent, parent_key, child, child_key):
        return df.select(F.concat(F.lit(parent), F.col(parent_key).cast("string")).alias("parent"),
                         F.concat(F.lit(child), F.col(child_key).cast("string")).alias("child"))
    return (
        edge(table(spark, sf, "nation"), "r", "n_regionkey", "n", "n_nationkey")
        .unionByName(edge(table(spark, sf, "customer"), "n", "c_nationkey", "c", "c_custkey"))
        .unionByName(edge(table(spark, sf, "orders"), "c", "o_custkey", "o", "o_orderkey"))
    )


REACH_SQL = """
WITH r AS (SELECT r_regionkey AS k FROM region WHERE r_name = 'EUROPE'),
n AS (SELECT n_nationkey AS k FROM nation WHERE n_regionkey IN (SELECT k FROM r)),
c AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (SELECT k FROM n)),
o AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT k FROM c)),
found AS (SELECT 'r' || k AS node, 0 AS depth FROM r UNION ALL SELECT 'n' || k, 1 FROM n
          UNION ALL SELECT 'c' || k, 2 FROM c UNION ALL SELECT 'o' || k, 3 FROM o)
"""


def europe(spark, sf) -> DataFrame:
    return table(spark, sf, "region").filter("r_name = 'EUROPE'").select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"))


@query(REACH_SQL + "SELECT node, CAST(depth AS BIGINT) AS depth FROM found")
def reachable(spark, sf):
    found = crosswalk.reachable(tree_edges(spark, sf), europe(spark, sf))
    return found.withColumn("depth", F.col("depth").cast("bigint"))


@query(REACH_SQL + "SELECT node, CAST(depth AS BIGINT) AS depth FROM found WHERE node LIKE 'c%'")
def reachable_of_kind(spark, sf):
    kinds = tree_edges(spark, sf).select(
        F.col("child").alias("node"),
        F.when(F.col("child").startswith("c"), "category").otherwise("block").alias("class_kind"))
    found = crosswalk.reachable_of_kind(tree_edges(spark, sf), europe(spark, sf), kinds)
    return found.select("node", F.col("depth").cast("bigint").alias("depth"))


# ── raw entities ─────────────────────────────────────────────────────────────

def raw_entities(spark, sf) -> DataFrame:
    """Customers as JSON entities, labels as text, object or list, links as text or object."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")

    def obj(lang: str, value) -> F.Column:
        return F.concat(F.lit('{"@language":"' + lang + '","@value":"'), value, F.lit('"}'))

    label = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit('"'), name, F.lit('"')))
        .when(F.col("c_mktsegment") == "MACHINERY", obj("en", name))
        .otherwise(F.concat(F.lit("["), obj("fr", F.concat(F.lit("le "), name)), F.lit(","), obj("en", name), F.lit("]"))))
    text = F.concat(
        F.lit('{"@id":"http://id.example/release/11/mms/'), key, F.lit('","code":"'),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("K"), key)).otherwise(""),
        F.lit('","classKind":"category","title":'), label,
        F.lit(',"synonym":[{"label":'), label, F.lit('},{"label":""}],"exclusion":[{"label":'), label,
        F.lit(',"linearizationReference":"http://id.example/mms/'), F.col("c_nationkey").cast("string"),
        F.lit('"}],"indexTerm":[{"label":"'), F.col("n_name"), F.lit('"}],"parent":["http://id.example/n/'),
        F.col("c_nationkey").cast("string"), F.lit('"],"child":[{"@id":"http://id.example/c/'), key,
        F.lit('"}],"source":"http://id.example/entity/'), key, F.lit('"}'))
    return c.select(F.from_json(text, entities.ENTITY).alias("e")).select("e.*")


@query("""
SELECT CASE WHEN c_acctbal > 0 THEN 'K' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS icd_code,
       'https://id.example/release/11/mms/' || c_custkey AS icd_uri, c_name AS title, 'ICD-11' AS source,
       c_name AS synonyms, c_name || '>http://id.example/mms/' || c_nationkey AS exclusion, n_name AS index_terms,
       'https://id.example/n/' || c_nationkey AS parents, 'https://id.example/c/' || c_custkey AS children,
       'https://id.example/entity/' || c_custkey AS foundation_uri
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def flatten_icd_entity(spark, sf):
    link = F.transform("exclusion", lambda x: F.concat(x["label"], F.lit(">"), x["linearization_uri"]))
    return entities.flatten_icd_entity(raw_entities(spark, sf)).select(
        "icd_code", "icd_uri", "title", "source", F.array_join("synonyms", "|").alias("synonyms"),
        F.array_join(link, "|").alias("exclusion"), F.array_join("index_terms", "|").alias("index_terms"),
        F.array_join("parent_uris", "|").alias("parents"), F.array_join("child_uris", "|").alias("children"),
        "foundation_uri")


@query("""
SELECT CASE WHEN p_size > 10 THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS icd_code,
       'https://id.example/release/10/' || p_partkey AS icd_uri, p_name AS title, p_type AS synonyms,
       p_name AS matching_terms, 'ICD-10' AS source, p_retailprice AS score
FROM part
""")
def flatten_icd_hit(spark, sf):
    part = table(spark, sf, "part")
    hits = part.select(
        F.concat(F.lit("http://id.example/release/10/"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise("").alias("theCode"),
        F.to_json(F.struct(F.lit("en").alias("@language"), F.col("p_name").alias("@value"))).alias("title"),
        F.lit(None).cast("string").alias("definition"),
        F.array(F.to_json(F.struct(F.col("p_type").alias("label")))).alias("synonyms"),
        F.array(F.struct(F.col("p_name").alias("label"))).alias("matchingPVs"),
        F.lit(None).cast("string").alias("foundationUri"), F.col("p_retailprice").alias("score"))
    return entities.flatten_icd_hit(hits).select(
        "icd_code", "icd_uri", "title", F.array_join("synonyms", "|").alias("synonyms"),
        F.array_join("matching_terms", "|").alias("matching_terms"), "source", "score")


# ── lookups and tall metadata ────────────────────────────────────────────────

def burden_export(spark, sf) -> DataFrame:
    """Line items as a disease-burden export with id/name column pairs."""
    return (
        dealt(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lit(2).cast("bigint").alias("measure_id"), F.lit("DALYs").alias("measure_name"),
            F.col("n_nationkey").cast("bigint").alias("location_id"), F.col("n_name").alias("location_name"),
            F.lit(3).cast("bigint").alias("sex_id"), F.lit("Both").alias("sex_name"),
            F.col("p_size").cast("bigint").alias("age_id"), F.concat(F.lit("age "), F.col("p_size").cast("string")).alias("age_name"),
            F.col("l_partkey").alias("cause_id"), F.col("p_name").alias("cause_name"),
            F.lit(1).cast("bigint").alias("metric_id"), F.col("l_returnflag").alias("metric_name"),
            F.lit(1).cast("bigint").alias("population_group_id"), F.lit("All").alias("population_group_name"),
            F.year("o_orderdate").cast("bigint").alias("year"), F.col("l_quantity").alias("val"),
            (F.col("l_quantity") + 1).alias("upper"), (F.col("l_quantity") - 1).alias("lower"))
    )


def country_table(spark, sf) -> DataFrame:
    """Known country names: nations of all regions but one."""
    return table(spark, sf, "nation").filter("n_regionkey <> 0").select(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso3"))


EXPORT_SQL = """
x AS (SELECT l.*, year(o_orderdate) AS yr, n_nationkey, n_name, p_name, p_size, n_regionkey FROM lineitem l
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)
"""
DIMENSIONS_SQL = EXPORT_SQL + """,
dims AS (
  SELECT 'measure' AS dimension, 2 AS id, 'DALYs' AS name FROM x
  UNION SELECT 'location', n_nationkey, CASE WHEN n_regionkey <> 0 THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') ELSE n_name END FROM x
  UNION SELECT 'sex', 3, 'Both' FROM x UNION SELECT 'age', p_size, 'age ' || p_size FROM x
  UNION SELECT 'cause', l_partkey, p_name FROM x UNION SELECT 'metric', 1, (SELECT min(l_returnflag) FROM x) FROM x
  UNION SELECT 'population_group', 1, 'All' FROM x)
"""


@query("WITH " + DIMENSIONS_SQL + "SELECT dimension, CAST(id AS BIGINT) AS id, name FROM dims")
def extract_dimensions(spark, sf):
    return lookups.extract_dimensions(burden_export(spark, sf), country_table(spark, sf))


@query("WITH " + DIMENSIONS_SQL + """
SELECT dimension, CAST(id AS BIGINT) AS id, name FROM dims WHERE dimension <> 'cause'
UNION ALL SELECT 'cause', p_partkey, 'stored ' || p_name FROM part
""")
def merge_metadata(spark, sf):
    """Stored names win over the export's; new ids are added."""
    stored = table(spark, sf, "part").select(
        F.lit("cause").alias("dimension"), F.col("p_partkey").alias("id"), F.concat(F.lit("stored "), "p_name").alias("name"))
    new = lookups.extract_dimensions(burden_export(spark, sf), country_table(spark, sf))
    return dedup.keep_first(stored, new, ["dimension", "id"])


@query("""
SELECT n_nationkey AS id, n_name AS name, r_name AS parent_name FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 100 + r_regionkey, r_name, '' FROM region
UNION ALL SELECT c_custkey + 1000, c_name, CASE WHEN c_acctbal > 0 THEN n_name ELSE 'X' || c_nationkey END
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def geo_with_parent(spark, sf):
    def place(df, code, name, kind, parent) -> DataFrame:
        return df.select(code.cast("string").alias("Code"), F.col(name).alias("Title"), F.lit(kind).alias("Dimension"),
                         parent.cast("string").alias("ParentCode"))
    nation, region, customer = (table(spark, sf, t) for t in ("nation", "region", "customer"))
    missing = F.concat(F.lit("X"), F.col("c_nationkey").cast("string"))
    places = (
        place(nation, F.col("n_nationkey"), "n_name", "COUNTRY", F.col("n_regionkey") + 100)
        .unionByName(place(region, F.col("r_regionkey") + 100, "r_name", "AREA", F.lit(None)))
        .unionByName(place(customer, F.col("c_custkey") + 1000, "c_name", "COUNTRY",
                           F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string")).otherwise(missing))))
    return burden.geo_catalogue(places).select(
        F.col("code").cast("bigint").alias("id"), "name", F.col("region_name").alias("parent_name"))


@query(f"""
SELECT 'SA_' || p_partkey AS id, p_name AS name, 'indicator' AS dimension FROM part
UNION ALL SELECT 'N' || n_nationkey, n_name, 'country' FROM nation
UNION ALL SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}', 'gho_ihme_cause')" for k, v in INDICATOR_CAUSE.items())})
UNION ALL SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}', 'gho_ihme_sex')" for k, v in SEX_ID.items())})
""")
def gho_metadata(spark, sf):
    """Catalogue documents with a record list and a code map, and the fixed maps."""
    part, nation = table(spark, sf, "part"), table(spark, sf, "nation")
    docs = part.select(
        F.array(F.struct(F.concat(F.lit("SA_"), F.col("p_partkey").cast("string")).alias("code"),
                         F.col("p_name").alias("name"))).alias("indicator_catalogue"),
        F.lit(None).cast("map<string, struct<code: string, name: string, type: string, region_code: string, region_name: string>>").alias("geo_catalogue"))
    code = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    geo = nation.select(
        F.lit(None).cast("array<struct<code: string, name: string>>").alias("indicator_catalogue"),
        F.create_map(code, F.struct(code.alias("code"), F.col("n_name").alias("name"), F.lit("COUNTRY").alias("type"),
                                    F.lit("").alias("region_code"), F.lit("").alias("region_name"))).alias("geo_catalogue"))
    return burden.build_gho_metadata(spark, docs.unionByName(geo)).select("id", "name", "dimension")


@query("""
SELECT n_name AS id, CAST(n_nationkey AS VARCHAR) AS name, 'gho_ihme_country' AS dimension FROM nation WHERE n_regionkey <> 1
UNION ALL SELECT n_name, 'kept', 'gho_ihme_country' FROM nation WHERE n_regionkey = 1
""")
def append_swapped(spark, sf):
    """Places already present are not added again."""
    nation = table(spark, sf, "nation")
    stored = nation.filter("n_regionkey = 1").select(
        F.col("n_name").alias("id"), F.lit("kept").alias("name"), F.lit("gho_ihme_country").alias("dimension"))
    other = nation.select(F.lit("location").alias("dimension"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return lookups.append_swapped(stored, other)
