"""Star schema from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import upsert
from tidewell.plans import burden, warehouse
from tidewell.queries import query, table
from tidewell.queries.codes import burden_export
from tidewell.queries.normalising import NOW
from tidewell.schemas import DIM_DISEASE, DIM_REGION, DIM_TIME, FACT
from tidewell.session import cut_lineage


def _empty(spark, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def nation_code(key: str = "n_nationkey") -> F.Column:
    return F.concat(F.lit("N"), F.lpad(F.col(key).cast("string"), 2, "0"))


def gbd_metadata(spark, sf) -> DataFrame:
    """Causes are parts, locations are nations."""
    part = table(spark, sf, "part").select(
        F.lit("cause").alias("dimension"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return part.unionByName(table(spark, sf, "nation").select(
        F.lit("location").alias("dimension"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")))


def gho_metadata(spark, sf) -> DataFrame:
    """Country codes of all nations but those of one region; one code is too long."""
    code = F.when(F.col("n_nationkey") == 7, "N007").otherwise(nation_code())
    return table(spark, sf, "nation").filter("n_regionkey <> 3").select(
        code.alias("id"), F.col("n_nationkey").cast("string").alias("name"), F.lit("gho_ihme_country").alias("dimension"))


def dim_region(spark, sf) -> DataFrame:
    """Stored like a real dimension: later steps read it, they do not rebuild it."""
    return cut_lineage(warehouse.build_dim_region(
        _empty(spark, DIM_REGION), gbd_metadata(spark, sf), gho_metadata(spark, sf)))


def flat_codes(spark, sf) -> DataFrame:
    """Part words as ICD-11 codes, brands as ICD-10 codes, several codes in one text."""
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("icd10Code"), F.concat_ws("&", F.replace("p_name", F.lit(" "), F.lit(" & "))).alias("icd11Code"),
        F.array("p_type").alias("icd11_chapter"))


def code_titles(spark, sf) -> DataFrame:
    """Titles for the words that open a promoted part's name."""
    word = F.get(F.split("p_name", " "), F.lit(0))
    return table(spark, sf, "part").filter("p_type = 'PROMO' and p_size > 25").select(
        word.alias("icd_code"), F.concat(F.lit("Title "), word).alias("title")).distinct()


def dim_disease(spark, sf) -> DataFrame:
    return cut_lineage(warehouse.build_dim_disease(
        _empty(spark, DIM_DISEASE), flat_codes(spark, sf), code_titles(spark, sf)))


def dim_time(spark, sf) -> DataFrame:
    return cut_lineage(warehouse.build_dim_time(_empty(spark, DIM_TIME), years(spark, sf)))


def years(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))


@query("""
SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code, n_name AS country_name, false AS is_global,
       CAST(NULL AS VARCHAR) AS who_region, CAST(count(*) OVER () AS BIGINT) AS top_key
FROM nation WHERE n_regionkey <> 3 AND n_nationkey <> 7
""")
def build_dim_region(spark, sf):
    dim = dim_region(spark, sf)
    return dim.select("country_code", "country_name", "is_global", "who_region",
                      dim.agg(F.max("region_key")).scalar().alias("top_key"))


@query("""
WITH c AS (SELECT p_brand AS icd10_code, unnest(string_split(p_name, ' ')) AS icd11_code, p_type FROM part),
t AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS icd11_code FROM part WHERE p_type = 'PROMO' AND p_size > 25)
SELECT icd10_code, c.icd11_code AS icd11_code, min(p_type) AS disease_category,
       CASE WHEN max(t.icd11_code) IS NOT NULL THEN 'Title ' || c.icd11_code ELSE c.icd11_code END AS disease_name,
       false AS is_neglected
FROM c LEFT JOIN t ON t.icd11_code = c.icd11_code GROUP BY icd10_code, c.icd11_code
""")
def build_dim_disease(spark, sf):
    return dim_disease(spark, sf).select("icd10_code", "icd11_code", "disease_category", "disease_name", "is_neglected")


@query("""
WITH stored AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE o_orderstatus = 'F'
                EXCEPT SELECT max(year(o_orderdate)) FROM orders),
numbered AS (SELECT y, row_number() OVER (ORDER BY y) AS k FROM stored),
fresh AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) NOT IN (SELECT y FROM stored))
SELECT y || '-01' AS year_month, CAST(k AS BIGINT) AS time_key, y AS year, 1 AS month, 1 AS quarter FROM numbered
UNION ALL SELECT y || '-01', CAST((SELECT max(k) FROM numbered) + row_number() OVER (ORDER BY y) AS BIGINT), y, 1, 1 FROM fresh
""")
def dim_time_missing(spark, sf):
    """Years that the stored dimension lacks are added; stored keys stay."""
    orders = table(spark, sf, "orders")
    latest = orders.agg(F.max(F.year("o_orderdate"))).scalar()
    stored = orders.filter("o_orderstatus = 'F'").select(F.year("o_orderdate").alias("year")).filter(F.col("year") != latest)
    old = cut_lineage(warehouse.build_dim_time(_empty(spark, DIM_TIME), stored))
    return warehouse.build_dim_time(old, years(spark, sf))


def health(spark, sf) -> DataFrame:
    """Burden rows of both sources."""
    rows = burden.normalise_gbd(burden_export(spark, sf), NOW)
    return rows.withColumn("source_data", F.when(F.col("upper") > 26, "GHO").otherwise("IHME"))


def facts(spark, sf, diseases: DataFrame, regions: DataFrame, times: DataFrame) -> DataFrame:
    rows = warehouse.fact_candidates(health(spark, sf), gbd_metadata(spark, sf), gho_metadata(spark, sf),
                                     diseases, regions, times)
    return warehouse.build_fact(_empty(spark, FACT), rows, NOW)


@query("""
SELECT l_partkey AS cause_id, c_nationkey AS location_id, year(o_orderdate) AS year,
       CASE WHEN l_quantity + 1 > 26 THEN 'GHO' ELSE 'IHME' END AS source_data, round(avg(l_quantity), 4) AS avg_daly
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""")
def agg_burden(spark, sf):
    return warehouse.agg_burden(health(spark, sf)).select(
        F.col("cause_id").cast("bigint").alias("cause_id"), "location_id", "year", "source_data",
        F.round("avg_daly", 4).alias("avg_daly"))


FACT_SQL = """
WITH a AS (
  SELECT l_partkey AS cause, p_name, c_nationkey AS loc, year(o_orderdate) AS y,
         CASE WHEN l_quantity + 1 > 26 THEN 7 ELSE 9 END AS source_key, avg(l_quantity) AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON p_partkey = l_partkey
  GROUP BY ALL),
t AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS w FROM part WHERE p_type = 'PROMO' AND p_size > 25),
d AS (SELECT DISTINCT p_brand AS icd10_code, w AS icd11_code,
             CASE WHEN w IN (SELECT w FROM t) THEN 'Title ' || w ELSE w END AS disease_name
      FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS w FROM part)),
r AS (SELECT n_nationkey AS loc, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code
      FROM nation WHERE n_regionkey <> 3 AND n_nationkey <> 7),
names AS (SELECT DISTINCT p_name, disease_name FROM (SELECT DISTINCT p_name FROM part), (SELECT DISTINCT disease_name FROM d)
          WHERE contains(lower(p_name), lower(disease_name)) OR contains(lower(disease_name), lower(p_name))),
f AS (SELECT icd10_code, icd11_code, country_code, y AS year, source_key, arg_min(v, cause) AS v
      FROM a JOIN names USING (p_name) JOIN d USING (disease_name) JOIN r USING (loc) GROUP BY ALL)
"""


@query(FACT_SQL + """
SELECT icd10_code, icd11_code, country_code, year, source_key, round(v, 4) AS daly_value FROM f
""")
def burden_fact(spark, sf):
    diseases, regions, times = dim_disease(spark, sf), dim_region(spark, sf), dim_time(spark, sf)
    return facts(spark, sf, diseases, regions, times).join(diseases, "disease_key") \
        .join(regions, "region_key").join(times, "time_key").select(
            "icd10_code", "icd11_code", "country_code", "year", "source_key", F.round("daly_value", 4).alias("daly_value"))


def trial_master(spark, sf) -> DataFrame:
    """Orders as processed trials: line suppliers' nations as places, part words as codes."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")) \
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    word = F.get(F.split("p_name", " "), F.lit(0))
    per = lines.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(nation_code("s_nationkey").alias("country"), F.lit("Ongoing").alias("approval"),
                                F.col("l_returnflag").alias("status"))).alias("countries_status"),
        F.collect_list(F.struct(F.when(F.col("l_linestatus") == "O", word).alias("code"),
                                F.lit("c").alias("chapter"))).alias("icd_11"))
    return table(spark, sf, "orders").join(per, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("trial_id"),
        F.array(F.lit(1).cast("tinyint"), F.lit(2).cast("tinyint")).alias("phases"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("end_date"), "countries_status",
        F.struct(F.array().cast("array<string>").alias("icd_10"), "icd_11").alias("codes"))


def numbered_diseases(spark, sf) -> DataFrame:
    """One disease per word, keys in word order."""
    word = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("icd11_code")).distinct() \
        .filter(F.col("icd11_code") > "c")
    return upsert.assign_keys(word, word.select(F.lit(0).cast("bigint").alias("disease_key"), "icd11_code").limit(0),
                              ["icd11_code"], "disease_key")


@query("""
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part),
d AS (SELECT w, row_number() OVER (ORDER BY w) AS disease_key FROM w WHERE w > 'c'),
l AS (SELECT l_orderkey AS k, s_nationkey AS n, l_returnflag AS status,
             CASE WHEN l_linestatus = 'O' THEN string_split(p_name, ' ')[1] END AS code
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey),
places AS (SELECT DISTINCT k, n, status FROM l WHERE n IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 3 AND n_nationkey <> 7)),
codes AS (SELECT k, min(disease_key) AS disease_key FROM l LEFT JOIN d ON w = code GROUP BY k)
SELECT CAST(k AS VARCHAR) AS trial_id, 'N' || lpad(CAST(n AS VARCHAR), 2, '0') AS country_code,
       CAST(max(disease_key) AS BIGINT) AS disease_key, min(status) AS status, '1,2' AS stage, bool_and(o_orderstatus <> 'F') AS active
FROM places JOIN codes USING (k) JOIN orders ON o_orderkey = k GROUP BY k, n
""")
def bridge_top1(spark, sf):
    """One row per (trial, region) with the smallest disease key."""
    regions = dim_region(spark, sf)
    dim = warehouse.build_dim_trials(trial_master(spark, sf), regions, numbered_diseases(spark, sf), NOW)
    return dim.join(regions, "region_key").select("trial_id", "country_code", "disease_key", "status", "stage", "active")


@query(FACT_SQL + """
SELECT CAST((SELECT count(*) FROM r) AS BIGINT) AS regions, CAST((SELECT count(*) FROM d) AS BIGINT) AS diseases,
       CAST((SELECT count(*) FROM f WHERE v > 0) AS BIGINT) AS fact_with_daly,
       CAST((SELECT count(DISTINCT (l_orderkey, s_nationkey)) FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
             JOIN r ON loc = s_nationkey) AS BIGINT) AS trials
""")
def verify_counts(spark, sf):
    regions, diseases = dim_region(spark, sf), dim_disease(spark, sf)
    fact = facts(spark, sf, diseases, regions, dim_time(spark, sf))
    dim_trials = warehouse.build_dim_trials(trial_master(spark, sf), regions, diseases, NOW)
    return warehouse.verify(regions, diseases, fact, dim_trials)
