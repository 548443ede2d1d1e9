"""Trial normalisers on orders, suppliers and parts shaped as trial records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import clinical
from tidewell.plans import trials
from tidewell.queries import query, table
from tidewell.session import cut_lineage

SITE = "struct<facility: string, city: string, country: string, recruitment_status: string>"


def _s(name: str) -> F.Column:
    return F.col(name).cast("string")


@query("""
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_size * 30 WHEN p_type = 'SMALL' THEN NULL ELSE p_size * 365 END AS days,
       CASE WHEN p_type = 'SMALL' AND p_size > 25 THEN NULL
            WHEN p_type = 'SMALL' THEN '<' || (p_size + 10) || ' years'
            WHEN p_size > 25 THEN p_size || '+ ' || CASE WHEN p_type = 'PROMO' THEN 'months' ELSE 'years' END
            ELSE p_size || '-' || (p_size + 10) || ' ' || CASE WHEN p_type = 'PROMO' THEN 'months' ELSE 'years' END END AS label
FROM part
""")
def age_days_label(spark, sf):
    unit = F.when(F.col("p_type") == "PROMO", " Month").otherwise(" Years")
    low = F.when(F.col("p_type") != "SMALL", F.concat(_s("p_size"), unit))
    high = F.when(F.col("p_size") <= 25, F.concat((F.col("p_size") + 10).cast("string"), F.lit(" Year")))
    return table(spark, sf, "part").select(
        "p_partkey", clinical.age_days(low).alias("days"), clinical.age_label(low, high).alias("label"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Ended, ended' WHEN 'O' THEN 'Ongoing, recruiting' ELSE 'unheard' END AS status,
       CASE o_orderstatus WHEN 'P' THEN 'Ended, ended' WHEN 'F' THEN 'Ended, ended' ELSE 'Ongoing, recruiting' END AS defaulted
FROM orders
""")
def status_map(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "Recruiting").otherwise("unheard")
    return table(spark, sf, "orders").select(
        "o_orderkey", clinical.map_status(raw).alias("status"), clinical.map_status(raw, F.lit("Ended, ended")).alias("defaulted"))


@query("""
SELECT s_suppkey, n_name || '/Authorised/recruitment pending|' || r_name || '/Ongoing/recruitment ended|' || 'Spain/ended/ended' AS places
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def parse_list_struct(spark, sf):
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    text = F.concat("n_name", F.lit(":Authorised, recruitment pending, "), "r_name", F.lit(":Ongoing, recruitment ended, Spain:Ended"))
    places = F.transform(clinical.parse_locations(text), lambda p: F.concat_ws("/", p["country"], p["approval"], p["status"]))
    return rows.select("s_suppkey", F.array_join(places, "|").alias("places"))


@query("""
WITH t AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r,
                  string_agg(l_linestatus, ',' ORDER BY l_linestatus) FILTER (WHERE l_returnflag = 'R') AS rt FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN r > n - r THEN '' ELSE concat_ws(',', rt, nullif(repeat('OTHER,', CAST(n - r - r AS INTEGER))[:-2], '')) END AS types
FROM t
""")
def pad_list(spark, sf):
    """Types of returned lines padded to the number of other lines."""
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")))).alias("types"),
        F.collect_list(F.when(F.col("l_returnflag") != "R", F.lit("x"))).alias("names"))
    return lists.select("l_orderkey", F.array_join(clinical.padded_types(F.col("types"), F.col("names")), ",").alias("types"))


# ── EU export ────────────────────────────────────────────────────────────────

def ctis_export(spark, sf) -> DataFrame:
    """Suppliers and customers as rows of the EU export."""
    customer = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    segment = F.col("c_mktsegment")
    none = F.lit(None).cast("string")
    return customer.select(
        F.col("c_name").alias("Trial number"), F.concat(F.lit("Trial of "), "c_name").alias("Title of the trial"),
        F.lit("Ended").alias("Overall trial status"),
        F.when(segment == "BUILDING", "Phase II and Phase III").when(segment == "MACHINERY", "Human Pharmacology (Phase I)")
        .otherwise("no phase").alias("Trial phase"),
        F.when(F.col("c_acctbal") > 5000, "Yes").when(F.col("c_acctbal") > 0, "No").alias("Trial results"),
        F.when(segment != "FURNITURE", F.col("n_name")).alias("Product"), F.lit("Female, Male").alias("Gender"),
        F.concat("n_name", F.lit("."), "c_mktsegment").alias("Medical conditions"),
        F.concat("n_name", F.lit(":Ongoing, recruiting, France:Ended")).alias("Location(s) and recruitment status"),
        F.lit("lives longer").alias("Primary endpoint"), none.alias("Secondary endpoints"),
        F.concat(F.lit("Diseases [C"), F.lpad((F.col("c_nationkey") + 10).cast("string"), 2, "0"), F.lit("] and [2A"),
                 F.lpad((F.col("c_nationkey") + 10).cast("string"), 2, "0"), F.lit("]")).alias("Therapeutic area"),
        F.when(segment == "BUILDING", '"0-17 years","18-64 years"').when(segment == "MACHINERY", "18-64 years, 65+ years")
        .otherwise("N/A,65+ years").alias("Age group"),
        F.when(segment == "BUILDING", "0-27 days,12-17 years").when(segment == "MACHINERY", "65-84 years,85+ years")
        .otherwise(none).alias("Age range secondary identifier"),
        F.col("c_custkey").cast("string").alias("Number of participants enrolled"), none.alias("Protocol code"),
        F.lit("s").alias("Sponsor/Co-Sponsors"), F.lit("industry").alias("Sponsor type"),
        F.lit("05/03/2024").alias("Last updated"), F.lit("01/02/2023").alias("Start date"),
        F.when(F.col("c_acctbal") > 0, "31/12/2023").alias("End date"), F.lit("soon").alias("Decision date"),
        none.alias("Global end of the trial"))


@query("""
SELECT c_name AS trial_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN '2,3' WHEN 'MACHINERY' THEN '1' ELSE '' END AS phases,
       CASE WHEN c_acctbal > 5000 THEN 'true' WHEN c_acctbal > 0 THEN 'false' ELSE '-' END AS results,
       'Female,Male' AS gender, n_name || ';' || c_mktsegment AS conditions,
       n_name || '/Ongoing/recruiting|France/ended/ended' AS places,
       '2024-03-05' AS last_updated, CASE WHEN c_acctbal > 0 THEN '2023-12-31' END AS end_date, c_custkey AS enrollment,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN n_name ELSE '' END AS products, 'primary:1|secondary:0' AS outcomes
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def ctis_core(spark, sf):
    place = F.transform("countries_status", lambda p: F.concat_ws("/", p["country"], p["approval"], p["status"]))
    outcome = F.transform("outcomes", lambda o: F.concat(o["type"], F.lit(":"), F.size(o["text"]).cast("string")))
    return trials.ctis_core(ctis_export(spark, sf)).select(
        "trial_id", F.array_join(F.transform("phases", lambda p: p.cast("string")), ",").alias("phases"),
        F.coalesce(F.col("results").cast("string"), F.lit("-")).alias("results"),
        F.array_join("gender", ",").alias("gender"), F.array_join("conditions", ";").alias("conditions"),
        F.array_join(place, "|").alias("places"), _s("last_updated").alias("last_updated"), _s("end_date").alias("end_date"),
        F.col("enrollment").cast("bigint").alias("enrollment"), F.array_join("methods.products", ",").alias("products"),
        F.array_join(outcome, "|").alias("outcomes"))


@query("""
SELECT c_name AS trial_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN '0-27 days,12-17 years,18-64 years'
            WHEN 'MACHINERY' THEN '18-64 years,65+ years,65-84 years,85+ years' ELSE '65+ years' END AS groupings,
       CASE c_mktsegment WHEN 'BUILDING' THEN '0:28,4380:6570,6570:23725'
            WHEN 'MACHINERY' THEN '6570:23725,23725:,23725:31025,31025:' ELSE '23725:' END AS ranges
FROM customer
""")
def ctis_age_ranges(spark, sf):
    """Buckets refined by secondary ones; open bounds print as blanks."""
    def side(x) -> F.Column:
        return F.coalesce(x.cast("string"), F.lit(""))
    aged = trials.ctis_age_ranges(ctis_export(spark, sf))
    ranges = F.transform("range_in_days", lambda r: F.concat(side(r["min"]), F.lit(":"), side(r["max"])))
    return aged.select(F.col("Trial number").alias("trial_id"), F.array_join("groupings", ",").alias("groupings"),
                       F.array_join(ranges, ",").alias("ranges"))


def code_tables(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(to_11, to_10, catalogue) over codes made from the nations."""
    nation = table(spark, sf, "nation").withColumn("nn", F.lpad((F.col("n_nationkey") + 10).cast("string"), 2, "0"))
    def code(head: str) -> F.Column:
        return F.concat(F.lit(head), "nn")
    known = nation.filter("n_regionkey <> 0")
    to_11 = known.select(code("C").alias("icd10Code"), code("5B").alias("icd11Code"))
    to_10 = known.select(code("2A").alias("icd11Code"), code("D").alias("icd10Code"))
    catalogue = nation.select(code("2A").alias("icd_code"), F.col("n_name").alias("chapter")).unionByName(
        nation.select(code("5B").alias("icd_code"), F.lit("endocrine").alias("chapter")))
    return to_11, to_10, catalogue


CODES_SQL = """
WITH c AS (SELECT c_name AS trial_id, lpad(CAST(c_nationkey + 10 AS VARCHAR), 2, '0') AS nn, n_name, n_regionkey <> 0 AS known
           FROM customer JOIN nation ON n_nationkey = c_nationkey)
"""


@query(CODES_SQL + """
SELECT trial_id, 'C' || nn || CASE WHEN known THEN ',D' || nn ELSE '' END AS icd_10,
       '2A' || nn || ':' || n_name || CASE WHEN known THEN ',5B' || nn || ':endocrine' ELSE '' END AS icd_11
FROM c
""")
def ctis_codes(spark, sf):
    to_11, to_10, catalogue = code_tables(spark, sf)
    rows = ctis_export(spark, sf).withColumnRenamed("Trial number", "trial_id")
    coded = trials.ctis_codes(rows, "trial_id", "Therapeutic area", to_11, to_10, catalogue)
    return coded.select("trial_id", F.array_join("codes.icd_10", ",").alias("icd_10"), _pairs().alias("icd_11"))


def _pairs() -> F.Column:
    pairs = F.transform("codes.icd_11", lambda x: F.concat(x["code"], F.lit(":"), F.coalesce(x["chapter"], F.lit("-"))))
    return F.array_join(pairs, ",")


@query(CODES_SQL.replace("n_name, n_regionkey", "n_name, c_nationkey, c_mktsegment, c_custkey, n_regionkey") + """
SELECT trial_id, 'C' || nn || CASE WHEN known THEN ',D' || nn ELSE '' END AS icd_10,
       '2A' || nn || ':' || n_name || CASE WHEN known THEN ',5B' || nn || ':endocrine' ELSE '' END AS icd_11,
       CASE c_mktsegment WHEN 'BUILDING' THEN '2,3' WHEN 'MACHINERY' THEN '1' ELSE '' END AS phases,
       CASE c_mktsegment WHEN 'BUILDING' THEN '0:28,4380:6570,6570:23725'
            WHEN 'MACHINERY' THEN '6570:23725,23725:,23725:31025,31025:' ELSE '23725:' END AS ranges,
       CASE WHEN known THEN 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE n_name END || '/Ongoing/recruiting|France/ended/ended' AS places,
       '2024-03-05' AS last_updated, c_custkey AS enrollment
FROM c
""")
def harmonise_ctis(spark, sf):
    """The whole EU job: dates, ages, codes and countries in the common schema."""
    def side(x) -> F.Column:
        return F.coalesce(x.cast("string"), F.lit(""))
    to_11, to_10, catalogue = code_tables(spark, sf)
    countries = table(spark, sf, "nation").filter("n_regionkey <> 0").select(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), F.lpad(_s("n_nationkey"), 2, "0")).alias("iso3"))
    done = trials.harmonise_ctis(cut_lineage(ctis_export(spark, sf)), to_11, to_10, catalogue, countries)
    place = F.transform("countries_status", lambda p: F.concat_ws("/", p["country"], p["approval"], p["status"]))
    ranges = F.transform("range_in_days", lambda r: F.concat(side(r["min"]), F.lit(":"), side(r["max"])))
    return done.select(
        "trial_id", F.array_join("codes.icd_10", ",").alias("icd_10"), _pairs().alias("icd_11"),
        F.array_join(F.transform("phases", lambda p: p.cast("string")), ",").alias("phases"), F.array_join(ranges, ",").alias("ranges"),
        F.array_join(place, "|").alias("places"), F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"), "enrollment")


# ── US records ───────────────────────────────────────────────────────────────

def studies(spark, sf) -> DataFrame:
    """Orders with their lines as nested registry studies. An order has few lines."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")) \
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    flag = F.col("l_returnflag")
    site = F.struct(
        F.lit(None).cast("string").alias("facility"), F.lit(None).cast("string").alias("city"), F.col("n_name").alias("country"),
        F.when(flag == "R", "RECRUITING").when(flag == "A", "completed").otherwise("WITHHELD").alias("status"))
    per = lines.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(site)).alias("locations"),
        F.array_sort(F.collect_list(F.struct(F.concat(F.lit("C"), F.lpad((F.col("n_nationkey") + 10).cast("string"), 2, "0"),
                                                      F.lit(".1")).alias("id")))).alias("meshes"),
        F.array_sort(F.collect_list(F.struct(F.col("s_name").alias("name"), F.lit("DRUG").alias("type")))).alias("interventions"))
    orders = table(spark, sf, "orders").join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status, day = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")
    def dated(value) -> F.Column:
        return F.struct(value.alias("date"))
    return orders.select(
        F.struct(
            F.struct(F.concat(F.lit("NCT"), _s("o_orderkey")).alias("nctId"), F.struct(_s("o_custkey").alias("id")).alias("orgStudyIdInfo"),
                     F.concat(F.lit(" Study "), _s("o_orderkey")).alias("officialTitle")).alias("identificationModule"),
            F.struct(F.when(status == "F", "completed").when(status == "O", "RECRUITING").otherwise("WITHHELD").alias("overallStatus"),
                     F.when(status == "F", True).alias("hasResults"), dated(F.date_format("o_orderdate", "yyyy-MM")).alias("startDateStruct"),
                     dated(F.when(status == "F", day)).alias("primaryCompletionDateStruct"), dated(F.lit("NA")).alias("completionDateStruct"),
                     dated(day).alias("studyFirstPostDateStruct"), dated(day).alias("lastUpdatePostDateStruct")).alias("statusModule"),
            F.struct(F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("EARLY_PHASE1"), F.lit("PHASE2")))
                     .when(F.col("o_orderpriority") == "2-HIGH", F.array(F.lit("NA"))).alias("phases"),
                     F.struct(F.col("o_custkey").alias("count")).alias("enrollmentInfo")).alias("designModule"),
            F.struct(F.array(F.col("o_orderpriority")).alias("conditions"), F.lit(None).cast("array<string>").alias("keywords")).alias("conditionsModule"),
            F.struct("interventions").alias("armsInterventionsModule"),
            F.struct(F.when(status != "P", "18 Years").alias("minimumAge"), F.when(status == "F", "65 Years").alias("maximumAge"),
                     F.when(status == "F", "ALL").when(status == "O", "FEMALE").alias("sex")).alias("eligibilityModule"),
            F.struct("locations").alias("contactsLocationsModule"),
            F.struct(F.struct(F.lit("Acme").alias("name"), F.lit("OTHER_GOV").alias("class")).alias("leadSponsor")).alias("sponsorCollaboratorsModule"),
            F.struct(F.array(F.struct(F.lit("alive").alias("measure"))).alias("primaryOutcomes"),
                     F.lit(None).cast("array<struct<measure: string>>").alias("secondaryOutcomes")).alias("outcomesModule"),
        ).alias("protocolSection"),
        F.struct(F.struct("meshes").alias("conditionBrowseModule")).alias("derivedSection"))


LINES_SQL = """
p AS (SELECT l_orderkey AS k,
             string_agg(DISTINCT n_name || '/' || CASE l_returnflag WHEN 'R' THEN 'Ongoing/recruiting' ELSE 'Ended/ended' END, '|'
                        ORDER BY n_name || '/' || CASE l_returnflag WHEN 'R' THEN 'Ongoing/recruiting' ELSE 'Ended/ended' END) AS places,
             string_agg(DISTINCT 'C' || (n_nationkey + 10) || '.1', ',' ORDER BY 'C' || (n_nationkey + 10) || '.1') AS mesh,
             string_agg(s_name, ',' ORDER BY s_name) AS names, count(*) AS n,
             string_agg(DISTINCT 'C' || (n_nationkey + 10), ',' ORDER BY 'C' || (n_nationkey + 10)) AS icd_10,
             string_agg(DISTINCT '5B' || (n_nationkey + 10) || ':endocrine', ',' ORDER BY '5B' || (n_nationkey + 10) || ':endocrine')
               FILTER (WHERE n_regionkey <> 0) AS icd_11
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)
"""


@query("WITH " + LINES_SQL + """
SELECT 'NCT' || o_orderkey AS nct_id, 'Study ' || o_orderkey AS title, o_orderstatus = 'F' AS results,
       coalesce(mesh, '') AS mesh_ids, coalesce(names, '') AS intervention_names, CAST(coalesce(n, 0) AS BIGINT) AS n_locations,
       strftime(o_orderdate, '%Y-%m') AS start_date, 'g' AS query_group, 'alive' AS primary_outcomes
FROM orders LEFT JOIN p ON k = o_orderkey
""")
def flatten_study(spark, sf):
    return trials.flatten_study(studies(spark, sf), "g").select(
        "nct_id", "title", "results", F.array_join("mesh_ids", ",").alias("mesh_ids"),
        F.array_join("intervention_names", ",").alias("intervention_names"), F.size("locations").cast("bigint").alias("n_locations"),
        "start_date", "query_group", F.array_join("primary_outcomes", ",").alias("primary_outcomes"))


def us_trials(spark, sf) -> DataFrame:
    to_11, _, catalogue = code_tables(spark, sf)
    countries = table(spark, sf, "nation").filter("n_regionkey <> 0").select(
        F.col("n_name").alias("name"), F.concat(F.lit("N"), F.lpad(_s("n_nationkey"), 2, "0")).alias("iso3"))
    landed = cut_lineage(trials.flatten_study(studies(spark, sf), "g"))
    return trials.harmonise_ctus(landed, to_11, catalogue, countries)


@query("WITH " + LINES_SQL + """,
q AS (SELECT l_orderkey AS k2, string_agg(DISTINCT
        CASE WHEN n_regionkey <> 0 THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') ELSE n_name END || '/' ||
        CASE l_returnflag WHEN 'R' THEN 'Ongoing/recruiting' ELSE 'Ended/ended' END, '|') AS iso,
        count(DISTINCT (n_nationkey, l_returnflag = 'R')) AS n_places
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)
SELECT 'NCT' || o_orderkey AS trial_id, CASE o_orderstatus WHEN 'F' THEN 'Ended, ended' WHEN 'O' THEN 'Ongoing, recruiting' ELSE 'WITHHELD' END AS overall_status,
       CASE o_orderpriority WHEN '1-URGENT' THEN '1,2' ELSE '' END AS phases,
       CASE o_orderstatus WHEN 'F' THEN '18-65 years' WHEN 'O' THEN '18+ years' ELSE '' END AS groupings,
       CASE o_orderstatus WHEN 'F' THEN '6570:23725' WHEN 'O' THEN '6570:' ELSE '' END AS ranges,
       CASE o_orderstatus WHEN 'F' THEN 'Female,Male' WHEN 'O' THEN 'Female' END AS gender,
       CAST(coalesce(n_places, 0) AS BIGINT) AS n_places, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS start_date,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS end_date,
       'Other_Gov' AS sponsor_type, CAST(coalesce(n, 0) AS BIGINT) AS n_types, coalesce(icd_10, '') AS icd_10, coalesce(icd_11, '') AS icd_11,
       o_custkey AS enrollment
FROM orders LEFT JOIN p ON k = o_orderkey LEFT JOIN q ON k2 = o_orderkey
""")
def ctus_trials(spark, sf):
    def side(x) -> F.Column:
        return F.coalesce(x.cast("string"), F.lit(""))
    ranges = F.transform("range_in_days", lambda r: F.concat(side(r["min"]), F.lit(":"), side(r["max"])))
    arm = F.get("methods.interventions", F.lit(0))
    return us_trials(spark, sf).select(
        "trial_id", "overall_status", F.array_join(F.transform("phases", lambda p: p.cast("string")), ",").alias("phases"),
        F.array_join("groupings", ",").alias("groupings"), F.array_join(ranges, ",").alias("ranges"),
        F.array_join("gender", ",").alias("gender"), F.size("countries_status").cast("bigint").alias("n_places"),
        F.date_format("start_date", "yyyy-MM-dd").alias("start_date"), F.date_format("end_date", "yyyy-MM-dd").alias("end_date"),
        "sponsor_type", F.size(arm["type"]).cast("bigint").alias("n_types"),
        F.array_join("codes.icd_10", ",").alias("icd_10"), _pairs().alias("icd_11"), "enrollment")


@query("WITH " + LINES_SQL + """
SELECT o_orderkey AS k, coalesce(string_agg(DISTINCT place, '|' ORDER BY place), '') AS places FROM orders LEFT JOIN (
  SELECT l_orderkey, CASE WHEN n_regionkey <> 0 THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') ELSE n_name END || '/' ||
         CASE l_returnflag WHEN 'R' THEN 'Ongoing/recruiting' ELSE 'Ended/ended' END AS place
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) ON l_orderkey = o_orderkey GROUP BY 1
""")
def trial_countries(spark, sf):
    """Sites of each trial as distinct ISO-3 / approval / status; empty for trials without sites."""
    place = F.transform("countries_status", lambda p: F.concat_ws("/", p["country"], p["approval"], p["status"]))
    return us_trials(spark, sf).select(
        F.expr("substring(trial_id, 4)").cast("bigint").alias("k"),
        F.coalesce(F.array_join(F.array_sort(place), "|"), F.lit("")).alias("places"))
