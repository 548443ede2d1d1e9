"""Upserts, deduplication and top-k on orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import dedup, upsert
from tidewell.queries import query, table

SEEN_OLD, SEEN_NEW = "2001-01-01T00:00:00", "2001-09-01T00:00:00"


def customer_records(orders: DataFrame, source, seen: str) -> DataFrame:
    """Orders as dated records of their customer."""
    return orders.select(
        F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("dated"),
        F.col("o_orderkey").alias("orderkey"), F.array(source).alias("sources"),
        F.lit(seen).alias("first_seen_at"), F.lit(seen).alias("last_seen_at"),
        F.lit(1).alias("version"))


def customer_master(orders: DataFrame) -> DataFrame:
    """Stored side: the latest finished order of each customer."""
    done = customer_records(orders.filter("o_orderstatus = 'F'"), F.lit("archive"), SEEN_OLD)
    return dedup.latest_per_key(done, ["custkey"], "dated", ["orderkey"])


def customer_batch(orders: DataFrame) -> DataFrame:
    """Arriving side: every other order, many per customer."""
    source = F.concat(F.lit("feed-"), F.col("o_orderstatus"))
    return customer_records(orders.filter("o_orderstatus <> 'F'"), source, SEEN_NEW)


def merged(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders")
    batch = upsert.collapse_incoming(customer_batch(orders), "custkey", "dated", "sources", ["orderkey"])
    return upsert.merge_with_status(customer_master(orders), batch, "custkey", "dated", "sources")


def flat(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "dated": F.date_format("dated", "yyyy-MM-dd"),
        "sources": F.array_join(F.array_sort("sources"), ","),
        "version": F.col("version").cast("bigint")})


MERGED_SQL = """
WITH ranked AS (
  SELECT *, o_orderstatus = 'F' AS done,
         row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'F'
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders),
e AS (SELECT * FROM ranked WHERE done AND rn = 1),
i AS (SELECT * FROM ranked WHERE NOT done AND rn = 1),
s AS (SELECT o_custkey, string_agg(DISTINCT 'feed-' || o_orderstatus, ',' ORDER BY 'feed-' || o_orderstatus) AS src
      FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey),
j AS (
  SELECT coalesce(e.o_custkey, i.o_custkey) AS custkey,
         CASE WHEN e.o_custkey IS NULL THEN 'new' WHEN i.o_custkey IS NULL THEN 'untouched'
              WHEN i.o_orderdate > e.o_orderdate THEN 'updated' ELSE 'source_only' END AS st,
         e.o_totalprice AS ep, i.o_totalprice AS ip, e.o_orderpriority AS eq, i.o_orderpriority AS iq,
         e.o_orderdate AS ed, i.o_orderdate AS id, e.o_orderkey AS ek, i.o_orderkey AS ik, s.src
  FROM e FULL JOIN i ON e.o_custkey = i.o_custkey LEFT JOIN s ON s.o_custkey = i.o_custkey),
m AS (
  SELECT custkey, st,
         CASE WHEN st IN ('new', 'updated') THEN ip ELSE ep END AS price,
         CASE WHEN st IN ('new', 'updated') THEN iq ELSE eq END AS priority,
         strftime(CASE WHEN st IN ('new', 'updated') THEN id ELSE ed END, '%Y-%m-%d') AS dated,
         CASE WHEN st IN ('new', 'updated') THEN ik ELSE ek END AS orderkey,
         CASE st WHEN 'new' THEN src WHEN 'untouched' THEN 'archive' ELSE 'archive,' || src END AS sources,
         CASE WHEN st = 'new' THEN '2001-09-01T00:00:00' ELSE '2001-01-01T00:00:00' END AS first_seen_at,
         CASE WHEN st = 'untouched' THEN '2001-01-01T00:00:00' ELSE '2001-09-01T00:00:00' END AS last_seen_at,
         CAST(CASE WHEN st = 'updated' THEN 2 ELSE 1 END AS BIGINT) AS version
  FROM j)
"""


@query(MERGED_SQL + """
SELECT custkey, price, priority, dated, orderkey, sources, first_seen_at, last_seen_at, version FROM m
""")
def upsert_by_date(spark, sf):
    orders = table(spark, sf, "orders")
    result = upsert.upsert_by_date(customer_master(orders), customer_batch(orders), "custkey",
                                   "dated", "sources", ["orderkey"])
    return flat(result)


@query(MERGED_SQL + "SELECT custkey, sources, st AS status FROM m")
def upsert_sources(spark, sf):
    df = merged(spark, sf)
    return flat(df).select("custkey", "sources", F.col(upsert.STATUS).alias("status"))


@query(MERGED_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE st = 'new') AS BIGINT) AS "new",
       CAST(count(*) FILTER (WHERE st = 'updated') AS BIGINT) AS updated,
       CAST(count(*) FILTER (WHERE st = 'source_only') AS BIGINT) AS source_only
FROM m
""")
def upsert_stats(spark, sf):
    return upsert.upsert_stats(merged(spark, sf))


@query("""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def dedup_incoming(spark, sf):
    events = table(spark, sf, "events")
    return dedup.latest_per_key(events, ["user_id", "event_type"], "ts", ["event_id"]) \
                .select("event_id", "user_id", "event_type", "value")


@query("""
WITH keyed AS (SELECT o_orderkey, o_orderpriority,
                      CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS appl_id FROM orders)
SELECT o_orderkey, o_orderpriority, appl_id FROM (
  SELECT *, row_number() OVER (PARTITION BY appl_id ORDER BY o_orderpriority, o_orderkey) AS rn FROM keyed)
WHERE rn = 1 OR appl_id IS NULL
""")
def dedup_first_source(spark, sf):
    keyed = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("appl_id"))
    return dedup.dedup_first(keyed, "appl_id", [F.col("o_orderpriority"), F.col("o_orderkey")])


@query("""
WITH RECURSIVE r AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') || '/' || o_orderpriority AS url,
         row_number() OVER (ORDER BY o_orderkey) AS n
  FROM orders),
s(k, n, ids, urls, kept) USING KEY (k) AS (
  SELECT 1, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST([] AS BIGINT[])
  UNION
  SELECT 1, r.n,
         CASE WHEN list_contains(ids, id) OR list_contains(urls, url) THEN ids ELSE list_append(ids, id) END,
         CASE WHEN list_contains(ids, id) OR list_contains(urls, url) THEN urls ELSE list_append(urls, url) END,
         CASE WHEN list_contains(ids, id) OR list_contains(urls, url) THEN kept ELSE list_append(kept, o_orderkey) END
  FROM s JOIN r ON r.n = s.n + 1)
SELECT o_orderkey, id, url FROM r WHERE o_orderkey IN (SELECT unnest(kept) FROM s)
""")
def dedup_id_or_url(spark, sf):
    """First-come rule over two keys; the SQL reads the rows one by one."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("id"),
        F.concat_ws("/", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority").alias("url"))
    return dedup.dedup_id_or_url(rows, "id", "url", ["o_orderkey"])


@query("""
SELECT CAST(user_id AS VARCHAR) AS url, arg_min(event_id, event_id) AS event_id,
       arg_min(value, event_id) AS value,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS category
FROM events GROUP BY user_id
""")
def merge_categories(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("url"), "event_id", "value",
        F.col("event_type").alias("category"))
    return dedup.merge_categories(rows, "url", "category", [F.col("event_id")]) \
                .withColumn("category", F.array_join("category", ","))


@query("""
SELECT o_orderkey, o_orderpriority, CAST(rn AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn
  FROM orders) WHERE rn <= 5
""")
def topk_per_group(spark, sf):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return dedup.top_k_per_group(table(spark, sf, "orders"), ["o_orderpriority"], order, 5) \
                .select("o_orderkey", "o_orderpriority", F.col("rank").cast("bigint").alias("rank"))


@query("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10
""")
def topk_by_value(spark, sf):
    order = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")]
    return dedup.top_k(table(spark, sf, "orders"), order, 10).select("o_orderkey", "o_totalprice")


@query("""
WITH s AS (SELECT avg(c_acctbal) AS m FROM customer),
old AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS k, c_acctbal AS bal, c_mktsegment AS seg
        FROM customer WHERE c_mktsegment = 'BUILDING'),
new AS (SELECT c_name, CASE WHEN c_acctbal > m THEN c_acctbal END AS bal, 'SEG-' || c_mktsegment AS seg
        FROM customer, s)
SELECT n.c_name AS name, CAST(old.k AS BIGINT) AS stored_key, n.seg AS segment, coalesce(n.bal, old.bal) AS balance
FROM new n LEFT JOIN old ON old.c_name = n.c_name
""")
def dim_upsert_coalesce(spark, sf):
    customer = table(spark, sf, "customer")
    old, new = _dim_sides(customer)
    merged_dim = upsert.upsert_dim(old, new, ["name"], ["segment"], ["balance"])
    return merged_dim.select("name", F.col("dim_key").alias("stored_key"), "segment", "balance")


def _dim_sides(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored dimension (one segment, numbered) and new rows (all, half without balance)."""
    named = customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                            F.col("c_acctbal").alias("balance"))
    empty = named.limit(0).select(F.lit(0).cast("bigint").alias("dim_key"), "name")
    old = upsert.assign_keys(named.filter("segment = 'BUILDING'"), empty, ["name"], "dim_key")
    mean = named.agg(F.avg("balance")).scalar()
    new = named.select("name", F.concat(F.lit("SEG-"), "segment").alias("segment"),
                       F.when(F.col("balance") > mean, F.col("balance")).alias("balance"))
    return old, new


@query("""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(1 AS BIGINT) AS first_key, CAST(count(*) AS BIGINT) AS last_key,
       CAST(count(*) AS BIGINT) AS n_keys,
       CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS BIGINT) AS n_kept
FROM customer
""")
def surrogate_keys(spark, sf):
    """Keys are dense and unique, and stored rows keep theirs."""
    old, new = _dim_sides(table(spark, sf, "customer"))
    keyed = upsert.assign_keys(new, old, ["name"], "dim_key")
    kept = keyed.join(old.select("name", F.col("dim_key").alias("old_key")), "name", "left")
    return kept.agg(
        F.count(F.lit(1)).alias("n"), F.min("dim_key").alias("first_key"),
        F.max("dim_key").alias("last_key"), F.countDistinct("dim_key").alias("n_keys"),
        F.count_if(F.col("dim_key") == F.col("old_key")).alias("n_kept"))


@query("""
WITH f AS (SELECT l_suppkey AS k, sum(l_quantity) AS q FROM lineitem
           GROUP BY 1 HAVING sum(l_quantity) > (SELECT sum(l_quantity) / count(DISTINCT l_suppkey) FROM lineitem))
SELECT s_suppkey AS disease_key, round(coalesce(q, s_acctbal), 2) AS kept, round(q, 2) AS reset
FROM supplier LEFT JOIN f ON k = s_suppkey
""")
def enrich_keep_old(spark, sf):
    supplier, lineitem = table(spark, sf, "supplier"), table(spark, sf, "lineitem")
    fact = supplier.select(F.col("s_suppkey").alias("disease_key"), F.col("s_acctbal").alias("score"))
    mean = lineitem.agg(F.sum("l_quantity") / F.countDistinct("l_suppkey")).scalar()
    sums = lineitem.groupBy(F.col("l_suppkey").alias("disease_key")).agg(F.sum("l_quantity").alias("score"))
    values = sums.filter(F.col("score") > mean)
    kept = upsert.enrich_fact(fact, values, "disease_key", "score")
    reset = upsert.enrich_fact(fact, values, "disease_key", "score", reset=True)
    return kept.join(reset.withColumnRenamed("score", "reset"), "disease_key").select(
        "disease_key", F.round("score", 2).alias("kept"), F.round("reset", 2).alias("reset"))


@query("""
WITH old AS (SELECT o_custkey AS d, year(o_orderdate) AS t, round(sum(o_totalprice), 2) AS v
             FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
new AS (SELECT o_custkey AS d, year(o_orderdate) AS t, round(sum(o_totalprice), 2) AS v
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2)
SELECT CAST(coalesce(old.d, new.d) AS BIGINT) AS cust, CAST(coalesce(old.t, new.t) AS BIGINT) AS year,
       coalesce(new.v, old.v) AS value,
       CASE WHEN new.d IS NOT NULL THEN '2002-01-01' ELSE '2000-01-01' END AS loaded_at
FROM old FULL JOIN new ON old.d = new.d AND old.t = new.t
""")
def fact_upsert(spark, sf):
    def sums(side: str) -> DataFrame:
        return table(spark, sf, "orders").filter(side).groupBy(
            F.col("o_custkey").alias("cust"), F.year("o_orderdate").cast("bigint").alias("year")
        ).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    old = sums("o_orderstatus = 'F'").withColumn("loaded_at", F.lit("2000-01-01"))
    return upsert.upsert_fact(old, sums("o_orderstatus <> 'F'"), ["cust", "year"], ["value"], F.lit("2002-01-01"))
