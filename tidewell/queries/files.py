"""Landing, readers, masters and streams, on files that Spark writes from the test tables.

Files go under the session's shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import upsert
from tidewell.plans.articles import normalise_articles
from tidewell.queries import query, table
from tidewell.queries.upserts import MERGED_SQL, customer_batch, customer_master
from tidewell.schemas import ARTICLES, DBL, INT, LONG, S, many, record
from tidewell.session import scratch_path
from tidewell.sources import files, relational
from tidewell.sources.master import Master
from tidewell.streaming import ingest
from tidewell.streaming.dedup import append_once, drop_repeats, late_rows

LINE = record(part=LONG, supp=LONG, quantity=DBL, flag=S)


def envelopes(spark, sf) -> DataFrame:
    """One landed document per order; an order has few lines, so documents are small."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"))).alias("records"))
    return table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fetched_at"),
        F.concat(F.lit("api-"), "o_orderstatus").alias("source_api"),
        F.struct("records").alias("data"), F.col("o_orderdate").alias("_day"))


@query("""
SELECT 'api-' || o_orderstatus AS source_api, strftime(o_orderdate, '%Y-%m-%d') AS fetched_at, l_partkey AS part,
       l_suppkey AS supp, l_quantity AS quantity, l_returnflag AS flag
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def land_and_read_envelope(spark, sf):
    """Documents landed by month, read back with an explicit schema and exploded."""
    folder = scratch_path(spark, "land")
    # By month: a folder per day would make thousands of tiny files here.
    files.land(envelopes(spark, sf).withColumn("_day", F.trunc("_day", "MM")), folder, "orders", F.col("_day"), "run1")
    return files.read_envelope(spark, f"{folder}/orders_run1", "records", LINE, multi_line=False)


@query("SELECT event_id, event_type, user_id FROM events WHERE event_type NOT IN ('error', 'view')")
def ndjson_tolerant(spark, sf):
    """Error events are broken lines, views are lines without any known field."""
    path = scratch_path(spark, "ndjson")
    kind = F.col("event_type")
    whole = F.to_json(F.struct("event_id", "event_type", "user_id"))
    line = F.when(kind == "error", F.concat(F.lit('{"event_id": '), "event_type")) \
            .when(kind == "view", F.concat(F.lit('{"_queue": ['), F.col("event_id").cast("string"), F.lit("]}"))).otherwise(whole)
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    return files.read_ndjson_tolerant(spark, path, record(event_id=LONG, event_type=S, user_id=LONG))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS "Trial number", CASE WHEN lang <> 'de' THEN source END AS "Sponsor type",
       length(text) AS text_length, md5(text) AS text_hash
FROM documents
""")
def ctis_csv(spark, sf):
    """Texts with line breaks and quotes through a quoted CSV with padded headers."""
    path = scratch_path(spark, "ctis")
    source = F.when(F.col("lang") == "de", "N/A").otherwise(F.col("source"))
    table(spark, sf, "documents").select(
        F.col("doc_id").alias("Trial number "), source.alias(" Sponsor type"), F.col("text").alias("Product")) \
        .write.option("header", True).option("quoteAll", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    read = files.read_ctis_csv(spark, path)
    return read.select("Trial number", "Sponsor type", F.char_length("Product").cast("bigint").alias("text_length"),
                       F.md5("Product").alias("text_hash"))


@query("""
SELECT 'P' || l_partkey AS "icd10Code", '0' || l_suppkey AS "icd11Code", lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS "icd11Chapter"
FROM lineitem
""")
def icd_map_tsv(spark, sf):
    """Codes and chapters that look like numbers stay text."""
    path = scratch_path(spark, "map")
    table(spark, sf, "lineitem").select(
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("icd11Chapter"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("icd10Code"), F.lit("x").alias("unused"),
        F.concat(F.lit("0"), F.col("l_suppkey").cast("string")).alias("icd11Code")) \
        .write.option("sep", "\t").option("header", True).csv(path)
    return files.read_icd_map(spark, path)


@query("SELECT l_partkey AS cause_id, l_returnflag AS cause_name, year(l_shipdate) AS year, l_extendedprice AS val FROM lineitem")
def gbd_csv(spark, sf):
    path = scratch_path(spark, "gbd")
    table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("cause_id"), F.col("l_returnflag").alias("cause_name"),
        F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("val")).write.option("header", True).csv(path)
    return files.read_gbd_csv(spark, path)


@query("SELECT l_partkey AS cause_id, l_suppkey AS location_id, CASE WHEN l_returnflag = 'R' THEN year(l_shipdate) END AS year, l_extendedprice AS val FROM lineitem")
def gbd_csv_mixed_headers(spark, sf):
    """Three exports in one folder: columns in two orders, and one without a year."""
    path = scratch_path(spark, "gbd-mixed")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("cause_id"), F.col("l_suppkey").alias("location_id"), F.year("l_shipdate").alias("year"),
        F.col("l_extendedprice").alias("val"), "l_returnflag")
    orders = {"R": ["year", "val", "cause_id", "location_id"], "A": ["cause_id", "location_id", "val"], "N": ["location_id", "cause_id", "val"]}
    for flag, columns in orders.items():
        lines.where(F.col("l_returnflag") == flag).select(*columns).write.mode("append").option("header", True).csv(path)
    return files.read_gbd_csv(spark, path).select("cause_id", "location_id", "year", "val")


@query("""
SELECT 'P' || l_partkey AS "icd10Code", '0' || l_suppkey AS "icd11Code", lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS "icd11Chapter"
FROM lineitem
""")
def icd_map_mixed_headers(spark, sf):
    path = scratch_path(spark, "map-mixed")
    lines = table(spark, sf, "lineitem").select(
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("icd11Chapter"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("icd10Code"),
        F.concat(F.lit("0"), F.col("l_suppkey").cast("string")).alias("icd11Code"), "l_returnflag")
    for flag, columns in (("R", ["icd10Code", "icd11Code", "icd11Chapter"]), ("A", ["icd11Code", "icd11Chapter", "icd10Code"]),
                          ("N", ["icd11Chapter", "icd10Code", "icd11Code"])):
        lines.where(F.col("l_returnflag") == flag).select(*columns).write.mode("append") \
            .option("sep", "\t").option("header", True).csv(path)
    return files.read_icd_map(spark, path)


@query("""
SELECT o_orderkey AS id, CASE WHEN o_totalprice <= 400000 THEN o_totalprice END AS price,
       '[' || o_orderkey || ',' || o_custkey || ']' AS keys, '{"p":"' || o_orderpriority || '"}' AS detail
FROM orders
""")
def flatten_for_rdbms(spark, sf):
    """Lists and structs as JSON text, NaN as null."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_totalprice") > 400000, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
        F.array("o_orderkey", "o_custkey").alias("keys"), F.struct(F.col("o_orderpriority").alias("p")).alias("detail"))
    return relational.flatten_for_rdbms(rows)


# ── masters and streams ──────────────────────────────────────────────────────

CUSTOMER = record(custkey=LONG, price=DBL, priority=S, dated=S, orderkey=LONG, sources=many(S),
                  first_seen_at=S, last_seen_at=S, version=INT)
MASTER_SQL = MERGED_SQL + """
SELECT custkey, price, priority, dated, sources, first_seen_at, last_seen_at, version FROM m
"""


def dated_text(df: DataFrame) -> DataFrame:
    """Dates as text that sorts like the order key within a day, so that no two rows tie."""
    stamp = F.concat(F.date_format("dated", "yyyy-MM-dd"), F.lit("/"), F.lpad(F.col("orderkey").cast("string"), 12, "0"))
    return df.withColumn("dated", stamp)


def day_only(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "dated": F.substring("dated", 1, 10), "sources": F.array_join(F.array_sort("sources"), ","),
        "version": F.col("version").cast("bigint")}).drop("orderkey")


def customers(spark, path: str) -> Master:
    return Master(spark, path, CUSTOMER, "custkey", "dated", "sources", buckets=4)


@query(MASTER_SQL.replace("i.o_orderdate > e.o_orderdate", "(i.o_orderdate, i.o_orderkey) > (e.o_orderdate, e.o_orderkey)"))
def master_upsert(spark, sf):
    """A stored master takes one batch: only rows of its keys are written."""
    orders = table(spark, sf, "orders")
    master = customers(spark, scratch_path(spark, "master"))
    master.overwrite(dated_text(customer_master(orders)))
    master.upsert(dated_text(customer_batch(orders)))
    return day_only(master.read())


@query(MASTER_SQL.replace("i.o_orderdate > e.o_orderdate", "(i.o_orderdate, i.o_orderkey) > (e.o_orderdate, e.o_orderkey)"))
def master_reopened(spark, sf):
    """A master opened without a number of buckets goes on with the stored one; another number is refused."""
    orders, path = table(spark, sf, "orders"), scratch_path(spark, "reopened")
    customers(spark, path).overwrite(dated_text(customer_master(orders)))
    try:
        Master(spark, path, CUSTOMER, "custkey", "dated", "sources", buckets=8)
        raise AssertionError("another number of buckets was taken")
    except ValueError:
        pass
    master = Master(spark, path, CUSTOMER, "custkey", "dated", "sources")
    master.upsert(dated_text(customer_batch(orders)))
    master.compact()
    return day_only(master.read())


CUSTOMER_ROUTE = ingest.Route("part-*.json", "customers", lists={"records": record(custkey=LONG, price=DBL, priority=S, dated=S)})


def customer_rows(documents: DataFrame) -> DataFrame:
    """Landed documents -> dated records of customers."""
    return files.explode_envelope(documents, "records").select(
        "custkey", "price", "priority", "dated", F.lit(0).cast("bigint").alias("orderkey"),
        F.array("source_api").alias("sources"), F.col("fetched_at").alias("first_seen_at"),
        F.col("fetched_at").alias("last_seen_at"), F.lit(1).alias("version"))


@query("""
WITH s AS (
  SELECT o_custkey AS custkey, o_orderdate, o_orderkey, o_totalprice, o_orderpriority, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
src AS (SELECT o_custkey AS custkey, string_agg(DISTINCT 'feed-' || o_orderstatus, ',' ORDER BY 'feed-' || o_orderstatus) AS sources
        FROM orders GROUP BY 1)
SELECT custkey, o_totalprice AS price, o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS dated, sources
FROM s JOIN src USING (custkey) WHERE rn = 1
""")
def stream_upsert(spark, sf):
    """Landed NDJSON documents streamed into a master, one file per micro-batch.

    However the batches fall, content is that of the newest order and the
    sources are those of all orders; versions depend on the batches.
    """
    landed, path = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    rec = F.struct(
        F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("dated"))
    table(spark, sf, "orders").select(
        F.lit("2001-09-01").alias("fetched_at"), F.concat(F.lit("feed-"), "o_orderstatus").alias("source_api"),
        F.struct(F.array(rec).alias("records")).alias("data")).repartition(3).write.json(landed)
    master = customers(spark, path)
    ingest.ingest_stream(spark, landed, CUSTOMER_ROUTE, customer_rows, master, scratch_path(spark, "stream-state"),
                         max_files=1, multi_line=False).awaitTermination()
    return day_only(master.read()).select("custkey", "price", "priority", "dated", "sources")


@query(MERGED_SQL.replace("i.o_orderdate > e.o_orderdate", "(i.o_orderdate, i.o_orderkey) > (e.o_orderdate, e.o_orderkey)") + """
SELECT custkey, price, version, CAST(0 AS BIGINT) AS changed_by_replay FROM m
""")
def replay(spark, sf):
    """The same batch again: no new rows, no updates, versions stay."""
    orders = table(spark, sf, "orders")
    master = customers(spark, scratch_path(spark, "replay"))
    master.overwrite(dated_text(customer_master(orders)))
    batch = dated_text(customer_batch(orders))
    master.upsert(batch)
    counts = master.upsert(batch)
    return day_only(master.read()).select(
        "custkey", "price", "version", F.lit(counts[upsert.NEW] + counts[upsert.UPDATED]).cast("bigint").alias("changed_by_replay"))


@query(MERGED_SQL.replace("i.o_orderdate > e.o_orderdate", "(i.o_orderdate, i.o_orderkey) > (e.o_orderdate, e.o_orderkey)") + """
SELECT custkey, price, version, CAST(0 AS BIGINT) AS changed_by_replay FROM m
""")
def backfill_files(spark, sf):
    """A day's landed files processed twice through their route: the second time nothing changes."""
    orders = table(spark, sf, "orders")
    folder, master = scratch_path(spark, "days"), customers(spark, scratch_path(spark, "backfill"))
    master.overwrite(dated_text(customer_master(orders)))
    rec = F.struct("custkey", "price", "priority", "dated")
    dated_text(customer_batch(orders)).select(
        F.lit("2001-09-01T00:00:00").alias("fetched_at"), F.get("sources", F.lit(0)).alias("source_api"),
        F.struct(F.array(rec).alias("records")).alias("data")).write.json(f"{folder}/2001-09-01")
    for _ in range(2):
        counts = ingest.backfill(spark, folder, "2001-09-01", CUSTOMER_ROUTE, customer_rows, master, multi_line=False)
    return day_only(master.read()).select(
        "custkey", "price", "version", F.lit(counts[upsert.NEW] + counts[upsert.UPDATED]).cast("bigint").alias("changed_by_replay"))


def name_files(spark, folder: str, stem: str) -> None:
    """Give the part files of a folder the names that a landing job gives."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for n, entry in enumerate(fs.listStatus(path)):
        if entry.getPath().getName().startswith("part-"):
            fs.rename(entry.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, f"{stem}_{n}.json"))


@query("""
SELECT 'https://docs.example/' || doc_id AS url, 't_' || lang AS topic, CASE WHEN lang = 'en' THEN 'en' ELSE lang END AS language,
       CASE WHEN lang = 'en' THEN 'newsapi.org/v2' ELSE 'api.currentsapi.services/v1' END AS source_apis,
       CASE WHEN lang <> 'de' THEN source END AS author, CAST(1 AS BIGINT) AS version
FROM documents
""")
def two_routes_one_master(spark, sf):
    """Both news services' files, found by the shipped routes, streamed into one master by one writer."""
    landed = scratch_path(spark, "news")
    headlines = F.col("lang") == "en"
    article = F.struct(
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string"), F.lit("?ref=x")).alias("url"),
        F.concat(F.lit("t_"), "lang").alias("topic"), F.array("source").alias("category"),
        F.when(F.col("lang") == "de", "#author.fullName}").otherwise(F.col("source")).alias("author"),
        F.col("text").alias("title"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("image_url"),
        F.lit("2026-03-01T00:00:00Z").alias("published_at"), F.col("lang").alias("language"))
    docs = table(spark, sf, "documents").select(
        F.lit("2026-03-26").alias("fetched_at"), F.when(headlines, "newsapi.org/v2").otherwise("api.currentsapi.services/v1").alias("source_api"),
        F.struct(F.array(article).alias("articles")).alias("data"), headlines.alias("headlines"))
    for stem, side in (("news", docs.where("headlines")), ("currentapi", docs.where("NOT headlines"))):
        folder = f"{landed}/2026-03-26/{stem}"
        side.drop("headlines").write.json(folder)
        name_files(spark, folder, stem)
    rows = None
    for route in ("news", "currents"):
        found = ingest.open_files(spark, landed, ingest.ROUTES[route], multi_line=False)
        part = normalise_articles(files.explode_envelope(found, "articles"), "2026-03-28T06:00:00+00:00")
        rows = part if rows is None else rows.unionByName(part)
    master = Master(spark, scratch_path(spark, "articles"), ARTICLES, "url", "published_at", "source_apis", buckets=4)
    ingest.merge_stream(rows, master, scratch_path(spark, "articles-state")).awaitTermination()
    return master.read().select("url", "topic", "language", F.array_join("source_apis", ",").alias("source_apis"), "author",
                                F.col("version").cast("bigint").alias("version"))


CHUNK = "CAST(floor(datediff(ts, DATE'2024-01-01') / 10) AS INT)"
_EVENT = "event_id bigint, user_id bigint, ts timestamp, value double"


@query("""
WITH e AS (SELECT *, datediff('day', DATE '2024-01-01', ts::DATE) // 10 AS chunk FROM events),
ends AS (SELECT chunk, max(ts) AS last FROM e GROUP BY chunk)
SELECT user_id, count(*) AS n_events, CAST(count(DISTINCT event_id) AS BIGINT) AS n_distinct,
  (SELECT count(*) FROM e JOIN ends USING (chunk) WHERE event_id % 10 = 0 AND ts < last - INTERVAL 3 DAY AND chunk < (SELECT max(chunk) FROM e) - 1) AS late
FROM events GROUP BY user_id
""")
def stream_dedup_watermark(spark, sf):
    """Events that come twice, some again in the next file and some two files later, too late; each is kept once."""
    landed, out = scratch_path(spark, "landed-events"), scratch_path(spark, "events")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value", F.expr(CHUNK).alias("chunk"))
    ends = {r[0]: r[1] for r in events.groupBy("chunk").agg(F.max("ts")).collect()}  # one per ten days
    # One pass over its days' rows gives a file; file after file lands, each a batch of the stream.
    chunk, last = F.col("chunk"), F.create_map(*[F.lit(x) for pair in sorted(ends.items()) for x in pair])[F.col("chunk")]
    again = F.when(F.col("ts") > last - F.expr("INTERVAL 6 HOURS"), chunk + 1)
    stale = F.when((F.col("ts") < last - F.expr("INTERVAL 3 DAYS")) & (F.col("event_id") % 10 == 0), chunk + 2)
    state, late = scratch_path(spark, "events-state"), 0
    for file in sorted(ends):
        days = events.where(f"ts >= timestamp(date_add(DATE'2024-01-01', {10 * (file - 2)})) AND ts < timestamp(date_add(DATE'2024-01-01', {10 * (file + 1)}))")
        days.withColumn("file", F.explode(F.array(chunk, chunk, again, stale))).where(F.col("file") == file) \
            .drop("chunk", "file").write.mode("append").parquet(landed)
        rows = spark.readStream.schema(_EVENT).parquet(landed)
        run = append_once(drop_repeats(rows, ["event_id"], "ts", "1 day"), out, state)
        run.awaitTermination()
        late += late_rows(run)
    return spark.read.schema(_EVENT).parquet(out).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("event_id").alias("n_distinct")).withColumn("late", F.lit(late).cast("bigint"))
