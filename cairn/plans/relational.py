"""Latest rows, counts, joins, set operations and other relational queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import latest, reports
from cairn.plans.registry import Registry
from cairn.sources.tables import table

R = Registry()
#: Evaluation times; nothing reads the clock.
EVENTS_AS_OF = "2024-02-01 00:00:00"
ORDERS_AS_OF = "2000-01-01 00:00:00"


def as_of(text: str):
    return F.lit(text).cast("timestamp")


def micros(column):
    return F.unix_micros(column.cast("timestamp"))


def seconds(column):
    return F.unix_timestamp(column.cast("timestamp"))


@R.query("""
SELECT user_id, event_type, event_id, epoch_us(ts) AS ts_us, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def latest_observation_per_key(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "user_id", "event_type", "ts", "event_id", "value")
    return latest.latest_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", micros(F.col("ts")).alias("ts_us"), "value")


@R.query("""
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""")
def latest_run_per_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return latest.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@R.query("""
WITH versions AS (
  SELECT o_orderpriority AS priority, date_trunc('year', o_orderdate) AS since, count(*) AS weight FROM orders
  WHERE extract(month FROM o_orderdate) = 1 GROUP BY 1, 2),
ranges AS (SELECT *, lead(since) OVER (PARTITION BY priority ORDER BY since) AS upto FROM versions)
SELECT o_orderkey, CAST(extract(year FROM since) AS BIGINT) AS policy_year, weight
FROM orders LEFT JOIN ranges ON o_orderpriority = priority AND since <= o_orderdate AND (upto IS NULL OR o_orderdate < upto)""")
def effective_policy_asof(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    versions = orders.where(F.month("o_orderdate") == 1).groupBy(
        "o_orderpriority", F.date_trunc("year", "o_orderdate").alias("since")).agg(F.count("*").alias("weight"))
    found = latest.join_effective(orders, versions, ["o_orderpriority"], "o_orderdate", "since")
    return found.select("o_orderkey", F.year("since").cast("long").alias("policy_year"), "weight")


@R.query("""
SELECT l.l_orderkey, l.l_linenumber, e.event_id, e.event_type FROM (
  SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_orderkey % 720 AS BIGINT) AS hour FROM lineitem) l
ASOF LEFT JOIN (
  SELECT user_id % 100 + 1 AS suppkey, CAST(floor((floor(epoch(ts)) - 1704067200) / 3600) AS BIGINT) AS hour, max(event_id) AS event_id,
    arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1, 2) e
ON l.l_suppkey = e.suppkey AND e.hour <= l.hour""")
def as_of_latest_event(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").withColumn("hour", F.col("l_orderkey") % 720)
    events = table(spark, d, "events", "user_id", "ts", "event_id", "event_type").select(
        (F.col("user_id") % 100 + 1).alias("l_suppkey"), F.floor((seconds(F.col("ts")) - 1704067200) / 3600).alias("hour"), "event_id", "event_type")
    hourly = latest.latest_per_key(events, ["l_suppkey", "hour"], ["event_id"], ["event_type"])
    found = latest.as_of_join(lines, hourly, ["l_suppkey"], "hour", "hour", ["event_id", "event_type"], width=72)
    return found.select("l_orderkey", "l_linenumber", "event_id", "event_type")


@R.query("""
SELECT event_id, user_id, event_type FROM (
  SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS k FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE k = 1 OR before IS DISTINCT FROM event_type""")
def changed_events_only(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "event_id", "user_id", "event_type", "ts")
    return latest.changed_only(rows, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@R.query("""
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'O') AS n_open,
  count(*) FILTER (WHERE l_discount > 0.05) AS n_discounted,
  epoch_us(min(l_shipdate) FILTER (WHERE l_linestatus = 'O')) AS first_open_us, max(l_quantity) FILTER (WHERE l_tax > 0.04) AS most_taxed
FROM lineitem GROUP BY 1""")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_discount", "l_shipdate", "l_quantity", "l_tax")
    is_open = F.col("l_linestatus") == "O"
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), reports.count_where(is_open, "n_open"), reports.count_where(F.col("l_discount") > 0.05, "n_discounted"),
        micros(F.min(F.when(is_open, F.col("l_shipdate")))).alias("first_open_us"),
        F.max(F.when(F.col("l_tax") > 0.04, F.col("l_quantity"))).alias("most_taxed"))


@R.query("""
SELECT c_mktsegment, count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'F') AS finished,
  count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'O') AS opened, count(DISTINCT o_custkey) AS customers
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def conditional_distinct(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders", "o_custkey", "o_orderstatus")
    # one row per customer first: the distinct counts then need no expansion of the orders
    by_customer = orders.groupBy("o_custkey").agg(
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("f"), F.max((F.col("o_orderstatus") == "O").cast("int")).alias("o"))
    customers = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    return by_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        F.sum("f").alias("finished"), F.sum("o").alias("opened"), F.count("*").alias("customers"))


@R.query("SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY 1 ORDER BY n DESC, user_id LIMIT 25")
def blocker_ranking(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "user_id", "event_type").where("event_type <> 'purchase'")
    return reports.ranked_counts(rows, ["user_id"], 25)


@R.query("""
WITH expected(source) AS (VALUES ('src0'), ('src1'), ('src2'), ('absent'))
SELECT e.source, count(d.doc_id) AS documents, coalesce(max(n_chars), 0) AS longest, count(d.doc_id) FILTER (WHERE lang = 'en') AS english
FROM expected e LEFT JOIN documents d ON d.source = e.source GROUP BY 1""")
def per_source_metrics(spark: SparkSession, d: str) -> DataFrame:
    expected = spark.createDataFrame([("src0",), ("src1",), ("src2",), ("absent",)], "source string")
    metrics = table(spark, d, "documents", "source", "n_chars", "lang").groupBy("source").agg(
        F.count("*").alias("documents"), F.max("n_chars").alias("longest"), reports.count_where(F.col("lang") == "en", "english"))
    return expected.join(metrics, "source", "left").na.fill(0)


@R.query("""
SELECT l_partkey, count(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'N') AS closed_votes FROM lineitem GROUP BY 1
HAVING count(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'N') >= 2 AND count(*) FILTER (WHERE l_returnflag = 'R') <= 0""")
def quorum_having(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_returnflag")
    return reports.quorum(rows, "l_partkey", "l_suppkey", F.col("l_returnflag") == "N", F.col("l_returnflag") == "R")


@R.query("""
WITH votes AS (SELECT l_partkey, n_name, count(*) AS votes FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER w AS k, lead(votes) OVER w AS second FROM votes
  WINDOW w AS (PARTITION BY l_partkey ORDER BY votes DESC, n_name))
SELECT l_partkey, n_name, votes FROM ranked WHERE k = 1 AND votes >= 2 AND votes > coalesce(second, 0)""")
def vote_consensus(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem", "l_partkey", "l_suppkey")
    homes = table(spark, d, "supplier", "s_suppkey", "s_nationkey").join(
        table(spark, d, "nation", "n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return reports.strict_winner(lines.join(homes, F.col("l_suppkey") == F.col("s_suppkey")), "l_partkey", "n_name")


@R.query("""
SELECT r_name, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS nations
FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1""")
def ordered_json_aggregate(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "region").join(table(spark, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    return joined.groupBy("r_name").agg(reports.ordered_json(["r_name"], "n_nationkey", ["n_nationkey", "n_name"], "nations"))


@R.query("""
SELECT user_id, count(DISTINCT date_trunc('week', ts)) AS weeks, epoch_us(max(ts)) AS last_us FROM events GROUP BY 1""")
def healthy_weeks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "user_id", "ts").groupBy("user_id").agg(
        F.count_distinct(F.date_trunc("week", "ts")).alias("weeks"), micros(F.max("ts")).alias("last_us"))


@R.query("""
SELECT o_orderkey, CASE WHEN n = 0 THEN 'empty' WHEN done = n THEN 'succeeded' WHEN failed = n THEN 'failed'
  WHEN done + failed = n THEN 'partial' ELSE 'running' END AS state, n AS jobs FROM (
  SELECT o_orderkey, count(l_orderkey) AS n, count(*) FILTER (WHERE l_returnflag = 'A') AS done,
    count(*) FILTER (WHERE l_returnflag = 'R') AS failed FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)""")
def run_rollup_state(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem", "l_orderkey", "l_returnflag").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), reports.count_where(F.col("l_returnflag") == "A", "done"), reports.count_where(F.col("l_returnflag") == "R", "failed"))
    joined = table(spark, d, "orders", "o_orderkey").join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left").na.fill(0, ["n", "done", "failed"])
    return joined.select("o_orderkey", reports.rollup_state(F.col("n"), F.col("done"), F.col("failed")).alias("state"), F.col("n").alias("jobs"))


@R.query(f"""
SELECT event_type, count(*) AS queued, count(*) FILTER (WHERE value > 50) AS large,
  CAST(epoch(TIMESTAMP '{EVENTS_AS_OF}') - floor(epoch(min(ts) FILTER (WHERE value > 50))) AS BIGINT) AS oldest_seconds FROM events GROUP BY 1""")
def queue_metrics(spark: SparkSession, d: str) -> DataFrame:
    large = F.col("value") > 50
    return table(spark, d, "events", "event_type", "value", "ts").groupBy("event_type").agg(
        F.count("*").alias("queued"), reports.count_where(large, "large"),
        (F.unix_timestamp(as_of(EVENTS_AS_OF)) - seconds(F.min(F.when(large, F.col("ts"))))).alias("oldest_seconds"))


@R.query("SELECT lower(trim(c_mktsegment)) AS segment, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def case_insensitive_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer", "c_mktsegment").groupBy(F.lower(F.trim("c_mktsegment")).alias("segment")).agg(
        F.count("*").alias("n")).where("n > 1")


@R.query("SELECT o_custkey, coalesce(o_orderpriority, 'none') AS family, max(o_totalprice) AS best FROM orders GROUP BY 1, 2")
def best_per_family(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders", "o_custkey", "o_orderpriority", "o_totalprice").groupBy(
        "o_custkey", F.coalesce("o_orderpriority", F.lit("none")).alias("family")).agg(F.max("o_totalprice").alias("best"))


@R.query("""
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def anti_unlinked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer", "c_custkey").join(
        table(spark, d, "orders", "o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@R.query("SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)")
def semi_has_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", "p_name").join(
        table(spark, d, "lineitem", "l_partkey"), F.col("p_partkey") == F.col("l_partkey"), "left_semi")


@R.query("""
SELECT o_orderkey, l_linenumber, l_extendedprice, line_count FROM orders LEFT JOIN (
  SELECT l_orderkey, l_linenumber, l_extendedprice, count(*) OVER (PARTITION BY l_orderkey) AS line_count,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber DESC, l_partkey DESC) AS k FROM lineitem) l
ON l_orderkey = o_orderkey AND k = 1""")
def lateral_top1(spark: SparkSession, d: str) -> DataFrame:
    best = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey").groupBy("l_orderkey").agg(
        F.max(F.struct("l_extendedprice", "l_linenumber", "l_partkey")).alias("b"), F.count("*").alias("line_count"))
    return table(spark, d, "orders", "o_orderkey").join(best, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "b.l_linenumber", "b.l_extendedprice", "line_count")


@R.query("""
WITH fields(field) AS (VALUES ('click'), ('purchase'), ('view'), ('refund')),
decisions AS (SELECT user_id, event_type AS field, count(*) AS n, max(value) AS best, max(ts) AS seen FROM events GROUP BY 1, 2)
SELECT c_custkey AS user_id, field, CASE WHEN n > 3 THEN 'conflicted' WHEN n IS NULL THEN 'unknown'
  WHEN seen < TIMESTAMP '2024-01-15 00:00:00' THEN 'stale' WHEN best > 30 THEN 'selected' ELSE 'retained' END AS state
FROM customer CROSS JOIN fields LEFT JOIN decisions USING (field) WHERE false
UNION ALL
SELECT c_custkey, f.field, CASE WHEN n > 3 THEN 'conflicted' WHEN n IS NULL THEN 'unknown'
  WHEN seen < TIMESTAMP '2024-01-15 00:00:00' THEN 'stale' WHEN best > 30 THEN 'selected' ELSE 'retained' END
FROM customer CROSS JOIN fields f LEFT JOIN decisions d ON d.user_id = c_custkey AND d.field = f.field""")
def coverage_matrix(spark: SparkSession, d: str) -> DataFrame:
    entities = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    decisions = table(spark, d, "events").select("user_id", F.col("event_type").alias("field"), "value", "ts").groupBy("user_id", "field").agg(
        (F.count("*") > 3).alias("conflicted"), (F.max("ts") < as_of("2024-01-15 00:00:00")).alias("stale"),
        F.when(F.max("value") > 30, "selected").otherwise("retained").alias("status"))
    return reports.coverage(entities, "user_id", ["click", "purchase", "view", "refund"], decisions)


@R.query("""
SELECT l_orderkey, l_partkey FROM (
  SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey) AS a,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey) AS b
  FROM (SELECT l_orderkey, l_partkey, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2)) WHERE a = 1 AND b = 1""")
def one_to_one_assignment(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice").groupBy("l_orderkey", "l_partkey").agg(
        F.max("l_extendedprice").alias("l_extendedprice"))
    return latest.one_to_one(pairs, "l_orderkey", "l_partkey", [F.desc("l_extendedprice")]).select("l_orderkey", "l_partkey")


@R.query("""
WITH totals AS (SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS DECIMAL(18, 2))) AS q FROM lineitem GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER w AS k, lead(q) OVER w AS second FROM totals WINDOW w AS (PARTITION BY l_partkey ORDER BY q DESC, l_suppkey))
SELECT l_partkey, l_suppkey, CAST(q AS DOUBLE) AS quantity FROM ranked WHERE k = 1 AND (second IS NULL OR q - second >= 5)""")
def margin_top1(spark: SparkSession, d: str) -> DataFrame:
    totals = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_quantity").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"))
    return latest.margin_top1(totals, ["l_partkey"], "q", "l_suppkey", 5).select(
        "l_partkey", "l_suppkey", F.col("q").cast("double").alias("quantity"))


@R.query("""
SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END,
  CASE WHEN o_totalprice > 100000 THEN NULL ELSE o_totalprice END ASC NULLS FIRST, o_orderkey LIMIT 50""")
def topk_nulls_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    price = F.when(~(F.col("o_totalprice") > 100000), F.col("o_totalprice"))
    return rows.orderBy(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1), price.asc_nulls_first(), "o_orderkey").limit(50).select(
        "o_orderkey", "o_orderstatus")


@R.query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
  (o_orderstatus = 'O') DESC, o_totalprice DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""")
def argmax_anchor(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.struct(F.col("o_orderstatus") == "O", "o_totalprice", "o_orderkey")
    return rows.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_totalprice"), key).alias("b")).select("o_custkey", "b.*")


@R.query("""
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""")
def union_all_entities(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return c.unionByName(table(spark, d, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@R.query("""
SELECT event_type AS name FROM events UNION SELECT o_orderstatus FROM orders UNION SELECT lang FROM documents""")
def union_distinct_names(spark: SparkSession, d: str) -> DataFrame:
    names = [table(spark, d, t).select(F.col(c).alias("name")).distinct() for t, c in (("events", "event_type"), ("orders", "o_orderstatus"), ("documents", "lang"))]
    return names[0].union(names[1]).union(names[2]).distinct()


@R.query("""
SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%e%' OR p_brand ILIKE '%#1%' ORDER BY p_name, p_partkey LIMIT 40 OFFSET 20""")
def ilike_paged(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part", "p_partkey", "p_name", "p_brand").where(F.col("p_name").ilike("%e%") | F.col("p_brand").ilike("%#1%"))
    return rows.select("p_partkey", "p_name").orderBy("p_name", "p_partkey").offset(20).limit(40)


@R.query("""
SELECT doc_id FROM documents WHERE NOT list_has_any(string_split(lower(text), ' '), ['idiot', 'moron', 'clown', 'scum'])""")
def array_overlap_filter(spark: SparkSession, d: str) -> DataFrame:
    flags = F.array(*(F.lit(x) for x in ("idiot", "moron", "clown", "scum")))
    return table(spark, d, "documents", "doc_id", "text").where(~F.arrays_overlap(F.split(F.lower("text"), " "), flags)).select("doc_id")


@R.query("""
SELECT c_custkey, s_name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
WHERE (CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_nationkey END) IS DISTINCT FROM s_nationkey""")
def null_safe_diff(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "customer", "c_custkey", "c_nationkey").join(
        table(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_name"), F.col("c_custkey") == F.col("s_suppkey"), "left")
    home = F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey"))
    return joined.where(~home.eqNullSafe(F.col("s_nationkey"))).select("c_custkey", "s_name")


@R.query("""
SELECT user_id, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_us, count(*) AS n, count(*) > 2 AS over_limit FROM events GROUP BY 1, 2""")
def fixed_window_quota(spark: SparkSession, d: str) -> DataFrame:
    from cairn.streaming.quota import window_counts

    rows = table(spark, d, "events", "user_id", "ts")
    return window_counts(rows, "user_id", "ts", "1 hour", 2).select("user_id", micros(F.col("window_start")).alias("window_us"), "n", "over_limit")


@R.query("""
SELECT conv_id, turn, role FROM (SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE k = 1 OR before IS DISTINCT FROM role""")
def turn_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations", "conv_id", "turn", "role")
    return latest.changed_only(rows, ["conv_id"], ["turn"], "role")


@R.query("SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "user_id", "props").groupBy(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"))


@R.query("""
WITH names AS (SELECT event_type AS name FROM events UNION SELECT 'idle'),
volume AS (SELECT event_type AS name, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1),
recent AS (SELECT event_type AS name, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1)
SELECT names.name, coalesce(volume.n, 0) AS events, coalesce(users, 0) AS users, coalesce(recent.n, 0) AS recent
FROM names LEFT JOIN volume USING (name) LEFT JOIN recent ON recent.name = names.name""")
def provider_dashboard(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events", "event_type", "user_id", "ts")
    stats = events.groupBy(F.col("event_type").alias("name")).agg(
        F.count("*").alias("events"), F.count_distinct("user_id").alias("users"),
        F.count_if(F.col("ts") >= as_of("2024-01-20 00:00:00")).alias("recent"))
    idle = spark.createDataFrame([("idle",)], "name string").join(stats, "name", "left_anti").select(
        "name", *(F.lit(0).cast("long").alias(c) for c in ("events", "users", "recent")))
    return stats.unionByName(idle)


@R.query("""
SELECT n_name, bool_or(s_acctbal < 0) AS any_negative, array_to_string(list_sort(list(DISTINCT s_suppkey)), ',') AS suppliers
FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1""")
def distinct_lists(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "nation", "n_nationkey", "n_name").join(
        table(spark, d, "supplier", "s_nationkey", "s_suppkey", "s_acctbal"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    keys = F.concat_ws(",", F.array_sort(F.collect_set("s_suppkey")).cast("array<string>"))
    return joined.groupBy("n_name").agg(F.bool_or(F.col("s_acctbal") < 0).alias("any_negative"),
                                        F.when(F.count("s_suppkey") > 0, keys).alias("suppliers"))


@R.query("""
SELECT l_orderkey, l_linenumber, (l_discount > 0.02 AND l_tax < 0.06 AND l_returnflag <> 'R' AND l_quantity >= 10) AS live,
  (CASE WHEN l_discount > 0 THEN 1 ELSE 0 END + CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) = 1 AS exactly_one FROM lineitem""")
def eligibility_predicate(spark: SparkSession, d: str) -> DataFrame:
    from cairn.functions.values import exactly_one

    live = (F.col("l_discount") > 0.02) & (F.col("l_tax") < 0.06) & (F.col("l_returnflag") != "R") & (F.col("l_quantity") >= 10)
    one = exactly_one(F.when(F.col("l_discount") > 0, 1), F.when(F.col("l_tax") > 0, 1))
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_quantity").select(
        "l_orderkey", "l_linenumber", live.alias("live"), one.alias("exactly_one"))


@R.query("""
SELECT c_custkey FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery') AND c_nationkey < 15""")
def scope_filter(spark: SparkSession, d: str) -> DataFrame:
    scope, nation = ["BUILDING", "machinery"], 15
    rows = table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    if scope:
        rows = rows.where(F.lower("c_mktsegment").isin(*(s.lower() for s in scope)))
    if nation is not None:
        rows = rows.where(F.col("c_nationkey") < nation)
    return rows.select("c_custkey")
