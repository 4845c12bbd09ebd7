"""Quality, join, aggregate, window, sort and set queries over batch tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.analytics import inventory
from millrace.functions import clean
from millrace.operators import aggregates as agg, quality
from millrace.operators.tables import earliest_by, grid
from millrace.queries import inputs
from millrace.queries.inputs import ORDERS_SQL, POS_SQL, SALES_SQL, TRANSACTIONS_SQL, TRIPS_SQL, USERS_SQL
from millrace.queries.registry import query
from millrace.scratch import materialise, scratch_path

# ---- quality -------------------------------------------------------------------------------

LINE_RULES = {"quantity_range": "l_quantity between 1 and 45", "discount_limit": "l_discount <= 0.08",
              "taxed": "nullif(l_tax, 0) > 0.01"}
EVENT_RULES = {"worth_it": "value > 5"}

LINE_METRICS_SQL = """
counted AS (
  SELECT count(*) AS n,
         count(*) FILTER (l_quantity BETWEEN 1 AND 45) AS a, count(*) FILTER (l_discount <= 0.08) AS b,
         count(*) FILTER (nullif(l_tax, 0) > 0.01) AS c,
         count(*) FILTER (l_quantity BETWEEN 1 AND 45 AND l_discount <= 0.08 AND nullif(l_tax, 0) > 0.01) AS ok
  FROM lineitem),
metrics AS (
  SELECT 'lineitem' AS dataset, 'quantity_range' AS name, a AS passed_records, n, ok FROM counted UNION ALL
  SELECT 'lineitem', 'discount_limit', b, n, ok FROM counted UNION ALL
  SELECT 'lineitem', 'taxed', c, n, ok FROM counted)"""


@query("q1_warn", f"""
WITH {LINE_METRICS_SQL}
SELECT dataset, name, passed_records, n - passed_records AS failed_records, CAST(0 AS BIGINT) AS dropped_records,
       n AS output_records FROM metrics""")
def q1(t):
    """Rules counted while the table is written; no row is dropped."""
    return quality.write_checked(t.lineitem, "lineitem", LINE_RULES, scratch_path(t.spark, "checked"))


@query("q2_drop", """
SELECT event_id, user_id, event_type, value FROM events WHERE value > 5""")
def q2(t):
    return quality.drop_failing(t.events, EVENT_RULES).select("event_id", "user_id", "event_type", "value")


@query("q3_drop_if_any_fails", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_quantity BETWEEN 1 AND 45 AND l_discount <= 0.08 AND nullif(l_tax, 0) > 0.01""")
def q3(t):
    return quality.drop_failing(t.lineitem, LINE_RULES).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")


@query("q4_quarantine", """
SELECT l_orderkey, l_linenumber, l_partkey,
       concat_ws(',', CASE WHEN (l_quantity BETWEEN 1 AND 45) IS NOT TRUE THEN 'quantity_range' END,
                      CASE WHEN (l_discount <= 0.08) IS NOT TRUE THEN 'discount_limit' END,
                      CASE WHEN (nullif(l_tax, 0) > 0.01) IS NOT TRUE THEN 'taxed' END) AS broken
FROM lineitem WHERE (l_quantity BETWEEN 1 AND 45 AND l_discount <= 0.08 AND nullif(l_tax, 0) > 0.01) IS NOT TRUE""")
def q4(t):
    _, aside = quality.quarantine(t.lineitem, LINE_RULES)
    return aside.select("l_orderkey", "l_linenumber", "l_partkey",
                        F.array_join("broken_rules", ",").alias("broken"))


@query("q5_rule_metrics", f"""
WITH {LINE_METRICS_SQL}
SELECT dataset, name, passed_records, n - passed_records AS failed_records, n - ok AS dropped_records,
       ok AS output_records FROM metrics""")
def q5(t):
    return quality.rule_metrics(t.lineitem, "lineitem", LINE_RULES, action="drop")


@query("q6_quality_report", f"""
WITH {LINE_METRICS_SQL}
SELECT dataset, CAST(sum(passed_records) AS BIGINT) AS passed_records,
       CAST(sum(n - passed_records) AS BIGINT) AS failed_records FROM metrics GROUP BY dataset
UNION ALL
SELECT 'events', count(*) FILTER (value > 5), count(*) FILTER ((value > 5) IS NOT TRUE) FROM events""")
def q6(t):
    both = quality.rule_metrics(t.lineitem, "lineitem", LINE_RULES).unionByName(
        quality.rule_metrics(t.events, "events", EVENT_RULES))
    return quality.quality_totals(both)


@query("q7_row_counts_agree", f"""
WITH {TRIPS_SQL}
SELECT (SELECT count(*) FROM trips) AS before_rows,
       (SELECT count(*) FROM trips LEFT JOIN airports ON origin = iata_code) AS after_rows,
       (SELECT count(*) FROM trips) = (SELECT count(*) FROM trips LEFT JOIN airports ON origin = iata_code) AS same_count""")
def q7(t):
    """Enrichment neither loses nor repeats rows."""
    trips = inputs.trips(t)
    joined = trips.join(inputs.airports(t), F.col("origin") == F.col("iata_code"), "left")
    return quality.row_count_check({"before": trips, "after": joined})


@query("q8_column_profile", """
SELECT 'c_custkey' AS "column", count(*) AS records, count(*) - count(c_custkey) AS nulls,
       count(DISTINCT c_custkey) AS distinct_values, CAST(min(c_custkey) AS VARCHAR) AS lowest, CAST(max(c_custkey) AS VARCHAR) AS highest FROM customer
UNION ALL SELECT 'segment', count(*), count(*) - count(nullif(c_mktsegment, 'MACHINERY')), count(DISTINCT nullif(c_mktsegment, 'MACHINERY')),
       min(nullif(c_mktsegment, 'MACHINERY')), max(nullif(c_mktsegment, 'MACHINERY')) FROM customer
UNION ALL SELECT 'c_nationkey', count(*), count(*) - count(c_nationkey), count(DISTINCT c_nationkey),
       CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR) FROM customer""")
def q8(t):
    frame = t.customer.select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"), "c_nationkey")
    return quality.column_profile(frame, exact=True)


@query("q9_first_row_per_key", f"""
WITH {TRIPS_SQL} SELECT * FROM airlines""")
def q9(t):
    active = inputs.airline_rows(t).filter("active = 'Y'")
    return earliest_by(active, ["iata"], ["name"])


# ---- joins (stream-static ones are in q_streams) -------------------------------------------

@query("j4_left_join_on_two_keys", f"""
WITH {POS_SQL}
SELECT c.item_id, c.store_id, count(*) AS n, count(l.quantity) AS matched,
       CAST(sum(coalesce(l.quantity, 0)) AS BIGINT) AS counted
FROM change c LEFT JOIN latest l ON c.item_id = l.item_id AND c.store_id = l.store_id GROUP BY ALL""")
def j4(t):
    latest = inventory.latest_snapshots(inputs.snapshots(t)).select(
        "item_id", "store_id", F.col("quantity").alias("counted"))
    # summed per pair before the join, so both sides have one row per key
    moves = inputs.changes(t).groupBy("item_id", "store_id").agg(F.count("*").alias("n"))
    return moves.join(latest, ["item_id", "store_id"], "left").select(
        "item_id", "store_id", "n", F.when(F.col("counted").isNotNull(), F.col("n")).otherwise(0).alias("matched"),
        (F.col("n") * F.coalesce("counted", F.lit(0))).alias("counted"))


@query("j5_dimension_grid", f"""
WITH {POS_SQL} SELECT item_id, item.name AS item_name, store_id, store.name AS store_name
FROM item CROSS JOIN store""")
def j5(t):
    return grid(inputs.items(t).withColumnRenamed("name", "item_name"),
                inputs.stores(t).withColumnRenamed("name", "store_name"))


@query("j6_scalar_attach", f"""
WITH {ORDERS_SQL}
SELECT customer_id, date_diff('day', max(d), (SELECT max(d) FROM sales)) AS days_quiet
FROM sales GROUP BY customer_id""")
def j6(t):
    """A one-row aggregate is used as a scalar, not joined."""
    orders = inputs.customer_orders(t)
    today = orders.agg(F.max("invoice_date")).scalar()
    last = orders.groupBy("customer_id").agg(F.max("invoice_date").alias("last"))
    return last.select("customer_id", F.datediff(today, "last").cast("bigint").alias("days_quiet"))


@query("j7_equi_join_with_range_condition", f"""
WITH {POS_SQL}
SELECT s.item_id, s.store_id, strftime(s.date_time, '%Y-%m-%d') AS counted_on,
       count(c.quantity) AS n_later, CAST(coalesce(sum(c.quantity), 0) AS BIGINT) AS moved
FROM latest s LEFT JOIN change c
  ON s.item_id = c.item_id AND s.store_id = c.store_id AND c.date_time >= s.date_time GROUP BY ALL""")
def j7(t):
    latest = inventory.latest_snapshots(inputs.snapshots(t))
    later = inventory.moved_since(inputs.changes(t), latest)
    return latest.join(later, ["item_id", "store_id"], "left").select(
        "item_id", "store_id", F.col("date_time").cast("date").alias("counted_on"),
        F.coalesce("_movements", F.lit(0)).cast("bigint").alias("n_later"), F.coalesce("_moved", F.lit(0)).alias("moved"))


@query("j8_inner_join_negated_filter", f"""
WITH {POS_SQL}
SELECT x.store_id, x.item_id, strftime(x.date_time, '%Y-%m-%d %H:%M:%S.%f') AS date_time, x.quantity
FROM change x JOIN store y ON x.store_id = y.store_id
WHERE NOT (y.name = 'online' AND x.change_type = 'bopis')""")
def j8(t):
    return inventory.countable_changes(inputs.changes(t), inputs.stores(t))


@query("j9_join_to_shares", f"""
WITH {SALES_SQL}, by_item AS (SELECT item, year(date) AS year, sum(sales) AS sold FROM sales GROUP BY ALL),
share AS (SELECT store, item, sum(sales) / CAST(sum(sum(sales)) OVER (PARTITION BY item) AS DOUBLE) AS ratio
          FROM sales GROUP BY store, item)
SELECT CAST(year AS INTEGER) AS year, store, item, sold * ratio AS allocated FROM by_item JOIN share USING (item)""")
def j9(t):
    sales = inputs.sales(t)
    by_item = sales.groupBy("item", F.year("date").alias("year")).agg(F.sum("sales").alias("sold"))
    shares = agg.share_of_total(
        sales.groupBy("store", "item").agg(F.sum("sales").alias("s")), ["item"], "s", "ratio")
    return by_item.join(shares, "item").select(
        "year", "store", "item", (F.col("sold") * F.col("ratio")).alias("allocated"))


@query("j10_wide_assembly", f"""
WITH {TRANSACTIONS_SQL},
anchor AS (SELECT DISTINCT household_key FROM tx),
a AS (SELECT household_key, count(*) AS n_1998 FROM tx WHERE year(day) = 1998 GROUP BY 1),
b AS (SELECT household_key, CAST(sum(units) AS BIGINT) AS units_1999 FROM tx WHERE year(day) = 1999 GROUP BY 1),
c AS (SELECT household_key, strftime(max(day), '%Y-%m-%d') AS last_day FROM tx GROUP BY 1)
SELECT * FROM anchor LEFT JOIN a USING (household_key) LEFT JOIN b USING (household_key) LEFT JOIN c USING (household_key)""")
def j10(t):
    """Four branches from one set of partial sums per household and year, so that the transactions are joined and read once."""
    tx = clean.normalise_transactions(inputs.raw_transactions(t))
    key = ["household_key"]
    years = materialise(tx.groupBy(*key, F.year("day").alias("year")).agg(
        F.count("*").alias("n"), F.sum("units").alias("units"), F.max("day").alias("last_day")), "years")
    a = years.filter("year = 1998").select(*key, F.col("n").alias("n_1998"))
    b = years.filter("year = 1999").select(*key, F.col("units").alias("units_1999"))
    c = years.groupBy(*key).agg(F.max("last_day").alias("last_day"))
    return years.select(*key).distinct().join(a, key, "left").join(b, key, "left").join(c, key, "left")


@query("j13_left_join_then_not_null", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL""")
def j13(t):
    return t.documents.join(t.labels, ["doc_id"], "left").filter(F.col("quality").isNotNull()).select(
        "doc_id", "lang", "n_chars", "quality")


@query("j14_rejoin_history", f"""
WITH {ORDERS_SQL}, firsts AS (SELECT customer_id, min(d) AS first_day FROM sales GROUP BY 1)
SELECT s.customer_id, strftime(s.d, '%Y-%m-%d') AS day, CAST(sum(amount) AS DOUBLE) AS amount
FROM sales s JOIN firsts f USING (customer_id) WHERE s.d > f.first_day GROUP BY ALL""")
def j14(t):
    daily = inputs.customer_orders(t).groupBy("customer_id", F.col("invoice_date").alias("day")).agg(
        F.sum("sales_amount").alias("amount"))
    firsts = daily.groupBy("customer_id").agg(F.min("day").alias("first_day"))
    return daily.join(firsts, "customer_id").filter(F.col("day") > F.col("first_day")).drop("first_day")


# ---- aggregates ----------------------------------------------------------------------------

@query("a1_group_count_sum", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY ALL""")
def a1(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"))


@query("a2_summary_bundle", """
SELECT event_type, strftime(ts, '%Y%m') AS month_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average, max(value) AS highest
FROM events GROUP BY ALL""")
def a2(t):
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return t.events.groupBy("event_type", F.date_format("ts", "yyyyMM").alias("month_id")).agg(
        total.alias("total"), (total / F.count("value")).alias("average"), F.max("value").alias("highest"))


@query("a3_group_by_expression", f"""
WITH {SALES_SQL} SELECT strftime(date_trunc('month', date), '%Y-%m-%d') AS month, CAST(year(date) AS INTEGER) AS year,
       CAST(sum(sales) AS BIGINT) AS sales FROM sales GROUP BY ALL""")
def a3(t):
    return inputs.sales(t).groupBy(F.trunc("date", "MM").alias("month"), F.year("date").alias("year")).agg(
        F.sum("sales").alias("sales"))


@query("a4_average_of_daily_sums", f"""
WITH {SALES_SQL}, daily AS (SELECT date, sum(sales) AS sold FROM sales GROUP BY 1)
SELECT CAST(year(date) AS INTEGER) AS year, CAST(dayofweek(date) + 1 AS INTEGER) AS weekday,
       CAST(sum(sold) AS DOUBLE) / count(*) AS avg_sales FROM daily GROUP BY ALL""")
def a4(t):
    daily = inputs.sales(t).groupBy("date").agg(F.sum("sales").alias("sold"))
    return daily.groupBy(F.year("date").alias("year"), F.dayofweek("date").alias("weekday")).agg(
        F.avg("sold").alias("avg_sales"))


@query("a5_several_distinct_counts", f"""
WITH {SALES_SQL} SELECT count(DISTINCT store) AS stores, count(DISTINCT item) AS items,
       count(DISTINCT year(date)) AS years, count(DISTINCT date) AS days FROM sales""")
def a5(t):
    return inputs.sales(t).agg(
        F.count_distinct("store").alias("stores"), F.count_distinct("item").alias("items"),
        F.count_distinct(F.year("date")).alias("years"), F.count_distinct("date").alias("days"))


@query("a6_conditional_distinct_counts", f"""
WITH {TRANSACTIONS_SQL} SELECT commodity_desc,
       count(DISTINCT CASE WHEN instore_discount > 0 THEN basket_id END) AS baskets_instore,
       count(DISTINCT CASE WHEN campaign_coupon_discount > 0 THEN basket_id END) AS baskets_campaign,
       count(DISTINCT CASE WHEN manuf_coupon_discount > 0 THEN day END) AS days_manuf FROM tx GROUP BY 1""")
def a6(t):
    tx = clean.normalise_transactions(inputs.raw_transactions(t))
    return tx.groupBy("commodity_desc").agg(
        F.count_distinct(F.when(F.col("instore_discount") > 0, F.col("basket_id"))).alias("baskets_instore"),
        F.count_distinct(F.when(F.col("campaign_coupon_discount") > 0, F.col("basket_id"))).alias("baskets_campaign"),
        F.count_distinct(F.when(F.col("manuf_coupon_discount") > 0, F.col("day"))).alias("days_manuf"))


@query("a7_conditional_sum_null_when_none", f"""
WITH {TRANSACTIONS_SQL} SELECT household_key, CAST(sum(CASE WHEN manuf_coupon_discount > 2000 THEN 1 END) AS BIGINT) AS n_manuf,
       CAST(sum(CASE WHEN campaign_coupon_discount > 6000 THEN 1 END) AS BIGINT) AS n_campaign FROM tx GROUP BY 1""")
def a7(t):
    tx = clean.normalise_transactions(inputs.raw_transactions(t))
    return tx.groupBy("household_key").agg(
        agg.conditional_count(F.col("manuf_coupon_discount") > 2000).alias("n_manuf"),
        agg.conditional_count(F.col("campaign_coupon_discount") > 6000).alias("n_campaign"))


@query("a8_global_min_max", """
SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day,
       max(o_totalprice) AS top FROM orders""")
def a8(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.max("o_totalprice").alias("top"))


@query("a9_first_per_group", """
SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(value, event_id) AS last_value
FROM events GROUP BY 1""")
def a9(t):
    return t.events.groupBy("user_id").agg(
        F.min_by("event_type", "event_id").alias("first_type"), F.max_by("value", "event_id").alias("last_value"))


@query("a11_expressions_over_aggregates", """
SELECT c_custkey, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS spent,
       strftime(greatest(max(o_orderdate), TIMESTAMP '1999-01-01'), '%Y-%m-%d') AS active_until
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def a11(t):
    spent = F.coalesce(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), F.lit(0))
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(
        spent.alias("spent"),
        F.greatest(F.max(F.col("o_orderdate").cast("date")), F.lit("1999-01-01").cast("date")).alias("active_until"))


@query("a12_distinct_keys", """
SELECT DISTINCT o_custkey AS household_key, p_type AS commodity_desc
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
def a12(t):
    return inputs.raw_transactions(t).select("household_key", "commodity_desc").distinct()


@query("a13_exact_quantile_cuts", """
WITH ranked AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) AS r, count(*) OVER () AS n FROM orders),
steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step)
SELECT CAST(step AS INTEGER) AS step, v AS cut FROM steps JOIN ranked ON r = (n * step + 5) // 6""")
def a13(t):
    cuts = agg.quantile_cuts(t.orders, "o_totalprice")
    each = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(v).alias("cut")) for i, v in enumerate(cuts)])
    return t.spark.range(1).select(F.inline(each))


@query("a14_histogram", """
WITH b AS (SELECT CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 500000 THEN 21
                  ELSE CAST(floor(o_totalprice / 25000) AS BIGINT) + 1 END AS bin FROM orders)
SELECT bin, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM b), 6) AS percent FROM b GROUP BY 1""")
def a14(t):
    return agg.histogram(t.orders, "o_totalprice", 0, 500000, 20)


@query("a15_correlation", """
WITH c AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS frequency, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS spend
           FROM orders GROUP BY 1)
SELECT round(corr(frequency, spend), 6) AS r, count(*) AS n FROM c""")
def a15(t):
    per = t.orders.groupBy("o_custkey").agg(
        F.count("*").cast("double").alias("frequency"),
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("spend"))
    return per.agg(F.round(F.corr("frequency", "spend"), 6).alias("r"), F.count("*").alias("n"))


# ---- windows -------------------------------------------------------------------------------

@query("w1_row_number_dedup", """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS first_order FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def w1(t):
    slim = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("first_order"), "o_orderkey")
    return earliest_by(slim, ["o_custkey"], ["first_order", "o_orderkey"])


@query("w2_share_of_total", f"""
WITH {SALES_SQL} SELECT store, item, CAST(sum(sales) AS BIGINT) AS sold,
       CAST(sum(sales) AS DOUBLE) / CAST(sum(sum(sales)) OVER (PARTITION BY item) AS DOUBLE) AS ratio
FROM sales GROUP BY store, item""")
def w2(t):
    sold = inputs.sales(t).groupBy("store", "item").agg(F.sum("sales").alias("sold"))
    return agg.share_of_total(sold, ["item"], "sold", "ratio")


@query("w3_next_30_days", f"""
WITH {TRANSACTIONS_SQL}, daily AS (SELECT household_key, day, sum(units) AS u FROM tx GROUP BY ALL)
SELECT household_key, strftime(day, '%Y-%m-%d') AS day, CAST(sum(u) OVER (PARTITION BY household_key ORDER BY day
       RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL 30 DAY FOLLOWING) AS BIGINT) AS units_next_30 FROM daily""")
def w3(t):
    return agg.days_ahead_sum(inputs.raw_transactions(t), ["household_key"], "day", "units", 1, 30, "units_next_30")


@query("w4_first_date_on_each_row", """
SELECT o_orderkey, o_custkey, date_diff('day', min(o_orderdate) OVER (PARTITION BY o_custkey), o_orderdate) AS days_in
FROM orders""")
def w4(t):
    """The minimum is aggregated per customer and joined, so a hot customer needs no window partition."""
    firsts = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_at"))
    return t.orders.join(firsts, "o_custkey").select(
        "o_orderkey", "o_custkey", F.datediff("o_orderdate", "first_at").cast("bigint").alias("days_in"))


@query("w5_next_change", """
SELECT event_id, user_id, event_type, lag(event_type) OVER w AS previous_type, lead(event_id) OVER w AS next_id
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def w5(t):
    slim = t.events.select("event_id", "user_id", "event_type")
    return agg.neighbours(slim, ["user_id"], "event_id", previous={"previous_type": "event_type"},
                          following={"next_id": "event_id"})


# ---- sort, limit, set ----------------------------------------------------------------------

@query("o1_order_by", """
SELECT c_mktsegment, c_nationkey, c_custkey, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey""")
def o1(t):
    return t.customer.select("c_mktsegment", "c_nationkey", "c_custkey", "c_acctbal").orderBy(
        "c_mktsegment", F.desc("c_acctbal"), "c_custkey")


@query("o2_top_groups", """
SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10""")
def o2(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return sold.groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(10)


@query("o3_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def o3(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("u1_positional_union", """
SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def u1(t):
    return t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).union(
        t.supplier.select("s_suppkey", "s_name"))


# ---- event-log reports ---------------------------------------------------------------------

LOG_SQL = """
log AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts, event_type AS kind, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events)"""


def event_log(t):
    """Job log records: a definition per signup event, a progress report per other event."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    dataset = F.concat(F.lit("table_"), F.col("user_id").cast("string"))
    define = F.to_json(F.struct(F.struct(
        dataset.alias("output_dataset"), F.array(F.lit("raw"), F.col("event_type")).alias("input_datasets"),
        F.lit("append").alias("flow_type")).alias("flow_definition")))
    rule = lambda name, ok, bad: F.struct(
        dataset.alias("dataset"), F.lit(name).alias("name"), ok.alias("passed_records"), bad.alias("failed_records"))
    zero = F.lit(0).cast("bigint")
    progress = F.to_json(F.struct(F.struct(
        F.lit("COMPLETED").alias("status"), F.struct((k + 1).alias("num_output_rows")).alias("metrics"),
        F.struct(F.lit(1).cast("bigint").alias("dropped_records"),
                 F.array(rule("valid_id", k, F.lit(2).cast("bigint")), rule("valid_value", k + 2, zero)).alias("expectations"),
                 ).alias("data_quality")).alias("flow_progress")))
    return t.events.select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "signup", define).otherwise(progress).alias("details"))


@query("l6_lineage_report", f"""
WITH {LOG_SQL}
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, 'table_' || CAST(user_id AS VARCHAR) AS output_dataset,
       '["raw","signup"]' AS input_datasets, 'append' AS flow_type FROM log WHERE kind = 'signup'""")
def l6(t):
    return quality.lineage(event_log(t))


METRICS_SQL = f"""
{LOG_SQL},
metrics AS (
  SELECT id, 'table_' || CAST(user_id AS VARCHAR) AS dataset, 'valid_id' AS name, k AS passed_records,
         CAST(2 AS BIGINT) AS failed_records, 'COMPLETED' AS status_update, CAST(1 AS BIGINT) AS dropped_records,
         k + 1 AS output_records, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM log WHERE kind <> 'signup'
  UNION ALL
  SELECT id, 'table_' || CAST(user_id AS VARCHAR), 'valid_value', k + 2, CAST(0 AS BIGINT), 'COMPLETED', CAST(1 AS BIGINT),
         k + 1, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') FROM log WHERE kind <> 'signup')"""


@query("q5_metrics_from_event_log", f"WITH {METRICS_SQL} SELECT * FROM metrics")
def q5_log(t):
    return quality.log_metrics(event_log(t))


@query("l7_quality_report", f"""
WITH {METRICS_SQL} SELECT dataset, CAST(sum(passed_records) AS BIGINT) AS passed_records,
       CAST(sum(failed_records) AS BIGINT) AS failed_records FROM metrics GROUP BY 1""")
def l7(t):
    return quality.quality_totals(quality.log_metrics(event_log(t)))
