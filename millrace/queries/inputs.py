"""

Each mapping is given twice: as a DataFrame and as the SQL text of a WITH clause.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# ---- point of sale -------------------------------------------------------------------------

POS_SQL = """
store AS (
  SELECT DISTINCT CAST(s_suppkey % 5 AS INTEGER) AS store_id,
         CASE WHEN s_suppkey % 5 = 0 THEN 'online' ELSE 'store_' || CAST(s_suppkey % 5 AS VARCHAR) END AS name
  FROM supplier),
item AS (SELECT p_partkey AS item_id, p_name AS name FROM part),
snapshot AS (
  SELECT l_partkey AS item_id, CAST(l_suppkey % 5 AS INTEGER) AS store_id,
         l_shipdate AS date_time, CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem WHERE l_returnflag = 'A'),
change AS (
  SELECT l_partkey AS item_id, CAST(l_suppkey % 5 AS INTEGER) AS store_id,
         l_shipdate AS date_time,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END AS INTEGER) AS quantity,
         CASE WHEN l_linestatus = 'O' THEN 'bopis' ELSE 'sale' END AS change_type
  FROM lineitem WHERE l_returnflag <> 'A'),
latest AS (
  SELECT item_id, store_id, date_time, quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id, store_id
                                 ORDER BY date_time DESC, quantity DESC) AS rn FROM snapshot)
  WHERE rn = 1)
"""


def stores(t) -> DataFrame:
    number = (F.col("s_suppkey") % 5).cast("int")
    return t.supplier.select(number.alias("store_id")).distinct().withColumn(
        "name",
        F.when(F.col("store_id") == 0, "online")
        .otherwise(F.concat(F.lit("store_"), F.col("store_id").cast("string"))),
    )


def items(t) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))


def snapshots(t) -> DataFrame:
    return t.lineitem.filter("l_returnflag = 'A'").select(
        F.col("l_partkey").alias("item_id"),
        (F.col("l_suppkey") % 5).cast("int").alias("store_id"),
        F.col("l_shipdate").alias("date_time"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def changes(t) -> DataFrame:
    return t.lineitem.filter("l_returnflag <> 'A'").select(
        F.col("l_partkey").alias("item_id"),
        (F.col("l_suppkey") % 5).cast("int").alias("store_id"),
        F.col("l_shipdate").alias("date_time"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
        .otherwise(-F.col("l_quantity")).cast("int").alias("quantity"),
        F.when(F.col("l_linestatus") == "O", "bopis").otherwise("sale").alias("change_type"),
    )


# ---- orders of one customer ----------------------------------------------------------------

ORDERS_SQL = """
sales AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS d,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders)
"""


def customer_orders(t) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("sales_amount"),
    )


# ---- household transactions ----------------------------------------------------------------

TRANSACTIONS_SQL = """
raw_tx AS (
  SELECT o_custkey AS household_key, o_orderkey AS basket_id, CAST(o_orderdate AS DATE) AS day,
         l_partkey AS product_id, p_type AS commodity_desc, CAST(l_quantity AS BIGINT) AS units,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,5)) AS sales_value,
         CAST(-CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,5)) AS retail_disc,
         CAST(CASE WHEN l_returnflag <> 'N' THEN -CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) ELSE 0 END AS DECIMAL(18,5)) AS coupon_disc,
         CAST(CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'N'
              THEN -CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) * CAST(0.5 AS DECIMAL(2,1)) ELSE 0 END AS DECIMAL(18,5)) AS coupon_match_disc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
tx AS (
  SELECT household_key, basket_id, day, product_id, commodity_desc, units,
         CASE WHEN coupon_match_disc = 0 THEN -coupon_disc ELSE 0 END AS campaign_coupon_discount,
         CASE WHEN coupon_match_disc <> 0 THEN -coupon_disc ELSE 0 END AS manuf_coupon_discount,
         -coupon_match_disc AS manuf_coupon_match_discount,
         -(coupon_disc - coupon_match_disc) AS total_coupon_discount,
         -retail_disc AS instore_discount,
         sales_value AS amount_paid,
         sales_value - retail_disc - coupon_disc - coupon_match_disc AS amount_list
  FROM raw_tx)
"""


def raw_transactions(t) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    money = "decimal(18,5)"
    coupon = F.when(F.col("l_returnflag") != "N", -price * tax).otherwise(F.lit(0))
    matched = F.when(
        (F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "N"),
        -price * tax * F.lit("0.5").cast("decimal(2,1)"),
    ).otherwise(F.lit(0))
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("household_key"),
            F.col("o_orderkey").alias("basket_id"),
            F.col("o_orderdate").cast("date").alias("day"),
            F.col("l_partkey").alias("product_id"),
            F.col("p_type").alias("commodity_desc"),
            F.col("l_quantity").cast("bigint").alias("units"),
            (price * (1 - discount)).cast(money).alias("sales_value"),
            (-price * discount).cast(money).alias("retail_disc"),
            coupon.cast(money).alias("coupon_disc"),
            matched.cast(money).alias("coupon_match_disc"),
        )
    )


# ---- flights -------------------------------------------------------------------------------
# a trip is an order line; origin and destination are the nations of customer and supplier

TRIPS_SQL = """
trips AS (
  SELECT l_orderkey AS trip_id, l_linenumber AS leg,
         CAST(year(l_shipdate) AS VARCHAR) AS year_text,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'NA' ELSE CAST(month(l_shipdate) AS VARCHAR) END AS month_text,
         CAST(day(l_shipdate) AS VARCHAR) AS day_text,
         CASE WHEN l_tax > 0.075 THEN 'NA' ELSE CAST(isodow(l_shipdate) AS VARCHAR) END AS weekday_text,
         p_brand AS carrier, 'N' || CAST(c_nationkey AS VARCHAR) AS origin, 'N' || CAST(s_nationkey AS VARCHAR) AS dest,
         CASE WHEN l_discount > 0.08 THEN 'NA' ELSE CAST(CAST(l_quantity AS INTEGER) - 20 AS VARCHAR) END AS arr_delay,
         CAST(p_size AS VARCHAR) AS distance
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
airports AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS iata_code, n_name AS name, r_name AS municipality,
         CAST(n_nationkey * 10 AS VARCHAR) || ',' || CAST(n_regionkey AS VARCHAR) AS coordinates
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7),
airline_rows AS (
  SELECT p_brand AS iata, p_name AS name, p_type AS kind,
         CASE WHEN p_size > 10 THEN 'Y' ELSE 'N' END AS active
  FROM part),
airlines AS (
  SELECT iata, name, kind, active FROM (
    SELECT *, row_number() OVER (PARTITION BY iata ORDER BY name, kind, active) AS rn
    FROM airline_rows WHERE active = 'Y') WHERE rn = 1)
"""


def trip_origins(t) -> DataFrame:
    """The nation each order's customer is in."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")


def trips(t, line: DataFrame | None = None, origins: DataFrame | None = None) -> DataFrame:
    """Trips of all order lines or of some, in which case the origins may have been written before."""
    ship = F.col("l_shipdate")
    return (
        (t.lineitem if line is None else line).join(trip_origins(t) if origins is None else origins, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("trip_id"),
            F.col("l_linenumber").alias("leg"),
            F.year(ship).cast("string").alias("year_text"),
            F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "NA")
            .otherwise(F.month(ship).cast("string")).alias("month_text"),
            F.dayofmonth(ship).cast("string").alias("day_text"),
            F.when(F.col("l_tax") > 0.075, "NA").otherwise((F.weekday(ship) + 1).cast("string")).alias("weekday_text"),
            F.col("p_brand").alias("carrier"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("origin"),
            F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("dest"),
            F.when(F.col("l_discount") > 0.08, "NA")
            .otherwise((F.col("l_quantity").cast("int") - 20).cast("string")).alias("arr_delay"),
            F.col("p_size").cast("string").alias("distance"),
        )
    )


def airports(t) -> DataFrame:
    return (
        t.nation.filter("n_nationkey <> 7")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iata_code"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("municipality"),
            F.concat_ws(",", (F.col("n_nationkey") * 10).cast("string"),
                        F.col("n_regionkey").cast("string")).alias("coordinates"),
        )
    )


def airline_rows(t) -> DataFrame:
    return t.part.select(
        F.col("p_brand").alias("iata"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"),
        F.when(F.col("p_size") > 10, "Y").otherwise("N").alias("active"),
    )


# ---- users and their spend -----------------------------------------------------------------

USERS_SQL = """
users AS (
  SELECT c_custkey AS id, lower(replace(c_name, '#', '.')) || '@mail.test' AS email,
         c_mktsegment AS firstname, 'CUSTOMER' AS lastname,
         strftime(first_at, '%m-%d-%Y %H:%M:%S') AS creation_date,
         strftime(last_at, '%m-%d-%Y %H:%M:%S') AS last_activity_date
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at
                           FROM orders GROUP BY 1) ON c_custkey = o_custkey),
silver AS (
  SELECT id, sha1(email) AS email,
         upper(substr(firstname, 1, 1)) || lower(substr(firstname, 2)) AS firstname,
         upper(substr(lastname, 1, 1)) || lower(substr(lastname, 2)) AS lastname,
         strptime(creation_date, '%m-%d-%Y %H:%M:%S') AS creation_date,
         strptime(last_activity_date, '%m-%d-%Y %H:%M:%S') AS last_activity_date
  FROM users),
spend AS (
  SELECT c_custkey AS id, CAST(18 + c_nationkey * 2 AS INTEGER) AS age,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DOUBLE) END AS annual_income,
         CAST(n_orders AS DOUBLE) AS spending_core
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON c_custkey = o_custkey
  WHERE c_mktsegment <> 'MACHINERY')
"""


def users(t) -> DataFrame:
    seen = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"))
    text = "MM-dd-yyyy HH:mm:ss"
    return t.customer.join(seen, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@mail.test")).alias("email"),
        F.col("c_mktsegment").alias("firstname"),
        F.lit("CUSTOMER").alias("lastname"),
        F.date_format("first_at", text).alias("creation_date"),
        F.date_format("last_at", text).alias("last_activity_date"),
    )


def spend(t) -> DataFrame:
    bought = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return (
        t.customer.filter("c_mktsegment <> 'MACHINERY'")
        .join(bought, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            (F.lit(18) + F.col("c_nationkey") * 2).cast("int").alias("age"),
            F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("annual_income"),
            F.col("n_orders").cast("double").alias("spending_core"),
        )
    )


# ---- daily sales per store and item --------------------------------------------------------

SALES_SQL = """
sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % 10 AS INTEGER) AS store,
         CAST(l_partkey % 50 AS INTEGER) AS item, CAST(l_quantity AS INTEGER) AS sales
  FROM lineitem)
"""


def calendar_sql(*keys: str) -> str:
    """``full_days``: every day of each series from its first to its last, with its sales or 0, as the models see it."""
    by = ", ".join(keys)
    return f"""{SALES_SQL},
day_totals AS (SELECT {by}, date, CAST(sum(sales) AS DOUBLE) AS y FROM sales GROUP BY ALL),
ends AS (SELECT {by}, min(date) AS lo, max(date) AS hi FROM day_totals GROUP BY ALL),
spine AS (SELECT {by}, lo, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM ends),
full_days AS (SELECT {by}, lo, hi, date, coalesce(y, 0) AS y FROM spine LEFT JOIN day_totals USING ({by}, date))"""


def sales(t) -> DataFrame:
    return t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_suppkey") % 10).cast("int").alias("store"),
        (F.col("l_partkey") % 50).cast("int").alias("item"),
        F.col("l_quantity").cast("int").alias("sales"),
    )
