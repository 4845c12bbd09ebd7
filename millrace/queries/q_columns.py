"""Projection, filter, cleaning and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.queries import inputs
from millrace.queries.inputs import TRANSACTIONS_SQL, TRIPS_SQL, USERS_SQL
from millrace.queries.registry import query

TS = "'%Y-%m-%d %H:%M:%S.%f'"


@query("p1_project_rename_cast", """
SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, o_orderstatus AS status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text, strftime(o_orderdate, '%Y-%m-%d') AS ordered_on
FROM orders""")
def p1(t):
    return (
        t.orders.withColumnRenamed("o_orderkey", "order_id")
        .withColumn("ordered_on", F.col("o_orderdate").cast("date"))
        .selectExpr("order_id", "cast(o_custkey as int) as customer_id", "o_orderstatus as status",
                    "cast(cast(o_totalprice as decimal(18,2)) as string) as price_text",
                    "ordered_on", "o_orderpriority")
        .drop("o_orderpriority")
    )


@query("p2_star_and_literal", """
SELECT *, 90 AS duration_holdout, 'all' AS cohort FROM customer""")
def p2(t):
    return t.customer.select("*", F.lit(90).alias("duration_holdout"), F.lit("all").alias("cohort"))


@query("p3_cast_and_suffix", """
SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name_30d, TRY_CAST(p_brand AS DOUBLE) AS p_brand_30d,
       TRY_CAST(p_type AS DOUBLE) AS p_type_30d, CAST(p_size AS DOUBLE) AS p_size_30d,
       CAST(p_retailprice AS DOUBLE) AS p_retailprice_30d FROM part""")
def p3(t):
    return clean.cast_and_suffix(t.part, ["p_partkey"], "_30d")


@query("p4_token_to_null", f"""
WITH {TRIPS_SQL}
SELECT trip_id, leg, nullif(year_text, 'NA') AS year_text, nullif(month_text, 'NA') AS month_text,
       nullif(day_text, 'NA') AS day_text, nullif(weekday_text, 'NA') AS weekday_text, nullif(carrier, 'NA') AS carrier, nullif(origin, 'NA') AS origin,
       nullif(dest, 'NA') AS dest, nullif(arr_delay, 'NA') AS arr_delay, nullif(distance, 'NA') AS distance
FROM trips""")
def p4(t):
    return clean.token_to_null(inputs.trips(t), "NA")


@query("p5_day_number_to_date", """
SELECT p_partkey, strftime(DATE '2018-01-01' + (p_size - 1), '%Y-%m-%d') AS start_day,
       strftime(DATE '2018-01-01' + (p_size + 29), '%Y-%m-%d') AS end_day FROM part""")
def p5(t):
    days = t.part.selectExpr("p_partkey", "cast(p_size as string) as start_day", "p_size + 30 as end_day")
    return clean.day_numbers_to_dates(days, "2018-01-01")


@query("p6_anonymise_users", f"""
WITH {USERS_SQL}
SELECT id, email, firstname, lastname, strftime(creation_date, {TS}) AS creation_date,
       strftime(last_activity_date, {TS}) AS last_activity_date FROM silver""")
def p6(t):
    return clean.anonymise_users(inputs.users(t))


@query("p7_strip_braces", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '-' || o_orderstatus AS trans_id FROM orders""")
def p7(t):
    wrapped = t.orders.select(
        "o_orderkey", F.format_string("{%d-%s}", "o_orderkey", "o_orderstatus").alias("raw_id"))
    return wrapped.select("o_orderkey", clean.strip_braces("raw_id").alias("trans_id"))


@query("p8_explode_and_flatten", """
SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations""")
def p8(t):
    """Turns collected per short time block of a conversation, then exploded and flattened."""
    blocks = (
        t.conversations.withColumn("block", F.floor(F.col("turn") / 100))
        .groupBy("conv_id", "block").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
    )
    return blocks.select("conv_id", F.inline("turns")).select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars"))


@query("p9_row_filter", """
SELECT * FROM (SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, l_discount FROM lineitem
 WHERE (l_quantity BETWEEN 5 AND 20 AND l_returnflag IN ('A', 'R') AND NOT (l_discount > 0.05 AND l_linestatus = 'F'))
    OR nullif(l_tax, 0) IS NULL)""")
def p9(t):
    keep = (
        F.col("l_quantity").between(5, 20)
        & F.col("l_returnflag").isin("A", "R")
        & ~((F.col("l_discount") > 0.05) & (F.col("l_linestatus") == "F"))
    ) | F.nullif(F.col("l_tax"), F.lit(0.0)).isNull()
    return t.lineitem.filter(keep).select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_discount")


@query("p10_drop_nulls", f"""
WITH {USERS_SQL} SELECT * FROM spend
WHERE age IS NOT NULL AND annual_income IS NOT NULL AND spending_core IS NOT NULL""")
def p10(t):
    return clean.keep_complete(inputs.spend(t))


@query("p11_fill_zero", f"""
WITH {USERS_SQL} SELECT id, age, coalesce(annual_income, 0) AS annual_income,
       coalesce(spending_core, 0) AS spending_core FROM spend""")
def p11(t):
    return clean.fill_zero(inputs.spend(t), ["annual_income", "spending_core"])


@query("p12_seeded_sample", """
SELECT o_orderkey, o_custkey FROM orders
WHERE substr(sha1('123' || CAST(o_orderkey AS VARCHAR)), 1, 7) < '4000000'""")
def p12(t):
    return clean.hash_sample(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 0.25, "123")


@query("p13_discounts_and_list_price", f"""
WITH {TRANSACTIONS_SQL}
SELECT household_key, basket_id, strftime(day, '%Y-%m-%d') AS day, product_id, commodity_desc, units,
       CAST(campaign_coupon_discount AS DOUBLE) AS campaign_coupon_discount,
       CAST(manuf_coupon_discount AS DOUBLE) AS manuf_coupon_discount,
       CAST(manuf_coupon_match_discount AS DOUBLE) AS manuf_coupon_match_discount,
       CAST(total_coupon_discount AS DOUBLE) AS total_coupon_discount,
       CAST(instore_discount AS DOUBLE) AS instore_discount,
       CAST(amount_paid AS DOUBLE) AS amount_paid, CAST(amount_list AS DOUBLE) AS amount_list
FROM tx""")
def p13(t):
    return clean.normalise_transactions(inputs.raw_transactions(t))


@query("p14_random_order", "SELECT c_custkey, c_name FROM customer")
def p14(t):
    return clean.shuffle_rows(t.customer.select("c_custkey", "c_name"), seed=42)


# ---- scalar functions ----------------------------------------------------------------------

@query("f1_casts", f"""
WITH {TRIPS_SQL}
SELECT trip_id, leg, TRY_CAST(month_text AS INTEGER) AS month, TRY_CAST(arr_delay AS INTEGER) AS delay,
       CAST(TRY_CAST(distance AS INTEGER) AS DOUBLE) AS distance, CAST(leg AS VARCHAR) AS leg_text FROM trips""")
def f1(t):
    return inputs.trips(t).selectExpr(
        "trip_id", "leg", "try_cast(month_text as int) as month", "try_cast(arr_delay as int) as delay",
        "cast(try_cast(distance as int) as double) as distance", "string(leg) as leg_text")


@query("f2_strings", """
SELECT p_partkey, sha1(p_name) AS hashed,
       upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS type_name,
       string_split(p_name, ' ')[1] AS first_word, substr(p_brand, 7, 2) AS brand_no,
       length(p_name) AS n_chars, regexp_extract(p_brand, '#([0-9]+)', 1) AS brand_digits FROM part""")
def f2(t):
    return t.part.select(
        "p_partkey", F.sha1("p_name").alias("hashed"), F.initcap("p_type").alias("type_name"),
        F.split("p_name", " ")[0].alias("first_word"), F.substring("p_brand", 7, 2).alias("brand_no"),
        F.length("p_name").cast("bigint").alias("n_chars"),
        F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("brand_digits"))


@query("f3_parse_dates", f"""
SELECT o_orderkey, strftime(o_orderdate, {TS}) AS stamp, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def f3(t):
    text = t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM-dd-yyyy HH:mm:ss").alias("a"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("b"))
    return text.select(
        "o_orderkey", F.to_timestamp("a", "MM-dd-yyyy HH:mm:ss").alias("stamp"),
        F.to_date("b", "yyyyMMdd").alias("day"))


@query("f4_make_date", """
SELECT o_orderkey, strftime(make_date(year(o_orderdate) + 28, month(o_orderdate), least(day(o_orderdate), 28)), '%Y-%m-%d') AS flight_day
FROM orders""")
def f4(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.make_date(F.year(d) + 28, F.month(d), F.least(F.dayofmonth(d), F.lit(28))).alias("flight_day"))


@query("f5_date_format", """
SELECT event_id, strftime(ts, '%Y%m') AS month_id, strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events""")
def f5(t):
    return t.events.select(
        "event_id", F.date_format("ts", "yyyyMM").alias("month_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("f6_date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday FROM orders""")
def f6(t):
    return t.orders.select(
        "o_orderkey", F.year("o_orderdate").alias("year"),
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"),
        F.expr("extract(dayofweek from o_orderdate)").alias("weekday"))


@query("f7_date_arithmetic", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 90, '%Y-%m-%d') AS plus_90,
       strftime(CAST(o_orderdate AS DATE) - 28, '%Y-%m-%d') AS minus_28,
       date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age_days FROM orders""")
def f7(t):
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", F.date_add(d, 90).alias("plus_90"), F.date_sub(d, 28).alias("minus_28"),
        F.datediff(d, F.lit("1995-01-01").cast("date")).cast("bigint").alias("age_days"))


@query("f8_elapsed_minutes", """
SELECT event_id, date_sub('minute', TIMESTAMP '2024-01-01 00:00:00', ts) AS minutes FROM events""")
def f8(t):
    return t.events.select(
        "event_id", F.expr("timestampdiff(MINUTE, timestamp_ntz'2024-01-01 00:00:00', ts)").alias("minutes"))


@query("f9_run_date", "SELECT o_orderkey, '2024-06-30' AS training_date FROM orders")
def f9(t):
    """The run date is a parameter, so that a re-run gives the same table."""
    run_date = "2024-06-30"
    return t.orders.select("o_orderkey", F.lit(run_date).cast("date").alias("training_date"))


@query("f10_math", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_quantity, 0) AS unit_price,
       abs(CAST(l_quantity AS INTEGER) - 25) AS off_centre, round(l_extendedprice, 0) AS whole_price,
       l_discount / nullif(l_tax, 0) AS discount_to_tax FROM lineitem""")
def f10(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        F.abs(F.col("l_quantity").cast("int") - 25).alias("off_centre"),
        F.round("l_extendedprice", 0).alias("whole_price"),
        F.try_divide("l_discount", "l_tax").alias("discount_to_tax"))


@query("f11_conditionals", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'owes' WHEN c_acctbal < 1000 THEN 'low' ELSE 'high' END AS band,
       coalesce(nullif(c_mktsegment, 'MACHINERY'), 'other') AS segment,
       greatest(nullif(c_nationkey, 3), 5) AS nation_or_5 FROM customer""")
def f11(t):
    return t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "owes").when(F.col("c_acctbal") < 1000, "low").otherwise("high").alias("band"),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), F.lit("other")).alias("segment"),
        F.greatest(F.nullif(F.col("c_nationkey"), F.lit(3)), F.lit(5)).alias("nation_or_5"))


@query("f12_arrays", """
SELECT word, count(*) AS n, min(p_partkey) AS first_part
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word""")
def f12(t):
    words = t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))


@query("f13_struct_fields", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def f13(t):
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("nation"))
    return t.customer.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("nation.name").alias("n_name"), F.col("nation.region.name").alias("r_name"))


@query("f14_json_paths", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"}' AS doc
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 10""")
def f14(t):
    parsed = t.events.select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", "k int").alias("p"),
        F.variant_get(F.parse_json("props"), "$.k", "int").alias("k_variant"))
    return parsed.filter("k_variant >= 10").select(
        "event_id", "k_text", F.col("p.k").alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("doc"))


@query("f16_date_between", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'""")
def f16(t):
    """Text that looks like dates is compared as real dates."""
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return text.filter(F.col("day").cast("date").between(
        F.lit("1996-03-01").cast("date"), F.lit("1997-02-28").cast("date")))
