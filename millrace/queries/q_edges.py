"""Operators at the edges of their input: absent amounts, odd numbers, far places, keys that look like numbers, unknown tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import clean, geo
from millrace.operators import aggregates as agg, changes as ch
from millrace.queries import inputs, q_changes
from millrace.queries.inputs import TRANSACTIONS_SQL
from millrace.queries.q_geo import SIZE, TRIPS_SQL, trips
from millrace.queries.q_streams import event_parts, event_stream, paths
from millrace.queries.registry import query
from millrace.queries.staging import arrive, staged
from millrace.scratch import scratch_path
from millrace.streaming import runs


@query("p12_whole_sample", "SELECT o_orderkey, o_custkey FROM orders")
def p12_whole(t):
    """A fraction of 1 keeps every row."""
    return clean.hash_sample(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 1.0, "123")


@query("p13_absent_amounts", f"""
WITH {TRANSACTIONS_SQL},
holes AS (
  SELECT household_key, basket_id, product_id, units, CASE WHEN product_id % 7 > 0 THEN coupon_disc END AS coupon,
         CASE WHEN product_id % 5 >= 2 THEN coupon_match_disc END AS match, CASE WHEN product_id % 11 > 0 THEN retail_disc END AS retail,
         CASE WHEN product_id % 13 > 0 THEN sales_value END AS sales FROM raw_tx)
SELECT household_key, basket_id, product_id, units,
       CAST(CASE WHEN coalesce(match, 0) = 0 THEN -coalesce(coupon, 0) ELSE 0 END AS DOUBLE) AS campaign_coupon_discount,
       CAST(CASE WHEN coalesce(match, 0) <> 0 THEN -coalesce(coupon, 0) ELSE 0 END AS DOUBLE) AS manuf_coupon_discount,
       CAST(-coalesce(match, 0) AS DOUBLE) AS manuf_coupon_match_discount, CAST(coalesce(match - coupon, 0) AS DOUBLE) AS total_coupon_discount,
       CAST(-coalesce(retail, 0) AS DOUBLE) AS instore_discount, CAST(coalesce(sales, 0) AS DOUBLE) AS amount_paid,
       CAST(coalesce(sales - retail - coupon - match, 0) AS DOUBLE) AS amount_list
FROM holes""")
def p13_absent(t):
    """Each amount is absent on some rows, alone and together with others."""
    raw = inputs.raw_transactions(t)
    p = F.col("product_id")
    for c, gone in (("coupon_disc", p % 7 == 0), ("coupon_match_disc", p % 5 < 2), ("retail_disc", p % 11 == 0), ("sales_value", p % 13 == 0)):
        raw = raw.withColumn(c, F.when(~gone, F.col(c)))
    return clean.normalise_transactions(raw).drop("day", "commodity_desc")


@query("a13_cuts_beyond_numbers", """
WITH v AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'NaN'::DOUBLE WHEN o_orderkey % 5 = 1 THEN 'Infinity'::DOUBLE
                       WHEN o_orderkey % 5 = 2 THEN '-Infinity'::DOUBLE ELSE o_totalprice END AS v FROM orders),
ranked AS (SELECT v, row_number() OVER (ORDER BY v) AS r, count(*) OVER () AS n FROM v),
steps AS (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS step)
SELECT CAST(step AS INTEGER) AS step, v AS cut FROM steps JOIN ranked ON r = (n * step + 9) // 10""")
def a13_beyond(t):
    k = F.col("o_orderkey") % 5
    odd = F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).when(k == 2, F.lit(-float("inf")))
    cuts = agg.exact_cuts(t.orders.select(odd.otherwise(F.col("o_totalprice")).alias("v")), "v", 10)
    each = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(float(v)).alias("cut")) for i, v in enumerate(cuts)])
    return t.spark.range(1).select(F.inline(each))


@query("w5_text_sequence", """
SELECT event_id, event_type, lag(user_id) OVER w AS previous_user, lead(event_id) OVER w AS next_id
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY CAST(event_id AS VARCHAR))""")
def w5_text(t):
    """A text order, with keys cut into slices."""
    slim = t.events.select("event_id", "user_id", "event_type", F.col("event_id").cast("string").alias("seq"))
    most = max(3, t.events.count() // 40)
    return agg.neighbours(slim, ["event_type"], "seq", previous={"previous_user": "user_id"}, following={"next_id": "event_id"},
                          max_rows=most).drop("seq", "user_id")


@query("d4_null_keys", f"""
WITH {q_changes.FEED_SQL}
SELECT CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS id, id AS own, bal, seg, "_change_type", CAST(7 AS BIGINT) AS "_commit_version" FROM feed""")
def d4_null(t):
    """One of two key columns is NULL on some rows; equal rows are no change."""
    before, after = (s.select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), F.col("id").alias("own"), "bal", "seg")
                     for s in q_changes.two_states(t))
    return ch.change_feed(before, after, ["id", "own"], 7)


@query("g4_far_cells", f"""
WITH {TRIPS_SQL},
far AS (SELECT event_id, CAST(floor(px / {SIZE}) AS BIGINT) + event_id % 3 * 4194304 AS ix, CAST(floor(py / {SIZE}) AS BIGINT) - event_id % 3 AS iy FROM trip)
SELECT count(*) AS points, count(DISTINCT (ix, iy)) AS cells FROM far""")
def g4_far(t):
    """Cells far from the origin are as distinct as those near it."""
    third = F.col("event_id") % 3
    x = F.col("pickup_longitude") + third * (4194304 * SIZE)
    y = F.col("pickup_latitude") - third * SIZE
    at = trips(t).select(geo.cell(geo.point(x, y), SIZE).alias("cell"))
    return at.agg(F.count("*").alias("points"), F.count_distinct("cell").alias("cells"))


@query("s25_folder_without_schema", """
SELECT 'customer' AS folder, count(*) AS n, 'bigint' AS key_type FROM customer UNION ALL SELECT 'nation', count(*), 'int' FROM nation""")
def s25_without(t):
    """A folder whose name has no schema is loaded with the inferred one."""
    base = staged(t, "folders-2", lambda p: [getattr(t, n).write.option("header", True).csv(f"{p}/{n}") for n in ("customer", "nation")])
    out = scratch_path(t.spark, "s25b-out")
    names = runs.ingest_folders(t.spark, base, "csv", {"customer": t.customer.schema}, out, scratch_path(t.spark, "s25b-cp"), header=True)
    first = [t.spark.read.parquet(f"{out}/{n}") for n in names]
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("folder"), "n", F.lit(df.dtypes[0][1]).alias("key_type"))
            for n, df in zip(names, first)]
    return rows[0].unionByName(rows[1])


KEYS = ["01", "1", "002", "", "x/y"]


@query("t11_text_keys", """
WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '01' WHEN 1 THEN '1' WHEN 2 THEN '002' WHEN 3 THEN '' WHEN 4 THEN 'x/y' END AS k FROM events)
SELECT coalesce('=' || k, 'NULL') AS branch, count(*) AS n, max(event_id) AS newest FROM e GROUP BY 1""")
def t11_text(t):
    """Keys that look like numbers, an empty one and NULL each have a branch of their own."""
    src, out, cp = paths(t, "t11k")
    k = F.col("event_id") % 6
    key = F.when(k == 0, "01").when(k == 1, "1").when(k == 2, "002").when(k == 3, "").when(k == 4, "x/y")
    arrive(event_parts(t), src, "parquet", lambda: runs.each_batch(
        event_stream(t, src).withColumn("key", key), runs.fan_out(out, "key"), cp))
    total = None
    for value in (*KEYS, None):
        branch = runs.read_branch(t.spark, out, "key", value).agg(F.count("*").alias("n"), F.max("event_id").alias("newest"))
        one = branch.select(F.lit("NULL" if value is None else f"={value}").alias("branch"), "n", "newest")
        total = one if total is None else total.unionByName(one)
    return total


@query("t12_unknown_tables", """
SELECT 'customer' AS source, count(*) AS n FROM customer UNION ALL SELECT '_other', 2 * count(*) FROM nation""")
def t12_unknown(t):
    """Rows of a table without a schema, and of none, come out as the rest."""
    src, _, cp = paths(t, "t12u")
    c = t.customer.select(F.lit("customer").alias("table_name"), F.to_json(F.struct("c_custkey")).alias("data"))
    n = t.nation.select(F.lit("nation").alias("table_name"), F.to_json(F.struct("n_nationkey")).alias("data"))
    c.unionByName(n).unionByName(n.withColumn("table_name", F.lit(None).cast("string"))).write.parquet(src)
    split = runs.split_payload(runs.table_stream(t.spark, src), {"customer": "c_custkey bigint"})
    out = {name: scratch_path(t.spark, f"t12u-{name}") for name in split}
    for name, df in split.items():
        runs.land(df, out[name], f"{cp}/{name}")
    rows = [t.spark.read.parquet(p).agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n") for name, p in out.items()]
    return rows[0].unionByName(rows[1])


@query("t6_late_row_count", """
WITH e AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
s AS (SELECT events.*, CASE WHEN event_id < lo + (hi - lo) / 3 THEN 1 WHEN event_id < lo + (hi - lo) * 2 / 3 THEN 2 ELSE 3 END AS part FROM events, e),
w AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM s WHERE part = 2)
SELECT count(*) AS late FROM s, w WHERE part = 1 AND ts <= date_trunc('millisecond', mark)""")
def t6_count(t):
    """The rows dropped below the watermark, summed over runs."""
    src, out, cp = paths(t, "t6c")
    first, middle, last = event_parts(t, 3)
    late = []
    arrive([middle, first, last], src, "parquet", lambda: late.append(runs.late_rows(runs.land(
        runs.drop_repeats(event_stream(t, src), "ts", "1 hour", ["event_id"]).select("event_id"), out, cp))))
    return t.spark.range(1).select(F.lit(sum(late)).cast("bigint").alias("late"))
