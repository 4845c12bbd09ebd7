"""Streaming, stream-static join and end-to-end job queries over staged files."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F, types as T

from millrace.functions.clean import anonymise_users
from millrace.operators import quality
from millrace.operators.changes import change_feed
from millrace.analytics import inventory
from millrace.analytics.inventory import transaction_documents
from millrace.analytics.segments import register_model
from millrace.plans import airline, feeds, stock, taxi, users
from millrace.queries import inputs, q_changes, q_geo
from millrace.queries.inputs import POS_SQL, TRIPS_SQL, USERS_SQL
from millrace.queries.q_inventory import stock_sql
from millrace.queries.registry import query
from millrace.queries.staging import arrive, file_count, finished, is_large, portions, shares, slices, staged, staged_as
from millrace.scratch import materialise, scratch_path, shuffles_removed
from millrace.sources.files import remove
from millrace.streaming import balances, cdc, histories, once, runs

# ---- stream-static joins -------------------------------------------------------------------

SILVER_SQL = f"""
{TRIPS_SQL},
silver AS (
  SELECT trip_id, leg, TRY_CAST(arr_delay AS INTEGER) AS arr_delay, CAST(distance AS INTEGER) AS distance,
         make_date(CAST(year_text AS INTEGER), CAST(month_text AS INTEGER), CAST(day_text AS INTEGER)) AS date,
         l.name AS airline_name, o.municipality AS origin_city, o.name AS origin_airport_name,
         d.municipality AS dest_city, d.name AS dest_airport_name
  FROM trips LEFT JOIN airports o ON origin = o.iata_code LEFT JOIN airports d ON dest = d.iata_code
  LEFT JOIN airlines l ON carrier = l.iata
  WHERE TRY_CAST(month_text AS INTEGER) BETWEEN 1 AND 12 AND TRY_CAST(day_text AS INTEGER) BETWEEN 1 AND 31
        AND TRY_CAST(weekday_text AS INTEGER) BETWEEN 1 AND 7)"""


def dimensions(t):
    """Airports and airlines, written once: no micro-batch builds them again, and the planner knows their size."""
    return (materialise(airline.airport_table(inputs.airports(t)), "airports"),
            materialise(airline.airline_table(inputs.airline_rows(t)), "airlines"))


def trip_files(t):
    """Staged trips; of large tables packed and joined share by share, so that the disk holds the shuffled rows of one share only."""
    def write(path):
        with shuffles_removed(t.spark):
            origins = materialise(inputs.trip_origins(t), "trip-origins")
            for line in shares(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]):
                inputs.trips(t, line, origins).write.mode("append").options(compression="gzip", maxRecordsPerFile=500_000).json(path)

    return staged(t, "trips-json", write) if is_large(t.lineitem) else staged_as(t, "trips", inputs.trips(t), "json")


def trip_stream(t):
    """The staged trips in two arrivals, however many files they are."""
    path = trip_files(t)
    half = -(-file_count(t.spark.read.text(path)) // 2)
    return runs.new_files(t.spark, path, "json", inputs.trips(t).schema, max_files=half)


@query("j1_stream_static_left", f"""
WITH {SILVER_SQL} SELECT trip_id, leg, arr_delay, distance, strftime(date, '%Y-%m-%d') AS date, airline_name,
       origin_city, origin_airport_name, dest_city, dest_airport_name FROM silver""")
def j1(t):
    """A star of three dimension joins on a stream, one dimension in two roles."""
    out, cp = scratch_path(t.spark, "j1-out"), scratch_path(t.spark, "j1-cp")
    stream = quality.drop_failing(trip_stream(t), airline.TRIP_RULES)
    runs.land(airline.enrich_trips(stream, *dimensions(t)), out, cp)
    return t.spark.read.parquet(out).drop("origin_coordinates", "dest_coordinates")


def user_files(t):
    return staged_as(t, "users", inputs.users(t), "json")


def spend_table(t):
    """Written once, so that no micro-batch groups the orders again."""
    return finished(t, "spend-table", lambda: materialise(inputs.spend(t), "spend"))


def spend_files(t):
    return staged_as(t, "spend", inputs.spend(t), "csv", header=True)


TS = "'%Y-%m-%d %H:%M:%S.%f'"


@query("j2_left_join_using_id", f"""
WITH {USERS_SQL} SELECT id, email, firstname, age, annual_income, spending_core FROM silver LEFT JOIN spend USING (id)""")
def j2(t):
    out, cp = scratch_path(t.spark, "j2-out"), scratch_path(t.spark, "j2-cp")
    stream = anonymise_users(runs.new_files(t.spark, user_files(t), "json", inputs.users(t).schema))
    runs.land(stream.join(spend_table(t), ["id"], "left"), out, cp)
    return t.spark.read.parquet(out).select("id", "email", "firstname", "age", "annual_income", "spending_core")


@query("j3_inner_join_shared_key", f"""
WITH {USERS_SQL} SELECT id, firstname, age, annual_income, spending_core FROM silver JOIN spend USING (id)""")
def j3(t):
    out, cp = scratch_path(t.spark, "j3-out"), scratch_path(t.spark, "j3-cp")
    stream = anonymise_users(runs.new_files(t.spark, user_files(t), "json", inputs.users(t).schema))
    runs.land(stream.join(spend_table(t), "id"), out, cp)
    return t.spark.read.parquet(out).select("id", "firstname", "age", "annual_income", "spending_core")


# ---- triggers, hops, aggregates ------------------------------------------------------------

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def event_parts(t, steps=2):
    return slices(t.events, "event_id", steps)


def event_stream(t, src):
    return runs.new_files(t.spark, src, "parquet", t.events.schema)


def paths(t, name):
    return [scratch_path(t.spark, f"{name}-{part}") for part in ("in", "out", "cp")]


@query("t1_incremental_batches", "SELECT event_id, user_id, event_type, value FROM events")
def t1(t):
    src, out, cp = paths(t, "t1")
    arrive(event_parts(t, 3), src, "parquet", lambda: runs.land(event_stream(t, src).select(*EVENT_COLUMNS), out, cp))
    return t.spark.read.parquet(out)


@query("t2_periodic_refresh", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def t2(t):
    """A continuously running query with a trigger interval, stopped once it has caught up."""
    src, out, cp = paths(t, "t2")
    t.events.write.parquet(src)
    running = runs.each_batch(event_stream(t, src).select("event_id", "event_type"), runs.batch_log(out), cp, every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("t3_chained_hops", """
SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events WHERE value > 5 GROUP BY 1""")
def t3(t):
    src, bronze, cp = paths(t, "t3")
    silver, gold = scratch_path(t.spark, "t3-silver"), scratch_path(t.spark, "t3-gold")

    def run():
        runs.land(event_stream(t, src), bronze, f"{cp}/bronze")
        kept = quality.drop_failing(runs.table_stream(t.spark, bronze), {"worth_it": "value > 5"})
        runs.land(kept.select(*EVENT_COLUMNS), silver, f"{cp}/silver")
        per_user = runs.table_stream(t.spark, silver).groupBy("user_id").agg(
            F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
        runs.each_batch(per_user, runs.batch_log(gold), f"{cp}/gold", "update")

    arrive(event_parts(t), src, "parquet", run)
    return runs.newest_rows(t.spark, gold, ["user_id"])


DAILY_SQL = f"""
WITH {SILVER_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, airline_name, count(*) AS no_flights,
       CAST(sum(distance) AS BIGINT) AS tot_distance FROM silver GROUP BY ALL"""


@query("t4_streaming_aggregate", """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def t4(t):
    """No watermark: changed groups are emitted per batch and the newest row per group is current."""
    src, out, cp = paths(t, "t4")

    def run():
        counted = event_stream(t, src).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
        runs.each_batch(counted, runs.batch_log(out), cp, "update")

    arrive(event_parts(t), src, "parquet", run)
    return runs.newest_rows(t.spark, out, ["day", "event_type"])


@query("a16_aggregate_by_date_and_key", DAILY_SQL)
def a16(t):
    out, cp = scratch_path(t.spark, "a16-out"), scratch_path(t.spark, "a16-cp")
    stream = quality.drop_failing(trip_stream(t), airline.TRIP_RULES)
    trips = airline.enrich_trips(stream, *dimensions(t))
    runs.each_batch(airline.daily_features(trips), runs.batch_log(out), cp, "update")
    return runs.newest_rows(t.spark, out, ["date", "airline_name"])


@query("t5_watermark_and_keyed_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def t5(t):
    """Purchases are delivered twice; each event is kept once."""
    src, out, cp = paths(t, "t5")
    doubled = [p.unionByName(p.filter("event_type = 'purchase'")) for p in event_parts(t)]
    arrive(doubled, src, "parquet", lambda: runs.land(
        runs.drop_repeats(event_stream(t, src), "ts", "1 hour", ["event_id", "user_id"]).select(*EVENT_COLUMNS), out, cp))
    return t.spark.read.parquet(out)


@query("t5_keyed_dedup_published", "SELECT event_id, user_id, event_type, value FROM events")
def t5_published(t):
    src, out, cp = paths(t, "t5p")
    doubled = [p.unionByName(p.filter("event_type = 'purchase'")) for p in event_parts(t)]
    arrive(doubled, src, "parquet", lambda: runs.land(runs.drop_repeats(
        event_stream(t, src), "ts", "1 hour", ["event_id", "user_id"], bounded=False).select(*EVENT_COLUMNS), out, cp))
    return t.spark.read.parquet(out)


@query("t6_late_rows_dropped", """
WITH e AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
s AS (SELECT events.*, CASE WHEN event_id < lo + (hi - lo) / 3 THEN 1 WHEN event_id < lo + (hi - lo) * 2 / 3 THEN 2 ELSE 3 END AS part FROM events, e),
w AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM s WHERE part = 2)
SELECT event_id, user_id, event_type, value FROM s, w WHERE part >= 2 OR ts > date_trunc('millisecond', mark)""")
def t6(t):
    """The middle third arrives first; of the first third only rows within the delay are kept."""
    src, out, cp = paths(t, "t6")
    first, middle, last = event_parts(t, 3)
    arrive([middle, first, last], src, "parquet", lambda: runs.land(
        runs.drop_repeats(event_stream(t, src), "ts", "1 hour", ["event_id"]).select(*EVENT_COLUMNS), out, cp))
    return t.spark.read.parquet(out)


@query("t5_each_key_once", "SELECT event_id, user_id, event_type, value FROM events")
def t5_once(t):
    """The newest third comes first, then the oldest with purchases of all thirds again, then the middle one: no row is lost or doubled."""
    src, out, cp = paths(t, "t5o")
    index = scratch_path(t.spark, "t5o-index")
    old, middle, new = event_parts(t, 3)
    bought = t.events.filter("event_type = 'purchase'")
    arrive([new, old.unionByName(bought), middle.unionByName(middle)], src, "parquet", lambda: runs.each_batch(
        event_stream(t, src), once.keep_first(out, index, ["event_id", "user_id"], "ts"), cp))
    return once.kept_rows(t.spark, out).select(*EVENT_COLUMNS)


@query("t7_enrichment_after_dedup", """
SELECT event_id, user_id, event_type, n_name FROM events JOIN nation ON user_id % 25 = n_nationkey""")
def t7(t):
    src, out, cp = paths(t, "t7")
    doubled = [p.unionByName(p) for p in event_parts(t)]
    nations = t.nation.select(F.col("n_nationkey").cast("bigint").alias("place"), "n_name")

    def run():
        once = runs.drop_repeats(event_stream(t, src), "ts", "1 hour", ["event_id"])
        runs.land(once.withColumn("place", F.col("user_id") % 25).join(nations, "place")
                  .select("event_id", "user_id", "event_type", "n_name"), out, cp)

    arrive(doubled, src, "parquet", run)
    return t.spark.read.parquet(out)


# ---- stock by what changed -----------------------------------------------------------------

def kept_balances(t):
    return finished(t, "balances", lambda: _kept_balances(t))


def _kept_balances(t):
    """Counts and movements in five arrivals each, dealt by order line, so that many come late."""
    spark, keys = t.spark, ["item_id", "store_id"]
    counted, moved, out, cp = (scratch_path(spark, f"balances-{n}") for n in ("counts", "moves", "out", "cp"))
    line = t.lineitem.withColumn("part_", F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(5)))
    counts = inputs.snapshots(SimpleNamespace(lineitem=line)).schema
    moves = inputs.changes(SimpleNamespace(lineitem=line)).schema
    for k in range(5):
        some = SimpleNamespace(lineitem=line.filter(F.col("part_") == k))
        inputs.snapshots(some).write.mode("append").parquet(counted)
        inputs.changes(some).write.mode("append").parquet(moved)
        both = balances.counts_and_movements(runs.new_files(spark, counted, "parquet", counts), runs.new_files(spark, moved, "parquet", moves), keys, "change_type")
        balances.follow(both, keys, out, cp)
    return balances.current_balances(spark, out, keys)


@query("i1_incremental_stock", stock_sql(POS_SQL))
def i1_incremental(t):
    return inventory.stock_of_balances(inputs.items(t), inputs.stores(t), kept_balances(t))


@query("i1_incremental_stock_each_store", stock_sql(POS_SQL, every_store=True))
def i1_incremental_each(t):
    return inventory.stock_of_balances(inputs.items(t), inputs.stores(t), kept_balances(t), mode="fixed")


# ---- change data ---------------------------------------------------------------------------

def change_stream(t, src):
    k = F.get_json_object("props", "$.k").cast("int")
    return event_stream(t, src).select(
        "user_id", "event_id", "event_type",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"), (k % 3).alias("band"))


@query("t8_latest_state_upsert", f"""
WITH {q_changes.EVENTS_SQL} SELECT user_id, event_id, value, band FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev) WHERE rn = 1""")
def t8(t):
    """Newer events arrive first; older ones must not overwrite them. A subset of columns is stored."""
    src, out, cp = paths(t, "t8")
    older, newer = event_parts(t)
    arrive([newer, older], src, "parquet", lambda: runs.each_batch(
        change_stream(t, src), cdc.scd1_batches(out, ["user_id"], ["event_id"], columns=["value", "band"]), cp))
    return cdc.scd1_table(t.spark, out, ["user_id"], ["event_id"])


@query("t9_version_history", f"WITH {q_changes.EVENTS_SQL}, {q_changes.SCD2_SQL} SELECT * FROM scd2")
def t9(t):
    """Out of order on purpose: the older half arrives after the newer one."""
    src, out, cp = paths(t, "t9")
    log = scratch_path(t.spark, "t9-log")
    older, newer = event_parts(t)
    arrive([newer, older], src, "parquet", lambda: runs.each_batch(
        change_stream(t, src),
        cdc.scd2_batches(log, out, ["user_id"], "event_id", q_changes.DELETE, tracked=["band"]), cp))
    return cdc.scd2_table(t.spark, out, ["user_id"])


@query("t9_history_in_state", f"WITH {q_changes.EVENTS_SQL}, {q_changes.SCD2_SQL} SELECT * FROM scd2")
def t9_state(t):
    """Ten arrivals, the newest first; a short tail sends long keys with late changes to the log."""
    return state_history(t, tail=20).table()


@query("t9_history_of_batches", f"""
WITH {q_changes.EVENTS_SQL}, {q_changes.SCD2_SQL},
own AS (SELECT user_id, count(*) AS n FROM scd2 GROUP BY 1) SELECT count(*) AS users, CAST(sum(n) AS BIGINT) AS versions, 10 AS batches FROM own""")
def t9_batches(t):
    """Users and versions of the history, and how many micro-batches emitted some or marked users as late."""
    job = state_history(t, tail=20)
    own = job.table().groupBy("user_id").agg(F.count("*").alias("n"))
    batches = t.spark.read.parquet(f"{job.base}/emitted").select("batch_id").distinct().count()
    return own.agg(F.count("*").alias("users"), F.sum("n").alias("versions")).withColumn("batches", F.lit(batches))


def state_history(t, tail):
    def run():
        src = scratch_path(t.spark, "t9s-in")
        job = histories.History(t.spark, scratch_path(t.spark, "t9s"), ["user_id"], "event_id", q_changes.DELETE, tracked=["band"], tail=tail)
        arrive(event_parts(t, 10)[::-1], src, "parquet", lambda: job.follow(change_stream(t, src)))
        return job
    return finished(t, f"state-history-{tail}", run)


@query("t10_deletes_in_change_data", f"WITH {q_changes.EVENTS_SQL}, {q_changes.SCD1_SQL} SELECT * FROM scd1")
def t10(t):
    src, out, cp = paths(t, "t10")
    older, newer = event_parts(t)
    arrive([newer, older], src, "parquet", lambda: runs.each_batch(
        change_stream(t, src), cdc.scd1_batches(out, ["user_id"], ["event_id"], q_changes.DELETE), cp))
    folded = scratch_path(t.spark, "t10-folded")
    cdc.compact_scd1(t.spark, out, ["user_id"], ["event_id"], folded)
    return cdc.scd1_table(t.spark, folded, ["user_id"], ["event_id"])


@query("t11_fan_out", """
SELECT 'purchase' AS branch, count(*) AS n, max(event_id) AS newest FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'all', count(*), max(event_id) FROM events""")
def t11(t):
    src, out, cp = paths(t, "t11")
    arrive(event_parts(t), src, "parquet", lambda: runs.each_batch(event_stream(t, src), runs.fan_out(out, "event_type"), cp))
    one = runs.read_branch(t.spark, out, "event_type", "purchase")
    everything = t.spark.read.parquet(out)
    cols = [F.count("*").alias("n"), F.max("event_id").alias("newest")]
    return one.agg(*cols).select(F.lit("purchase").alias("branch"), "n", "newest").unionByName(
        everything.agg(*cols).select(F.lit("all").alias("branch"), "n", "newest"))


@query("t12_payload_split", """
SELECT c_custkey AS id, c_acctbal AS amount, 'customer' AS source FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def t12(t):
    """Two tables travel in one stream as (metadata, table_name, data) and are split and parsed."""
    src, _, cp = paths(t, "t12")
    c = t.customer.select(F.lit("m").alias("metadata"), F.lit("customer").alias("table_name"),
                          F.to_json(F.struct("c_custkey", "c_acctbal")).alias("data"))
    s = t.supplier.select(F.lit("m").alias("metadata"), F.lit("supplier").alias("table_name"),
                          F.to_json(F.struct("s_suppkey", "s_acctbal")).alias("data"))
    c.unionByName(s).write.parquet(src)
    stream = runs.table_stream(t.spark, src)
    split = runs.split_payload(stream, {"customer": "c_custkey bigint, c_acctbal double",
                                        "supplier": "s_suppkey bigint, s_acctbal double"})
    out = {n: scratch_path(t.spark, f"t12-{n}") for n in split}
    started = [runs.land(df, out[n], f"{cp}/{n}", wait=False) for n, df in split.items()]
    for q in started:
        q.awaitTermination()
    rows = t.spark.read.parquet(out["customer"]).select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.lit("customer").alias("source"))
    return rows.unionByName(t.spark.read.parquet(out["supplier"]).select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"), F.lit("supplier").alias("source")))


@query("t13_history_and_latest", """
SELECT 'history' AS sink, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
UNION ALL SELECT 'latest', count(*), CAST(sum(newest) AS BIGINT) FROM (SELECT max(event_id) AS newest FROM events GROUP BY user_id)""")
def t13(t):
    src, out, cp = paths(t, "t13")
    latest = scratch_path(t.spark, "t13-latest")
    arrive(event_parts(t), src, "parquet", lambda: runs.each_batch(
        event_stream(t, src).select(*EVENT_COLUMNS), runs.history_and_latest(out, latest, ["user_id"], ["event_id"]), cp))
    cols = [F.count("*").alias("n"), F.sum("event_id").alias("ids")]
    current = runs.newest_rows(t.spark, latest, ["user_id"])
    return t.spark.read.parquet(out).agg(*cols).select(F.lit("history").alias("sink"), "n", "ids").unionByName(
        current.agg(*cols).select(F.lit("latest").alias("sink"), "n", "ids"))


# ---- inference -----------------------------------------------------------------------------

CENTRES = [[25.0, 2000.0, 5.0], [40.0, 5000.0, 10.0], [55.0, 8000.0, 15.0]]  # a fitted model's parameters


def _distance(c):
    return f"(age - {c[0]}) * (age - {c[0]}) + (annual_income - {c[1]}) * (annual_income - {c[1]}) + (spending_core - {c[2]}) * (spending_core - {c[2]})"


SEGMENT_SQL = f"""CASE WHEN {_distance(CENTRES[0])} <= least({_distance(CENTRES[1])}, {_distance(CENTRES[2])}) THEN 0
  WHEN {_distance(CENTRES[1])} <= {_distance(CENTRES[2])} THEN 1 ELSE 2 END"""
SCORED_SQL = f"""
scored AS (SELECT id, email, firstname, strftime(creation_date, {TS}) AS creation_date, age, annual_income, spending_core,
                  CAST({SEGMENT_SQL} AS INTEGER) AS segment
           FROM silver LEFT JOIN spend USING (id)
           WHERE age IS NOT NULL AND annual_income IS NOT NULL AND spending_core IS NOT NULL)"""


@query("t14_streaming_inference", f"WITH {USERS_SQL}, {SCORED_SQL} SELECT id, segment FROM scored")
def t14(t):
    out, cp = scratch_path(t.spark, "t14-out"), scratch_path(t.spark, "t14-cp")
    stream = runs.new_files(t.spark, user_files(t), "json", inputs.users(t).schema)
    gold = users.user_features(stream, spend_table(t))
    runs.land(users.score_users(gold, CENTRES).select("id", "segment"), out, cp)
    return t.spark.read.parquet(out)


@query("x1_model_as_sql_function", f"WITH {USERS_SQL}, {SCORED_SQL} SELECT id, segment FROM scored")
def x1(t):
    register_model(t.spark, "predict_segment", CENTRES)
    users.user_features(inputs.users(t), inputs.spend(t)).createOrReplaceTempView("user_features")
    return t.spark.sql("""select id, predict_segment(cast(age as double), annual_income, spending_core) as segment
                          from user_features""")


@query("x4_cluster_names", f"""
WITH {USERS_SQL}, {SCORED_SQL} SELECT id, CASE segment WHEN 0 THEN 'starter' WHEN 1 THEN 'regular' ELSE 'big spender' END AS segment_name FROM scored""")
def x4(t):
    from millrace.functions.clean import relabel
    scored = users.score_users(users.user_features(inputs.users(t), inputs.spend(t)), CENTRES)
    return scored.select("id", relabel("segment", {0: "starter", 1: "regular", 2: "big spender"}).alias("segment_name"))


@query("i5_customer_features", f"""
WITH {USERS_SQL}, {SCORED_SQL} SELECT id, email, firstname, age, annual_income, spending_core FROM scored""")
def i5(t):
    gold = users.user_features(anonymise_users(inputs.users(t)), inputs.spend(t))
    return gold.select("id", "email", "firstname", "age", "annual_income", "spending_core")


# ---- end-to-end jobs -----------------------------------------------------------------------

def airline_job(t):
    return finished(t, "airline", lambda: _airline_job(t))


def _airline_job(t):
    src = scratch_path(t.spark, "airline-in")
    job = airline.Airline(t.spark, src, inputs.airports(t), inputs.airline_rows(t), inputs.trips(t).schema)
    trips = t.spark.read.parquet(staged_as(t, "trips", inputs.trips(t), "parquet"))
    whole = trips.withColumn("_y", F.col("year_text").cast("int"))
    # lines: some with a field that no schema knows, some cut off
    row = F.to_json(F.struct(*inputs.trips(t).columns))
    more = F.concat(F.expr("substring(row, 1, length(row) - 1)"), F.lit(',"note":"x"}'))
    lines = lambda p: p.select("leg", row.alias("row")).select(F.explode(F.when(F.col("leg") == 6, F.array(more)).when(
        F.col("leg") == 7, F.array("row", F.substring("row", 1, 20))).otherwise(F.array("row"))).alias("value"))
    arrive([lines(p.drop("_y")) for p in slices(whole, "_y", 2)], src, "text", job.run)
    return job


DELAY_SQL = f"""
{SILVER_SQL},
delay AS (SELECT airline_name, origin_city, dest_city, date, arr_delay > 0 AS is_arr_delayed, arr_delay FROM silver),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY airline_name, origin_city, dest_city, date
          ORDER BY is_arr_delayed DESC NULLS LAST, arr_delay DESC NULLS LAST) AS rn FROM delay) WHERE rn = 1)"""


@query("l1_airline_daily", DAILY_SQL)
def l1(t):
    return airline_job(t).daily_table()


RULES_SQL = f"""
{TRIPS_SQL},
r AS (SELECT TRY_CAST(month_text AS INTEGER) BETWEEN 1 AND 12 AS m, TRY_CAST(day_text AS INTEGER) BETWEEN 1 AND 31 AS d,
             TRY_CAST(weekday_text AS INTEGER) BETWEEN 1 AND 7 AS w FROM trips),
line AS (SELECT true AS whole, leg <> 6 AS plain FROM trips UNION ALL SELECT false, false FROM trips WHERE leg = 7),
counts AS (
  SELECT 'trips' AS dataset, name, count(*) FILTER (passed) AS passed_records, count(*) FILTER (passed IS NOT TRUE) AS failed_records,
         count(*) FILTER ((m AND d AND w) IS NOT TRUE) AS dropped_records, count(*) FILTER (m AND d AND w) AS output_records
  FROM (SELECT *, unnest(['valid_month', 'valid_day', 'valid_weekday']) AS name, unnest([m, d, w]) AS passed FROM r) GROUP BY name
  UNION ALL SELECT 'trips_raw', name, count(*) FILTER (passed), count(*) FILTER (NOT passed), count(*) FILTER (NOT whole), count(*) FILTER (whole)
  FROM (SELECT *, unnest(['readable', 'nothing_rescued']) AS name, unnest([whole, plain]) AS passed FROM line) GROUP BY name)"""


@query("l1_rule_events", f"""
WITH {RULES_SQL} SELECT dataset, name, passed_records, failed_records, dropped_records, output_records, 2 AS batches FROM counts""")
def l1_events(t):
    """The same counts through the progress records of the job, one per dataset and batch."""
    rows = quality.log_metrics(airline_job(t).events())
    sums = [F.sum(c).alias(c) for c in ("passed_records", "failed_records", "dropped_records", "output_records")]
    return rows.groupBy("dataset", "name").agg(*sums, F.count("*").cast("int").alias("batches"))


@query("l1_rule_metrics", f"WITH {RULES_SQL} SELECT * FROM counts")
def l1_metrics(t):
    return airline_job(t).metrics()


@query("i4_latest_delays", f"""
WITH {DELAY_SQL} SELECT airline_name, origin_city, dest_city, strftime(date, '%Y-%m-%d') AS date, is_arr_delayed, arr_delay FROM (
  SELECT *, row_number() OVER (PARTITION BY airline_name, origin_city, dest_city ORDER BY date DESC) AS r2 FROM one) WHERE r2 = 1""")
def i4(t):
    return airline_job(t).latest_delays()


@query("l1_airline_delay_history", f"""
WITH {DELAY_SQL},
seen AS (SELECT *, lag(is_arr_delayed) OVER w AS was, row_number() OVER w AS r2 FROM one
         WINDOW w AS (PARTITION BY airline_name, origin_city, dest_city ORDER BY date)),
edges AS (SELECT *, lead(date) OVER (PARTITION BY airline_name, origin_city, dest_city ORDER BY date) AS end_at
          FROM seen WHERE r2 = 1 OR was IS DISTINCT FROM is_arr_delayed)
SELECT airline_name, origin_city, dest_city, is_arr_delayed, strftime(date, '%Y-%m-%d') AS "__START_AT", strftime(end_at, '%Y-%m-%d') AS "__END_AT" FROM edges""")
def l1_history(t):
    return airline_job(t).delay_history().drop("arr_delay")


@query("l2_users_scored", f"""
WITH {USERS_SQL}, {SCORED_SQL} SELECT id, email, firstname, creation_date, age, annual_income, spending_core, segment FROM scored""")
def l2(t):
    gold = users_job(t).gold()
    return gold.select("id", "email", "firstname", "creation_date", "age", "annual_income", "spending_core", "segment")


def users_job(t):
    def run():
        spend_schema = "id bigint, age int, annual_income double, spending_core double"
        job = users.Users(t.spark, user_files(t), inputs.users(t).schema, spend_files(t), T.StructType.fromDDL(spend_schema), CENTRES)
        job.run()
        return job
    return finished(t, "users", run)


@query("l2_rule_metrics", f"""
WITH {USERS_SQL},
g AS (SELECT age IS NOT NULL AS a, annual_income IS NOT NULL AS i, spending_core IS NOT NULL AS s FROM silver LEFT JOIN spend USING (id)),
each AS (SELECT *, unnest(['valid_age', 'valid_annual_income', 'valid_spending_core']) AS name, unnest([a, i, s]) AS passed FROM g)
SELECT 'users' AS dataset, name, count(*) FILTER (passed) AS passed_records, count(*) FILTER (NOT passed) AS failed_records,
       count(*) FILTER (NOT (a AND i AND s)) AS dropped_records, count(*) FILTER (a AND i AND s) AS output_records FROM each GROUP BY name
UNION ALL SELECT 'users_raw', 'nothing_rescued', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), count(*) FROM users
UNION ALL SELECT 'users_raw', 'readable', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), count(*) FROM users
UNION ALL SELECT 'users_silver', 'valid_id', count(id), CAST(count(*) - count(id) AS BIGINT), CAST(0 AS BIGINT), count(*) FROM users
UNION ALL SELECT 'spend', 'nothing_rescued', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), count(*) FROM spend""")
def l2_metrics(t):
    return users_job(t).metrics()


# identical documents are one document
L3_SQL = stock_sql(POS_SQL.replace("FROM lineitem WHERE l_returnflag <> 'A')", """FROM (
    SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem) WHERE l_returnflag <> 'A')"""))


def stock_job(t):
    """Dimension, count and document files to current stock, in two unordered runs with repeated documents."""
    text = lambda n, df: staged_as(t, f"pos-{n}", df, "csv", header=True)
    types = t.lineitem.select(
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("change_type_id"),
        F.when(F.col("l_linestatus") == "O", "bopis").otherwise("sale").alias("change_type")).distinct()
    parts_of_id = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
    rows = t.lineitem.filter("l_returnflag <> 'A'").select(
        F.concat(F.lit("{"), F.concat_ws("-", *[F.col(c).cast("string") for c in parts_of_id]), F.lit("}")).alias("trans_id"),
        F.col("l_partkey").alias("item_id"), (F.col("l_suppkey") % 5).cast("int").alias("store_id"),
        F.col("l_shipdate").cast("timestamp").alias("date_time"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("int").alias("quantity"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).cast("bigint").alias("change_type_id"))

    written = scratch_path(t.spark, "pos-documents")
    with shuffles_removed(t.spark):
        transaction_documents(rows, tasks=portions(t.lineitem, width=2)).drop("part").write.option("compression", "zstd").parquet(written)
    documents = t.spark.read.parquet(written).withColumn("_at", F.unix_micros("date_time"))
    older, newer = [p.drop("_at") for p in slices(documents, "_at", 2)]
    counts = inputs.snapshots(t).withColumn("_odd", F.col("item_id") % 2)
    first, second = [p.drop("_odd") for p in slices(counts, "_odd", 2)]
    counted, arrived = scratch_path(t.spark, "pos-snapshots"), scratch_path(t.spark, "pos-arrived")
    job = stock.Stock(t.spark, text("items", inputs.items(t)), text("stores", inputs.stores(t)), text("types", types), counted, arrived)
    # the newer half comes first; the older one follows, and every document of the newer one again
    for some_counts, some_documents in ((second, newer), (first, older.unionByName(newer))):
        some_counts.write.mode("append").options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", compression="gzip", maxRecordsPerFile=500_000).csv(counted)
        some_documents.write.mode("append").options(compression="gzip", maxRecordsPerFile=500_000).json(arrived)
        if some_documents is not newer:  # all have arrived
            remove(t.spark, written)
        job.run()
    return job


@query("l3_inventory", L3_SQL)
def l3(t):
    return finished(t, "stock", lambda: stock_job(t)).current()


@query("l3_stock_metrics", f"""
SELECT 'current_stock' AS dataset, 'positive_stock' AS name, count(*) FILTER (current_inventory > 0) AS passed_records,
       count(*) FILTER ((current_inventory > 0) IS NOT TRUE) AS failed_records, CAST(0 AS BIGINT) AS dropped_records, count(*) AS output_records
FROM ({L3_SQL})""")
def l3_metrics(t):
    return finished(t, "stock", lambda: stock_job(t)).metrics()


@query("l3_arrivals", f"""
WITH {POS_SQL},
line AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate FROM lineitem WHERE l_returnflag <> 'A'),
ends AS (SELECT epoch_us(min(l_shipdate)) AS lo, epoch_us(max(l_shipdate)) AS hi FROM line),
half AS (SELECT epoch_us(l_shipdate) < lo + (hi - lo) / 2 AS old, epoch_us(l_shipdate) AS t, hi FROM line, ends)
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) FILTER (NOT old) AS arrived, count(*) FILTER (NOT old) AS kept, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS below_watermark FROM half
UNION ALL SELECT 1, count(*), count(*) FILTER (old), count(*) FILTER (NOT old), count(*) FILTER (t < hi - 3600000000) FROM half""")
def l3_arrivals(t):
    """Nothing is lost below the watermark, and no repeat is kept."""
    return finished(t, "stock", lambda: stock_job(t)).arrivals().drop("newest")


@query("l4_taxi_zone_months", f"WITH {q_geo.BETWEEN_SQL} SELECT pickup_zone, month_id, {q_geo.TOTALS_SQL} FROM joined GROUP BY ALL")
def l4(t):
    from millrace.queries.q_sources import zone_files
    trips = staged_as(t, "taxi-trips", q_geo.trips(t), "parquet")
    return taxi.run_taxi(t.spark, zone_files(t), trips, q_geo.SIZE, vendor=q_geo.VENDOR)["zone_month"]


@query("l5_change_feed_history", f"""
WITH {q_changes.FEED_SQL},
changed AS (SELECT id FROM a WHERE id NOT IN (SELECT id FROM b) UNION ALL
            SELECT a.id FROM a JOIN b USING (id) WHERE a.bal IS DISTINCT FROM b.bal OR a.seg IS DISTINCT FROM b.seg)
SELECT id, bal, seg, CAST(0 AS BIGINT) AS "__START_AT",
       CAST(CASE WHEN id IN (SELECT id FROM changed) THEN 1 END AS BIGINT) AS "__END_AT" FROM a
UNION ALL SELECT id, bal, seg, CAST(1 AS BIGINT), CAST(NULL AS BIGINT) FROM b WHERE id NOT IN (SELECT id FROM a) OR id IN (SELECT id FROM changed)""")
def l5(t):
    """A table loaded once and changed once, followed through its change feed."""
    return _feed_job(t).history()


@query("l5_change_feed_latest", f"WITH {q_changes.FEED_SQL} SELECT * FROM b")
def l5_latest(t):
    return _feed_job(t).latest()


def _feed_job(t):
    return finished(t, "feed", lambda: _run_feed(t))


def _run_feed(t):
    before, after = q_changes.two_states(t)
    src = scratch_path(t.spark, "feed-in")
    job = feeds.FeedTargets(t.spark, src, ["id"], tracked=["bal", "seg"])
    arrive([change_feed(before.filter("false"), before, ["id"], 0), change_feed(before, after, ["id"], 1)],
           src, "parquet", job.run)
    return job
