"""Change-handling queries. Key: user, sequence: event id, delete: an error event."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes as ch, layout
from millrace.queries.registry import query
from millrace.scratch import scratch_path

EVENTS_SQL = """
ev AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value,
              CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS band FROM events)"""

SCD1_SQL = """
scd1 AS (SELECT user_id, event_id, event_type, value, band FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev)
  WHERE rn = 1 AND event_type <> 'error')"""

# band is tracked; event_type and value show the last change inside the version
SCD2_SQL = """
seen AS (SELECT *, event_type = 'error' AS del, lag(event_type) OVER w AS was_type, lag(band) OVER w AS was_band
         FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
marked AS (SELECT *, CASE WHEN del OR was_type IS NULL OR was_type = 'error' OR band <> was_band THEN 1 ELSE 0 END AS edge FROM seen),
grouped AS (SELECT *, sum(edge) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM marked),
vers AS (SELECT user_id, grp, min(event_id) AS start_at, arg_max(event_type, event_id) AS event_type,
                arg_max(coalesce(value, -1), event_id) AS value, min(band) AS band, bool_or(del) AS del
         FROM grouped GROUP BY user_id, grp),
ended AS (SELECT *, lead(start_at) OVER (PARTITION BY user_id ORDER BY grp) AS end_at FROM vers),
scd2 AS (SELECT user_id, event_type, nullif(value, -1) AS value, band, start_at AS "__START_AT", end_at AS "__END_AT"
         FROM ended WHERE NOT del)"""


def user_changes(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        "user_id", "event_id", "event_type",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"), (k % 3).alias("band"))


DELETE = "event_type = 'error'"


@query("d1_delete_where", f"""
WITH {EVENTS_SQL} SELECT * FROM ev WHERE (value > 20) IS NOT TRUE""")
def d1(t):
    return ch.delete_where(user_changes(t), "value > 20")


@query("d2_keyed_upsert", """
SELECT c_custkey, CASE WHEN o.last_price IS NULL THEN c_acctbal ELSE o.last_price END AS balance
FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS last_price FROM orders GROUP BY 1) o
  ON c_custkey = o.o_custkey""")
def d2(t):
    target = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"))
    source = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("balance"),
                             F.col("o_orderkey").alias("at"))
    both = ch.upsert(target.withColumn("at", F.lit(-1).cast("bigint")), source, ["c_custkey"], ["at"])
    known = t.customer.select("c_custkey")
    return both.join(known, "c_custkey", "left_semi").drop("at")


@query("d3_as_of", f"""
WITH {EVENTS_SQL}, {SCD2_SQL}
SELECT * FROM scd2 WHERE "__START_AT" <= (SELECT max(event_id) // 2 FROM events)
  AND ("__END_AT" IS NULL OR "__END_AT" > (SELECT max(event_id) // 2 FROM events))""")
def d3(t):
    history = ch.scd2(user_changes(t), ["user_id"], "event_id", DELETE, tracked=["band"])
    middle = t.events.agg(F.floor(F.max("event_id") / 2)).scalar()
    return ch.as_of(history, middle)


@query("d3_versions_and_restore", """
SELECT CAST(v AS INTEGER) AS version, n AS records FROM (
  SELECT 0 AS v, count(*) AS n FROM customer UNION ALL
  SELECT 1, count(*) FROM customer WHERE (c_acctbal < 0) IS NOT TRUE UNION ALL
  SELECT 2, count(*) FROM customer)""")
def d3_versions(t):
    base = scratch_path(t.spark, "versions")
    ch.write_version(t.customer, base, 0)
    ch.write_version(ch.delete_where(ch.read_version(t.spark, base, 0), "c_acctbal < 0"), base, 1)
    ch.restore(t.spark, base, version=0, as_version=2)
    return ch.version_history(t.spark, base)


FEED_SQL = """
a AS (SELECT c_custkey AS id, c_acctbal AS bal, c_mktsegment AS seg FROM customer WHERE c_nationkey <> 3),
b AS (SELECT c_custkey AS id, CASE WHEN c_acctbal < 1000 THEN c_acctbal + 1 ELSE c_acctbal END AS bal,
             nullif(c_mktsegment, 'MACHINERY') AS seg FROM customer WHERE c_nationkey <> 5),
feed AS (
  SELECT b.id, b.bal, b.seg, 'insert' AS "_change_type" FROM b WHERE b.id NOT IN (SELECT id FROM a) UNION ALL
  SELECT a.id, a.bal, a.seg, 'delete' FROM a WHERE a.id NOT IN (SELECT id FROM b) UNION ALL
  SELECT a.id, a.bal, a.seg, 'update_preimage' FROM a JOIN b USING (id) WHERE a.bal IS DISTINCT FROM b.bal OR a.seg IS DISTINCT FROM b.seg UNION ALL
  SELECT b.id, b.bal, b.seg, 'update_postimage' FROM a JOIN b USING (id) WHERE a.bal IS DISTINCT FROM b.bal OR a.seg IS DISTINCT FROM b.seg)"""


def two_states(t):
    c = t.customer
    before = c.filter("c_nationkey <> 3").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    after = c.filter("c_nationkey <> 5").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") < 1000, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("bal"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("seg"))
    return before, after


@query("d4_change_feed", f"""
WITH {FEED_SQL} SELECT *, CAST(7 AS BIGINT) AS "_commit_version" FROM feed""")
def d4(t):
    before, after = two_states(t)
    return ch.change_feed(before, after, ["id"], 7)


@query("d5_apply_feed", f"WITH {FEED_SQL} SELECT * FROM b")
def d5(t):
    """Applying the feed between two states to the first gives the second."""
    before, after = two_states(t)
    return ch.apply_feed(before, ch.change_feed(before, after, ["id"], 7), ["id"])


@query("d5_latest_state", f"WITH {EVENTS_SQL}, {SCD1_SQL} SELECT * FROM scd1")
def d5_scd1(t):
    return ch.scd1(user_changes(t), ["user_id"], ["event_id"], DELETE, on_tie="error")


@query("d5_latest_non_null_state", f"""
WITH {EVENTS_SQL}, gone AS (SELECT user_id, max(event_id) AS at FROM ev WHERE event_type = 'error' GROUP BY 1)
SELECT ev.user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) FILTER (value IS NOT NULL) AS value, arg_max(band, event_id) AS band
FROM ev LEFT JOIN gone USING (user_id) WHERE gone.at IS NULL OR event_id > gone.at GROUP BY 1""")
def d5_non_null(t):
    return ch.scd1(user_changes(t), ["user_id"], ["event_id"], DELETE, ignore_null_updates=True)


@query("d5_validity_intervals", f"WITH {EVENTS_SQL}, {SCD2_SQL} SELECT * FROM scd2")
def d5_scd2(t):
    return ch.scd2(user_changes(t), ["user_id"], "event_id", DELETE, tracked=["band"])


@query("w5_validity_intervals_all_columns", f"""
WITH {EVENTS_SQL},
seen AS (SELECT *, lag(event_type) OVER w AS t0, lag(value) OVER w AS v0, lag(band) OVER w AS b0
         FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
edges AS (SELECT * FROM seen WHERE event_type = 'error' OR t0 IS NULL OR t0 = 'error'
          OR t0 IS DISTINCT FROM event_type OR v0 IS DISTINCT FROM value OR b0 IS DISTINCT FROM band),
ended AS (SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS end_at FROM edges)
SELECT user_id, event_type, value, band, event_id AS "__START_AT", end_at AS "__END_AT" FROM ended WHERE event_type <> 'error'""")
def w5_all(t):
    return ch.scd2(user_changes(t), ["user_id"], "event_id", DELETE)


@query("d6_clustered_layout", """
WITH e AS (SELECT min(o_custkey) AS c0, max(o_custkey) AS c1, min(o_totalprice) AS p0, max(o_totalprice) AS p1 FROM orders),
s AS (SELECT o_orderkey, CAST(floor(CAST(o_custkey - c0 AS DOUBLE) / CAST(c1 - c0 AS DOUBLE) * 255) AS BIGINT) AS x,
             CAST(floor((o_totalprice - p0) / (p1 - p0) * 255) AS BIGINT) AS y FROM orders, e)
SELECT o_orderkey, CAST(""" + " + ".join(
    f"(((x >> {b}) & 1) << {2 * b + 1}) + (((y >> {b}) & 1) << {2 * b})" for b in range(8)) + """ AS BIGINT) AS zone
FROM s""")
def d6(t):
    """Written clustered, read back, and shown with the value the files are ordered by."""
    path = scratch_path(t.spark, "clustered")
    layout.write_clustered(t.orders, ["o_custkey", "o_totalprice"], path, files=8)
    back = t.spark.read.parquet(path)
    return layout.with_zone(back, ["o_custkey", "o_totalprice"]).select("o_orderkey", "zone")
