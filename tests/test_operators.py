"""Operators on small frames, including the paths that only hot keys take."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from millrace.analytics import inventory, propensity as pro
from millrace.functions import clean, geo
from millrace.operators import aggregates as agg, changes as ch, layout, quality, spatial
from millrace.operators.tables import earliest_by, grid, grid_blocks, hot_keys, keyed_join, latest_by, salted_join
from millrace.queries import inputs, q_changes
from millrace.scratch import scratch_path
from millrace.sources import files, sinks
from millrace.streaming import cdc, runs


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; NULL is a key too."""
    data = [(None if k == 3 else k, i, i % 5) for i in range(900) for k in [0 if i % 3 else i % 7]]
    return spark.createDataFrame(data, "k int, seq long, v int")


def test_neighbours_slices_agree_with_a_window(skewed):
    made = {"previous": {"before": "v"}, "following": {"after": "seq"}}
    plain = agg.neighbours(skewed, ["k"], "seq", **made)
    sliced = agg.neighbours(skewed, ["k"], "seq", max_rows=20, **made)
    assert rows(plain) == rows(sliced)


def test_salted_join_agrees_with_a_plain_join(skewed):
    small = skewed.groupBy("k").agg(F.max("seq").alias("top"))
    hot = hot_keys(skewed, ["k"], 50)
    assert hot is not None
    for how in ("inner", "left"):
        assert rows(salted_join(skewed, small, ["k"], how, hot, ["seq"], 7)) == rows(keyed_join(skewed, small, ["k"], how))


def test_hot_keys_absent(skewed):
    assert hot_keys(skewed, ["k"], 10_000) is None


def test_latest_and_earliest(skewed):
    by = {}
    for k, seq, v in skewed.collect():
        by.setdefault(k, []).append((seq, v))
    assert {r[0]: (r[1], r[2]) for r in latest_by(skewed, ["k"], ["seq"]).collect()} == {k: max(x) for k, x in by.items()}
    assert {r[0]: (r[1], r[2]) for r in earliest_by(skewed, ["k"], ["seq"]).collect()} == {k: min(x) for k, x in by.items()}


def test_grid_is_the_product(spark):
    a, b = spark.range(13).toDF("a"), spark.range(17).toDF("b")
    assert rows(grid(a, b)) == sorted(itertools.product(range(13), range(17)), key=repr)


def test_grid_repeats_only_the_few(spark):
    a, b = spark.range(13).toDF("a"), spark.range(17).toDF("b")
    for spread, blocks in ((4, (4, 4)), (13, (1, 169)), (17, (289, 1))):
        assert grid_blocks(a, b, spread) == blocks
        assert rows(grid(a, b, spread)) == sorted(itertools.product(range(13), range(17)), key=repr)


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0, 2.0], list(np.random.default_rng(1).normal(size=997)),
                                    [0.0] * 50 + [1e9, -1e9, 3.5]])
def test_exact_cuts_are_order_statistics(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    ordered = sorted(values)
    want = [ordered[math.ceil(len(values) * i / 6) - 1] for i in range(1, 6)]
    assert agg.exact_cuts(df, "x") == want
    assert agg.exact_cuts(df.filter("false"), "x") == []


def test_current_stock_modes_with_hot_pair(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "item_id long, name string")
    stores = spark.createDataFrame([(0, "online"), (1, "s1"), (2, "s2")], "store_id int, name string")
    snaps = spark.createDataFrame([(1, 1, 5, 10), (1, 1, 3, 99), (2, 9, 1, 1)], "item_id long, store_id int, date_time long, quantity int")
    moves = spark.createDataFrame(
        [(1, 1, 4, 7, "sale"), (1, 1, 5, -1, "sale"), (1, 0, 9, 5, "bopis"), (1, 8, 9, 5, "sale")] + [(1, 1, 6, 1, "sale")] * 60
        + [(2, 2, 1, 4, "sale")], "item_id long, store_id int, date_time long, quantity int, change_type string")
    got = inventory.current_stock(items, stores, snaps, moves)
    assert rows(got.select("store_id", "item_id", "current_inventory")) == rows(
        spark.createDataFrame([(1, 1, 69), (None, 1, 0), (None, 2, 0)], "a int, b long, c long"))
    fixed = inventory.current_stock(items, stores, snaps, moves, mode="fixed")
    assert fixed.count() == 6
    assert fixed.filter("store_id = 2 and item_id = 2").first()["current_inventory"] == 4
    kept = inventory.countable_changes(moves, stores)
    latest = inventory.latest_snapshots(snaps)
    assert rows(inventory.moved_since(kept, latest)) == rows(inventory.moved_since(kept, latest, max_rows=5))


def test_documents_are_split_and_lose_nothing(spark):
    data = [("{a}", i % 40, 1, i, i % 3, 2) for i in range(500)] + [("{b}", 1, 1, 1, 1, 1)] * 30
    df = spark.createDataFrame(data, "trans_id string, item_id long, store_id int, date_time long, quantity int, change_type_id long")
    docs = inventory.transaction_documents(df, part_size=50)
    assert docs.agg(F.max(F.size("items"))).first()[0] <= 60 and docs.count() > 10
    back = inventory.item_rows(docs).select("trans_id", "item_id", "quantity")
    assert rows(back) == sorted([(a[1:-1], i, q) for a, i, _, _, q, _ in data], key=repr)


# ---- change data ---------------------------------------------------------------------------

def test_latest_state_equals_open_versions(t):
    c = q_changes.user_changes(t)
    one = ch.scd1(c, ["user_id"], ["event_id"], q_changes.DELETE).select("user_id", "event_type", "value", "band")
    two = ch.current_versions(ch.scd2(c, ["user_id"], "event_id", q_changes.DELETE)).select("user_id", "event_type", "value", "band")
    assert rows(one) == rows(two)


def test_histories_agree_when_sliced(t):
    c = q_changes.user_changes(t)
    args = (c, ["user_id"], "event_id", q_changes.DELETE, ["band"])
    assert rows(ch.scd2(*args)) == rows(ch.scd2(*args, max_rows=3))


def test_replay_in_any_order_gives_the_same_tables(t):
    c = q_changes.user_changes(t).persist()
    want1 = rows(ch.scd1(c, ["user_id"], ["event_id"], q_changes.DELETE))
    want2 = rows(ch.scd2(c, ["user_id"], "event_id", q_changes.DELETE))
    parts = [c.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i) for i in range(3)]
    s1, s2, log = (scratch_path(t.spark, n) for n in ("replay1", "replay2", "replay-log"))
    one = cdc.scd1_batches(s1, ["user_id"], ["event_id"], q_changes.DELETE)
    two = cdc.scd2_batches(log, s2, ["user_id"], "event_id", q_changes.DELETE)
    for batch, i in enumerate((2, 0, 1, 1)):
        one(parts[i], min(batch, 2) if batch < 3 else 2)  # the last batch is delivered again
        two(parts[i], min(batch, 2) if batch < 3 else 2)
    got1 = cdc.scd1_table(t.spark, s1, ["user_id"], ["event_id"]).select(*c.columns)
    got2 = cdc.scd2_table(t.spark, s2, ["user_id"]).select("user_id", "event_type", "value", "band", "__START_AT", "__END_AT")
    assert rows(got1) == want1 and rows(got2) == want2
    c.unpersist()


def test_feed_round_trip(t):
    before, after = q_changes.two_states(t)
    assert rows(ch.apply_feed(before, ch.change_feed(before, after, ["id"], 1), ["id"])) == rows(after)


def test_ties_are_refused(spark):
    tied = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "k int, s int, v string")
    with pytest.raises(Exception, match="share a sequence value"):
        ch.scd1(tied, ["k"], ["s"], on_tie="error").collect()
    assert ch.scd1(tied, ["k"], ["s"]).first()["v"] == "b"


def test_null_updates_are_ignored_since_the_last_delete(spark):
    c = spark.createDataFrame([(1, 1, "a", 5, False), (1, 2, None, None, True), (1, 3, "b", None, False), (1, 4, None, 7, False)],
                              "k int, s int, x string, y int, d boolean")
    got = ch.scd1(c, ["k"], ["s"], "d", ignore_null_updates=True).first()
    assert (got["x"], got["y"], got["s"]) == ("b", 7, 4)


def test_delete_keeps_unknown_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert rows(ch.delete_where(df, "x > 3")) == rows(spark.createDataFrame([(1,), (None,)], "x int"))


def test_layout_keeps_rows_and_interleaves(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).alias("b"))
    zoned = layout.with_zone(df, ["a", "b"], bits=4)
    assert rows(zoned.select("zone")) == sorted([(i,) for i in range(256)], key=repr)


def test_schema_is_inferred_once(spark, tmp_path):
    asked = []

    def infer():
        asked.append(1)
        return spark.range(1).schema
    first, second = (files.stored_schema(spark, str(tmp_path / "schema"), infer) for _ in range(2))
    assert first == second == spark.range(1).schema and len(asked) == 1


def test_one_outlier_does_not_fill_one_file(spark, tmp_path):
    df = spark.range(10_000).select(F.when(F.col("id") == 0, 10 ** 9).otherwise(F.col("id") % 100).alias("a"), (F.col("id") % 97).alias("b"))
    layout.write_clustered(df, ["a", "b"], str(tmp_path / "out"), files=8)
    sizes = [r[0] for r in spark.read.parquet(str(tmp_path / "out")).groupBy(F.input_file_name()).count().select("count").collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 2 * 10_000 / 8


# ---- sources, quality, cleaning ------------------------------------------------------------

def test_rescue_keeps_every_line(spark):
    schema = T._parse_datatype_string("a int, b array<int>")
    lines = spark.createDataFrame([('{"a":1,"b":[1,2]}',), ('{"a":"x"}',), ('{"a":2,"c":{"d":1}}',), ('{"a":',), ("",)], "value string")
    got = {r["_l"]: (r["a"], r["b"], r[files.RESCUED]) for r in [
        {**r.asDict(), "_l": i} for i, r in enumerate(files.rescue_json(lines, schema).collect())]}
    assert got[0] == (1, [1, 2], None)
    assert got[1][0] is None and got[1][2] == '{"a":"x"}'
    assert got[2][0] == 2 and '"c"' in got[2][2]
    assert got[3][0] is None and files.CORRUPT in got[3][2]


def test_rescue_columns(spark):
    texts = spark.createDataFrame([("1", "2.5"), ("x", None)], "a string, b string")
    got = files.rescue_columns(texts, T._parse_datatype_string("a int, b double")).collect()
    assert tuple(got[0]) == (1, 2.5, None) and got[1][2] == '{"a":"x"}'


def test_declared_not_null_fails_the_job(spark):
    schema = T.StructType([T.StructField("x", T.IntegerType(), False)])
    with pytest.raises(Exception, match="NULL in x"):
        sinks.declared(spark.createDataFrame([(1,), (None,)], "x int"), schema).collect()


def test_rules_treat_unknown_as_failed(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "x int")
    good, bad = quality.quarantine(df, {"small": "x < 5", "known": "x is not null"})
    assert rows(good) == [(1,)] and bad.count() == 2
    m = {r["name"]: r for r in quality.rule_metrics(df, "d", {"small": "x < 5", "known": "x is not null"}, "drop").collect()}
    assert m["small"]["passed_records"] == 1 and m["known"]["passed_records"] == 2
    assert m["small"]["dropped_records"] == 2 and m["small"]["output_records"] == 1


def test_sample_is_repeatable_and_near_its_share(spark):
    df = spark.range(4000)
    a, b = clean.hash_sample(df, "id", 0.3, "s"), clean.hash_sample(df, "id", 0.3, "s")
    assert rows(a) == rows(b) and 1050 < a.count() < 1350


def test_transaction_nulls_become_zero(spark):
    raw = spark.createDataFrame([(1, None, None, -2.0, 8.0)], "id int, coupon_disc double, coupon_match_disc double, retail_disc double, sales_value double")
    got = clean.normalise_transactions(raw).first()
    assert got["amount_list"] == 0.0 and got["instore_discount"] == 2.0 and got["total_coupon_discount"] == 0.0
    raw = spark.createDataFrame([(1, -5.0, None, -2.0, 8.0)], "id int, coupon_disc double, coupon_match_disc double, retail_disc double, sales_value double")
    assert clean.normalise_transactions(raw).first()["campaign_coupon_discount"] == 5.0


# ---- streams -------------------------------------------------------------------------------

def test_late_rows_are_counted(t):
    t.spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")  # the count must not rest on kept reports
    src, out, cp = (scratch_path(t.spark, n) for n in ("late-in", "late-out", "late-cp"))
    middle = t.events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    counted = 0
    for part in (t.events.filter(F.col("event_id") > middle), t.events.filter(F.col("event_id") <= middle)):
        part.write.mode("append").parquet(src)
        stream = runs.new_files(t.spark, src, "parquet", t.events.schema)
        query = runs.land(runs.drop_repeats(stream, "ts", "1 hour", ["event_id"]), out, cp)
        counted += runs.late_rows(query)
    assert counted > 0 and t.spark.read.parquet(out).count() + counted == t.events.count()


def test_bulk_load_twice_loads_once(t):
    src, out, cp = (scratch_path(t.spark, n) for n in ("load-in", "load-out", "load-cp"))
    t.customer.write.parquet(src)
    for _ in range(2):
        runs.load_once(t.spark, src, "parquet", t.customer.schema, out, cp)
    assert rows(t.spark.read.parquet(out)) == rows(t.customer)


# ---- geometry ------------------------------------------------------------------------------

def _inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def test_grid_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    star = [(math.cos(a) * r, math.sin(a) * r) for a, r in zip(np.linspace(0, 2 * math.pi, 14, endpoint=False), [9, 3] * 7)]
    sliver = [(-8.0, -8.0), (8.0, -7.9), (8.0, -7.8)]
    zones = spark.createDataFrame([("star", star), ("sliver", sliver)], "zone string, ring array<struct<x:double,y:double>>")
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-10, 10, size=(1500, 2)))]
    df = spark.createDataFrame(points, "id int, x double, y double").select("id", geo.point("x", "y").alias("at"))
    want = sorted([(i, z) for i, x, y in points for z, r in (("star", star), ("sliver", sliver)) if _inside(r, x, y)], key=repr)
    for size, coarse in ((1.0, 4), (0.5, 8), (3.0, 1)):
        cells = spatial.tessellate(zones, "ring", size, coarse)
        assert rows(spatial.points_in_zones(df, "at", cells, size).select("id", "zone")) == want


# ---- propensity ----------------------------------------------------------------------------

def test_labels_count_returns(spark):
    """A later week whose units cancel out is no purchase."""
    import datetime as dt
    day = lambda n: dt.date(2024, 1, 6) + dt.timedelta(days=n)
    tx = spark.createDataFrame([(1, "c", day(1), 1), (1, "c", day(15), 2), (1, "c", day(22), -2), (2, "c", day(60), 1)],
                               "household_key long, commodity_desc string, day date, units long")
    pairs = tx.select("household_key", "commodity_desc").distinct()
    got = {(r[0], str(r[2])): r[3] for r in pro.labels(tx, pairs).collect()}
    assert got[(1, "2024-01-06")] == 0 and got[(2, "2024-02-24")] is None
    assert got[(2, "2024-01-06")] == 0


def test_reference_stamp_is_the_last_transaction_day(t):
    from millrace.queries import q_customers as q
    tx, pairs = q.tx(t), q.pairs(t)
    days = {str(r[0]) for r in pro.backfill(tx, pairs, 2, windows=["30d"], ratios=False, stamp="reference").select("day").distinct().collect()}
    seen = {str(r[0]) for r in tx.select("day").distinct().collect()}
    assert days and days <= seen


def test_scan_of_features_is_bounded(t):
    from millrace.queries import q_customers as q
    f = pro.summary_features(pro.with_last_day(q.tx(t), ["30d"]), ["household_key"], ["30d"])
    plan = f._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(day" in plan


def test_scan_reads_only_needed_columns(t):
    plan = inputs.sales(t).groupBy("store").agg(F.sum("sales"))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan


def test_labels_of_chosen_weeks_equal_the_whole_table(t):
    from millrace.queries import q_customers as q
    tx, pairs = q.tx(t), q.pairs(t)
    whole = pro.labels(tx, pairs)
    days = [r[0] for r in whole.select("day").distinct().orderBy(F.desc("day")).limit(3).collect()]
    assert rows(pro.labels(tx, pairs, days)) == rows(whole.filter(F.col("day").isin(days)))
