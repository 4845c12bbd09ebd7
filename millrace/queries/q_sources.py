"""File source and sink queries over files staged from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.functions import geo
from millrace.queries import inputs
from millrace.queries.inputs import USERS_SQL
from millrace.queries.registry import query
from millrace.queries.staging import arrive, slices, staged, staged_as
from millrace.scratch import scratch_path
from millrace.sources import evolving, files, sinks
from millrace.streaming import runs

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENTS_OUT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props"
SELECT_EVENTS = f"SELECT {EVENTS_OUT} FROM events"


MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def event_json(t):
    return staged_as(t, "events", t.events, "json", files=4, **MICROS)


def work(t, name):
    return scratch_path(t.spark, name)


@query("s1_json_scan", SELECT_EVENTS)
def s1(t):
    """By SQL path on the staged files, typed on the way out."""
    t.spark.read.schema(EVENT_SCHEMA).options(**MICROS).json(event_json(t)).createOrReplaceTempView("s1_reader")
    by_path = t.spark.sql(f"select event_id, user_id from json.`{event_json(t)}`")
    by_reader = t.spark.table("s1_reader")
    return by_reader.join(by_path, ["event_id", "user_id"], "left_semi").select(*t.events.columns)


CHANGE_SCHEMA = "trans_id string, item_id int, store_id int, date_time timestamp, quantity int, change_type_id int"


@query("s2_csv_scan_declared", """
SELECT '{' || CAST(l_orderkey AS VARCHAR) || '}' AS trans_id, CAST(l_partkey AS INTEGER) AS item_id,
       CAST(l_suppkey % 5 AS INTEGER) AS store_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS date_time,
       CAST(l_quantity AS INTEGER) AS quantity, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS change_type_id
FROM lineitem""")
def s2(t):
    """Two directories in one scan, declared schema and timestamp format."""
    rows = t.lineitem.select(
        F.format_string("{%d}", "l_orderkey").alias("trans_id"), F.col("l_partkey").alias("item_id"),
        (F.col("l_suppkey") % 5).alias("store_id"), F.date_format("l_shipdate", "MM/dd/yyyy HH:mm").alias("date_time"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("change_type_id"))
    a = staged_as(t, "changes-returned", rows.filter("change_type_id = 1"), "csv", header=True)
    b = staged_as(t, "changes-other", rows.filter("change_type_id <> 1"), "csv", header=True)
    return t.spark.read.csv([a, b], schema=CHANGE_SCHEMA, header=True, timestampFormat="MM/dd/yyyy HH:mm")


@query("s3_csv_inferred_header_and_parts", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s3(t):
    """The first part carries the header, the others are headerless and matched by a glob."""
    first, *rest = slices(t.customer, "c_custkey", 3)
    base = staged(t, "headed", lambda p: first.write.option("header", True).csv(f"{p}/head"))
    staged(t, "headless", lambda _: [
        df.write.option("header", False).csv(f"{base}/part-000{i:02d}") for i, df in enumerate(rest, 1)])
    head = t.spark.read.option("header", True).option("inferSchema", True).csv(f"{base}/head")
    parts = t.spark.read.option("inferSchema", True).csv(f"{base}/part-000{{0[1-9],1[0-9]}}")
    return head.union(parts)


@query("s4_table_by_name", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def s4(t):
    files.register_tables(t.spark, {n: f"{t.sf_dir}/{n}.parquet" for n in ("customer", "nation", "region")})
    return t.spark.sql("""select c_custkey, n_name, r_name from customer
                          join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")


def text_files(t):
    """Page sources, one folder per document language, as plain files."""
    return staged(t, "texts", lambda path: t.documents.select("lang", F.hex(F.encode("text", "utf-8")).alias("line"))
                  .write.option("maxRecordsPerFile", 100_000).partitionBy("lang").text(path))


BINARY_SQL = """
SELECT lang AS id, CAST(sum(strlen(text) * 2 + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY 1"""


@query("s5_binary_scan", BINARY_SQL)
def s5(t):
    found = t.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(text_files(t))
    return found.select(files.id_from_path("lang=([a-z]+)").alias("id"), F.octet_length("content").alias("n")).groupBy(
        "id").agg(F.sum("n").alias("n_bytes"))


@query("s6_incremental_json", SELECT_EVENTS)
def s6(t):
    """Two arrivals, two runs: the second only reads the files that are new."""
    src, out, cp = work(t, "s6-in"), work(t, "s6-out"), work(t, "s6-cp")
    arrive(slices(t.events, "event_id", 2), src, "json",
           lambda: runs.land(runs.new_files(t.spark, src, "json", EVENT_SCHEMA, **MICROS), out, cp), **MICROS)
    return t.spark.read.parquet(out)


@query("s7_incremental_csv", f"""
WITH {USERS_SQL} SELECT id, age, annual_income, spending_core FROM spend""")
def s7(t):
    src, out, cp = work(t, "s7-in"), work(t, "s7-out"), work(t, "s7-cp")

    def run():
        schema = files.stored_schema(t.spark, f"{cp}-schema", lambda: files.hinted_schema(
            t.spark, src, "csv", "id bigint, annual_income double, spending_core double", header=True))
        runs.land(runs.new_files(t.spark, src, "csv", schema, header=True), out, cp)

    arrive(slices(inputs.spend(t), "id", 2), src, "csv", run, header=True)
    return t.spark.read.parquet(out)


LATE_SQL = """
WITH e AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
p AS (SELECT orders.*, CASE WHEN o_orderkey < lo + (hi - lo) / 3 THEN 1 WHEN o_orderkey < lo + (hi - lo) * 2 / 3 THEN 2 ELSE 3 END AS part FROM orders, e)
SELECT o_orderkey, o_totalprice, CASE WHEN part > 1 THEN o_custkey END AS o_custkey, CASE WHEN part > 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ordered,
       CASE WHEN part > 2 THEN o_orderpriority END AS o_orderpriority, CAST(NULL AS VARCHAR) AS _rescued_data FROM p"""


def late_columns(t, fmt, **options):
    """Three arrivals, each with more columns than the one before and in another order."""
    src = work(t, f"late-{fmt}-in")
    job = evolving.Evolving(t.spark, src, fmt, work(t, f"late-{fmt}"), "o_orderkey bigint, o_totalprice double")
    names = [["o_orderkey", "o_totalprice"], ["ordered", "o_totalprice", "o_custkey", "o_orderkey"],
             ["o_custkey", "o_orderpriority", "o_orderkey", "ordered", "o_totalprice"]]
    parts = slices(t.orders.withColumn("ordered", F.date_format("o_orderdate", "yyyy-MM-dd")), "o_orderkey", 3)
    for part, columns in zip(parts, names):
        part.select(*columns).write.mode("append").options(**options).format(fmt).save(src)
        job.run()
    return job


@query("s7_late_column", LATE_SQL)
def s7_late(t):
    return late_columns(t, "csv", header=True).table()


@query("s10_late_field", LATE_SQL)
def s10_late(t):
    return late_columns(t, "json").table()


@query("s8_incremental_multiline_json", """
SELECT r_name AS type, count(*) AS features, min(s_name) AS first_zone
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def s8(t):
    """One pretty-printed feature collection per file."""
    src = zone_files(t)
    out, cp = work(t, "s8-out"), work(t, "s8-cp")
    stream = runs.new_files(t.spark, src, "json", geo.COLLECTION_SCHEMA, multiLine=True, recursiveFileLookup=True)
    runs.land(stream, out, cp)
    flat = t.spark.read.parquet(out).select("type", F.explode("features").alias("f"))
    return flat.groupBy("type").agg(F.count("*").alias("features"), F.min("f.properties.zone").alias("first_zone"))


def zone_files(t):
    from millrace.queries.q_geo import collections
    return staged(t, "zones-geojson", lambda p: collections(t, pretty="true").write.partitionBy("region", "block").text(p))


@query("s9_incremental_binary", BINARY_SQL)
def s9(t):
    src, out, cp = text_files(t), work(t, "s9-out"), work(t, "s9-cp")
    schema = t.spark.read.format("binaryFile").load(src).schema
    stream = runs.new_files(t.spark, src, "binaryFile", T.StructType([f for f in schema if f.name != "lang"]),
                            pathGlobFilter="part-*", recursiveFileLookup=True)
    tagged = stream.select(files.id_from_path("lang=([a-z]+)").alias("id"), "path", "content")
    runs.land(tagged, out, cp)
    return t.spark.read.parquet(out).groupBy("id").agg(F.sum(F.octet_length("content")).alias("n_bytes"))


@query("s10_schema_hints", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
       CAST(p_retailprice AS DOUBLE) AS p_retailprice, CAST(NULL AS VARCHAR) AS remark FROM part""")
def s10(t):
    """Two inferred types are overridden and an expected column is added."""
    src = staged_as(t, "part", t.part, "json")
    schema = files.hinted_schema(t.spark, src, "json", "p_partkey string, p_size bigint, remark string")
    return t.spark.read.schema(schema).json(src)


def dirty_lines(t):
    """Errors carry a text where a number belongs, views an unknown field, clicks are cut short."""
    doc = F.to_json(F.struct("event_id", "user_id", "value"))
    bad_value = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":'),
                         F.col("user_id").cast("string"), F.lit(',"value":"n/a"}'))
    extra = F.concat(F.expr("substring(d, 1, length(d) - 1)"), F.lit(',"note":"x"}'))
    cut = F.expr("substring(d, 1, length(d) - 3)")
    lines = t.events.withColumn("d", doc).select(
        F.when(F.col("event_type") == "error", bad_value).when(F.col("event_type") == "view", extra)
        .when(F.col("event_type") == "click", cut).otherwise(F.col("d")).alias("value"))
    return staged_as(t, "dirty", lines, "text")


RESCUE_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                              T.StructField("value", T.DoubleType())])


@query("s11_rescued_data", """
SELECT CASE WHEN event_type <> 'click' THEN event_id END AS event_id, CASE WHEN event_type <> 'click' THEN user_id END AS user_id,
       CASE WHEN event_type NOT IN ('click', 'error') THEN value END AS value,
       CASE event_type WHEN 'error' THEN '{"value":"n/a"}' WHEN 'view' THEN '{"note":"x"}' WHEN 'click' THEN 'line' END AS rescued
FROM events""")
def s11(t):
    parsed = files.rescue_json(t.spark.read.text(dirty_lines(t)), RESCUE_SCHEMA)
    kept = F.col(files.RESCUED)
    return parsed.select("event_id", "user_id", "value",
                         F.when(kept.contains(files.CORRUPT), "line").otherwise(kept).alias("rescued"))


@query("s12_corrupt_record", """
SELECT event_type = 'click' OR event_type = 'error' AS corrupt, count(*) AS n,
       count(CASE WHEN event_type <> 'click' THEN event_id END) AS parsed_ids,
       count(CASE WHEN event_type <> 'click' THEN user_id END) AS parsed_users,
       count(CASE WHEN event_type NOT IN ('click', 'error') THEN value END) AS parsed_values FROM events GROUP BY 1""")
def s12(t):
    schema = files.with_corrupt_record(RESCUE_SCHEMA)
    rows = t.spark.read.schema(schema).json(dirty_lines(t))
    return rows.groupBy(F.col(files.CORRUPT).isNotNull().alias("corrupt")).agg(
        F.count("*").alias("n"), F.count("event_id").alias("parsed_ids"),
        F.count("user_id").alias("parsed_users"), F.count("value").alias("parsed_values"))


@query("s13_files_per_batch", """
SELECT CAST(b AS BIGINT) AS batches, (SELECT count(*) FROM events) AS n FROM (SELECT 4 AS b)""")
def s13(t):
    """Four files at one file per micro-batch make four batches."""
    out, cp = work(t, "s13-out"), work(t, "s13-cp")
    stream = runs.new_files(t.spark, event_json(t), "json", EVENT_SCHEMA, max_files=1, **MICROS)
    runs.each_batch(stream, runs.batch_log(out), cp)
    return t.spark.read.parquet(out).agg(F.count_distinct("batch_id").alias("batches"), F.count("*").alias("n"))


@query("s14_existing_files", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s14(t):
    """Files that were there before the first run are part of it."""
    out, cp = work(t, "s14-out"), work(t, "s14-cp")
    runs.land(runs.new_files(t.spark, event_json(t), "json", EVENT_SCHEMA, **MICROS), out, cp)
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("s15_stream_from_table", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def s15(t):
    src, out, cp = work(t, "s15-in"), work(t, "s15-out"), work(t, "s15-cp")
    arrive(slices(t.events, "event_id", 2), src, "parquet", lambda: runs.land(
        runs.table_stream(t.spark, src).filter("event_type = 'purchase'").select("event_id", "user_id", "value"), out, cp))
    return t.spark.read.parquet(out)


@query("s16_stream_over_rewritten_files", """
SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value FROM events
WHERE CASE WHEN event_type = 'click' THEN value + 1 ELSE value END > 6""")
def s16(t):
    """Upstream rewrites come through again; the reader keeps the newest row per key, then filters."""
    src, out, cp = work(t, "s16-in"), work(t, "s16-out"), work(t, "s16-cp")
    rewritten = t.events.withColumn("value", F.when(F.col("event_type") == "click", F.col("value") + 1).otherwise(F.col("value")))
    arrive([t.events, rewritten], src, "parquet", lambda: runs.each_batch(
        runs.table_stream(t.spark, src).select("event_id", "user_id", "value"), runs.batch_log(out), cp))
    return runs.newest_rows(t.spark, out, ["event_id"]).filter("value > 6")


@query("s17_idempotent_bulk_load", SELECT_EVENTS)
def s17(t):
    out, cp = work(t, "s17-out"), work(t, "s17-cp")
    for _ in range(2):
        runs.load_once(t.spark, event_json(t), "json", EVENT_SCHEMA, out, cp, **MICROS)
    return t.spark.read.parquet(out)


@query("s18_exactly_once_sink", SELECT_EVENTS)
def s18(t):
    out, cp = work(t, "s18-out"), work(t, "s18-cp")
    for _ in range(2):
        stream = runs.new_files(t.spark, event_json(t), "json", EVENT_SCHEMA, max_files=2, **MICROS)
        runs.land(stream, out, cp, partition_by=["event_type"])
    return t.spark.read.parquet(out).select(*t.events.columns)


@query("s19_schema_evolving_write", """
SELECT c_custkey, c_name, CASE WHEN c_custkey >= (SELECT max(c_custkey) / 2 FROM customer) THEN c_mktsegment END AS c_mktsegment FROM customer""")
def s19(t):
    path = work(t, "s19")
    older, newer = slices(t.customer, "c_custkey", 2)
    sinks.append_evolving(older.select("c_custkey", "c_name"), path)
    sinks.append_evolving(newer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return sinks.read_evolving(t.spark, path)


@query("s20_overwrite", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def s20(t):
    path = work(t, "s20")
    sinks.overwrite(t.customer.select("c_custkey", "c_acctbal"), path)
    sinks.overwrite(t.customer.select("c_custkey", "c_acctbal").filter("c_acctbal >= 0"), path)
    return t.spark.read.parquet(path)


@query("s21_create_if_absent", "SELECT s_suppkey, s_name FROM supplier")
def s21(t):
    path = work(t, "s21")
    sinks.create_if_absent(t.supplier.select("s_suppkey", "s_name"), path)
    sinks.create_if_absent(t.supplier.select("s_suppkey", "s_name").filter("s_suppkey < 0"), path)
    return t.spark.read.parquet(path)


@query("s22_json_split", "SELECT CAST(5 AS BIGINT) AS files, count(*) AS n FROM customer")
def s22(t):
    path = work(t, "s22")
    sinks.split_json(t.customer, path, 5)
    return t.spark.read.schema(t.customer.schema).json(path).select(F.input_file_name().alias("f")).agg(
        F.count_distinct("f").alias("files"), F.count("*").alias("n"))


@query("s23_row_documents", """
SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS doc FROM orders""")
def s23(t):
    slim = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return slim.select(sinks.row_document(slim).alias("doc"))


@query("s24_declared_not_null", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer")
def s24(t):
    schema = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("name", T.StringType(), False)])
    return sinks.declared(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), schema)


@query("s25_folder_fan_in", """
SELECT 'customer' AS folder, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part""")
def s25(t):
    base = staged(t, "folders", lambda p: [
        getattr(t, n).write.option("header", True).csv(f"{p}/{n}") for n in ("customer", "orders", "part")])
    out = work(t, "s25-out")
    schemas = {n: getattr(t, n).schema for n in ("customer", "orders", "part")}
    names = runs.ingest_folders(t.spark, base, "csv", schemas, out, work(t, "s25-cp"), header=True)
    counted = [t.spark.read.parquet(f"{out}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("folder"), "n") for n in names]
    total = counted[0]
    for c in counted[1:]:
        total = total.unionByName(c)
    return total


@query("s26_temp_view", "SELECT event_type, count(*) AS n FROM events WHERE value > 5 GROUP BY 1")
def s26(t):
    t.events.filter("value > 5").createOrReplaceTempView("worthwhile_events")
    return t.spark.sql("select event_type, count(*) as n from worthwhile_events group by event_type")


@query("s27_date_spine", """
SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""")
def s27(t):
    return files.date_spine(t.orders, "o_orderdate")
