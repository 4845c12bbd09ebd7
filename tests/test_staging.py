"""Staged tables: parts follow the size of what is read."""

import glob
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from millrace.queries import inputs, q_customers, q_streams, staging
from millrace.queries.registry import Tables
from millrace.scratch import scratch_path


def small(spark, n=400):
    """Order lines of a few parts and orders, in folders like those of the test tables."""
    base = scratch_path(spark, "tables")
    key = F.col("id")
    at = F.expr("timestamp_ntz'1995-01-01' + make_dt_interval(cast(id % 90 as int))")
    made = {
        "customer": spark.range(5).select(key.alias("c_custkey"), (key % 3).cast("int").alias("c_nationkey")),
        "supplier": spark.range(5).select(key.alias("s_suppkey"), (key % 3).cast("int").alias("s_nationkey")),
        "part": spark.range(9).select(key.alias("p_partkey"), F.concat(F.lit("b"), key % 2).alias("p_brand"), F.concat(F.lit("t"), key % 4).alias("p_type"),
                                      F.lit("n").alias("p_name"), (key + 8).cast("int").alias("p_size")),
        "orders": spark.range(n // 4).select(key.alias("o_orderkey"), (key % 5).alias("o_custkey"), at.alias("o_orderdate")),
        "lineitem": spark.range(n).select((key % (n // 4)).alias("l_orderkey"), (key % 9).alias("l_partkey"), (key % 5).alias("l_suppkey"),
                                          (key % 4).cast("int").alias("l_linenumber"), (key % 7 + 18.0).alias("l_quantity"), (key + 100.0).alias("l_extendedprice"),
                                          F.lit(0.05).alias("l_discount"), F.lit(0.01).alias("l_tax"), F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
                                          at.alias("l_shipdate"))}
    for name, df in made.items():
        df.write.parquet(f"{base}/{name}.parquet")
    return Tables(spark, base)


def test_files_and_parts_follow_the_input(spark, monkeypatch):
    t = small(spark)
    assert staging.portions(inputs.trips(t)) == 4
    monkeypatch.setattr(staging, "PART_BYTES", 1000)
    n = staging.portions(inputs.trips(t))
    assert n > 8
    path = q_streams.trip_files(t)
    assert len(glob.glob(f"{path.removeprefix('file:')}/*.json")) == n
    batches = []
    q_streams.runs.each_batch(q_streams.trip_stream(t), lambda df, k: batches.append(df.count()), scratch_path(spark, "cp"))
    assert len(batches) == 2 and sum(batches) == 400
    assert q_customers.tx(t).count() == 400
    assert len(q_customers.tx(t).inputFiles()) > 8


def test_large_staged_trips_are_joined_share_by_share(spark, tmp_path, monkeypatch):
    """Every row once, null keys too; files are packed, come in two arrivals, and no shuffled row stays on disk."""
    some = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    some("customer", [(c, f"c{c}", c % 3, 1.0, "x") for c in range(5)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    some("supplier", [(c, f"s{c}", c % 2, 1.0) for c in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    some("part", [(c, f"p{c}", f"b{c % 3}", "t", c, 1.0) for c in range(6)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    some("orders", [(c, c % 5, "O", 1.0) for c in range(40)] + [(None, 1, "O", 1.0), (7, 2, "F", 2.0)],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")
    lines = [(k % 45, k % 6 if k % 11 else None, k % 4, None if k % 13 == 0 else k % 3, float(k % 40), 1.0, (k % 10) / 100, (k % 9) / 100, "ANR"[k % 3],
              "OF"[k % 2], datetime(2000, 1 + k % 12, 1 + k % 28)) for k in range(300)]
    some("lineitem", lines + lines[:20], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    t = Tables(spark, str(tmp_path))
    monkeypatch.setattr(staging, "LARGE_BYTES", 0)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = shuffled()
    path = q_streams.trip_files(t)
    assert not shuffled() - before
    files = spark.read.text(path).inputFiles()
    assert len(files) >= staging.SHARES and all(f.endswith(".json.gz") for f in files)
    want = inputs.trips(t)
    got = spark.read.schema(want.schema).json(path)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and want.count() > 200
    batches = []
    q_streams.runs.each_batch(q_streams.trip_stream(t), lambda df, k: batches.append(df.count()), scratch_path(spark, "cp"))
    assert len(batches) == 2 and sum(batches) == want.count()
