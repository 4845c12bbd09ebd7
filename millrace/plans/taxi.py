"""Taxi trips between zones: zone files and trips to two summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import geo
from millrace.operators import cover, quality, spatial
from millrace.scratch import scratch_path
from millrace.streaming import runs


def run_taxi(spark: SparkSession, zone_files: str, trip_table: str, size: float, mode: str = "exact",
             vendor: str = "VTS") -> dict[str, DataFrame]:
    base = scratch_path(spark, "taxi")
    cp = f"{base}/checkpoints"
    stream = runs.new_files(spark, zone_files, "json", geo.COLLECTION_SCHEMA, multiLine=True, recursiveFileLookup=True)
    shapes = stream.select(F.explode("features").alias("f")).select(
        "f.properties.zone", "f.properties.zone_id", F.col("f.geometry").alias("geometry"))
    runs.land(shapes.select("zone", "zone_id", geo.rings().alias("ring")), f"{base}/zones", f"{cp}/zones")
    zones = spark.read.parquet(f"{base}/zones")
    good = quality.drop_failing(runs.table_stream(spark, trip_table), spatial.trip_rules(vendor))
    if mode == "exact":
        cover.cover(zones, "ring", size).write.mode("overwrite").parquet(f"{base}/cells")
        # a micro-batch knows its own hot cells, a streaming join does not
        runs.each_batch(good, lambda df, k: runs.write_batch(cover.trips_between(df, spark.read.parquet(f"{base}/cells"), size), f"{base}/trips", k), f"{cp}/trips")
        trips = spark.read.parquet(f"{base}/trips").drop("batch_id")
    else:
        spatial.tessellate(zones, "ring", size).write.mode("overwrite").parquet(f"{base}/cells")
        runs.land(spatial.trips_between_zones(good, spark.read.parquet(f"{base}/cells"), size, mode), f"{base}/trips", f"{cp}/trips")
        trips = spark.read.parquet(f"{base}/trips")
    return {"zone_month": spatial.zone_month_summary(trips), "daily": spatial.daily_summary(trips)}
