"""Flight trips: raw files, enriched trips, daily features, delay histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.clean import token_to_null
from millrace.operators.tables import earliest_by
from millrace.scratch import materialise, scratch_path
from millrace.sources.files import RESCUED, rescue_json
from millrace.streaming import cdc, checked, histories, runs

TRIP_RULES = {
    "valid_month": "try_cast(month_text as int) between 1 and 12",
    "valid_day": "try_cast(day_text as int) between 1 and 31",
    "valid_weekday": "try_cast(weekday_text as int) between 1 and 7",
}
# what did not fit is counted and kept in the side column; a line that is no record at all goes no further
RAW_RULES = {"nothing_rescued": "_rescued_data is null"}
READABLE = {"readable": "get_json_object(_rescued_data, '$._corrupt_record') is null"}
DELAY_KEYS = ["airline_name", "origin_city", "dest_city"]


def airport_table(raw: DataFrame) -> DataFrame:
    return raw.select("iata_code", "name", "municipality", F.split("coordinates", ",").alias("coordinates"))


def airline_table(raw: DataFrame) -> DataFrame:
    """Active airlines, the first name per code."""
    active = raw.filter("iata is not null and iata <> '' and active = 'Y'")
    return earliest_by(active, ["iata"], ["name"])


def enrich_trips(trips: DataFrame, airports: DataFrame, airlines: DataFrame) -> DataFrame:
    """Trips with airline and both airports; the airport table plays two roles."""
    date_text = F.format_string("%s%02d%02d", "year_text", F.col("month_text").try_cast("int"), F.col("day_text").try_cast("int"))
    o, d, a = airports.alias("origin_airport"), airports.alias("dest_airport"), airlines.alias("airline")
    return (
        trips.join(o, F.col("origin") == F.col("origin_airport.iata_code"), "left")
        .join(d, F.col("dest") == F.col("dest_airport.iata_code"), "left")
        .join(a, F.col("carrier") == F.col("airline.iata"), "left")
        .select(
            "trip_id", "leg", F.col("arr_delay").try_cast("int").alias("arr_delay"),
            F.col("distance").try_cast("int").alias("distance"),
            F.try_to_date(date_text, "yyyyMMdd").alias("date"),
            F.col("airline.name").alias("airline_name"),
            F.col("origin_airport.municipality").alias("origin_city"), F.col("origin_airport.name").alias("origin_airport_name"),
            F.col("origin_airport.coordinates").alias("origin_coordinates"),
            F.col("dest_airport.municipality").alias("dest_city"), F.col("dest_airport.name").alias("dest_airport_name"),
            F.col("dest_airport.coordinates").alias("dest_coordinates"))
    )


def daily_features(trips: DataFrame) -> DataFrame:
    return trips.groupBy("date", "airline_name").agg(
        F.count("*").alias("no_flights"), F.sum("distance").alias("tot_distance"))


def delays(trips: DataFrame) -> DataFrame:
    """The columns of the delay histories."""
    return trips.select(*DELAY_KEYS, "date", (F.col("arr_delay") > 0).alias("is_arr_delayed"), "arr_delay")


class Airline:
    """Paths of one deployment; ``run`` takes in whatever files arrived since the last call."""

    def __init__(self, spark: SparkSession, source: str, airports: DataFrame, airlines: DataFrame, schema: T.StructType):
        self.spark, self.source, self.schema = spark, source, schema
        # small tables of known size, so that the streaming joins broadcast them and no carrier is a hot key
        self.airports = materialise(airport_table(airports), "airports")
        self.airlines = materialise(airline_table(airlines), "airlines")
        base = scratch_path(spark, "airline")
        self.bronze, self.silver, self.daily, self.scd1, self.rules = (f"{base}/{n}" for n in ("bronze", "silver", "daily", "scd1", "rules"))
        self.history = histories.History(spark, f"{base}/history", DELAY_KEYS, "date", tracked=["is_arr_delayed"], reduce_first=True)
        self.checkpoints = f"{base}/checkpoints"

    def run(self) -> None:
        spark, cp = self.spark, self.checkpoints
        lines = rescue_json(spark.readStream.text(self.source), self.schema)
        runs.each_batch(lines, checked.checked("trips_raw", runs.batch_log(self.bronze), self.rules, READABLE, RAW_RULES), f"{cp}/bronze")
        bronze = T.StructType([*self.schema.fields, T.StructField(RESCUED, T.StringType())])
        raw = token_to_null(runs.new_files(spark, f"{self.bronze}/*", "parquet", bronze)).drop(RESCUED)
        enrich = lambda df, k: runs.write_batch(enrich_trips(df, self.airports, self.airlines), self.silver, k)
        runs.each_batch(raw, checked.checked("trips", enrich, self.rules, TRIP_RULES), f"{cp}/silver")
        trips = spark.read.parquet(self.silver).drop("batch_id").schema
        silver = lambda: runs.new_files(spark, f"{self.silver}/*", "parquet", trips)
        runs.each_batch(daily_features(silver()), runs.batch_log(self.daily), f"{cp}/daily", "update")
        changes = delays(silver())
        runs.each_batch(changes, cdc.scd1_batches(self.scd1, DELAY_KEYS, ["date"]), f"{cp}/scd1")
        self.history.follow(changes)

    def metrics(self) -> DataFrame:
        """What the rules passed, failed and dropped, over all batches so far; counted when the rows were written."""
        return checked.rule_totals(self.spark, self.rules)

    def events(self) -> DataFrame:
        """The rules' counts per batch, as progress records."""
        return checked.progress_events(self.spark, self.rules)

    def daily_table(self) -> DataFrame:
        return runs.newest_rows(self.spark, self.daily, ["date", "airline_name"])

    def latest_delays(self) -> DataFrame:
        return cdc.scd1_table(self.spark, self.scd1, DELAY_KEYS, ["date"])

    def delay_history(self) -> DataFrame:
        return self.history.table()
