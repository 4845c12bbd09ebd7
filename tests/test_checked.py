"""Rules counted in the pass that writes: several batches, a repeated one, unknown predicates, and lines that are no records."""

import json

from pyspark.sql import functions as F, types as T

from millrace.operators import quality
from millrace.plans.airline import RAW_RULES, READABLE
from millrace.scratch import scratch_path
from millrace.sources.files import rescue_json
from millrace.streaming import checked, runs


def test_counts_of_batches_add_up_and_a_repeated_one_replaces_itself(spark):
    out, log = scratch_path(spark, "ck-out"), scratch_path(spark, "ck-log")
    write = checked.checked("numbers", runs.batch_log(out), log, {"small": "v < 5", "known": "v is not null"}, {"even": "v % 2 = 0"})
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    write(rows(1, 2, None, 9), 0)
    for some in (rows(1), rows(4, 6, 8)):
        write(some, 1)
    write(rows().limit(0), 2)
    got = {(r.batch_id, r.name): tuple(r)[3:] for r in checked.rule_log(spark, log).collect()}
    assert got[(0, "small")] == (2, 2, 2, 2) and got[(0, "known")] == (3, 1, 2, 2) and got[(0, "even")] == (1, 3, 2, 2)
    assert got[(1, "small")] == (1, 2, 2, 1) and got[(2, "even")] == (0, 0, 0, 0) and len(got) == 9
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 2, 4]
    totals = {r.name: tuple(r)[2:] for r in checked.rule_totals(spark, log).collect()}
    assert totals["small"] == (3, 4, 4, 3)
    events = quality.log_metrics(checked.progress_events(spark, log)).filter("name = 'even'").agg(F.sum("failed_records"), F.count("*")).first()
    assert tuple(events) == (3 + 0, 3)


def test_broken_lines_and_unknown_fields(spark):
    schema = T.StructType.fromDDL("id bigint, name string")
    lines = [json.dumps({"id": 1, "name": "a"}), json.dumps({"id": 2, "name": "b", "more": 1}), '{"id": 3, "na', json.dumps({"id": "x"}), json.dumps({"_corrupt_record": None, "id": 5})]
    rows = rescue_json(spark.createDataFrame([(v,) for v in lines], "value string"), schema)
    out, log = scratch_path(spark, "cl-out"), scratch_path(spark, "cl-log")
    checked.checked("raw", runs.batch_log(out), log, READABLE, RAW_RULES)(rows, 0)
    got = {r.name: (r.passed_records, r.failed_records, r.dropped_records, r.output_records) for r in checked.rule_log(spark, log).collect()}
    assert got == {"readable": (4, 1, 1, 4), "nothing_rescued": (2, 3, 1, 4)}
