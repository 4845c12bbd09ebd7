"""Version histories held in state: any order of arrival, short tails, and the batch operator give the same versions."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators.changes import scd2
from millrace.scratch import scratch_path
from millrace.streaming import histories, runs


def plain(rows):
    """{start: (end, row)} of one key's (sequence, row, tracked, deleted), straight from the rule."""
    best = {}
    for r in rows:
        if r[0] not in best or r[1] > best[r[0]][1]:
            best[r[0]] = r
    out, start, was = {}, None, None
    for seq, row, tracked, gone in sorted(best.values()):
        if start is not None and (gone or tracked != was):
            out[start] = (seq, out[start][1])
            start = None
        if not gone:
            if start is None:
                start, was = seq, tracked
            out[start] = (None, row)
    return out


@pytest.mark.parametrize("tail", [1, 2, 5, 1000])
def test_emitted_versions_add_up(tail):
    rng = random.Random(tail)
    late_keys = 0
    for _ in range(400):
        drawn = [(rng.randint(0, 14), rng.randint(0, 9)) for _ in range(rng.randint(1, 16))]
        rows = [(s, f'"{v}"', "ab"[v % 2], v % 5 == 4) for s, v in drawn]
        order = rng.sample(rows, len(rows)) if rng.random() < 0.6 else sorted(rows)
        state, table, late, touched = None, {}, False, 0
        while order:
            n = rng.randint(1, 4)
            part, order = order[:n], order[n:]
            state, emitted = histories.advanced(state, part, tail)
            assert len(state[0]) <= tail
            for start, end, row, removed, rebuild in emitted:
                if rebuild:
                    late = True
                elif removed:
                    table.pop(start)
                else:
                    table[start] = (end, row)
            touched += len(emitted)
            if late:
                assert emitted == [(None, None, None, False, True)]  # and for ever after
        late_keys += late
        if not late:
            assert table == plain(rows)
    assert (late_keys > 20) == (tail < 1000)


def test_a_late_change_touches_its_neighbours_only():
    rows = [(k, f'"{k}"', "ab"[k // 2 % 2], False) for k in range(0, 200, 2)]
    state, _ = histories.advanced(None, rows, 1000)
    _, emitted = histories.advanced(state, [(101, '"x"', "z", False)], 1000)
    assert sorted(e[0] for e in emitted) == [100, 101]


def test_equal_sequences_keep_the_largest():
    rows = lambda *v: [(1, v_, "t", False) for v_ in v]
    for a, b in (('{"x":9}', '{"x":10}'), ('{"x":null}', '{"x":-1}'), ('{"x":"a"}', '{"x":"b"}'), ('{"x":[1,2]}', '{"x":[1,3]}'), ('{"x":1.5,"y":1}', '{"x":1.50,"y":2}')):
        for order in ((a, b), (b, a)):
            assert histories.merged(rows(order[0]), rows(order[1]))[0][1] == b


DDL = "k long, j string, at date, amount decimal(10,2), flag boolean, seen timestamp, kind string"


@pytest.mark.parametrize("tail", [2, 1000])
def test_history_equals_the_batch(spark, tail):
    rng = random.Random(3)
    day = date(2024, 1, 1)
    rows = [(rng.choice([1, 2, None]), rng.choice(["x", "", None]), rng.choice([day + timedelta(days=rng.randint(0, 30))] * 9 + [None]),
             rng.choice([None, Decimal(rng.randint(0, 3)) / 4]), rng.choice([True, False, None]),
             rng.choice([None, datetime(2024, 1, 1, 1, 2, 3, 456789)]), rng.choice(["set", "set", "set", "gone"])) for _ in range(120)]
    src = scratch_path(spark, "th-in")
    job = histories.History(spark, scratch_path(spark, "th"), ["k", "j"], "at", "kind = 'gone'", tracked=["amount", "flag"], tail=tail)
    for k in range(4):
        spark.createDataFrame(rows[k::4], DDL).write.mode("append").parquet(src)
        job.follow(runs.new_files(spark, src, "parquet", DDL))
        if k in (1, 3):
            so_far = spark.createDataFrame([r for j in range(k + 1) for r in rows[j::4]], DDL).filter("at IS NOT NULL")
            want = scd2(so_far, ["k", "j"], "at", "kind = 'gone'", ["amount", "flag"], unique=False)
            assert Counter(map(tuple, job.table().collect())) == Counter(map(tuple, want.select(*job.table().columns).collect()))
    emitted = spark.read.parquet(f"{job.base}/emitted")
    assert emitted.filter("rebuild").isEmpty() == (tail == 1000)


def test_sequences_of_text_are_refused(spark):
    src = scratch_path(spark, "tx-in")
    spark.createDataFrame([(1, "a", 2)], "k long, at string, v int").write.parquet(src)
    with pytest.raises(ValueError):
        histories.History(spark, scratch_path(spark, "tx"), ["k"], "at").follow(runs.new_files(spark, src, "parquet", "k long, at string, v int"))


def test_timestamps_as_sequence(spark):
    src, start = scratch_path(spark, "ts-in"), datetime(2024, 5, 1, 0, 0, 0, 1)
    ddl = "k long, at timestamp, v int"
    spark.createDataFrame([(1, start, 1), (1, start + timedelta(microseconds=1), 2)], ddl).write.parquet(src)
    job = histories.History(spark, scratch_path(spark, "ts"), ["k"], "at")
    job.follow(runs.new_files(spark, src, "parquet", ddl))
    got = {(r.v, r["__START_AT"], r["__END_AT"]) for r in job.table().collect()}
    assert got == {(1, start, start + timedelta(microseconds=1)), (2, start + timedelta(microseconds=1), None)}
    assert job.table().agg(F.count("*")).first()[0] == 2


def test_changes_of_one_moment_are_reduced_before_the_state(spark):
    """Many rows per key and sequence, keys and sequences also null: the same versions, and a row per key and sequence for Python."""
    rows = [(k, date(2024, 1, 1) + timedelta(days=d) if d else None, d % 2 == 0 if v % 3 else None, v)
            for k in ("a", "b", None) for d in range(6) for v in range(d, d + 30)]
    random.Random(4).shuffle(rows)
    src, tables = scratch_path(spark, "reduce-in"), []
    df = spark.createDataFrame(rows, "k string, at date, late boolean, delay int")
    jobs = [histories.History(spark, scratch_path(spark, "reduce"), ["k"], "at", tracked=["late"], reduce_first=first) for first in (False, True)]
    for part in df.randomSplit([0.5, 0.5], seed=1):
        part.write.mode("append").parquet(src)
        for job in jobs:
            job.follow(runs.table_stream(spark, src))
    for job in jobs:
        tables.append(Counter(map(tuple, job.table().select("k", "late", "delay", "__START_AT", "__END_AT").collect())))
    assert tables[0] == tables[1] and len(tables[0]) > 6
    assert spark.read.parquet(f"{jobs[1].base}/reduced").count() <= 2 * 3 * 5


def test_late_keys_are_taken_from_the_log_once(spark, monkeypatch):
    """Micro-batches with late changes of long keys read no log; the table does, once and for all such keys."""
    rows = [(k % 3 if k % 3 else None, k, k // 4 % 2) for k in range(90)]
    src, read = scratch_path(spark, "late-in"), []
    job = histories.History(spark, scratch_path(spark, "late"), ["k"], "at", tracked=["v"], tail=2)
    monkeypatch.setattr(histories, "scd2", lambda *a, **k: read.append(1) or scd2(*a, **k))
    ddl = "k long, at long, v long"
    for part in (rows[60:], rows[30:60], rows[:30]):
        spark.createDataFrame(part, ddl).write.mode("append").parquet(src)
        job.follow(runs.new_files(spark, src, "parquet", ddl))
    assert not read
    want = scd2(spark.createDataFrame(rows, ddl), ["k"], "at", None, ["v"], unique=False)
    assert Counter(map(tuple, job.table().collect())) == Counter(map(tuple, want.select(*job.table().columns).collect()))
    assert len(read) == 2  # the table was asked for twice
