"""Version histories kept in state: a batch reads the keys it touched, and not the log of changes.

Per key the state holds the newest ``tail`` changes in order, and where the version around the oldest of them began. A micro-batch puts its
changes in their places, whatever their order of arrival, and emits only versions that began, ended or changed by that, and the
starts that are no more. Older changes leave the state with their versions closed.

Nothing is lost by that: all changes are landed in a log first, and a key that later gets a change older than its tail is from then on taken
from the log, as a whole and by the batch operator, when the table is read; a micro-batch only marks it. So state is bounded per key, no
micro-batch reads the log again, and a read does so once, for the keys that are long and got very late changes.

A version starts where a tracked column differs or after a delete and ends at the next version or delete; untracked columns show the last
change inside. Changes of a key with one sequence value are reduced to the largest. A change without a sequence has no place in a
history and is left out. NULL is a key like any other. Keys share the state of a group, so that a call of Python serves many of them; the number
of groups is written when the history is begun.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.changes import scd2
from millrace.operators.tables import latest_by
from millrace.streaming.once import bucket_count
from millrace.streaming.runs import batch_log, each_batch, land, new_files, table_stream, write_batch

STATE = "keys string"  # JSON: {key: [seq, row, tracked, gone, began, cut, late]}
GROUPS = 512  # a hundredth of the number of keys, or so
EMITTED = "key string, start bigint, end bigint, row string, removed boolean, rebuild boolean"
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
TAIL = 1000


def packed(cols: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), JSON)


def as_number(sequence: str, kind: T.DataType) -> Column:
    col = F.col(f"`{sequence}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return col.cast("bigint")
    raise ValueError(f"a sequence of type {kind.simpleString()} is not kept in state")


def from_number(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(col.cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(col).cast(kind)
    return col.cast(kind)


def _rank(value) -> tuple:
    """An order of JSON values of one type, NULL first."""
    if value is None:
        return (0,)
    if isinstance(value, list):
        return (1, [_rank(v) for v in value])
    if isinstance(value, dict):
        return (1, [_rank(v) for v in value.values()])
    return (1, value)


def larger(a: str, b: str) -> bool:
    if a == b:
        return False
    return _rank(json.loads(a, parse_float=Decimal)) > _rank(json.loads(b, parse_float=Decimal))


def versions(rows: list[tuple], began: int | None) -> dict[int, tuple[int | None, str]]:
    """{start: (end, row)} of changes (sequence, row, tracked, deleted) in order; ``began`` is where the first one's version began."""
    out: dict[int, tuple[int | None, str]] = {}
    start = tracked = None
    for k, (seq, row, now, gone) in enumerate(rows):
        if start is not None and (gone or now != tracked):
            out[start] = (seq, out[start][1])
            start = None
        if gone:
            continue
        if start is None:
            start, tracked = (began if k == 0 and began is not None else seq), now
        out[start] = (None, row)
    return out


def merged(rows: list[tuple], new: list[tuple]) -> list[tuple]:
    """Changes by sequence; of equal ones the largest row."""
    by = {r[0]: r for r in rows}
    for r in new:
        have = by.get(r[0])
        if have is None or larger(r[1], have[1]):
            by[r[0]] = r
    return [by[k] for k in sorted(by)]


def advanced(state: tuple | None, new: list[tuple], tail: int) -> tuple[tuple, list[tuple]]:
    """The state after some changes of its key, and what to emit: (start, end, row, removed, rebuild)."""
    seq, row, tracked, gone, began, cut, late = state if state is not None else ([], [], [], [], None, False, False)
    rows = list(zip(seq, row, tracked, gone))
    # the oldest change in state stands for those before it, so it must not change either
    late = bool(late) or bool(cut and any(r[0] < seq[0] or (r[0] == seq[0] and larger(r[1], row[0])) for r in new))
    if late:  # the log has it all
        return ([], [], [], [], None, True, True), [(None, None, None, False, True)]
    before = versions(rows, began)
    rows = merged(rows, new)
    after = versions(rows, began)
    emitted = [(s, e, r, False, False) for s, (e, r) in after.items() if before.get(s) != (e, r)]
    emitted += [(s, None, None, True, False) for s in before if s not in after]
    if len(rows) > tail:
        first = rows[-tail]
        around = [s for s in after if s <= first[0] and (after[s][0] is None or first[0] < after[s][0])]
        rows, cut, began = rows[-tail:], True, around[0] if around else None
    return (*([list(c) for c in zip(*rows)] or [[], [], [], []]), began, bool(cut), False), emitted


def changed_versions(stream: DataFrame, tail: int = TAIL, groups: int = GROUPS) -> DataFrame:
    """(key, start, end, row, removed, rebuild) after each micro-batch from (key, seq, row, tracked, gone)."""

    def fold(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        new: dict[str, list[tuple]] = {}
        for part in parts:
            for key, *row in zip(*(part[c].tolist() for c in ("key", "seq", "row", "tracked", "gone"))):
                new.setdefault(key, []).append(tuple(row))
        emitted = []
        for key, some in new.items():
            held[key], out = advanced(held.get(key), some, tail)
            emitted += [(key, *r) for r in out]
        state.update((json.dumps(held),))
        if emitted:
            out = np.empty((len(emitted), 6), object)  # objects, because a column of numbers with NULL would become floats
            out[:] = emitted
            yield pd.DataFrame(out, columns=["key", "start", "end", "row", "removed", "rebuild"], copy=False)

    grouped = stream.withColumn("grp", F.pmod(F.xxhash64("key"), F.lit(groups))).groupBy("grp")
    return grouped.applyInPandasWithState(fold, EMITTED, STATE, "append", GroupStateTimeout.NoTimeout)


class History:
    """One type 2 target: a log of changes, the state of its keys and the versions emitted so far.

    Where many changes share key and sequence, ``reduce_first`` reduces those of a batch to the largest in Spark, so that Python
    sees one row each.
    """

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], sequence: str, delete_when: str | None = None,
                 tracked: Sequence[str] | None = None, tail: int = TAIL, groups: int = GROUPS, reduce_first: bool = False):
        self.groups, self.reduce_first = groups, reduce_first
        self.spark, self.base, self.keys, self.sequence = spark, base, list(keys), sequence
        self.delete_when, self.tracked, self.tail = delete_when, tracked, tail

    def follow(self, changes: DataFrame) -> None:
        """Take in all that has arrived."""
        land(changes, f"{self.base}/log", f"{self.base}/checkpoints/log")
        log = table_stream(self.spark, f"{self.base}/log")
        if self.reduce_first:
            each_batch(log, self._reduce, f"{self.base}/checkpoints/reduced")
            log = new_files(self.spark, f"{self.base}/reduced/*", "parquet", log.schema)
        n = bucket_count(self.spark, f"{self.base}/groups", self.groups)
        each_batch(changed_versions(self._rows(log), self.tail, n), batch_log(f"{self.base}/emitted"), f"{self.base}/checkpoints/versions")

    def _reduce(self, df: DataFrame, batch_id: int) -> None:
        """The batch's largest change per key and sequence, which is all the state would keep of them."""
        placed = df.filter(F.col(f"`{self.sequence}`").isNotNull())
        write_batch(latest_by(placed, [*self.keys, self.sequence], []), f"{self.base}/reduced", batch_id)

    def _parts(self, schema: T.StructType) -> tuple[list[str], T.DataType]:
        return [c for c in schema.names if c not in self.keys and c != self.sequence], schema[self.sequence].dataType

    def _rows(self, log: DataFrame) -> DataFrame:
        rest, kind = self._parts(log.schema)
        gone = F.lit(False) if self.delete_when is None else F.coalesce(F.expr(f"({self.delete_when})"), F.lit(False))
        tracked = rest if self.tracked is None else list(self.tracked)
        return log.select(packed(self.keys).alias("key"), as_number(self.sequence, kind).alias("seq"), packed(rest).alias("row"),
                          packed(tracked).alias("tracked"), gone.alias("gone")).filter("seq IS NOT NULL")

    def _late_versions(self, late: DataFrame) -> DataFrame:
        """All versions of some keys from the log."""
        log = self.spark.read.parquet(f"{self.base}/log")
        mine = log.withColumn("_key", packed(self.keys)).join(late.withColumnRenamed("key", "_key"), "_key", "left_semi")
        mine = mine.drop("_key").filter(F.col(f"`{self.sequence}`").isNotNull())
        return scd2(mine, self.keys, self.sequence, self.delete_when, self.tracked, unique=False)

    def table(self) -> DataFrame:
        """The versions as they stand."""
        schema = self.spark.read.parquet(f"{self.base}/log").schema
        rest, kind = self._parts(schema)
        emitted = self.spark.read.schema(f"{EMITTED}, batch_id int").parquet(f"{self.base}/emitted")
        rows, late = emitted.filter("NOT rebuild").drop("rebuild"), emitted.filter("rebuild").select("key").distinct()
        has_late = not emitted.filter("rebuild").isEmpty()
        if has_late:
            rows = rows.join(late, "key", "left_anti")
        newest = latest_by(rows, ["key", "start"], ["batch_id"]).filter("NOT removed")
        of = lambda names: T.StructType([schema[n] for n in names])
        read = newest.select(F.from_json("key", of(self.keys), JSON).alias("_k"), F.from_json("row", of(rest), JSON).alias("_r"), "start", "end")
        table = read.select(*[F.col(f"_k.`{c}`").alias(c) for c in self.keys], *[F.col(f"_r.`{c}`").alias(c) for c in rest],
                            from_number(F.col("start"), kind).alias("__START_AT"), from_number(F.col("end"), kind).alias("__END_AT"))
        return table.unionByName(self._late_versions(late).select(*table.columns)) if has_late else table
