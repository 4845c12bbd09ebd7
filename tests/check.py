"""Run registered queries against their DuckDB counterparts.

    python tests/check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0) if v != 0 else "0.0"
    return str(v)


def kind(v):
    return None if v is None else type(v).__name__


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = sorted(tuple(cell(r[i]) for i in order) for r in rows)
    kinds = [{kind(r[i]) for r in rows[:2000]} - {None} for i in order]
    return sorted(columns), values, kinds


def compare(name, df, con, sql):
    s_cols, s_rows, s_kind = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    d_cols, d_rows, d_kind = normal([c[0] for c in cur.description], cur.fetchall())
    if s_cols != d_cols:
        return f"columns {s_cols} != {d_cols}"
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} != {len(d_rows)}: {s_rows[:2]} / {d_rows[:2]}"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(s_cols, a, b) if x != y]
        return f"{len(bad)} of {len(s_rows)} rows differ, first: {cells[:4]}"
    for c, a, b in zip(s_cols, s_kind, d_kind):
        if a and b and a != b:
            return f"type of {c}: {a} != {b}"
    return None


def main(argv):
    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    import __spark_entry__ as entry
    if os.environ.get("CHECK_PLAIN_SESSION"):  # whatever settings Spark starts with
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from millrace.session import local_session
        spark = local_session(scratch=tempfile.mkdtemp(prefix="check-"))
    con = duck(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                error = compare(name, df, con, sqls[name])
                note = "ok" if error is None else "MISMATCH " + error
            else:
                n = len(df.collect())
                error = None if n else "no rows"
                note = f"rows-only {n}" if n else "NO ROWS"
        except Exception as e:
            error = str(e)
            note = "ERROR " + "".join(traceback.format_exception_only(e))[:700]
        bad += error is not None
        print(f"{name:44s} {time.time() - t0:6.1f}s {note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
