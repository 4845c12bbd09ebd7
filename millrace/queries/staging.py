"""Files written from the test tables, so that file sources and streams have something to read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.scratch import scratch_path

_written: dict[tuple[str, str, str], str] = {}


def staged(t, name: str, write: Callable[[str], None]) -> str:
    """Path of a staged copy, written once per session and table directory."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _written:
        path = scratch_path(t.spark, f"staged-{name}")
        write(path)
        _written[key] = path
    return _written[key]


_jobs: dict[tuple[str, str, str], object] = {}


def finished(t, name: str, run: Callable[[], object]):
    """A job that was run once per session and table directory, for queries on its several tables."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _jobs:
        _jobs[key] = run()
    return _jobs[key]


PART_BYTES = 8 << 20


def bytes_read(df: DataFrame) -> int:
    """Size of the files ``df`` reads."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def portions(df: DataFrame, least: int = 4, width: int = 1) -> int:
    """Parts for a table made from ``df``: one for so many bytes of the files it reads, so that parts do not grow with the data.

    ``width`` tells how many times as wide as usual its rows are.
    """
    return max(least, -(-bytes_read(df) * width // PART_BYTES))


def staged_as(t, name: str, df: DataFrame, fmt: str, files: int | None = None, **options) -> str:
    """A staged copy in ``files`` files, or in as many as ``portions`` says."""
    return staged(t, f"{name}-{fmt}",
                  lambda path: df.repartition(files or portions(df)).write.format(fmt).options(**options).save(path))


LARGE_BYTES = 48 << 20
SHARES = 4


def is_large(df: DataFrame) -> bool:
    """Whether what is made from ``df`` is made in shares and packed, so that it needs less disk."""
    return bytes_read(df) > LARGE_BYTES


def shares(df: DataFrame, keys: list[str]) -> list[DataFrame]:
    """A table in ``SHARES`` parts by a hash of ``keys``."""
    return [df.filter(F.pmod(F.xxhash64(*keys), F.lit(SHARES)) == k) for k in range(SHARES)]


def file_count(df: DataFrame) -> int:
    return len(df.inputFiles())


def slices(df: DataFrame, column: str, steps: int) -> list[DataFrame]:
    """The whole table in ``steps`` consecutive value ranges of a numeric column."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    edges = [lo + (hi - lo) * i / steps for i in range(steps)] + [hi]
    out = []
    for i in range(steps):
        upper = F.col(column) <= edges[i + 1] if i == steps - 1 else F.col(column) < edges[i + 1]
        out.append(df.filter((F.col(column) >= edges[i]) & upper))
    return out


def arrive(parts: list[DataFrame], path: str, fmt: str, run: Callable[[], None], **options) -> None:
    """Write one part after another into ``path`` and run the job after each arrival."""
    for part in parts:
        part.write.mode("append").format(fmt).options(**options).save(path)
        run()
