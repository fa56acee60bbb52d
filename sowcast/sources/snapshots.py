"""Tables that are replaced as a whole while others read them.

A new version of a table is written beside the old one and becomes visible only
when a line naming it is added to the root's publish log. Several tables
published together appear together, since their lines share one file, and a
reader who resolves several tables at once sees either all of the old or all of the
new versions. A job that fails before publishing leaves what readers see unchanged.
"""

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sowcast.operators.relational import row_counts
from sowcast.sources.tables import read_csv, read_table, write_csv, write_table

_LOG_SCHEMA = "sequence LONG, table_name STRING, format STRING, schema STRING, path STRING, row_count LONG, adds_to_earlier BOOLEAN"


@dataclass(frozen=True)
class Version:
    """A written but not necessarily published version of a table."""

    table: str
    path: str
    format: str
    schema: str
    row_count: int | None = None  # counted while it was written; older logs do not tell
    adds_to_earlier: bool = False  # a part of a table in parts, see read_parts

    def read(self, spark: SparkSession) -> DataFrame:
        if self.format == "csv":
            return read_csv(spark, self.path, self.schema)
        return read_table(spark, self.path, self.schema)


def new_run_id() -> str:
    return uuid.uuid4().hex


def write_version(
    df: DataFrame, root: str, table: str, run_id: str, format: str = "parquet", sort_by: Sequence[str] = ()
) -> Version:
    """Write a version of a table without showing it to readers. Its rows are counted in
    the same pass."""
    path = f"{root}/{table}/v={run_id}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    seen = Observation()
    df = (df.sortWithinPartitions(*sort_by) if sort_by else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    if format == "csv":
        write_csv(df, path, compression="gzip")  # an eighth of the bytes, in as many files as tasks
    else:
        write_table(df, path)
    # nothing is observed of a plan that is known to be empty
    return Version(table, path, format, columns, seen.get.get("rows", 0))


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG_SCHEMA).json(f"{root}/_published")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def publish(spark: SparkSession, root: str, versions: Sequence[Version]) -> None:
    """Show these versions to readers, all at once."""
    log = _log(spark, root)
    last = log.agg(F.max("sequence")).first()[0] if log is not None else None
    # by the clock, so that two publishers do not take the same number
    sequence = max((last or 0) + 1, time.time_ns())
    _append(spark, root, [(sequence, v.table, v.format, v.schema, v.path, v.row_count, v.adds_to_earlier) for v in versions])


def _append(spark: SparkSession, root: str, lines: list[tuple]) -> None:
    spark.createDataFrame(lines, _LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_published")


def _newest(log: DataFrame) -> DataFrame:
    latest = F.max(F.struct("sequence", "path", "format", "schema", "row_count")).alias("v")
    return log.groupBy("table_name").agg(latest).select("table_name", "v.*")


def read_all_published(spark: SparkSession, root: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    """The versions of several tables that were current at one moment."""
    return {t: version.read(spark) for t, version in _current(spark, root, tables).items()}


def _current(spark: SparkSession, root: str, tables: Sequence[str]) -> dict[str, Version]:
    log = _log(spark, root)
    wanted = _newest(log.where(F.col("table_name").isin(list(tables)))).collect() if log is not None else []
    found = {r.table_name: Version(r.table_name, r.path, r.format, r.schema, r.row_count) for r in wanted}
    if missing := [t for t in tables if t not in found]:
        raise LookupError(f"no published version of {', '.join(missing)} under {root}")
    return {t: found[t] for t in tables}


def published_counts(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """``table_name`` and ``row_count`` of several tables at one moment, as the log tells;
    only versions whose log does not tell are counted."""
    current = _current(spark, root, tables)
    told = [(t, v.row_count) for t, v in current.items() if v.row_count is not None]
    counts = spark.createDataFrame(told, "table_name STRING, row_count LONG")
    untold = {t: v.read(spark) for t, v in current.items() if v.row_count is None}
    return counts.unionByName(row_counts(untold)) if untold else counts


def read_parts(spark: SparkSession, root: str, tables: Sequence[str]) -> dict[str, dict[int, DataFrame]]:
    """Tables in parts as of one moment, each by the sequence in which its parts were
    published: the last whole version and all that were added since."""
    log = _log(spark, root)
    lines = log.where(F.col("table_name").isin(list(tables))).orderBy("sequence").collect() if log is not None else []
    found: dict[str, dict[int, Version]] = {t: {} for t in tables}
    for r in lines:
        if not r.adds_to_earlier:
            found[r.table_name].clear()
        found[r.table_name][r.sequence] = Version(r.table_name, r.path, r.format, r.schema, r.row_count)
    if missing := [t for t in tables if not found[t]]:
        raise LookupError(f"no published version of {', '.join(missing)} under {root}")
    return {t: {n: version.read(spark) for n, version in parts.items()} for t, parts in found.items()}


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The version of a table that was published last."""
    return read_all_published(spark, root, [table])[table]


def compact_log(spark: SparkSession, root: str) -> None:
    """Replace the log's files by one with the current versions, and those that they add
    to. Files that are published meanwhile stay; run it while no job is starting to read."""
    log = _log(spark, root)
    if log is None:
        return
    files = log.inputFiles()
    whole = log.where("NOT coalesce(adds_to_earlier, false)").groupBy("table_name").agg(F.max("sequence").alias("since"))
    needed = log.join(whole, "table_name", "left").where("since IS NULL OR sequence >= since").select(log.columns)
    _append(spark, root, [tuple(r) for r in needed.collect()])
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
