"""Sinks. These are the library's only actions.

Every sink is idempotent: a re-run replaces exactly what it wrote before, so a
job that lost executors, or was run twice, leaves the same data.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions.columns import in_range
from vitals.session import shared_path


def write_raw(df: DataFrame, path: str, files: int, mode: str = "overwrite") -> None:
    """Parquet in a given number of files; the round-robin shuffle evens out their sizes."""
    df.repartition(files).write.mode(mode).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Unpartitioned Parquet in files of the advisory partition size."""
    df.hint("rebalance").write.mode(mode).parquet(path)


def write_events(
    df: DataFrame, path: str, mode: str = "overwrite", by: str = "event_date", replace: str = "days"
) -> None:
    """Parquet partitioned by day, replacing the days present in ``df`` or, with
    ``replace="all"``, whatever the path held.

    After the de-duplicating shuffle every task holds rows of every day, and a
    plain partitioned write would leave tasks x days small files. The rebalance
    hint groups rows by day and lets AQE split a day that is too large for one
    task, so files have the advisory size whatever the skew between days.
    """
    (
        df.hint("rebalance", by)
        .write.mode(mode)
        .option("partitionOverwriteMode", {"days": "dynamic", "all": "static"}[replace])
        .partitionBy(by)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, buckets: int = 256, key: str = "repo_name") -> int:
    """Bucketed and sorted table, so aggregations and joins by key need no shuffle.

    Hash repartitioning to the bucket count first makes one file per bucket
    instead of one per task and bucket. Rows are counted on their way into the table; raises
    if the table holds another number, else returns it.
    """
    written = Observation()
    (
        df.repartition(buckets, key)
        .observe(written, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    stored_rows = df.sparkSession.table(table).count()
    if stored_rows != written.get["rows"]:
        raise RuntimeError(f"{table} holds {stored_rows} rows of {written.get['rows']}")
    return stored_rows


def copy_range(src: DataFrame, path: str, lo: date | str, hi: date | str) -> None:
    """Copy a date range to its own dataset, replacing all of it; only its partitions are read."""
    write_events(src.filter(in_range(lo, hi)), path, replace="all")


def _report_ready(df: DataFrame, timestamp_format: str) -> DataFrame:
    """Both timestamp types in one text format; nested columns as JSON text."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, timestamp_format)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def export_csv(df: DataFrame, path: str, order: Sequence[str] = (), one_file: bool = True) -> None:
    """CSV with a header: one file for results of report size, with ``one_file=False`` a file for each task.

    ``coalesce`` comes after the aggregation's own shuffle, so only the result
    rows pass through the single writing task. Several files keep the order, too: each holds one range of it.
    """
    out = df.orderBy(*order) if order else df
    out = out.coalesce(1) if one_file else out
    out.write.mode("overwrite").option("header", True).csv(path)


def export_report(df: DataFrame, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """Report CSV with readable timestamps; nothing is collected to the driver."""
    export_csv(_report_ready(df, timestamp_format), path)


def export_metrics(row: DataFrame, path: str) -> None:
    """One-row aggregate as a metric,value CSV."""
    from vitals.functions.aggregates import metric_rows

    export_csv(metric_rows(row), path)


def sample_rows(df: DataFrame, columns: Sequence[str], n: int, order: Sequence = ()) -> DataFrame:
    """``n`` rows for a report: any when unordered, else the first by ``order``."""
    rows = df.orderBy(*order) if order else df
    return rows.select(*columns).limit(n) if not order else rows.limit(n).select(*columns)


def write_era(df: DataFrame, path: str) -> DataFrame:
    """Per-era results as Parquet by era; re-running one era replaces only that era.

    Returns the stored table with all eras. It is read with the schema of
    ``df``, as an era without result rows leaves no file to take it from.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("era")
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write once and read back: the durable way to feed several later jobs. Replaces the path."""
    if by:
        write_events(df, path, by=by, replace="all")
    else:
        write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Frames stored in the shared folder for the length of a ``with`` block.

    They are deleted when it ends, also by an error, so nothing lazy that reads them may leave the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def stored(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        path = shared_path(self.spark, name)
        self.paths.append(path)
        return stored(df, path, by)

    def __exit__(self, *error: object) -> None:
        configuration = self.spark._jsc.hadoopConfiguration()
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(configuration).delete(path, True)
        self.paths.clear()
