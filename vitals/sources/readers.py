"""Readers with explicit schemas. None of them runs an action."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals import schemas
from vitals.functions.columns import conform, in_range, not_on


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    name_glob: str | None = None,
    skip_corrupt_files: bool = False,
) -> DataFrame:
    """JSON lines (plain or gzip) from a file, a directory or a glob.

    A malformed line gives NULLs. ``skip_corrupt_files`` keeps what could be read
    of a truncated archive; it is set on this read only, never on the session.
    """
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if skip_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    return reader.json(path)


def read_input(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: str,
    name_glob: str | None = None,
    skip_corrupt_files: bool = False,
) -> DataFrame:
    """The same data as JSON lines or as Parquet, with the same options."""
    if fmt == "json":
        return read_json_lines(spark, path, schema, name_glob, skip_corrupt_files)
    if fmt == "parquet":
        reader = spark.read
        if name_glob:
            reader = reader.option("pathGlobFilter", name_glob)
        if skip_corrupt_files:
            reader = reader.option("ignoreCorruptFiles", "true")
        return reader.parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unknown format: {fmt}")


def read_events(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "json",
    full: bool = False,
    name_glob: str | None = None,
    skip_corrupt_files: bool = False,
) -> DataFrame:
    """Raw events. By default only the fields cleaning needs are decoded."""
    schema = schemas.RAW_EVENT if full else schemas.CLEANING_EVENT
    return read_input(spark, path, fmt, schema, name_glob, skip_corrupt_files)


def read_event_month(spark: SparkSession, folder: str, month: str, fmt: str = "json", **options) -> DataFrame:
    """One month (``YYYY-MM``) of hourly archives in a flat folder."""
    suffix = {"json": "json.gz", "parquet": "parquet"}.get(fmt, fmt)
    return read_events(spark, folder, fmt, name_glob=f"{month}-*.{suffix}", **options)


def read_models(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_input(spark, path, fmt, schemas.RAW_MODEL)


def read_hub_records(spark: SparkSession, path: str) -> DataFrame:
    """Hub API records as text lines, for ``cleaning.normalize_model_record``."""
    return spark.read.text(path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Curated repositories: one JSON array, spread over several lines."""
    return spark.read.schema(schemas.SEED).option("multiLine", True).json(path)


def read_package_downloads(spark: SparkSession, path: str) -> DataFrame:
    """Monthly downloads; the feed quotes the number, so it is read as text and cast."""
    raw = read_json_lines(spark, path, schemas.PACKAGE_DOWNLOADS)
    return raw.withColumn("downloads", F.expr("try_cast(downloads AS BIGINT)"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, typed; a header that disagrees with the schema is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_curated_repos(spark: SparkSession, path: str) -> DataFrame:
    """Repository list whose header must have ``repo_name``, at any position."""
    table = spark.read.option("header", True).csv(path)
    if "repo_name" not in table.columns:
        raise ValueError("the curated list needs a repo_name column")
    return table.select("repo_name")


def read_clean_events(
    spark: SparkSession,
    path: str,
    lo: date | str | None = None,
    hi: date | str | None = None,
    exclude: Iterable[date | str] = (),
    all_columns: bool = False,
) -> DataFrame:
    """Cleaned events, with partitions pruned by date range and excluded days.

    ``all_columns`` adds the cleaned columns an older dataset lacks, as NULLs.
    """
    events = spark.read.parquet(path)
    if all_columns:
        events = conform(events, [tuple(c.split()) for c in schemas.CLEAN_EVENT.split(",")])
    if lo is not None or hi is not None:
        events = events.filter(in_range(lo or "0001-01-01", hi or "9999-12-31"))
    return exclude_dates(events, exclude)


def exclude_dates(events: DataFrame, dates: Iterable[date | str]) -> DataFrame:
    """Drop days known to be incomplete."""
    dates = list(dates)
    return events.filter(not_on(dates)) if dates else events


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def read_table_or_path(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The catalog table when it exists (bucketed copies), else the Parquet path."""
    return spark.table(table) if spark.catalog.tableExists(table) else spark.read.parquet(path)


def union_optional(events: DataFrame, path: str) -> DataFrame:
    """Add a second dataset when its path exists; any other failure is raised."""
    try:
        extra = events.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if _is_missing(error):
            return events
        raise
    return events.unionByName(extra, allowMissingColumns=True)


def parse_lines(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSON text in a column (text files, message payloads) as typed columns.

    The generator keeps later filters above it. With a plain projection they
    would be pushed below and parse the text once more for every predicate.
    """
    return lines.select(F.inline(F.array(F.from_json(column, schema))))


# Compressed bytes handed to the decompressor at a time.
PIECE = 1 << 20


def archive_losses(spark: SparkSession, path: str | list[str], name_glob: str = "*.gz") -> DataFrame:
    """What a tolerant read of gzip archives keeps: ``path``, ``length``, ``rows`` read, and whether the
    archive ``ended_early``.

    The rows are those that ``read_json_lines(..., skip_corrupt_files=True)`` returns. An archive is whole
    if each of its gzip members reaches its end mark with a right checksum. A task holds one compressed archive,
    which is decompressed piece by piece.
    """
    lines = read_json_lines(spark, path, "type string", name_glob, skip_corrupt_files=True)
    kept = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    archives = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).option("recursiveFileLookup", True).load(path)

    def ends(content: bytes) -> bool:
        at = 0
        while at < len(content):
            member = zlib.decompressobj(wbits=31)
            try:
                while at < len(content) and not member.eof:
                    member.decompress(content[at : at + PIECE])
                    at += PIECE
            except zlib.error:
                return False
            if not member.eof:
                return False
            at = min(at, len(content)) - len(member.unused_data)
        return bool(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [ends(batch.column("content")[k].as_py()) for k in range(batch.num_rows)]
            early = pa.array([not w for w in whole], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), early], ["path", "length", "ended_early"])

    checked = archives.select("path", "length", "content").mapInArrow(run, "path string, length bigint, ended_early boolean")
    # One source writes file:/x, the other file:///x.
    same = F.regexp_replace("path", "^file:/+", "/") == F.regexp_replace("file", "^file:/+", "/")
    return checked.join(kept, same, "left").select("path", "length", F.coalesce("rows", F.lit(0)).alias("rows"), "ended_early")


def archive_hours(spark: SparkSession, folder: str, month: str) -> DataFrame:
    """Hours of a month (``YYYY-MM``) for which an archive was delivered, with its size: ``event_date``, ``hour``, ``length``.

    Names are ``YYYY-MM-DD-H.json.gz``. Only the folder is listed; no archive is opened.
    """
    named = spark.read.format("binaryFile").option("pathGlobFilter", f"{month}-*.json.gz").load(folder).select("path", "length")
    day, hour = (F.regexp_extract("path", r"([0-9]{4}-[0-9]{2}-[0-9]{2})-([0-9]{1,2})\.json\.gz$", i) for i in (1, 2))
    return named.select(day.cast("date").alias("event_date"), hour.cast("int").alias("hour"), "length")
