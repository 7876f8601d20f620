"""Helpers shared by the operators: input tables, batches of texts, and the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vitals

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows of which no label is learned: crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def slices(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``most_bytes`` (one row at least), which bounds
    what a task holds beside its input however long the texts are."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most_bytes // max(batch.nbytes, most_bytes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, which the session names in ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a session inside one process gets a folder of its own; any
    other must be told.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="vitals-shared-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read back: it is computed once, and
    a lost executor costs no more than reading it again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes the files of frames made by ``stored`` that nothing reads any more."""
    for df in frames:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Sends the library's code to the executors, once for each application, so that it need not
    be installed there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(vitals.__file__).parent
    file = Path(tempfile.mkdtemp(prefix="vitals-code-")) / "vitals_code.zip"
    with zipfile.ZipFile(file, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(file))
