"""What the operators need from the session: their own code on the workers, and shared scratch tables."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Hands this package to the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_coldshelf_shipped", False):
        return
    # The driver serves this file to the executors itself, so its place is its own affair.
    target = Path(tempfile.mkdtemp(prefix="coldshelf-")) / f"{PACKAGE.name}_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(target))
    context._coldshelf_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path in the shared folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent, as in tests, a folder of this machine takes its place,
    which only a local session may use.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(context, "_coldshelf_folder", None)
        if base is None:
            base = context._coldshelf_folder = tempfile.mkdtemp(prefix="coldshelf-shared-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark's own setting that deletes a query's shuffle files when the query has ended.
_SPENT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Spark's own setting of the rows that a Python worker is handed at a time.
_HANDED = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, spent: bool = False, handed: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors.

    With ``spent`` the shuffle files that it took go at once, not when the frame is forgotten.
    With ``handed`` Python workers get so many rows at a time, or fewer if the session says so;
    the executor and the worker each hold such a batch whole.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    settings = {_SPENT: "true"} if spent else {}
    if handed is not None:
        usual = int(spark.conf.get(_HANDED))
        settings[_HANDED] = str(min(usual, handed) if usual > 0 else handed)  # 0 and less: no limit
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a small table that one file holds, about.
FILE_BYTES = 4 << 20


def few(df: DataFrame, rows: int, bytes_a_row: int) -> DataFrame:
    """``df`` in as many partitions as its rows take, by a count that they don't exceed.

    Never more than it has, nor fewer than the session works on at a time. What precedes the
    last shuffle keeps its tasks.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows * bytes_a_row // FILE_BYTES))
    return df.coalesce(min(parts, 1 << 30))


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` whose worker gives its free memory back when a task ends.

    Workers live on between the stages of an application, and what one stage has freed would
    otherwise count against the next.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def release() -> None:
    """Returns the worker's free memory to the system, where the platform has a way to."""
    gc.collect()
    trimmed(None)


def trimmed(result):
    """``result``, with the memory that was freed on the way given back; for functions of groups."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    return result


def rested(spark: SparkSession) -> None:
    """Has idle workers give their free memory back: a few empty tasks for every core.

    Stages of other kinds leave memory with the workers that they shared; a pipeline does this
    between its stages.
    """

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch

    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(lean(run), "id long").write.format("noop").mode("overwrite").save()


def extended(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with more columns."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def carried(docs: DataFrame) -> DataFrame:
    """``docs`` as two columns, text and all others in doc, so that new columns cannot clash with them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("doc"), "text")


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from rows that ``carried`` them."""
    return rows.select(*(F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns))
