"""Archive requests as a stream: each version of a config file is handled once.

A request is a file's arrival, not its path: a file that is written again is a new
request, however old its time stamp. What has arrived is found by listing the folder
against a ledger of the versions handled before, which lies beside the checkpoint; the
query's own source only says when to look.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coldshelf.session import fixed
from coldshelf.sources.config import parse_configs
from coldshelf.sources.lake import delete_files, qualify, resolve

_VERSION = ["path", "modificationTime", "length"]
_PLAN = "path string, modificationTime timestamp, length bigint, value string"
# The ledger is one table, partitioned by run and by the day on which a file was written.
_DAY = "string(to_date(modificationTime)) AS day"


def request_files(spark: SparkSession, folder: str, pattern: str = "*.yaml") -> DataFrame:
    """The versions of the files below a folder, with their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder)


def waiting_requests(
    spark: SparkSession, folder: str, ledger: str, pattern: str = "*.yaml", max_files: int | None = None
) -> DataFrame:
    """Versions that the ledger does not hold, oldest first; ``max_files`` of them at a time."""
    files = request_files(spark, folder, pattern).select(*_VERSION, F.expr(_DAY))
    if _exists(spark, ledger):
        handled = spark.read.schema(f"{_PLAN}, run string, day string").parquet(ledger)
        files = files.join(handled.select(*_VERSION, "day"), [*_VERSION, "day"], "left_anti")
    return files.orderBy("modificationTime", "path").limit(max_files) if max_files else files


def serve_requests(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    handle: Callable[[DataFrame, str], None],
    *,
    pattern: str = "*.yaml",
    max_files: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Start handling requests; ``handle`` gets the new configs and a run id.

    A run's requests, with their texts, are written down before they are handled: a
    batch interrupted by a failure is given to ``handle`` again, with the same texts
    and the same run id, which no other run of this or another stream has. Without a
    trigger, all waiting requests are handled and the query ends.
    """
    home = qualify(spark, checkpoint)
    ledger = f"{home}/requests"
    stream = hashlib.sha256(home.encode()).hexdigest()[:12]

    def look(_: DataFrame, batch: int) -> None:
        turn = 0
        while True:
            plan = f"{ledger}/run={batch}-{turn}"
            rows = _read_plan(spark, plan)
            if rows is None:
                rows = _plan(spark, folder, ledger, plan, pattern, max_files)
            if rows is None:
                return
            handle(parse_configs(rows, F.col("path"), F.col("value")), f"run_{stream}_{batch}_{turn}")
            turn += 1

    if trigger:
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    else:
        # A file of this call's own makes the query look once.
        tick = f"{home}/ticks"
        spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.mode("append").text(tick)
        ticks = spark.readStream.format("text").option("maxFileAge", "36500d").load(tick)
    return (
        ticks.writeStream.option("checkpointLocation", f"{home}/query")
        .foreachBatch(look)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _plan(spark, folder: str, ledger: str, plan: str, pattern: str, max_files: int | None) -> DataFrame | None:
    # A plan that a killed run has left half written was given to nobody.
    delete_files(spark, plan)
    new = fixed(waiting_requests(spark, folder, ledger, pattern, max_files))
    oldest = new.agg(F.min("modificationTime")).first()[0]
    if oldest is None:
        return None
    # Only files as young as the oldest new one are opened.
    files = request_files(spark, folder, pattern).filter(F.col("modificationTime") >= F.lit(oldest))
    rows = files.join(new, _VERSION, "left_semi").select(*_VERSION, F.col("content").cast("string").alias("value"), F.expr(_DAY))
    rows.write.partitionBy("day").parquet(plan)
    return _read_plan(spark, plan)


def _read_plan(spark: SparkSession, path: str) -> DataFrame | None:
    """Requests written down at a path; None unless all of them were."""
    if not _exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema(f"{_PLAN}, day string").parquet(path).drop("day")


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = resolve(spark, path)
    return fs.exists(target)
