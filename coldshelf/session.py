"""Session settings: UTC stamps, adaptive plans, fair sharing between tables,
and the lake catalog an archive writes to."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    # Stamps are UTC instants; the session zone must not shift them.
    "spark.sql.session.timeZone": "UTC",
    # Keeps min/max of the stamps in the footers, so files not yet due are skipped.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables archived at the same time share the executors.
    "spark.scheduler.mode": "FAIR",
}


def lake_catalog_conf(
    name: str,
    *,
    warehouse: str,
    catalog_impl: str | None = None,
    io_impl: str | None = None,
    catalog_class: str = "org.apache.iceberg.spark.SparkCatalog",
    default: bool = True,
) -> dict[str, str]:
    """Settings that register a lake catalog under ``name``.

    The implementation classes are inputs: nothing here talks to a cloud
    service. ``default=True`` makes it the session's default catalog.
    """
    prefix = f"spark.sql.catalog.{name}"
    conf = {prefix: catalog_class, f"{prefix}.warehouse": warehouse}
    if catalog_impl:
        conf[f"{prefix}.catalog-impl"] = catalog_impl
    if io_impl:
        conf[f"{prefix}.io-impl"] = io_impl
    if default:
        conf["spark.sql.defaultCatalog"] = name
    return conf


def warehouse_root(target_path: str) -> str:
    """Catalog warehouse for a table path: the ``iceberg/`` folder of its bucket."""
    parts = urlsplit(target_path)
    if not parts.scheme or not parts.netloc:
        raise ValueError(f"not a bucket path: {target_path!r}")
    return f"s3://{parts.netloc}/iceberg/"


def build_session(app_name: str = "coldshelf", conf: Mapping[str, str] | None = None) -> SparkSession:
    """Get or create a session with the base settings plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it. Only a local
    session, whose executors are this process, may do with a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="coldshelf-")


def fixed(df: DataFrame) -> DataFrame:
    """The rows as they are now: read once, the same at every later use, and
    still there when executors are lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
