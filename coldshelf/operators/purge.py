"""Removing an archive database with its tables and their data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from coldshelf.functions.naming import qualified_name
from coldshelf.sources.lake import catalog_entry, delete_files, is_inside, list_tables

_REPORT = "table_name string, location string, dropped boolean"


def purge(
    spark: SparkSession,
    database: str,
    roots: Iterable[str],
    *,
    dry_run: bool = True,
    catalog: str | None = None,
) -> DataFrame:
    """Drop every table of a database with its files, then the database.

    The default only reports what would go. ``roots`` are the warehouse folders
    archives may lie in: if any table lies elsewhere, or its catalog does not say
    where, nothing is dropped, whichever catalog it is. Views have no location and
    go first. Tables go one after another and the first failure stops the run, so
    what is left is what the report of a second call shows.
    """
    roots = list(roots)
    planned = []
    for row in list_tables(spark, database, catalog).toLocalIterator():
        name = qualified_name(catalog, database, row.table_name)
        entry = catalog_entry(spark, name)
        planned.append((row.table_name, name, entry.archive_path or entry.location, entry.is_view))
    strays = [f"{table} at {place}" for table, _, place, view in planned if not view and not _allowed(spark, place, roots)]
    if strays:
        raise ValueError(f"refusing to delete outside the warehouse: {', '.join(strays)}")
    if not dry_run:
        for _, name, folder, is_view in sorted(planned, key=lambda p: not p[3]):  # views read the tables
            spark.sql(f"DROP VIEW IF EXISTS {name}" if is_view else f"DROP TABLE IF EXISTS {name} PURGE")
            if folder and not is_view and catalog is None:
                # Dropping a table with a location of its own leaves its files; a lake
                # catalog owns the files of its tables and deletes them itself.
                delete_files(spark, folder)
        spark.sql(f"DROP DATABASE IF EXISTS {qualified_name(catalog, database)}")
    return spark.createDataFrame([(table, None if view else folder, not dry_run) for table, _, folder, view in planned], _REPORT)


def _allowed(spark: SparkSession, folder: str | None, roots: list[str]) -> bool:
    """Whether a table's files may be deleted; not if nobody can tell where they are."""
    return folder is not None and any(is_inside(spark, folder, root) for root in roots)
