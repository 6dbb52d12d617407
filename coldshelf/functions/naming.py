"""Names and addresses: archive targets, quoted identifiers, JDBC URL parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def target_database(connection: Column) -> Column:
    """Archive database of a connection."""
    return F.concat(F.lit("archive_"), connection)


def target_table(schema: Column, table: Column) -> Column:
    """Archive table of a source table."""
    return F.concat(schema, F.lit("_"), table)


def target_path(warehouse: Column, connection: Column, schema: Column, table: Column) -> Column:
    """Folder of a source table's archive; the warehouse may end in slashes."""
    root = F.rtrim(warehouse, F.lit("/"))
    return F.concat(F.concat_ws("/", root, connection, schema, table), F.lit("/"))


def catalog_safe(name: Column) -> Column:
    """The name with every character a session catalog rejects replaced by ``_``."""
    return F.regexp_replace(name, "[^A-Za-z0-9_]", "_")


def qualified_name(*parts: str | None) -> str:
    """Back-quoted dotted name, such as catalog, database and table."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def jdbc_name(*parts: str) -> str:
    """Double-quoted dotted name for the source database."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in parts)


def bucket(url: Column) -> Column:
    """Bucket of an object-store URL (the authority, so ``_`` is allowed)."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def jdbc_address(url: Column) -> Column:
    """Struct of host (lower case), port and database of a JDBC URL."""
    plain = F.replace(url, F.lit("jdbc:"), F.lit(""))
    authority = F.regexp_replace(F.try_parse_url(plain, F.lit("AUTHORITY")), "^.*@", "")
    host = F.regexp_replace(F.regexp_replace(authority, ":[0-9]*$", ""), r"^\[|\]$", "")
    port = F.regexp_extract(authority, ":([0-9]+)$", 1).try_cast("int")
    database = F.trim(F.try_parse_url(plain, F.lit("PATH")), F.lit("/"))
    return F.struct(F.lower(host).alias("host"), port.alias("port"), database.alias("database"))
