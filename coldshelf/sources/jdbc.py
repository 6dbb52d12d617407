"""Reading source tables over JDBC: connections, inventory, partitioned scans."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldshelf.functions.naming import jdbc_name

POSTGRES_DRIVER = "org.postgresql.Driver"

# Types whose values can be compared in the database and written back as a
# literal without loss. Zoned timestamps and floats are left out.
_NUMBER_AND_TIME = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.DateType,
    T.TimestampNTZType,
)
_KEY_TYPES = (*_NUMBER_AND_TIME, T.StringType)

# A scan is split into parts of 5,000 to a million rows, if that makes no more
# than 20,000 parts.
_MIN_ROWS, _MAX_ROWS = 5_000, 1_000_000
_MAX_PARTITIONS = 20_000


@dataclass(frozen=True)
class Connection:
    """How to reach a source database. Credentials stay out of ``repr``."""

    url: str
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    driver: str = POSTGRES_DRIVER
    # Without a fetch size the PostgreSQL driver holds a whole result in memory.
    fetch_size: int = 10_000
    # The most connections one scan holds at a time; None leaves it to the cores.
    max_connections: int | None = None
    # False for databases that number rows only in the order of a subquery.
    window_order: bool = True
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    # The snapshot that its readers share, while one is held open.
    snapshot: str | None = None

    def login(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password}
        return {key: value for key, value in given.items() if value is not None}

    def options(self) -> dict[str, str]:
        options = {
            "url": self.url,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        return {**options, **self.login(), **self.properties}


def resolve_connection(spec: Mapping[str, str], env: Mapping[str, str] | None = None) -> Connection:
    """Connection from a config or registry entry.

    Takes a JDBC url with either ``username``/``password`` or the names of the
    environment variables that hold them (``user_env``/``password_env``).
    """
    env = os.environ if env is None else env
    if not spec.get("jdbc_url"):
        raise ValueError("a connection needs a jdbc_url")

    def secret(direct: str, variable: str) -> str | None:
        if spec.get(direct) is not None:
            return spec[direct]
        name = spec.get(variable)
        if name is None:
            return None
        if name not in env:
            raise ValueError(f"environment variable {name} is not set")
        return env[name]

    return Connection(
        url=spec["jdbc_url"],
        user=secret("username", "user_env"),
        password=secret("password", "password_env"),
        driver=spec.get("driver") or POSTGRES_DRIVER,
    )


def inventory(
    spark: SparkSession,
    connection: Connection,
    schemas: Sequence[str],
    relation: str = "information_schema.tables",
    **scan_options,
) -> DataFrame:
    """Tables and views of the listed schemas, as (table_schema, table_name).

    The schema test and the two-column projection run in the database.
    """
    if not schemas:
        raise ValueError("at least one schema must be listed")
    return (
        scan(spark, connection, relation, **scan_options)
        .filter(F.col("table_schema").isin(list(schemas)))
        .select(F.col("table_schema").alias("table_schema"), F.col("table_name").alias("table_name"))
    )


# The columns of each table's primary key, or else of its narrowest unique index without
# NULLs, conditions or expressions, in key order. Any account sees the index catalog.
_INDEX_KEYS = """
(SELECT k.table_schema, k.table_name, a.attname AS column_name, p.place AS ordinal_position
FROM (
  SELECT DISTINCT ON (c.oid) c.oid, n.nspname AS table_schema, c.relname AS table_name, i.indkey, i.indnkeyatts
  FROM pg_catalog.pg_index i
  JOIN pg_catalog.pg_class c ON c.oid = i.indrelid JOIN pg_catalog.pg_namespace n ON n.oid = c.relnamespace
  WHERE n.nspname IN ({schemas}) AND i.indisunique AND i.indisvalid AND i.indimmediate
    AND i.indpred IS NULL AND i.indexprs IS NULL
    AND NOT EXISTS (
      SELECT 1 FROM pg_catalog.pg_attribute o
      WHERE o.attrelid = c.oid AND o.attnum = ANY ((i.indkey::int2[])[0:i.indnkeyatts - 1]) AND NOT o.attnotnull
    )
  ORDER BY c.oid, i.indisprimary DESC, i.indnkeyatts, i.indexrelid
) k
CROSS JOIN LATERAL unnest(k.indkey::int2[]) WITH ORDINALITY AS p(attnum, place)
JOIN pg_catalog.pg_attribute a ON a.attrelid = k.oid AND a.attnum = p.attnum
WHERE p.place <= k.indnkeyatts) keys
"""


def primary_keys(spark: SparkSession, connection: Connection, schemas: Sequence[str]) -> DataFrame:
    """Key columns in key order: (table_schema, table_name, key_columns).

    PostgreSQL shows constraints to a table's owner and writers only, so there the keys come
    from the catalog of indexes, which an account that may only read sees too, and a table
    without a primary key has its narrowest unique one. Elsewhere they are the primary keys
    of the standard views.
    """
    if connection.driver == POSTGRES_DRIVER:
        usage = scan(spark, connection, _INDEX_KEYS.format(schemas=", ".join(map(literal, schemas))))
    else:
        usage = _constrained(spark, connection, schemas)
    # A key has at most a few dozen columns, so each list is small.
    column = F.struct("ordinal_position", "column_name")
    return (
        usage.groupBy("table_schema", "table_name")
        .agg(F.array_sort(F.collect_list(column)).alias("parts"))
        .select("table_schema", "table_name", F.col("parts.column_name").alias("key_columns"))
    )


def _constrained(spark: SparkSession, connection: Connection, schemas: Sequence[str]) -> DataFrame:
    """Columns of primary keys, from the standard views."""
    names = ["constraint_schema", "constraint_name", "table_schema", "table_name"]
    listed = F.col("table_schema").isin(list(schemas))
    constraints = (
        scan(spark, connection, "information_schema.table_constraints")
        .filter(listed & (F.col("constraint_type") == "PRIMARY KEY"))
        .select(*(F.col(n).alias(n) for n in names))
    )
    usage = (
        scan(spark, connection, "information_schema.key_column_usage")
        .filter(listed)
        .select(*(F.col(n).alias(n) for n in [*names, "column_name", "ordinal_position"]))
    )
    return usage.join(constraints, names)


def scan(
    spark: SparkSession,
    connection: Connection,
    relation: str,
    key_columns: Sequence[str] | None = None,
    unique_key: bool = False,
    rows_per_partition: int | None = None,
    sample_percent: float | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Whole table as a lazy DataFrame, one database query per partition.

    With ``key_columns`` the table is read in ranges of about equal row count
    (:func:`key_ranges`); without them, or if none of them can split it, it is
    one partition. ``options`` are passed to the reader (``customSchema`` for a
    bare numeric, for example).
    """
    ranges = []
    if key_columns:
        ranges = key_ranges(spark, connection, relation, key_columns, unique_key, rows_per_partition, sample_percent)
    return _read(spark, connection, relation, ranges, options)


def scan_table(
    spark: SparkSession,
    connection: Connection,
    schema: str,
    table: str,
    key_columns: Sequence[str] | None = None,
    unique_key: bool = False,
    rows_per_partition: int | None = None,
    sample_percent: float | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Whole source table, read by its quoted name.

    A PostgreSQL table that no key splits is read in ranges of its pages
    (:func:`page_ranges`) if its readers share a snapshot: without one, a row that is
    updated meanwhile moves to another page, and would be read twice or not at all.
    """
    relation = jdbc_name(schema, table)
    ranges = []
    if key_columns:
        ranges = key_ranges(spark, connection, relation, key_columns, unique_key, rows_per_partition, sample_percent)
    if not ranges and connection.driver == POSTGRES_DRIVER and connection.snapshot:
        ranges = page_ranges(spark, connection, relation)
    return _read(spark, connection, relation, ranges, options)


def _read(
    spark: SparkSession,
    connection: Connection,
    relation: str,
    ranges: Sequence[str],
    options: Mapping[str, str] | None,
) -> DataFrame:
    df = read_parts(spark, connection, relation, ranges, options)
    # A task reads its ranges one after another, on one connection at a time.
    return df.coalesce(connection.max_connections) if connection.max_connections and len(ranges) > 1 else df


def read_parts(
    spark: SparkSession,
    connection: Connection,
    relation: str,
    predicates: Sequence[str],
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a relation, one query for each predicate; all rows without any."""
    options = {**connection.options(), **(options or {})}
    if len(predicates) < 2 and list(predicates) in ([], ["1 = 1"]):
        return spark.read.format("jdbc").options(**options).option("dbtable", relation).load()
    url = options.pop("url")
    return spark.read.jdbc(url, relation, predicates=list(predicates), properties=options)


def page_ranges(
    spark: SparkSession, connection: Connection, relation: str, pages_per_partition: int = 32_768
) -> list[str]:
    """Predicates that split a PostgreSQL table by the pages its rows lie in.

    Balanced whatever the data, and planned without reading the table. Views
    and partitioned parents have no pages of their own and stay in one part. A row version
    that a snapshot shows stays where it is, so the parts are exact under one snapshot only.
    """
    if not connection.snapshot:
        raise ValueError("page ranges need readers that share a snapshot")
    size = f"SELECT pg_relation_size({literal(relation)}::regclass) / current_setting('block_size')::bigint AS pages"
    pages = query(spark, connection, size).first()[0] or 0
    starts = list(range(0, pages, pages_per_partition))
    predicates = [f"ctid >= '({low},0)'::tid AND ctid < '({high},0)'::tid" for low, high in zip(starts, starts[1:])]
    return [*predicates, *(f"ctid >= '({low},0)'::tid" for low in starts[-1:])]


def key_ranges(
    spark: SparkSession,
    connection: Connection,
    relation: str,
    key_columns: Sequence[str],
    unique_key: bool = False,
    rows_per_partition: int | None = None,
    sample_percent: float | None = None,
) -> list[str]:
    """Predicates that split a table into disjoint parts of bounded row count.

    Together they hold for every row exactly once, whatever rows arrive after
    planning: the outer ranges are open and NULL has a part of its own. Only
    the boundaries come to the driver, some ten thousand for the largest table.

    A single integer column that is a ``unique_key`` is cut into even strides
    between its ends: a stride of n keys holds at most n rows, so nothing has
    to be counted. Otherwise the boundaries are every n-th key, found in the
    database in one pass over the key's index, so gaps and clusters do not
    matter. A value that alone fills several parts (a hot key) is split again by
    the next key column, and after the last one by the table's other number and
    time columns. Key columns of other types (floats, zoned timestamps) are passed
    over; if that leaves none, there are no ranges.

    ``sample_percent`` looks for boundaries in a block sample of the table
    instead of all its keys (PostgreSQL). Parts get less even, no less whole.
    """
    columns = {f.name.lower(): f for f in scan(spark, connection, relation).schema.fields}
    key = [f for f in (columns[name.lower()] for name in key_columns) if isinstance(f.dataType, _KEY_TYPES)]
    if not key:
        return []
    others = [f for f in columns.values() if f not in key and isinstance(f.dataType, _NUMBER_AND_TIME)]
    names = [f.name for f in [*key, *others]]
    slots = spark.sparkContext.defaultParallelism
    if unique_key and len(key_columns) == 1 and _is_whole_number(key[0].dataType):
        strides = _even_strides(spark, connection, relation, names[0], slots, rows_per_partition)
        if strides:
            return strides
    share = 1.0 if sample_percent is None else sample_percent / 100
    looked_at = relation if sample_percent is None else f"{relation} TABLESAMPLE SYSTEM ({sample_percent})"
    planner = _RangePlanner(spark, connection, looked_at)
    if rows_per_partition is None:
        found = planner.measure(jdbc_name(names[0]), slots, share)
    else:
        planner.step = max(int(rows_per_partition * share), 1)
        found = None
    return list(planner.split(names, found=found))


def _is_whole_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0)


def _even_strides(
    spark: SparkSession, connection: Connection, relation: str, column: str, slots: int, rows: int | None
) -> list[str]:
    """Ranges of equal width over a unique integer column; none if its values
    lie so far apart that the width would say little about the rows."""
    name = jdbc_name(column)
    # One query per end: each is a single step into the index.
    ends = [query(spark, connection, f"SELECT {f}({name}) AS k FROM {relation}").first()[0] for f in ("MIN", "MAX")]
    if ends[0] is None:
        return []
    low, high = map(int, ends)
    span = high - low + 1
    stride = rows or min(max(span // slots, _MIN_ROWS), _MAX_ROWS)
    stride = max(stride, -(-span // _MAX_PARTITIONS))
    if stride > 50 * _MAX_ROWS:
        return []
    starts = list(range(low + stride, high + 1, stride))
    if not starts:
        return ["1 = 1"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(starts, starts[1:])]
    return [f"{name} IS NULL", f"{name} < {starts[0]}", *inner, f"{name} >= {starts[-1]}"]


class _RangePlanner:
    """Walks the key columns from left to right, splitting what is too large."""

    def __init__(self, spark: SparkSession, connection: Connection, relation: str):
        self.spark = spark
        self.connection = connection
        self.relation = relation
        self.step = 1

    def measure(self, name: str, slots: int, share: float) -> list:
        """Choose the step by looking at the keys, small steps first; returns the
        boundaries found on the way. Each look stops at its last boundary, so
        only the one that reaches the table's end reads all keys."""
        fine = max(int(_MIN_ROWS * share), 1)
        while len(found := self.boundaries(name, None, fine, fine * _MAX_PARTITIONS)) == _MAX_PARTITIONS:
            fine *= 20
        wanted = min(len(found) * fine // slots, int(_MAX_ROWS * share))
        every = max(wanted // fine, 1)
        self.step = fine * every
        return found[every - 1 :: every]

    def split(self, columns: Sequence[str], within: str | None = None, found: list | None = None) -> Iterator[str]:
        if not columns:
            # Rows alike in every column that could tell them apart.
            yield within or "1 = 1"
            return
        name, rest = jdbc_name(columns[0]), columns[1:]
        empty = both(within, f"{name} IS NULL")
        nulls = query(self.spark, self.connection, f"SELECT COUNT(*) AS n FROM {self.relation} WHERE {empty}")
        yield from self.split(rest, empty) if nulls.first()[0] > self.step else [empty]
        if found is None:
            found = self.boundaries(name, within, self.step)
        # A boundary found more than once is a value that fills several parts.
        low = f"{name} IS NOT NULL"
        for value, times in Counter(found).items():
            bound = literal(value)
            yield both(within, low, f"{name} < {bound}")
            low = f"{name} >= {bound}"
            if times > 1:
                yield from self.split(rest, both(within, f"{name} = {bound}"))
                low = f"{name} > {bound}"
        yield both(within, low)

    def boundaries(self, name: str, within: str | None, step: int, last: int | None = None) -> list:
        """Every ``step``-th value of a column, in the database's own order."""
        rows = f"{self.relation} WHERE {both(within, f'{name} IS NOT NULL')}"
        if self.connection.window_order:
            numbered = f"SELECT {name}, ROW_NUMBER() OVER (ORDER BY {name}) AS rn FROM {rows}"
        else:
            ordered = f"SELECT {name} FROM {rows} ORDER BY {name}"
            numbered = f"SELECT {name}, ROW_NUMBER() OVER () AS rn FROM ({ordered}) o"
        stop = f" AND rn <= {last}" if last else ""
        nth = f"SELECT {name}, rn FROM ({numbered}) q WHERE MOD(rn, {step}) = 0{stop}"
        found = query(self.spark, self.connection, nth).collect()
        return [value for value, _ in sorted(found, key=lambda row: row[1])]


def query(spark: SparkSession, connection: Connection, sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**connection.options()).option("query", sql).load()


def both(*tests: str | None) -> str:
    return " AND ".join(test for test in tests if test)


def literal(value) -> str:
    if isinstance(value, (int, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else str(value)
    if isinstance(value, dt.datetime):
        return f"CAST('{value.isoformat(sep=' ', timespec='microseconds')}' AS TIMESTAMP)"
    if isinstance(value, dt.date):
        return f"CAST('{value.isoformat()}' AS DATE)"
    return "'" + str(value).replace("'", "''") + "'"
