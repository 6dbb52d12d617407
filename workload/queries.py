"""Registered queries. Each runs over whole tables of ``sf_dir``."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from coldshelf.functions import retention
from coldshelf.functions.documents import lookup, string_map
from coldshelf.functions.naming import bucket, jdbc_address, qualified_name
from coldshelf.operators import discover as discovery
from coldshelf.operators import manifest as jobs
from coldshelf.operators import retire
from coldshelf.operators.archive import archive_table, ensure_database
from coldshelf.operators.manifest import ARGUMENTS
from coldshelf.operators.purge import purge
from coldshelf.operators.stamp import ADDED_AT, EXPIRES_AT, expiry, stamp, utc_now
from coldshelf.operators.validate import violations
from coldshelf.plans.fanout import append_run_log, archive_many, logged
from coldshelf.plans.pipeline import all_violations, run_archive
from coldshelf.sources.config import CONFIG_TYPE, read_configs, source_rows
from coldshelf.sources.jdbc import inventory, scan_table
from coldshelf.sources.lake import list_tables, read_archive
from coldshelf.sources.versions import reading
from coldshelf.streaming.requests import request_files, serve_requests
from workload.data import (
    HOT_KEY,
    SOURCE_SCHEMA,
    embedded,
    load,
    load_catalog,
    rewrite,
    scratch,
    source_database,
    table,
    unique,
)

RUN_TS = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
NTZ = "timestamp_ntz"
# Archives of orders: first and last day, time of the run, policy; and when they are looked at.
DATED = {
    "orders_old": (dt.date(1900, 1, 1), dt.date(1997, 1, 1), dt.datetime(1997, 1, 1), "1y"),
    "orders_middle": (dt.date(1997, 1, 1), dt.date(2000, 1, 1), dt.datetime(2000, 1, 1), "6m"),
    "orders_new": (dt.date(2000, 1, 1), dt.date(2100, 1, 1), dt.datetime(2001, 8, 2, 12), "10d"),
}
AS_OF = dt.datetime(2000, 6, 29)  # the very moment at which the middle one is due


# --- sources ---------------------------------------------------------------


def jdbc_scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    connection = source_database(spark, sf_dir, "orders")
    return scan_table(spark, connection, SOURCE_SCHEMA, "orders", key_columns=["o_orderkey"], unique_key=True)


def jdbc_scan_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key's first column has three values, each with about a third of the rows."""
    connection = source_database(spark, sf_dir, "lineitem")
    return scan_table(spark, connection, SOURCE_SCHEMA, "lineitem", key_columns=HOT_KEY)


def jdbc_archive_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a config to archived tables, read over JDBC by primary key."""
    names = ["customer", "orders", "supplier"]
    connection = source_database(spark, sf_dir, *names)
    if not spark.conf.get("spark.coldshelf.source.url", None):
        load_catalog(spark, connection, names)
    folder = scratch(spark, "jdbc_archive_run")
    key = unique("tpch") + "_dev"
    inline = {"jdbc_url": connection.url, "driver": connection.driver, "username": connection.user, "password": connection.password}
    config = Row(
        env="dev",
        connections={key: json.dumps({k: v for k, v in inline.items() if v is not None})},
        warehouses={"cold": folder},
        retention_policies={"half_year": "6m"},
        sources=[
            Row(
                name=source,
                connection=key,
                warehouse="cold",
                retention_policy="half_year",
                include=Row(schemas=[SOURCE_SCHEMA], tables=[pattern]),
                exclude=None,
            )
            for source, pattern in (("tpch", "(customer|orders|supplier)$"), ("nothing", "no_such_table"))
        ],
    )
    configs = spark.createDataFrame([("request", config, None)], f"config_id string, config {CONFIG_TYPE}, error string")
    statuses = run_archive(
        spark,
        configs,
        {},  # the config itself says how to connect
        run_ts=RUN_TS,
        ts_type=NTZ,
        database_root=folder,
    )
    return statuses.select("source_name", "source_schema", "source_table", "target_table", "row_count", "status")


def inventory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table stands in for the catalog view of a large database."""
    connection = embedded(spark, f"inventory:{sf_dir}")
    listed = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("TABLE_SCHEMA"), F.col("c_name").alias("TABLE_NAME")
    )
    load(spark, connection, listed, "INFORMATION_SCHEMA.TABLES")
    return inventory(spark, connection, ["BUILDING", "MACHINERY"], key_columns=["table_schema", "table_name"])


def config_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects as maps: keys by name and by column, missing ones with a default, JSON again."""
    props = string_map(F.col("props"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", props.alias("props"))
    found = lookup(F.col("props"), "k")
    key = F.when(F.col("event_type") == "error", "k").otherwise(F.col("event_type"))
    return events.select(
        "event_id",
        found.alias("k"),
        lookup(F.col("props"), key, F.lit("none")).alias("by_column"),
        F.to_json(F.struct(F.col("event_type").alias("name"), found.alias("value"))).alias("document"),
    )


# --- stamps and literals ---------------------------------------------------


def retention_stamp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(table(spark, sf_dir, "orders"), "6m", RUN_TS, NTZ)


def retention_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's user id as a length, in units good and bad."""
    unit = F.when(F.col("event_type") == "error", "w").otherwise(
        F.element_at(F.array(F.lit("d"), F.lit("M"), F.lit("y")), (F.col("event_id") % 3 + 1).cast("int"))
    )
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.col("user_id"), unit).alias("literal"))
    literal = F.col("literal")
    return events.select(
        "event_id",
        "literal",
        retention.is_retention_literal(literal).alias("well_formed"),
        retention.retention_days(literal).cast("bigint").alias("days"),
    )


def address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket of each page's address, and the parts of a JDBC URL made from it."""
    pages = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    port = (F.col("page_id") % 1000 + 5000).cast("string")
    jdbc = F.concat(F.lit("jdbc:postgresql://"), F.upper(host), F.lit(":"), port, F.lit("/db_"), "page_id", F.lit("/"))
    parts = jdbc_address(jdbc)
    return pages.select(
        "page_id",
        bucket(F.col("url")).alias("bucket"),
        parts["host"].alias("host"),
        parts["port"].cast("bigint").alias("port"),
        parts["database"].alias("database"),
    )


# --- archive tables --------------------------------------------------------


def archive_roundtrip_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archived(spark, table(spark, sf_dir, "lineitem"), "lineitem")


def archive_roundtrip_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamps are instants here, and shown in UTC."""
    stored = _archived(spark, table(spark, sf_dir, "embeddings"), "embeddings", ts_type="timestamp")
    return stored.select("vec_id", "label", F.posexplode("embedding").alias("position", "value"), ADDED_AT).select(
        "vec_id", "label", F.col("position").cast("bigint"), F.col("value").cast("double"), _utc(ADDED_AT).alias(ADDED_AT)
    )


def archive_default_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is given no time stamps its rows with its own."""
    before = utc_now()
    stored = _archived(spark, table(spark, sf_dir, "orders"), "orders", run_ts=None, ts_type="timestamp")
    added, span = F.col(ADDED_AT), F.unix_seconds(EXPIRES_AT) - F.unix_seconds(ADDED_AT)
    now = added.between(F.lit(before), F.lit(utc_now()))
    return stored.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bool_and(now).alias("stamped_now"),
        F.count_distinct(ADDED_AT).alias("times"),
        F.max(span / 86_400).cast("bigint").alias("days"),
    )


def archive_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run archives the table from itself, with another schema."""
    folder, database = scratch(spark, "archive_replace"), unique("archive_replace")
    target = {"database": database, "table": "orders", "path": f"{folder}/orders/", "ts_type": NTZ}
    place = {"database_root": folder}
    archive_table(table(spark, sf_dir, "orders"), policy="10d", run_ts=RUN_TS, **target, **place)
    newer = read_archive(spark, database, "orders").select(
        "o_orderkey", F.upper("o_orderstatus").alias("status"), F.col(ADDED_AT).alias("first_added_at"), ADDED_AT
    )
    archive_table(newer, policy="1Y", run_ts=RUN_TS + dt.timedelta(days=1), **target, **place)
    return read_archive(spark, database, "orders")


def archive_read_while_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader that opened a version sees after it has been replaced, and what the table holds then."""
    folder, database = scratch(spark, "archive_read"), unique("archive_read")
    target = {"database": database, "table": "orders", "path": f"{folder}/orders/", "policy": "10d", "ts_type": NTZ}
    place = {"database_root": folder, "run_ts": RUN_TS}
    orders = table(spark, sf_dir, "orders")
    archive_table(orders, **target, **place)

    def summary(df: DataFrame, version: str) -> DataFrame:
        counted = df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"), F.max("o_orderkey").alias("newest"))
        return counted.withColumn("version", F.lit(version))

    with reading(spark, database, "orders") as held:
        archive_table(orders.filter("o_orderstatus = 'F'"), **target, **place)
        summary(held, "held").write.parquet(f"{folder}/held")
    return spark.read.parquet(f"{folder}/held").unionByName(summary(read_archive(spark, database, "orders"), "current"))


def archive_many_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables that are there, one that is not, and two that would have the same target."""
    names = ["customer", "orders", "lineitem", "embeddings", "no_such_table"]
    shared = {"nation": "places", "region": "places"}
    statuses, _, _ = _archive_tables(spark, sf_dir, [*names, *shared], shared)
    return statuses.select("source_table", "target_table", "row_count", "status")


def archive_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ended after two of four tables, and is started again under its id."""
    folder, database, run = scratch(spark, "archive_resume"), unique("resume"), unique("run")
    ensure_database(spark, database, location=f"{folder}/database")
    log, connection = qualified_name(database, "runs"), unique("tables")
    names = ["customer", "orders", "part", "supplier"]
    for attempt, some in enumerate([names[:2], names], 1):
        resume = logged(spark, log, run) if attempt > 1 else None
        statuses, _, _ = _archive_tables(
            spark, sf_dir, some, place=(folder, connection), run_id=run, resume=resume, run_ts=RUN_TS + dt.timedelta(days=attempt)
        )
        append_run_log(statuses, log, f"{folder}/runs")
    stored = spark.table(log).filter(F.col("run_id") == run)
    return stored.select("source_table", "row_count", "status", _utc("added_at").alias("added_at"))


def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of an archive database, with the rows each holds."""
    names = ["nation", "part", "supplier", "documents"]
    _, database, _ = _archive_tables(spark, sf_dir, names, verify=True)
    rows = None
    for name in names:
        stored = read_archive(spark, database, f"{SOURCE_SCHEMA}_{name}")
        counted = stored.agg(F.count(F.lit(1)).alias("row_count"), F.max(EXPIRES_AT).alias("expires_at"))
        counted = counted.withColumn("table_name", F.lit(f"{SOURCE_SCHEMA}_{name}"))
        rows = counted if rows is None else rows.unionByName(counted)
    return list_tables(spark, database).join(rows, "table_name")


def archive_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs in one append-only log."""
    folder, database = scratch(spark, "archive_run_log"), unique("run_log")
    ensure_database(spark, database, location=f"{folder}/database")
    log = qualified_name(database, "runs")
    for names in (["orders", "events"], ["events"]):
        statuses, _, _ = _archive_tables(spark, sf_dir, names)
        append_run_log(statuses, log, f"{folder}/runs")
    return spark.table(log).select(
        "source_schema",
        "source_table",
        "retention_policy",
        _utc("added_at").alias("added_at"),
        _utc("expires_at").alias("expires_at"),
        "row_count",
        "status",
    )


def purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive, list what a purge would take, purge, and list what is left."""
    statuses, database, folder = _archive_tables(spark, sf_dir, ["customer", "orders", "pages"])
    planned = purge(spark, database, [folder])
    removed = purge(spark, database, [folder], dry_run=False)
    left = spark.catalog.databaseExists(database)
    return (
        planned.select("table_name", F.col("dropped").alias("dropped_by_listing"))
        .join(removed.select("table_name", "dropped"), "table_name")
        .join(statuses.select(F.col("target_table").alias("table_name"), "row_count"), "table_name")
        .withColumn("database_left", F.lit(left))
    )


# --- discovery, manifest, validation ---------------------------------------


def inventory_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("table_schema"), F.col("c_name").alias("table_name")
    )
    return discovery.filter_inventory(listed, ["BUILDING", "MACHINERY"], ["Customer#0+1", "(?P<n>Cust).*5"], [".*7", "x|.*9"])


def discovery_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _discovered(spark, sf_dir).select("source_name", "table_schema", "table_name")


def discovery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.discovery_counts(_inventory(spark, sf_dir), source_rows(_configs(spark, sf_dir)))


def discovery_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four documents for each source, however many tables it has."""
    return discovery.discovery_documents(_discovered(spark, sf_dir), documents=4)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.manifest(_discovered(spark, sf_dir)).select("source_name", *ARGUMENTS)


def manifest_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job arguments of all sources as JSON."""
    rows = jobs.manifest(_discovered(spark, sf_dir))
    return jobs.script_args(rows).select(F.to_json(F.struct("script_args")).alias("job"))


def manifest_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tables: brands hold a ``#``, names a blank, and many repeat."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.concat(F.lit("archive_"), "p_type").alias("target_glue_db"),
        F.concat_ws("_", "p_brand", "p_name", "p_size").alias("target_glue_table"),
    )
    return jobs.manifest_violations(rows)


def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One config per customer, each breaking the rules its values choose."""
    customer = table(spark, sf_dir, "customer")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    key = F.concat("c_name", F.when(segment == "BUILDING", "_prod").otherwise("_dev"))
    unit = F.when(nation >= 20, "w").otherwise("d")
    policies = F.create_map(F.lit("keep"), F.concat(nation.cast("string"), unit))
    schemas = F.when(nation == 7, F.array().cast("array<string>")).otherwise(F.array(segment))
    include = F.struct(schemas.alias("schemas"), F.array(F.lit("Customer.*")).alias("tables"))
    source = F.struct(
        F.col("c_name").alias("name"),
        F.when(nation == 3, "nobody").when(nation == 4, "").otherwise(key).alias("connection"),
        F.when(segment == "FURNITURE", "swamp").when(segment != "MACHINERY", "lake").alias("warehouse"),
        F.when(nation == 5, "lost").otherwise("keep").alias("retention_policy"),
        F.when(nation != 8, include).alias("include"),
        F.lit(None).cast("struct<tables:array<string>>").alias("exclude"),
    )
    lake = F.create_map(F.lit("lake"), F.lit("s3://cold-lake"))
    config = F.struct(
        F.when(segment != "AUTOMOBILE", "dev").alias("env"),
        F.create_map(key, F.lit("source_db")).alias("connections"),
        F.when(F.col("c_acctbal") >= 0, lake).alias("warehouses"),
        policies.alias("retention_policies"),
        F.array(source).alias("sources"),
    )
    present = F.when(F.col("c_acctbal") < 9500, config)
    configs = customer.select(F.col("c_custkey").alias("config_id"), present.cast(CONFIG_TYPE).alias("config"))
    return violations(configs)


def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """YAML files, some with a text where a list belongs, read and checked as a batch."""
    folder = scratch(spark, "config_scan")
    _request_texts(spark, sf_dir).write.partitionBy("request").text(f"{folder}/configs")
    configs = read_configs(spark, f"{folder}/configs/*/*.txt")
    return all_violations(configs).select(
        F.regexp_extract("config_id", "request=([^/]+)", 1).alias("request"), "rule", "subject"
    )


# --- request stream --------------------------------------------------------


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One YAML request per market segment and nation, computed from the customers. Before
    the second pass those of three nations are edited in place; a third finds nothing new."""
    folder = scratch(spark, "request_stream")
    requests = _request_texts(spark, sf_dir, lists_only=True)
    requests.write.partitionBy("request").text(f"{folder}/requests")

    def handle(batch: DataFrame, run_id: str) -> None:
        # A batch given twice writes the same folder twice.
        rows = source_rows(batch).select("source_name", "connection", "warehouse_path", "retention_value", "include_tables")
        rows.write.mode("overwrite").parquet(f"{folder}/handled/{run_id}")

    for turn in range(3):
        if turn == 1:
            files = request_files(spark, f"{folder}/requests", "*.txt").filter(F.col("path").rlike("request=[a-z]+_[0-2]/"))
            for file in files.select("path", F.col("content").cast("string").alias("text")).collect():
                rewrite(spark, file.path, file.text.replace("s3://cold-lake/", "s3://colder-lake/"))
        served = serve_requests(spark, f"{folder}/requests", f"{folder}/checkpoint", handle, pattern="*.txt")
        served.awaitTermination()
    handled = spark.read.parquet(f"{folder}/handled/*")
    return handled.select(
        "source_name",
        "connection",
        "warehouse_path",
        F.col("retention_value").alias("retention"),
        F.element_at("include_tables", 1).alias("pattern"),
    )


# --- beyond copying: reading the stamps ------------------------------------


def expired_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stamped as of their own date, under a policy by priority."""
    return retire.expired(_dated_orders(spark, sf_dir), dt.datetime(1998, 1, 1))


def expiry_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    shipped = lineitem.withColumn(EXPIRES_AT, expiry(F.col("l_shipdate"), F.lit("1y"), NTZ))
    tables = {"orders": _dated_orders(spark, sf_dir), "lineitem": shipped}
    return retire.expiry_summary(tables, dt.datetime(1998, 1, 1))


def expired_in_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The due rows of three archives of orders; the scan skips the files of those that are not due."""
    found = [retire.expired(stored, AS_OF) for stored in _dated_archives(spark, sf_dir).values()]
    return reduce(DataFrame.unionByName, found)


def archive_expiry_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retire.expiry_summary(_dated_archives(spark, sf_dir), AS_OF)


def table_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "orders": (table(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf_dir, "events"), "ts"),
    }
    return retire.table_age(tables, "20y", dt.datetime(2022, 1, 1))


# --- shared parts ----------------------------------------------------------


def _request_texts(spark: SparkSession, sf_dir: str, lists_only: bool = False) -> DataFrame:
    """A config for each market segment and nation; the first nations' has a pattern where a list belongs."""
    customer = table(spark, sf_dir, "customer")
    groups = customer.groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("customers"), F.max("c_custkey").alias("newest")
    )
    name = F.concat_ws("_", F.lower("c_mktsegment"), "c_nationkey")
    pattern = F.concat(F.lit('".*'), "newest", F.lit('$"'))
    listed = F.concat(F.lit("["), pattern, F.lit("]"))
    tables = listed if lists_only else F.when(F.col("c_nationkey") < 5, pattern).otherwise(listed)
    lines = [
        F.lit("env: dev"),
        F.concat(F.lit("connections: {"), name, F.lit("_dev: customer_db}")),
        F.lit("warehouses:\n  lake: s3://cold-lake/"),
        F.concat(F.lit("retention_policies:\n  keep: "), F.col("customers").cast("string"), F.lit("d")),
        F.concat(F.lit("sources:\n  - name: "), name),
        F.concat(F.lit("    connection: "), name, F.lit("_dev")),
        F.lit("    warehouse: lake\n    retention_policy: keep\n    exclude: null"),
        F.concat(F.lit('    include: {schemas: ["'), "c_mktsegment", F.lit('"], tables: '), tables, F.lit("}")),
    ]
    return groups.select(name.alias("request"), F.concat_ws("\n", *lines).alias("value"))


def _utc(column: str) -> Column:
    """An instant as the wall clock time of UTC."""
    return F.convert_timezone(None, F.lit("UTC"), F.col(column).cast(NTZ))


def _archived(spark: SparkSession, df: DataFrame, name: str, **options) -> DataFrame:
    folder, database = scratch(spark, name), unique(f"archive_{name}")
    given = {"run_ts": RUN_TS, "ts_type": NTZ, **options}
    archive_table(df, database, name, f"{folder}/{name}/", "6m", database_root=folder, **given)
    return read_archive(spark, database, name)


def _archive_tables(
    spark: SparkSession,
    sf_dir: str,
    names: list[str],
    targets: dict[str, str] | None = None,
    place: tuple[str, str] | None = None,
    **options,
) -> tuple[DataFrame, str, str]:
    """Archive given tables at once: statuses, the database, its warehouse folder."""
    folder, connection = place or (scratch(spark, "warehouse"), unique("tables"))
    database = f"archive_{connection}"
    named = {n: (targets or {}).get(n, n) for n in names}
    rows = [
        ("tables", SOURCE_SCHEMA, n, connection, f"{folder}/{connection}/{SOURCE_SCHEMA}/{t}/", database, f"{SOURCE_SCHEMA}_{t}", "6m")
        for n, t in named.items()
    ]
    statuses = archive_many(
        spark,
        spark.createDataFrame(rows, ["source_name", *ARGUMENTS]),
        lambda row: table(spark, sf_dir, row.source_table),
        **{"run_ts": RUN_TS, "ts_type": NTZ, "database_root": folder, **options},
    )
    return statuses, database, folder


def _configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One config per nation, with its region as the warehouse and two sources."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.concat("n_name", F.lit("_dev"))

    def source(suffix: str, schemas: list[str], include: list[str], exclude: list[str]):
        def texts(values):
            return F.array(*map(F.lit, values)).cast("array<string>")

        return F.struct(
            F.concat("n_name", F.lit(suffix)).alias("name"),
            key.alias("connection"),
            F.col("r_name").alias("warehouse"),
            F.lit("keep").alias("retention_policy"),
            F.struct(texts(schemas).alias("schemas"), texts(include).alias("tables")).alias("include"),
            F.struct(texts(exclude).alias("tables")).alias("exclude"),
        )

    config = F.struct(
        F.lit("dev").alias("env"),
        F.create_map(key, F.concat(F.lit("db."), F.lower("n_name"))).alias("connections"),
        F.create_map("r_name", F.concat(F.lit("s3://"), F.lower("r_name"), F.lit(".archive//"))).alias("warehouses"),
        F.create_map(F.lit("keep"), F.concat((F.col("n_nationkey") + 1).cast("string"), F.lit("m"))).alias(
            "retention_policies"
        ),
        F.array(
            source("-picked", ["BUILDING", "MACHINERY"], ["Customer#0+1", ".*5$"], [".*7"]),
            source("-whole", ["FURNITURE", "FURNITURE"], [], []),
        ).alias("sources"),
    )
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(F.col("n_name").alias("config_id"), config.cast(CONFIG_TYPE).alias("config"))


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the tables of their nation's database."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.concat(F.lit("db."), F.lower("n_name")).alias("connection_value"),
        F.col("c_mktsegment").alias("table_schema"),
        F.col("c_name").alias("table_name"),
    )


def _discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.discover(_inventory(spark, sf_dir), source_rows(_configs(spark, sf_dir)))


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = F.when(F.col("o_orderpriority") == "1-URGENT", "1y").otherwise("6m")
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn(EXPIRES_AT, expiry(F.col("o_orderdate"), policy, NTZ))


def _dated_archives(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders in three archives, made at different times under different policies."""
    folder, database = scratch(spark, "dated"), unique("archive_dated")
    orders = table(spark, sf_dir, "orders")
    found = {}
    for name, (first, last, run_ts, policy) in DATED.items():
        some = orders.filter((F.col("o_orderdate") >= F.lit(first)) & (F.col("o_orderdate") < F.lit(last)))
        archive_table(some, database, name, f"{folder}/{name}/", policy, run_ts=run_ts, ts_type=NTZ, database_root=folder)
        found[name] = read_archive(spark, database, name)
    return found


QUERIES = {
    query.__name__: query
    for query in (
        jdbc_scan_orders,
        jdbc_scan_hot_key,
        jdbc_archive_run,
        inventory_scan,
        config_lookup,
        retention_stamp_orders,
        retention_days,
        address_parts,
        archive_roundtrip_lineitem,
        archive_roundtrip_arrays,
        archive_default_time,
        archive_replace,
        archive_read_while_replaced,
        archive_many_status,
        archive_resume,
        archive_listing,
        archive_run_log,
        purge_report,
        inventory_filter,
        discovery_result,
        discovery_counts,
        discovery_document,
        manifest,
        manifest_arguments,
        manifest_conflicts,
        config_violations,
        config_scan,
        request_stream,
        expired_rows,
        expiry_overview,
        expired_in_archives,
        archive_expiry_overview,
        table_age,
    )
}
