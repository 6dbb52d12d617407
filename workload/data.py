"""Inputs of the registered queries: tables, scratch folders, a source database."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldshelf.functions.naming import jdbc_name
from coldshelf.session import shared_folder
from coldshelf.sources.jdbc import Connection
from coldshelf.sources.lake import resolve

SOURCE_SCHEMA = "main"
# Primary keys of the tables that are read over JDBC.
PRIMARY_KEYS = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "supplier": ["s_suppkey"],
}
# A key whose leading column has few values, each holding much of the table.
HOT_KEY = ["l_returnflag", "l_orderkey"]
_DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
_loaded: set[tuple[str, str, str]] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def rewrite(spark: SparkSession, path: str, text: str) -> None:
    """Give a file another content, under the same path."""
    fs, target = resolve(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def unique(name: str) -> str:
    """A catalog name no other run uses."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def source_database(spark: SparkSession, sf_dir: str, *names: str) -> Connection:
    """A database holding the named tables in schema ``main``.

    On a cluster it is the one whose URL the session names in
    ``spark.coldshelf.source.url``. In local mode it is an embedded database in
    memory, filled from the given tables; only this process can see it.
    """
    url = spark.conf.get("spark.coldshelf.source.url", None)
    if url:
        return Connection(
            url=url,
            user=spark.conf.get("spark.coldshelf.source.user", None),
            password=spark.conf.get("spark.coldshelf.source.password", None),
        )
    connection = embedded(spark, f"source:{sf_dir}")
    for name in names:
        if _mark(spark, connection, jdbc_name(SOURCE_SCHEMA, name)) in _loaded:
            continue
        keys = [PRIMARY_KEYS[name], *([HOT_KEY] if name == "lineitem" else [])]
        load(spark, connection, table(spark, sf_dir, name), jdbc_name(SOURCE_SCHEMA, name), keys)
    return connection


def embedded(spark: SparkSession, label: str) -> Connection:
    """An in-memory database of this process; no server and no port."""
    master = spark.sparkContext.master
    # The executors of ``local-cluster[...]`` are processes of their own.
    if not master.startswith("local[") and master != "local":
        raise RuntimeError(
            "executors cannot see this process's embedded database: "
            "set spark.coldshelf.source.url to a database the cluster can reach"
        )
    # Room for the tables' pages, as a database server has; read when it starts.
    spark._jvm.java.lang.System.setProperty("derby.storage.pageCacheSize", "100000")
    name = hashlib.md5(label.encode()).hexdigest()
    return Connection(
        url=f"jdbc:derby:memory:{name};create=true",
        driver=_DERBY,
        window_order=False,
        # Nothing writes while it is read, so readers need no row locks.
        properties={"sessionInitStatement": "SET CURRENT ISOLATION = UR"},
    )


def load(
    spark: SparkSession, connection: Connection, df: DataFrame, relation: str, keys: list[list[str]] = ()
) -> None:
    """Write a DataFrame to the embedded database, once per application, and
    index its keys as a source database would."""
    mark = _mark(spark, connection, relation)
    if mark in _loaded:
        return
    # The default text type of this database cannot be compared or sorted.
    texts = ", ".join(f"`{name}` VARCHAR(250)" for name, kind in df.dtypes if kind == "string")
    writer = df.write.format("jdbc").options(**connection.options()).option("batchsize", 5000)
    if texts:
        writer = writer.option("createTableColumnTypes", texts)
    writer.option("dbtable", relation).mode("overwrite").save()
    opened = spark._jvm.java.sql.DriverManager.getConnection(connection.url)
    for key in keys:
        columns = ", ".join(map(jdbc_name, key))
        opened.createStatement().execute(f"CREATE INDEX {jdbc_name(unique('by_key'))} ON {relation} ({columns})")
    opened.close()
    _loaded.add(mark)


def _mark(spark: SparkSession, connection: Connection, relation: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, connection.url, relation


def load_catalog(spark: SparkSession, connection: Connection, names: list[str]) -> None:
    """Give the embedded database the standard catalog views of its tables."""
    keys = [(SOURCE_SCHEMA, n, f"pk_{n}", c, i) for n in names for i, c in enumerate(PRIMARY_KEYS[n], 1)]
    usage = spark.createDataFrame(
        keys, "TABLE_SCHEMA string, TABLE_NAME string, CONSTRAINT_NAME string, COLUMN_NAME string, ORDINAL_POSITION int"
    ).withColumn("CONSTRAINT_SCHEMA", F.col("TABLE_SCHEMA"))
    constraints = (
        usage.select("TABLE_SCHEMA", "TABLE_NAME", "CONSTRAINT_SCHEMA", "CONSTRAINT_NAME")
        .distinct()
        .withColumn("CONSTRAINT_TYPE", F.lit("PRIMARY KEY"))
    )
    load(spark, connection, constraints.select("TABLE_SCHEMA", "TABLE_NAME"), "INFORMATION_SCHEMA.TABLES")
    load(spark, connection, constraints, "INFORMATION_SCHEMA.TABLE_CONSTRAINTS")
    load(spark, connection, usage, "INFORMATION_SCHEMA.KEY_COLUMN_USAGE")
