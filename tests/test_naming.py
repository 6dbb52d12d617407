from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from coldshelf.functions.naming import (
    bucket,
    catalog_safe,
    jdbc_address,
    jdbc_name,
    qualified_name,
    target_database,
    target_path,
    target_table,
)
from coldshelf.session import build_session, lake_catalog_conf, warehouse_root

URLS = [
    "jdbc:postgresql://db.example.org:5432/sales",
    "jdbc:postgresql://DB.Example.ORG:5432/sales/",
    "jdbc:postgresql://my_host:5432/sales",
    "jdbc:postgresql://host/sales",
    "jdbc:postgresql://user:secret@host:6000/sales",
    "jdbc:postgresql://[::1]:5432/sales",
    "jdbc:postgresql://host:5432",
]


@pytest.mark.parametrize("url", URLS)
def test_jdbc_address(spark, url):
    parts = urlsplit(url.replace("jdbc:", ""))
    row = spark.range(1).select(jdbc_address(F.lit(url)).alias("a")).first().a
    assert (row.host, row.port, row.database) == (parts.hostname, parts.port, parts.path.strip("/"))


def test_address_of_nonsense_is_null(spark):
    row = spark.range(1).select(jdbc_address(F.lit("no url at all")).alias("a"), bucket(F.lit("s3:// x")).alias("b")).first()
    assert (row.a.host, row.a.port, row.b) == (None, None, None)


@pytest.mark.parametrize("url,expected", [("s3://my_bucket/a/b", "my_bucket"), ("s3://lake.temp", "lake.temp")])
def test_bucket(spark, url, expected):
    assert spark.range(1).select(bucket(F.lit(url))).first()[0] == expected
    assert warehouse_root(url) == f"s3://{expected}/iceberg/"


def test_warehouse_root_needs_a_bucket():
    with pytest.raises(ValueError):
        warehouse_root("/local/path")


@pytest.mark.parametrize("warehouse", ["s3://lake", "s3://lake/", "s3://lake//"])
def test_targets(spark, warehouse):
    c, s, t = F.lit("shop_dev"), F.lit("public"), F.lit("orders")
    row = spark.range(1).select(target_database(c), target_table(s, t), target_path(F.lit(warehouse), c, s, t)).first()
    assert tuple(row) == ("archive_shop_dev", "public_orders", "s3://lake/shop_dev/public/orders/")


def test_quoting(spark):
    assert qualified_name("lake", "db", "t") == "`lake`.`db`.`t`"
    assert qualified_name(None, "d`b", "t") == "`d``b`.`t`"
    assert jdbc_name("public", 'a"b') == '"public"."a""b"'
    assert spark.range(1).select(catalog_safe(F.lit("a-b c.ü_1"))).first()[0] == "a_b_c___1"


def test_lake_catalog_conf():
    conf = lake_catalog_conf("lake", warehouse="s3://b/iceberg/", catalog_impl="x.Catalog", io_impl="x.IO")
    assert conf == {
        "spark.sql.catalog.lake": "org.apache.iceberg.spark.SparkCatalog",
        "spark.sql.catalog.lake.warehouse": "s3://b/iceberg/",
        "spark.sql.catalog.lake.catalog-impl": "x.Catalog",
        "spark.sql.catalog.lake.io-impl": "x.IO",
        "spark.sql.defaultCatalog": "lake",
    }
    assert "spark.sql.defaultCatalog" not in lake_catalog_conf("lake", warehouse="w", default=False)


def test_session_uses_utc(spark):
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.scheduler.mode") == "FAIR"
