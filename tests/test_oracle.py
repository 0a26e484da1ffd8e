"""Every registered query against its check SQL, over whole tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracle import connect, difference
from faresettle.catalog import queries as registry, sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_check_sql():
    assert set(registry.queries()) == set(sql.check_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    result = registry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(result, duck.sql(sql.check_sql()[name]).df()) is None


def test_entry_is_the_whole_report(spark):
    report = entry.entry(spark)
    assert len(report.columns) == 32
    assert report.select("Type").toPandas()["Type"].is_monotonic_decreasing


def test_orders_of_any_day_are_in_the_report(spark, tmp_path):
    """Nothing bounds the days that the queries look at but the data."""
    for name in ("customer", "lineitem", "nation"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    late = orders.filter("o_orderstatus = 'F'").limit(1).withColumn("o_orderdate", F.lit("2005-05-05").cast(orders.schema["o_orderdate"].dataType))
    orders.unionByName(late).write.parquet(str(tmp_path / "orders.parquet"))
    report = registry.queries()["settlement_report"](spark, str(tmp_path))
    assert report.filter("TrxDate = '2005-05-05'").count() == 1
