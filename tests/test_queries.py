"""Every registered query against its SQL twin, on the smallest tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import connect, difference
from workloads import registry
from workloads.standins import bronze_root

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, oracle, name):
    assert difference(registry.QUERIES[name](spark, SF_DIR), oracle, registry.SQL[name]) == ""


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_result_is_empty(spark, oracle, name):
    assert oracle.execute(f"SELECT count(*) FROM ({registry.SQL[name]})").fetchone()[0] > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_only_the_prefix_that_is_asked_for_lands(spark, tmp_path):
    spark.createDataFrame(
        [(1, 2, 3, 4, 5.0, "N", "O", "1995-01-01")],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
        "l_returnflag string, l_linestatus string, l_shipdate string",
    ).withColumn("l_shipdate", F.to_date("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    # There is no table of orders here.
    root = bronze_root(spark, str(tmp_path), ["credits"])
    assert [p.name for p in Path(root.removeprefix("file:")).iterdir()] == ["credits"]
    assert bronze_root(spark, str(tmp_path), ["credits"]) == root
