import pytest
from conftest import rows

from silverlake.operators.merge import dedupe_latest
from silverlake.plans.specs import TableSpec
from silverlake.sources import bucketed
from silverlake.sources.bucketed import merge_into_bucketed

SPEC = TableSpec("items", "items", ("id", "k"), (("id", "id", "string"), ("k", "k", "string"), ("v", "v", "int")))
SCHEMA = "id string, k string, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def name(spark):
    yield "bucketed_items"
    for table in ("bucketed_items", "bucketed_items__next"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_loads_and_merges(spark, root, name):
    merge_into_bucketed(frame(spark, ("1", "a", 1), ("2", "b", 2), (None, "n", 0)), name, SPEC, root)
    merge_into_bucketed(frame(spark, ("2", "b", 9), ("2", "b", 8), ("3", "c", 3), (None, "n", 0)), name, SPEC, root)
    expected = [("1", "a", 1), ("2", "b", 9), ("3", "c", 3), (None, "n", 0), (None, "n", 0)]
    assert rows(spark.table(name)) == sorted(expected, key=str)
    assert bucketed.bucket_count(spark, name, SPEC) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert not spark.catalog.tableExists(f"{name}__next")


def test_only_the_source_is_shuffled(spark, root, name):
    """One Exchange in the whole merge: that which finds the source's latest rows also serves the join."""
    merge_into_bucketed(spark.range(5000).selectExpr("CAST(id AS STRING) id", "'a' k", "1 v"), name, SPEC, root)
    size = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(size, "-1")
    try:
        source = dedupe_latest(frame(spark, ("7", "a", 2), ("x", "b", 2)), SPEC.keys, keys_complete=True)
        plan = bucketed.merged(source, name, SPEC, keys_complete=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(size)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") == 1
    above = plan.split("Exchange hashpartitioning")[0]
    assert "Bucketed: true" in above  # the target, on the other side of the join


def test_every_duplicate_rule(spark, root, name):
    data = frame(spark, ("1", "a", 1), ("1", "a", 2))
    merge_into_bucketed(data, name, SPEC, root, on_duplicate="keep")
    assert spark.table(name).count() == 2
    with pytest.raises(Exception, match="several source rows"):
        merge_into_bucketed(data, name, SPEC, root, on_duplicate="error")
    assert spark.table(name).count() == 2 and not spark.catalog.tableExists(f"{name}__next")
    merge_into_bucketed(frame(spark, ("1", "a", 7)), name, SPEC, root)
    assert rows(spark.table(name)) == [("1", "a", 7), ("1", "a", 7)]
    with pytest.raises(ValueError, match="on_duplicate"):
        merge_into_bucketed(data, name, SPEC, root, on_duplicate="first")


def test_buckets_are_the_tables_own(spark, root, name):
    merge_into_bucketed(frame(spark, ("1", "a", 1)), name, SPEC, root, buckets=3)
    merge_into_bucketed(frame(spark, ("1", "a", 2)), name, SPEC, root)
    assert bucketed.bucket_count(spark, name, SPEC) == 3
    with pytest.raises(ValueError, match="has 3 buckets"):
        merge_into_bucketed(frame(spark, ("1", "a", 2)), name, SPEC, root, buckets=5)
    other = TableSpec("items", "items", ("id",), SPEC.columns)
    with pytest.raises(ValueError, match="not by"):
        merge_into_bucketed(frame(spark, ("1", "a", 2)), name, other, root)


def test_a_merge_that_died_is_finished_or_forgotten(spark, root, name):
    """Between its two renames the finished table is taken up; before them what it wrote is dropped."""
    merge_into_bucketed(frame(spark, ("1", "a", 1)), name, SPEC, root)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__next")
    merge_into_bucketed(frame(spark, ("2", "a", 2)), name, SPEC, root)
    assert rows(spark.table(name)) == [("1", "a", 1), ("2", "a", 2)]
    bucketed._write(frame(spark, ("9", "z", 9)), f"{name}__next", SPEC, root, 4)
    merge_into_bucketed(frame(spark, ("3", "a", 3)), name, SPEC, root)
    assert rows(spark.table(name)) == [("1", "a", 1), ("2", "a", 2), ("3", "a", 3)]
