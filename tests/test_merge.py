from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverlake.operators.merge import ambiguous_keys, dedupe_latest, upsert

SCHEMA = "id int, k string, v string"
KEYS = ["id", "k"]
TARGET = [(1, "a", "x"), (1, "a", "y"), (2, "b", "z"), (None, "n", "t")]
SOURCE = [(1, "a", "NEW"), (3, "c", "INS"), (3, "c", "INS2"), (None, "n", "SN")]


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("mode", ["error", "keep"])
def test_every_unmatched_row_is_added(spark, mode):
    result = upsert(frame(spark, TARGET), frame(spark, SOURCE), KEYS, on_duplicate=mode)
    expected = [
        (1, "a", "NEW"), (1, "a", "NEW"), (2, "b", "z"), (3, "c", "INS"), (3, "c", "INS2"),
        (None, "n", "t"), (None, "n", "SN"),
    ]
    assert rows(result) == sorted(expected, key=str)


def test_latest_takes_one_source_row(spark):
    result = upsert(frame(spark, TARGET), frame(spark, SOURCE), KEYS)
    assert Counter(rows(result))[(3, "c", "INS2")] == 1
    assert (3, "c", "INS") not in rows(result)


def test_ambiguous_match_fails_only_in_error_mode(spark):
    source = frame(spark, [*SOURCE, (1, "a", "NEW2")])
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(frame(spark, TARGET), source, KEYS, on_duplicate="error").collect()
    assert (1, "a", "NEW2") in rows(upsert(frame(spark, TARGET), source, KEYS))
    assert rows(ambiguous_keys(frame(spark, TARGET), source, KEYS)) == [(1, "a", 2)]


def test_order_by_a_column_the_target_lacks(spark):
    source = frame(spark, [(1, "a", "z", "obj1"), (1, "a", "b", "obj2")], SCHEMA + ", obj string")
    result = upsert(frame(spark, []), source, KEYS, order_by=["obj"])
    assert rows(result) == [(1, "a", "b")]


def test_columns_that_are_all_keys(spark):
    result = upsert(frame(spark, [(1, "a", "x")]), frame(spark, [(1, "a", "x"), (2, "b", "y")]), ["id", "k", "v"])
    assert rows(result) == [(1, "a", "x"), (2, "b", "y")]


def test_mistakes_are_named(spark):
    target = frame(spark, TARGET)
    with pytest.raises(ValueError, match="on_duplicate"):
        upsert(target, target, KEYS, on_duplicate="first")
    with pytest.raises(ValueError, match="missing"):
        upsert(target, target.drop("v"), KEYS)


def model(target, source):
    """The merge as plain dictionaries, for unique keys; null keys are kept apart."""
    merged = {r[0]: r for r in target if r[0] is not None}
    merged.update({r[0]: r for r in source if r[0] is not None})
    return Counter(merged.values()) + Counter(r for r in [*target, *source] if r[0] is None)


def side(unique):
    row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("pqr"))
    lists = st.lists(row, max_size=8)
    if not unique:
        return lists
    return lists.map(lambda rs: list({r[0]: r for r in rs if r[0] is not None}.values()) + [r for r in rs if r[0] is None])


PLANS = [
    {},
    {"source_unique": True},
    {"target_unique": True},
    {"source_unique": True, "target_unique": True},
]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=side(True), source=side(True))
def test_all_plans_agree_with_the_model(spark, target, source):
    t, s = frame(spark, target, "k int, v string"), frame(spark, source, "k int, v string")
    for plan in PLANS:
        assert Counter(map(tuple, upsert(t, s, ["k"], **plan).collect())) == model(target, source), plan


def test_merging_twice_changes_nothing(spark):
    t = frame(spark, [(1, "a", "x"), (2, "b", "y")])
    s = frame(spark, [(2, "b", "n"), (3, "c", "m")])
    once = upsert(t, s, KEYS)
    assert rows(upsert(once, s, KEYS)) == rows(once)


def test_dedupe_latest_equals_a_window(spark):
    data = spark.range(3000).select(
        F.expr("IF(id % 3 = 0, 7, id % 50)").cast("int").alias("k"),
        F.pmod(F.hash("id"), F.lit(20)).alias("o"),
        F.pmod(F.hash("id", F.lit(1)), F.lit(5)).cast("string").alias("v"),
    ).withColumn("k", F.expr("IF(k = 49, NULL, k)"))
    data.createOrReplaceTempView("dedupe_data")
    expected = spark.sql(
        """SELECT k, o, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o DESC, v DESC) AS n
           FROM dedupe_data) WHERE n = 1 AND k IS NOT NULL
           UNION ALL SELECT * FROM dedupe_data WHERE k IS NULL"""
    )
    assert rows(dedupe_latest(data, ["k"], ["o"])) == rows(expected)


def test_dedupe_combines_before_the_shuffle(spark):
    data = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    physical = dedupe_latest(data, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in physical.split("Exchange", 1)[1]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, many of them as exact copies."""
    many = spark.range(30_000).select(
        F.expr("IF(id % 3 = 0, 5, id % 1000)").cast("int").alias("k"),
        F.expr("IF(id % 3 = 0, 0, id)").alias("payload"),
    )
    one = spark.range(0, 2000, 5).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    return many, one


def test_a_hot_target_key_is_split(spark, skewed):
    """With thresholds for test-sized data, Spark deals the hot key's rows to several tasks."""
    many, _ = skewed
    source = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("payload"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        merged = upsert(many, source, ["k"], source_unique=True)
        assert merged.count() == many.count() + 2000
        plan = merged._jdf.queryExecution().executedPlan()
        merged.collect()
        assert "skew=true" in plan.toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def scans_and_shuffles(df):
    df.collect()
    physical = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return physical.count("FileScan"), physical.count("Exchange hashpartitioning")


def test_a_merge_into_a_unique_target_shuffles_each_side_once(spark, root):
    spark.range(5000).withColumn("v", F.lit(1)).write.parquet(f"{root}/t")
    spark.range(4000, 6000).withColumn("v", F.lit(2)).write.parquet(f"{root}/s")
    target, source = spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/s")
    merged = upsert(target, source, ["id"], target_unique=True)
    scans, shuffles = scans_and_shuffles(merged)
    assert scans <= 4 and shuffles <= 2
    assert merged.count() == 6000


def test_a_repeated_target_key_is_updated_in_every_copy(spark, skewed):
    many, _ = skewed
    source = spark.createDataFrame([(5, 1), (5_000, 2)], "k int, payload long")
    result = upsert(many, source, ["k"])
    assert result.where("k = 5").distinct().count() == 1
    assert result.count() == many.count() + 1
