import shutil
from dataclasses import replace
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverlake.plans.specs import TableSpec, find
from silverlake.sources import silver
from silverlake.sources.catalog import merge_into_catalog
from silverlake.sources.silver import (
    read_silver,
    register_views,
    table_exists,
    upsert_table,
)

SPEC = TableSpec("items", "items", ("id", "k"), (("id", "id", "string"), ("k", "k", "string"), ("v", "v", "int")))
SCHEMA = "id string, k string, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_first_load_then_merge(spark, root):
    assert not table_exists(spark, root, "items")
    with pytest.raises(ValueError, match="does not exist"):
        read_silver(spark, root, SPEC)
    upsert_table(frame(spark, ("1", "a", 1), ("2", "b", 2), (None, "n", 0)), root, SPEC)
    assert table_exists(spark, root, "items") and not table_exists(spark, root, "item")
    upsert_table(frame(spark, ("2", "b", 9), ("3", "c", 3), (None, "n", 0)), root, SPEC)
    result = read_silver(spark, root, SPEC)
    assert rows(result) == sorted(
        [("1", "a", 1), ("2", "b", 9), ("3", "c", 3), (None, "n", 0), (None, "n", 0)], key=str
    )
    assert result.schema == SPEC.schema


def files_of(root, table="items"):
    """The table's data files by partition."""
    found = {}
    for path in Path(f"{root}/{table}").glob("silver_part=*/*.parquet"):
        found.setdefault(path.parent.name, set()).add(path.name)
    return found


@pytest.mark.parametrize("width", [7, 100_000])
def test_the_width_of_partitions_does_not_change_the_result(spark, root, width):
    spec = replace(SPEC, part_width=width, part_hashes=3)
    for first, last, v in ((-50, 400, 1), (300, 600, 2)):
        ids = "if(id % 2 = 0, CAST(id AS STRING), concat('tt', id))"
        upsert_table(spark.range(first, last).selectExpr(f"{ids} id", "'a' k", f"{v} v"), root, spec)
    result = read_silver(spark, root, spec)
    assert result.groupBy("v").count().orderBy("v").collect() == [(1, 350), (2, 300)]
    assert result.select("id").distinct().count() == 650


def test_a_merge_rewrites_only_the_partitions_it_touches(spark, root):
    """A hundred neighbouring keys into two million rows."""
    many = spark.range(2_000_000).selectExpr("CAST(id AS STRING) id", "'a' k", "1 v")
    assert upsert_table(many, root, SPEC, keys_complete=True) == 2_000_000
    before = files_of(root)
    assert len(before) == 20
    few = spark.range(1_000_050, 1_000_150).selectExpr("CAST(id AS STRING) id", "'a' k", "2 v")
    assert upsert_table(few, root, SPEC, keys_complete=True) == 100_000
    after = files_of(root)
    assert {part for part in after if after[part] != before[part]} == {"silver_part=n100000-10"}
    result = read_silver(spark, root, SPEC)
    assert (result.count(), result.where("v = 2").count()) == (2_000_000, 100)


def test_new_keys_in_new_partitions_rewrite_nothing(spark, root):
    upsert_table(frame(spark, ("1", "a", 1), ("5", "b", 2)), root, SPEC)
    before = files_of(root)
    assert upsert_table(frame(spark, ("300000", "c", 3), (None, "n", 4)), root, SPEC) == 2
    after = files_of(root)
    assert {part: after[part] for part in before} == before and len(after) == 3
    assert read_silver(spark, root, SPEC).count() == 4


def test_the_target_is_pruned_by_the_partitions_of_the_source(spark, root, monkeypatch):
    """The plan of a merge: partitions are pruned at run time, and rows dealt out by partition are written once."""
    upsert_table(spark.range(0, 10**6, 1000).selectExpr("CAST(id AS STRING) id", "'a' k", "1 v"), root, SPEC)
    plans = []
    monkeypatch.setattr(silver, "_replace", lambda rows, *_: plans.append(rows._jdf.queryExecution().toString()) or 0)
    upsert_table(frame(spark, ("1", "a", 2)), root, SPEC)
    assert "dynamicpruning" in plans[0].split("== Physical Plan ==")[1]


def test_a_large_partition_is_split_over_tasks(spark, root):
    """One key in a third of the rows: its partition is written by several tasks."""
    size, whole = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(size, "32k")
    spark.conf.set(whole, "false")
    try:
        wide = spark.range(60_000).selectExpr("if(id % 3 = 0, '7', CAST(id * 100 AS STRING)) id", "CAST(id AS STRING) k", "1 v")
        upsert_table(wide, root, SPEC)
    finally:
        spark.conf.unset(size)
        spark.conf.unset(whole)
    assert len(files_of(root)["silver_part=n100000-0"]) > 2
    assert read_silver(spark, root, SPEC).count() == 60_000


def test_another_layout_is_refused(spark, root):
    upsert_table(frame(spark, ("1", "a", 1)), root, SPEC)
    for spec in (replace(SPEC, part_width=10), replace(SPEC, part_hashes=5)):
        data = frame(spark, ("1", "a", 1)) if spec.part_width == 10 else frame(spark, ("x", "a", 1))
        if spec.part_hashes == 5:
            upsert_table(frame(spark, ("x", "a", 1)), root, SPEC)
        with pytest.raises(ValueError, match="another part_width or part_hashes"):
            upsert_table(data, root, spec)
    assert read_silver(spark, root, SPEC).count() == 2


def test_latest_wins_also_on_first_load(spark, root):
    data = frame(spark, ("1", "a", 1), ("1", "a", 2)).withColumn("object_key", F.col("v").cast("string"))
    upsert_table(data, root, SPEC, order_by=["object_key"])
    assert rows(read_silver(spark, root, SPEC)) == [("1", "a", 2)]


def test_keep_leaves_duplicates_and_later_updates_all(spark, root):
    upsert_table(frame(spark, ("1", "a", 1), ("1", "a", 2)), root, SPEC, on_duplicate="keep")
    upsert_table(frame(spark, ("1", "a", 3)), root, SPEC)
    assert rows(read_silver(spark, root, SPEC)) == [("1", "a", 3), ("1", "a", 3)]


def test_failed_load_leaves_the_table_alone(spark, root):
    upsert_table(frame(spark, ("1", "a", 1)), root, SPEC)
    with pytest.raises(Exception, match="several source rows"):
        upsert_table(frame(spark, ("1", "a", 2), ("1", "a", 3)), root, SPEC, on_duplicate="error")
    assert rows(read_silver(spark, root, SPEC)) == [("1", "a", 1)]


def test_empty_loads(spark, root):
    assert upsert_table(frame(spark), root, SPEC) == 0
    assert table_exists(spark, root, "items") and read_silver(spark, root, SPEC).isEmpty()
    upsert_table(frame(spark, ("1", "a", 1)), root, SPEC)
    assert upsert_table(frame(spark), root, SPEC) == 0
    assert rows(read_silver(spark, root, SPEC)) == [("1", "a", 1)]


def test_a_load_that_is_repeated_changes_nothing(spark, root):
    """Also rows without a key, if the load has a name."""
    data = frame(spark, (None, "n", 1), ("4", "b", 2), ("4", None, 3))
    for number in (0, 0, 1, 0):
        upsert_table(data, root, SPEC, load=f"stream-{number}")
    assert rows(read_silver(spark, root, SPEC).where("id IS NULL OR k IS NULL").groupBy("v").count()) == [(1, 2), (3, 2)]
    assert read_silver(spark, root, SPEC).count() == 5


def test_a_job_that_dies_while_moving_is_put_right_by_the_same_load(spark, root):
    """Two of three partitions have been replaced, and the third is gone."""
    old = [(str(i), "a", 1) for i in range(0, 300_000, 50_000)]
    new = [(str(i), "a", 2) for i in range(0, 300_000, 100_000)]
    upsert_table(frame(spark, *old), root, SPEC)
    upsert_table(frame(spark, *new[:2]), root, SPEC)
    shutil.rmtree(f"{root}/items/silver_part=n100000-2")
    upsert_table(frame(spark, *new), root, SPEC)
    found = {r.id: r.v for r in read_silver(spark, root, SPEC).collect()}
    assert found == {i: v for i, _, v in old if i != "250000"} | {i: v for i, _, v in new}  # 250000 went with its partition


def test_views(spark, root):
    genres = find("genres")
    upsert_table(spark.createDataFrame([("1", 28, "Action")], genres.schema), root, genres)
    assert register_views(spark, root) == ["genres"]
    assert spark.sql("SELECT name FROM genres WHERE id = 28").first().name == "Action"


@pytest.fixture
def plain_table(spark, root):
    frame(spark, ("1", "a", 1)).write.option("path", f"{root}/plain").saveAsTable("plain_items")
    yield "plain_items"
    spark.sql("DROP TABLE plain_items")


def test_catalog_merge_needs_a_format_with_merge(spark, plain_table):
    data = frame(spark, ("1", "a", 1), ("1", "a", 2))
    with pytest.raises(PySparkException) as failure:
        merge_into_catalog(data, plain_table, SPEC)
    assert failure.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"
    with pytest.raises(ValueError, match="several source rows"):
        merge_into_catalog(data, plain_table, SPEC, on_duplicate="error")
    with pytest.raises(ValueError, match="on_duplicate"):
        merge_into_catalog(data, plain_table, SPEC, on_duplicate="first")


def test_catalog_table_is_created_from_one_row_per_key(spark, monkeypatch):
    """As far as it goes without a table format: what would be written."""
    written = []
    monkeypatch.setattr(spark.catalog.__class__, "tableExists", lambda *_: False)
    data = frame(spark, ("1", "a", 1), ("1", "a", 2))
    monkeypatch.setattr(
        type(data), "writeTo", lambda df, name: SimpleNamespace(create=lambda: written.append((name, rows(df))))
    )
    merge_into_catalog(data, "db.items", SPEC)
    assert written == [("db.items", [("1", "a", 2)])]


def test_a_first_load_shuffles_once(spark, root, monkeypatch):
    """The latest row of a key is found where the shuffle by partition has put it; the newest wins."""
    data = spark.range(3000).selectExpr("CAST(id % 1000 AS STRING) id", "'a' k", "CAST(id AS INT) v")
    plans, replace_ = [], silver._replace

    def seen(rows, *args, **how):
        plans.append(rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return replace_(rows, *args, **how)

    monkeypatch.setattr(silver, "_replace", seen)
    assert upsert_table(data, root, SPEC, order_by=["v"], keys_complete=True) == 1000
    # Before, one by key and another, a rebalance, by partition.
    assert plans[0].count("Exchange") == 1 and "Exchange hashpartitioning(silver_part" in plans[0]
    assert read_silver(spark, root, SPEC).where("v = 2000 + CAST(id AS INT)").count() == 1000
