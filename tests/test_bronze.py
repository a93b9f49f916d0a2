import json
import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from movie_data import AVATAR, movie, movies
from pyspark.sql import functions as F

from silverlake.sources.bronze import (
    ENOUGH,
    NOT_ENOUGH,
    UNREACHABLE,
    check_day,
    day_objects,
    inventory,
    object_schemas,
    read_objects,
    readiness,
    scan_day,
)


def land(df, root, key):
    df.coalesce(1).write.parquet(f"{root}/{key}")


def test_scan_takes_only_the_day(spark, root):
    land(movies(spark, AVATAR), root, "movies/movies_part_20221104-120000.parquet")
    land(movies(spark, movie(2, "b")), root, "movies/movies_part_20221105-120000.parquet")
    day = scan_day(spark, root, "movies", 20221105)
    assert rows(day.select("id")) == [(2,)]
    assert day.first().object_key.startswith("movies/movies_part_20221105-120000.parquet/")
    assert scan_day(spark, root, "movies", "20230101").isEmpty()


def test_scan_does_not_open_other_days(spark, root):
    for day in (20221104, 20221105, 20221106):
        land(movies(spark, AVATAR), root, f"movies/movies_part_{day}-120000.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = scan_day(spark, root, "movies", 20221105).select("id")
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        while node.children().size():
            node = node.children().apply(0)
        assert node.metrics().get("numFiles").get().value() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_the_root_does_not_count_as_part_of_the_key(spark, root):
    land(movies(spark, AVATAR), f"{root}/20221105", "movies/movies_part_20221104-120000.parquet")
    assert scan_day(spark, f"{root}/20221105", "movies", 20221105).isEmpty()


def test_inventory_and_readiness(spark, root):
    land(movies(spark, AVATAR), root, "movies/movies_part_20221104-120000.parquet")
    land(movies(spark, AVATAR), root, "movies/movies_part_20221104-130000.parquet")
    assert inventory(spark, root, ["movies", "credits"]).where(F.col("bytes") > 0).count() == 2
    status = readiness(spark, root, ["movies", "credits"], 20221104)
    assert rows(status) == [("credits", 0, NOT_ENOUGH), ("movies", 2, ENOUGH)]
    assert check_day(spark, root, ["movies", "credits"], 20221104) == ENOUGH
    assert check_day(spark, root, ["movies", "credits"], 20221105) == NOT_ENOUGH
    assert check_day(spark, f"{root}/nowhere", ["movies"], 20221104) == UNREACHABLE


def test_a_folder_named_as_its_prefix_below_the_day(spark, root):
    land(movies(spark, AVATAR), root, "movies/20221105/movies/obj.parquet")
    land(movies(spark, movie(2, "b")), root, "movies/a day/x+y_20221106%.parquet")
    assert check_day(spark, root, ["movies"], 20221105) == ENOUGH
    assert rows(scan_day(spark, root, "movies", 20221105).select("id")) == [(19995,)]
    day = scan_day(spark, f"file://{root}/", "movies", 20221106)
    assert day.first().object_key.startswith("movies/a day/x+y_20221106%.parquet/")


def test_objects_of_different_schema(spark, root):
    land(movies(spark, AVATAR), root, "movies/movies_part_20221104-120000.parquet")
    text = movies(spark, movie(2, "b")).withColumn("id", F.col("id").cast("string")).drop("tagline")
    land(text, root, "movies/movies_part_20221104-130000.parquet")
    day = scan_day(spark, root, "movies", 20221104)
    assert sorted((r.id, r.tagline) for r in day.collect()) == [("19995", ""), ("2", None)]


def test_pattern_narrows_the_listing(spark, root):
    land(movies(spark, AVATAR), root, "movies/movies_part_20221104-120000.parquet")
    land(movies(spark, AVATAR), root, "movies/movies_part_20221105-120000.parquet")
    assert inventory(spark, root, ["movies", "credits"], "*20221105*").count() == 1
    assert scan_day(spark, root, "movies", 20221105, "*20221105*").count() == 1
    assert scan_day(spark, root, "movies", 20221106, "*20221106*").isEmpty()


def test_a_folder_whose_files_differ(spark, root):
    """Written by two versions: a column more, and another type. Every file is read with its own columns."""
    folder = f"{root}/movies/movies_part_20221104-120000.parquet"
    spark.range(3).selectExpr("id", "'a' title").coalesce(1).write.parquet(folder)
    spark.range(3, 5).selectExpr("id", "'b' title", "1.5D score").coalesce(1).write.mode("append").parquet(folder)
    spark.range(5, 6).selectExpr("CAST(id AS STRING) id", "'c' title").coalesce(1).write.mode("append").parquet(folder)
    found = scan_day(spark, root, "movies", 20221104)
    assert rows(found.select("id", "title", "score")) == sorted(
        [("0", "a", None), ("1", "a", None), ("2", "a", None), ("3", "b", 1.5), ("4", "b", 1.5), ("5", "c", None)], key=str
    )


def test_schemas_of_objects(spark, root):
    df = spark.range(2).selectExpr("id", "named_struct('a', 1) deep", "array('x') list", "DATE '2020-01-01' day", "1.5BD money")
    df.coalesce(1).write.parquet(f"{root}/movies/with space+%.parquet")
    paths = [r["path"] for r in inventory(spark, root, ["movies"]).collect()]
    found = object_schemas(spark, root, paths).collect()
    assert {r.object_key.split("/")[1] for r in found} == {"with space+%.parquet"}
    types = {r.column: r.type for r in found}
    assert types["id"] == "long" and types["day"] == "date" and types["money"] == "decimal(2,1)"
    assert json.loads(types["deep"])["type"] == "struct" and json.loads(types["list"])["type"] == "array"


def test_files_of_other_writers(spark, root):
    """No Spark schema in the footer, and a type that Arrow gives and Spark's footer reading does not know."""
    os.makedirs(f"{root}/movies")
    pq.write_table(pa.table({"id": pa.array([1, 2], pa.int32()), "t": pa.array(["a", "b"])}), f"{root}/movies/x_20221104.parquet")
    pq.write_table(pa.table({"id": pa.array([3], pa.int32()), "u": pa.array([7], pa.uint8())}), f"{root}/movies/y_20221104.parquet")
    found = scan_day(spark, root, "movies", 20221104)
    assert rows(found.select("id", "t", "u")) == [(1, "a", None), (2, "b", None), (3, None, 7)]


def test_a_broken_object_is_told_by_name(spark, root):
    os.makedirs(f"{root}/movies")
    Path(f"{root}/movies/x_20221104.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="x_20221104"):
        scan_day(spark, root, "movies", 20221104).collect()


def test_all_footers_are_read_by_one_job(spark, root):
    for i in range(30):
        spark.range(i, i + 1).coalesce(1).write.parquet(f"{root}/movies/movies_part_20221104-{i:06}.parquet")
    paths = day_objects(spark, root, "movies", 20221104)
    tracker, group = spark.sparkContext.statusTracker(), "footers"
    spark.sparkContext.setJobGroup(group, "")
    try:
        assert read_objects(spark, root, paths).schema["id"].dataType.simpleString() == "bigint"
        assert len(tracker.getJobIdsForGroup(group)) <= 2  # AQE gives its shuffle a job of its own
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
