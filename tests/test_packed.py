"""First loads, whose rows travel as packed batches of bronze columns."""

import datetime
import decimal
import json

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from silverlake.operators import packed
from silverlake.operators.packed import deal_out, first_of_each, packable
from silverlake.operators.transform import transform
from silverlake.plans.daily import retry_failed, run_day
from silverlake.plans.specs import TableSpec, find
from silverlake.sources import silver
from silverlake.sources.bronze import OBJECT_KEY, scan_day
from silverlake.sources.silver import RELEASE, dealt_by_key, read_silver, upsert_table

SPEC = TableSpec("items", "items", ("id", "k"), (("id", "id", "string"), ("k", "k", "string"), ("v", "v", "int")))
OBJECT = "{root}/credits/credits_part_20221104-{hour}0000.parquet"


def test_rows_come_out_as_they_went_in(spark):
    kinds = "s string, i int, l long, f float, d double, b boolean, x binary, t timestamp, n timestamp_ntz, y date, m decimal(20,3), e byte"
    at = datetime.datetime(1999, 12, 31, 23, 59, 59, 123456)
    some = ("Español \u0000 😀", -5, 2**62, 1.5, float("inf"), True, b"\xff\x00", at, at, at.date(), decimal.Decimal("1.500"), -7)
    data = spark.createDataFrame([some, (None,) * 12, ("", *some[1:])] * 700, kinds).repartition(3)
    assert packable(data.schema) and not packable(spark.range(1).selectExpr("array(id)").schema)
    number = F.pmod(F.xxhash64("s"), F.lit(7))
    dealt = deal_out(data, number, 7)
    assert dealt.schema == data.schema and rows(dealt) == rows(data)
    places = dealt.select(F.spark_partition_id().alias("at"), number.alias("to")).distinct().collect()
    assert places and all(r.at == r.to for r in places)


def test_a_task_sorts_out_a_bounded_number_of_rows_at_once(monkeypatch):
    monkeypatch.setattr(packed, "HELD", 4_000)
    monkeypatch.setattr(packed, "HANDED", 300)
    batches = [
        pa.RecordBatch.from_pydict({packed.TO: pa.array([j % 3 for j in range(100)], pa.int32()), "v": [f"{i}-{j}" for j in range(100)]})
        for i in range(20)
    ]
    sent = list(packed._pack(iter(batches)))
    assert len(sent) > 4 and all(b.num_rows == 3 and b[packed.TO].to_pylist() == [0, 1, 2] for b in sent)
    came = list(packed._unpack(iter(sent)))
    assert len(came) > 4 and all(b.num_rows < 600 for b in came)
    assert sorted(v for b in came for v in b["v"].to_pylist()) == sorted(v for b in batches for v in b["v"].to_pylist())
    assert list(packed._pack(iter([]))) == list(packed._unpack(iter([]))) == []


def test_a_key_that_goes_on_in_the_next_batch_begins_once():
    keys = [[("a", 1), ("a", 1)], [], [("a", 1), ("a", 2)], [("a", 2)], [("b", 2), (None, 2), (None, 2), ("b", None), ("b", None), ("c", 1)]]
    kind = pa.struct([("x", pa.string()), ("y", pa.int32())])
    arrays = [pa.array([dict(zip("xy", k, strict=True)) for k in batch], kind) for batch in keys]
    found = [a.to_pylist() for a in packed._begins(iter(arrays))]
    assert found == [[True, False], [], [False, True], [False], [True] * 6]


def test_the_first_of_each_key_without_a_shuffle(spark):
    data = spark.range(30_000).selectExpr("CAST(id % 1000 AS STRING) id", "if(id % 7 = 0, NULL, 'a') k", "CAST(id AS INT) v").coalesce(1)
    found = first_of_each(data, ["id", "k"], [F.desc("v")])
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
    expected = data.where("k IS NOT NULL").groupBy("id", "k").agg(F.max("v").alias("v")).union(data.where("k IS NULL"))
    assert rows(found) == rows(expected)


def credits(spark, root):
    """Two objects: names that change, people twice, no id, a movie in many rows, lists that do not read."""
    person = lambda c, name, **more: {"credit_id": c, "name": name, "id": 1} | more
    for hour, late in (("12", False), ("13", True)):
        data = []
        for i in range(0 if not late else 150, 300 if not late else 450):
            movie = None if i % 50 == 0 else f"tt{i}" if i % 9 == 0 else str(i * 1000 - 20_000)
            cast = [person(f"c{i % 4}", f"late {i}" if late else f"name {i}"), person(f"c{i % 3}", "twice"), person(None, "no credit", gender="x")]
            text = '[{"id": 1' if i % 11 == 0 else None if i % 13 == 0 else json.dumps(cast)
            data += [(movie, f"t{i}", text, "[]")] * (2 if i % 5 == 0 else 1)
        data += [("7", f"hot {late} {n}", json.dumps([person(f"c{n % 10}", f"n{n}")]), None) for n in range(400)]
        frame = spark.createDataFrame(data, "movie_id string, title string, cast string, crew string")
        frame.repartition(5).write.parquet(OBJECT.format(root=root, hour=hour))


@pytest.mark.parametrize("name", ["cast", "crew"])
def test_a_first_load_has_the_rows_and_counts_of_a_plain_one(spark, root, name):
    credits(spark, f"{root}/bronze")
    spec = find(name)
    log = run_day(spark, f"{root}/bronze", f"{root}/silver", 20221104, tables={name: spec}).first()
    source = transform(scan_day(spark, f"{root}/bronze", "credits", 20221104), spec, keep=[OBJECT_KEY])
    written = upsert_table(source, f"{root}/plain", spec, order_by=[OBJECT_KEY])
    assert rows(read_silver(spark, f"{root}/silver", spec)) == rows(read_silver(spark, f"{root}/plain", spec))
    assert (log["status"], log["rows_written"], log["rows_in"]) == ("written", written, scan_day(spark, f"{root}/bronze", "credits", 20221104).count())
    assert (log["lost"]["unreadable"] > 0) == (name == "cast")


def test_a_first_load_moves_lists_and_not_their_elements(spark, root, monkeypatch):
    """One exchange, of packed batches, before the lists are opened; the elements are not shuffled."""
    credits(spark, f"{root}/bronze")
    plans, replace_ = [], silver._replace

    def seen(data, *args, **how):
        plans.append(data._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return replace_(data, *args, **how)

    monkeypatch.setattr(silver, "_replace", seen)
    log = run_day(spark, f"{root}/bronze", f"{root}/silver", 20221104, tables={"cast": find("cast")})
    assert log.first()["status"] == "written"
    (plan,) = plans
    assert plan.count("Exchange") == 1 and "from_json" not in plan.split("Exchange")[1]
    assert plan.index("Generate inline") < plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("MapInArrow")


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_a_run_do_not_stay_on_disk(spark, root):
    credits(spark, f"{root}/bronze")
    before = shuffle_files(spark)
    log = run_day(spark, f"{root}/bronze", f"{root}/silver", 20221104, tables={n: find(n) for n in ("cast", "crew")})
    left = {name for name in shuffle_files(spark) - before if name.endswith(".data")}
    assert [r["status"] for r in log.collect()] == ["written"] * 2
    # The listing of objects may leave one; each table's own is gone.
    assert len(left) <= 1 and spark.conf.get(RELEASE, "false") == "false"


def test_a_retry_loads_as_a_first_load_does(spark, root):
    broken = OBJECT.format(root=f"{root}/bronze", hour="12")
    spark.range(1).selectExpr("'x' value").write.text(broken)
    tables = {"cast": find("cast")}
    run_id = run_day(spark, f"{root}/bronze", f"{root}/silver", 20221104, tables=tables).first()["run_id"]
    one = json.dumps([{"credit_id": "c", "id": 1, "name": "a"}])
    spark.createDataFrame([(1, "t", one, "[]")], "movie_id long, title string, cast string, crew string").write.mode("overwrite").parquet(broken)
    assert retry_failed(spark, f"{root}/bronze", f"{root}/silver", run_id, tables=tables).first()["rows_written"] == 1


def test_what_cannot_travel_packed_is_loaded_plainly(spark, root):
    data = spark.createDataFrame([("1", "a", 1, [1])], "id string, k string, v int, more array<int>")
    assert dealt_by_key(data, SPEC, 1) is not None
    assert dealt_by_key(data, SPEC, 1, keep=["more"]) is None
    by_number = TableSpec("m", "m", ("id",), (("id", "v", "double"),))
    assert dealt_by_key(data, by_number, 1) is None
    in_list = TableSpec("m", "m", ("name", "id"), (("id", "id", "string"),), "k", "name string")
    assert dealt_by_key(data, in_list, 1) is None


def test_a_key_that_a_sentinel_fills_before_the_lists_are_opened(spark):
    spec = TableSpec("m", "m", ("id", "name"), (("id", "id", "string"),), "k", "name string", ("id", "XX"))
    data = spark.createDataFrame([(None, f'[{{"name": "{n % 5}"}}]', n) for n in range(100)], "id string, k string, v int").repartition(4)
    dealt = dealt_by_key(data, spec, 1)
    assert dealt.select(F.spark_partition_id()).distinct().count() == 1
