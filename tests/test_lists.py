"""Lists that do not read well: what is counted, and what opens without a declared element."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from silverlake.functions import list_faults, open_elements, parse_list
from silverlake.functions.json_lists import _nothing_unread
from silverlake.operators.transform import list_losses, transform
from silverlake.plans.specs import find

ELEMENT = "id int, name string"
NOTHING = (0, 0, 0)

# text, what the declared element gives, (unreadable, not_a_list, bad_elements), what opens as (id, name)
EDGES = [
    (None, [(None, None)], NOTHING, [(None, None)]),
    ("", [(None, None)], NOTHING, [(None, None)]),
    (" \t", [(None, None)], NOTHING, [(None, None)]),
    ("[]", [(None, None)], NOTHING, [(None, None)]),
    ("null", [(None, None)], NOTHING, [(None, None)]),
    ("5", [(None, None)], (0, 1, 0), [(None, None)]),
    ('"x"', [(None, None)], (0, 1, 0), [(None, None)]),
    ('[{"id":1', [(None, None)], (1, 0, 0), [(None, None)]),
    ("not json", [(None, None)], (1, 0, 0), [(None, None)]),
    ('[{"id":1},]', [(None, None)], (1, 0, 0), [(None, None)]),
    ('{"id":1,"name":"a"}', [(1, "a")], NOTHING, [(1, "a")]),
    ('{"id":"x"}', [(None, None)], (0, 1, 1), [(None, None)]),
    ('[{"id":"x","name":"a"},{"id":2,"name":"b"}]', [(None, "a"), (2, "b")], (0, 0, 1), [(None, "a"), (2, "b")]),
    ('[{"id":"7"}]', [(None, None)], (0, 0, 1), [(7, None)]),
    ('[{"id":1.5}]', [(None, None)], (0, 0, 1), [(1, None)]),
    ('[{"id":99999999999}]', [(None, None)], (0, 0, 1), [(None, None)]),
    ('[{"name":"a","zz":[1]}]', [(None, "a")], NOTHING, [(None, "a")]),
    ('[{"id":null,"name":"u"}]', [(None, "u")], NOTHING, [(None, "u")]),
    ('[null,{"id":3,"name":"c"}]', [(None, None), (3, "c")], NOTHING, [(None, None), (3, "c")]),
    ('[5,{"id":3,"name":"c"}]', [(None, None)], (0, 0, 2), [(None, None), (3, "c")]),
    ('[[{"id":1}]]', [(None, None)], (0, 0, 1), [(None, None)]),
    ('[{"ID":1,"Name":"x"}]', [(None, None)], NOTHING, [(None, None)]),
    ("[{'id':4,'name':'q'}]", [(4, "q")], NOTHING, [(None, None)]),
    ('[{"id":1,"id":2}]', [(2, None)], NOTHING, [(None, None)]),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, e[0]) for i, e in enumerate(EDGES)], "n int, list string").repartition(3)


def test_declared_elements(edges):
    found = edges.selectExpr("n", f"inline_outer(from_json(list, 'array<struct<{ELEMENT.replace(' ', ':')}>>'))".replace(",:", ","))
    expected = [(n, *row) for n, e in enumerate(EDGES) for row in e[1]]
    assert rows(found) == sorted(expected, key=str)


def test_faults(edges):
    parsed = edges.select("n", "list", parse_list("list", ELEMENT).alias("parsed"))
    found = parsed.select("n", list_faults("list", parsed["parsed"], ELEMENT).alias("f")).select("n", "f.*")
    assert rows(found) == sorted([(n, *e[2]) for n, e in enumerate(EDGES)], key=str)


def test_open_elements(edges):
    found = open_elements(edges, "list", {"id": ("$.id", "int"), "name": ("$.name", "string")}).drop("list")
    expected = [(n, *row) for n, e in enumerate(EDGES) for row in e[3]]
    assert rows(found) == sorted(expected, key=str)


def test_open_elements_with_the_rest(spark):
    data = [(1, json.dumps([{"id": 1, "deep": {"a": [1, 2]}}, {"id": 2}]))]
    frame = spark.createDataFrame(data, "k int, list string")
    found = open_elements(frame, "list", {"second": ("$.deep.a[1]", "int")}, rest="all")
    assert rows(found.drop("list")) == [(1, 2, '{"deep":{"a":[1,2]},"id":1}'), (1, None, '{"id":2}')]
    with pytest.raises(ValueError, match="there already"):
        open_elements(frame, "list", {"K": ("$.id", "int")})


def test_an_opened_list_is_parsed_once(spark):
    frame = spark.createDataFrame([(1, "[]")], "k int, list string")
    fields = {f"c{i}": (f"$.c{i}", "int") for i in range(5)}
    plan = open_elements(frame, "list", fields)._jdf.queryExecution().executedPlan().toString()
    assert "variant_explode" in plan and plan.count("parseJson(list") <= 1


def test_losses_of_a_table(spark):
    genres = find("genres")
    lists = ['[{"id":1,"name":"a"}]', "[{", "7", '[{"id":"x","name":"b"},{"id":"y"}]', None]
    bronze = spark.createDataFrame(list(enumerate(lists)), "id int, genres string")
    assert rows(list_losses(bronze, genres)) == [("genres", 4, 1, 1, 2)]
    assert rows(list_losses(bronze.limit(0), genres)) == [("genres", 0, 0, 0, 0)]
    with pytest.raises(ValueError, match="no list"):
        list_losses(bronze, find("movies"))


def test_observing_changes_no_row(spark, edges):
    from pyspark.sql import Observation

    genres, counts = find("genres"), Observation()
    bronze = edges.selectExpr("n AS id", "list AS genres")
    observed = transform(bronze, genres, counts=counts)
    assert rows(observed) == rows(transform(bronze, genres))
    faults = [sum(e[2][i] for e in EDGES) for i in range(3)]
    assert counts.get == {"rows_in": len(EDGES), "unreadable": faults[0], "not_a_list": faults[1], "bad_elements": faults[2]}


def test_a_field_that_is_not_there_is_told_without_variants(spark):
    """The text names no field more often than it was read; anything doubtful is still parsed again."""
    element = "id int, name string"
    cases = [
        ('[{"id": 1, "name": "a"}, {"name": "b"}]', True, (0, 0, 0)),
        ('  [{"id": 1}, {"x": {"y": 2}, "id": 2}]', True, (0, 0, 0)),
        ('[{"id": "x", "name": "b"}]', False, (0, 0, 1)),
        ('[{"\\u0069d": "x", "name": "b"}]', False, (0, 0, 1)),
        ('[{"id": null, "name": "a"}, {"name": "b"}]', False, (0, 0, 0)),
        ('[{"name": "id"}, {"name": "b"}]', False, (0, 0, 0)),
        ('{"name": "b"}', False, (0, 1, 0)),
        # The number makes the whole list unreadable to from_json, so the record before it is lost as well.
        ('[{"name": "b"}, 5]', False, (0, 0, 2)),
        ('[{"other": 1}]', False, (0, 0, 0)),
    ]
    frame = spark.createDataFrame([(i, text) for i, (text, *_) in enumerate(cases)], "n int, list string")
    parsed = frame.select("n", "list", parse_list("list", element).alias("p"))
    quick = _nothing_unread(F.col("list"), F.col("p"), ["id", "name"])
    found = parsed.select(quick, list_faults("list", F.col("p"), element).alias("f"), "n").orderBy("n").collect()
    assert [(bool(q), tuple(f)) for q, f, _ in found] == [(quick, faults) for _, quick, faults in cases]
