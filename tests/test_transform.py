import datetime
import json

import pytest
from conftest import rows
from movie_data import AVATAR, AVATAR_CREDITS, credits, movie, movies
from pyspark.sql import functions as F

from silverlake.functions import convert
from silverlake.operators.transform import keys_complete, lost_values, transform
from silverlake.plans.specs import MOVIE_TABLES, TableSpec, find

SCHEMAS = {
    "cast": "movie_id string, title string, cast_id int, character string, credit_id string, "
    "gender int, id int, name string",
    "crew": "movie_id string, title string, credit_id string, department string, gender int, "
    "id int, job string, name string",
    "movies": "movie_id string, title string, budget double, homepage string, "
    "original_language string, original_title string, overview string, popularity float, "
    "release_date date, revenue double, runtime int, status string, tagline string, "
    "vote_average float, vote_count int",
    "genres": "movie_id string, id int, name string",
    "keywords": "movie_id string, id int, name string",
    "production_companies": "movie_id string, id int, name string",
    "production_countries": "movie_id string, iso_3166_1 string, name string",
    "spoken_languages": "movie_id string, iso_639_1 string, name string",
}


def source(spark, name):
    if find(name).prefix == "credits":
        return credits(spark, AVATAR_CREDITS)
    return movies(spark, AVATAR)


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_schema(spark, name):
    result = transform(source(spark, name), find(name))
    got = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in result.schema)
    assert got == SCHEMAS[name]
    assert [f.dataType for f in find(name).schema] == [f.dataType for f in result.schema]


def test_there_are_eight_tables():
    assert sorted(MOVIE_TABLES) == sorted(SCHEMAS)


def test_movie_columns_come_from_themselves(spark):
    row = transform(movies(spark, AVATAR), find("movies")).first()
    assert (row.movie_id, row.budget, row.revenue, row.runtime) == ("19995", 2.37e8, 2787965087.0, 162)
    assert row.release_date == datetime.date(2009, 12, 10)
    assert row.popularity == pytest.approx(150.43758, abs=1e-4)
    assert (row.vote_count, round(row.vote_average, 4)) == (11800, 7.2)


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("genres", [("19995", 12, "Adventure"), ("19995", 28, "Action")]),
        ("keywords", [("19995", 1463, "culture clash")]),
        ("production_companies", [("19995", 289, "Ingenious Film Partners")]),
        (
            "production_countries",
            [("19995", "GB", "United Kingdom"), ("19995", "US", "United States of America")],
        ),
        ("spoken_languages", [("19995", "en", "English"), ("19995", "es", "Español")]),
        (
            "cast",
            [
                ("19995", "Avatar", 242, "Jake Sully", "5602a8a7c3a3685532001c9a", 2, 65731, "Sam Worthington"),
                ("19995", "Avatar", 3, "Neytiri", "0000000000", 1, 8691, "Zoe Saldana"),
            ],
        ),
        (
            "crew",
            [("19995", "Avatar", "52fe48009251416c750aca23", "Editing", 0, 1721, "Editor", "Stephen E. Rivkin")],
        ),
    ],
)
def test_lists(spark, name, expected):
    assert rows(transform(source(spark, name), find(name))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, [(-9999, None)]),
        ("", [(-9999, None)]),
        ("[]", [(-9999, None)]),
        ("null", [(-9999, None)]),
        ("5", [(-9999, None)]),
        ('[{"id":1', [(-9999, None)]),
        ('{"id":1,"name":"a"}', [(1, "a")]),
        ('[{"id":"x","name":"a"},{"id":2,"name":"b"}]', [(-9999, "a"), (2, "b")]),
        ('[{"id":"7","name":"a"}]', [(-9999, "a")]),
        ('[{"id":1.5,"name":"a"}]', [(-9999, "a")]),
        ('[{"id":99999999999,"name":"a"}]', [(-9999, "a")]),
        ('[null,{"id":3,"name":"c"}]', [(-9999, None), (3, "c")]),
        ('[{"ID":1,"Name":"a"}]', [(-9999, None)]),
        ('[{"id":1,"id":2,"name":"a"}]', [(2, "a")]),
        ('[{"name":"a","other":1}]', [(-9999, "a")]),
    ],
)
def test_json_edges(spark, text, expected):
    result = transform(spark.createDataFrame([(1, text)], "id bigint, genres string"), find("genres"))
    assert rows(result.select("id", "name")) == sorted(expected, key=str)


def test_null_country_gets_its_code(spark):
    bronze = movies(spark, movie(1, "a"), movie(2, "b", production_countries=[{"name": "Nowhere"}]))
    assert rows(transform(bronze, find("production_countries"))) == [("1", "XX", None), ("2", "XX", "Nowhere")]


@pytest.mark.parametrize(
    ("text", "kind", "expected"),
    [
        ("2.5", "int", 2),
        ("", "int", None),
        ("x", "int", None),
        ("1e3", "int", 1000),
        ("3e9", "int", None),
        ("", "double", None),
        ("2.37E8", "double", 2.37e8),
        ("7.5", "float", 7.5),
        ("2009-12-10", "date", datetime.date(2009, 12, 10)),
        ("", "date", None),
        ("10/12/2009", "date", None),
        ("2009-2-3", "date", None),
        ("2009-13-40", "date", None),
        ("2009-12-10 00:00:00", "date", None),
    ],
)
def test_casts(spark, text, kind, expected):
    data = spark.createDataFrame([(text,)], "v string")
    assert data.select(convert("v", kind)).first()[0] == expected


def test_typed_dates_convert_too(spark):
    data = spark.sql("SELECT DATE '2009-12-10' AS d, TIMESTAMP '2009-12-10 11:00:00' AS t")
    row = data.select(convert("d", "date"), convert("t", "date")).first()
    assert list(row) == [datetime.date(2009, 12, 10)] * 2


def test_lost_values(spark):
    bronze = movies(spark, AVATAR, movie(2, "b", release_date="10/12/2009", budget=None, runtime="x"))
    counts = {r.column: (r.present, r.lost) for r in lost_values(bronze, find("movies")).collect()}
    assert counts["release_date"] == (2, 1)
    assert counts["budget"] == (1, 0)
    assert counts["runtime"] == (2, 1)
    assert lost_values(bronze, find("genres")).count() == 0


def test_keys_complete(spark):
    bronze = movies(spark, AVATAR)
    assert keys_complete(bronze, find("movies")) and keys_complete(bronze, find("genres"))
    nulls = bronze.withColumn("id", F.lit(None).cast("bigint"))
    assert not keys_complete(nulls, find("movies")) and not keys_complete(nulls, find("genres"))
    cast_key = TableSpec("t", "t", ("k",), (("k", "title", "int"),))
    assert not keys_complete(bronze, cast_key)


def test_spec_mistakes_are_named():
    columns = (("k", "k", "string"),)
    with pytest.raises(ValueError, match="not columns"):
        TableSpec("t", "t", ("other",), columns)
    with pytest.raises(ValueError, match="repeated"):
        TableSpec("t", "t", ("k",), columns * 2)
    with pytest.raises(ValueError, match="does not fit"):
        TableSpec("t", "t", ("k", "id"), columns, "l", "id int", ("id", "XX"))
    with pytest.raises(ValueError, match="unknown table"):
        find("nothing")
    with pytest.raises(ValueError, match="no safe cast"):
        convert("k", "map")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_plan_reads_only_its_columns_without_shuffle(spark, root, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spec = find(name)
    source(spark, name).write.parquet(f"{root}/b")
    text = plan(transform(spark.read.parquet(f"{root}/b"), spec))
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sorted(c.split(":")[0] for c in read.split(",")) == sorted(set(spec.bronze_columns))
    assert "Exchange" not in text and "Python" not in text


# Rows that the eight tables must give.
GOLDEN_CAST = [
    ("19995", "Avatar", 242, "Jake Sully", "5602a8a7c3a3685532001c9a", 2, 65731, "Sam Worthington"),
    ("19995", "Avatar", 3, "Neytiri", "52fe48009251416c750ac9cb", 1, 8691, "Zoe Saldana"),
    ("19995", "Avatar", 25, "Dr. Grace Augustine", "52fe48009251416c750aca39", 1, 10205, "Sigourney Weaver"),
    ("19995", "Avatar", 4, "Col. Quaritch", "52fe48009251416c750ac9cf", 2, 32747, "Stephen Lang"),
]
GOLDEN_CREW = [
    ("19995", "Avatar", "52fe48009251416c750aca23", "Editing", 0, 1721, "Editor", "Stephen E. Rivkin"),
    ("19995", "Avatar", "539c47ecc3a36810e3001f87", "Art", 2, 496, "Production Design", "Rick Carter"),
    ("19995", "Avatar", "54491c89c3a3680fb4001cf7", "Sound", 0, 900, "Sound Designer", "Christopher Boyes"),
    ("19995", "Avatar", "54491cb70e0a267480001bd0", "Sound", 0, 900, "Supervising Sound Editor", "Christopher Boyes"),
]
GOLDEN_GENRES = [
    ("19995", 28, "Action"), ("19995", 12, "Adventure"), ("19995", 14, "Fantasy"),
    ("19995", 878, "Science Fiction"), ("285", 12, "Adventure"),
]
GOLDEN_KEYWORDS = [
    ("19995", 1463, "culture clash"), ("19995", 2964, "future"), ("19995", 3386, "space war"),
    ("19995", 3388, "space colony"), ("19995", 3679, "society"),
]
GOLDEN_LANGUAGES = [
    ("19995", "en", "English"), ("19995", "es", "Español"), ("285", "en", "English"),
    ("206647", "fr", "Français"), ("206647", "en", "English"),
]
GOLDEN_COUNTRIES = [("19995", "GB", "United Kingdom"), ("206647", "GB", "United Kingdom")]
GOLDEN_MOVIES = [
    ("19995", 2.37e8, 150.43758, "2009-12-10", 2.787965087e9, 162, 7.2, 11800),
    ("285", 3.0e8, 139.08261, "2007-05-19", 9.61e8, 169, 6.9, 4500),
    ("206647", 2.45e8, 107.376785, "2015-10-26", 8.80674609e8, 148, 6.3, 4466),
    ("49026", 2.5e8, 112.31295, "2012-07-16", 1.084939099e9, 165, 7.6, 9106),
    ("49529", 2.6e8, 43.926994, "2012-03-07", 2.841391e8, 132, 6.1, 2124),
]
GOLDEN_LISTS = {
    "genres": GOLDEN_GENRES,
    "keywords": GOLDEN_KEYWORDS,
    "spoken_languages": GOLDEN_LANGUAGES,
    "production_countries": GOLDEN_COUNTRIES,
}


def packed(rows, names):
    """Rows of one table back as bronze: a JSON list for each movie."""
    lists = {}
    for row in rows:
        lists.setdefault(row[0], []).append(dict(zip(names, row[-len(names) :], strict=True)))
    return lists


@pytest.mark.parametrize("name", ["cast", "crew"])
def test_golden_credits(spark, name):
    golden = {"cast": GOLDEN_CAST, "crew": GOLDEN_CREW}[name]
    names = [f.split()[0] for f in find(name).element.split(", ")]
    data = [
        (int(m), "Avatar", *(json.dumps(people) if c == name else "[]" for c in ("cast", "crew")))
        for m, people in packed(golden, names).items()
    ]
    assert rows(transform(credits(spark, *data), find(name))) == sorted(golden, key=str)


@pytest.mark.parametrize("name", list(GOLDEN_LISTS))
def test_golden_lists(spark, name):
    golden = GOLDEN_LISTS[name]
    names = [f.split()[0] for f in find(name).element.split(", ")]
    data = [movie(int(m), "t", **{name: found}) for m, found in packed(golden, names).items()]
    assert rows(transform(movies(spark, *data), find(name))) == sorted(golden, key=str)


def test_golden_movies(spark):
    data = [
        movie(int(m), "t", budget=f"{budget:.0f}", popularity=str(popularity), release_date=day,
              revenue=f"{revenue:.0f}", runtime=str(float(runtime)), vote_average=str(vote), vote_count=str(votes))
        for m, budget, popularity, day, revenue, runtime, vote, votes in GOLDEN_MOVIES
    ]
    found = {r.movie_id: r for r in transform(movies(spark, *data), find("movies")).collect()}
    for m, budget, popularity, day, revenue, runtime, vote, votes in GOLDEN_MOVIES:
        row = found[m]
        assert row.vote_count == votes
        assert (row.budget, str(row.release_date), row.revenue, row.runtime) == (budget, day, revenue, runtime)
        assert (row.popularity, row.vote_average) == (pytest.approx(popularity), pytest.approx(vote))
