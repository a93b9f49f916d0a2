import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from silverlake.operators import analyst

CREW = "movie_id string, title string, credit_id string, department string, gender int, id int, job string, name string"


@pytest.fixture(scope="module")
def crew_rows():
    """One movie holds a third of the credits; some crews repeat, some people share a name."""
    rng = random.Random(7)
    data, credit = [], 0
    for m in range(60):
        members = [m % 5, 10 + m % 3] if m % 2 else rng.sample(range(20), 4)
        size = 200 if m == 0 else len(members)
        for i in range(size):
            person = i % 50 if m == 0 else members[i]
            credit += 1
            job = "Director" if i < 2 else "Crew"
            data.append((str(m), f"t{m}", f"c{credit}", "d", 0, person, job, f"p{person % 7}"))
    data.append(("61", "t61", "0000000000", None, None, None, None, None))
    return data


def test_crew_loyalty(spark, crew_rows):
    sets, directs = defaultdict(set), defaultdict(set)
    for movie, _, credit, _, _, person, job, _ in crew_rows:
        if credit != "0000000000":
            sets[movie].add(person)
            if job == "Director":
                directs[person].add(movie)
    expected = []
    for person, movies in directs.items():
        times = Counter(frozenset(sets[m]) for m in movies)
        ratio = round(max(times.values()) / len(movies), 4)
        expected.append((person, len(movies), len(times), ratio, len(times) == 1))
    result = analyst.crew_loyalty(spark.createDataFrame(crew_rows, CREW))
    assert rows(result) == sorted(expected, key=str)
    assert any(r[4] for r in expected) and not all(r[4] for r in expected)


def test_collaborators(spark, crew_rows):
    crew = spark.createDataFrame(crew_rows, CREW)
    directs, members = defaultdict(set), defaultdict(set)
    for movie, _, credit, _, _, person, job, _ in crew_rows:
        if credit != "0000000000":
            members[movie].add(person)
            if job == "Director":
                directs[person].add(movie)
    top = min(directs, key=lambda p: (-len(directs[p]), p))
    assert rows(analyst.most_active(crew)) == [(top, len(directs[top]))]
    shared = Counter(p for m in directs[top] for p in members[m] if p != top)
    total = len(directs[top])
    expected = [(p, n, total, round(n / total, 4)) for p, n in shared.items()]
    assert rows(analyst.collaborators(crew, analyst.most_active(crew)).drop("director")) == sorted(expected, key=str)


def test_several_directors_are_kept_apart(spark, crew_rows):
    crew = spark.createDataFrame(crew_rows, CREW)
    two = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    both = analyst.collaborators(crew, two)
    for person in (1, 2):
        one = analyst.collaborators(crew, two.where(F.col("id") == person))
        assert rows(one) == rows(both.where(F.col("director") == person)) != []


def test_credits_without_a_person_are_left_out(spark, crew_rows):
    more = [*crew_rows, ("1", "t1", "real", "d", 0, None, "Director", "nobody"), ("3", "t3", "real2", "d", 0, None, "Crew", "nobody")]
    old, new = (spark.createDataFrame(x, CREW) for x in (crew_rows, more))
    assert rows(analyst.crew_loyalty(old)) == rows(analyst.crew_loyalty(new))
    everyone = old.select("id").where("id IS NOT NULL")
    assert rows(analyst.collaborators(old, everyone)) == rows(analyst.collaborators(new, everyone))


def test_top_movies_and_ties(spark):
    cast = spark.createDataFrame(
        [("1", "a", 7, "Sam"), ("2", "b", 7, "Sam"), ("3", "c", 7, "Sam"), ("3", "d", 8, "Zoe"), ("4", "0000000000", None, None)],
        "movie_id string, credit_id string, id int, name string",
    )
    movies = spark.createDataFrame(
        [("1", "One", 5.0), ("2", "Two", 9.0), ("3", "Three", 9.0), ("4", "Four", None)],
        "movie_id string, title string, revenue double",
    )
    assert rows(analyst.top_movies(cast, movies)) == [(7, "Sam", "2", "Two", 9.0), (8, "Zoe", "3", "Three", 9.0)]
    assert rows(analyst.top_movie_of(cast, movies, "Sam")) == [("Sam", "2", "Two", 9.0)]
    assert analyst.top_movie_of(cast, movies, "Nobody").isEmpty()


def test_revenue_by_genre_leaves_out_the_sentinel_and_unknown_revenue(spark):
    genres = spark.createDataFrame(
        [("1", 28, "Action"), ("2", 28, "Action"), ("2", 12, "Adventure"), ("3", -9999, None), ("4", 28, "Action")],
        "movie_id string, id int, name string",
    )
    movies = spark.createDataFrame([("1", 1.0), ("2", 2.0), ("3", 50.0), ("4", None)], "movie_id string, revenue double")
    result = analyst.revenue_by_genre(genres, movies)
    assert rows(result) == [("Action", 2, 1.5, 2.0), ("Adventure", 1, 2.0, 2.0)]


def test_revenue_that_is_no_money_counts_nowhere(spark):
    genres = spark.createDataFrame([(str(i), 1, "g") for i in range(4)], "movie_id string, id int, name string")
    movies = spark.createDataFrame(
        [("0", float("nan")), ("1", 10.0), ("2", float("inf")), ("3", 1e40)], "movie_id string, revenue double"
    )
    assert rows(analyst.revenue_by_genre(genres, movies)) == [("g", 1, 10.0, 10.0)]


def test_revenue_by_genre_with_a_hot_movie(spark):
    genres = spark.range(3000).select(
        F.expr("IF(id % 3 = 0, '1', CAST(id AS STRING))").alias("movie_id"),
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("g"), F.col("id") % 4).alias("name"),
    )
    movies = spark.range(3000).select(F.col("id").cast("string").alias("movie_id"), (F.col("id") / 2).alias("revenue"))
    plain = genres.join(movies, "movie_id").groupBy("name").agg(F.count("*"), F.round(F.avg("revenue"), 2), F.max("revenue"))
    assert rows(analyst.revenue_by_genre(genres, movies)) == rows(plain)


def test_release_and_revenue(spark):
    movies = spark.sql(
        """SELECT * FROM VALUES (DATE '2020-01-01', 1.0D), (DATE '2020-01-31', 2.0D), (DATE '2021-05-01', 4.0D),
           (NULL, 9.0D) AS t(release_date, revenue)"""
    )
    assert rows(analyst.revenue_by_month(movies)) == [(2020, 1, 2, 3.0), (2021, 5, 1, 4.0)]
    assert analyst.release_revenue_correlation(movies).first().correlation > 0.9


def test_crew_credits(spark, crew_rows):
    crew = spark.createDataFrame(crew_rows, CREW)
    expected = [(r[0], r[1], r[3], r[6]) for r in crew_rows if r[7] == "p3"]
    assert rows(analyst.crew_credits(crew, "p3")) == sorted(expected, key=str)
