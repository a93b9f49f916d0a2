"""The analyst questions as SQL: table functions over the views of the silver tables.

    register_views(spark, silver)
    register_functions(spark)
    spark.sql("SELECT * FROM top_movie_of(:person)", args={"person": "Sam Worthington"})

They last as long as the session. Arguments are values, also when they come from outside; they are never
pasted into the text of a query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from silverlake.operators.analyst import MONEY
from silverlake.plans.specs import NO_CREDIT, NO_ID

KNOWN = f"(SELECT *, try_cast(revenue AS {MONEY}) AS paid FROM movies WHERE try_cast(revenue AS {MONEY}) IS NOT NULL)"
CREDITED = f"(SELECT DISTINCT movie_id, id FROM crew WHERE credit_id <> '{NO_CREDIT}')"

# A function's parameters are known at the top of its query only, not inside its subqueries.
#: Name and parameters, result, the views that it reads, and the query.
FUNCTIONS = {
    "top_movie_of": (
        "person STRING COMMENT 'an actor by name'",
        "name STRING, movie_id STRING, title STRING, revenue DOUBLE",
        ("cast", "movies"),
        f"""SELECT person, known.movie_id, title, CAST(paid AS DOUBLE)
            FROM {KNOWN} known JOIN (SELECT DISTINCT movie_id, name FROM cast) played ON played.movie_id = known.movie_id
            WHERE played.name = person
            ORDER BY paid DESC, known.movie_id LIMIT 1""",
    ),
    "credits_of": (
        "person STRING COMMENT 'a crew member by name'",
        "movie_id STRING, title STRING, department STRING, job STRING",
        ("crew",),
        "SELECT movie_id, title, department, job FROM crew WHERE crew.name = person",
    ),
    "revenue_of_genre": (
        "genre STRING COMMENT 'a genre by name'",
        "movies BIGINT, revenue DOUBLE, max_revenue DOUBLE",
        ("genres", "movies"),
        f"""SELECT count(*), CAST(sum(paid) AS DOUBLE), CAST(max(paid) AS DOUBLE)
            FROM genres JOIN {KNOWN} known ON known.movie_id = genres.movie_id
            WHERE genres.id <> {NO_ID} AND genres.name = genre""",
    ),
    "released_between": (
        "first DATE COMMENT 'the first day', last DATE COMMENT 'the last day, included'",
        "movie_id STRING, title STRING, release_date DATE, revenue DOUBLE",
        ("movies",),
        "SELECT movie_id, title, release_date, revenue FROM movies WHERE release_date BETWEEN first AND last",
    ),
    "colleagues_of": (
        "person INT COMMENT 'a crew member by id'",
        "id INT, shared BIGINT",
        ("crew",),
        f"""SELECT other.id, count(DISTINCT other.movie_id)
            FROM {CREDITED} other JOIN {CREDITED} own ON own.movie_id = other.movie_id
            WHERE own.id = person AND other.id <> person
            GROUP BY other.id""",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """The functions whose views are there (see ``register_views``); returns their names."""
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    names = []
    for name, (parameters, result, reads, query) in FUNCTIONS.items():
        if views.issuperset(reads):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({result}) RETURN {query}")
            names.append(name)
    return names
