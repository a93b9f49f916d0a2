"""A few bronze rows in the shape of the movie and credit objects."""

import json

MOVIE_SCHEMA = (
    "id bigint, title string, budget string, homepage string, original_language string, "
    "original_title string, overview string, popularity string, release_date string, "
    "revenue string, runtime string, status string, tagline string, vote_average string, "
    "vote_count string, genres string, keywords string, production_companies string, "
    "production_countries string, spoken_languages string"
)
CREDIT_SCHEMA = "movie_id bigint, title string, cast string, crew string"


def movie(movie_id, title, **values):
    base = dict(
        id=movie_id, title=title, budget="237000000", homepage="http://example.org/",
        original_language="en", original_title=title, overview="text", popularity="150.437577",
        release_date="2009-12-10", revenue="2787965087", runtime="162", status="Released",
        tagline="", vote_average="7.2", vote_count="11800", genres="[]", keywords="[]",
        production_companies="[]", production_countries="[]", spoken_languages="[]",
    )
    base.update({k: json.dumps(v) if isinstance(v, list) else v for k, v in values.items()})
    return tuple(base[field.split()[0]] for field in MOVIE_SCHEMA.split(", "))


AVATAR = movie(
    19995,
    "Avatar",
    genres=[{"id": 28, "name": "Action"}, {"id": 12, "name": "Adventure"}],
    keywords=[{"id": 1463, "name": "culture clash"}],
    production_companies=[{"id": 289, "name": "Ingenious Film Partners"}],
    production_countries=[
        {"iso_3166_1": "US", "name": "United States of America"},
        {"iso_3166_1": "GB", "name": "United Kingdom"},
    ],
    spoken_languages=[{"iso_639_1": "en", "name": "English"}, {"iso_639_1": "es", "name": "Español"}],
)
AVATAR_CREDITS = (
    19995,
    "Avatar",
    json.dumps(
        [
            {
                "cast_id": 242, "character": "Jake Sully", "credit_id": "5602a8a7c3a3685532001c9a",
                "gender": 2, "id": 65731, "name": "Sam Worthington", "order": 0,
            },
            {"cast_id": 3, "character": "Neytiri", "gender": 1, "id": 8691, "name": "Zoe Saldana", "order": 1},
        ]
    ),
    json.dumps(
        [
            {
                "credit_id": "52fe48009251416c750aca23", "department": "Editing", "gender": 0,
                "id": 1721, "job": "Editor", "name": "Stephen E. Rivkin",
            }
        ]
    ),
)


def movies(spark, *rows):
    return spark.createDataFrame(list(rows), MOVIE_SCHEMA)


def credits(spark, *rows):
    return spark.createDataFrame(list(rows), CREDIT_SCHEMA)
