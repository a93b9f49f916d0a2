"""The analyst questions over silver tables.

Sums of money go through an exact decimal, so results do not depend on the order in which
partitions are added up; a revenue that does not fit it (NaN, infinite, too large) counts as
unknown everywhere. Sentinel rows (no genre, no credit) and credits without a person's id are left
out. ``movies_unique`` says that a movie has one row, as in a table loaded with ``latest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlake.plans.specs import NO_CREDIT, NO_ID

MONEY = "decimal(28,4)"


def top_movie_of(cast: DataFrame, movies: DataFrame, person: str) -> DataFrame:
    """The highest-grossing movie with the given actor: one row, or none."""
    starred = cast.where(F.col("name") == person).select("movie_id")
    return (
        _paid(movies, "movie_id", "title")
        .join(starred, "movie_id", "left_semi")
        .select(F.lit(person).alias("name"), "movie_id", "title", F.col("revenue").cast("double"))
        .orderBy(F.desc("revenue"), "movie_id")
        .limit(1)
    )


def top_movies(cast: DataFrame, movies: DataFrame, movies_unique: bool = False) -> DataFrame:
    """Every actor's highest-grossing movie; ties go to the smaller movie id."""
    roles = _credited(cast).select("movie_id", "id", "name")
    paid = _one_per_movie(_paid(movies, "movie_id", "title"), movies_unique, "revenue", "title")
    best = F.min(F.struct((-F.col("revenue")).alias("loss"), "movie_id", "title"))
    return (
        roles.join(paid, "movie_id")
        .groupBy("id", "name")
        .agg(best.alias("best"))
        .select(
            "id", "name", "best.movie_id", "best.title", (-F.col("best.loss")).cast("double").alias("revenue")
        )
    )


def revenue_by_genre(genres: DataFrame, movies: DataFrame, movies_unique: bool = False) -> DataFrame:
    """Per genre: number of movies with a known revenue, average and greatest revenue."""
    known = _one_per_movie(_paid(movies, "movie_id"), movies_unique, "revenue")
    tagged = genres.where(F.col("id") != NO_ID).select("movie_id", "name")
    return (
        tagged.join(known, "movie_id")
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("movies"),
            F.round(F.sum("revenue").cast("double") / F.count(F.lit(1)), 2).alias("avg_revenue"),
            F.max("revenue").cast("double").alias("max_revenue"),
        )
    )


def revenue_by_month(movies: DataFrame) -> DataFrame:
    """Per release year and month: number of movies and their revenue."""
    released = _paid(movies.where("release_date IS NOT NULL"), "release_date")
    return released.groupBy(
        F.year("release_date").alias("year"), F.month("release_date").alias("month")
    ).agg(F.count(F.lit(1)).alias("movies"), F.round(F.sum("revenue").cast("double"), 2).alias("revenue"))


def release_revenue_correlation(movies: DataFrame) -> DataFrame:
    """Correlation of the release day with revenue: one row."""
    day = F.unix_date("release_date").cast("double")
    return movies.agg(F.round(F.corr(day, F.col("revenue")), 6).alias("correlation"))


def release_rollup(movies: DataFrame) -> DataFrame:
    """Movies, revenue and its trend by year, year and month, weekday (0 is Monday) and in all, in one pass.

    ``level`` names the grouping; columns that it does not group by are null. ``slope`` is the change of revenue
    per day in the group and ``r2`` how much of the revenue's spread it explains (both null for a single day).
    """
    day = F.col("release_date")
    released = _paid(movies.where("release_date IS NOT NULL"), "release_date").select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.weekday(day).alias("weekday"),
        F.unix_date(day).cast("double").alias("day"),
        "revenue",
    )
    by = ["year", "month", "weekday"]
    sets = {"all": [], "year": ["year"], "month": ["year", "month"], "weekday": ["weekday"]}
    # One bit for each column, set where it is not grouped by.
    number = {sum((c not in on) << (2 - i) for i, c in enumerate(by)): level for level, on in sets.items()}
    level = F.element_at(F.create_map(*[F.lit(x) for pair in number.items() for x in pair]), F.grouping_id().cast("int"))
    amount = F.col("revenue").cast("double")
    return released.groupingSets([[F.col(c) for c in on] for on in sets.values()], *by).agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("movies"),
        F.round(F.sum("revenue").cast("double"), 2).alias("revenue"),
        F.round(F.regr_slope(amount, "day"), 3).alias("slope"),
        F.round(F.regr_r2(amount, "day"), 6).alias("r2"),
    )


#: Size of the quantile sketches. The share of movies below an estimate is off by less than SKETCH_ERROR.
SKETCH_K, SKETCH_ERROR = 1000, 0.01


def revenue_sketches(genres: DataFrame, movies: DataFrame, movies_unique: bool = False) -> DataFrame:
    """``(name, day, sketch)``: for each genre and release day a sketch of the revenues, some kilobytes at most.

    To be stored and added to day by day; ``revenue_quantiles`` merges what it is given, so a day's load
    does not read the movies of other days again.
    """
    known = _one_per_movie(_paid(movies, "movie_id", "release_date"), movies_unique, "revenue", "release_date")
    tagged = genres.where(F.col("id") != NO_ID).select("movie_id", "name")
    return (
        tagged.join(known, "movie_id")
        .groupBy("name", F.col("release_date").alias("day"))
        .agg(F.kll_sketch_agg_double(F.col("revenue").cast("double"), F.lit(SKETCH_K)).alias("sketch"))
    )


def revenue_quantiles(sketches: DataFrame, *by: str) -> DataFrame:
    """Per ``by`` (as a rule the genre): number of movies, quartiles and median, from merged sketches."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    at = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    return merged.select(
        *by,
        F.kll_sketch_get_n_double("sketch").alias("movies"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in at.items()],
    )


def crew_turnover(crew: DataFrame, movies: DataFrame, job: str = "Director") -> DataFrame:
    """How much of a director's crew stays from one movie to the next, by release date and movie id.

    ``(director, movie_id, previous, crew, kept, usual)``: the people of the movie, those of them who were
    in the director's previous movie (both null for the first), and the average share kept over this movie and the two
    before. Only the director's list of movies is windowed. Crews are compared by joins on person and movie, so
    neither pairs of people nor a crew as one value is ever made. Movies without a date come first.
    """
    people = _credited(crew).groupBy("movie_id", "id").agg(F.max(F.col("job") == job).alias("directs"))
    sizes = people.groupBy("movie_id").agg(F.count(F.lit(1)).alias("crew"))
    dates = movies.groupBy("movie_id").agg(F.max("release_date").alias("date"))
    directed = people.where("directs").select(F.col("id").alias("director"), "movie_id").join(dates, "movie_id", "left")
    career = Window.partitionBy("director").orderBy("date", "movie_id")
    steps = directed.withColumn("previous", F.lag("movie_id").over(career))
    pairs = steps.where("previous IS NOT NULL").select("movie_id", "previous").distinct()
    there = people.select(F.col("movie_id").alias("previous"), "id")
    kept = (
        people.select("movie_id", "id")
        .join(pairs, "movie_id")
        .join(there, ["previous", "id"], "left_semi")
        .groupBy("movie_id", "previous")
        .agg(F.count(F.lit(1)).alias("kept"))
    )
    found = steps.join(sizes, "movie_id").join(kept, ["movie_id", "previous"], "left")
    found = found.withColumn("kept", F.when(F.col("previous").isNotNull(), F.coalesce("kept", F.lit(0))))
    share = F.col("kept") / F.col("crew")
    return found.select(
        "director", "movie_id", "previous", "crew", "kept",
        F.round(F.avg(share).over(career.rowsBetween(-2, Window.currentRow)), 4).alias("usual"),
    )


def crew_loyalty(crew: DataFrame, job: str = "Director") -> DataFrame:
    """Does a director always work with the same crew? One row per director, by person id.

    ``movies`` directed, ``crews`` (different sets of people among them), ``same_crew_ratio``
    (share of the movies made with the most usual set) and ``always``.

    A movie's set of people is reduced to its size and two 64-bit hashes, so movies are
    compared without listing pairs of people: every step grows with the crew rows, also for
    a movie that holds a large share of them.
    """
    member = F.col("id")
    people = (
        _credited(crew)
        .groupBy("movie_id", "id")
        .agg(F.max(F.col("job") == job).alias("directs"))
    )
    crews = people.groupBy("movie_id").agg(
        F.struct(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64(member)).alias("a"),
            F.bit_xor(F.xxhash64(member, F.lit("b"))).alias("b"),
        ).alias("crew")
    )
    directed = people.where("directs").select("movie_id", "id")
    return (
        directed.join(crews, "movie_id")
        .groupBy("id", "crew")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("id")
        .agg(
            F.sum("times").alias("movies"),
            F.count(F.lit(1)).alias("crews"),
            F.round(F.max("times") / F.sum("times"), 4).alias("same_crew_ratio"),
        )
        .withColumn("always", F.col("crews") == 1)
    )


def most_active(crew: DataFrame, job: str = "Director") -> DataFrame:
    """The person with the most movies in the given job: one row ``(id, movies)``."""
    held = _credited(crew).where(F.col("job") == job)
    return (
        held.select("id", "movie_id")
        .distinct()
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("movies"))
        .orderBy(F.desc("movies"), "id")
        .limit(1)
    )


def collaborators(crew: DataFrame, directors: DataFrame, job: str = "Director") -> DataFrame:
    """How often each person worked with each of the given directors.

    ``directors`` has the persons' ``id``, such as ``most_active`` gives. Result:
    ``(director, id, shared, total, ratio)``, where ratio 1 means on every movie.
    """
    real = _credited(crew)
    wanted = directors.select("id").distinct()
    directed = (
        real.where(F.col("job") == job)
        .join(wanted, "id", "left_semi")
        .select(F.col("id").alias("director"), "movie_id")
        .distinct()
    )
    totals = directed.groupBy("director").agg(F.count(F.lit(1)).alias("total"))
    shared = (
        real.select("movie_id", "id")
        .join(directed, "movie_id")
        .where(F.col("id") != F.col("director"))
        .distinct()
        .groupBy("director", "id")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    ratio = F.round(F.col("shared") / F.col("total"), 4).alias("ratio")
    return shared.join(totals, "director").select("director", "id", "shared", "total", ratio)


def crew_credits(crew: DataFrame, person: str) -> DataFrame:
    """The movies and roles of one crew member."""
    return crew.where(F.col("name") == person).select("movie_id", "title", "department", "job")


def _credited(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("credit_id") != NO_CREDIT) & F.col("id").isNotNull())


def _paid(movies: DataFrame, *columns: str) -> DataFrame:
    """``revenue`` as exact money, and ``columns``, where the revenue is known."""
    known = movies.select(F.col("revenue").try_cast(MONEY).alias("revenue"), *columns)
    return known.where(F.col("revenue").isNotNull())


def _one_per_movie(movies: DataFrame, unique: bool, *columns: str) -> DataFrame:
    """One row per movie id. Shuffles by the id, which the join that follows needs anyway."""
    if unique:
        return movies
    row = F.max(F.struct(*columns)).alias("row")
    return movies.groupBy("movie_id").agg(row).select("movie_id", *[f"row.{c}" for c in columns])
