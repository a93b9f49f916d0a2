"""Bronze-shaped data derived from the given tables.

An order stands for a movie (its price for the revenue, its date for the release) and a line
item for one entry of its credits: the supplier is a crew member, the part an actor. Nested
lists are JSON text made row by row, so nothing is grouped to build them. Some lists are
empty, null or cut off and some keys are missing, to reach the null-key rules.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.sources.scratch import scratch_path

DAY = "20221104"
OBJECT = "{prefix}/{prefix}_part_{day}-120000.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def json_list(*elements: Column) -> Column:
    return F.to_json(F.array(*elements))


def element(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def movies_bronze(orders: DataFrame) -> DataFrame:
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    customer, price = F.col("o_custkey"), F.col("o_totalprice")
    pending = status == "P"
    title = F.concat(F.lit("Order "), key)
    genres = json_list(
        element(id=F.substring(priority, 1, 1).cast("int"), name=priority),
        element(id=F.when(status == "F", 10).otherwise(11), name=F.concat(F.lit("Status "), status)),
    )
    keywords = json_list(
        element(id=F.year("o_orderdate"), name=F.lit("year")),
        element(id=F.lit(None).cast("int"), name=priority),
    )
    companies = json_list(element(id=customer, name=F.concat(F.lit("Customer "), customer)))
    countries = json_list(element(iso_3166_1=F.nullif(status, F.lit("P")), name=priority))
    languages = json_list(
        element(iso_639_1=F.lit("en"), name=F.lit("English")),
        element(iso_639_1=F.lower(status), name=F.lit("Español")),
    )
    return orders.select(
        key.alias("id"),
        title.alias("title"),
        customer.cast("string").alias("budget"),
        F.concat(F.lit("https://example.org/"), key).alias("homepage"),
        status.alias("original_language"),
        title.alias("original_title"),
        priority.alias("overview"),
        price.cast("string").alias("popularity"),
        F.when(pending, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("release_date"),
        price.cast("string").alias("revenue"),
        F.concat(customer, F.lit(".5")).alias("runtime"),
        status.alias("status"),
        priority.alias("tagline"),
        (customer / 10).cast("string").alias("vote_average"),
        F.when(pending, F.lit("n/a")).otherwise(customer.cast("string")).alias("vote_count"),
        F.when(pending, F.lit("[]")).otherwise(genres).alias("genres"),
        F.when(status != "F", keywords).alias("keywords"),
        F.when(pending, F.lit('[{"id": 1')).otherwise(companies).alias("production_companies"),
        countries.alias("production_countries"),
        languages.alias("spoken_languages"),
    )


def credits_bronze(lineitem: DataFrame) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    credit = F.concat_ws("-", line, part, supplier, F.date_format("l_shipdate", "yyyyMMdd"))
    gender = F.when(F.col("l_linestatus") == "O", 1).otherwise(2)
    lead = element(
        cast_id=line,
        character=F.col("l_returnflag"),
        credit_id=F.when(F.col("l_returnflag") != "R", credit),
        gender=gender,
        id=part,
        name=F.concat(F.lit("Part "), part),
        order=line,
    )
    extra = element(
        cast_id=line + 100,
        character=F.lit("extra"),
        credit_id=F.concat_ws("-", credit, F.lit("x")),
        gender=F.lit(None).cast("int"),
        id=supplier,
        name=F.concat(F.lit("Supplier "), supplier),
        order=line + 1,
    )
    crew = element(
        credit_id=credit,
        department=F.col("l_linestatus"),
        gender=F.lit(0),
        id=supplier,
        job=F.when(line == 1, F.lit("Director")).otherwise(F.lit("Crew")),
        name=F.concat(F.lit("Supplier "), supplier),
    )
    return lineitem.select(
        order.alias("movie_id"),
        F.concat(F.lit("Order "), order).alias("title"),
        F.when(F.col("l_quantity") <= 45, json_list(lead, extra)).alias("cast"),
        json_list(crew).alias("crew"),
    )


def copy_objects(spark: SparkSession, source: str, target: str) -> None:
    """The same bytes under another name, in whatever store the scratch folder is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old, new = hadoop.Path(source), hadoop.Path(target)
    hadoop.FileUtil.copy(old.getFileSystem(conf), old, new.getFileSystem(conf), new, False, conf)


# Lists of JSON repeat their field names and most of their values.
PACKED = "zstd"

_landed: dict[tuple[str, str], tuple[str, set[str]]] = {}
_LANDING = {"movies": ("orders", movies_bronze), "credits": ("lineitem", credits_bronze)}


def land(rows: DataFrame, root: str, prefix: str, day: str = DAY) -> None:
    """Rows as the day's bronze objects: several files even from a single small input file."""
    per_file = max(50_000, rows.count() // 64)
    writer = rows.write.option("maxRecordsPerFile", per_file).option("compression", PACKED)
    writer.parquet(f"{root}/{OBJECT.format(prefix=prefix, day=day)}")


def bronze_root(spark: SparkSession, sf_dir: str, prefixes: Iterable[str] = tuple(_LANDING)) -> str:
    """The whole tables landed as one day of movies and credits, each prefix once per application when first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root, done = _landed.setdefault(key, (scratch_path(spark, "bronze"), set()))
    for prefix in prefixes:
        if prefix in done:
            continue
        source, shape = _LANDING[prefix]
        try:
            land(shape(table(spark, sf_dir, source)), root, prefix)
        except Exception:
            # What a failed write leaves behind must not be taken for the prefix's objects.
            _landed.pop(key, None)
            raise
        done.add(prefix)
    return root


CREDIT_SQL = "l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m%d')"

# The silver rows of the same data as SQL, one query per table.
SILVER_SQL = {
    "movies": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, 'Order ' || o_orderkey AS title,
               CAST(o_custkey AS DOUBLE) AS budget, 'https://example.org/' || o_orderkey AS homepage,
               o_orderstatus AS original_language, 'Order ' || o_orderkey AS original_title,
               o_orderpriority AS overview, CAST(o_totalprice AS FLOAT) AS popularity,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS release_date,
               o_totalprice AS revenue, CAST(o_custkey AS INTEGER) AS runtime,
               o_orderstatus AS status, o_orderpriority AS tagline,
               CAST(o_custkey / 10 AS FLOAT) AS vote_average,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END AS vote_count
        FROM orders""",
    "genres": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id, o_orderpriority AS name
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 11 END,
               'Status ' || o_orderstatus
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), -9999, NULL FROM orders WHERE o_orderstatus = 'P'""",
    "keywords": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, CAST(year(o_orderdate) AS INTEGER) AS id,
               'year' AS name
        FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), -9999, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), -9999, NULL FROM orders WHERE o_orderstatus = 'F'""",
    "production_companies": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id,
               CASE WHEN o_orderstatus = 'P' THEN -9999 ELSE CAST(o_custkey AS INTEGER) END AS id,
               CASE WHEN o_orderstatus <> 'P' THEN 'Customer ' || o_custkey END AS name
        FROM orders""",
    "production_countries": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id,
               CASE WHEN o_orderstatus = 'P' THEN 'XX' ELSE o_orderstatus END AS iso_3166_1,
               o_orderpriority AS name
        FROM orders""",
    "spoken_languages": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, 'en' AS iso_639_1, 'English' AS name
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), lower(o_orderstatus), 'Español' FROM orders""",
    "cast": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Order ' || l_orderkey AS title,
               l_linenumber AS cast_id, l_returnflag AS character,
               CASE WHEN l_returnflag <> 'R' THEN {CREDIT_SQL}
                    ELSE '0000000000' END AS credit_id,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS gender,
               CAST(l_partkey AS INTEGER) AS id, 'Part ' || l_partkey AS name
        FROM lineitem WHERE l_quantity <= 45
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), 'Order ' || l_orderkey, l_linenumber + 100, 'extra',
               {CREDIT_SQL} || '-x', NULL, CAST(l_suppkey AS INTEGER),
               'Supplier ' || l_suppkey
        FROM lineitem WHERE l_quantity <= 45
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), 'Order ' || l_orderkey, NULL, NULL, '0000000000',
               NULL, NULL, NULL
        FROM lineitem WHERE l_quantity > 45""",
    "crew": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Order ' || l_orderkey AS title,
               {CREDIT_SQL} AS credit_id, l_linestatus AS department,
               0 AS gender, CAST(l_suppkey AS INTEGER) AS id,
               CASE WHEN l_linenumber = 1 THEN 'Director' ELSE 'Crew' END AS job,
               'Supplier ' || l_suppkey AS name
        FROM lineitem""",
}
