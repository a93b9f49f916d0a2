"""Every query by name, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.functions import open_elements, parse_list
from silverlake.operators import analyst
from silverlake.operators.merge import ambiguous_keys, dedupe_latest, upsert
from silverlake.operators.transform import list_losses as count_list_losses
from silverlake.operators.transform import lost_values, transform
from silverlake.plans.daily import read_log, retry_failed, run_day, run_summary
from silverlake.plans.specs import MOVIE_TABLES, TableSpec, find, prefixes
from silverlake.sources.bronze import check_day, day_objects, inventory, scan_day
from silverlake.sources.bronze import object_schemas as read_schemas
from silverlake.sources.bronze import readiness as check_readiness
from silverlake.sources.bucketed import merge_into_bucketed
from silverlake.sources.scratch import scratch_path, staged
from silverlake.sources.silver import (
    read_silver,
    register_views,
    table_exists,
    upsert_table,
)
from silverlake.sources.sql_functions import register_functions
from silverlake.streaming.ingest import ingest_available
from workloads.standins import (
    DAY,
    OBJECT,
    PACKED,
    SILVER_SQL,
    bronze_root,
    copy_objects,
    credits_bronze,
    element,
    json_list,
    land,
    movies_bronze,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql:
            SQL[key] = sql
        return run

    return add


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of one silver table, straight from the day's bronze objects."""
    spec = find(name)
    return transform(bronze(spark, sf_dir, spec.prefix), spec)


def bronze(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    return scan_day(spark, bronze_root(spark, sf_dir, [prefix]), prefix, DAY)


_stored: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Silver tables as analysts read them: loaded once per application, then queried."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root = _stored.setdefault(key, scratch_path(spark, "silver"))
    missing = {name: find(name) for name in names if not table_exists(spark, root, name)}
    if missing:
        run_day(spark, bronze_root(spark, sf_dir, prefixes(missing)), root, DAY, tables=missing)
    return [read_silver(spark, root, find(name)) for name in names]


def day_text(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


# ---------------------------------------------------------------- projection, casts, JSON


@query(
    """SELECT o_orderkey AS movie_id, o_custkey, o_orderstatus, o_totalprice AS revenue
       FROM orders"""
)
def scan_project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").withColumnsRenamed(
        {"o_orderkey": "movie_id", "o_totalprice": "revenue"}
    )


# Values as text, a fraction for every int and a foreign format for part of the dates.
SHIPPED = TableSpec(
    name="shipped",
    prefix="lines",
    keys=("order_id",),
    columns=(
        ("order_id", "l_orderkey", "string"),
        ("quantity", "quantity", "int"),
        ("price", "price", "double"),
        ("discount", "discount", "float"),
        ("shipped", "shipped", "date"),
    ),
)


def lines_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "N", F.lit("unknown"))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_discount").cast("string").alias("discount"),
        F.when(F.col("l_linestatus") == "O", F.date_format(shipped, "MM/dd/yyyy"))
        .otherwise(F.date_format(shipped, "yyyy-MM-dd"))
        .alias("shipped"),
    )


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
              CASE WHEN l_returnflag <> 'N' THEN CAST(trunc(l_quantity) AS INTEGER) END AS quantity,
              l_extendedprice AS price, CAST(l_discount AS FLOAT) AS discount,
              CASE WHEN l_linestatus <> 'O' THEN strftime(l_shipdate, '%Y-%m-%d') END AS shipped
       FROM lineitem"""
)
def flat_casts_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform(lines_as_text(spark, sf_dir), SHIPPED)
    return rows.withColumn("shipped", F.col("shipped").cast("string"))


@query(
    """SELECT 'quantity' AS "column", count(*) AS present,
              count(*) FILTER (l_returnflag = 'N') AS lost FROM lineitem
       UNION ALL SELECT 'price', count(*), 0 FROM lineitem
       UNION ALL SELECT 'discount', count(*), 0 FROM lineitem
       UNION ALL SELECT 'shipped', count(*), count(*) FILTER (l_linestatus = 'O') FROM lineitem"""
)
def cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lost_values(lines_as_text(spark, sf_dir), SHIPPED)


@query("SELECT event_id, event_type, CAST(props->>'k' AS INTEGER) AS k FROM events")
def json_struct_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = parse_list("props", "k int").getItem(0)
    return table(spark, sf_dir, "events").select("event_id", "event_type", props["k"].alias("k"))


# ---------------------------------------------------------------- the eight silver tables


def _silver_query(name: str) -> None:
    sql = SILVER_SQL[name]
    if name == "movies":
        sql = f"SELECT * REPLACE (strftime(release_date, '%Y-%m-%d') AS release_date) FROM ({sql})"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = silver(spark, sf_dir, name)
        return rows.withColumn("release_date", F.col("release_date").cast("string")) if name == "movies" else rows

    query(sql, name=f"silver_{name}")(run)


for _name in MOVIE_TABLES:
    _silver_query(_name)


# ---------------------------------------------------------------- lists of any other table

LINE_IDS = TableSpec(
    name="line_ids",
    prefix="orders",
    keys=("order_id", "id"),
    columns=(("order_id", "l_orderkey", "string"), ("line", "l_linenumber", "int")),
    list_column="ids",
    element="id int, name string",
    sentinel=("id", -9999),
)


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line,
              CAST(l_partkey AS INTEGER) AS id, 'part' AS name
       FROM lineitem WHERE l_returnflag <> 'N'
       UNION ALL
       SELECT CAST(l_orderkey AS VARCHAR), l_linenumber,
              CASE WHEN l_linestatus = 'F' THEN CAST(l_suppkey AS INTEGER) ELSE -9999 END, 'supplier'
       FROM lineitem WHERE l_returnflag <> 'N'
       UNION ALL
       SELECT CAST(l_orderkey AS VARCHAR), l_linenumber, -9999, NULL
       FROM lineitem WHERE l_returnflag = 'N'"""
)
def explode_int_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = F.when(F.col("l_linestatus") == "F", F.col("l_suppkey"))
    ids = json_list(
        element(id=F.col("l_partkey"), name=F.lit("part")),
        element(id=supplier, name=F.lit("supplier")),
    )
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "ids", F.when(F.col("l_returnflag") != "N", ids).otherwise(F.lit("[]"))
    )
    return transform(lines, LINE_IDS)


TURNS = TableSpec(
    name="turns",
    prefix="conversations",
    keys=("conv_id", "turn", "role"),
    columns=(("conv_id", "conv_id", "string"), ("turn", "turn", "int")),
    list_column="said",
    element="role string, text string",
    sentinel=("role", "XX"),
)


@query(
    """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS INTEGER) AS turn,
              coalesce(nullif(role, 'system'), 'XX') AS role, text
       FROM conversations"""
)
def explode_string_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = json_list(element(role=F.nullif(F.col("role"), F.lit("system")), text=F.col("text")))
    turns = table(spark, sf_dir, "conversations").withColumn("said", said)
    return transform(turns, TURNS)


WIDE_LINE = TableSpec(
    name="wide_lines",
    prefix="lines",
    keys=("order_id", "line"),
    columns=(("order_id", "l_orderkey", "string"), ("shipped", "shipped", "date")),
    list_column="packed",
    # The list also has the tax, which is left out.
    element="line int, part string, supplier int, quantity double, price double, status string, flag string",
    sentinel=("line", -9999),
)


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
              CASE WHEN l_returnflag = 'A' THEN -9999 ELSE CAST(l_linenumber AS INTEGER) END AS line,
              CASE WHEN l_returnflag <> 'A' THEN 'p' || l_partkey END AS part,
              CASE WHEN l_returnflag <> 'A' THEN CAST(l_suppkey AS INTEGER) END AS supplier,
              CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS DOUBLE) END AS quantity,
              CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END AS price,
              CASE WHEN l_returnflag <> 'A' THEN l_linestatus END AS status,
              CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag
       FROM lineitem"""
)
def explode_wide_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide record of which one field is left out; every fourth list or so is missing."""
    packed = json_list(
        element(
            line=F.col("l_linenumber"),
            part=F.concat(F.lit("p"), "l_partkey"),
            tax=F.col("l_tax"),
            supplier=F.col("l_suppkey"),
            quantity=F.col("l_quantity"),
            price=F.col("l_extendedprice"),
            status=F.col("l_linestatus"),
            flag=F.col("l_returnflag"),
        )
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        F.when(F.col("l_returnflag") != "A", packed).alias("packed"),
    )
    return transform(lines, WIDE_LINE).withColumn("shipped", F.col("shipped").cast("string"))


@query(SILVER_SQL["genres"])
def explode_via_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze(spark, sf_dir, "movies").createOrReplaceTempView("bronze_movies")
    return spark.sql(
        """SELECT movie_id, coalesce(id, -9999) AS id, name
           FROM (SELECT CAST(id AS STRING) AS movie_id,
                        inline_outer(from_json(genres, 'array<struct<id:int,name:string>>'))
                 FROM bronze_movies)"""
    )


TAGS = TableSpec(
    name="tags",
    prefix="orders",
    keys=("order_id", "id"),
    columns=(("order_id", "o_orderkey", "string"),),
    list_column="tags",
    element="id int, name string",
    sentinel=("id", -9999),
)


def tagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of every kind, by the customer: cut off, JSON null, a single record, fractions, a number, none, good."""
    kind, status = F.col("o_custkey") % 7, F.col("o_orderstatus")
    good = json_list(element(id=F.col("o_custkey"), name=status), element(id=F.lit(None).cast("int"), name=status))
    fraction = F.concat(F.lit('[{"id":1.5,"name":"'), status, F.lit('"},{"id":2,"name":3},{"name":"x"}]'))
    tags = (
        F.when(kind == 0, F.lit('[{"id": 1'))
        .when(kind == 1, F.lit("null"))
        .when(kind == 2, F.lit('{"id":"x","name":"a"}'))
        .when(kind == 3, fraction)
        .when(kind == 4, F.col("o_orderkey").cast("string"))
        .when(kind == 5, F.lit(None))
        .otherwise(good)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", tags.alias("tags"))


@query(
    """SELECT 'tags' AS "column", count(*) FILTER (o_custkey % 7 <> 5) AS present,
              count(*) FILTER (o_custkey % 7 = 0) AS unreadable,
              count(*) FILTER (o_custkey % 7 IN (2, 4)) AS not_a_list,
              count(*) FILTER (o_custkey % 7 IN (2, 3)) AS bad_elements
       FROM orders"""
)
def list_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lists lose. A number as a name is read as text, so only the fraction is a bad value."""
    return count_list_losses(tagged_orders(spark, sf_dir), TAGS)


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, CAST(l_linenumber AS INTEGER) AS "order",
              CAST(l_partkey AS BIGINT) AS id, 'Part ' || l_partkey AS name, 'character,credit_id' AS texts
       FROM lineitem WHERE l_quantity <= 45 AND l_returnflag <> 'R'
       UNION ALL
       SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS INTEGER), CAST(l_partkey AS BIGINT),
              'Part ' || l_partkey, 'character'
       FROM lineitem WHERE l_quantity <= 45 AND l_returnflag = 'R'
       UNION ALL
       SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber + 1 AS INTEGER), CAST(l_suppkey AS BIGINT),
              'Supplier ' || l_suppkey, 'character,credit_id'
       FROM lineitem WHERE l_quantity <= 45
       UNION ALL
       SELECT CAST(l_orderkey AS VARCHAR), NULL, NULL, NULL, '' FROM lineitem WHERE l_quantity > 45"""
)
def explode_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with fields that no spec declares: the place in the billing, and which texts an element has."""
    credits = bronze(spark, sf_dir, "credits").select(F.col("movie_id").cast("string"), "cast")
    fields = {"order": ("$.order", "int"), "id": ("$.id", "bigint"), "name": ("$.name", "string")}
    opened = open_elements(credits, "cast", fields, rest="whole")
    has = [F.when(F.get_json_object("whole", f"$.{c}").isNotNull(), F.lit(c)) for c in ("character", "credit_id")]
    return opened.select("movie_id", *fields, F.concat_ws(",", *has).alias("texts"))


# ---------------------------------------------------------------- bronze objects by day

SCAN_DAY = "20240115"


def land_events(spark: SparkSession, sf_dir: str) -> str:
    """Events as bronze objects, a folder per day; returns the bronze root."""
    root = scratch_path(spark, "bronze")
    table(spark, sf_dir, "events").withColumn("events_part", F.date_format("ts", "yyyyMMdd")).write.partitionBy(
        "events_part"
    ).parquet(f"{root}/events")
    return root


@query(
    f"""SELECT event_id, user_id, event_type, value, props FROM events
        WHERE strftime(ts, '%Y%m%d') = '{SCAN_DAY}'"""
)
def land_and_scan_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = land_events(spark, sf_dir)
    rows = scan_day(spark, root, "events", SCAN_DAY)
    return rows.select("event_id", "user_id", "event_type", "value", "props")


@query(
    """SELECT DISTINCT 'events' AS prefix, 'events/events_part=' || strftime(ts, '%Y%m%d') AS object,
              true AS filled
       FROM events"""
)
def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed objects by name: a folder for each day."""
    objects = inventory(spark, land_events(spark, sf_dir), ["events"])
    name = F.substring_index("object_key", "/", 2).alias("object")
    return objects.groupBy("prefix", name).agg((F.min("bytes") > 0).alias("filled"))


@query(
    f"""SELECT 'events' AS prefix, count(*) > 0 AS any_object,
               CASE WHEN count(*) > 0 THEN 'enough_file' ELSE 'not_enough_file' END AS status
        FROM events WHERE strftime(ts, '%Y%m%d') = '{SCAN_DAY}'
        UNION ALL SELECT 'credits', false, 'not_enough_file'"""
)
def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = check_readiness(spark, land_events(spark, sf_dir), ["events", "credits"], SCAN_DAY)
    return status.select("prefix", (F.col("objects") > 0).alias("any_object"), "status")


@query(
    """SELECT strftime(min(ts), '%Y%m%d') AS day, 'enough_file' AS status FROM events
       UNION ALL SELECT strftime(max(ts) + INTERVAL 1 DAY, '%Y%m%d'), 'not_enough_file' FROM events
       UNION ALL SELECT 'no root', 'http_request_error'"""
)
def day_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of the first day of the events, of the day after the last, and of a missing root."""
    root = land_events(spark, sf_dir)
    day = lambda ts: F.date_format(ts, "yyyyMMdd")
    first, after = (
        table(spark, sf_dir, "events").agg(day(F.min("ts")), day(F.max("ts") + F.expr("INTERVAL 1 DAY"))).first()
    )
    found = [(d, check_day(spark, root, ["events", "credits"], d)) for d in (first, after)]
    found.append(("no root", check_day(spark, f"{root}-none", ["events"], first)))
    return spark.createDataFrame(found, "day string, status string")


TYPED = TableSpec(
    name="typed",
    prefix="orders",
    keys=("order_id",),
    columns=(("order_id", "id", "string"), ("price", "price", "double"), ("note", "note", "string")),
)


def two_kinds(orders: DataFrame) -> dict[str, DataFrame]:
    """Odd orders with a number as id and without notes, even ones with texts and notes."""
    id_, price = F.col("o_orderkey"), F.col("o_totalprice").alias("price")
    odd = orders.where(id_ % 2 != 0).select(id_.cast("long").alias("id"), price)
    even = orders.where(id_ % 2 == 0).select(
        id_.cast("string").alias("id"), price.cast("string"), F.col("o_orderpriority").alias("note")
    )
    return {"a": odd, "b": even}


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DOUBLE) AS price,
              CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note
       FROM orders"""
)
def objects_of_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd orders land with a number as id and without notes, even ones with a text as id.

    The first two days have one kind each, the third both, in a folder named as its prefix.
    """
    root = scratch_path(spark, "bronze")
    odd, even = two_kinds(table(spark, sf_dir, "orders")).values()
    odd.write.parquet(f"{root}/orders/orders_part_20221104-120000.parquet")
    even.write.parquet(f"{root}/orders/orders_part_20221105-120000.parquet")
    odd.write.parquet(f"{root}/orders/20221106/orders/odd.parquet")
    even.write.parquet(f"{root}/orders/20221106/orders/even.parquet")
    by_day, at_once = scratch_path(spark, "silver"), scratch_path(spark, "silver")
    run_day(spark, root, by_day, "20221104", tables={"typed": replace(TYPED, columns=TYPED.columns[:2])})
    run_day(spark, root, by_day, "20221105", tables={"typed": replace(TYPED, columns=TYPED.columns[:2])})
    run_day(spark, root, at_once, "20221106", tables={"typed": TYPED})
    prices = read_silver(spark, by_day, replace(TYPED, columns=TYPED.columns[:2]))
    return prices.join(read_silver(spark, at_once, TYPED).select("order_id", "note"), "order_id")


@query(
    """WITH kinds AS (SELECT o_orderkey % 2 AS odd, count(*) AS n FROM orders GROUP BY 1),
            columns(odd, "column", type) AS (VALUES (1, 'id', 'long'), (1, 'price', 'double'),
                (0, 'id', 'string'), (0, 'price', 'string'), (0, 'note', 'string'))
       SELECT CASE odd WHEN 1 THEN 'a' ELSE 'b' END AS object, "column", type
       FROM kinds JOIN columns USING (odd) WHERE n > 0"""
)
def object_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns and types of one object whose files were written by two versions, read from their footers."""
    root = scratch_path(spark, "bronze")
    for name, part in two_kinds(table(spark, sf_dir, "orders")).items():
        part.write.parquet(f"{root}/orders/orders_part_20221104-120000.parquet/{name}.parquet")
    found = read_schemas(spark, root, day_objects(spark, root, "orders", "20221104"))
    name = F.regexp_extract("object_key", r"/([ab])\.parquet/", 1).alias("object")
    return found.select(name, "column", "type").distinct()


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DOUBLE) AS price,
              CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note
       FROM orders"""
)
def folder_of_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object that is a folder, appended to with a new column and another type."""
    root, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for part in two_kinds(table(spark, sf_dir, "orders")).values():
        part.write.mode("append").parquet(f"{root}/orders/orders_part_20221104-120000.parquet")
    run_day(spark, root, silver_root, "20221104", tables={"typed": TYPED})
    return read_silver(spark, silver_root, TYPED)


# ---------------------------------------------------------------- merge


@query(
    """WITH old AS (SELECT * FROM orders WHERE o_orderdate < DATE '1996-01-01'),
            new AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice, 'U' AS o_orderstatus)
                    FROM orders WHERE o_orderdate >= DATE '1995-01-01')
       SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM new
       UNION ALL
       SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM old
       WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)"""
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known orders up to 1995; changed or new ones from 1995 on."""
    orders = table(spark, sf_dir, "orders")
    wanted = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    old = orders.where("o_orderdate < DATE '1996-01-01'").select(*wanted)
    new = (
        orders.where("o_orderdate >= DATE '1995-01-01'")
        .select(*wanted)
        .withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("U")})
    )
    return upsert(old, new, ["o_orderkey"], target_unique=True)


PRICED = TableSpec(
    name="priced",
    prefix="orders",
    keys=("order_id",),
    columns=(("order_id", "o_orderkey", "string"), ("status", "o_orderstatus", "string"), ("price", "o_totalprice", "double")),
)


@query(
    """WITH old AS (SELECT * FROM orders WHERE o_orderdate < DATE '1996-01-01'),
            new AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice, 'U' AS o_orderstatus)
                    FROM orders WHERE o_orderdate >= DATE '1995-01-01')
       SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status, o_totalprice AS price FROM new
       UNION ALL
       SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, o_totalprice FROM old
       WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)"""
)
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change, into a table that is bucketed by its key and is not shuffled."""
    orders, root = table(spark, sf_dir, "orders"), scratch_path(spark, "bucketed")
    name = f"priced_{uuid4().hex}"
    new = orders.where("o_orderdate >= DATE '1995-01-01'").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("U")}
    )
    for load in (orders.where("o_orderdate < DATE '1996-01-01'"), new):
        merge_into_bucketed(transform(load, PRICED), name, PRICED, root, keys_complete=True)
    return spark.table(name)


@query(
    """WITH old AS (SELECT nullif(o_custkey % 7, 0) AS part, o_orderkey AS id, o_totalprice AS price
                    FROM orders WHERE o_orderdate < DATE '1997-01-01'),
            new AS (SELECT nullif(o_custkey % 7, 0) AS part, o_orderkey AS id, o_totalprice + 1 AS price
                    FROM orders WHERE o_orderdate >= DATE '1995-01-01')
       SELECT * FROM new
       UNION ALL SELECT * FROM old
       WHERE part IS NULL OR NOT EXISTS (SELECT 1 FROM new WHERE new.part = old.part AND new.id = old.id)"""
)
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part of the keys is null on both sides: those rows match nothing and stay, old and new."""
    part = F.nullif(F.col("o_custkey") % 7, F.lit(0)).alias("part")
    price, orders = F.col("o_totalprice"), table(spark, sf_dir, "orders")
    old = orders.where("o_orderdate < DATE '1997-01-01'")
    new = orders.where("o_orderdate >= DATE '1995-01-01'")
    return upsert(
        old.select(part, F.col("o_orderkey").alias("id"), price.alias("price")),
        new.select(part, F.col("o_orderkey").alias("id"), (price + 1).alias("price")),
        ["part", "id"],
    )


LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_returnflag", "l_shipdate",
]


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
              l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
       FROM lineitem
       QUALIFY row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                    l_extendedprice DESC, l_returnflag DESC) = 1"""
)
def dedupe_latest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).withColumn(
        "l_shipdate", day_text("l_shipdate")
    )


QUERIES["dedupe_latest"] = QUERIES.pop("dedupe_latest_line")
SQL["dedupe_latest"] = SQL.pop("dedupe_latest_line")


@query(
    """SELECT l_orderkey, count(*) AS source_rows
       FROM lineitem new
       WHERE l_shipdate >= DATE '1996-01-01'
         AND EXISTS (SELECT 1 FROM lineitem old
                     WHERE old.l_shipdate < DATE '1996-01-01' AND old.l_orderkey = new.l_orderkey)
       GROUP BY l_orderkey HAVING count(*) > 1"""
)
def merge_ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lines from before 1996 and several from then on."""
    lines = table(spark, sf_dir, "lineitem")
    old = lines.where("l_shipdate < DATE '1996-01-01'")
    new = lines.where("l_shipdate >= DATE '1996-01-01'")
    return ambiguous_keys(old, new, ["l_orderkey"])


# ---------------------------------------------------------------- silver tables on storage


@query(SILVER_SQL["genres"])
def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "silver")
    upsert_table(silver(spark, sf_dir, "genres"), root, find("genres"))
    return read_silver(spark, root, find("genres"))


@query(
    f"""WITH first AS ({SILVER_SQL["genres"]}),
             second AS (
               SELECT CAST(o_orderkey AS VARCHAR) AS movie_id,
                      CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id,
                      lower(o_orderpriority) AS name
               FROM orders)
        SELECT * FROM second
        UNION ALL
        SELECT * FROM first
        WHERE NOT EXISTS (SELECT 1 FROM second
                          WHERE second.movie_id = first.movie_id AND second.id = first.id)"""
)
def merge_stale_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load with one genre per movie: dropped genres and sentinels both stay."""
    root, genres = scratch_path(spark, "silver"), find("genres")
    orders = table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    one = json_list(element(id=F.substring(priority, 1, 1).cast("int"), name=F.lower(priority)))
    upsert_table(transform(movies_bronze(orders), genres), root, genres)
    upsert_table(transform(orders.select(F.col("o_orderkey").alias("id"), one.alias("genres")), genres), root, genres)
    return read_silver(spark, root, genres)


def load_all(spark: SparkSession, sf_dir: str) -> str:
    """The daily batch over the landed day; returns the silver root."""
    silver_root = scratch_path(spark, "silver")
    run_day(spark, bronze_root(spark, sf_dir), silver_root, DAY)
    return silver_root


@query(
    " UNION ALL ".join(
        f"""SELECT DISTINCT '{spec.name}' AS "table", movie_id, CAST({spec.keys[-1]} AS VARCHAR) AS "key"
            FROM ({SILVER_SQL[spec.name]})"""
        for spec in MOVIE_TABLES.values()
    )
)
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight tables after one day: the merge key of every row."""
    root = load_all(spark, sf_dir)
    keys = [
        read_silver(spark, root, spec).select(
            F.lit(spec.name).alias("table"), "movie_id", F.col(spec.keys[-1]).cast("string").alias("key")
        )
        for spec in MOVIE_TABLES.values()
    ]
    return reduce(DataFrame.unionByName, keys)


# Dates and counts of pending orders do not convert, and their list of companies is cut off.
LOST_SQL = {
    "movies": "(SELECT 2 * count(*) FROM orders WHERE o_orderstatus = 'P')",
    "production_companies": "(SELECT count(*) FROM orders WHERE o_orderstatus = 'P')",
}
LOGGED_SQL = {
    spec.name: f"""
        SELECT '{spec.name}' AS "table", 'written' AS status,
               (SELECT count(*) FROM {"lineitem" if spec.prefix == "credits" else "orders"}) AS rows_in,
               (SELECT count(*) FROM (SELECT DISTINCT {", ".join(spec.keys)} FROM ({SILVER_SQL[spec.name]}))) AS rows_written,
               {LOST_SQL.get(spec.name, "0")} AS lost_values"""
    for spec in MOVIE_TABLES.values()
}


@query(" UNION ALL ".join(LOGGED_SQL.values()))
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of each table: rows in, rows written, values and lists lost."""
    log = read_log(spark, load_all(spark, sf_dir))
    return log.select("table", "status", "rows_in", "rows_written", "lost_values")


@query(
    f"""SELECT count(*) AS expected, count(*) FILTER (rows_in > 0) AS transformed,
               count(*) FILTER (rows_written > 0) AS written,
               CASE WHEN min(rows_written) > 0 THEN 'transformation_and_save_succeeded'
                    ELSE 'some_problem_occurred' END AS status
        FROM ({" UNION ALL ".join(LOGGED_SQL.values())})"""
)
def run_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(read_log(spark, load_all(spark, sf_dir))).drop("run_id", "objects")


NOTES = TableSpec("notes", "notes", ("id",), (("id", "id", "string"),))


@query(
    """SELECT 'movies' AS "table", 'written' AS status, count(*) AS rows_in, count(*) AS rows_written FROM orders
       UNION ALL SELECT 'cast', 'read_failed', NULL, NULL
       UNION ALL SELECT 'notes', 'no_objects', 0, NULL"""
)
def one_prefix_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good objects under one prefix, none under another, and one that is no Parquet under the third."""
    root, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    orders = table(spark, sf_dir, "orders")
    land(movies_bronze(orders), root, "movies")
    orders.select("o_comment" if "o_comment" in orders.columns else F.col("o_orderstatus")).write.text(
        f"{root}/{OBJECT.format(prefix='credits', day=DAY)}"
    )
    tables = {"movies": find("movies"), "cast": find("cast"), "notes": NOTES}
    log = run_day(spark, root, silver_root, DAY, tables=tables)
    return log.select("table", "status", "rows_in", "rows_written")


QUERIES["run_summary"] = QUERIES.pop("run_log_summary")
SQL["run_summary"] = SQL.pop("run_log_summary")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS movie_id,
              CASE WHEN o_orderdate >= DATE '1995-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS revenue,
              CASE WHEN o_orderdate >= DATE '1995-01-01' THEN 'second' ELSE o_orderstatus END AS status
       FROM orders"""
)
def two_day_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping days through the daily batch: the later day's movies win."""
    bronze_dir, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    orders = table(spark, sf_dir, "orders")
    first = movies_bronze(orders.where("o_orderdate < DATE '1996-01-01'"))
    second = movies_bronze(
        orders.where("o_orderdate >= DATE '1995-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    ).withColumn("status", F.lit("second"))
    tables = {"movies": find("movies")}
    for day, rows in (("20221104", first), ("20221105", second)):
        land(rows, bronze_dir, "movies", day)
        run_day(spark, bronze_dir, silver_root, day, tables=tables)
    return read_silver(spark, silver_root, find("movies")).select("movie_id", "revenue", "status")


@query(
    """SELECT 3 AS expected, 3 AS transformed, count(DISTINCT k) AS written,
              CASE WHEN count(DISTINCT k) = 3 THEN 'transformation_and_save_succeeded' ELSE 'some_problem_occurred' END AS status,
              count(DISTINCT k) + (SELECT count(DISTINCT k) FROM (SELECT 1 AS k FROM lineitem UNION SELECT 2 FROM lineitem)) AS entries
       FROM (SELECT 0 AS k FROM orders UNION SELECT 1 FROM lineitem UNION SELECT 2 FROM lineitem)"""
)
def retry_of_a_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credits cannot be read at first; once they are there, only their two tables are loaded again."""
    root, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    land(movies_bronze(orders), root, "movies")
    broken = f"{root}/{OBJECT.format(prefix='credits', day=DAY)}"
    lines.limit(1).select("l_returnflag").write.text(broken)
    tables = {name: find(name) for name in ("movies", "cast", "crew")}
    run_id = run_day(spark, root, silver_root, DAY, tables=tables).first()["run_id"]
    credits_bronze(lines).write.mode("overwrite").option("compression", PACKED).parquet(broken)
    retry_failed(spark, root, silver_root, run_id, tables=tables)
    log = read_log(spark, silver_root)
    return run_summary(log).drop("run_id", "objects").crossJoin(log.agg(F.count(F.lit(1)).alias("entries")))


@query(
    f"""SELECT name, count(*) AS movies, max(revenue) AS top_revenue
        FROM ({SILVER_SQL["genres"]}) g JOIN ({SILVER_SQL["movies"]}) m USING (movie_id)
        WHERE id <> -9999 GROUP BY name"""
)
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over the stored tables."""
    stored(spark, sf_dir, "genres", "movies")
    root = _stored[spark.sparkContext.applicationId, sf_dir]
    register_views(spark, root, [find("genres"), find("movies")])
    return spark.sql(
        """SELECT name, count(*) AS movies, max(revenue) AS top_revenue
           FROM genres JOIN movies USING (movie_id) WHERE id <> -9999 GROUP BY name"""
    )


EVENTS = TableSpec(
    name="events",
    prefix="events",
    keys=("event_id",),
    columns=(
        ("event_id", "event_id", "string"),
        ("user_id", "user_id", "string"),
        ("event_type", "event_type", "string"),
        ("value", "value", "double"),
        ("props", "props", "string"),
    ),
)


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
              event_type, value, props
       FROM events"""
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed events through the stream, ten objects at a time; a second call finds nothing."""
    bronze_dir, silver_root = land_events(spark, sf_dir), scratch_path(spark, "silver")
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        ingest_available(
            spark,
            bronze_dir,
            silver_root,
            "events",
            checkpoint,
            tables={"events": EVENTS},
            files_per_batch=10,
        )
    return read_silver(spark, silver_root, EVENTS)


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
              event_type, value, props
       FROM events"""
)
def stream_late_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of earlier days that land after those of later days are taken by the next call."""
    bronze_dir, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    checkpoint = scratch_path(spark, "checkpoint")
    events = table(spark, sf_dir, "events").withColumn("events_part", F.date_format("ts", "yyyyMMdd"))
    early = F.col("events_part") < SCAN_DAY
    for part in (events.where(~early), events.where(early)):
        part.write.mode("append").partitionBy("events_part").parquet(f"{bronze_dir}/events")
        ingest_available(spark, bronze_dir, silver_root, "events", checkpoint, tables={"events": EVENTS})
    return read_silver(spark, silver_root, EVENTS)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DOUBLE) AS price,
              CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note
       FROM orders"""
)
def stream_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of two schemas through the stream, as the daily batch loads them."""
    bronze_dir, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for name, part in two_kinds(table(spark, sf_dir, "orders")).items():
        part.repartition(2).write.parquet(f"{bronze_dir}/orders/{name}.parquet")
    checkpoint = scratch_path(spark, "checkpoint")
    ingest_available(spark, bronze_dir, silver_root, "orders", checkpoint, tables={"typed": TYPED}, files_per_batch=3)
    return read_silver(spark, silver_root, TYPED)


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
               CASE WHEN strftime(ts, '%Y%m%d') <= '{SCAN_DAY}' THEN value + 1 ELSE value END AS value, props
        FROM events"""
)
def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events land, those of the first days again with other values, and then the first delivery of
    these days once more, byte by byte under new names: the newer values stay."""
    bronze_dir, silver_root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    checkpoint = scratch_path(spark, "checkpoint")
    events = table(spark, sf_dir, "events")
    early = F.date_format("ts", "yyyyMMdd") <= SCAN_DAY

    def arrive() -> None:
        ingest_available(
            spark, bronze_dir, silver_root, "events", checkpoint, tables={"events": EVENTS}, redelivered_within="30 days"
        )

    events.where(early).write.parquet(f"{bronze_dir}/events/first.parquet")
    events.where(~early).write.parquet(f"{bronze_dir}/events/rest.parquet")
    arrive()
    events.where(early).withColumn("value", F.col("value") + 1).write.parquet(f"{bronze_dir}/events/changed.parquet")
    arrive()
    copy_objects(spark, f"{bronze_dir}/events/first.parquet", f"{bronze_dir}/events/again.parquet")
    arrive()
    return read_silver(spark, silver_root, EVENTS)


@query(
    """SELECT o_orderkey, o_totalprice AS old_price, o_totalprice + o_custkey % 3 AS new_price
       FROM orders WHERE o_custkey % 3 > 0"""
)
def aliased_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose price a load would change: both sides have the same columns, told apart by alias."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + F.col("o_custkey") % 3)
    both = orders.alias("old").join(changed.alias("new"), F.expr("old.o_orderkey = new.o_orderkey"))
    return both.where("new.o_totalprice <> old.o_totalprice").select(
        "old.o_orderkey",
        F.col("old.o_totalprice").alias("old_price"),
        F.col("new.o_totalprice").alias("new_price"),
    )


# ---------------------------------------------------------------- analyst questions

PERSON = "Supplier 7"


@query(
    f"""SELECT '{PERSON}' AS name, movie_id, title, revenue
        FROM ({SILVER_SQL["movies"]})
        WHERE movie_id IN (SELECT movie_id FROM ({SILVER_SQL["cast"]}) WHERE name = '{PERSON}')
        ORDER BY revenue DESC, movie_id LIMIT 1"""
)
def q1_top_movie_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.top_movie_of(*stored(spark, sf_dir, "cast", "movies"), PERSON)


@query(
    f"""SELECT id, name, movie_id, title, revenue
        FROM (SELECT c.id, c.name, m.movie_id, m.title, m.revenue
              FROM ({SILVER_SQL["cast"]}) c JOIN ({SILVER_SQL["movies"]}) m USING (movie_id)
              WHERE c.credit_id <> '0000000000')
        QUALIFY row_number() OVER (PARTITION BY id, name ORDER BY revenue DESC, movie_id) = 1"""
)
def q1_top_by_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.top_movies(*stored(spark, sf_dir, "cast", "movies"), movies_unique=True)


@query(
    f"""SELECT name, count(*) AS movies,
               round(CAST(sum(CAST(revenue AS DECIMAL(28, 4))) AS DOUBLE) / count(*), 2) AS avg_revenue,
               max(revenue) AS max_revenue
        FROM ({SILVER_SQL["genres"]}) g JOIN ({SILVER_SQL["movies"]}) m USING (movie_id)
        WHERE id <> -9999 GROUP BY name"""
)
def q2_group_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.revenue_by_genre(*stored(spark, sf_dir, "genres", "movies"), movies_unique=True)


@query(
    f"""SELECT CAST(year(release_date) AS INTEGER) AS year, CAST(month(release_date) AS INTEGER) AS month,
               count(*) AS movies,
               round(CAST(sum(CAST(revenue AS DECIMAL(28, 4))) AS DOUBLE), 2) AS revenue
        FROM ({SILVER_SQL["movies"]}) WHERE release_date IS NOT NULL GROUP BY 1, 2"""
)
def q3_month_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.revenue_by_month(*stored(spark, sf_dir, "movies"))


@query(
    f"""SELECT round(corr(CAST(date_diff('day', DATE '1970-01-01', release_date) AS DOUBLE), revenue), 6)
               AS correlation
        FROM ({SILVER_SQL["movies"]})"""
)
def q3_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.release_revenue_correlation(*stored(spark, sf_dir, "movies"))


@query(
    f"""WITH crew AS ({SILVER_SQL["crew"]}),
             sets AS (SELECT movie_id, string_agg(id::VARCHAR, ',' ORDER BY id) AS people
                      FROM (SELECT DISTINCT movie_id, id FROM crew) GROUP BY movie_id),
             directed AS (SELECT DISTINCT movie_id, id FROM crew WHERE job = 'Director'),
             times AS (SELECT id, people, count(*) AS n FROM directed JOIN sets USING (movie_id)
                       GROUP BY id, people)
        SELECT id, CAST(sum(n) AS BIGINT) AS movies, count(*) AS crews,
               round(max(n) / CAST(sum(n) AS DOUBLE), 4) AS same_crew_ratio, count(*) = 1 AS always
        FROM times GROUP BY id"""
)
def q4_crew_loyalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.crew_loyalty(*stored(spark, sf_dir, "crew"))


@query(
    f"""WITH crew AS ({SILVER_SQL["crew"]}),
             directed AS (SELECT DISTINCT movie_id, id FROM crew WHERE job = 'Director'),
             director AS (SELECT id FROM directed GROUP BY id ORDER BY count(*) DESC, id LIMIT 1),
             theirs AS (SELECT movie_id FROM directed WHERE id = (SELECT id FROM director))
        SELECT id, count(DISTINCT movie_id) AS shared, (SELECT count(*) FROM theirs) AS total,
               round(count(DISTINCT movie_id) / (SELECT CAST(count(*) AS DOUBLE) FROM theirs), 4) AS ratio
        FROM crew
        WHERE movie_id IN (SELECT movie_id FROM theirs) AND id <> (SELECT id FROM director)
        GROUP BY id"""
)
def q4_collab_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    (crew,) = stored(spark, sf_dir, "crew")
    return analyst.collaborators(crew, analyst.most_active(crew)).drop("director")


@query(
    f"""WITH crew AS ({SILVER_SQL["crew"]}),
             directed AS (SELECT DISTINCT movie_id, id AS director FROM crew WHERE job = 'Director'),
             totals AS (SELECT director, count(*) AS total FROM directed GROUP BY director)
        SELECT director, id, count(DISTINCT movie_id) AS shared, any_value(total) AS total,
               round(count(DISTINCT movie_id) / CAST(any_value(total) AS DOUBLE), 4) AS ratio
        FROM crew JOIN directed USING (movie_id) JOIN totals USING (director)
        WHERE id <> director GROUP BY director, id"""
)
def q4_all_collaborators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every director."""
    (crew,) = stored(spark, sf_dir, "crew")
    return analyst.collaborators(crew, crew.where("job = 'Director'").select("id"))


@query(
    f"""WITH m AS (SELECT movie_id, CASE WHEN runtime % 11 = 0 THEN NULL ELSE revenue END AS revenue
                   FROM ({SILVER_SQL["movies"]}))
        SELECT name, count(*) AS movies,
               round(CAST(sum(CAST(revenue AS DECIMAL(28, 4))) AS DOUBLE) / count(*), 2) AS avg_revenue,
               max(revenue) AS max_revenue
        FROM ({SILVER_SQL["genres"]}) g JOIN m USING (movie_id)
        WHERE id <> -9999 AND revenue IS NOT NULL GROUP BY name"""
)
def q2_odd_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue that is not a number, infinite or too large for money is left out of every measure."""
    genres, movies = stored(spark, sf_dir, "genres", "movies")
    odd = F.when(F.col("runtime") % 3 == 0, float("nan")).when(F.col("runtime") % 3 == 1, float("inf")).otherwise(1e40)
    revenue = F.when(F.col("runtime") % 11 == 0, odd).otherwise(F.col("revenue"))
    return analyst.revenue_by_genre(genres, movies.withColumn("revenue", revenue), movies_unique=True)


@query(f"""SELECT movie_id, title, department, job FROM ({SILVER_SQL["crew"]}) WHERE name = '{PERSON}'""")
def q5_member_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.crew_credits(*stored(spark, sf_dir, "crew"), PERSON)


# ---------------------------------------------------------------- SQL functions, sketches, rollups, frames


@query(
    f"""SELECT 'top_movie_of' AS question, movie_id, title, revenue AS amount FROM (
            SELECT movie_id, title, revenue FROM ({SILVER_SQL["movies"]})
            WHERE movie_id IN (SELECT movie_id FROM ({SILVER_SQL["cast"]}) WHERE name = '{PERSON}')
            ORDER BY revenue DESC, movie_id LIMIT 1)
        UNION ALL
        SELECT 'credits_of', movie_id, title, NULL FROM ({SILVER_SQL["crew"]}) WHERE name = '{PERSON}'
        UNION ALL
        SELECT 'released_between', movie_id, title, revenue FROM ({SILVER_SQL["movies"]})
        WHERE release_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-31'
        UNION ALL
        SELECT 'revenue_of_genre', '1-URGENT', CAST(count(*) AS VARCHAR), max(revenue)
        FROM ({SILVER_SQL["genres"]}) g JOIN ({SILVER_SQL["movies"]}) m USING (movie_id) WHERE name = '1-URGENT'
        UNION ALL
        SELECT 'colleagues_of', CAST(id AS VARCHAR), NULL, count(DISTINCT movie_id)
        FROM ({SILVER_SQL["crew"]}) WHERE id <> 7
          AND movie_id IN (SELECT movie_id FROM ({SILVER_SQL["crew"]}) WHERE id = 7) GROUP BY id"""
)
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questions as table functions of SQL, with their arguments as named parameters."""
    stored(spark, sf_dir, "cast", "crew", "genres", "movies")
    register_views(spark, _stored[spark.sparkContext.applicationId, sf_dir])
    register_functions(spark)
    return spark.sql(
        """SELECT 'top_movie_of' AS question, movie_id, title, revenue AS amount FROM top_movie_of(:person)
           UNION ALL SELECT 'credits_of', movie_id, title, NULL FROM credits_of(:person)
           UNION ALL SELECT 'released_between', movie_id, title, revenue FROM released_between(:first, :last)
           UNION ALL SELECT 'revenue_of_genre', :genre, CAST(movies AS STRING), max_revenue FROM revenue_of_genre(:genre)
           UNION ALL SELECT 'colleagues_of', CAST(id AS STRING), NULL, CAST(shared AS DOUBLE) FROM colleagues_of(:id)""",
        args={"person": PERSON, "first": date(1995, 3, 1), "last": date(1995, 3, 31), "genre": "1-URGENT", "id": 7},
    )


@query(
    f"""SELECT name, count(*) AS movies, 3 AS quantiles_in_bounds, true AS merged_as_recomputed
        FROM ({SILVER_SQL["genres"]}) g JOIN ({SILVER_SQL["movies"]}) m USING (movie_id)
        WHERE id <> -9999 GROUP BY name"""
)
def q2_revenue_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles and median of each genre from sketches that are stored by day, held against the exact ranks."""
    genres, movies = stored(spark, sf_dir, "genres", "movies")
    by_day = staged(analyst.revenue_sketches(genres, movies, movies_unique=True), "sketches")
    at_once = analyst.revenue_quantiles(analyst.revenue_sketches(genres, movies.withColumn("release_date", F.lit(None).cast("date")), True), "name")
    found = analyst.revenue_quantiles(by_day, "name")
    revenues = genres.where("id <> -9999").join(movies.select("movie_id", "revenue"), "movie_id")
    ranks = revenues.join(found, "name").groupBy("name").agg(
        *[
            ((F.count_if(F.col("revenue") < F.col(q)) / F.count(F.lit(1)) <= share + analyst.SKETCH_ERROR)
             & (F.count_if(F.col("revenue") <= F.col(q)) / F.count(F.lit(1)) >= share - analyst.SKETCH_ERROR)).cast("int").alias(q)
            for q, share in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
        ]
    )
    both = found.select("name", "movies").join(at_once.select("name", F.col("movies").alias("again")), "name")
    return both.join(ranks, "name").select(
        "name",
        "movies",
        (F.col("q25") + F.col("median") + F.col("q75")).alias("quantiles_in_bounds"),
        (F.col("movies") == F.col("again")).alias("merged_as_recomputed"),
    )


@query(
    f"""WITH m AS (SELECT CAST(year(release_date) AS INTEGER) AS year, CAST(month(release_date) AS INTEGER) AS month,
                          CAST(isodow(release_date) - 1 AS INTEGER) AS weekday, revenue,
                          CAST(date_diff('day', DATE '1970-01-01', release_date) AS DOUBLE) AS day
                   FROM ({SILVER_SQL["movies"]}) WHERE release_date IS NOT NULL)
        SELECT year, month, weekday,
               CASE grouping(year, month, weekday) WHEN 7 THEN 'all' WHEN 3 THEN 'year' WHEN 1 THEN 'month' ELSE 'weekday' END AS level,
               count(*) AS movies, round(CAST(sum(CAST(revenue AS DECIMAL(28, 4))) AS DOUBLE), 2) AS revenue,
               CASE WHEN min(day) < max(day) THEN round(regr_slope(revenue, day), 3) END AS slope,
               CASE WHEN min(day) < max(day) THEN round(regr_r2(revenue, day), 6) END AS r2
        FROM m GROUP BY GROUPING SETS ((), (year), (year, month), (weekday))"""
)
def q3_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.release_rollup(*stored(spark, sf_dir, "movies"))


@query(
    f"""WITH crew AS (SELECT DISTINCT movie_id, id FROM ({SILVER_SQL["crew"]})),
             directed AS (SELECT DISTINCT movie_id, id AS director FROM ({SILVER_SQL["crew"]}) WHERE job = 'Director'),
             steps AS (SELECT director, movie_id, release_date,
                              lag(movie_id) OVER (PARTITION BY director ORDER BY release_date NULLS FIRST, movie_id) AS previous
                       FROM directed LEFT JOIN ({SILVER_SQL["movies"]}) USING (movie_id)),
             sizes AS (SELECT movie_id, count(*) AS crew FROM crew GROUP BY movie_id),
             pairs AS (SELECT DISTINCT movie_id, previous FROM steps WHERE previous IS NOT NULL),
             same AS (SELECT p.movie_id, p.previous, count(*) AS n
                      FROM pairs p JOIN crew a ON a.movie_id = p.movie_id JOIN crew b ON b.movie_id = p.previous AND b.id = a.id
                      GROUP BY p.movie_id, p.previous),
             sized AS (SELECT steps.*, crew, CASE WHEN steps.previous IS NOT NULL THEN coalesce(n, 0) END AS kept
                       FROM steps JOIN sizes USING (movie_id)
                       LEFT JOIN same ON same.movie_id = steps.movie_id AND same.previous = steps.previous)
        SELECT director, movie_id, previous, crew, kept,
               round(avg(kept / CAST(crew AS DOUBLE)) OVER (PARTITION BY director ORDER BY release_date NULLS FIRST, movie_id
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS usual
        FROM sized"""
)
def q4_crew_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyst.crew_turnover(*stored(spark, sf_dir, "crew", "movies"))
