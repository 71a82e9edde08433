"""Review-platform records derived from the order and event tables.

The given tables hold customers, parts, orders, line items, events, documents
and conversations.  Each function below reads them as raw records of the
shapes declared in ``schemas``; every record is computed from one row, or from
one equi-join, so the stand-ins grow with the tables and need no more of the
cluster than a scan does.

users     customers and their orders
business  parts, placed in the nations
reviews   line items with their orders (stars only), and documents with the
          order of the same number (stars and text)
tips      turns of the conversations
checkins  events, one to three times each
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele import schemas
from clientele.sources.files import spread
from clientele.sources.topics import as_messages

TIME = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def _id(prefix: str, column: Column | str) -> Column:
    return F.concat(F.lit(prefix), F.col(column) if isinstance(column, str) else column)


def _shape(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("review_count"),
        F.date_format(F.min("o_orderdate"), TIME).alias("yelping_since"),
        F.sort_array(F.collect_set(F.year("o_orderdate").cast("string"))).alias("years"),
        F.avg(1 + F.col("o_orderkey") % 5).alias("average_stars"),
    )
    key = F.col("c_custkey")
    useful = F.floor(F.abs("c_acctbal"))
    friends = F.transform(F.sequence(key + 1, key + key % 13), lambda i: _id("u", i))
    years = F.concat_ws(",", F.col("years"))
    return _shape(
        table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumns({
            "user_id": _id("u", key),
            "name": F.col("c_name"),
            "review_count": F.coalesce("review_count", F.lit(0)),
            "useful": useful,
            "funny": useful % 100,
            "cool": useful % 37,
            "fans": key % 50,
            # Some lists carry the stray "20" entries seen in real ones.
            "elite": F.when(key % 7 == 0, F.concat(years, F.lit(",20,20")))
            # and numbers that are no years.
            .when(key % 11 == 0, F.concat(years, F.lit(", 201,20125"))).otherwise(years),
            "friends": F.when(key % 13 == 0, "None").otherwise(F.array_join(friends, ", ")),
            **{c: (useful + i) % (10 + i) for i, c in enumerate(schemas.COMPLIMENTS)},
        }),
        schemas.USER,
    )


def raw_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    names = F.concat(F.regexp_replace("p_name", " ", ", "), F.lit(", "), F.col("p_type"))
    # Some names hold a bare comma.
    names = F.when(key % 10 == 3, F.concat(names, F.lit(", Food,Drink"))).otherwise(names)
    part = table(spark, sf_dir, "part").withColumn("nation", (key % 25).cast("int"))
    return _shape(
        part.join(table(spark, sf_dir, "nation"), F.col("nation") == F.col("n_nationkey"))
        .withColumns({
            "business_id": _id("b", key),
            "name": F.col("p_name"),
            "address": F.concat("p_brand", F.lit(" street")),
            "attributes": F.create_map(
                F.lit("Size"), F.col("p_size").cast("string"), F.lit("Type"), F.col("p_type")
            ),
            "hours": F.create_map(F.lit("Monday"), F.concat((key % 12).cast("string"), F.lit(":0-18:0"))),
            "categories": F.when(key % 50 != 0, names),
            "city": F.col("n_name"),
            "state": _id("S", "n_regionkey"),
            "latitude": F.col("n_nationkey") * 2.0 + (key % 10) / 4.0,
            "longitude": F.col("n_nationkey") * -3.0 + (key % 8) / 8.0,
            "is_open": key % 2,
            "postal_code": F.lpad((key % 100000).cast("string"), 5, "0"),
            "review_count": F.col("p_size"),
            "stars": 1 + (key % 9) / 2.0,
        }),
        schemas.BUSINESS,
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", _id("u", "o_custkey").alias("user_id"),
        F.date_format("o_orderdate", TIME).alias("date"),
    )
    part = F.col("l_partkey")
    rated = (
        spread(table(spark, sf_dir, "lineitem"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns({
            "review_id": F.concat_ws("-", F.lit("l"), "l_orderkey", "l_linenumber", part, "l_suppkey"),
            "business_id": _id("b", part),
            "stars": F.when(part % 40 != 0, 1 + (F.col("l_quantity") - 1) % 5),
            "text": F.lit(None),
            "useful": F.col("l_linenumber"),
            "funny": F.col("l_linenumber") % 2,
            "cool": F.lit(0),
        })
    )
    doc = F.col("doc_id")
    written = (
        documents(spark, sf_dir)
        .join(orders, doc == F.col("o_orderkey"))
        .withColumns({
            "review_id": _id("d", doc),
            "business_id": _id("b", doc % 200),
            "stars": 1 + doc % 5,
            "useful": doc % 9,
            "funny": doc % 4,
            "cool": doc % 3,
        })
    )
    return _shape(rated, schemas.REVIEW).unionByName(_shape(written, schemas.REVIEW))


def written_reviews(documents: DataFrame) -> DataFrame:
    """Documents alone as reviews, their source as the user."""
    doc = F.col("doc_id")
    return _shape(
        documents.withColumns({
            "review_id": _id("d", doc),
            "user_id": F.col("source"),
            "business_id": _id("b", doc % 200),
            "stars": 1 + doc % 5,
            "useful": doc % 9,
            "funny": doc % 4,
            "cool": doc % 3,
            "date": F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (doc % 1000).cast("int")), TIME),
        }),
        schemas.REVIEW,
    )


def tips_of(conversations: DataFrame) -> DataFrame:
    conv = F.col("conv_id")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (conv % 365).cast("int"))
    return _shape(
        conversations.withColumns({
            "user_id": _id("u", conv),
            "business_id": _id("b", conv % 200),
            "compliment_count": F.col("turn"),
            # Some dates cannot be read.
            "date": F.when(conv % 11 == 0, "soon").otherwise(F.date_format(day, TIME)),
        }),
        schemas.TIP,
    )


def raw_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tips_of(spread(table(spark, sf_dir, "conversations")))


def _place(props: Column | str = "props") -> Column:
    return _id("b", F.get_json_object(props, "$.k"))


def checkins_of(events: DataFrame) -> DataFrame:
    times = F.transform(
        F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")),
        lambda d: F.date_format(F.col("ts") + F.make_dt_interval(days=d), TIME),
    )
    return _shape(
        events.withColumns({"business_id": _place(), "date": F.array_join(times, ", ")}),
        schemas.CHECKIN,
    )


def raw_checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkins_of(table(spark, sf_dir, "events"))


def event_reviews(events: DataFrame) -> DataFrame:
    """Events as short reviews."""
    return _shape(
        events.withColumns({
            "review_id": _id("e", "event_id"),
            "user_id": _id("u", "user_id"),
            "business_id": _place(),
            "stars": F.col("value"),
            "text": F.col("event_type"),
            "date": F.date_format("ts", TIME),
            "useful": F.col("event_id") % 9,
            "funny": F.col("event_id") % 4,
            "cool": F.col("event_id") % 3,
        }),
        schemas.REVIEW,
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream."""
    schema = table(spark, sf_dir, name).schema
    # The glob covers a table that is one file and one that is a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def event_messages(events: DataFrame) -> DataFrame:
    """Event reviews as topic messages; some of them are cut short."""
    rows = event_reviews(events)
    number = F.substring("review_id", 2, 20).cast("bigint")
    broken = rows.select(
        F.when(number % 97 == 0, F.lit('{"review_id": "e').cast("binary"))
        .otherwise(F.to_json(F.struct("*")).cast("binary")).alias("value")
    )
    return broken


def checkin_messages(events: DataFrame) -> DataFrame:
    return as_messages(checkins_of(events))
