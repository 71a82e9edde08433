"""Features per user.

Each review is turned into a handful of small facts: its business, its categories,
its city, its sentiment, its frequent words.  Reviews are dealt out by user as
they are, and become facts where they arrive: these are several times as large,
so they are counted per (user, kind, key) and gathered per user without being
shuffled.  Businesses that are small meet the reviews after that shuffle; larger
ones meet them before, in one of their own that carries no texts.  Users with so
many reviews that they would hold up a task take another way: their facts are
counted before the shuffle, so that such a user costs a task its number of
distinct keys.  Everything comes out hash-partitioned by user, ready to be joined
without another shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clientele.functions.columns import map_of
from clientele.operators.cleaning import friend_count
from clientele.operators.dimension import is_small
from clientele.operators.sketches import heavy_keys

CATEGORIES, AREA, SENTIMENTS, WORDS = PARTS = ("categories", "area", "sentiments", "words")
ACTIVITY = "activity"

# Codes of the fact kinds, one byte each in the shuffle, by review column.
KINDS = {"categories": 0, "city": 1, "sentiment": 2, "frequent_words": 3, "activity": 4, "unplaced": 5}

# Rows of one user that a task takes in as they are; users with more are counted before the shuffle.
HEAVY_ROWS = 1_000_000

# Reviews that a task makes facts of, about; it holds a dozen facts of each.
DEALT_ROWS = 250_000

# Columns that hold the key of a kind, where they are not named like it.
_KEYS = {"activity": "visited", "given": "key"}

# What a user's visits to one business add up to, and how such sums are merged.
VISIT_SUMS = {
    "n": F.sum, "stars_sum": F.sum, "stars_n": F.sum, "first_seen": F.min, "last_seen": F.max,
    "min_stars": F.min, "max_stars": F.max,
}


def city_points(business: DataFrame) -> DataFrame:
    """One point per city: that of its lowest business id."""
    return business.where(F.col("city").isNotNull()).groupBy("city").agg(
        *[F.min_by(c, "business_id").alias(c) for c in ("latitude", "longitude")]
    )


def cities_by_state(business: DataFrame) -> DataFrame:
    """Businesses whose city is named with its state, so that cities of one name stay apart.

    For all features of places; a city without a state keeps its name.
    """
    named = F.concat_ws(", ", "city", "state")
    return business.withColumn("city", F.when(F.col("city").isNotNull(), named))


# Kinds that a visit has one of.
_VISITED = ("activity", "unplaced")


def _code(kind: str) -> Column:
    return F.lit(KINDS[kind]).cast("tinyint")


def _facts(rows: DataFrame, leading: Iterable[str], many: Iterable[str] = (), kept: Iterable[str] = ()) -> DataFrame:
    """One row (user_id, kind, key, kept...) per fact of a row of ``rows``.

    ``leading`` names kinds of one fact a row, ``many`` array columns; ``given`` is
    the fact that a row names itself.  Single facts lead the exploded array, the
    lists follow in order, so that a position tells the kind.
    """
    leading, many = list(leading), list(many)
    empty = F.array().cast("array<string>")
    lists = {name: F.coalesce(name, empty) for name in many}
    keys = F.concat(F.array(*[_KEYS.get(name, name) for name in leading]).cast("array<string>"), *lists.values())
    kind, at, end = F.lit(None).cast("tinyint"), F.col("at"), F.lit(len(leading))
    for name in many:
        start, end = end, end + F.col(f"_{name}")
        kind = F.when((at >= start) & (at < end), _code(name)).otherwise(kind)
    for place, name in enumerate(leading):
        kind = F.when(at == place, F.col("given") if name == "given" else _code(name)).otherwise(kind)
    sizes = [F.size(found).alias(f"_{name}") for name, found in lists.items()]
    own = ["given"] if "given" in leading else []
    return (
        rows.select("user_id", *kept, *own, *sizes, F.posexplode(keys).alias("at", "key"))
        .where(F.col("key").isNotNull())
        .select("user_id", kind.alias("kind"), "key", *kept)
    )


def visits_of(reviews: DataFrame) -> DataFrame:
    """One row per user and business with its ``VISIT_SUMS``.

    A business that a user reviews again and again meets its place once.
    """
    dated = reviews if "date" in reviews.columns else reviews.withColumn("date", F.lit(None).cast("timestamp"))
    return dated.groupBy("user_id", "business_id").agg(
        F.count("*").alias("n"), F.sum("stars").alias("stars_sum"), F.count("stars").alias("stars_n"),
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"),
        F.min("stars").alias("min_stars"), F.max("stars").alias("max_stars"),
    )


def merged_visits(visits: DataFrame) -> DataFrame:
    """Visit sums of several sets of reviews as those of all of them."""
    return visits.groupBy("user_id", "business_id").agg(*[f(c).alias(c) for c, f in VISIT_SUMS.items()])


def _as_visits(reviews: DataFrame) -> DataFrame:
    """Every review as a visit of its own, with the sums that its columns allow."""
    dated = {c: F.col("date") for c in ("first_seen", "last_seen") if "date" in reviews.columns}
    return reviews.withColumns({
        "n": F.lit(1).cast("bigint"), "stars_sum": F.col("stars"), "stars_n": F.col("stars").isNotNull().cast("bigint"),
        "min_stars": F.col("stars"), "max_stars": F.col("stars"), **dated,
    })


def heavy_users(rows: DataFrame) -> list[str]:
    """Users with over ``HEAVY_ROWS`` rows, from one pass that shuffles no key; some may have fewer."""
    found = heavy_keys(rows.select("user_id"), "user_id", 100).where(F.col("rows") > HEAVY_ROWS)
    return [r["user_id"] for r in found.collect()]


def dealt_partitions(rows: int, least: int) -> int | None:
    """How many partitions ``rows`` reviews are dealt out to, so that the facts of a task
    are bounded; None where they need no more than ``least``, which AQE may size by bytes."""
    wanted = -(-rows // DEALT_ROWS)
    return wanted if wanted > least else None


def text_counts(reviews: DataFrame) -> DataFrame:
    """Counted sentiments and frequent words (user_id, kind, key, n) of reviews with a user."""
    facts = _facts(reviews.where(F.col("user_id").isNotNull()), ["sentiment"], ["frequent_words"])
    return merged_texts(facts.withColumn("n", F.lit(1).cast("bigint")))


def merged_texts(texts: DataFrame) -> DataFrame:
    return texts.groupBy("user_id", "kind", "key").agg(F.sum("n").alias("n"))


def _review_rows(reviews: DataFrame, parts: set[str]) -> DataFrame:
    """The columns of reviews that ``parts`` come from; reviews without a user have no place here."""
    columns = []
    if parts & {ACTIVITY, CATEGORIES, AREA}:
        columns += ["business_id", "stars"]
    if ACTIVITY in parts:
        columns += [c for c in ("date",) if c in reviews.columns]
    columns += [c for c, part in (("sentiment", SENTIMENTS), ("frequent_words", WORDS)) if part in parts]
    return _with_unplaced(reviews.where(F.col("user_id").isNotNull()).select("user_id", *columns), parts)


def _with_unplaced(rows: DataFrame, parts: set[str]) -> DataFrame:
    """Visits without a business are a fact of their own: they count as activity only."""
    if ACTIVITY not in parts:
        return rows
    return rows.withColumn("unplaced", F.when(F.col("business_id").isNull(), ""))


def _packed(
    rows: DataFrame, texts: DataFrame | None, business: DataFrame | None, parts: set[str],
    dealt: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``rows``, and ``texts`` that meet no business, with the places of visits, ``dealt`` out once.

    The businesses are broadcast to where the rows have been dealt when measured
    to be small enough.  When they are not, visits and businesses meet in a shuffle
    of their own, where AQE splits the partition of a business that holds too many.
    """
    def with_texts(df: DataFrame, *more: DataFrame) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df, *more, *([texts] if texts else [])])

    placed = [c for c, part in (("city", AREA), ("categories", CATEGORIES)) if part in parts]
    if not placed:
        return dealt(with_texts(rows.withColumn("visited", F.col("business_id")) if ACTIVITY in parts else rows))
    place = business.select("business_id", *placed)
    small = is_small(place)
    if AREA in parts:
        # Points join the businesses here, not the users later: a city in
        # which many users live never becomes a join key of theirs.
        points = city_points(business)
        place = place.join(F.broadcast(points) if small else points, "city", "left")
    columns = [c for c in place.columns if c != "business_id"]
    place = place.groupBy("business_id").agg(F.collect_list(F.struct(*columns)).alias("places"))
    # Rows without a known business count for the other parts only.
    how = "left" if parts - {AREA, CATEGORIES} else "inner"
    if small:
        return _with_places(dealt(with_texts(rows)).join(F.broadcast(place), "business_id", how), columns)
    own = [c for c in ("sentiment", "frequent_words") if c in rows.columns]
    met = _with_places(rows.drop(*own).join(place, "business_id", how), columns)
    return dealt(with_texts(met, *([rows.select("user_id", *own)] if own else [])))


def _with_places(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per place of a row; a business that is listed again is another visit, with no text of its own."""
    spread = rows.select(*[c for c in rows.columns if c != "places"], F.posexplode_outer("places").alias("copy", "place"))
    texts = [c for c in ("sentiment", "frequent_words") if c in rows.columns]
    first = F.coalesce("copy", F.lit(0)) == 0
    return spread.withColumns({
        "visited": F.concat(F.coalesce("copy", F.lit(0)).cast("string"), F.lit(":"), "business_id"),
        **{c: F.when(first, F.col(c)) for c in texts}, **{c: F.col("place")[c] for c in columns},
    }).drop("copy", "place")


def _all_facts(rows: DataFrame, parts: set[str]) -> DataFrame:
    """The facts of packed rows, each with the sums that its row carries."""
    if "n" not in rows.columns:
        rows = _as_visits(rows) if "stars" in rows.columns else rows.withColumn("n", F.lit(1).cast("bigint"))
    leading = {
        "given": "given" in rows.columns, "activity": ACTIVITY in parts, "unplaced": ACTIVITY in parts,
        "city": AREA in parts, "sentiment": "sentiment" in rows.columns,
    }
    kept = [c for c in (*VISIT_SUMS, "latitude", "longitude") if c in rows.columns]
    return _facts(
        rows, [k for k, there in leading.items() if there],
        [c for c in ("categories", "frequent_words") if c in rows.columns], kept)


def _counted_facts(facts: DataFrame, parts: set[str]) -> DataFrame:
    """Sums per (user, kind, key); facts that lie by user stay where they are."""
    # Each sum is kept for the kinds that show it.
    shown = {"n": F.sum("n")}
    if parts & {ACTIVITY, CATEGORIES}:
        starred = F.col("kind").isin(*[KINDS[k] for k in (*_VISITED, "categories")])
        shown |= {c: F.sum(F.when(starred, F.col(c))) for c in ("stars_sum", "stars_n")}
    if ACTIVITY in parts:
        dated = [c for c in ("first_seen", "last_seen", "min_stars", "max_stars") if c in facts.columns]
        shown |= {c: VISIT_SUMS[c](_of(_VISITED, c)) for c in dated}
    if AREA in parts:
        # All facts of a city carry the same point.
        shown |= {c: F.max(_of("city", c)) for c in ("latitude", "longitude")}
    return facts.groupBy("user_id", "kind", "key").agg(*[v.alias(c) for c, v in shown.items()])


def _of(kinds: str | Iterable[str], value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    wanted = [KINDS[k] for k in ([kinds] if isinstance(kinds, str) else kinds)]
    return F.when(F.col("kind").isin(*wanted), value)


def _pairs(kind: str, value: Column) -> Column:
    """The (key, value) pairs of one kind; pairs without a value are left out."""
    pair = F.when(value.isNotNull(), F.struct(F.col("key"), value.alias("value")))
    return map_of(F.collect_list(_of(kind, pair)))


def user_features(
    reviews: DataFrame, business: DataFrame | None = None, parts: Iterable[str] = PARTS, partitions: int | None = None
) -> DataFrame:
    """One row per user with the map features of ``parts``.

    Maps are empty, and the city null, where a user has nothing to show.
    ``partitions`` fixes how many the users are dealt out to; without it that follows the reviews.
    """
    parts = set(parts)
    return _features(_review_rows(reviews, parts), None, business, parts, partitions)


def merged_features(
    visits: DataFrame, texts: DataFrame, business: DataFrame, only: DataFrame | None = None
) -> DataFrame:
    """All features, activity included, from sums that ``merged_visits`` and ``merged_texts`` take in.

    ``only`` lists users (user_id) to whom the features are restricted, some of them again and again.
    """
    parts = {ACTIVITY, *PARTS}
    texts = texts.withColumnRenamed("kind", "given")
    if only is not None:
        users = only.distinct()
        if is_small(users):
            visits, texts = (rows.join(F.broadcast(users), "user_id", "left_semi") for rows in (visits, texts))
            only = None
    return _features(_with_unplaced(visits, parts), texts, business, parts, only=only)


def _features(
    rows: DataFrame, texts: DataFrame | None, business: DataFrame | None, parts: set[str],
    partitions: int | None = None, only: DataFrame | None = None,
) -> DataFrame:
    def made(dealt: Callable[[DataFrame], DataFrame]) -> DataFrame:
        facts = _all_facts(_packed(rows, texts, business, parts, dealt), parts)
        return _gathered(_counted_facts(facts, parts), parts)

    # The pass that looks for heavy users counts the rows as well.
    watch = Observation()
    heavy = heavy_users(rows.select("user_id").observe(watch, F.count(F.lit(1)).alias("rows")))
    if partitions is None:
        partitions = dealt_partitions(watch.get["rows"], rows.sparkSession.sparkContext.defaultParallelism)
    by_user = ([partitions] if partitions else []) + ["user_id"]

    def dealt(df: DataFrame) -> DataFrame:
        if only is None:
            return df.repartition(*by_user)
        # Many users are met where the rows have been dealt.  A semi join would be
        # moved to where the rows come from, in a shuffle of its own.
        return df.repartition(*by_user).join(only.repartition(*by_user).distinct(), "user_id")

    if not heavy:
        return made(dealt)
    is_heavy = F.col("user_id").isin(heavy)

    def spread(df: DataFrame) -> DataFrame:
        rows = df.where(is_heavy)
        return rows if only is None else rows.join(F.broadcast(only.where(is_heavy).distinct()), "user_id")

    return made(lambda df: dealt(df.where(~is_heavy))).unionByName(made(spread))


def _gathered(facts: DataFrame, parts: set[str]) -> DataFrame:
    made: dict[str, Column] = {}
    if ACTIVITY in parts:
        first, last = (
            f(_of(_VISITED, c)) if c in facts.columns else F.lit(None).cast("timestamp")
            for f, c in ((F.min, "first_seen"), (F.max, "last_seen")))
        made |= {
            "first_seen": first,
            "last_seen": last,
            "date_diff": F.datediff(last, first),
            "different_business_count": F.count(_of("activity", "key")),
            "avg_rating": F.try_divide(F.sum(_of(_VISITED, "stars_sum")), F.sum(_of(_VISITED, "stars_n"))),
            "min_stars": F.min(_of(_VISITED, "min_stars")),
            "max_stars": F.max(_of(_VISITED, "max_stars")),
        }
    if CATEGORIES in parts:
        made |= {
            "category_map": _pairs("categories", F.col("n")),
            "category_avg_stars": _pairs(
                "categories", F.try_divide(F.col("stars_sum"), F.col("stars_n"))
            ),
        }
    if AREA in parts:
        visit = F.struct((-F.col("n")).alias("order"), "key", "n", "latitude", "longitude")
        made["visits"] = F.sort_array(F.collect_list(_of("city", visit)))
    if SENTIMENTS in parts:
        made["sentiment_map"] = _pairs("sentiment", F.col("n"))
    if WORDS in parts:
        made["frequent_words_map"] = _pairs("frequent_words", F.col("n"))

    users = facts.groupBy("user_id").agg(
        *[value.alias(name) for name, value in made.items()]
    )
    if AREA in parts:
        # Visits are sorted: the home city leads, the rest is travel.
        home = F.get("visits", F.lit(0))
        away = F.filter("visits", lambda v, i: i > 0)
        users = users.withColumns({
            "user_city": home["key"],
            "travel_map": F.map_from_entries(F.transform(away, lambda v: F.struct(v["key"], v["n"]))),
            "latitude": home["latitude"],
            "longitude": home["longitude"],
        }).drop("visits")
    return users


def has_all(parts: Iterable[str] = PARTS) -> Column:
    """True for users that have every feature of ``parts``."""
    shown = {
        CATEGORIES: (F.size("category_map") > 0) & (F.size("category_avg_stars") > 0),
        AREA: F.col("user_city").isNotNull(),
        SENTIMENTS: F.size("sentiment_map") > 0,
        WORDS: F.size("frequent_words_map") > 0,
    }
    condition = F.lit(True)
    for part in parts:
        condition = condition & shown[part]
    return condition


def user_activity(reviews: DataFrame) -> DataFrame:
    """First and last review, days between, businesses, mean and extreme stars."""
    first, last = F.min("date"), F.max("date")
    return reviews.groupBy("user_id").agg(
        first.alias("first_seen"),
        last.alias("last_seen"),
        F.datediff(last, first).alias("date_diff"),
        F.count_distinct("business_id").alias("different_business_count"),
        F.avg("stars").alias("avg_rating"),
        F.min("stars").alias("min_stars"),
        F.max("stars").alias("max_stars"),
    )


def category_counts(reviews: DataFrame, business: DataFrame) -> DataFrame:
    users = user_features(reviews, business, [CATEGORIES])
    return users.select("user_id", "category_map").where(F.size("category_map") > 0)


def category_ratings(reviews: DataFrame, business: DataFrame) -> DataFrame:
    users = user_features(reviews, business, [CATEGORIES])
    return users.select("user_id", "category_avg_stars").where(F.size("category_avg_stars") > 0)


def user_area(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """Home city (most visited, then first by name), its point, other cities."""
    return user_features(reviews, business, [AREA]).where(has_all([AREA]))


def sentiment_counts(reviews: DataFrame) -> DataFrame:
    return user_features(reviews, parts=[SENTIMENTS]).where(has_all([SENTIMENTS]))


def frequent_words(reviews: DataFrame) -> DataFrame:
    """In how many of a user's reviews each word is among the most frequent."""
    return user_features(reviews, parts=[WORDS]).where(has_all([WORDS]))


def user_words(reviews: DataFrame) -> DataFrame:
    """The frequent words as rows (user_id, word, n): nothing is gathered per user,
    however many words an account has."""
    facts = _counted_facts(_all_facts(_review_rows(reviews, {WORDS}), {WORDS}), {WORDS})
    return facts.select("user_id", F.col("key").alias("word"), "n")


def friends_counts(friends: DataFrame, empty: tuple[str, ...] = ()) -> DataFrame:
    """Friends per user; ``empty`` names placeholders that stand for none."""
    return friends.select("user_id", friend_count(F.col("friends"), empty).alias("friends_count"))
