"""The wide profile: one row per user, scalars and maps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clientele import schemas
from clientele.operators import cleaning, features, sampling
from clientele.operators.dimension import small_side
from clientele.session import prepare_shuffles
from clientele.sources.files import (
    content_hash,
    flat_columns,
    input_state,
    materialize,
    parsed_columns,
    read_json,
    sample_dir,
    save_table,
)
from clientele.streaming.ingest import TOPICS, has_written, read_sink


def build_profile(
    users: DataFrame, reviews: DataFrame, business: DataFrame, how: str = "inner", partitions: int | None = None
) -> DataFrame:
    """Cleaned users joined with every feature.

    ``inner`` keeps the users that have all features, ``left`` all users.  The
    features arrive hash-partitioned by user, so the join moves only the users,
    and not even these if they are bucketed into as many ``partitions``.
    """
    parts = (features.ACTIVITY, *features.PARTS)
    return join_features(users, features.user_features(reviews, business, parts, partitions), how)


def join_features(users: DataFrame, made: DataFrame, how: str = "inner") -> DataFrame:
    if how == "inner":
        made = made.where(features.has_all())
    return users.join(made, "user_id", how).select(*schemas.PROFILE_COLUMNS)


@dataclass
class RawPaths:
    """JSON-lines inputs of a batch run."""

    users: str
    business: str
    reviews: str
    tips: str
    checkins: str


def _streamed_reviews(spark: SparkSession, streamed: str, chosen: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Reviews that the ingest has enriched, each once; malformed ones are left out."""
    rows = read_sink(spark, streamed, "reviews")
    rows = rows.where(F.col("review_id").isNotNull() & F.col("user_id").isNotNull())
    return chosen(rows).dropDuplicates(["review_id"])


def rows_not_in(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows without an equal in ``others``, by a digest of all their columns."""
    columns = sorted(rows.columns)

    def digest() -> Column:
        return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)

    seen = others.select(digest().alias("_digest")).distinct()
    return rows.withColumn("_digest", digest()).join(seen, "_digest", "left_anti").select(*rows.columns)


def run_batch(
    spark: SparkSession,
    paths: RawPaths,
    output: str,
    lexicon: DataFrame,
    fraction: float = 1.0,
    mode: str = "hash",
    how: str = "inner",
    streamed: str | None = None,
    empty_friends: tuple[str, ...] = (),
    tasks: int | None = None,
    counts: dict[str, int] | None = None,
    once: bool = False,
) -> DataFrame:
    """Sample, clean, enrich and merge; each table is written once and reread.

    The raw reviews, by far the largest input, are read once (twice for the top
    sample, which has to count first): the sampled ids come from the columns of
    the written review table.  ``tasks`` deals them out to that many tasks, for
    inputs that cannot be split.

    ``streamed`` is the output of an ingest.  Its reviews are enriched already
    and join the batch's; one that both have counts once, as the batch has it.
    Its tips and check-ins, which have no ids, are added to the batch's; with
    ``once``, those that equal one of the batch's in every column are the same,
    and are left out.

    A run that was interrupted continues after the last finished table.  A table
    is made again when the inputs or arguments that it depends on have changed.
    ``counts`` receives the rows of each table.
    """
    prepare_shuffles(spark)
    out = sample_dir(output, fraction)
    inputs = [input_state(spark, p) for p in vars(paths).values()]
    if streamed:
        inputs += [input_state(spark, f"{streamed}/{topic}/data") for topic in TOPICS]
    base = [*inputs, str(fraction), mode, content_hash(lexicon), *(["once"] if once else [])]

    def keep(name: str, build: Callable[[], DataFrame], *arguments) -> DataFrame:
        watch = Observation(name)
        made_from = "\n".join([*base, *map(str, arguments)])
        seen: list[int] = []

        def observed() -> DataFrame:
            seen.append(1)
            return build().observe(watch, F.count(F.lit(1)).alias("rows"))

        table = materialize(spark, f"{out}/{name}", observed, made_from=made_from)
        if counts is not None:
            counts[name] = watch.get["rows"] if seen else table.count()
        return table

    raw_reviews = read_json(spark, paths.reviews, schemas.REVIEW)
    if tasks:
        raw_reviews = raw_reviews.repartition(tasks)
    sampled, ranked = fraction < 1, mode == "top"
    user_ids = business_ids = None
    chosen: Callable[[DataFrame], DataFrame] = lambda rows: rows
    if sampled and ranked:
        user_ids = keep("sampled_user_id", lambda: sampling.top_users(raw_reviews, fraction))
        small_ids = small_side(user_ids)
        chosen = lambda rows: sampling.restrict(rows, small_ids, "user_id")
    elif sampled:
        chosen = lambda rows: rows.where(sampling.drawn(fraction, mode))
    reviews = keep("review", lambda: cleaning.enrich_reviews(chosen(raw_reviews), lexicon), tasks)
    if streamed and has_written(spark, streamed, "reviews"):
        own = reviews
        reviews = keep("all_review", lambda: own.unionByName(
            _streamed_reviews(spark, streamed, chosen).join(own.select("review_id"), "review_id", "left_anti")
        ), tasks)
    if sampled:
        if not ranked:
            user_ids = keep("sampled_user_id", lambda: reviews.select("user_id").distinct())
        business_ids = keep("sampled_business_id", lambda: reviews.select("business_id").distinct())
        user_ids, business_ids = small_side(user_ids), small_side(business_ids)

    def of_users(rows: DataFrame) -> DataFrame:
        return sampling.restrict(rows, user_ids, "user_id")

    def of_business(rows: DataFrame) -> DataFrame:
        return sampling.restrict(rows, business_ids, "business_id")

    def with_streamed(rows: DataFrame, topic: str) -> DataFrame:
        if streamed and has_written(spark, streamed, topic):
            more = read_sink(spark, streamed, topic)
            return rows.unionByName(rows_not_in(more, rows) if once else more)
        return rows

    # Users carry their friends, so that the raw ones are read once.
    users = keep("user", lambda: cleaning.typed_users(
        of_users(read_json(spark, paths.users, schemas.USER)), empty_friends), empty_friends)
    keep("friends", lambda: users.select("user_id", "friends"))
    business = keep("business", lambda: cleaning.clean_business(
        of_business(read_json(spark, paths.business, schemas.BUSINESS))))
    keep("checkin", lambda: of_business(with_streamed(
        cleaning.clean_checkins(read_json(spark, paths.checkins, schemas.CHECKIN)), "checkins")))
    keep("tip", lambda: of_users(with_streamed(
        cleaning.clean_tips(read_json(spark, paths.tips, schemas.TIP)), "tips")))
    return keep("combined", lambda: build_profile(users, reviews, business, how), how, empty_friends, tasks)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (table, rows), one per table; Parquet tables are counted from their footers."""
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def publish_profile(profile: DataFrame, table: str, **options) -> None:
    """Store a profile the way warehouses hold it: maps and lists as JSON text."""
    save_table(flat_columns(profile), table, **options)


def load_profile(spark: SparkSession, table: str) -> DataFrame:
    """A published profile with its maps and lists."""
    return parsed_columns(spark.table(table), schemas.PROFILE_JSON)
