"""The registered queries: (session, folder of the given tables) to result."""

from __future__ import annotations

import datetime
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, TimestampNTZType, TimestampType

from clientele import schemas
from clientele.functions.columns import map_text
from clientele.functions.sentiment import MAX_INLINE_WORDS
from clientele.operators import cleaning, features, reports, sampling, sketches, variants
from clientele.operators import segment as seg
from clientele.operators.segment import FilterSpec, Segment
from clientele.plans.increment import FactStore, refresh_profile, start_fact_sink, stored_profile
from clientele.plans.profile import (
    RawPaths, build_profile, load_profile, publish_profile, run_batch, table_counts)
from clientele.session import prepare_shuffles, prepare_state
from clientele.sources import files, layout, standins, topics
from clientele.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# The caller's lexicon of these queries: function words of the four languages
# the documents are written in.
LEXICON = {
    "the": 0.9, "of": -0.7, "and": 1.3, "was": -1.9, "that": 1.1, "with": -1.4, "by": 0.6,
    "le": 1.2, "les": -1.5, "et": 0.8, "de": -0.4,
    "der": 1.6, "und": -0.9, "mit": -1.2,
    "el": -1.1, "que": 0.7, "los": 1.4,
}
FRACTION = 0.1
# Messages of a micro-batch.
BATCH_BYTES = 512 * 1024 * 1024
# Bytes of the given tables that become one file of messages, which one task writes and reads.
FILE_BYTES = 8 * 1024 * 1024
# Users that share a clustered file.
FILE_USERS = 50_000
AS_OF = datetime.date(2001, 8, 1)
NOW = {"availableNow": True}

# Ranges of the segment queries, in the order of the default filters.
RANGES = ((2, None), (2, 4), (5, 40), (100, 2400), (100, None))
FILTERS = tuple(f.enable(r) for f, r in zip(seg.DEFAULT_FILTERS, RANGES, strict=True))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "word string, valence double")


_REMOVED_AT_END: set[str] = set()

# Shared tables ---------------------------------------------------------------

def _folder(spark: SparkSession, sf_dir: str) -> str:
    """Where this application keeps tables made from ``sf_dir``, until it ends."""
    name = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    of_application = f"{files.shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if of_application not in _REMOVED_AT_END:
        _REMOVED_AT_END.add(of_application)
        files.remove_at_end(spark, of_application)
    return f"{of_application}/{name}"


def _scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{_folder(spark, sf_dir)}/{name}-{uuid.uuid4().hex[:8]}"


def review_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched reviews, written once per application and read from then on."""
    return files.materialize(spark, f"{_folder(spark, sf_dir)}/review", lambda: (
        cleaning.enrich_reviews(standins.raw_reviews(spark, sf_dir), lexicon(spark))
    ))


def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile, written once per application and read from then on."""
    return files.materialize(
        spark, f"{_folder(spark, sf_dir)}/combined", lambda: _profile(spark, sf_dir)
    )


def _profile(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    return build_profile(
        cleaning.clean_users(standins.raw_users(spark, sf_dir)),
        review_table(spark, sf_dir),
        cleaning.clean_business(standins.raw_business(spark, sf_dir)),
        how,
    )


def _typed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standins.raw_reviews(spark, sf_dir)
    return raw.withColumn("date", F.try_to_timestamp(F.col("date")))


def _business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_business(standins.raw_business(spark, sf_dir))


def portable(df: DataFrame) -> DataFrame:
    """Columns in types every SQL engine prints alike: maps, lists and times
    as text, counts as 64-bit integers."""

    def plain(name, kind):
        column = F.col(name)
        if isinstance(kind, MapType):
            return map_text(column)
        if isinstance(kind, ArrayType):
            if isinstance(kind.elementType, TimestampType):
                column = F.transform(column, lambda t: F.date_format(t, standins.TIME))
            return F.array_join(column, ",")
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.date_format(column, standins.TIME)
        return column.cast("bigint") if isinstance(kind, IntegerType) else column

    return df.select([plain(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_shuffles(spark)
        return portable(run(spark, sf_dir))

    QUERIES[run.__name__] = prepared
    return run


# Sources, sinks, primitives --------------------------------------------------

@query
def prim_project(spark, sf_dir):
    return standins.raw_reviews(spark, sf_dir).select("user_id", "business_id")


@query
def src_json_roundtrip(spark, sf_dir):
    path = _scratch(spark, sf_dir, "json")
    files.write_json(standins.raw_reviews(spark, sf_dir), path)
    return files.read_json(spark, path, schemas.REVIEW)


@query
def src_json_map_schema(spark, sf_dir):
    path = _scratch(spark, sf_dir, "json-map")
    raw = standins.raw_business(spark, sf_dir)
    nested = F.struct(
        F.col("attributes")["Size"].cast("int").alias("Size"), F.col("attributes")["Type"].alias("Type")
    )
    raw.withColumn("attributes", nested).write.json(path)
    return files.read_json(spark, path, schemas.BUSINESS)


@query
def op_materialize(spark, sf_dir):
    path = files.sample_dir(_scratch(spark, sf_dir, "cache"), FRACTION) + "/visits"

    def build():
        reviews = standins.raw_reviews(spark, sf_dir)
        ids = sampling.sample_users(reviews, FRACTION)
        return sampling.restrict(reviews, ids, "user_id").groupBy("user_id", "business_id").agg(
            F.count("*").alias("visits")
        )

    files.materialize(spark, path, build)
    return files.materialize(spark, path, build)


@query
def sink_table(spark, sf_dir):
    name = f"users_{uuid.uuid4().hex[:8]}"
    publish_profile(profile_table(spark, sf_dir), name, path=_scratch(spark, sf_dir, "users"))
    return load_profile(spark, name)


# Samples ---------------------------------------------------------------------

@query
def sample_users_hash(spark, sf_dir):
    return sampling.sample_users(standins.raw_reviews(spark, sf_dir), FRACTION)


@query
def sample_top_fraction(spark, sf_dir):
    return sampling.sample_users(standins.raw_reviews(spark, sf_dir), FRACTION, "top")


@query
def sample_business(spark, sf_dir):
    reviews = standins.raw_reviews(spark, sf_dir)
    return sampling.sample_business(reviews, sampling.sample_users(reviews, FRACTION))


@query
def sample_semi_join(spark, sf_dir):
    reviews = standins.raw_reviews(spark, sf_dir)
    ids = sampling.sample_users(reviews, FRACTION)
    return sampling.restrict(reviews, ids, "user_id").select("review_id", "user_id", "stars")


# Cleaning and text -----------------------------------------------------------

@query
def clean_users(spark, sf_dir):
    return cleaning.clean_users(standins.raw_users(spark, sf_dir))


@query
def clean_business(spark, sf_dir):
    return _business(spark, sf_dir)


@query
def clean_checkins(spark, sf_dir):
    return cleaning.clean_checkins(standins.raw_checkins(spark, sf_dir))


@query
def clean_tips(spark, sf_dir):
    return cleaning.clean_tips(standins.raw_tips(spark, sf_dir))


def _documents(spark, sf_dir):
    return standins.written_reviews(standins.documents(spark, sf_dir))


@query
def enrich_reviews(spark, sf_dir):
    return cleaning.enrich_reviews(_documents(spark, sf_dir), lexicon(spark))


def _all_texts(spark, sf_dir):
    """Every document and every turn."""
    tips = standins.raw_tips(spark, sf_dir).select(
        F.concat_ws("-", "user_id", "compliment_count").alias("review_id"), "text")
    return _documents(spark, sf_dir).select("review_id", "text").unionByName(tips)


@query
def nlp_sentiment(spark, sf_dir):
    return cleaning.with_sentiment(_all_texts(spark, sf_dir), lexicon(spark)).select("review_id", "sentiment")


@query
def nlp_sentiment_large(spark, sf_dir):
    """A lexicon too large to travel with the plan; ids are missing or repeat."""
    filler = spark.range(MAX_INLINE_WORDS + 1).select(
        F.concat(F.lit("filler"), "id").alias("word"), F.lit(1.0).alias("valence"))
    number = F.try_to_number(F.substring("review_id", 2, 18), F.lit("999999999999999999"))
    texts = _all_texts(spark, sf_dir).withColumn(
        "review_id", F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, "same").otherwise(F.col("review_id")))
    labelled = cleaning.with_sentiment(texts, lexicon(spark).unionByName(filler))
    return labelled.select("review_id", "sentiment")


@query
def nlp_top_words(spark, sf_dir):
    from clientele.functions.text import top_words

    return standins.documents(spark, sf_dir).select(
        "doc_id", top_words(F.col("text")).alias("frequent_words")
    )


# Features and profile --------------------------------------------------------

@query
def feat_user_agg(spark, sf_dir):
    return features.user_activity(_typed_reviews(spark, sf_dir))


@query
def feat_distinct_sketch(spark, sf_dir):
    """Different businesses of every user, exact and from sketches per year and of two halves."""
    reviews = _typed_reviews(spark, sf_dir).select("review_id", "user_id", "business_id", F.year("date").alias("year"))
    exact = reviews.groupBy("user_id").agg(F.count_distinct("business_id").alias("businesses"))
    half = F.crc32("review_id") % 2
    yearly = sketches.distinct_sketches(reviews, ["user_id", "year"], "business_id")
    halves = [sketches.distinct_sketches(reviews.where(half == k), ["user_id"], "business_id") for k in (0, 1)]
    whole, merged = (
        sketches.merged_sketches(parts, ["user_id"]).select("user_id", sketches.distinct_estimate().alias(name))
        for name, parts in (("whole", yearly), ("merged", halves[0].unionByName(halves[1]))))
    off = F.abs(F.col("whole") - F.col("businesses"))
    return exact.join(whole, "user_id").join(merged, "user_id").select(
        "user_id", "businesses", (off <= 3 * sketches.DISTINCT_ERROR * F.col("businesses") + 0.5).alias("close"),
        (F.col("whole") == F.col("merged")).alias("merges"))


@query
def feat_user_agg_view(spark, sf_dir):
    """The activity measures over a registered view."""
    _typed_reviews(spark, sf_dir).createOrReplaceTempView("review")
    return features.user_activity(spark.table("review"))


@query
def feat_category_counts(spark, sf_dir):
    return features.category_counts(_typed_reviews(spark, sf_dir), _business(spark, sf_dir))


@query
def feat_category_avg(spark, sf_dir):
    return features.category_ratings(_typed_reviews(spark, sf_dir), _business(spark, sf_dir))


@query
def feat_area(spark, sf_dir):
    return features.user_area(_typed_reviews(spark, sf_dir), _business(spark, sf_dir))


@query
def feat_friends_count(spark, sf_dir):
    return features.friends_counts(cleaning.friends_of(standins.raw_users(spark, sf_dir)))


@query
def feat_sentiment_map(spark, sf_dir):
    return features.sentiment_counts(review_table(spark, sf_dir))


@query
def feat_frequent_words(spark, sf_dir):
    return features.frequent_words(review_table(spark, sf_dir))


@query
def feat_user_words(spark, sf_dir):
    return features.user_words(review_table(spark, sf_dir))


@query
def profile_merge(spark, sf_dir):
    return _profile(spark, sf_dir)


@query
def profile_merge_left(spark, sf_dir):
    return _profile(spark, sf_dir, "left")


@query
def profile_incremental(spark, sf_dir):
    """Built from two thirds of the reviews, compacted, then refreshed with the last third alone."""
    out = _scratch(spark, sf_dir, "facts")
    store = FactStore(spark, f"{out}/store")
    users, business = cleaning.clean_users(standins.raw_users(spark, sf_dir)), _business(spark, sf_dir)
    third = F.pmod(F.crc32("review_id"), F.lit(3))

    def batch(number):
        return review_table(spark, sf_dir).where(third == number)

    for number in (0, 1):
        store.add(batch(number), "files", number)
    store.compact()
    files.save_parquet(stored_profile(store, users, business), f"{out}/profile")
    part = store.add(batch(2), "files", 2)
    return refresh_profile(spark.read.parquet(f"{out}/profile"), store, part, users, business)


@query
def profile_streamed(spark, sf_dir):
    """Some reviews come in files and the others as messages, some of these twice; nothing is read again."""
    out = _scratch(spark, sf_dir, "fact-stream")
    store = FactStore(spark, f"{out}/store")
    enrich = cleaning.review_enricher(lexicon(spark))
    raw = standins.raw_reviews(spark, sf_dir)
    third = F.pmod(F.crc32("review_id"), F.lit(3))
    prepare_state(spark)
    store.add(enrich(raw.where(third == 0)), "files", 0)
    again = F.pmod(F.crc32(F.reverse("review_id")), F.lit(4)) == 0
    sent = (raw.where(third == 1), raw.where((third == 2) | ((third == 1) & again)))
    for rows in sent:
        _send(rows, f"{out}/messages")
        # Paced by bytes: every micro-batch has costs of its own, and a table many small files.
        replay = topics.read_replay(spark, f"{out}/messages", bytes_per_trigger=BATCH_BYTES)
        decoded = topics.decode(replay, schemas.REVIEW)
        # Orders of many years come in any order here.
        _finish(start_fact_sink(
            ingest.once_by_id(decoded, "5000 days"), store, "messages", f"{out}/checkpoint", enrich, NOW))
    users, business = cleaning.clean_users(standins.raw_users(spark, sf_dir)), _business(spark, sf_dir)
    return stored_profile(store, users, business)


def _raw_files(spark, sf_dir, folder: str, **parts: DataFrame) -> RawPaths:
    """The raw records as JSON files; ``parts`` replaces some of them."""
    raw = {
        "users": standins.raw_users, "business": standins.raw_business, "reviews": standins.raw_reviews,
        "tips": standins.raw_tips, "checkins": standins.raw_checkins,
    }
    for name, read in raw.items():
        rows = parts[name] if name in parts else read(spark, sf_dir)
        files.write_json(rows, f"{folder}/{name}")
    return RawPaths(**{name: f"{folder}/{name}" for name in raw})


@query
def run_counts(spark, sf_dir):
    """Rows of the tables that a run makes."""
    users = cleaning.typed_users(standins.raw_users(spark, sf_dir))
    return table_counts({
        "review": review_table(spark, sf_dir), "user": users, "friends": users.select("user_id", "friends"),
        "business": _business(spark, sf_dir), "checkin": cleaning.clean_checkins(standins.raw_checkins(spark, sf_dir)),
        "tip": cleaning.clean_tips(standins.raw_tips(spark, sf_dir)), "combined": profile_table(spark, sf_dir),
    })


@query
def feat_area_by_state(spark, sf_dir):
    """Home cities told from cities of the same name in other states."""
    return features.user_area(_typed_reviews(spark, sf_dir), features.cities_by_state(_business(spark, sf_dir)))


@query
def pipeline_run(spark, sf_dir):
    """The batch run from JSON files to the profile."""
    out = _scratch(spark, sf_dir, "batch-run")
    return run_batch(spark, _raw_files(spark, sf_dir, f"{out}/raw"), f"{out}/tables", lexicon(spark))


@query
def pipeline_stream_profile(spark, sf_dir):
    """Part of the records arrives in files and part as messages; some reviews come both ways."""
    out = _scratch(spark, sf_dir, "stream-run")

    def third(rows):
        return F.pmod(F.crc32(F.to_json(F.struct(*rows.columns))), F.lit(3))

    filed, sent = {}, {}
    for name, read in (("reviews", standins.raw_reviews), ("tips", standins.raw_tips), ("checkins", standins.raw_checkins)):
        rows = read(spark, sf_dir)
        filed[name] = rows.where(third(rows) != 0)
        sent[name] = rows.where(third(rows) != 1 if name == "reviews" else third(rows) == 0)
    tables = {"reviews": ("lineitem", "documents"), "tips": ("conversations",), "checkins": ("events",)}
    messages = {}
    for name, rows in sent.items():
        path, given = f"{out}/messages/{name}", sum(
            files.folder_bytes(spark, f"{sf_dir}/{t}.parquet") for t in tables[name])
        parts = max(4, -(-given // FILE_BYTES))
        topics.write_replay(rows, path, files=parts)
        messages[name] = topics.read_replay(spark, path, _pace(parts, files.folder_bytes(spark, path)))
    for started in ingest.run_ingest(messages, f"{out}/streamed", lexicon(spark), trigger=NOW):
        _finish(started)
    paths = _raw_files(spark, sf_dir, f"{out}/raw", **filed)
    return run_batch(spark, paths, f"{out}/tables", lexicon(spark), streamed=f"{out}/streamed")


# Segments --------------------------------------------------------------------

def _segment(spark, sf_dir) -> Segment:
    return Segment(profile_table(spark, sf_dir), FILTERS)


@query
def seg_filter_chain(spark, sf_dir):
    return _segment(spark, sf_dir).rows


@query
def seg_filter_eq(spark, sf_dir):
    chosen = FilterSpec("user_city", "eq", "NATION_7", "City")
    return Segment(profile_table(spark, sf_dir), (chosen,)).rows


@query
def seg_filter_in(spark, sf_dir):
    chosen = FilterSpec("elite", "in", ("1996", "2001"), "Elite")
    return Segment(profile_table(spark, sf_dir), (chosen,)).rows.select("user_id", "elite")


@query
def seg_filter_contains(spark, sf_dir):
    chosen = FilterSpec("elite", "contains", "1997,1999", "Elite")
    return Segment(profile_table(spark, sf_dir), (chosen,)).rows.select("user_id", "elite")


@query
def seg_filter_bounds(spark, sf_dir):
    return seg.filter_bounds(profile_table(spark, sf_dir), [f.column for f in seg.DEFAULT_FILTERS])


@query
def seg_filter_bounds_footers(spark, sf_dir):
    """The same from the footers of the profile's files."""
    profile_table(spark, sf_dir)
    columns = [f.column for f in seg.DEFAULT_FILTERS]
    return seg.bounds_of(layout.largest_values(spark, f"{_folder(spark, sf_dir)}/combined", columns), columns)


@query
def seg_filter_clustered(spark, sf_dir):
    """The filter chain over a profile whose files are clustered by the columns of the filters."""
    path = _scratch(spark, sf_dir, "clustered")
    columns = [f.column for f in seg.DEFAULT_FILTERS]
    profile = profile_table(spark, sf_dir)
    layout.save_clustered(profile, path, columns, files=max(8, -(-profile.count() // FILE_USERS)))
    return Segment(spark.read.parquet(path), FILTERS).rows


@query
def seg_cube(spark, sf_dir):
    """Users by city, status and year of joining, with all totals."""
    dimensions = {
        "city": F.col("user_city"), "status": reports.status_column(AS_OF, 10), "joined": F.year("yelping_since")}
    return seg.slice_and_dice(profile_table(spark, sf_dir), dimensions, ("review_count", "fans", "useful"))


@query
def seg_grouping_sets(spark, sf_dir):
    """The same by city and status, and by year, and over all."""
    dimensions = {
        "city": F.col("user_city"), "status": reports.status_column(AS_OF, 10), "joined": F.year("yelping_since")}
    sets = (("city", "status"), ("joined",), ())
    return seg.slice_and_dice(profile_table(spark, sf_dir), dimensions, ("review_count",), sets)


@query
def seg_funnel(spark, sf_dir):
    return _segment(spark, sf_dir).funnel()


@query
def seg_popular_categories(spark, sf_dir):
    return seg.popular_categories(_segment(spark, sf_dir).rows)


@query
def seg_popular_words(spark, sf_dir):
    return seg.popular_words(_segment(spark, sf_dir).rows)


@query
def seg_elite_years(spark, sf_dir):
    return seg.elite_per_year(_segment(spark, sf_dir).rows)


@query
def seg_emotions(spark, sf_dir):
    return seg.emotions(_segment(spark, sf_dir).rows)


@query
def seg_geo_points(spark, sf_dir):
    return seg.geo_points(_segment(spark, sf_dir).rows)


@query
def seg_preview(spark, sf_dir):
    return seg.preview(_segment(spark, sf_dir).rows, seed=7)


@query
def seg_export(spark, sf_dir):
    """The whole segment as CSV, read back with all its columns."""
    path = _scratch(spark, sf_dir, "customers.csv")
    rows = _segment(spark, sf_dir).rows
    files.export_csv(rows, path)
    flat = ", ".join(
        f"`{c}` {'string' if c in schemas.PROFILE_JSON else kind}" for c, kind in rows.dtypes)
    back = spark.read.option("header", True).option("escape", '"').schema(flat).csv(path)
    return files.parsed_columns(back, schemas.PROFILE_JSON)


# Reports ---------------------------------------------------------------------

@query
def bi_user_status(spark, sf_dir):
    return reports.user_status(profile_table(spark, sf_dir), AS_OF, recent_days=30)


@query
def bi_user_status_short(spark, sf_dir):
    return reports.user_status(profile_table(spark, sf_dir), AS_OF, recent_days=10)


@query
def bi_sentiment_pivot(spark, sf_dir):
    return reports.sentiment_pivot(profile_table(spark, sf_dir))


@query
def bi_sentiment_ratio(spark, sf_dir):
    return reports.sentiment_ratios(profile_table(spark, sf_dir))


@query
def bi_sentiment_pct(spark, sf_dir):
    return reports.sentiment_shares(profile_table(spark, sf_dir))


@query
def bi_sentiment_by_year(spark, sf_dir):
    return reports.sentiment_by_year(profile_table(spark, sf_dir))


@query
def bi_sentiment_corr(spark, sf_dir):
    pairs = reports.sentiment_correlation(profile_table(spark, sf_dir))
    return pairs.select([F.round(c, 6).alias(c) for c in pairs.columns])


@query
def bi_category_long(spark, sf_dir):
    return reports.category_long(profile_table(spark, sf_dir))


def _variants(spark, sf_dir) -> DataFrame:
    name = f"variants_{uuid.uuid4().hex[:8]}"
    variants.publish_variants(profile_table(spark, sf_dir), name, path=_scratch(spark, sf_dir, "variants"))
    return variants.load_variants(spark, name)


@query
def bi_variant_pivot(spark, sf_dir):
    """Sentiment counts by path from a profile published with variants."""
    return variants.sentiment_pivot(_variants(spark, sf_dir))


@query
def bi_variant_long(spark, sf_dir):
    """Categories flattened from a profile published with variants."""
    return variants.category_long(_variants(spark, sf_dir))


@query
def bi_category_reviews(spark, sf_dir):
    return reports.category_reviews(profile_table(spark, sf_dir))


@query
def bi_top_categories(spark, sf_dir):
    return reports.top_categories(profile_table(spark, sf_dir))


@query
def bi_category_dist(spark, sf_dir):
    return reports.top_categories(profile_table(spark, sf_dir), 30)


@query
def bi_elite_years(spark, sf_dir):
    return reports.elite_years(profile_table(spark, sf_dir))


@query
def bi_elite_years_wide(spark, sf_dir):
    return reports.elite_years(profile_table(spark, sf_dir), schemas.REPORT_COLUMNS)


@query
def bi_elite_years_text(spark, sf_dir):
    return reports.elite_years(profile_table(spark, sf_dir), as_text=True)


@query
def bi_reviews_by_year(spark, sf_dir):
    return reports.reviews_by_year(profile_table(spark, sf_dir))


@query
def bi_reviews_by_review_year(spark, sf_dir):
    return reports.reviews_by_review_year(_typed_reviews(spark, sf_dir))


@query
def bi_activity_heatmap(spark, sf_dir):
    return reports.activity_heatmap(profile_table(spark, sf_dir))


@query
def bi_business_bins(spark, sf_dir):
    return reports.business_bins(profile_table(spark, sf_dir))


@query
def bi_key_skew(spark, sf_dir):
    return reports.key_skew(standins.raw_reviews(spark, sf_dir), "business_id")


@query
def bi_skew_sketch(spark, sf_dir):
    """The ten businesses with most reviews, and whether quantiles of text lengths are within their error."""
    reviews = standins.raw_reviews(spark, sf_dir).select("business_id", F.octet_length("text").cast("long").alias("bytes"))
    heavy = sketches.heavy_keys(reviews, "business_id", 10).select(
        F.lit("business").alias("kind"), F.col("business_id").alias("name"), F.col("rows").alias("amount"))
    found = sketches.quantiles(reviews, "bytes", (0.1, 0.5, 0.9, 0.99))
    error = 2 * sketches.RANK_ERROR
    within = (F.col("below") - error <= F.col("probability")) & (F.col("probability") <= F.col("up_to") + error)
    return heavy.unionByName(sketches.rank_span(reviews, "bytes", found).select(
        F.lit("quantile").alias("kind"), F.col("probability").cast("string").alias("name"),
        within.cast("bigint").alias("amount")))


@query
def bi_model_join(spark, sf_dir):
    profile = profile_table(spark, sf_dir)
    status = reports.user_status(profile, AS_OF, recent_days=10)
    return reports.joined_model(review_table(spark, sf_dir), profile, status)


@query
def bi_model_join_bucketed(spark, sf_dir):
    """The model over tables that are bucketed by user alike, without moving a row."""
    out, name = _scratch(spark, sf_dir, "bucketed"), uuid.uuid4().hex[:8]
    profile = profile_table(spark, sf_dir)
    tables = {
        "review": review_table(spark, sf_dir).select("user_id", "sentiment"),
        "profile": profile,
        "status": reports.user_status(profile, AS_OF, recent_days=10),
    }
    for table, rows in tables.items():
        layout.save_bucketed(rows, f"{table}_{name}", "user_id", 8, path=f"{out}/{table}")
    return reports.joined_model(*[spark.table(f"{table}_{name}") for table in tables])


@query
def profile_bucketed(spark, sf_dir):
    """The profile with users from a bucketed table, which the features meet where they lie."""
    name = f"users_{uuid.uuid4().hex[:8]}"
    users = cleaning.clean_users(standins.raw_users(spark, sf_dir))
    reviews = review_table(spark, sf_dir)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-reviews.count() // features.DEALT_ROWS))
    layout.save_bucketed(users, name, "user_id", buckets, path=_scratch(spark, sf_dir, "users"))
    return build_profile(spark.table(name), reviews, _business(spark, sf_dir), partitions=buckets)


# Streams, run to completion --------------------------------------------------

def _finish(started) -> None:
    started.awaitTermination()


def _pace(parts: int, size: int) -> int:
    """How many of ``parts`` even files a micro-batch takes: half of them, ``BATCH_BYTES`` at most."""
    return max(1, min(-(-parts // 2), BATCH_BYTES * parts // max(1, size)))


def _send(rows: DataFrame, path: str) -> None:
    """Adds messages to a topic's replay folder."""
    messages = topics.as_messages(rows).select(F.col("value").cast("string"))
    messages.write.mode("append").options(**files.GZIP).text(path)


def _sent_events(spark, sf_dir) -> list[DataFrame]:
    """Event reviews as three times they are sent: ten days each, some of them again
    with the next, some twice, and some of the first and the second only with the third."""
    rows = standins.event_reviews(standins.table(spark, sf_dir, "events"))
    number = F.substring("review_id", 2, 20).cast("bigint")
    time = F.least(F.lit(3), F.ceil(F.day(F.col("date").cast("timestamp")) / 10))
    withheld = ((number % 11 == 3) & (time == 1)) | ((number % 11 == 7) & (time == 2))
    out = []
    for k in (1, 2, 3):
        own = rows.where((time == k) & ~withheld)
        sent = own.unionByName(own.where(number % 7 == 0)).unionByName(
            rows.where((time == k - 1) & ~withheld & (number % 5 == 0)))
        out.append(sent if k < 3 else sent.unionByName(rows.where(withheld)))
    return out


@query
def stream_dedup(spark, sf_dir):
    """Each review once, over three starts of the same query; what comes over four days late is left out."""
    out = _scratch(spark, sf_dir, "stream-dedup")
    for rows in _sent_events(spark, sf_dir):
        _send(rows, f"{out}/messages")
        decoded = topics.decode(topics.read_replay(spark, f"{out}/messages", files_per_trigger=1000), schemas.REVIEW)
        _finish(ingest.start_file_sink(ingest.once_by_id(decoded, "4 days"), out, "reviews", NOW))
    return ingest.read_sink(spark, out, "reviews")


@query
def stream_daily(spark, sf_dir):
    """Messages by day, for the days that the watermark has passed; late ones count while their day is open."""
    out = _scratch(spark, sf_dir, "stream-daily")
    for rows in _sent_events(spark, sf_dir):
        _send(rows, f"{out}/messages")
        decoded = topics.decode(topics.read_replay(spark, f"{out}/messages", files_per_trigger=1000), schemas.REVIEW)
        _finish(ingest.start_file_sink(ingest.daily_counts(decoded, "4 days"), out, "daily", NOW))
    return ingest.read_sink(spark, out, "daily").withColumn("stars_sum", F.round("stars_sum", 2))


@query
def stream_decode(spark, sf_dir):
    out = _scratch(spark, sf_dir, "stream-decode")
    messages = standins.event_messages(standins.table_stream(spark, sf_dir, "events"))
    _finish(ingest.start_file_sink(topics.decode(messages, schemas.REVIEW), out, "reviews", NOW))
    return ingest.read_sink(spark, out, "reviews")


@query
def stream_file_sink(spark, sf_dir):
    out = _scratch(spark, sf_dir, "stream-files")
    messages = standins.checkin_messages(standins.table_stream(spark, sf_dir, "events"))
    rows = cleaning.clean_checkins(topics.decode(messages, schemas.CHECKIN))
    _finish(ingest.start_file_sink(rows, out, "checkins", NOW))
    return ingest.read_sink(spark, out, "checkins")


@query
def stream_tips(spark, sf_dir):
    out = _scratch(spark, sf_dir, "stream-tips")
    tips = standins.tips_of(standins.table_stream(spark, sf_dir, "conversations"))
    rows = cleaning.clean_tips(topics.decode(topics.as_messages(tips), schemas.TIP))
    _finish(ingest.start_file_sink(rows, out, "tips", NOW))
    return ingest.read_sink(spark, out, "tips")


@query
def stream_enrich(spark, sf_dir):
    out = _scratch(spark, sf_dir, "stream-enrich")
    ids = sampling.sample_users(_documents(spark, sf_dir), 0.5)
    reviews = standins.written_reviews(standins.table_stream(spark, sf_dir, "documents"))
    decoded = topics.decode(topics.as_messages(reviews), schemas.REVIEW)
    _finish(ingest.start_review_sink(decoded, out, lexicon(spark), ids, NOW, tasks=16))
    return ingest.read_sink(spark, out, "reviews")


@query
def stream_replay(spark, sf_dir):
    out = _scratch(spark, sf_dir, "stream-replay")
    rows = standins.event_reviews(standins.table(spark, sf_dir, "events"))
    topics.write_replay(rows, f"{out}/replay", files=4)
    replayed = topics.decode(topics.read_replay(spark, f"{out}/replay"), schemas.REVIEW)
    _finish(ingest.start_file_sink(replayed, out, "reviews", NOW))
    return ingest.read_sink(spark, out, "reviews")
