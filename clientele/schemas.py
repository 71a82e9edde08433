"""Declared schemas of the raw inputs and of the warehouse profile.

Declaring them keeps every JSON read a single pass; inference would read all
of the input once more.
"""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

_TEXT_MAP = MapType(StringType(), StringType())


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


COMPLIMENTS = [
    "compliment_cool", "compliment_cute", "compliment_funny", "compliment_hot",
    "compliment_list", "compliment_more", "compliment_note", "compliment_photos",
    "compliment_plain", "compliment_profile", "compliment_writer",
]

BUSINESS = _struct(
    address=StringType(), attributes=_TEXT_MAP, business_id=StringType(),
    categories=StringType(), city=StringType(), hours=_TEXT_MAP, is_open=LongType(),
    latitude=DoubleType(), longitude=DoubleType(), name=StringType(),
    postal_code=StringType(), review_count=LongType(), stars=DoubleType(),
    state=StringType(),
)

REVIEW = _struct(
    business_id=StringType(), cool=LongType(), date=StringType(), funny=LongType(),
    review_id=StringType(), stars=DoubleType(), text=StringType(), useful=LongType(),
    user_id=StringType(),
)

TIP = _struct(
    business_id=StringType(), compliment_count=LongType(), date=StringType(),
    text=StringType(), user_id=StringType(),
)

CHECKIN = _struct(business_id=StringType(), date=StringType())

USER = _struct(
    user_id=StringType(), name=StringType(), review_count=LongType(),
    yelping_since=StringType(), useful=LongType(), funny=LongType(), cool=LongType(),
    elite=StringType(), friends=StringType(), fans=LongType(), average_stars=DoubleType(),
    **{c: LongType() for c in COMPLIMENTS},
)

# Columns that the wide reports carry next to the derived ones.
REPORT_COLUMNS = [
    "user_id", "average_stars", *COMPLIMENTS, "cool", "elite", "fans", "funny",
    "name", "review_count", "useful", "yelping_since", "first_seen", "last_seen",
    "date_diff", "different_business_count", "avg_rating", "min_stars", "max_stars",
    "category_map", "friends_count",
]

# The profile: one row per user.
PROFILE_COLUMNS = [
    *REPORT_COLUMNS, "sentiment_map", "frequent_words_map", "user_city", "travel_map",
    "latitude", "longitude", "category_avg_stars",
]

# Types of the profile columns that warehouses hold as JSON text.
PROFILE_JSON = {
    "elite": "array<string>",
    "category_map": "map<string,bigint>",
    "sentiment_map": "map<string,bigint>",
    "frequent_words_map": "map<string,bigint>",
    "travel_map": "map<string,bigint>",
    "category_avg_stars": "map<string,double>",
}
