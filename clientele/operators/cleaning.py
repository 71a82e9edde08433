"""Raw records to typed tables.

Everything is parsed with the forgiving variants: a value that cannot be read
becomes null, it does not stop the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.sentiment import compound, inline_lexicon, joined_lexicon, label
from clientele.functions.text import top_words

LIST = ", "
LOOSE_LIST = r",\s*"


def text_list(column: Column | str, separator: str = LIST) -> Column:
    """ "a, b, c" as an array; a bare comma belongs to its entry."""
    return F.split(column, separator)


def friend_count(friends: Column, empty: tuple[str, ...] = ()) -> Column:
    """Number of friends in a list.  A placeholder counts as one friend unless
    it is named in ``empty``."""
    size = F.coalesce(F.size(friends), F.lit(0))
    if not empty:
        return size
    placeholder = (F.size(friends) == 1) & F.get(friends, F.lit(0)).isin(list(empty))
    return F.when(placeholder, 0).otherwise(size)


def typed_users(raw: DataFrame, empty_friends: tuple[str, ...] = ()) -> DataFrame:
    """Typed users with their friends, as list and as number."""
    return raw.withColumns({
        "elite": text_list("elite", LOOSE_LIST),
        "yelping_since": F.try_to_timestamp(F.col("yelping_since")),
        "friends_count": friend_count(text_list("friends"), empty_friends),
        "friends": text_list("friends"),
    })


def clean_users(raw: DataFrame, empty_friends: tuple[str, ...] = ()) -> DataFrame:
    """Typed users.  The friends list is replaced by its length, read off the
    same row; the list itself is a table of its own (``friends_of``)."""
    return typed_users(raw, empty_friends).drop("friends")


def friends_of(raw: DataFrame) -> DataFrame:
    return raw.select("user_id", text_list("friends").alias("friends"))


def clean_business(raw: DataFrame) -> DataFrame:
    return raw.withColumn("categories", text_list("categories"))


def clean_checkins(raw: DataFrame) -> DataFrame:
    return raw.withColumn("date", F.transform(text_list("date"), lambda d: F.try_to_timestamp(d)))


def clean_tips(raw: DataFrame) -> DataFrame:
    return raw.withColumn("date", F.try_to_timestamp(F.col("date")))


def sentiment_labeller(lexicon: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds ``sentiment`` (positive, negative or neutral) for ``text``.

    A lexicon of bounded size travels with the plan and rows stay where they
    are; a larger one is joined by word and text, with the same result for every
    row.  The lexicon is read, and the expression built, once for all tables the
    result is used on.
    """
    text = F.col("text")
    inline = inline_lexicon(lexicon)
    if inline:
        sentiment = label(compound(text, inline)).alias("sentiment")
        return lambda df: df.select("*", sentiment)

    def joined(df: DataFrame) -> DataFrame:
        rows, words = joined_lexicon(df, lexicon, "text")
        return rows.select(*df.columns, label(compound(text, words)).alias("sentiment"))

    return joined


def with_sentiment(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    return sentiment_labeller(lexicon)(df)


def review_enricher(lexicon: DataFrame, k: int = 10) -> Callable[[DataFrame], DataFrame]:
    """Types raw reviews and adds sentiment and frequent words, table by table."""
    add_sentiment = sentiment_labeller(lexicon)
    typed = {
        "date": F.try_to_timestamp(F.col("date")),
        "frequent_words": top_words(F.col("text"), k),
    }
    return lambda raw: add_sentiment(raw.withColumns(typed))


def enrich_reviews(raw: DataFrame, lexicon: DataFrame, k: int = 10) -> DataFrame:
    """Typed reviews with sentiment and frequent words; batch and stream alike."""
    return review_enricher(lexicon, k)(raw)
