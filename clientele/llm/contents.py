"""Documents by content: short ones, later copies, and one bearer per long text.

Work on repeated passages looks at every different text once.  Equal texts are
told by their MD5; the document with the smallest id bears the text, and a
copy's result follows from its being a copy.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a null id: later than any other.
LAST_ID = 2**63 - 1


class Contents(NamedTuple):
    """All have ``row``, a struct of the carried columns.  ``short`` and
    ``bearers`` have doc and text; ``bearers`` also part, which tells different
    texts under one id apart.  ``copies`` has first, the bearer, and the measures asked for."""

    short: DataFrame
    copies: DataFrame
    bearers: DataFrame


def by_content(docs: DataFrame, carry: list[str], is_long: Column, **measures: Column) -> Contents:
    """Divides ``docs``; ``is_long`` and ``measures`` are expressions over ``text``."""
    base = docs.select(
        F.struct(*carry).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    named = base.where(is_long).withColumn("name", F.md5("text"))
    firsts = named.groupBy("name").agg(F.min("doc").alias("first"))
    copies = (
        named.select("row", "doc", "name", *[c.alias(n) for n, c in measures.items()])
        .join(firsts, "name").where("doc > first").select("row", "first", *measures)
    )
    borne = firsts.groupBy(F.col("first").alias("doc")).agg(F.sort_array(F.collect_set("name")).alias("names"))
    # Joined by id alone, so that the texts stay dealt out by it for what follows.
    bearers = (
        named.join(borne, "doc")
        .withColumn("part", F.array_position("names", F.col("name")).cast("int"))
        .where("part > 0").select("row", "doc", "part", "text")
    )
    return Contents(base.where(~is_long).select("row", "doc", "text"), copies, bearers)
