"""Chat formatting with a verified round trip.

Template, turn after turn::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Rendered text is read back by a deterministic parser, and the recovered turn is
compared with its source.  A turn is first tried as it is; content that does not
come back identical is escaped and tried again.  Escaping puts one backslash
behind the ``<`` of every control string and of every string that already looks
like an escaped one, so it can be undone, and an escaped text cannot hold a
control string.  In roles a line feed is written as ``<|im_nl|>``.

Defined results: null roles and texts are empty; turns are ordered by turn
number (nulls first), then role, then rendered text, and repeated rows are
repeated turns; a null ``conv_id`` is a conversation of its own; an empty table
gives no rows; other columns are ignored.  A conversation is one value of one
row, so its length is bounded by the size of a Spark string (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.words import let

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|im_nl|>"
TAIL = END + "\n"
TRAINED_ROLE = "assistant"

_TEXT_CONTROL = r"(start|end)"
_ROLE_CONTROL = r"(start|end|nl)"


def _escape(value: Column, names: str) -> Column:
    return F.regexp_replace(value, rf"<(\\*)\|im_{names}\|>", r"<\\$1|im_$2|>")


def _unescape(value: Column, names: str) -> Column:
    return F.regexp_replace(value, rf"<\\(\\*)\|im_{names}\|>", r"<$1|im_$2|>")


def escape_text(text: Column) -> Column:
    return _escape(text, _TEXT_CONTROL)


def unescape_text(text: Column) -> Column:
    return _unescape(text, _TEXT_CONTROL)


def escape_role(role: Column) -> Column:
    return F.replace(_escape(role, _ROLE_CONTROL), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return _unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")), _ROLE_CONTROL)


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(TAIL))


def parse(formatted: Column) -> Column:
    """Turns of a formatted text: array of (raw_role, raw_text, role, text).

    Null where the text is not of the grammar: no closed turns, a turn without
    its head, or a control string inside a turn.
    """

    def turn(piece: Column) -> Column:
        head = F.length(F.lit(START))
        inner = F.substring(piece, head + 1, F.length(piece))
        split = F.locate("\n", inner)
        fits = piece.startswith(START) & (split > 0) & ~inner.contains(START) & ~inner.contains(END)
        raw_role = F.substring(inner, F.lit(1), split - 1)
        raw_text = F.substring(inner, split + 1, F.length(inner))
        return F.when(fits, F.struct(
            raw_role.alias("raw_role"),
            raw_text.alias("raw_text"),
            unescape_role(raw_role).alias("role"),
            unescape_text(raw_text).alias("text"),
        ))

    def turns(pieces: Column) -> Column:
        closed = F.slice(pieces, 1, F.size(pieces) - 1)
        open_end = F.element_at(pieces, -1)
        return let(
            F.transform(closed, turn),
            lambda found: F.when((open_end == "") & ~F.exists(found, lambda t: t.isNull()), found),
        )

    return let(F.split(formatted, r"<\|im_end\|>\n", -1), turns)


def _comes_back(rendered: Column, role: Column, text: Column) -> Column:
    return let(parse(rendered), lambda t: F.coalesce(
        (F.size(t) == 1) & (F.get(t, F.lit(0))["role"] == role) & (F.get(t, F.lit(0))["text"] == text),
        F.lit(False),
    ))


def render_verified(role: Column, text: Column) -> Column:
    """The first rendering that parses back to exactly this role and text."""
    attempts = [render(role, text), render(escape_role(role), escape_text(text))]
    return F.coalesce(*[
        let(a, lambda r: F.when(_comes_back(r, role, text), r)) for a in attempts
    ])


def format_conversations(turns: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) to one row per conversation.

    Returns conv_id, formatted, turns (array of role and text, read back from
    ``formatted``), loss_mask (runs of code points: length, loss) and identical
    (the turns read back equal the source, compared by hash).
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rendered = rows.select(
        "conv_id", "turn", "role",
        render_verified(F.col("role"), F.col("text")).alias("rendered"),
        F.xxhash64("role", "text").alias("source_hash"),
    )
    # Rows of a conversation are gathered per map task first.
    gathered = rendered.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "rendered", "source_hash"))).alias("rows")
    )
    joined = gathered.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["rendered"]), "").alias("formatted"),
        F.transform("rows", lambda r: r["source_hash"]).alias("source_hashes"),
    )
    parsed = joined.withColumn("parsed", parse(F.col("formatted")))

    def runs(t: Column) -> Column:
        def run(length, loss):
            return F.struct(length.cast("long").alias("length"), loss.alias("loss"))

        head = F.length(F.lit(START)) + F.length(t["raw_role"]) + 1
        return F.array(
            run(head, F.lit(False)),
            run(F.length(t["raw_text"]), t["role"] == TRAINED_ROLE),
            run(F.length(F.lit(TAIL)), F.lit(False)),
        )

    return parsed.select(
        "conv_id",
        "formatted",
        F.transform("parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        F.flatten(F.transform("parsed", runs)).alias("loss_mask"),
        F.coalesce(
            F.transform("parsed", lambda t: F.xxhash64(t["role"], t["text"])) == F.col("source_hashes"),
            F.lit(False),
        ).alias("identical"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, from what was read back."""
    def joined(parts: Column) -> Column:
        return F.array_join(parts, "")

    listing = joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    trained = joined(F.transform(
        F.filter("turns", lambda t: t["role"] == TRAINED_ROLE), lambda t: t["text"]
    ))
    return formatted.withColumn("trained", trained).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listing, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )
