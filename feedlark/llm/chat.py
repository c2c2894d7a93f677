"""Conversations as training text whose turns can be read back exactly, with a loss mask.

A turn is an opening marker, the text, and the closing marker of its kind; turns follow one another
without anything between. A deterministic parser reads the text again. Where the turns that it
recovers differ from the source, the control strings inside the texts are escaped by one more
backslash after their first character, and the result is parsed again. The parser always takes one
such backslash away, so a text that holds an escaped control string is itself a conflict.

Defined results: null texts and roles are empty strings; turns of equal number are ordered by role and
text; repeated rows are turns of their own; rows without an id form one conversation; an empty table
gives no conversations. The texts of a conversation meet in one row, which is the training sample.
Everything is an expression of Spark; no text is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers of the template (fixed values): role -> opening and closing.
MARKERS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")}
OTHER_OPEN, OTHER_CLOSE = "[TURN:", "[/TURN]"  # any other role stands in the opening, as hexadecimal bytes
TRAINED = "assistant"

_REST = r"(/?(?:SYS|INST|TURN)\]|OUT\]|TURN:[0-9A-F]*\]|/s>)"
CONTROL = r"([\[<])(\\*)" + _REST  # a control string, escaped any number of times
ESCAPED = r"([\[<])\\(\\*)" + _REST
# \G: a turn begins where the last one ended, so that a text is read once, whatever it holds
TURN = (
    r"(?s)\G(?:\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|\[OUT\].*?</s>|\[TURN:[0-9A-F]*\].*?\[/TURN\])"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _opening(role: Column) -> Column:
    known = F.lit(None).cast("string")
    for name, (opening, _) in MARKERS.items():
        known = F.when(role == name, opening).otherwise(known)
    return F.coalesce(known, F.concat(F.lit(OTHER_OPEN), F.hex(role), F.lit("]")))


def _closing(role: Column) -> Column:
    known = F.lit(OTHER_CLOSE)
    for name, (_, closing) in MARKERS.items():
        known = F.when(role == name, closing).otherwise(known)
    return known


def render(turns: Column, escaped: bool) -> Column:
    """One string from an array of (role, text)."""

    def one(t: Column) -> Column:
        text = escape(t["text"]) if escaped else t["text"]
        return F.concat(_opening(t["role"]), text, _closing(t["role"]))

    return F.array_join(F.transform(turns, one), "")


def cut(formatted: Column) -> Column:
    """The turns as strings, with markers; null unless they make up the whole text."""
    found = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    return F.when(F.array_join(found, "") == formatted, found)


def _body(turn: Column, opening: Column, closing: Column) -> Column:
    return F.substring(turn, opening + 1, F.length(turn) - opening - closing)


def parts(turn: Column) -> Column:
    """(role, opening, closing) of a turn: its role and the lengths of its markers."""
    other = F.regexp_extract(turn, r"^\[TURN:([0-9A-F]*)\]", 1)
    found = F.struct(
        F.unhex(other).cast("string").alias("role"),
        (F.length(other) + len(OTHER_OPEN) + 1).alias("opening"),
        F.lit(len(OTHER_CLOSE)).alias("closing"),
    )
    for name, (opening, closing) in MARKERS.items():
        known = F.struct(
            F.lit(name).alias("role"), F.lit(len(opening)).alias("opening"), F.lit(len(closing)).alias("closing")
        )
        found = F.when(F.startswith(turn, F.lit(opening)), known).otherwise(found)
    return found


def parse(cuts: Column) -> Column:
    """Array of (role, text) from the turns of `cut`."""

    def one(turn: Column) -> Column:
        p = parts(turn)
        text = unescape(_body(turn, p["opening"], p["closing"]))
        return F.struct(p["role"].alias("role"), text.alias("text"))

    return F.transform(cuts, one)


def loss_spans(cuts: Column) -> Column:
    """Array of (start, end): the code points of the formatted text that are trained on, markers left out."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(seen: Column, turn: Column) -> Column:
        p = parts(turn)
        start = (seen["at"] + p["opening"]).cast("bigint")
        end = (seen["at"] + F.length(turn) - p["closing"]).cast("bigint")
        grown = F.concat(seen["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(
            (seen["at"] + F.length(turn)).cast("bigint").alias("at"),
            F.when(p["role"] == TRAINED, grown).otherwise(seen["spans"]).alias("spans"),
        )

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))
    return F.aggregate(cuts, begin, step)["spans"]


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text that the spans cover, unescaped span by span."""
    covered = F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return F.array_join(covered, "")


def format_conversations(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conversation, formatted, loss_spans, escaped): one row per conversation.

    `escaped` tells whether the plain rendering was read back wrongly. A rendering that cannot be
    read back even when escaped would be a fault of the grammar, and fails the job.
    """
    entry = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    whole = rows.groupBy(F.col(conversation).alias("_id")).agg(F.sort_array(F.collect_list(entry)).alias("_turns"))
    whole = whole.withColumn("_turns", F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    plain = whole.withColumn("_plain", render(F.col("_turns"), escaped=False))
    same = F.coalesce(parse(cut(F.col("_plain"))) == F.col("_turns"), F.lit(False))
    tried = plain.withColumn("_same", same)
    final = tried.select(
        "_id", "_turns", F.when(F.col("_same"), F.col("_plain")).otherwise(render(F.col("_turns"), escaped=True)).alias("formatted"), (~F.col("_same")).alias("escaped")
    )
    final = final.withColumn("_cuts", cut(F.col("formatted")))
    again = F.col("_same_again")
    final = final.withColumn("_same_again", ~F.col("escaped") | F.coalesce(parse(F.col("_cuts")) == F.col("_turns"), F.lit(False)))
    return final.select(
        F.col("_id").alias(conversation),
        F.when(again, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation cannot be read back"))).alias("formatted"),
        loss_spans(F.col("_cuts")).alias("loss_spans"),
        "escaped",
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) from a formatted text."""
    return parse(cut(formatted))
