"""Chat formatting by grammar round trip, in DataFrame functions only.

Grammar of the output::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>\\n"

where ``role`` has no line feed and neither part contains ``<|``. Each turn is
first rendered as it is and parsed again. If the parsed turn differs from its
source (control strings in the text, an escape that is already there), it is
rendered with escapes and parsed again; a turn that still differed would stop
the job. Since a turn ends in a line feed and no control string contains one,
turns that are recovered one by one are also recovered from the whole text.

Escapes: ``<``, any number of backslashes and ``|`` get one more backslash
before the bar; a line feed in a role becomes ``<|n|>``. Both are undone by
the parser.

Defined results: a null text or role counts as empty; rows are ordered by
turn (null first), then role, then text, so repeated turns stay, in a fixed
order; rows without a conversation id form one conversation whose id is null;
an empty table gives no rows; further columns are ignored. A conversation is
one row of the result, as it is one training example; it has to fit in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START = "<|im_start|>"
END = "<|im_end|>"
FEED = "<|n|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(FEED))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(FEED), F.lit("\n")))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def _parse_turn(piece: Column) -> Column:
    """What follows a start mark -> struct(role, text); null where the grammar is broken."""
    raw_role = F.substring_index(piece, "\n", 1)
    rest = F.substr(piece, F.char_length(raw_role) + 2)
    raw_text = F.substring_index(rest, END, 1)
    sound = (rest == F.concat(raw_text, F.lit(END + "\n"))) & ~F.contains(raw_text, F.lit("<|"))
    return F.when(
        sound, F.struct(_unescape_role(raw_role).alias("role"), unescape(raw_text).alias("text"))
    )


def parse(formatted: Column) -> Column:
    """Formatted text -> array<struct<role, text>>, by the grammar above."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.filter(pieces, lambda piece, i: i > 0), _parse_turn)


def format_conversations(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> one row per conversation.

    Columns: conv_id; formatted (the text); loss_spans (array<struct<start,
    end>>, code points of the formatted text that carry loss: the texts of
    turns in ``loss_roles``, still escaped); n_turns; n_escaped (turns that
    needed escapes).
    """
    turns = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    safe_role, safe_text = F.col("safe_role"), F.col("safe_text")
    tried = (
        turns.withColumn("plain", parse(render(role, text)).eqNullSafe(source))
        .withColumn("safe_role", F.when(F.col("plain"), role).otherwise(_escape_role(role)))
        .withColumn("safe_text", F.when(F.col("plain"), text).otherwise(escape(text)))
        .withColumn("rendered", render(safe_role, safe_text))
        .withColumn(
            "rendered",
            F.when(F.col("plain") | parse(F.col("rendered")).eqNullSafe(source), F.col("rendered")).otherwise(
                F.raise_error(F.lit("a turn is not recovered from its escaped text"))
            ),
        )
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    start = F.coalesce(
        F.sum(F.char_length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    text_start = F.col("start") + F.char_length(safe_role) + len(START) + 1
    placed = (
        tried.withColumn("place", F.row_number().over(order))
        .withColumn("start", start)
        .select(
            "conv_id",
            "plain",
            F.struct(
                "place",
                "rendered",
                F.when(
                    role.isin(*loss_roles),
                    F.struct(
                        text_start.cast("long").alias("start"),
                        (text_start + F.char_length(safe_text)).cast("long").alias("end"),
                    ),
                ).alias("span"),
            ).alias("part"),
        )
    )
    parts = F.array_sort(F.collect_list("part"))
    return (
        placed.groupBy("conv_id")
        .agg(
            parts.alias("parts"),
            F.count(F.lit(1)).alias("n_turns"),
            F.count_if(~F.col("plain")).alias("n_escaped"),
        )
        .select(
            "conv_id",
            F.array_join(F.col("parts.rendered"), "").alias("formatted"),
            F.filter(F.col("parts.span"), lambda span: span.isNotNull()).alias("loss_spans"),
            "n_turns",
            "n_escaped",
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text and its loss spans say.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars.
    """
    turn_text = F.transform(
        F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    under_mask = F.transform(
        F.col("loss_spans"),
        lambda s: unescape(
            F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return (
        formatted.withColumn("turns", parse(F.col("formatted")))
        .withColumn("loss_text", F.array_join(under_mask, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turn_text, ""), 256).alias("turns_sha256"),
            F.char_length("loss_text").cast("long").alias("loss_chars"),
            F.sha2("loss_text", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )
