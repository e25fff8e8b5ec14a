"""Chat formatting with rotated perspectives for dialogues of many parties.

Every participant of a conversation is the assistant once: the whole dialogue is
rendered with that participant's turns as the assistant's, the other participants as
named users, and a mask of what the assistant says. Roles of the frame, such as
the system's, stay what they are and are no participants.

Turns of a conversation are gathered in parts of bounded length, so a conversation
of any length is rendered whole without ever being in one task. Column expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import once, sums_before
from .common import running_totals, stored

#: Roles that belong to the frame of a dialogue.
FRAME = ("system",)
#: Characters (texts and ``TURN_CHARS`` a turn) after which a part ends with the turn at hand.
PART_CHARS = 1_000_000
TURN_CHARS = 32
#: Groups of parts that the participants of a long conversation are copied to.
SALTS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: The name of a speaker whose role is absent or blank.
UNNAMED = "unknown"


def speaker(role: Column) -> Column:
    """The role as a name on one line without markers."""
    name = F.trim(F.regexp_replace(F.coalesce(role.cast("string"), F.lit("")), "[\\s<|>=]+", " "))
    return F.when(name == "", F.lit(UNNAMED)).otherwise(name)


def spoken(text: Column) -> Column:
    """The text with a backslash inside anything that would read as a marker; '' for null."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def turns_of(chats: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    key = F.col(conv_col).cast("string")
    rows = chats.select(
        F.col(conv_col).alias("_conv_id"),
        F.when(key.isNull(), "1").otherwise(F.concat(F.lit("0"), key)).alias("_conv"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit((1 << 63) - 1)).alias("_turn"),
        speaker(F.col(role_col)).alias("_speaker"),
        spoken(F.col(text_col)).alias("_text"),
    )
    return rows.withColumn("_chars", F.length("_text").cast("long") + TURN_CHARS)


def in_parts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of conversations of one part, and those of longer ones with ``_part``; only these are sorted for it."""
    long = turns.groupBy("_conv").agg(F.sum("_chars").alias("_all")).filter(F.col("_all") > PART_CHARS).select("_conv")
    long = stored(long, "long-chats")
    whole = turns.join(long, "_conv", "left_anti")
    cut = stored(turns.join(long, "_conv", "left_semi"), "long-turns")
    cut = running_totals(cut, ["_conv"], ["_turn", "_speaker", "_text"], "_chars", "_before")
    return whole, stored(cut.withColumn("_part", F.floor(F.col("_before") / PART_CHARS)).drop("_before"), "parts")


def participants(turns: DataFrame, frame: Sequence[str]) -> DataFrame:
    return turns.filter(~F.col("_speaker").isin(*frame)).select("_conv", F.col("_speaker").alias("assistant")).distinct()


def meetings(cut: DataFrame, frame: Sequence[str]) -> DataFrame:
    """Every part of a long conversation with every participant, by key alone.

    The participants go first to groups of parts and from there to the parts, so that no task has all
    parts of a conversation.
    """
    spots = cut.select("_conv", "_part", F.pmod("_part", F.lit(SALTS)).alias("_salt")).distinct()
    groups = spots.select("_conv", "_salt").distinct().join(participants(cut, frame), "_conv")
    return spots.join(groups, ["_conv", "_salt"]).drop("_salt")


def segments(turns: Column, assistant: Column, frame: Sequence[str]) -> Column:
    """The head, the content and whether it is masked in, of each turn."""

    def one(turn: Column) -> Column:
        name = turn["_speaker"]
        mine = name == assistant
        role = F.when(mine, F.lit("assistant")).when(name.isin(*frame), name).otherwise(F.concat(F.lit("user name="), name))
        head = F.concat(F.lit(OPEN), role, F.lit("\n"))
        return F.struct(head.alias("head"), F.concat(turn["_text"], F.lit(CLOSE)).alias("body"), mine.alias("mine"))

    return F.transform(turns, one)


def masks(pieces: Column) -> Column:
    """Start and end (code points, end exclusive) of what the assistant says, with its closing marker."""
    sizes = F.transform(pieces, lambda p: F.length(p["head"]) + F.length(p["body"]) + 1)

    def spans(before: Column) -> Column:
        each = F.zip_with(
            pieces,
            before,
            lambda p, at: F.when(
                p["mine"], F.struct((at + F.length(p["head"])).alias("start"), (at + F.length(p["head"]) + F.length(p["body"])).alias("stop"))
            ),
        )
        return F.filter(each, lambda x: x.isNotNull())

    return once(sums_before(sizes), spans)


def rotated(
    chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", frame: Sequence[str] = FRAME
) -> DataFrame:
    """One row per conversation, participant and part: id, ``assistant``, ``part``, ``n_turns``, ``text``, ``masks``.

    Parts in order, laid end to end, are the whole dialogue; masks count from the start of their
    part. Turns are ordered by number (null last), then speaker and text, and rows that
    repeat are turns of their own. Null texts are empty turns; a null or blank role is the
    participant ``unknown``; rows without a conversation id are one conversation. One with
    frame turns alone has no participant and gives no row. Other columns are left
    out. An empty table gives none.
    """
    turns = turns_of(chats, conv_col, turn_col, role_col, text_col)
    whole, cut = in_parts(turns)
    rows = F.sort_array(F.collect_list(F.struct("_turn", "_speaker", "_text"))).alias("_turns")
    name = F.any_value("_conv_id").alias("_conv_id")
    short = whole.groupBy("_conv").agg(rows, name).join(participants(whole, frame), "_conv").withColumn("_part", F.lit(0).cast("long"))
    long = cut.groupBy("_conv", "_part").agg(rows, name).join(meetings(cut, frame), ["_conv", "_part"])
    pieces = segments(F.col("_turns"), F.col("assistant"), frame)
    drawn = short.unionByName(long).select("_conv_id", "assistant", "_part", F.explode(F.array(pieces)).alias("_pieces"))
    return drawn.select(
        F.col("_conv_id").alias(conv_col),
        "assistant",
        F.col("_part").alias("part"),
        F.size("_pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        masks(F.col("_pieces")).alias("masks"),
    )
