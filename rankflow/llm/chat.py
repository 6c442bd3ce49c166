"""Multi-party dialogues from the view of each participant.

For every participant of a conversation the dialogue is rendered with that speaker as the
assistant and the others as named users; system turns stay system turns. The mask covers
what the assistant says, with the end of turn. Dialogues are cut between turns into parts: a
turn belongs to the part in which its first character falls, counting ``part_chars``
characters to a part. So no row outgrows a part and its last turn, however long the
conversation.

Every view of a conversation repeats its turns; that is what is asked for. Turns go by
``turn``, then role, then text with its end mark, nulls first. Repeated rows are repeated
turns, counted before they are placed. A conversation of very many turns, such as the one of
all rows without a conversation, is placed in blocks: turns chosen by hash cut it along its
order. A null role is a participant called unknown, a null text is empty, and rows with a null
conversation form one conversation. A conversation of system turns alone has no view. The
opening of a turn marker inside a text is broken up by a blank, so texts cannot forge turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.blocks import with_running
from rankflow.llm.common import picked
from rankflow.session import stage

PART_CHARS = 8192
BLOCK_TURNS = 65_536
"""Distinct turns in a block, on average; a conversation of far fewer is one block."""
CUT_CHARS = 1024
"""A cut keeps that much of its text, so cuts stay small; texts alike that far share a block."""
REPEATS = 4096
"""Repeated turns are written out in lists of that length."""
START, END = "<|im_start|>", "<|im_end|>"


def _passed(cuts: Column, row: Column) -> Column:
    """How many of the sorted ``cuts`` do not come after ``row``, by halving."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span["lo"], span["hi"]
        middle = F.floor((lo + hi) / 2).cast("int")
        passed = F.get(cuts, middle) <= row
        return F.when(lo >= hi, span).otherwise(
            F.struct(F.when(passed, middle + 1).otherwise(lo).alias("lo"), F.when(passed, hi).otherwise(middle).alias("hi"))
        )

    whole = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.when(cuts.isNull(), F.lit(0)).otherwise(F.aggregate(rounds, whole, halve, lambda span: span["lo"]))


def _in_blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """Distinct turns with the ``block`` of their conversation's order that they fall in."""
    place = lambda text: F.struct("turn", "role", text.alias("tail"))
    chosen = rows.filter(F.pmod(F.xxhash64("conv", "turn", "role", "tail"), F.lit(block_turns)) == 0)
    cut = place(F.left("tail", F.lit(CUT_CHARS)))
    cuts = chosen.groupBy(F.col("conv").alias("of")).agg(F.sort_array(F.collect_set(cut)).alias("cuts"))
    met = rows.join(stage(cuts, "cuts"), F.col("conv").eqNullSafe(F.col("of")), "left")
    return met.withColumn("block", _passed(F.col("cuts"), place(F.col("tail")))).drop("of", "cuts")


def turns(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """Each turn in each participant's view: ``(conv, speaker, turn, role, said, masked, start)``.

    ``said`` is the rendered turn, ``masked`` the character of ``said`` from which the mask runs
    to its end (null: none), ``start`` where the turn stands in the whole dialogue.
    """
    said = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = picked(conversations, conv=conv, turn=turn, role=role, text=text).select(
        "conv", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.concat(said, F.lit(END + "\n")).alias("tail")
    )
    rows = stage(rows.groupBy("conv", "turn", "role", "tail").agg(F.count("*").alias("n")), "turns")
    system = F.col("role") == "system"
    speakers = rows.filter(~system).select(F.col("conv").alias("in"), F.col("role").alias("speaker")).distinct()
    speakers = stage(speakers, "speakers")
    views = _in_blocks(rows, block_turns).join(speakers, F.col("conv").eqNullSafe(F.col("in"))).drop("in")
    own = F.col("role") == F.col("speaker")
    head = F.concat(
        F.lit(START),
        F.when(system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), F.col("role"))),
        F.lit("\n"),
    )
    views = views.select(
        F.col("conv").isNull().alias("no_conv"),
        "conv",
        "speaker",
        "turn",
        "role",
        "n",
        "block",
        F.concat(head, "tail").alias("said"),
        F.when(own, F.length(head)).alias("masked"),
    )
    # Null conversations are told apart by a flag, as joins on the key pass over nulls.
    keyed = views.withColumn("at", F.coalesce(F.col("conv").cast("string"), F.lit("")))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("said")]
    size = F.length("said").cast("bigint")
    placed = with_running(keyed, ["no_conv", "at", "speaker"], "block", order, "first", size * F.col("n"))
    lists = placed.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(REPEATS).cast("bigint"))))
    each = lists.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + REPEATS, F.col("n")) - 1)))
    return each.select("conv", "speaker", "turn", "role", "said", "masked", (F.col("first") + F.col("copy") * size).alias("start"))


def dialogues(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_chars: int = PART_CHARS,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """``(conv, speaker, part, n_turns, dialogue, mask)`` for every participant's view.

    ``mask`` holds (start, end) characters of ``dialogue``, the end beyond the last, to train on.
    """
    said = turns(conversations, conv, turn, role, text, block_turns).withColumn("part", F.floor(F.col("start") / part_chars).cast("bigint"))
    line = F.struct("start", "role", "said", "masked")
    parts = said.groupBy("conv", "speaker", "part").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    first = F.col("lines")[0]["start"]
    spoken = F.filter("lines", lambda x: x["masked"].isNotNull())
    mask = F.transform(
        spoken,
        lambda x: F.struct(
            (x["start"] - first + x["masked"]).alias("start"), (x["start"] - first + F.length(x["said"]) - 1).alias("end")
        ),
    )
    return parts.select(
        "conv",
        "speaker",
        "part",
        F.size("lines").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["said"]), "").alias("dialogue"),
        mask.alias("mask"),
    )
