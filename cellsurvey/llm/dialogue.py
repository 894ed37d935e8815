"""Chat formatting by perspective rotation. Native: DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as ``assistant``, the others as
``user`` with their name, and the system turns as they are. The mask of a rendering lists the code-point spans of the
assistant's words and of the mark that ends them: what a model would be trained on.

A conversation of any length is rendered in parts of ``turns_per_part`` turns; the parts of a perspective joined in order
are the whole rendering, and offsets of masks count from its beginning. Turns are ordered by (turn, speaker, text) with
NULL first; a NULL text is empty, a NULL speaker is the system, a NULL conversation is a conversation of its own, and
repeated turns stay. Conversations of system turns alone have no participant and no rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions.ranking import running_totals
from cellsurvey.llm.common import own_columns
from cellsurvey.session import durable

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rotate(turns: DataFrame, speaker: str = "role", system: str = "system", turns_per_part: int = 256) -> DataFrame:
    """(conv_id, perspective, part, text, mask array<struct<start, end>>, n_turns)."""
    said = own_columns(turns, "conv_id", "turn", speaker, "text").select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "turn",
        F.coalesce(speaker, F.lit(system)).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    # a conversation can hold a third of all turns: positions come from ranges of rows, not from a window over it
    numbered = durable(running_totals(said.withColumn("one", F.lit(1).cast("bigint")), ["conv"], ["turn", "speaker", "text"], ["one"]))
    people = durable(
        numbered.filter(F.col("speaker") != system).groupBy("conv", F.col("speaker").alias("perspective")).agg(F.count(F.lit(1)).alias("own")))
    parts = numbered.withColumn("part", F.floor(F.col("one_before") / turns_per_part))
    grouped = durable(
        parts.groupBy("conv_id", "conv", "part")  # at most turns_per_part turns each
        .agg(F.array_sort(F.collect_list(F.struct("one_before", "speaker", "text"))).alias("turns")))
    name = lambda t, p: (
        F.when(t["speaker"] == system, F.lit(system)).when(t["speaker"] == p, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), t["speaker"])))
    rendered = grouped.join(people.select("conv", "perspective"), "conv").select(
        "conv_id", "conv", "perspective", "part",
        F.transform("turns", lambda t: F.struct(
            F.concat(F.lit(OPEN), name(t, F.col("perspective")), F.lit("\n")).alias("head"),
            t["text"].alias("text"), (t["speaker"] == F.col("perspective")).alias("own"))).alias("turns"))
    tail = f"{CLOSE}\n"
    body = rendered.select(
        "*", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(tail))), "").alias("text"),
        # running offset inside the part, and the spans of own turns
        F.aggregate(
            "turns", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("mask")),
            lambda s, t: F.struct(
                (s["at"] + F.length(t["head"]) + F.length(t["text"]) + len(tail)).alias("at"),
                F.when(t["own"], F.concat(s["mask"], F.array(F.struct(
                    (s["at"] + F.length(t["head"])).alias("start"),
                    (s["at"] + F.length(t["head"]) + F.length(t["text"]) + len(CLOSE)).alias("end")))))
                .otherwise(s["mask"]).alias("mask")),
            lambda s: s["mask"]).alias("mask"))
    sized = body.select("conv_id", "conv", "perspective", "part", "text", "mask", F.size("turns").alias("n_turns"), F.length("text").cast("bigint").alias("size"))
    placed = running_totals(sized, ["conv", "perspective"], ["part"], ["size"])
    return placed.select(
        "conv_id", "perspective", "part", "text", "n_turns",
        F.transform("mask", lambda m: F.struct(
            (m["start"] + F.col("size_before")).alias("start"), (m["end"] + F.col("size_before")).alias("end"))).alias("mask"))
