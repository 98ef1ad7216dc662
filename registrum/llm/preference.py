"""Preference formatting: two conversations per pair become a shared prompt and two completions.

The prompt is the longest common prefix of turns of the chosen and the rejected conversation,
rendered once. What follows it on either side is that side's completion; only the assistant's
turns of a completion are trained on, all else is masked.

Turns stay rows from beginning to end. A turn that only one side has is a difference; the first
number of such a turn (a partial aggregate per pair) ends the prompt. So no conversation, however
long, is gathered in a task, and a pair that holds a third of all turns is spread by its turns.

Turns of one number count as one step: they are common if both sides have the same ones. Repeated
rows count once. Null role and text count as empty, a null number comes last, turns without a
pair id belong to no pair and are left out. A side without turns gives an empty completion; equal
sides give a prompt only. Other columns are not carried along, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.session import write_and_reread

LAST = (1 << 63) - 1


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def segments(
    chosen: DataFrame,
    rejected: DataFrame,
    pair: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per rendered turn: pair, part (prompt, chosen, rejected), turn, rendered, trained."""

    def side(df: DataFrame, own: bool) -> DataFrame:
        return df.where(F.col(pair).isNotNull()).select(
            F.col(pair).alias("pair"),
            F.coalesce(F.col(turn).cast("long"), F.lit(LAST)).alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(own).alias("in_chosen"),
            F.lit(not own).alias("in_rejected"),
        )

    turns = (
        side(chosen, True)
        .unionByName(side(rejected, False))
        .groupBy("pair", "turn", "role", "text")
        .agg(F.max("in_chosen").alias("in_chosen"), F.max("in_rejected").alias("in_rejected"))
    )
    turns = write_and_reread(turns, "turns")
    ends = turns.where("in_chosen <> in_rejected").groupBy("pair").agg(F.min("turn").alias("end"))
    ends = write_and_reread(ends, "prompt-ends")
    placed = turns.join(ends, "pair", "left")
    prompt = F.col("end").isNull() | (F.col("turn") < F.col("end"))
    parts = F.when(prompt, F.array(F.lit("prompt"))).otherwise(
        F.array_compact(F.array(F.when(F.col("in_chosen"), "chosen"), F.when(F.col("in_rejected"), "rejected")))
    )
    return placed.withColumn("part", F.explode(parts)).select(
        "pair",
        "part",
        "turn",
        rendered(F.col("role"), F.col("text")).alias("rendered"),
        ((F.col("part") != "prompt") & (F.col("role") == trained_role)).alias("trained"),
    )


def assembled(found: DataFrame) -> DataFrame:
    """One row per pair for a trainer: prompt, chosen, rejected, and for both completions the
    trained stretches as start and stop in code points. A row holds one whole conversation."""

    def turns(part: str) -> Column:
        own = F.when(F.col("part") == part, F.struct("turn", "rendered", "trained"))
        return F.array_sort(F.collect_list(own)).alias(part)

    rows = found.groupBy("pair").agg(*[turns(p) for p in ("prompt", "chosen", "rejected")])

    def body(part: str) -> Column:
        return F.array_join(F.col(f"{part}.rendered"), "").alias(part)

    def mask(part: str) -> Column:
        done = F.aggregate(
            part,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
            lambda s, t: F.struct(
                (s["at"] + F.length(t["rendered"])).alias("at"),
                F.when(
                    t["trained"],
                    F.concat(
                        s["spans"],
                        F.array(F.struct(s["at"].alias("start"), (s["at"] + F.length(t["rendered"])).alias("stop"))),
                    ),
                ).otherwise(s["spans"]).alias("spans"),
            ),
        )
        return done["spans"].alias(f"{part}_trained")

    return rows.select("pair", body("prompt"), body("chosen"), body("rejected"), mask("chosen"), mask("rejected"))
