"""Preference pairs: a prompt that is rendered once, and two completions with masks.

All of it is column expressions. Two conversations are compared turn by turn; the turns that both
begin with are the prompt, and what follows in each is its completion. A mask names the character
spans of a completion that are trained on: the texts of its assistant turns with their end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_stream.llm.common import written

START, END = "<|im_start|>", "<|im_end|>"


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id and `turns`, an array of (turn, role, text) in the order of these three.

    A null role or text counts as empty. Rows without a conversation id belong to none. Turns that
    stand more than once are kept each.
    """
    one = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    known = turns.where("conv_id is not null")
    return known.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))


def _same(a: Column, b: Column) -> Column:
    return a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])


def common_prefix(a: Column, b: Column) -> Column:
    """How many turns both begin with; the turn numbers do not matter."""
    same = F.zip_with(a, b, lambda x, y: x.isNotNull() & y.isNotNull() & _same(x, y))
    breaks = F.array_position(same, F.lit(False))
    return F.when(breaks > 0, breaks - 1).otherwise(F.size(a).cast("bigint")).cast("int")


def _rendered(turn: Column) -> Column:
    return F.concat(
        F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n")
    )


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def mask(turns: Column) -> Column:
    """Spans (start, end) of the rendered turns that are trained on."""

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(F.lit(START)) + F.length(turn["role"]) + 1
        end = begin + F.length(turn["text"]) + F.length(F.lit(END))
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(turns, begin, step, lambda state: state["spans"])


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """`pairs` has pair_id, and `chosen` and `rejected`: arrays of (turn, role, text).

    Returns pair_id, n_common, prompt, and for each side the completion, its mask, and whether it
    trains anything. Equal conversations have an empty completion on both sides; if one is the
    beginning of the other, its completion is empty. A null conversation counts as one without
    turns. Other columns are left out.
    """
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    sides = pairs.select(
        "pair_id",
        F.coalesce("chosen", none).alias("chosen"),
        F.coalesce("rejected", none).alias("rejected"),
    )
    n = common_prefix(F.col("chosen"), F.col("rejected"))
    counted = sides.withColumn("n_common", n)

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("n_common") + 1, F.greatest(F.size(side), F.lit(1)))

    cut = counted.select(
        "pair_id",
        "n_common",
        render(F.slice("chosen", F.lit(1), F.col("n_common"))).alias("prompt"),
        rest("chosen").alias("c"),
        rest("rejected").alias("r"),
    )
    return cut.select(
        "pair_id",
        "n_common",
        "prompt",
        render(F.col("c")).alias("chosen"),
        mask(F.col("c")).alias("chosen_mask"),
        render(F.col("r")).alias("rejected"),
        mask(F.col("r")).alias("rejected_mask"),
    )


def last_reply_swapped(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: each one with an assistant turn is chosen as it is; rejected is
    the same with the text of its last assistant turn taken from the next conversation that has
    one, in the order of the ids. The last one takes that of the first.

    Conversations without an assistant turn give no pair. One that is alone is its own partner, so
    both its completions are empty, as are those of neighbours with equal replies.

    The conversations are dealt out by ranges of their ids; the next one is found within the range,
    and the last of a range takes the first of the next, of which there is one for each task.
    """
    spark = conversations.sparkSession
    is_reply = F.transform("turns", lambda t: t["role"] == "assistant")
    where = F.size("turns") - F.array_position(F.reverse(is_reply), F.lit(True))
    own = conversations.where(F.exists("turns", lambda t: t["role"] == "assistant"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.select("conv_id", "turns", where.cast("int").alias("at")).repartitionByRange(parts, "conv_id")
    rows = written(dealt.withColumn("part", F.spark_partition_id()))
    reply = F.element_at("turns", F.col("at") + 1)["text"]
    firsts = rows.groupBy("part").agg(F.min_by(reply, "conv_id").alias("first"))
    ring = firsts.groupBy().agg(F.array_sort(F.collect_list(F.struct("part", "first"))).alias("ring"))
    following = ring.select(
        F.explode(F.expr("transform(ring, (x, i) -> struct(x.part, ring[(i + 1) % size(ring)].first AS following))"))
    ).select("col.*")
    inside = Window.partitionBy("part").orderBy("conv_id")
    met = rows.withColumn("next", F.lead(reply).over(inside)).join(following, "part")
    swapped = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["turn"].alias("turn"),
            t["role"].alias("role"),
            F.when(i == F.col("at"), F.coalesce("next", "following")).otherwise(t["text"]).alias("text"),
        ),
    )
    return met.select(
        F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), swapped.alias("rejected")
    )
