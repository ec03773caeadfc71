"""A dialogue seen by each of its participants.

The project stores no dialogues, so the operator is general: rows ``conv_id``,
``turn``, ``speaker``, ``text``. For each participant (every speaker but
``system``) the whole dialogue is rendered with that speaker as assistant, all
others as named users, and loss spans over the assistant's own words.

Turns are numbered within their dialogue, and a part holds ``PART_ROWS`` of
them, so no task ever gathers more than that of a dialogue; parts in order are the
dialogue. The numbers come from one order of all turns, cut into ranges
of which a long dialogue fills many. Only DataFrame functions are used.

Defined results: a null speaker is ``unknown``, a null text is empty, null turns
come first (as turn -1); identical rows are one; different rows with one turn
number are ordered by the digests of speaker and text; rows with a null ``conv_id`` are one
dialogue; a dialogue of system turns alone has no participant and no view. Columns besides the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.running import NUMBER, before_each
from matchloom.session import Workspace

PART_ROWS = 64
SYSTEM = "system"


def dialogue_turns(turns: DataFrame) -> DataFrame:
    return turns.select(
        "conv_id", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("speaker", F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text")).distinct()


def numbered_turns(turns: DataFrame, work: Workspace) -> DataFrame:
    """Turns with ``number_``, the turns before them in the order of dialogues, turn numbers and digests."""
    rows = work.settle(dialogue_turns(turns).withColumn("digest", F.concat(F.md5("speaker"), F.md5("text"))), "turns")
    numbered = before_each(rows, work, "numbered", [F.col("conv_id").asc_nulls_first(), F.col("turn"), F.col("digest")], {})
    work.drop("turns")  # the numbered table has taken its place
    return numbered.select("conv_id", "speaker", "text", NUMBER)


def render(segments: Column) -> tuple[Column, Column]:
    """Text of ordered segments ``head``, ``body``, ``own``, and the spans of those that are the assistant's own."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(done: Column, segment: Column) -> Column:
        begin = done["end"] + F.length(segment["head"])
        end = begin + F.length(segment["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("end"), F.when(segment["own"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))
    lines = F.transform(segments, lambda s: F.concat(s["head"], s["body"], F.lit("\n")))
    return F.array_join(lines, ""), F.aggregate(segments, start, add, lambda done: done["spans"])


def perspective_views(turns: DataFrame, work: Workspace) -> DataFrame:
    """One row per dialogue, participant and part: ``conv_id``, ``perspective``, ``part``, ``n_turns``, ``rendered``,
    ``loss_spans`` (start and end characters in the part of what the model learns to say).

    Participants are settled before the join, so Spark can split the turns of a
    very long dialogue. Views are one per participant and turn by definition.
    """
    rows = numbered_turns(turns, work)
    speakers = work.settle(rows.groupBy("conv_id", "speaker").agg(F.min(NUMBER).alias("first")), "speakers")
    starts = speakers.groupBy("conv_id").agg(F.min("first").alias("first"))
    same_dialogue = F.col("s.conv_id").eqNullSafe(F.col("d.conv_id"))
    people = work.settle(speakers.where(F.col("speaker") != SYSTEM).alias("s").join(starts.alias("d"), same_dialogue)
                         .select("s.conv_id", F.col("speaker").alias("perspective"), "d.first"), "participants")
    own = F.col("speaker") == F.col("perspective")
    head = (F.when(own, F.lit("<|assistant|>")).when(F.col("speaker") == SYSTEM, F.lit("<|system|>"))
            .otherwise(F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>"))))
    segment = F.struct(NUMBER, F.concat(head, F.lit("\n")).alias("head"), F.concat("text", F.lit("<|end|>")).alias("body"), own.alias("own"))
    same = F.col("t.conv_id").eqNullSafe(F.col("p.conv_id"))
    joined = rows.alias("t").join(people.alias("p"), same).select(
        "t.*", "perspective", F.floor((F.col(NUMBER) - F.col("first")) / PART_ROWS).alias("part"))
    views = joined.groupBy("conv_id", "perspective", "part").agg(F.sort_array(F.collect_list(segment)).alias("segments"))
    rendered, spans = render(F.col("segments"))
    return views.select("conv_id", "perspective", "part", F.size("segments").cast("long").alias("n_turns"),
                        rendered.alias("rendered"), spans.alias("loss_spans"))
