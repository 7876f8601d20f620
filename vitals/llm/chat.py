r"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to one string. The turns of a conversation are
rendered as successively longer prefixes; what an output adds to the one before is the span of
the newest turn. Two more renderings, in which that turn's text is one letter or another, show
where inside the span the text begins and ends. A template that changes what it wrote before is
detected: its conversation is marked ``rewritten`` and gets no spans, as no turn's place is then
certain. Loss falls on the texts of the given roles.

``marked`` is a template that wraps each turn in control strings. In texts and roles it writes one
more backslash into every ``<``, backslashes, ``|`` sequence, so ``<|`` never occurs in them and
``read_back`` recovers every role and text exactly.

A conversation's output is one string, so a task holds one conversation at a time; turns arrive
sorted and are read as a stream. Rendering every prefix takes time in the square of the number of
turns of one conversation, which is inherent to a template known only by its output. So the prefixes
of a conversation of more than ``BLOCK_TURNS`` turns are rendered in blocks, each in a task of its
own that gets the turns up to the block's end; blocks need no result of each other, as the one before
a prefix is rendered again where a block begins.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.tables import slices, stored

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

# The control strings of the template.
START = "<|im_start|>"
END = "<|im_end|>"

SPAN = "role string, span_start bigint, span_end bigint, text_start bigint, text_end bigint, loss boolean"
FORMATTED = f"conv_id bigint, n_turns bigint, formatted string, rewritten boolean, spans array<struct<{SPAN}>>"
OUTPUT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("rewritten", pa.bool_()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("role", pa.string()), *((c, pa.int64()) for c in ("span_start", "span_end", "text_start", "text_end")), ("loss", pa.bool_())]
                )
            ),
        ),
    ]
)
FLUSH_CHARS = 4 << 20
BLOCK_TURNS = 512
# Rows of ids up to which the table of long conversations is broadcast.
BROADCAST_IDS = 100_000


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """A role also ends at the line end, so it must not hold one."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked(turns: Sequence[Turn]) -> str:
    return "".join([f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns])


def read_back(formatted: str) -> list[Turn]:
    """Roles and texts of an output of ``marked``."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        out.append((unescape_role(role), unescape(rest[: -len(END) - 1])))
    return out


def render(
    turns: Sequence[Turn], template: Template, loss_roles: frozenset[str], start: int = 0
) -> tuple[str, bool, list[dict]]:
    """The output, whether history was rewritten, and a span for each turn from ``start`` if it was not."""
    before, spans = template(turns[:start]), []
    for k in range(start + 1, len(turns) + 1):
        role, _ = turns[k - 1]
        now = template(turns[:k])
        if not now.startswith(before):
            return template(turns), True, []
        a, b = (template([*turns[: k - 1], (role, letter)]) for letter in "ab")
        if not (a.startswith(before) and b.startswith(before)):
            return template(turns), True, []
        head = len(commonprefix([a[len(before) :], b[len(before) :]]))
        tail = len(a) - len(before) - head - 1
        spans.append(
            {
                "role": role,
                "span_start": len(before),
                "span_end": len(now),
                "text_start": len(before) + head,
                "text_end": max(len(now) - tail, len(before) + head),
                "loss": role in loss_roles,
            }
        )
        before = now
    return before, False, spans


def format_conversations(
    conversations: DataFrame,
    template: Template = marked,
    loss_roles: Sequence[str] = ("assistant",),
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """One row per ``conv_id`` (null is one of them): the output, its spans in code points.

    Turns are ordered by ``turn`` (null first), ties by role and text, repeated rows all kept; a
    null role or text counts as empty. Other columns are ignored.
    """
    empty = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    long = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > block_turns), "long-conversations")
    n_long = long.count()
    if not n_long:
        return rendered(turns, template, loss_roles)
    ids = long.select(F.col("conv_id").alias("_id"), "n")
    ids = F.broadcast(ids) if n_long <= BROADCAST_IDS else ids
    is_long = F.col("conv_id").eqNullSafe(F.col("_id"))
    short = rendered(turns.join(ids, is_long, "left_anti"), template, loss_roles)
    return short.unionByName(rendered_in_blocks(turns.join(ids, is_long).drop("_id"), template, loss_roles, block_turns))


def rows_of(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple]:
    for batch in slices(batches):
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def rendered(turns: DataFrame, template: Template, loss_roles: Sequence[str]) -> DataFrame:
    """Each conversation in one task."""
    by_turn = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    wanted = frozenset(loss_roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, chars = [], 0
        for conv_id, group in groupby(rows_of(batches, ("conv_id", "role", "text")), itemgetter(0)):
            own = [turn[1:] for turn in group]
            formatted, rewritten, spans = render(own, template, wanted)
            ready.append(
                {"conv_id": conv_id, "n_turns": len(own), "formatted": formatted, "rewritten": rewritten, "spans": spans}
            )
            chars += len(formatted)
            if chars > FLUSH_CHARS:
                yield pa.RecordBatch.from_pylist(ready, OUTPUT)
                ready, chars = [], 0
        yield pa.RecordBatch.from_pylist(ready, OUTPUT)

    return by_turn.mapInArrow(run, FORMATTED)


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``at``, a turn's place in its conversation. Range partitions split a long conversation;
    only their counts are summed for the whole of it."""
    order = ["conv_id", "turn", "role", "text"]
    parts = stored(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    before = Window.partitionBy("id").orderBy("own").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(F.col("conv_id").alias("id"), F.col("part").alias("own")).agg(F.count("*").alias("rows"))
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    return (
        parts.withColumn("at", F.row_number().over(inside) - 1)
        .join(ahead, (F.col("part") == F.col("own")) & F.col("conv_id").eqNullSafe(F.col("id")))
        .withColumn("at", F.col("at") + F.col("ahead"))
        .select("conv_id", "n", "at", "role", "text")
    )


def rendered_in_blocks(turns: DataFrame, template: Template, loss_roles: Sequence[str], block_turns: int) -> DataFrame:
    """Each block of prefixes in a task of its own; ``n`` is the number of turns of a conversation."""
    of_turn = F.floor(F.col("at") / block_turns)
    last = F.floor((F.col("n") - 1) / block_turns)
    needed = numbered(turns).withColumn("block", F.explode(F.sequence(of_turn, last)))
    by_turn = needed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    wanted = frozenset(loss_roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("conv_id", "block", "n", "role", "text")
        for (conv_id, block, n), group in groupby(rows_of(batches, columns), itemgetter(0, 1, 2)):
            own = [turn[3:] for turn in group]
            formatted, rewritten, spans = render(own, template, wanted, block * block_turns)
            row = {"conv_id": conv_id, "n_turns": n, "rewritten": rewritten, "spans": spans, "block": block}
            row["formatted"] = formatted if len(own) == n else None
            yield pa.RecordBatch.from_pylist([row], OUTPUT.append(pa.field("block", pa.int64())))

    blocks = by_turn.mapInArrow(run, f"{FORMATTED}, block bigint")
    whole = blocks.groupBy("conv_id", "n_turns").agg(
        F.max("formatted").alias("formatted"),
        F.max("rewritten").alias("rewritten"),
        F.array_sort(F.collect_list(F.struct("block", "spans"))).alias("blocks"),
    )
    spans = F.flatten(F.col("blocks.spans"))
    return whole.select(
        "conv_id",
        "n_turns",
        "formatted",
        "rewritten",
        F.when(F.col("rewritten"), F.slice(spans, 1, 0)).otherwise(spans).alias("spans"),
    )


READ = "conv_id bigint, n_turns bigint, turns string, loss string, formatted_chars bigint"


def read_formatted(formatted: DataFrame) -> DataFrame:
    """From outputs of ``marked`` alone: every turn as role, line end, text, line end, and all
    text under the loss mask, unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            whole = batch.column("formatted").to_pylist()
            turns = [read_back(f) for f in whole]
            loss = [
                "".join([unescape(f[s["text_start"] : s["text_end"]]) for s in spans if s["loss"]])
                for f, spans in zip(whole, batch.column("spans").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(map(len, turns), pa.int64()),
                    pa.array(["".join([f"{r}\n{t}\n" for r, t in own]) for own in turns], pa.string()),
                    pa.array(loss, pa.string()),
                    pa.array(map(len, whole), pa.int64()),
                ],
                ["conv_id", "n_turns", "turns", "loss", "formatted_chars"],
            )

    return formatted.mapInArrow(run, READ)


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Adds conversation -1, whose texts imitate the control strings."""
    rows = [(-1, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    probe = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def digests(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    read = read_formatted(format_conversations(with_probe(spark, conversations)))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
