"""Conversation structure repair by a rank-convergence parallel Viterbi.

A conversation is whole if the initials of its roles, in order, are ``(s?(ua)+)?``. Its turns, in order
of ``turn`` (nulls first, then by role and text), have at most one fault each: *blank* (no character but
white space), *duplicate* (role and text occurred before) or *truncated* (does not end in ``.``, ``!`` or
``?``). Edits make it whole: ``K`` keeps a turn, ``R`` gives it the role the place asks for (1), ``D``
deletes it (2; blank and duplicate ones must go), ``I`` inserts an empty turn (5); a truncated turn that
stays costs 5 more. The cheapest edits count, and of equally cheap ones the least string of letters.

*Costs.* What is left to pay from a place in the conversation, for each of four states (nothing yet,
after ``s``, after ``u``, after ``a``), follows backward from turn to turn: a product of matrices over
(min, +). Conversations are cut into chunks, and all chunks of a batch go back in step in numpy, each from
a *speculative* vector: what is left if the conversation ended there. Such products soon have rank one:
whatever they start from, they differ by a constant. So a chunk is right, up to a constant, if the vector that the
next one delivers is its own plus a constant. Only chunks for which it is not are rerun with that vector,
until none is left (fix-up passes). Decisions compare costs at one place, so constants do not matter.

*Tracing.* Edits are read forward, always the least letter whose cost and what is left after it equal
what was left before. A chunk is traced from each state; the states chosen at its end lead from chunk to
chunk to the state in which each one is entered.

*Scale.* Rows are ranged by conversation, turn, role and the beginning of the text, so one long
conversation is spread over tasks; only copies of one turn stay together. Conversations inside one chunk are
finished where they are. Of others, only vectors and states of chunks meet, one row for ``CHUNK`` turns,
and are read as a sorted stream. A digest of a whole repaired conversation reads its texts in one stream, too,
holding one chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.llm.tables import dropped, slices, stored

CHUNK = 64
CHUNK_CHARS = 4 << 20
# Characters of a text by which rows are ranged.
RANGED = 64
WHITE = " \t\n\v\f\r"
ENDS = (".", "!", "?")

OTHER, SYSTEM, USER, ASSISTANT = range(4)
CLASSES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
REROLE, DELETE, INSERT, STUMP = 1, 2, 5, 5

# States: nothing yet, after s, after u, after a. The state after the one role that edits can put next,
# the state after keeping a role where that is allowed, and what is left to pay at the end.
NEXT = [2, 2, 3, 2]
KEEP = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (3, USER): 2, (2, ASSISTANT): 3}
FINAL = [0, 2 * INSERT, INSERT, 0]
ROLES = {2: "user", 3: "assistant"}
NEVER = 1 << 40
PAD = 255


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults: by the crc32 of ``conv_id:turn`` modulo 20 a row is dropped, emptied,
    stripped of its sentence ends, repeated, or given to the user. Nulls count as one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    h = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return (
        conversations.filter(h != 0)
        .select(
            "conv_id",
            "turn",
            F.when(h == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
            F.when(h == 1, "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(h == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def symbols(roles: list[str], texts: list[str]) -> bytes:
    """Of each turn the class of its role and, times four, its fault."""
    seen, out = set(), bytearray()
    for role, text in zip(roles, texts):
        bare = text.rstrip(WHITE)
        fault = BLANK if not bare else DUPLICATE if (role, text) in seen else FINE if bare.endswith(ENDS) else TRUNCATED
        seen.add((role, text))
        out.append(CLASSES.get(role[:1], OTHER) + 4 * fault)
    return bytes(out)


CHUNKS = pa.schema(
    [("conv_id", pa.int64()), ("chunk", pa.int64()), ("turn_min", pa.int64()), ("turn_max", pa.int64()), ("n_turns", pa.int64()),
     ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("symbols", pa.binary())]
)
CHUNKS_SQL = (
    "conv_id bigint, chunk bigint, turn_min bigint, turn_max bigint, n_turns bigint, roles array<string>, texts array<string>, symbols binary"
)


def chunks(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """Turns in order, cut into chunks of at most ``size`` turns; chunk numbers follow the order.

    ``turn_min``, ``turn_max`` and ``n_turns`` describe the distinct turns that are not null.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    ordered = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(RANGED))).sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        piece, chars = [], 0
        for batch in slices(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                if piece and (row[0] != piece[0][0] or len(piece) >= size or chars > CHUNK_CHARS):
                    yield piece
                    piece, chars = [], 0
                piece.append(row)
                chars += len(row[3])
        if piece:
            yield piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ready, chars = TaskContext.get().partitionId() << 32, [], 0
        for piece in pieces(batches):
            turns = {t for _, t, _, _ in piece if t is not None}
            roles, texts = [r for _, _, r, _ in piece], [t for *_, t in piece]
            ready.append((piece[0][0], number, min(turns, default=None), max(turns, default=None), len(turns), roles, texts, symbols(roles, texts)))
            number += 1
            chars += sum(map(len, texts))
            if chars > CHUNK_CHARS:
                yield batch_of(ready, CHUNKS)
                ready, chars = [], 0
        yield batch_of(ready, CHUNKS)

    return ordered.mapInArrow(run, CHUNKS_SQL)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def costs(parts: list[bytes], ends: np.ndarray) -> np.ndarray:
    """What is left to pay at each place of each chunk and in each state, given what is left at its end:
    (places, chunks, states). All chunks go back in step; shorter ones wait."""
    width = max(map(len, parts), default=0)
    steps = np.full((len(parts), width), PAD, np.uint8)
    for i, part in enumerate(parts):
        steps[i, : len(part)] = np.frombuffer(part, np.uint8)
    left = np.empty((width + 1, len(parts), 4), np.int64)
    left[width] = now = ends
    after = [NEXT[q] for q in NEXT]
    for k in range(width - 1, -1, -1):
        role, fault = steps[:, k, None] & 3, steps[:, k, None] >> 2
        kept = np.full(now.shape, NEVER)
        for (q, cls), to in KEEP.items():
            kept[:, q] = np.where(role[:, 0] == cls, now[:, to], kept[:, q])
        stays = np.minimum(kept, REROLE + now[:, NEXT]) + np.where(fault == TRUNCATED, STUMP, 0)
        paid = np.where((fault == BLANK) | (fault == DUPLICATE), NEVER, stays)
        paid = np.minimum(paid, DELETE + now)
        paid = np.minimum(paid, np.minimum(INSERT + paid[:, NEXT], 2 * INSERT + paid[:, after]))
        left[k] = now = np.where(steps[:, k, None] == PAD, now, paid)
    return left


def traced(part: bytes, left: list[list[int]], state: int, last: bool) -> tuple[str, int, int]:
    """The least letters of the cheapest edits from a state, their cost, and the state at the end."""
    letters, cost = [], 0
    for i, step in enumerate(part):
        extra = STUMP if step >> 2 == TRUNCATED else 0
        while True:
            here, after, onward = left[i][state], left[i + 1], NEXT[state]
            if DELETE + after[state] == here:
                letters.append("D")
                cost += DELETE
            elif INSERT + left[i][onward] == here:
                letters.append("I")
                cost, state = cost + INSERT, onward
                continue
            elif (to := KEEP.get((state, step & 3))) is not None and extra + after[to] == here:
                letters.append("K")
                cost, state = cost + extra, to
            else:
                letters.append("R")
                cost, state = cost + REROLE + extra, onward
            break
    while last and FINAL[state]:
        letters.append("I")
        cost, state = cost + INSERT, NEXT[state]
    return "".join(letters), cost, state


def repaired(letters: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits."""
    new_roles, new_texts, turns = [], [], zip(roles, texts)
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(turns)
        if letter == "D":
            continue
        state = KEEP[state, CLASSES[role[0]]] if letter == "K" else NEXT[state]
        new_roles.append(role if letter == "K" else ROLES[state])
        new_texts.append(text)
    return new_roles, new_texts


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    condition = F.lit(True)
    for c in names:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def _with_earlier_duplicates(parts: DataFrame) -> DataFrame:
    """(``conv_id``, ``chunk``, ``symbols``) of conversations of several chunks, where turns that
    occurred in an earlier chunk are duplicates, too. A chunk names each text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ready = []
            for conv_id, chunk, roles, texts, steps in zip(*(c.to_pylist() for c in batch.columns)):
                for at, (role, text, step) in enumerate(zip(roles, texts, steps)):
                    if step >> 2 in (FINE, TRUNCATED):
                        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
                        ready.append((conv_id, chunk, at, digest))
            yield batch_of(ready, pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("at", pa.int32()), ("digest", pa.binary())]))

    named = parts.select("conv_id", "chunk", "roles", "texts", "symbols").mapInArrow(
        run, "conv_id bigint, chunk bigint, at int, digest binary"
    )
    named = stored(named, "turns")
    first = named.groupBy("conv_id", "digest").agg(F.min("chunk").alias("first")).alias("f")
    again = named.alias("n").join(first, F.expr("n.conv_id <=> f.conv_id AND n.digest = f.digest AND n.chunk > f.first"))
    marks = again.groupBy("n.chunk").agg(F.collect_list("at").alias("repeated"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for steps, at in zip(batch.column("symbols").to_pylist(), batch.column("repeated").to_pylist()):
                new = bytearray(steps)
                for i in at or ():
                    new[i] = (new[i] & 3) + 4 * DUPLICATE
                found.append(bytes(new))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"), pa.array(found, pa.binary())], ["conv_id", "chunk", "symbols"])

    marked = parts.select("conv_id", "chunk", "symbols").join(marks, "chunk", "left").select("conv_id", "chunk", "symbols", "repeated")
    out = stored(marked.mapInArrow(mark, "conv_id bigint, chunk bigint, symbols binary"), "steps")
    dropped(parts.sparkSession, named)
    return out


VECTOR = pa.list_(pa.int64())


def _relaxed(steps: DataFrame) -> DataFrame:
    """Adds ``start``, what is left at a chunk's first place if ``end`` is left at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if batch.num_rows:
                left = costs(batch.column("symbols").to_pylist(), np.array(batch.column("end").to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(left[0].tolist(), VECTOR)], [*batch.schema.names, "start"])

    names = ["conv_id", "chunk", "symbols", "end"]
    return steps.select(*names).mapInArrow(run, "conv_id bigint, chunk bigint, symbols binary, end array<bigint>, start array<bigint>")


def _by_conversation(df: DataFrame, chunk: Column, names: list[str], folded, schema: str) -> DataFrame:
    """``folded`` over the rows of each conversation, as a stream sorted by chunk."""
    ordered = df.repartition("conv_id").sortWithinPartitions("conv_id", chunk).select("conv_id", *names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches):
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", *names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from folded(groupby(rows(batches), lambda r: r[0]))

    return ordered.mapInArrow(run, schema)


WANTED = pa.schema([("chunk", pa.int64()), ("wanted", VECTOR), ("stale", pa.bool_()), ("last", pa.bool_())])


def _stitched(states: DataFrame) -> DataFrame:
    """Of each chunk: whether the vector that the next one delivers is not its own plus a constant, and that vector."""

    def folded(conversations) -> Iterator[pa.RecordBatch]:
        ready = []
        for _, own in conversations:
            incoming, last = np.array(FINAL), True
            for _, chunk, end, start in own:
                apart = incoming - np.array(end)
                stale = bool((apart != apart[0]).any())
                ready.append((chunk, (incoming - incoming.min()).tolist(), stale, last))
                incoming, last = np.array(start), False
                if len(ready) > 1 << 14:
                    yield batch_of(ready, WANTED)
                    ready = []
        yield batch_of(ready, WANTED)

    return _by_conversation(states, F.desc("chunk"), ["chunk", "end", "start"], folded, "chunk bigint, wanted array<bigint>, stale boolean, last boolean")


def settled(steps: DataFrame, most_passes: int = 10_000) -> DataFrame:
    """Adds ``end``, right up to a constant, and whether a chunk is the ``last`` of its conversation."""
    spark = steps.sparkSession
    final = F.array(*(F.lit(x).cast("bigint") for x in FINAL))
    states = stored(_relaxed(steps.withColumn("end", final)), "states")
    for _ in range(most_passes):
        verdicts = stored(_stitched(states), "verdicts")
        stale = verdicts.filter("stale")
        if stale.isEmpty():
            out = states.join(verdicts.select("chunk", "last"), "chunk").select("conv_id", "chunk", "symbols", "end", "last")
            out = stored(out, "settled")
            dropped(spark, states, verdicts)
            return out
        again = _relaxed(states.drop("end", "start").join(stale.select("chunk", F.col("wanted").alias("end")), "chunk"))
        fixed = stored(again.unionByName(states.join(stale.select("chunk"), "chunk", "left_anti")), "states")
        dropped(spark, states, verdicts)
        states = fixed
    raise RuntimeError(f"cost vectors did not settle in {most_passes} passes")


def _entered(states: DataFrame) -> DataFrame:
    """Of each chunk the state in which it is entered: (``chunk``, ``entry``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if batch.num_rows:
                parts = batch.column("symbols").to_pylist()
                left = costs(parts, np.array(batch.column("end").to_pylist())).transpose(1, 0, 2).tolist()
                exits = [[traced(p, whole, q, False)[2] for q in range(4)] for p, whole in zip(parts, left)]
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"), pa.array(exits, VECTOR)], ["conv_id", "chunk", "exits"])

    ends = states.select("conv_id", "chunk", "symbols", "end").mapInArrow(run, "conv_id bigint, chunk bigint, exits array<bigint>")

    def folded(conversations) -> Iterator[pa.RecordBatch]:
        ready = []
        for _, own in conversations:
            state = 0
            for _, chunk, exits in own:
                ready.append((chunk, state))
                state = exits[state]
                if len(ready) > 1 << 14:
                    yield batch_of(ready, pa.schema([("chunk", pa.int64()), ("entry", pa.int64())]))
                    ready = []
        yield batch_of(ready, pa.schema([("chunk", pa.int64()), ("entry", pa.int64())]))

    return _by_conversation(ends, F.col("chunk"), ["chunk", "exits"], folded, "chunk bigint, entry bigint")


PIECES = pa.schema(
    [*CHUNKS][:5]
    + [("alone", pa.bool_()), ("symbols", pa.binary()), ("audit", pa.string()), ("cost", pa.int64())]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)
PIECES_SQL = (
    "conv_id bigint, chunk bigint, turn_min bigint, turn_max bigint, n_turns bigint, alone boolean, "
    "symbols binary, audit string, cost bigint, roles array<string>, texts array<string>"
)


def repair(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """Repaired conversations in pieces, one for each chunk: ``roles`` and ``texts`` after the edits,
    ``audit`` and ``cost``, the ``symbols`` of the turns before them, and whether the piece is all of
    its conversation. Conversation, turn, role and text may be null (role and text: one space); other
    columns are ignored; no turns give no pieces.
    """
    parts = stored(chunks(conversations, size), "chunks")
    many = parts.groupBy("conv_id").count().filter("count > 1")
    several = parts.join(many, _same(parts, many, "conv_id"), "left_semi")
    alone = parts.join(many, _same(parts, many, "conv_id"), "left_anti")
    final = F.array(*(F.lit(x).cast("bigint") for x in FINAL))
    plans = [alone.select("*", final.alias("end"), F.lit(True).alias("last"), F.lit(0).cast("bigint").alias("entry"), F.lit(True).alias("alone"))]
    if not many.isEmpty():
        states = settled(_with_earlier_duplicates(several))
        plan = states.join(_entered(states), "chunk").drop("conv_id")
        plans.append(several.drop("symbols").join(plan, "chunk").withColumn("alone", F.lit(False)))
    names = [*CHUNKS.names, "end", "last", "entry", "alone"]
    planned = plans[0].select(*names)
    for other in plans[1:]:
        planned = planned.unionByName(other.select(*names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.to_pylist()
            left = costs([r["symbols"] for r in rows], np.array([r["end"] for r in rows]).reshape(-1, 4)).transpose(1, 0, 2).tolist()
            for row, whole in zip(rows, left):
                row["audit"], row["cost"], _ = traced(row["symbols"], whole, row["entry"], row["last"])
                row["roles"], row["texts"] = repaired(row["audit"], row["roles"], row["texts"], row["entry"])
            yield batch_of([tuple(r[c] for c in PIECES.names) for r in rows], PIECES)

    return planned.mapInArrow(run, PIECES_SQL)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ``conv_id``, ``chunk``, ``place`` in it, ``role``, ``text``."""
    both = F.arrays_zip("roles", "texts")
    turns = pieces.select("conv_id", "chunk", F.posexplode(both).alias("place", "turn"))
    return turns.select("conv_id", "chunk", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


COUNTS = "gaps blank duplicate truncated illegal cost".split()
DIGESTS = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
DIGESTS_SQL = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"


def _summed(conversations) -> Iterator[pa.RecordBatch]:
    ready = []
    for conv_id, own in conversations:
        faults, illegal, cost, audit, whole, any_turn = [0] * 4, 0, 0, [], hashlib.sha256(), False
        first = latest = before = None
        n_turns = 0
        for _, turn_min, turn_max, n, steps, letters, paid, roles, texts in own:
            for step in steps:
                faults[step >> 2] += 1
                illegal += before is not None and (before, step & 3) not in LEGAL
                before = step & 3
            if turn_min is not None:
                n_turns += n - (turn_min == latest)
                first, latest = turn_min if first is None else first, turn_max
            audit.append(letters)
            cost += paid
            for role, text in zip(roles, texts):
                whole.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                any_turn = True
        gaps = 0 if first is None else latest - first + 1 - n_turns
        ready.append((conv_id, gaps, *faults[1:], illegal, cost, "".join(audit), whole.hexdigest()))
        if len(ready) > 1 << 12:
            yield batch_of(ready, DIGESTS)
            ready = []
    yield batch_of(ready, DIGESTS)


def summaries(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, the edits, their cost, and a digest of the repaired turns."""
    names = ["turn_min", "turn_max", "n_turns", "symbols", "audit", "cost", "roles", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", *names)))
            yield from _summed((row[0], [row]) for row in rows)

    alone = pieces.filter("alone").select("conv_id", *names).mapInArrow(run, DIGESTS_SQL)
    return alone.unionByName(_by_conversation(pieces.filter("NOT alone"), F.col("chunk"), names, _summed, DIGESTS_SQL))


def digests(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """``summaries`` of the damaged conversations, with a row for those that lost all their turns."""
    found = summaries(repair(damaged(conversations), size))
    every = conversations.select("conv_id").distinct()
    zero, empty = F.lit(0).cast("bigint"), F.sha2(F.lit(""), 256)
    return every.join(found, _same(every, found, "conv_id"), "left").select(
        every["conv_id"],
        *(F.coalesce(found[c], zero).alias(c) for c in COUNTS),
        F.coalesce(found["audit"], F.lit("")).alias("audit"),
        F.coalesce(found["repaired_sha256"], empty).alias("repaired_sha256"),
    )
