"""Cheapest repair of conversations by Knuth's lightest-derivation agenda.

A repaired conversation's roles begin with s?, and then u and a alternate, an
answer last; it may be empty.  An edit keeps a row, gives it another role,
deletes it, or inserts an empty one.  The deduction system has an item (i, q) for
"rows i and later can be finished from state q", and hyperedges that join such an
item with an edit of the row before it.  An edit stands to the *left* of what it
extends, so comparing (cost, audit) is monotone; a kept row costs nothing, so the
number of rows finished stands between the two and makes every step superior.
Items are popped from a heap in that order until the goal item is final.  Audits
are never compared letter by letter: among items of equal cost and rows, the order
in which they became final is the order of their audits.

On a cluster:

1. Faults are JVM expressions.  Texts that come back at a later turn are found by
   partial sums over (conversation, role, text), not by collecting conversations.
2. Rows are range partitioned and sorted by conversation and turn, so a huge
   conversation lies in many tasks, and cut into blocks of at most ``BLOCK`` rows.
   A block's faults and role initials are one short string, its signature.
3. A block that is a conversation is solved by itself.  Other blocks are solved for
   every state before and after them, and a conversation's blocks are folded from
   the last to the first.  Two edit sequences of one block with equal cost differ
   before either ends, since both consume all its rows and end with a row's edit;
   so folding by block gives the same least audit.
4. Edits join their rows again by block, so repaired rows are as distributed as
   the rows were.

Nulls and odd input: a null role or text is one space.  Rows are taken by turn
(nulls first), then role, then text, so equal rows are neighbours and the later
ones are duplicates.  A null conversation id is an id.  An empty role is no role
of the grammar and never kept.  Other columns play no part.  An empty table gives
empty results.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.scratch import materialize

#: Costs of the edits, and of leaving a truncated row in the conversation.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: Most rows of a block, and signatures whose repair a task remembers.
BLOCK, REMEMBERED = 256, 20_000
#: The characters that separate words, and those that end a sentence.
SPACE, STOPS = " \t\n\x0b\x0c\r", ".!?"

#: Faults of a row, and role initials, in the order of their codes.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua?"
#: What the repaired rows so far end with, and what a next initial makes of it.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
BEFORE = {q: [(p, c) for (p, c), r in NEXT.items() if r == q] for q in range(4)}
ACCEPTING = (START, ASSISTANT)
#: Letters of a plan: K and D, the role given (u, a), the role inserted (U, A); and their audit letters.
TO_AUDIT = str.maketrans("uaUA", "RRII")
LAWFUL = {"su", "ua", "au"}


def code(initial: int, fault: int) -> str:
    return chr(ord("a") + 4 * initial + fault)


def decoded(signature: str) -> list[tuple[str, int]]:
    return [(INITIALS[(ord(c) - 97) // 4], (ord(c) - 97) % 4) for c in signature]


def derivations(signature: str, exits: tuple[int, ...], goals: tuple[int, ...], last: bool) -> dict[int, tuple[int, str]]:
    """Cost and plan of the lightest derivation of each goal state before the rows.

    ``exits`` are the states that may follow the rows.  Only after the ``last`` row
    of a conversation may rows be inserted behind it; elsewhere the next block does.
    """
    rows = decoded(signature)
    final: dict[tuple[int, int], tuple[int, int, str, tuple[int, int] | None]] = {}
    agenda = [(0, 0, "", rank, state, "", None) for rank, state in enumerate(exits)]
    wanted = {(len(rows), goal) for goal in goals}
    while agenda and wanted:
        cost, done, _, _, state, step, tail = heapq.heappop(agenda)
        item = (done, state)
        if item in final:
            continue
        rank = len(final)
        final[item] = (cost, rank, step, tail)
        wanted.discard(item)
        if done or last:
            for before, role in BEFORE[state]:
                if role != "s":
                    heapq.heappush(agenda, (cost + INSERT, done, "I", rank, before, role.upper(), item))
        if done == len(rows):
            continue
        initial, fault = rows[len(rows) - 1 - done]
        heapq.heappush(agenda, (cost + DELETE, done + 1, "D", rank, state, "D", item))
        if fault in (BLANK, DUPLICATE):
            continue
        left = CUT_OFF if fault == TRUNCATED else 0
        for before, role in BEFORE[state]:
            if role == initial:
                heapq.heappush(agenda, (cost + KEEP + left, done + 1, "K", rank, before, "K", item))
            elif role != "s":
                heapq.heappush(agenda, (cost + REROLE + left, done + 1, "R", rank, before, role, item))

    found = {}
    for goal in goals:
        at, plan = (len(rows), goal), []
        while at in final and final[at][3] is not None:
            plan.append(final[at][2])
            at = final[at][3]
        if (len(rows), goal) in final:
            found[goal] = final[len(rows), goal][0], "".join(plan)
    return found


@lru_cache(REMEMBERED)
def repaired(signature: str) -> tuple[int, str]:
    """Cost and plan of a whole conversation."""
    return derivations(signature, ACCEPTING, (START,), True)[START]


def block_table(signature: str) -> list[dict]:
    """Cost and plan between every two states around a block; exit -1 is a lawful end."""
    runs = [(r, derivations(signature, (r,), (START, SYSTEM, USER, ASSISTANT), False)) for r in range(4)]
    runs.append((-1, derivations(signature, ACCEPTING, (START, SYSTEM, USER, ASSISTANT), True)))
    return [{"p": p, "r": r, "cost": cost, "plan": plan} for r, found in runs for p, (cost, plan) in found.items()]


def folded(tables: list[list[dict]]) -> tuple[int, list[str]]:
    """Cost and plans of a conversation's blocks, from their tables in order."""
    best: dict[int, int] = {-1: 0}
    choices: list[dict[int, dict]] = []
    for number, table in enumerate(reversed(tables)):
        options: dict[int, list] = {}
        for entry in table:
            if (entry["r"] == -1) == (number == 0) and entry["r"] in best:
                options.setdefault(entry["p"], []).append((entry["cost"] + best[entry["r"]], entry["plan"].translate(TO_AUDIT), entry["r"], entry))
        chosen = {p: min(found, key=lambda o: o[:3]) for p, found in options.items()}
        best = {p: option[0] for p, option in chosen.items()}
        choices.append({p: option[3] for p, option in chosen.items()})
    state, plans = START, []
    for chosen in reversed(choices):
        plans.append(chosen[state]["plan"])
        state = chosen[state]["r"]
    return best[START], plans


def counts(signature: str, before: str = "") -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows and unlawful neighbours; ``before`` is the initial before the rows."""
    rows = decoded(signature)
    initials = before + "".join(initial for initial, _ in rows)
    faults = [fault for _, fault in rows]
    unlawful = sum(initials[i : i + 2] not in LAWFUL for i in range(len(initials) - 1))
    return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), unlawful


def _changed(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it; nulls are equal."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _begins(table: pa.Table, names: list[str]) -> np.ndarray:
    """True where a run of equal values of ``names`` begins."""
    new = np.ones(table.num_rows, bool)
    if table.num_rows:
        new[1:] = np.logical_or.reduce([_changed(table.column(name).combine_chunks()) for name in names])
    return new


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their block and place; a block's last row carries its signature.

    A block is held back until a row of another one follows; no more is held.  The
    first and the last conversation of a task may go on in another, so their
    blocks are never taken for whole conversations.
    """
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    held: pa.Table | None = None
    before: pa.Table | None = None  # the last row seen, its run and its place
    run = place = -1

    def numbered(fresh: pa.Table) -> pa.Table:
        nonlocal before, run, place
        known = fresh if before is None else pa.concat_tables([before, fresh])
        skip = known.num_rows - fresh.num_rows
        new, other = (_begins(known, names)[skip:] for names in (["conv"], ["conv", "turn", "role", "text"]))
        runs = run + np.cumsum(new)
        index = np.arange(fresh.num_rows)
        places = index - np.maximum.accumulate(np.where(new, index, -1))
        first = int(np.argmax(new)) if new.any() else len(new)
        places[:first] = place + 1 + index[:first]
        fault = fresh.column("fault").to_numpy()
        fault = np.where(~other & (fault != BLANK), DUPLICATE, fault)
        codes = (ord("a") + 4 * fresh.column("initial").to_numpy() + fault).astype(np.uint8)
        before, run, place = fresh.slice(fresh.num_rows - 1), int(runs[-1]), int(places[-1])
        fresh = fresh.select(["conv", "turn", "role", "text"]).append_column("run", pa.array(runs.astype(np.int64)))
        return fresh.append_column("place", pa.array(places.astype(np.int64))).append_column("code", pa.array(codes))

    def written(rows: pa.Table, end: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
        runs, places = rows.column("run").to_numpy(), rows.column("place").to_numpy()
        codes = rows.column("code").to_numpy().tobytes()
        starts = np.flatnonzero((places % BLOCK == 0) | (np.arange(len(places)) == 0))
        stops = np.append(starts[1:], len(places))
        n = len(places) if end else int(starts[-1])
        signatures, whole = [None] * n, np.zeros(n, bool)
        for start, stop in zip(starts.tolist(), stops.tolist()):
            if stop <= n:
                signatures[stop - 1] = codes[start:stop].decode("ascii")
                whole[stop - 1] = runs[start] > 0 and places[start] == 0 and stop < len(runs) and runs[stop] != runs[start]
        out = rows.slice(0, n).select(["conv", "turn", "role", "text"]).append_column("part", pa.array(np.full(n, part, np.int32)))
        out = out.append_column("run", pa.array(runs[:n])).append_column("block", pa.array(places[:n] // BLOCK))
        out = out.append_column("seq", pa.array((places[:n] % BLOCK + 1).astype(np.int32)))
        out = out.append_column("signature", pa.array(signatures, pa.string())).append_column("whole", pa.array(whole))
        return out.combine_chunks().to_batches(), rows.slice(n)

    for batch in batches:
        if batch.num_rows:
            rows = numbered(pa.Table.from_batches([batch]))
            rows = rows if held is None else pa.concat_tables([held, rows])
            out, held = written(rows.combine_chunks(), False)
            yield from out
    if held is not None:
        yield from written(held.combine_chunks(), True)[0]


_TABLE = "array<struct<p int, r int, cost long, plan string>>"


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plans of whole conversations, tables of other blocks."""
    entry = pa.list_(pa.struct([("p", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("plan", pa.string())]))
    for batch in batches:
        costs, plans, tables = [], [], []
        for signature, whole in zip(batch.column("signature").to_pylist(), batch.column("whole").to_pylist()):
            cost, plan = repaired(signature) if whole else (None, None)
            costs.append(cost)
            plans.append(plan)
            tables.append(None if whole else block_table(signature))
        found = [batch.column(name) for name in ("conv", "part", "run", "block", "signature")]
        found += [pa.array(costs, pa.int64()), pa.array(plans, pa.string()), pa.array(tables, entry)]
        yield pa.RecordBatch.from_arrays(found, ["conv", "part", "run", "block", "signature", "cost", "plan", "table"])


def _folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for conversations of several blocks; a conversation's cost stands at its first block."""

    def fold(rows: list[dict]) -> pa.RecordBatch:
        cost, plans = folded([row["table"] for row in rows])
        for number, (row, plan) in enumerate(zip(rows, plans)):
            before = decoded(rows[number - 1]["signature"][-1])[0][0] if number else ""
            row |= {"plan": plan, "cost": 0 if number else cost, "before": before}
            del row["table"]
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = None
    held: list[dict] = []
    for batch in batches:
        if schema is None:
            kinds = [batch.schema.field(name) for name in ("conv", "part", "run", "block", "signature")]
            schema = pa.schema([*kinds, ("cost", pa.int64()), ("plan", pa.string()), ("before", pa.string())])
        for row in batch.to_pylist():
            if held and row["conv"] != held[0]["conv"]:
                yield fold(held)
                held = []
            held.append({name: row[name] for name in ("conv", "part", "run", "block", "signature", "table")})
    if held:
        yield fold(held)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's audit and fault counts."""
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("signature", "before", "plan")]
        rows = [(*counts(signature, before), plan.translate(TO_AUDIT)) for signature, before, plan in zip(*columns)]
        numbers = [pa.array([row[i] for row in rows], pa.int64()) for i in range(4)]
        kept = [batch.column(name) for name in ("conv", "part", "block", "cost")]
        yield pa.RecordBatch.from_arrays([*kept, *numbers, pa.array([row[4] for row in rows], pa.string())], ["conv", "part", "block", "cost", "blank", "duplicate", "truncated", "illegal", "audit"])


def _fault(text: Column) -> Column:
    """Blank, truncated or sound, by the text alone."""
    words = F.rtrim(text, F.lit(SPACE))
    ended = F.substring(words, -1, 1).isin(*STOPS)
    return F.when(words == "", BLANK).when(ended, SOUND).otherwise(TRUNCATED)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """What was wrong with each conversation and what mended it, and the repaired rows.

    The first frame has conv, gaps, blank, duplicate, truncated, illegal, cost and
    audit; the second conv, role, text, and part, block, seq, step, which order the rows of a conversation.
    """
    kind = rows.schema[conv].dataType.simpleString()
    turns = rows.schema[turn].dataType.simpleString()
    space = F.lit(" ")
    faults = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text")
    ).withColumn("fault", _fault(F.col("text")))
    faults = faults.withColumn("initial", F.expr("CASE substring(role, 1, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END"))

    # Texts that come back at a later turn: only those need a join.
    place, digest = F.struct(F.col("turn").isNotNull(), "turn"), F.sha2("text", 256)
    spans = faults.where(F.col("fault") != BLANK).groupBy("conv", "role", digest.alias("digest")).agg(F.min(place).alias("low"), F.max(place).alias("high"))
    back = materialize(spans.where("low < high").select(F.col("conv").alias("_conv"), F.col("role").alias("_role"), "digest", "low"), "returning")
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (digest == F.col("digest"))
    later = (F.col("fault") != BLANK) & F.col("low").isNotNull() & (F.col("low") < place)
    faults = faults.join(back, same, "left").withColumn("fault", F.when(later, DUPLICATE).otherwise(F.col("fault")))

    order = [F.col(name).asc_nulls_first() for name in ("conv", "turn", "role", "text")]
    ranged = faults.select("conv", "turn", "role", "text", "fault", "initial").repartitionByRange(*order).sortWithinPartitions(*order)
    named = f"conv {kind}, turn {turns}, role string, text string, part int, run long, block long, seq int, signature string, whole boolean"
    stored = materialize(ranged.mapInArrow(_blocks, named), "conversation-rows")

    blocks = stored.where("signature IS NOT NULL").select("conv", "part", "run", "block", "signature", "whole")
    solved = f"conv {kind}, part int, run long, block long, signature string, cost long, plan string"
    solutions = materialize(blocks.mapInArrow(_solved, f"{solved}, table {_TABLE}"), "conversation-plans")
    alone = solutions.where("plan IS NOT NULL").drop("table").withColumn("before", F.lit(""))
    parts = solutions.where("plan IS NULL").repartition("conv").sortWithinPartitions("conv", "part", "run", "block")
    plans = materialize(alone.union(parts.mapInArrow(_folds, f"{solved}, before string")), "conversation-edits")

    each = plans.mapInArrow(_counted, f"conv {kind}, part int, block long, cost long, blank long, duplicate long, truncated long, illegal long, audit string")
    audits = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "block", "audit"))), lambda b: b["audit"]), "")
    sums = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    found = each.groupBy("conv").agg(*sums, audits.alias("audit"))
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = stored.groupBy(F.col("conv").alias("_conv")).agg(F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"))
    summary = found.join(gaps, F.col("conv").eqNullSafe(F.col("_conv"))).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = plans.select("part", "run", "block", F.length("signature").alias("size"), F.split("plan", "(?<=[KDua])").alias("steps"))
    own = stored.select("conv", "role", "text", "part", "run", "block", "seq").join(edits, ["part", "run", "block"])
    mine = F.expr("array_join(slice(steps, seq, if(seq = size, 2, 1)), '')")
    lines = F.transform(
        F.split(mine, ""),
        lambda c: F.when(c == "K", F.struct("role", "text"))
        .when(c == "u", F.struct(F.lit("user").alias("role"), "text"))
        .when(c == "a", F.struct(F.lit("assistant").alias("role"), "text"))
        .when(c == "U", F.struct(F.lit("user").alias("role"), F.lit("").alias("text")))
        .when(c == "A", F.struct(F.lit("assistant").alias("role"), F.lit("").alias("text"))),
    )
    kept = own.select("conv", "part", "block", "seq", F.posexplode(F.filter(lines, lambda line: line.isNotNull())).alias("step", "line"))
    return summary, kept.select("conv", "line.role", "line.text", "part", "block", "seq", "step")


def digests(repaired_rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the hash of each conversation's ``role:text`` lines.

    A hash is sequential, so a conversation streams through one task, which holds
    a batch of its rows and the hash so far.
    """
    kind = repaired_rows.schema["conv"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current = None, None
        for batch in batches:
            ids, texts = batch.column("conv"), []
            for conv, role, text in zip(ids.to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                line = f"{role}:{text}".encode()
                if state is not None and conv == current:
                    state.update(b"\n" + line)
                    continue
                if state is not None:
                    texts.append((current, state.hexdigest()))
                state, current = hashlib.sha256(line), conv
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in texts], ids.type), pa.array([h for _, h in texts])], ["conv", "repaired_sha256"])
            last = ids.type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], last), pa.array([state.hexdigest()])], ["conv", "repaired_sha256"])

    streamed = repaired_rows.repartition("conv").sortWithinPartitions("conv", "part", "block", "seq", "step")
    return streamed.mapInArrow(hashed, f"conv {kind}, repaired_sha256 string")
