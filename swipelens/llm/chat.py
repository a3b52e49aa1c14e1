"""Chat formatting with minimum-cost repair of the roles.

A legal conversation is an optional system turn, then user and assistant in turn, from a user
to an assistant. Each turn is kept, relabelled, or merged into the turn before it, and empty
turns are inserted, so that the sequence is legal at the smallest total cost; of equal costs
in a run, the plan whose first move is cheaper is taken, and of equal moves that which merges.

The state between turns is the role of the last turn. What a run of turns does to the states
is a small matrix of costs, and matrices of neighbouring runs combine by minimum and sum. So a
conversation is cut into runs of ``RUN_TURNS``; matrices are made run by run, folded along the
runs of a conversation to find the state in which each run begins, and each run is then repaired
on its own. No task holds more than one run, however long a conversation is; the folding passes
one row of sixteen numbers per run through the task of the conversation.

The result has one row per run: ``text`` is the rendered run and the parts of a conversation,
joined in order, are the conversation. A conversation up to ``RUN_TURNS`` turns is one row.

Edge cases: turns are ordered by ``turn`` (null last), then role and text; repeated rows are
turns of their own. A null text is empty. Roles are compared in lower case and by common other
names; an unknown or null role can only be relabelled. Turns without a conversation id form one
conversation, with a null id. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import ship, whole
from swipelens.operators.ordering import POSITION, with_position
from swipelens.session import materialize

ROLES = ("system", "user", "assistant")
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
START = 3
STATES = 4
#: Roles that may follow each state, and the states in which a conversation may end.
LEGAL = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
FINAL = (2,)
MERGE, RELABEL, INSERT = 1, 2, 3
FAR = 1 << 40

RUN_TURNS = 512
#: Runs per batch that a task hands on.
BATCH_ROWS = 512
NO_ID = "none"
TEMPLATE = "<|{role}|>\n{text}\n<|end|>\n"
_HEAD, _TAIL = TEMPLATE.split("{text}")
RESULT = (
    "conv_id BIGINT, part BIGINT, text STRING, n_turns BIGINT, n_rendered BIGINT, n_merged BIGINT, "
    "n_relabelled BIGINT, n_inserted BIGINT, cost BIGINT"
)


def role_number(role: str | None) -> int:
    """Index of the role, or -1."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else -1


@cache
def insertions(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty turns after ``state`` that make ``role`` legal."""
    queue, seen = [(state, ())], {state}
    for at, path in queue:
        if role in LEGAL[at]:
            return path
        for step in LEGAL[at]:
            if step not in seen:
                seen.add(step)
                queue.append((step, (*path, step)))
    return None


@cache
def moves(state: int, role: int) -> tuple[tuple[int, int, bool, tuple[int, ...]], ...]:
    """(cost, next state, merged, inserted) of a turn with this role, the preferred first."""
    found = []
    for label in sorted(range(3), key=lambda x: x != role):
        relabel = RELABEL * (label != role)
        if label == state:
            found.append((relabel + MERGE, label, True, ()))
        path = insertions(state, label)
        if path is not None:
            found.append((relabel + INSERT * len(path), label, False, path))
    return tuple(sorted(found, key=lambda m: (m[0], not m[2], m[1] != role)))


@cache
def closing(state: int) -> tuple[int, ...]:
    """The fewest empty turns that end a conversation; an empty conversation needs none."""
    if state == START or state in FINAL:
        return ()
    return min(((*p, f) for f in FINAL if (p := insertions(state, f)) is not None), key=len)


Matrix = tuple[tuple[int, ...], ...]
IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in range(STATES)) for i in range(STATES))


def combine(a: Matrix, b: Matrix) -> Matrix:
    """Costs of one run and then another: minimum over the state in between."""
    columns = list(zip(*b))
    return tuple(tuple(min(FAR, min(x + y for x, y in zip(row, column))) for column in columns) for row in a)


@cache
def turn_matrix(role: int) -> Matrix:
    rows = []
    for state in range(STATES):
        row = [FAR] * STATES
        for cost, to, _, _ in moves(state, role):
            row[to] = min(row[to], cost)
        rows.append(tuple(row))
    return tuple(rows)


def run_matrix(roles: list[int]) -> Matrix:
    found = IDENTITY
    for role in roles:
        found = combine(found, turn_matrix(role))
    return found


def plan(roles: list[int], state: int, end: int) -> list[tuple[int, int, bool, tuple[int, ...]]]:
    """The cheapest moves from ``state`` to ``end``, and of these the first in the order of ``moves``."""
    rest = [[FAR] * STATES for _ in range(len(roles) + 1)]
    rest[-1][end] = 0
    for i in range(len(roles) - 1, -1, -1):
        for s in range(STATES):
            rest[i][s] = min((m[0] + rest[i + 1][m[1]] for m in moves(s, roles[i])), default=FAR)
    chosen = []
    for i, role in enumerate(roles):
        move = next(m for m in moves(state, role) if m[0] + rest[i + 1][m[1]] == rest[i][state])
        chosen.append(move)
        state = move[1]
    return chosen


def render(texts: list[str], chosen: list[tuple[int, int, bool, tuple[int, ...]]], state: int, last: bool) -> str:
    """The text of a run that begins after ``state``. A turn is closed by what follows it."""
    out, is_open = [], state != START
    for text, (_, role, merged, inserted) in zip(texts, chosen):
        if merged:
            out.append("\n" + text)
            continue
        if is_open:
            out.append(_TAIL)
        out += [_HEAD.format(role=ROLES[r]) + _TAIL for r in inserted]
        out.append(_HEAD.format(role=ROLES[role]) + text)
        is_open = True
    if last:
        end = chosen[-1][1] if chosen else state
        out.append(_TAIL if end != START else "")
        out += [_HEAD.format(role=ROLES[r]) + _TAIL for r in closing(end)]
    return "".join(out)


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[list]:
    """The rows of one run after the other, from rows that are sorted by run."""
    key, held = None, []
    for frame in frames:
        for row in frame.itertuples(index=False):
            if (row.conv, row.part) != key:
                if held:
                    yield held
                key, held = (row.conv, row.part), []
            held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    for some in batched(rows, BATCH_ROWS):
        yield pd.DataFrame(some, columns=columns)


def _matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per run: its cost matrix, row by row."""
    def of(run: list) -> tuple:
        matrix = run_matrix([role_number(r.role) for r in run])
        return run[0].conv, run[0].part, [c for row in matrix for c in row]

    yield from _batched(map(of, _runs(frames)), ["conv", "part", "m"])


def _states(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Along the runs of each conversation: costs so far, of each state, before each run."""
    conv, costs = None, None
    for frame in frames:
        out = []
        for c, part, flat in zip(frame["conv"], frame["part"], frame["m"]):
            if c != conv:
                conv, costs = c, [0 if s == START else FAR for s in range(STATES)]
            out.append((c, part, flat, list(costs)))
            matrix = [flat[i * STATES:(i + 1) * STATES] for i in range(STATES)]
            costs = [min(FAR, min(int(a) + int(row[t]) for a, row in zip(costs, matrix))) for t in range(STATES)]
        yield pd.DataFrame(out, columns=["conv", "part", "m", "before"])


def _ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Backwards along the runs: the state before and after each run on a cheapest way."""
    conv, end = None, START
    for frame in frames:
        out = []
        for c, part, before, flat in zip(*(frame[x] for x in ("conv", "part", "before", "m"))):
            before, matrix = [int(x) for x in before], [[int(x) for x in flat[i * STATES:(i + 1) * STATES]] for i in range(STATES)]
            is_last = c != conv
            if is_last:
                after = [min(a + row[t] for a, row in zip(before, matrix)) for t in range(STATES)]
                conv, end = c, min(range(STATES), key=lambda t: (after[t] + INSERT * len(closing(t)), t not in FINAL))
            begin = min(range(STATES), key=lambda s: before[s] + matrix[s][end])
            out.append((c, part, begin, end, is_last))
            end = begin
        yield pd.DataFrame(out, columns=["conv", "part", "begin", "end", "last"])


def _repaired(run: list) -> tuple:
    """One rendered run between its two states, and what was done to it."""
    first = run[0]
    begin, end, last = int(first.begin), int(first.end), bool(first.last)
    roles = [role_number(r.role) for r in run]
    chosen = plan(roles, begin, end)
    ending = len(closing(end)) if last else 0
    inserted = sum(len(m[3]) for m in chosen) + ending
    merged = sum(m[2] for m in chosen)
    relabelled = sum(m[1] != r for m, r in zip(chosen, roles))
    cost = sum(m[0] for m in chosen) + INSERT * ending
    return (
        first.conv, int(first.part), render([r.text for r in run], chosen, begin, last), len(run),
        len(run) - merged + inserted, merged, relabelled, inserted, cost,
    )


def _repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield from _batched(map(_repaired, _runs(frames)), [c.split()[0] for c in RESULT.split(", ")])


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    run_turns: int = RUN_TURNS,
) -> DataFrame:
    """One row per run of at most ``run_turns`` turns, rendered; see the module.

    Turns are numbered by one range-partitioned sort over (conversation, turn), so that a
    conversation that holds much of the table is spread over many partitions.
    """
    ship(turns.sparkSession)
    # Named by text, so that no id is rounded in pandas and null is a conversation as well.
    rows = turns.select(
        F.coalesce(F.col(conv).cast("bigint").cast("string"), F.lit(NO_ID)).alias("conv"),
        F.col(conv).isNull().alias("no_id"), F.col(conv).cast("bigint").alias("id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), whole(text).alias("text"),
    )
    order = [F.col("no_id"), F.col("id"), F.col("turn").isNull(), F.col("turn"), F.col("role"), F.xxhash64("text")]
    placed = with_position(rows, *order)
    starts = placed.groupBy("conv").agg(F.min(POSITION).alias("_first"))
    at = F.col(POSITION) - F.col("_first")
    cut = materialize(
        placed.join(starts, "conv").select("conv", F.floor(at / run_turns).cast("bigint").alias("part"), at.alias("at"), "role", "text")
    )

    def by(frame: DataFrame, *key: str, then) -> DataFrame:
        return frame.repartition(*key).sortWithinPartitions(*key, then)

    run = ("conv", "part")
    matrices = materialize(
        by(cut.select(*run, "at", "role"), *run, then="at").mapInPandas(_matrices, "conv STRING, part BIGINT, m ARRAY<BIGINT>")
    )
    # One row per run from here on: a conversation's runs are folded in order, and then back.
    states = by(matrices, "conv", then="part").mapInPandas(_states, "conv STRING, part BIGINT, m ARRAY<BIGINT>, before ARRAY<BIGINT>")
    bounds = materialize(
        by(materialize(states), "conv", then=F.col("part").desc())
        .mapInPandas(_ends, "conv STRING, part BIGINT, begin INT, end INT, last BOOLEAN")
    )
    ready = by(cut.join(bounds, ["conv", "part"]), *run, then="at")
    done = ready.mapInPandas(_repair, RESULT.replace("conv_id BIGINT", "conv_id STRING"))
    return done.withColumn("conv_id", F.nullif("conv_id", F.lit(NO_ID)).cast("bigint"))
