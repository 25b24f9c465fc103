"""Finding the faults of conversations, and the cheapest edits that make their roles alternate again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain, groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
NEVER = 1 << 60
#: What has been put out so far: nothing, a system turn, or it ends in a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that a turn put in or given another role gets, by what stands before it.
NEXT = (USER, USER, ASSISTANT, USER)
DONE = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
OUT_BYTES = 1 << 20


class Turn(NamedTuple):
    """What the search needs of a turn."""

    initial: str
    must_go: bool
    unfinished: bool


def moves(turn: Turn | None, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, state after it, turns consumed) in order of the edits' letters. ``turn`` is None behind the last."""
    if turn is not None:
        yield "D", DELETE, state, 1
    yield "I", INSERT, NEXT[state], 0
    if turn is None or turn.must_go:
        return
    more = UNFINISHED if turn.unfinished else 0
    kept = {"s": SYSTEM if state == START else None, "u": USER, "a": ASSISTANT}.get(turn.initial)
    if kept == SYSTEM or (kept is not None and kept == NEXT[state]):
        yield "K", KEEP + more, kept, 1
    yield "R", REROLE + more, NEXT[state], 1


def suffix_bounds(turns: Sequence[Turn]) -> list[list[int]]:
    """What the turns from each place on cost at least, by state: the cheapest edits if the conversation might end
    anywhere. At most two insertions short of the truth, so few places are searched more than a few times."""
    bounds = [[0] * 4]
    for turn in reversed(turns):
        after = bounds[-1]
        here = [min((cost + after[to] for _, cost, to, used in moves(turn, state) if used), default=NEVER) for state in range(4)]
        for _ in range(2):  # an insertion may need another behind it
            here = [min(here[state], INSERT + here[NEXT[state]]) for state in range(4)]
        bounds.append(here)
    bounds.reverse()
    return bounds


def first_dive(turns: Sequence[Turn], bounds: list[list[int]]) -> int:
    """The cost of some whole repair: always on by the edit that promises most."""
    place, state, cost = 0, START, 0
    while place < len(turns) or state not in DONE:
        turn = turns[place] if place < len(turns) else None
        _, step, state, used = min(moves(turn, state), key=lambda move: move[1] + bounds[place + move[3]][move[2]])
        place, cost = place + used, cost + step
    return cost


def cheapest_edits(turns: Sequence[Turn]) -> tuple[int, str]:
    """The least cost of edits that leave role initials ``(s?(ua)+)?``, and the ASCII-least of their letters.

    Depth-first branch and bound over (place, state) with a stack of its own. Edits are tried in order of their letters, so
    paths come in order of their audits: of two that reach a node, the later one is no better unless it is cheaper. A node's
    table entry is the least cost it was reached with, and what costs as much is dominated. A path ends where its cost
    and the suffix bound exceed the incumbent, or equal it once the incumbent is a path met earlier in this order. The
    stack is empty when the incumbent is proved the best."""
    bounds = suffix_bounds(turns)
    best, audit = first_dive(turns, bounds), None
    reached = [[NEVER] * 4 for _ in range(len(turns) + 1)]
    path = bytearray()
    stack = [(0, START, 0, 0, b"")]
    while stack:
        place, state, cost, depth, edit = stack.pop()
        del path[depth:]
        path += edit
        least = cost + bounds[place][state]
        if cost >= reached[place][state] or least > best or (least == best and audit is not None):
            continue
        reached[place][state] = cost
        if place == len(turns) and state in DONE:
            best, audit = cost, path.decode()
            continue
        turn = turns[place] if place < len(turns) else None
        ahead = [(place + used, to, cost + step, len(path), letter.encode()) for letter, step, to, used in moves(turn, state)]
        stack += reversed(ahead)
    return best, audit or ""


def apply_edits(turns: Sequence[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """(role, text) of the conversation after the edits."""
    done, state, place = [], START, 0
    for edit in audit:
        if edit in "IR":
            state = NEXT[state]
            done.append((ROLES[state], "" if edit == "I" else turns[place][1]))
        elif edit == "K":
            done.append(turns[place])
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[turns[place][0][:1]]
        place += edit != "I"
    return done


class Repair(NamedTuple):
    gaps: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str
    repaired: list[tuple[str, str]]


def repair(turns: Sequence[tuple[str, str]], numbers: Sequence[int | None]) -> Repair:
    """Faults and cheapest repair of one conversation: (role, text) in order, and the turn numbers."""
    known = {n for n in numbers if n is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    seen: set[tuple[str, str]] = set()
    blank = duplicate = truncated = 0
    judged = []
    for role, text in turns:
        said = text.strip(BLANKS)
        is_blank, again = not said, (role, text) in seen
        unfinished = not is_blank and not again and said[-1] not in ENDS
        blank, duplicate, truncated = blank + is_blank, duplicate + (again and not is_blank), truncated + unfinished
        judged.append(Turn(role[:1], is_blank or again, unfinished))
        seen.add((role, text))
    illegal = sum(a.initial + b.initial not in LEGAL for a, b in zip(judged, judged[1:]))
    cost, audit = cheapest_edits(judged)
    return Repair(gaps, blank, duplicate, truncated, illegal, cost, audit, apply_edits(turns, audit))


SAID = T.StructType([T.StructField("role", T.StringType(), False), T.StructField("text", T.StringType(), False)])
FOUND = [*[T.StructField(name, T.LongType()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
         T.StructField("audit", T.StringType()), T.StructField("repaired", T.ArrayType(SAID, False))]


def repair_conversations(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
                         text_column: str = "text", present: Column | None = None) -> DataFrame:
    """One row per value of ``conv_column`` (null is one too): gaps in the turn numbers; how many turns are blank, repeat
    an earlier one, or break off; pairs of neighbours whose roles do not follow each other; cost and ``audit`` of the
    cheapest edits (K keep, R give the role that is due, D delete, I insert), and ``repaired``, the turns after them.

    Turns stand in order of ``turn_column``, nulls first, equal numbers in order of role and text. Null roles and texts
    count as one space, malformed UTF-8 as U+FFFD. Rows where ``present`` does not hold do not take part, but their
    conversation has its row, with zeros, an empty audit and no turns if none is left. An empty table gives no row; other
    columns are left out, whatever their names. Edits leave role initials ``(s?(ua)+)?``.

    One shuffle and a sort; tasks read their conversations one after the other from the sorted rows, so the room a task
    needs is that of its longest conversation, and a hot text or role changes nothing. The repair of one conversation is
    the work of one task, in time and room proportional to its length."""
    def filled(column: str) -> Column:
        return F.make_valid_utf8(F.coalesce(F.col(column).cast("string"), F.lit(" ")))

    sent = rows.select(
        F.col(conv_column).alias("conv"), F.col(turn_column).cast("long").alias("turn"), filled(role_column).alias("role"),
        filled(text_column).alias("text"), F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"))
    ordered = sent.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    schema = T.StructType([T.StructField(conv_column, sent.schema["conv"].dataType), *FOUND])

    def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)

    said = pa.list_(pa.struct([pa.field("role", pa.string(), False), pa.field("text", pa.string(), False)]))

    def batch_of(convs: list, found: list[Repair], kind: pa.DataType) -> pa.RecordBatch:
        *numbers, audits, repaired = zip(*found, strict=True)
        turns = [[{"role": role, "text": text} for role, text in each] for each in repaired]
        return pa.RecordBatch.from_arrays([
            pa.array(convs, kind), *[pa.array(column, pa.int64()) for column in numbers], pa.array(audits, pa.string()),
            pa.array(turns, said)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kind = first.schema.field(0).type
        convs, found, held = [], [], 0
        for conv, group in groupby(each_row(chain([first], batches)), key=itemgetter(0)):
            kept = [row for row in group if row[4]]
            convs.append(conv)
            found.append(repair([(role, text) for _, _, role, text, _ in kept], [row[1] for row in kept]))
            held += 256 + sum(len(row[3]) for row in kept)
            if held > OUT_BYTES:
                yield batch_of(convs, found, kind)
                convs, found, held = [], [], 0
        if convs:
            yield batch_of(convs, found, kind)

    return ordered.mapInArrow(run, schema)
