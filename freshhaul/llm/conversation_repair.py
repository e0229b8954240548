"""Cheapest repair of a conversation's turns, by depth-first branch-and-bound.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles, without blank turns
and without repeated ones. Edits, by their letters: Keep costs 0, Rerole (to user or
assistant) 3, Delete 4, Insert (an empty turn of user or assistant) 3. Blank and repeated
turns have to be deleted, a truncated one that stays costs 3 more. Of equal costs the audit,
the letters in order, decides: the least by ASCII.

A node is a number of turns dealt with and a state of the role pattern. The search keeps
its open prefixes on a stack, cheapest edit on top; drops those whose cost and bound of the
rest exceed the best whole repair so far, or tie with it and have a greater audit; and
remembers for each node the best (cost, audit) that reached it. The bound adds what each
turn costs alone and what disjoint pairs of neighbours cost that cannot both stay as they
are. No prefix of a node is the beginning of another one of equal cost, so the better
prefix stays better with any ending, and the search ends with a proven optimum.

Turns are one byte each for the search. Conversations of more than ``BLOCK`` turns are
searched block by block, from each state to each state, and the results composed, which
takes time in proportion to the turns. A task reads a conversation twice in a row from its
sorted rows, first the bytes, then the texts, and so never holds the texts of more than a
batch, however many turns one conversation has.

Nulls: a role or text counts as one space; turns without number come first; rows without
``conv_id`` are one conversation. Rows alike in number are ordered by role and text; of
repeated rows all but the first are duplicates. Texts of any length pass as they are.
Other columns than the four are not read. No rows: no conversations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshhaul.llm.common import SPACES, WORD

#: Turns that are searched together; longer searches would take more time for each turn.
BLOCK = 12
#: Searches whose results a task keeps.
MEMO = 200_000
#: Rows that a task passes on together.
BATCH = 2_000

# States: nothing yet, after s, after u, after a. Initials: s, u, a, others.
INITIALS = "sua"
NEXT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
RENEW = (2, 2, 3, 2)  # the state after a turn of the role that the pattern wants
ROLES = ("", "", "user", "assistant")  # by the state that the turn leads to
ENDS = (0, 3)
LEGAL = {(0, 1), (1, 2), (2, 1)}

# A turn's byte: fault * 4 + initial.
SOUND, DOOMED, TRUNCATED = range(3)
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3

FAULTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
EDITS = (
    "conv_id bigint, seq bigint, edit string, role string, text string, n_turns bigint, "
    f"gaps bigint, {FAULTS}, cost bigint, audit string"
)
_EDITS = pa.schema(
    [
        (name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (x.split(" ") for x in EDITS.split(", "))
    ]
)
SUMMARY = ["n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def least_costs(codes: bytes) -> tuple[list[int], list[int]]:
    """What each turn costs whatever is done, and a lower bound for each suffix."""
    alone = []
    for code in codes:
        fault, initial = divmod(code, 4)
        if fault == DOOMED:
            alone.append(DELETE)
        elif fault == TRUNCATED:
            alone.append(3 if initial < 3 else DELETE)
        else:
            alone.append(KEEP if initial < 3 else REROLE)
    rest = [0] * (len(codes) + 2)
    for i in range(len(codes) - 1, -1, -1):
        rest[i] = alone[i] + rest[i + 1]
        if i + 1 < len(codes):
            a, b = codes[i], codes[i + 1]
            sound = a // 4 != DOOMED and b // 4 != DOOMED and a % 4 < 3 and b % 4 < 3
            if sound and (a % 4, b % 4) not in LEGAL:
                extra = min(REROLE, DELETE - alone[i], DELETE - alone[i + 1])
                rest[i] = max(rest[i], alone[i] + alone[i + 1] + extra + rest[i + 2])
    return alone, rest


def search(codes: bytes, entry: int, exits: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """Least (cost, audit) from state ``entry`` to one of ``exits``; None if there is none.

    Turns are inserted before a turn, and after the last one only with ``last``.
    """
    n = len(codes)
    alone, rest = least_costs(codes)

    def bound(i: int, state: int) -> int:
        if i == n:
            return 0
        code = codes[i]
        if code // 4 == DOOMED or code % 4 == 3 or NEXT[state][code % 4] >= 0:
            return rest[i]
        return max(rest[i], alone[i] + min(REROLE, DELETE - alone[i]) + rest[i + 1])

    best: tuple[int, str] | None = None  # the incumbent
    reached = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if reached[i, state] != (cost, audit):
            continue  # a better prefix came meanwhile
        if best is not None:
            least = cost + bound(i, state)
            if least > best[0] or (least == best[0] and audit > best[1][: len(audit)]):
                continue
        if i == n and state in exits and (best is None or (cost, audit) < best):
            best = (cost, audit)
        children = []
        if i < n:
            fault, initial = divmod(codes[i], 4)
            children.append((DELETE, "D", i + 1, state))
            if fault != DOOMED:
                stays = 3 if fault == TRUNCATED else 0
                children.append((REROLE + stays, "R", i + 1, RENEW[state]))
                if NEXT[state][initial] >= 0:
                    children.append((KEEP + stays, "K", i + 1, NEXT[state][initial]))
        if i < n or last:
            children.append((INSERT, "I", i, RENEW[state]))
        children.sort(reverse=True)
        for more, letter, j, after in children:
            prefix = (cost + more, audit + letter)
            known = reached.get((j, after))
            if known is None or prefix < known:
                reached[j, after] = prefix
                stack.append((j, after, *prefix))
    return best


def cheapest(codes: bytes, block: int = BLOCK, memo: dict | None = None) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation; ``memo`` keeps the searches of a task."""
    memo = {} if memo is None else memo
    if len(memo) > MEMO:
        memo.clear()

    def searched(*of) -> tuple[int, str] | None:
        if of not in memo:
            memo[of] = search(*of)
        return memo[of]

    front = {0: (0, "")}
    at = 0
    while len(codes) - at > block:
        piece = codes[at : at + block]
        after: dict[int, tuple[int, str]] = {}
        for entry, (cost, audit) in front.items():
            for state in range(4):
                found = searched(piece, entry, (state,), False)
                if found is not None:
                    whole = (cost + found[0], audit + found[1])
                    if state not in after or whole < after[state]:
                        after[state] = whole
        front, at = after, at + block
    ends = []
    for entry, (cost, audit) in front.items():
        found = searched(codes[at:], entry, ENDS, True)
        ends.append((cost + found[0], audit + found[1]))
    return min(ends)


class _Conversation:
    """Faults of the turns read so far, then the edits of their second reading."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.codes = bytearray()
        self.faults = [0, 0, 0, 0]
        self.low = self.high = None
        self.numbers = 0
        self.audit: str | None = None

    def note(self, turn: int | None, initial: int, fault: int) -> None:
        """A turn; ``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated."""
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.numbers += turn != self.high
            self.high = turn
        if fault:
            self.faults[fault - 1] += 1
        if self.codes and (self.codes[-1] % 4, initial) not in LEGAL:
            self.faults[3] += 1
        self.codes.append((SOUND, DOOMED, DOOMED, TRUNCATED)[fault] * 4 + initial)

    def head(self, memo: dict) -> tuple:
        cost, self.audit = cheapest(bytes(self.codes), memo=memo)
        self.at = self.row = self.state = self.seq = 0
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers
        return (
            self.conv_id, 0, None, None, None,
            len(self.codes), gaps, *self.faults, cost, self.audit,
        )

    def _edit(self, letter: str, role: str | None, text: str | None) -> tuple:
        self.at += 1
        self.seq += 1
        return self.conv_id, self.seq, letter, role, text, *[None] * 8

    def inserts(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = RENEW[self.state]
            yield self._edit("I", ROLES[self.state], "")

    def edits(self, role: str, text: str) -> Iterator[tuple]:
        """The edit of the next turn, after the inserts that come before it."""
        yield from self.inserts()
        letter = self.audit[self.at]
        if letter == "D":
            yield self._edit("D", None, None)
        elif letter == "R":
            self.state = RENEW[self.state]
            yield self._edit("R", ROLES[self.state], text)
        else:
            self.state = NEXT[self.state][self.codes[self.row] % 4]
            yield self._edit("K", role, text)
        self.row += 1


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = BATCH) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[4] or "") if len(row) > 4 and isinstance(row[4], str) else 0
        if len(held) >= size or chars > 1 << 22:
            yield _batch(held, schema)
            held, chars = [], 0
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edits() -> Iterator[tuple]:
        now, memo = None, {}
        for batch in batches:
            for conv_id, texts, turn, initial, fault, role, text in _rows(batch):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        yield from now.inserts()
                    now = _Conversation(conv_id)
                if not texts:
                    now.note(turn, initial, fault)
                    continue
                if now.audit is None:
                    yield now.head(memo)
                yield from now.edits(role, text)
        if now is not None:
            yield from now.inserts()

    return _batches(edits(), _EDITS)


def repair_edits(conversations: DataFrame) -> DataFrame:
    """The edits of each conversation, in order and next to each other in a partition.

    ``seq`` 0 is a row of its own for the conversation: turns, gaps in their numbers, faults
    (each turn counts for its first one), neighbours that cannot follow each other, cost
    and audit. The rows after it have the edit's letter and, unless it deletes, role and
    text of the repaired turn.
    """
    space = F.lit(" ")
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    place = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))  # 0 for others, 1 for no role
    known = (F.col("role") != "") & (place > 0)
    ending = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(~F.col("text").rlike(WORD), 1)
        .when(F.col("copy") > 1, 2)
        .when(~ending.isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    marked = (
        turns.repartition("conv_id")
        .withColumn("copy", F.row_number().over(same))
        .select(
            "conv_id", "turn", "role", "text",
            F.when(known, place - 1).otherwise(3).cast("bigint").alias("initial"),
            fault.cast("bigint").alias("fault"),
        )
    )
    twice = marked.withColumn("texts", F.explode(F.array(F.lit(False), F.lit(True))))
    none = F.lit(None).cast("string")
    ordered = twice.sortWithinPartitions(
        F.col("conv_id"), F.col("texts"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")
    ).select(
        "conv_id", "texts", "turn", "initial", "fault",
        F.when(F.col("texts"), F.col("role")).otherwise(none).alias("role"),
        F.when(F.col("texts"), F.col("text")).otherwise(none).alias("text"),
    )
    return ordered.mapInArrow(_repair, EDITS)


def repaired_turns(edits: DataFrame) -> DataFrame:
    """Turns of the repaired conversations: conv_id, seq, role and text."""
    return edits.filter("seq > 0 AND edit <> 'D'").select("conv_id", "seq", "role", "text")


def summaries(edits: DataFrame) -> DataFrame:
    """One row for each conversation: faults, cost and audit."""
    return edits.filter("seq = 0").select("conv_id", *SUMMARY)
