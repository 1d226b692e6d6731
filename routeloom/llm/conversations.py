"""Repair of the structure of conversations by depth-first branch and bound.

A sound conversation is ``(s?(ua)+)?`` in the initials of its roles: perhaps a system turn, then
user and assistant in turns.  Turns may be kept, given another role, deleted or inserted; the
cheapest such edits are sought with an explicit stack, lower bounds for what remains, the best
repair so far, and for each place and state the least cost that has led there.

Every turn becomes one small code, and only the codes of the conversation at hand are held.  Its
repaired text is made in a second pass, turn by turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the contract.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: States after the roles so far: none, a system turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
_CLASS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The state after one more turn of a class in ``_CLASS``.
_NEXT = {
    (START, SYSTEM): SYSTEM,
    (START, USER): USER,
    (SYSTEM, USER): USER,
    (USER, ASSISTANT): ASSISTANT,
    (ASSISTANT, USER): USER,
}
#: The class that a renamed or inserted turn must have.
_WANTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

#: Faults of a turn; the code of a turn is ``4 * fault + class`` (class 0: another role).
SOUND, CUT, BLANK, DUPLICATE = range(4)
#: Audits that a task remembers by the codes of short conversations.
_MEMORY, _SHORT = 100_000, 64
_ROWS, _BYTES = 2_000, 4 << 20


class _Bounds:
    """Lower bounds of what the turns from a place on must cost.

    Blank and repeated turns must go, cut ones cost at least 1.  Of the others, two neighbours
    whose roles may not follow each other need an edit at one of them or between them; an edit
    serves two such pairs at most, if they share a turn.  So runs of k pairs need k/2 edits,
    rounded up, and an edit costs at least 2 more.
    """

    def __init__(self, codes: bytes):
        n = len(codes)
        self.codes = codes
        self.forced = [0] * (n + 1)
        self.live = [n] * (n + 1)  # the first turn from here on that may stay
        self.pairs = [0] * (n + 1)  # for the pairs from this live turn on
        after = n
        for i in range(n - 1, -1, -1):
            fault, role = codes[i] >> 2, codes[i] & 3
            if fault >= BLANK:
                self.forced[i] = self.forced[i + 1] + DELETE
                self.live[i] = after
                continue
            self.forced[i] = self.forced[i + 1] + (TRUNCATED if fault == CUT else 0)
            self.live[i] = i
            legal = role != 0 and self._follows(role, after)
            self.pairs[i] = self._pairs(legal, after)
            after = i

    def _follows(self, state: int, place: int) -> bool:
        """Whether the turn at ``place``, or the end, may come in this state."""
        if place == len(self.codes):
            return state in (START, ASSISTANT)
        return (state, self.codes[place] & 3) in _NEXT

    def _pairs(self, legal: bool, place: int) -> int:
        """For the pair before the live turn at ``place`` and all behind it."""
        if legal:
            return self.pairs[place]
        return INSERT + (self.pairs[self.live[place + 1]] if place < len(self.codes) else 0)

    def __call__(self, place: int, state: int) -> int:
        first = self.live[place]
        return self.forced[place] + self._pairs(self._follows(state, first), first)


def _steps(codes: bytes, place: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at a node as ``(initial, cost, place, state)``, in ASCII order."""
    found = []
    wanted = _WANTED[state]
    if place < len(codes):
        found.append(("D", DELETE, place + 1, state))
    found.append(("I", INSERT, place, _NEXT[state, wanted]))
    if place < len(codes) and codes[place] >> 2 < BLANK:
        extra = TRUNCATED if codes[place] >> 2 == CUT else 0
        after = _NEXT.get((state, codes[place] & 3))
        if after is not None:
            found.append(("K", extra, place + 1, after))
        found.append(("R", RENAME + extra, place + 1, _NEXT[state, wanted]))
    return found


def _dive(codes: bytes, bounds: _Bounds) -> int:
    """Cost of the repair that always takes the step with the least bound."""
    place, state, cost = 0, START, 0
    while place < len(codes) or state not in (START, ASSISTANT):
        steps = _steps(codes, place, state)
        _, step, place, state = min(steps, key=lambda s: (s[1] + bounds(s[2], s[3]), s[2] <= place))
        cost += step
    return cost


def repair(codes: bytes) -> tuple[int, str]:
    """Cheapest repair of a conversation: ``(cost, audit)``, of equal costs the ASCII-least audit.

    Edits are tried in ASCII order, so prefixes come in ASCII order too: of two that lead to one
    node, the later one is only worth following if it costs less, and of two whole repairs of equal
    cost the first is the least.
    """
    bounds = _Bounds(codes)
    limit = _dive(codes, bounds) + 1  # a repair must cost less than this
    best: tuple[int, str] | None = None
    least = [[limit] * 4 for _ in range(len(codes) + 1)]
    stack: list[tuple[int, int, int, tuple | None]] = [(0, START, 0, None)]
    while stack:
        place, state, cost, trail = stack.pop()
        if cost >= least[place][state] or cost + bounds(place, state) >= limit:
            continue
        least[place][state] = cost
        if place == len(codes) and state in (START, ASSISTANT):
            limit = cost
            letters = []
            while trail is not None:
                trail, letter = trail
                letters.append(letter)
            best = cost, "".join(reversed(letters))
            continue
        for letter, step, after, then in reversed(_steps(codes, place, state)):
            stack.append((after, then, cost + step, (trail, letter)))
    return best


def damaged(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Turns ``(conv, turn, role, text, there)`` with faults put in by a hash of their place.

    By ``crc32("conv:turn") % 20``: 0 drops the turn (``there`` is false), 1 empties its text, 2
    takes out all ``.!?``, 3 repeats it, 4 makes it a user's.  Null roles and texts are one space.
    """
    blank = F.lit(" ")
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    place = F.concat(
        F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank)
    )
    text = F.coalesce(F.col(f"`{text_col}`"), blank)
    rows = turns.select(
        conv.alias("conv"),
        turn.alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), blank).alias("role"),
        text.alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("fault"),
    )
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") <= 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("fault") != 0).alias("there"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


def as_turns(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Turns as they are, in the form that :func:`find_repairs` takes."""
    return turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
        F.lit(True).alias("there"),
    )


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations together and their turns in order; Spark spills what memory cannot hold."""
    order = [F.col(c).asc_nulls_first() for c in ("conv", *first, "turn", "role", "text")]
    return rows.repartition("conv").sortWithinPartitions(*order)


def _edits_schema(turns: DataFrame) -> T.StructType:
    counts = "gaps blank duplicate truncated illegal cost".split()
    return T.StructType(
        [turns.schema["conv"]]
        + [T.StructField(name, T.LongType()) for name in counts]
        + [T.StructField("audit", T.StringType())]
    )


class _Conversation:
    """Counts and codes of the conversation at hand."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.seen: set[bytes] = set()
        self.counts = [0, 0, 0]  # blank, duplicate, truncated
        self.illegal = self.distinct = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, role: str, ends: str | None, key: bytes) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        fault = SOUND
        if not ends:
            fault = BLANK
        elif key in self.seen:
            fault = DUPLICATE
        elif ends not in ENDS:
            fault = CUT
        if fault == BLANK:
            self.counts[0] += 1
        elif fault == DUPLICATE:
            self.counts[1] += 1
        elif fault == CUT:
            self.counts[2] += 1
        self.seen.add(key)
        self.codes.append(4 * fault + _CLASS.get(role[:1], 0))

    def row(self, conv: object, repairs: dict[bytes, tuple[int, str]]) -> tuple:
        codes = bytes(self.codes)
        found = repairs.get(codes)
        if found is None:
            found = repair(codes)
            if len(codes) <= _SHORT and len(repairs) < _MEMORY:
                repairs[codes] = found
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (conv, gaps, *self.counts, self.illegal, *found)


def find_repairs(turns: DataFrame) -> DataFrame:
    """Faults of each conversation of ``turns`` and its cheapest repair.

    ``turns`` comes from :func:`as_turns` or :func:`damaged`.  Per conversation ``conv``:
    ``gaps`` in the turn numbers, the numbers of ``blank``, ``duplicate`` and ``truncated`` turns
    (each by its first fault), ``illegal`` neighbours, and the ``cost`` and ``audit`` (edits'
    initials: Delete, Insert, Keep, Rerole) of the repair.

    Turns are taken by number, those without one first; ties by role and text.  Conversations
    without an id are one conversation.  One without any turn left has zeros and an empty audit.
    A task reads one conversation after another and holds a byte per turn and 16 bytes per
    different turn of the one it is at.
    """
    schema = _edits_schema(turns)
    ends = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    rows = _in_order(turns).select(
        "conv",
        F.col("turn").cast("bigint").alias("turn"),
        "role",
        "there",
        ends.alias("ends"),
        F.unhex(F.md5(F.concat_ws("\0", "role", "text").cast("binary"))).alias("key"),
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairs: dict[bytes, tuple[int, str]] = {}
        conv, current, out, held = None, None, [], 0
        kind: list[pa.DataType] = []
        types = [*[pa.int64()] * 6, pa.string()]
        for one, turn, role, there, last, key in _typed(batches, kind):
            if current is None or one != conv:
                if current is not None:
                    out.append(current.row(conv, repairs))
                    held += len(current.codes) + 100
                    if held > _BYTES:
                        yield _batch(out, [*kind, *types], schema.names)
                        out, held = [], 0
                conv, current = one, _Conversation()
            if there:
                current.add(turn, role, last, key)
        if current is not None:
            out.append(current.row(conv, repairs))
            yield _batch(out, [*kind, *types], schema.names)

    return rows.mapInArrow(solve, schema)


def _applied(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``(conv, role, text, edit)`` per repaired turn; at ends the conversation's row and None.

    ``rows`` are ``(conv, role, text, there, repair)``: of each conversation the row of
    :func:`find_repairs` without its ``conv``, then the turns.
    """
    state, left, head = START, iter(""), None

    def inserted(conv: object, edits: Iterator[str]) -> Iterator[tuple]:
        """The turns inserted before the next edit of another kind, which is returned."""
        nonlocal state
        for edit in edits:
            if edit != "I":
                return edit
            wanted = _WANTED[state]
            state = _NEXT[state, wanted]
            yield conv, ROLES["u" if wanted == USER else "a"], "", "I"
        return None

    open_conv = None
    for conv, role, text, there, found in rows:
        if found is not None:
            if head is not None:
                yield from inserted(open_conv, left)
                yield open_conv, None, head, None
            open_conv, head, state, left = conv, found, START, iter(found["audit"])
        elif there:
            edit = yield from inserted(conv, left)
            if edit == "K":
                state = _NEXT[state, _CLASS[role[:1]]]
                yield conv, role, text, edit
            elif edit == "R":
                wanted = _WANTED[state]
                state = _NEXT[state, wanted]
                yield conv, ROLES["u" if wanted == USER else "a"], text, edit
    if head is not None:
        yield from inserted(open_conv, left)
        yield open_conv, None, head, None


def _with_repairs(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """Each conversation's repair, then its turns in order."""
    found = F.struct(*repairs.columns[1:])
    columns = ["conv", "turn", "role", "text", "there", "found", "kind"]
    kinds = {f.name: f.dataType for f in turns.schema.fields}
    nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in columns[1:4]]
    heads = repairs.select(
        "conv", *nothing, F.lit(False).alias("there"), found.alias("found"), F.lit(0).alias("kind")
    )
    empty = F.lit(None).cast(heads.schema["found"].dataType)
    body = turns.select(*columns[:5], empty.alias("found"), F.lit(1).alias("kind"))
    ordered = _in_order(heads.unionByName(body), "kind")
    return ordered.select("conv", "role", "text", "there", "found")


def _typed(batches: Iterator[pa.RecordBatch], kind: list[pa.DataType]) -> Iterator[tuple]:
    """Rows of all batches; the first column's type goes to ``kind``."""
    for whole in batches:
        kind[:] = [whole.schema.field(0).type]
        for at in range(0, whole.num_rows, _ROWS):
            columns = [c.to_pylist() for c in whole.slice(at, _ROWS).columns]
            yield from zip(*columns, strict=True)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns of all repaired conversations as ``(conv, place, role, text, edit)``.

    ``place`` counts from 0; ``edit`` is K(eep), R(erole) or I(nsert).  A conversation that is
    repaired to nothing has no rows.
    """
    schema = T.StructType(
        [
            turns.schema["conv"],
            T.StructField("place", T.LongType()),
            *[T.StructField(name, T.StringType()) for name in ("role", "text", "edit")],
        ]
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, held, place = [], [], 0, 0
        for conv, role, text, edit in _applied(_typed(batches, kind)):
            if edit is None:
                place = 0
                continue
            out.append((conv, place, role, text, edit))
            place += 1
            held += len(text) + 100
            if held > _BYTES:
                yield _batch(out, [*kind, pa.int64(), *[pa.string()] * 3], schema.names)
                out, held = [], 0
        if out:
            yield _batch(out, [*kind, pa.int64(), *[pa.string()] * 3], schema.names)

    return _with_repairs(turns, repairs).mapInArrow(apply, schema)


def repaired_digests(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """Columns of ``repairs`` and ``repaired_sha256``, of ``role:text`` of all repaired turns.

    The turns are joined by newlines and hashed one after another, so no conversation is held
    whole.
    """
    schema = T.StructType(
        [*repairs.schema.fields, T.StructField("repaired_sha256", T.StringType())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, held = [], [], 0
        types = [*[pa.int64()] * 6, *[pa.string()] * 2]
        sha, between = hashlib.sha256(), b""
        for conv, role, text, edit in _applied(_typed(batches, kind)):
            if edit is not None:
                sha.update(between + f"{role}:{text}".encode())
                between = b"\n"
                continue
            out.append((conv, *text.values(), sha.hexdigest()))
            held += len(text["audit"]) + 200
            sha, between = hashlib.sha256(), b""
            if held > _BYTES:
                yield _batch(out, [*kind, *types], schema.names)
                out, held = [], 0
        if out:
            yield _batch(out, [*kind, *types], schema.names)

    return _with_repairs(turns, repairs).mapInArrow(digest, schema)
