"""Repair of the turn structure of conversations by an auction shortest-path algorithm.

The rows of a conversation and the states of its role pattern span a lattice: layer ``i`` has a node for
each state (nothing yet, after system, after user, after assistant) before row ``i`` is dealt with, and
every edit is an arc of integer cost.  Each node has a price.  A path grows from a node along the
arc that its price pays for (extension); where no arc is as cheap as the price, the price rises to the
cheapest one and the path steps back (contraction).  Layers are settled from the end of the
conversation, so a path ends as soon as it reaches a layer whose prices have converged; a price then is
the cost of the cheapest way from its node to the end.  Arcs on which the prices differ by exactly
the arc's cost are tight; following the tight arc of least letter from the first node spells the
cheapest edits, of equally cheap ones those least in ASCII order.

No task holds a conversation.  All rows are sorted into ranges, so a conversation of any length is cut
into segments, at most one for each range.  A segment becomes a matrix of the costs from each state
before it to each state behind it; the matrices of a conversation, read from its end, give the
prices behind each segment.  Then its segments stream through one task in order, one in memory
at a time, where edits are traced.

Rows of a conversation are ordered by turn, NULL first; rows of one turn by role and text.  A NULL
role or text is one space; an empty role has no initial and fits nowhere.  NULL is a conversation id like any other.  Repeated rows are duplicates.
A conversation without rows gives one row without an edit; an empty table gives an empty one.  Only
the four columns are read; others, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import written

# What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

SPACES = "\t\n\v\f\r "

FINE, CUT, BLANK, REPEATED = "", "truncated", "blank", "duplicate"

# States of the role pattern (s?(ua)+)?: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT_TURN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

Prices = tuple["int | None", ...]
"""Of each state; None where no way leads to the end."""


class Arc(NamedTuple):
    letter: str
    cost: int
    to: int
    same_layer: bool


class Kind(NamedTuple):
    """All that the lattice needs to know of a row."""

    initial: str
    fault: str


def kept_as(initial: str, state: int) -> int | None:
    """State after a row of this role is kept, if the pattern allows it."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "ua"[NEXT_TURN[state] == ASSISTANT]:
        return NEXT_TURN[state]
    return None


@lru_cache(None)
def arcs(kind: Kind | None, state: int) -> tuple[Arc, ...]:
    """Edits at a node, least letter first; ``None`` stands for the end, where only inserts are left."""
    turn = NEXT_TURN[state]
    insert = Arc("I", INSERT, turn, True)
    if kind is None:
        return (insert,)
    found = [Arc("D", DELETE, state, False), insert]
    if kind.fault in (FINE, CUT):
        more = TRUNCATED if kind.fault == CUT else 0
        kept = kept_as(kind.initial, state)
        if kept is not None:
            found.append(Arc("K", more, kept, False))
        found.append(Arc("R", REROLE + more, turn, False))
    return tuple(found)


def settle(kind: Kind, after: Prices) -> Prices:
    """Prices of a row's layer from those of the layer behind it."""
    known = [p for p in after if p is not None]
    if not known:
        return (None,) * 4
    least = min(known)
    # Equal distances between prices have equal results.
    made = _settle(kind, tuple(None if p is None else p - least for p in after))
    return tuple(None if p is None else p + least for p in made)


@lru_cache(1 << 16)
def _settle(kind: Kind | None, after: Prices) -> Prices:
    """The auction within a layer.

    No way from here can be cheaper than the cheapest one from the next layer, which is 0 here; so
    prices of 0 are ones that no arc undercuts, and the auction starts with them.
    """
    can = [False] * 4
    for _ in STATES:
        for s in STATES:
            can[s] = any(
                can[a.to] if a.same_layer else after[a.to] is not None for a in arcs(kind, s)
            )
    price: list[int] = [0] * 4
    settled = [False] * 4

    def offer(arc: Arc) -> int:
        return arc.cost + (price[arc.to] if arc.same_layer else after[arc.to])

    for origin in STATES:
        path = [origin] if can[origin] and not settled[origin] else []
        while path:
            at = path[-1]
            open_arcs = [
                a
                for a in arcs(kind, at)
                if (can[a.to] if a.same_layer else after[a.to] is not None)
            ]
            best = min(open_arcs, key=offer)
            if price[at] < offer(best):
                price[at] = offer(best)
                if len(path) > 1:
                    path.pop()
            elif best.same_layer and not settled[best.to]:
                path.append(best.to)
            else:
                for s in path:
                    settled[s] = True
                path = []
    return tuple(price[s] if can[s] else None for s in STATES)


def end_prices() -> Prices:
    """Prices behind the last row: nothing is left to do after an assistant, or without any row."""
    # The goal is a layer of its own, reached free of charge from the two accepting states.
    price = {NOTHING: 0, ASSISTANT: 0}
    for s in (USER, SYSTEM):
        price[s] = INSERT + price[NEXT_TURN[s]]
    return tuple(price[s] for s in STATES)


def matrix(kinds: list[Kind]) -> list[list[int | None]]:
    """Costs of a segment from each state before it (row) to each one behind it (column)."""
    columns = []
    for target in STATES:
        price: Prices = tuple(0 if s == target else None for s in STATES)
        for kind in reversed(kinds):
            price = settle(kind, price)
        columns.append(price)
    return [[columns[t][s] for t in STATES] for s in STATES]


def before(costs: list[list[int | None]], behind: Prices) -> Prices:
    """Prices before a segment from those behind it."""
    return tuple(
        min(
            (c + p for c, p in zip(row, behind) if c is not None and p is not None), default=None
        )
        for row in costs
    )


def layers(kinds: list[Kind], behind: Prices) -> list[Prices]:
    """Prices before each row of a segment, and behind the last one."""
    found = [behind]
    for kind in reversed(kinds):
        found.append(settle(kind, found[-1]))
    return found[::-1]


def least_tight(kind: Kind | None, state: int, here: Prices, after: Prices | None) -> Arc | None:
    """The tight arc of least letter; None at the goal."""
    for arc in arcs(kind, state):
        price = here[arc.to] if arc.same_layer else after[arc.to]
        if price is not None and here[state] == arc.cost + price:
            return arc
    return None


def conversation_key(conv_id: str) -> Column:
    """The id as text; NULL has one of its own."""
    c = F.col(f"`{conv_id}`")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.lit("+"), c.cast("string")))


def faults(rows: DataFrame) -> DataFrame:
    """Rows with their first fault.

    Equal rows of one turn are counted before they are compared with those of other turns, so
    repeats of any number reach the join as one row a turn.
    """
    alike = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    counted = rows.groupBy("conv", "conv_id", "turn", "role", "text").agg(F.count("*").alias("times"))
    counted = counted.withColumn("alike", alike)
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = counted.groupBy("conv", "alike").agg(F.min(at).alias("first"))
    is_first = F.col("first.turn").eqNullSafe(F.col("turn"))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    plain = F.when(~last.isin(".", "!", "?"), CUT).otherwise(FINE)
    own = F.when(last == "", BLANK).when(is_first, plain).otherwise(REPEATED)
    others = F.array_repeat(
        F.when(last == "", BLANK).otherwise(REPEATED), (F.col("times") - 1).cast("int")
    )
    return (
        counted.join(first, ["conv", "alike"])
        .select(
            "conv", "conv_id", "turn", "role", "text",
            F.explode(F.concat(F.array(own), others)).alias("fault"),
        )
    )


def sorted_turns(rows: DataFrame) -> DataFrame:
    """All rows in order, with the range (``part``) and the place in it; a written table."""
    kinds = dict(rows.dtypes)
    names = ["conv", "conv_id", "turn", "role", "text", "fault"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, begin = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array([part] * n, pa.int32()),
                    pa.array(range(begin, begin + n), pa.int64()),
                ],
                [*names, "part", "seq"],
            )
            begin += n

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Of equal rows the first may be sound, the others are duplicates.
    order = ["conv", "turn", "role", "text", "late"]
    placed = (
        rows.withColumn("late", F.col("fault") == REPEATED)
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(*names)
        .mapInArrow(
            place, ", ".join([*(f"{c} {kinds[c]}" for c in names), "part int", "seq bigint"])
        )
    )
    return written(placed, "turns")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[Kind]]]:
    """Key and kinds of each segment of a sorted stream."""
    key, kinds = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "part", "initial", "fault"))
        for conv, part, initial, fault in zip(*columns):
            if (conv, part) != key:
                if kinds:
                    yield key, kinds
                key, kinds = (conv, part), []
            kinds.append(Kind(initial, fault))
    if kinds:
        yield key, kinds


ROWS = 20_000
"""Rows of a batch that a task hands over."""


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = ROWS) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or size > 1 << 23:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def segment_ends(turns: DataFrame) -> DataFrame:
    """Prices behind each segment: ``conv``, ``part``, ``behind``."""
    made = pa.schema(
        [("conv", pa.string()), ("part", pa.int32()), ("costs", pa.list_(pa.list_(pa.int64())))]
    )
    ends = pa.schema(
        [("conv", pa.string()), ("part", pa.int32()), ("behind", pa.list_(pa.int64()))]
    )

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((*key, matrix(kinds)) for key, kinds in _segments(batches)), made)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            current, price = None, end_prices()
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in made.names)
                for conv, part, costs in zip(*columns):
                    if conv != current:
                        current, price = conv, end_prices()
                    yield conv, part, list(price)
                    price = before(costs, price)

        return _batches(rows(), ends)

    narrow = turns.select("conv", "part", "seq", F.substring("role", 1, 1).alias("initial"), "fault")
    costs = (
        narrow.repartition("conv", "part")
        .sortWithinPartitions("conv", "part", "seq")
        .select("conv", "part", "initial", "fault")
        .mapInArrow(cost, "conv string, part int, costs array<array<bigint>>")
    )
    return (
        costs.repartition("conv")
        .sortWithinPartitions("conv", F.col("part").desc())
        .mapInArrow(chain, "conv string, part int, behind array<bigint>")
    )


class Row(NamedTuple):
    turn: object
    role: str
    text: str
    fault: str


def trace(
    rows: list[Row], behind: Prices, state: int, last: bool
) -> tuple[list[tuple[str, int, Row | None, str | None]], int]:
    """Edits of a segment entered in ``state``: letter, cost, row, role; and the state behind it.

    What is inserted behind the last row belongs to the last segment.
    """
    kinds: list[Kind | None] = [Kind(r.role[:1], r.fault) for r in rows]
    prices, edits, at = layers(kinds, behind), [], 0
    while at < len(rows) or last:
        kind = kinds[at] if at < len(rows) else None
        arc = least_tight(kind, state, prices[at], prices[at + 1] if kind else None)
        if arc is None:
            break
        row = None if arc.same_layer else rows[at]
        new = ROLE_OF.get(arc.to) if arc.letter in "IR" else row.role if row else None
        edits.append((arc.letter, arc.cost, row, None if arc.letter == "D" else new))
        at, state = at + (not arc.same_layer), arc.to
    return edits, state


def repair(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    ids: DataFrame | None = None,
) -> DataFrame:
    """The edits of every conversation, a row each, a conversation's together and in order.

    ``conv_id``, ``at`` (place among the conversation's edits, from 0), ``edit`` (``K``eep, ``R``erole,
    ``D``elete, ``I``nsert; NULL for a conversation without rows), ``cost``, ``fault`` (NULL for an
    insert), ``turn``, ``old_role``, ``role`` and ``text`` after the edit (NULL for a delete).
    ``ids`` are further conversations, which may have no rows.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`"), space).alias("text"),
    ).withColumn("conv", conversation_key("conv_id"))
    turns = sorted_turns(faults(rows))
    # The stream of a conversation: a row for itself, then for each segment its prices and its rows.
    heads = rows.select("conv_id") if ids is None else ids.select(F.col(f"`{conv_id}`").alias("conv_id"))
    heads = heads.distinct().select(
        conversation_key("conv_id").alias("conv"), "conv_id",
        F.lit(-1).alias("part"), F.lit(-1).cast("bigint").alias("seq"),
    )
    prices = segment_ends(turns).withColumn("seq", F.lit(-1).cast("bigint"))
    stream = turns.unionByName(prices, allowMissingColumns=True).unionByName(
        heads, allowMissingColumns=True
    )
    types = dict(stream.dtypes)
    fields = {
        "conv_id": types["conv_id"], "at": "bigint", "edit": "string", "cost": "bigint",
        "fault": "string", "turn": types["turn"], "old_role": "string", "role": "string",
        "text": "string",
    }
    ddl = ", ".join(f"{c} {t}" for c, t in fields.items())
    names = ["conv", "conv_id", "part", "seq", "turn", "role", "text", "fault", "behind"]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _edits(batches, names, list(fields))

    return (
        stream.repartition("conv")
        .sortWithinPartitions("conv", "part", "seq")
        .select(*names)
        .mapInArrow(edit, T._parse_datatype_string(ddl))
    )


def _edits(
    batches: Iterator[pa.RecordBatch], names: list[str], made: list[str]
) -> Iterator[pa.RecordBatch]:
    """Edits of the conversations of a stream, a segment in memory at a time."""
    schema: list[pa.Schema] = []

    def segments() -> Iterator[tuple]:
        """Heads (id, None, None) and segments (id, prices behind, rows)."""
        head, behind, rows = None, None, []
        for batch in batches:
            kinds = {c: batch.schema.field(c).type for c in ("conv_id", "turn")}
            if not schema:
                plain = {"at": pa.int64(), "cost": pa.int64(), **kinds}
                schema.append(pa.schema([(c, plain.get(c, pa.string())) for c in made]))
            columns = (batch.column(c).to_pylist() for c in names)
            for _, conv_id, part, seq, turn, role, text, fault, prices in zip(*columns):
                if seq < 0 and behind is not None:
                    yield head, behind, rows
                    behind, rows = None, []
                if part < 0:
                    head = conv_id
                    yield head, None, None
                elif seq < 0:
                    behind = tuple(prices)
                else:
                    rows.append(Row(turn, role, text, fault))
        if behind is not None:
            yield head, behind, rows

    def rows() -> Iterator[tuple]:
        coming = segments()
        now = next(coming, None)
        at, state = 0, NOTHING
        while now is not None:
            then = next(coming, None)
            head, behind, found = now
            last = then is None or then[1] is None
            if behind is None:
                at, state = 0, NOTHING
                if last:
                    yield head, 0, None, 0, None, None, None, None, None
            else:
                edits, state = trace(found, behind, state, last)
                for letter, cost, row, role in edits:
                    if row is None:
                        yield head, at, letter, cost, None, None, None, role, ""
                    else:
                        text = None if letter == "D" else row.text
                        yield head, at, letter, cost, row.fault, row.turn, row.role, role, text
                    at += 1
            now = then

    held: list[tuple] = []
    size = 0
    for row in rows():
        held.append(row)
        size += len(row[-1] or "") + 100
        if size > 1 << 22:
            yield _batch(held, schema[0])
            held, size = [], 0
    if held:
        yield _batch(held, schema[0])


def summaries(edits: DataFrame) -> DataFrame:
    """A row for each conversation: faults, cost, audit and digest of what the edits leave.

    Takes the rows as :func:`repair` leaves them, a conversation's together and in order, and streams
    them: of a conversation only its audit is held.
    """
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = dict(edits.dtypes)["conv_id"]
    legal = {"su", "ua", "au"}

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            now = None
            for batch in batches:
                if not types:
                    types.append(batch.schema.field("conv_id").type)
                columns = (
                    batch.column(c).to_pylist()
                    for c in ("conv_id", "at", "edit", "cost", "fault", "turn", "old_role", "role", "text")
                )
                for conv_id, at, edit, cost, fault, turn, old_role, role, text in zip(*columns):
                    if at == 0:
                        if now is not None:
                            yield now.row()
                        now = Summary(conv_id)
                    if edit is not None:
                        now.add(edit, cost, fault, turn, old_role, role, text)
            if now is not None:
                yield now.row()

        class Summary:
            def __init__(self, conv_id):
                self.conv_id, self.n = conv_id, dict.fromkeys(counts, 0)
                self.audit, self.digest, self.first = [], hashlib.sha256(), True
                self.low = self.turn = self.initial = None
                self.turns = 0

            def add(self, edit, cost, fault, turn, old_role, role, text):
                self.audit.append(edit)
                self.n["cost"] += cost
                if edit != "I":
                    if fault:
                        self.n[fault] += 1
                    if self.initial is not None:
                        self.n["illegal"] += self.initial + old_role[:1] not in legal
                    self.initial = old_role[:1]
                    if turn is not None and turn != self.turn:
                        self.low = turn if self.low is None else self.low
                        self.turn = turn
                        self.turns += 1
                if edit != "D":
                    line = f"{role}:{text}" if self.first else f"\n{role}:{text}"
                    self.digest.update(line.encode())
                    self.first = False

            def row(self):
                if self.turns:
                    self.n["gaps"] = self.turn - self.low + 1 - self.turns
                return (
                    self.conv_id, *self.n.values(), "".join(self.audit), self.digest.hexdigest()
                )

        made = rows()
        first = next(made, None)
        if first is None:
            return
        schema = pa.schema(
            [("conv_id", types[0]), *((c, pa.int64()) for c in counts),
             ("audit", pa.string()), ("repaired_sha256", pa.string())]
        )

        def all_rows():
            yield first
            yield from made

        yield from _batches(all_rows(), schema)

    return edits.mapInArrow(
        summarise,
        f"conv_id {kind}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string",
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by a checksum of id and turn, as the query has them.

    One row in 20 each is dropped, emptied, stripped of its sentence marks, repeated, or made the user's.
    """

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), what.alias("what")
    )
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", ""))
    times = F.when(F.col("what") == 0, 0).when(F.col("what") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")
