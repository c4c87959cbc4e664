"""Conversations made regular again by the cheapest edits.

A regular conversation has the roles ``(s?(ua)+)?``: nothing, or perhaps a system turn
and then user and assistant in turn. Edits and their costs: keep a turn (0), change its
role to the one that is due (3), delete it (4; blank and repeated turns must go), insert
an empty turn of the role that is due (3). A truncated turn that stays costs 3 more. The
audit is the edits' initials in order, ``D``, ``I``, ``K``, ``R``; of equal costs the
least audit counts.

The edits of ``n`` turns are paths through a lattice of ``n + 1`` by four points: turns
read, and what came last (nothing, system, user, assistant). A forward heap grows from
the beginning and a reverse heap from the end. When the least costs of both exceed the
cheapest meeting together, every cheapest path has a point that both have labelled;
until then equal costs are finished. Each side keeps the least audit of every point, so
the least of all meetings' joined audits is the answer. (No audit to a point is the
beginning of an equally cheap one to it, as going on costs something or reads a turn; so
the lesser front always gives the lesser whole.)

A conversation is not gathered. Its turns are sorted over all partitions and a byte for
each (role and fault) goes to blocks of at most ``BLOCK_TURNS``. Each block is searched
between all points of its ends, in tasks of its own, and the tables of the blocks are
put together in order; that costs about as many bytes as the audit has. Texts are not
part of that. The hash of a repaired conversation is one chain over its turns, so they
pass through a task one after the other and are never held.

Defined results: NULL roles and texts read as one space. Turns go by number, NULL
first; turns of one number by role, the first ``TIE_CHARS`` characters and a hash of the
text. NULL is a conversation of its own. An empty table gives an empty one. Extra columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import SPACES, only, ship
from starloom.storage import materialize

#: Turns that are searched as one lattice; longer conversations are put together of several.
BLOCK_TURNS = 512

TIE_CHARS = 32

#: What came last, and what each role leads to from there.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
DUE = (USER, USER, ASSISTANT, USER)
ENDS = (NOTHING, ASSISTANT)
LEGAL = ("su", "ua", "au")

RECAST, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: One letter per turn: its role (system, user, assistant, other) and whether it is sound,
#: truncated or has to go.
ROLES, SOUND, CUT_OFF, MUST_GO = "suax", 0, 1, 2
CODES = {chr(65 + 3 * r + fault): (role, fault) for r, role in enumerate(ROLES) for fault in range(3)}


def _code(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char((65 + 3 * place + fault).cast("long"))


def _forward(codes: str, i: int, last: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges out of a point: turns read, what came last, cost, edit."""
    yield i, DUE[last], INSERT, "I"
    if i < len(codes):
        role, fault = CODES[codes[i]]
        yield i + 1, last, DELETE, "D"
        if fault != MUST_GO:
            more = TRUNCATED if fault == CUT_OFF else 0
            if role in KEEP[last]:
                yield i + 1, KEEP[last][role], more, "K"
            yield i + 1, DUE[last], RECAST + more, "R"


def _reverse(codes: str, i: int, last: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into a point, as :func:`_forward` gives them."""
    before = [state for state in range(4) if DUE[state] == last]
    for state in before:
        yield i, state, INSERT, "I"
    if i:
        role, fault = CODES[codes[i - 1]]
        yield i - 1, last, DELETE, "D"
        if fault != MUST_GO:
            more = TRUNCATED if fault == CUT_OFF else 0
            for state in range(4):
                if KEEP[state].get(role) == last:
                    yield i - 1, state, more, "K"
            for state in before:
                yield i - 1, state, RECAST + more, "R"


class _Side:
    """One of the two searches: labels (cost, audit) by point, and the heap of open points."""

    def __init__(self, edges, codes: str, begins: list[tuple[int, int]], reverse: bool):
        self.edges, self.codes, self.reverse = edges, codes, reverse
        self.labels = dict.fromkeys(begins, (0, ""))
        self.heap, self.closed = [], set()
        for point in begins:
            self._open(0, point)

    def _open(self, cost: int, point: tuple[int, int]) -> None:
        # Edits that cost nothing read a turn; points of one cost are closed in that order.
        heappush(self.heap, (cost, -point[0] if self.reverse else point[0], point))

    def least(self) -> float:
        while self.heap and self.heap[0][2] in self.closed:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def step(self) -> Iterator[tuple[int, int]]:
        """Close the cheapest open point; gives the points whose labels got better."""
        cost, _, point = heappop(self.heap)
        self.closed.add(point)
        audit = self.labels[point][1]
        for i, last, more, edit in self.edges(self.codes, *point):
            label = (cost + more, edit + audit if self.reverse else audit + edit)
            to = (i, last)
            if to not in self.closed and (to not in self.labels or label < self.labels[to]):
                self.labels[to] = label
                self._open(label[0], to)
                yield to


def cheapest(codes: str, begin: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the best path from ``begin`` to any of ``ends``; None if there is none."""
    n = len(codes)
    front = _Side(_forward, codes, [(0, begin)], False)
    back = _Side(_reverse, codes, [(n, end) for end in ends], True)
    best = min((0 for point in front.labels if point in back.labels), default=float("inf"))
    while True:
        from_front, from_back = front.least(), back.least()
        if from_front + from_back > best or float("inf") in (from_front, from_back):
            break
        side, other = (front, back) if from_front <= from_back else (back, front)
        for point in side.step():
            if point in other.labels:
                best = min(best, side.labels[point][0] + other.labels[point][0])
    met = [
        (label[0] + back.labels[point][0], label[1] + back.labels[point][1])
        for point, label in front.labels.items()
        if point in back.labels
    ]
    return min(met, default=None)


def search(codes: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """The table of a block: (from, to, cost, audit). The last block of a conversation leads to ``NOTHING``."""
    table = []
    for begin in (NOTHING,) if first else range(4):
        for ends in (ENDS,) if last else ((end,) for end in range(4)):
            found = cheapest(codes, begin, ends)
            if found:
                table.append((begin, ends[0], *found))
    return table


def join_tables(tables: Iterator[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and audit of the best way through the blocks of a conversation, the first one first.

    What all ways have in common so far is put aside, so long audits are not copied again and again.
    """
    ways, common = {NOTHING: (0, "")}, []
    for table in tables:
        after: dict[int, tuple[int, str]] = {}
        for begin, end, cost, audit in table:
            if begin in ways:
                way = (ways[begin][0] + cost, ways[begin][1] + audit)
                if end not in after or way < after[end]:
                    after[end] = way
        shared = commonprefix([audit for _, audit in after.values()])
        common.append(shared)
        ways = {end: (cost, audit[len(shared) :]) for end, (cost, audit) in after.items()}
    cost, audit = ways[NOTHING]
    return cost, "".join(common) + audit


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with typical faults, by a checksum of conversation and turn: conv_id, turn, role, text."""
    rows = only(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("draw", F.crc32(name) % 20).filter("draw != 0")
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def in_order(turns: DataFrame) -> DataFrame:
    """The turns stored in order, with ``mark``, a number that grows in that order and nearly without gaps.

    ``turns`` has conv_id, turn, role and text. However many turns tie, they may fall into
    several partitions.
    """
    rows = turns.withColumn("role", F.coalesce("role", F.lit(" "))).withColumn("text", F.coalesce("text", F.lit(" ")))
    rows = rows.withColumns({"_start": F.substring("text", 1, TIE_CHARS), "_hash": F.xxhash64("text")})
    order = ["conv_id", "turn", "role", "_start", "_hash"]
    rows = rows.withColumn("_origin", F.spark_partition_id())
    rows = rows.repartitionByRange(*order, "_origin").sortWithinPartitions(*order, "text", "_origin")
    rows = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("mark"))
    return materialize(rows, "turns")


def with_faults(stored: DataFrame) -> DataFrame:
    """The stored turns with the first fault of each: ``blank``, ``duplicate``, ``truncated`` or NULL.

    A turn is repeated if its role and text were there before in the conversation, which
    is found from the least mark of each text; only texts that come twice are joined.
    """
    shown = F.btrim("text", F.lit(SPACES))
    rows = stored.select(
        F.col("conv_id").alias("_conv"),
        F.col("role").alias("_role"),
        F.sha2(F.col("text").cast("binary"), 256).alias("_digest"),
        F.col("mark").alias("_mark"),
    )
    again = rows.groupBy("_conv", "_role", "_digest").agg(F.min("_mark").alias("_first"), F.count("*").alias("_n"))
    again = again.filter("_n > 1").drop("_n")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
    same &= F.sha2(F.col("text").cast("binary"), 256) == F.col("_digest")
    fault = (
        F.when(shown == "", "blank")
        .when(F.col("mark") > F.col("_first"), "duplicate")
        .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return stored.join(again, same, "left").select(*stored.columns, fault.alias("fault"))


def plans(turns: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation and how it is repaired, and its turns in order.

    The first table has conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit;
    ``conversations`` (conv_id) adds conversations of which no turn is left.
    """
    ship(turns.sparkSession)
    stored = in_order(turns)
    faults = with_faults(stored)
    counts = faults.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    fault = F.when(F.col("fault") == "truncated", CUT_OFF).when(F.col("fault").isNotNull(), MUST_GO).otherwise(SOUND)
    coded = faults.select(
        "conv_id", "mark", F.floor(F.col("mark") / BLOCK_TURNS).alias("block"), _code(F.col("role"), fault).alias("code")
    )
    blocks = coded.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("mark", "code"))).alias("_coded"))
    blocks = blocks.select("conv_id", "block", F.array_join("_coded.code", "").alias("codes"))
    ends = blocks.groupBy("conv_id").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    ends = ends.toDF("_conv", "first", "last")
    blocks = blocks.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    kind = blocks.schema["conv_id"].dataType.simpleString()

    def search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, block, codes, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                table = search(codes, block == first, block == last)
                roles = [CODES[code][0] for code in codes]
                illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))
                out.append((conv, block, illegal, roles[0], roles[-1], [dict(zip(EDGE, edge)) for edge in table]))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), [batch.schema.field(0).type, *TABLE])]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "block", "illegal", "head", "tail", "edges"])

    # Long conversations have many blocks; they are dealt over all tasks.
    dealt = blocks.select("conv_id", "block", "codes", "first", "last").repartition("conv_id", "block")
    edges = "array<struct<begin:int,end:int,cost:bigint,audit:string>>"
    tables = dealt.mapInArrow(
        search_blocks, f"conv_id {kind}, block bigint, illegal bigint, head string, tail string, edges {edges}"
    )
    whole = tables.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "illegal", "head", "tail", "edges"))).alias("blocks")
    )

    def join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                parts = batch.column(1)[row].as_py()
                cost, audit = join_tables([tuple(e.values()) for e in part["edges"]] for part in parts)
                illegal = sum(part["illegal"] for part in parts)
                illegal += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(parts, parts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([illegal]), pa.array([cost]), pa.array([audit])],
                    names=["conv_id", "illegal", "cost", "audit"],
                )

    found = whole.mapInArrow(join_blocks, f"conv_id {kind}, illegal bigint, cost bigint, audit string")
    keys = (turns if conversations is None else conversations).select("conv_id").distinct().toDF("_id")
    plan = keys.join(counts.toDF("_a", *counts.columns[1:]), F.col("_id").eqNullSafe(F.col("_a")), "left")
    plan = plan.join(found.toDF("_b", *found.columns[1:]), F.col("_id").eqNullSafe(F.col("_b")), "left")
    zeros = [F.coalesce(name, F.lit(0)).alias(name) for name in COUNTS]
    return plan.select(F.col("_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit")), stored


EDGE = ("begin", "end", "cost", "audit")
_EDGE_TYPE = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
TABLE = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(_EDGE_TYPE))
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Repair:
    """Follows the audit of one conversation as its turns come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, NOTHING

    def _due(self) -> str:
        self.last = DUE[self.last]
        return "user" if self.last == USER else "assistant"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """Empty turns that stand here: edit, role, text."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._due(), ""

    def read(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What a turn becomes, after what is inserted before it."""
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.last = KEEP[self.last][role[:1]]
            yield edit, role, text
        elif edit == "R":
            yield edit, self._due(), text


def _stream(plan: DataFrame, stored: DataFrame) -> DataFrame:
    """Plans (mark NULL) and turns together, each plan right before its turns."""
    nothing = F.lit(None)
    rows = stored.select(
        "conv_id", "mark", "turn", "role", "text", *[nothing.cast("long").alias(c) for c in COUNTS], nothing.cast("string").alias("audit")
    )
    turn = stored.schema["turn"].dataType
    heads = plan.select(
        "conv_id",
        nothing.cast("long").alias("mark"),
        nothing.cast(turn).alias("turn"),
        nothing.cast("string").alias("role"),
        nothing.cast("string").alias("text"),
        *COUNTS,
        "audit",
    )
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "mark")


def repaired(turns: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, position from 0, turn, edit, role, text.

    Inserted turns have no number.
    """
    plan, stored = plans(turns)
    kinds = {name: stored.schema[name].dataType.simpleString() for name in ("conv_id", "turn")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, conv, position = None, None, 0
        for batch in batches:
            out, names = [], batch.schema.names
            columns = [batch.column(names.index(c)).to_pylist() for c in ("conv_id", "mark", "turn", "role", "text", "audit")]

            def put(found, turn):
                nonlocal position
                for edit, role, text in found:
                    out.append((conv, position, turn if edit != "I" else None, edit, role, text))
                    position += 1

            for of, mark, turn, role, text, audit in zip(*columns):
                if mark is None:
                    if repair is not None:
                        put(repair.inserts(), None)
                    repair, conv, position = _Repair(audit), of, 0
                else:
                    put(repair.read(role, text), turn)
            yield as_rows(batch, out)
        if repair is not None:
            out = []
            put(repair.inserts(), None)
            yield as_rows(batch, out)

    def as_rows(batch: pa.RecordBatch, out: list) -> pa.RecordBatch:
        types = [batch.schema.field("conv_id").type, pa.int64(), batch.schema.field("turn").type, *[pa.string()] * 3]
        columns = list(zip(*out)) or [()] * len(types)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", "position", "turn", "edit", "role", "text"]
        )

    schema = f"conv_id {kinds['conv_id']}, position bigint, turn {kinds['turn']}, edit string, role string, text string"
    return _stream(plan, stored).mapInArrow(run, schema)


def report(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The plan of each conversation and a hash of its repaired turns, ``role:text`` line by line."""
    plan, stored = plans(turns, conversations)
    kind = stored.schema["conv_id"].dataType.simpleString()
    kept = ("conv_id", *COUNTS, "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, head, digest, lines, types = None, None, None, 0, None

        def add(found) -> None:
            nonlocal lines
            for _, role, text in found:
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1

        def end() -> tuple:
            add(repair.inserts())
            return *head, digest.hexdigest()

        for batch in batches:
            names, out = batch.schema.names, []
            types = [batch.schema.field(name).type for name in kept] + [pa.string()]
            columns = {name: batch.column(name).to_pylist() for name in names}
            for row, mark in enumerate(columns["mark"]):
                if mark is None:
                    if repair is not None:
                        out.append(end())
                    head = tuple(columns[name][row] for name in kept)
                    repair, digest, lines = _Repair(head[-1]), hashlib.sha256(), 0
                else:
                    add(repair.read(columns["role"][row], columns["text"][row]))
            if out:
                yield as_rows(out, types)
        if repair is not None:
            yield as_rows([end()], types)

    def as_rows(out: list, types: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), types)], names=[*kept, "repaired_sha256"]
        )

    counted = ", ".join(f"{name} bigint" for name in COUNTS)
    return _stream(plan, stored).mapInArrow(run, f"conv_id {kind}, {counted}, audit string, repaired_sha256 string")
