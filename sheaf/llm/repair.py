"""Repair of conversations by an auction for the shortest path over an edit lattice.

A node of the lattice is a number of rows dealt with and the last role given:
none, system, user or assistant.  Its arcs are the edits of the next row (keep,
give another role, delete) and the insertion of an empty row, with integer
costs.  The auction algorithm keeps a path from the start and a price at each
node that is never more than its distance to the end: the path's last node
either gets the least of cost plus price over its arcs and leaves the path, or
is followed by the node where that least is reached.  When the end is reached,
the arcs of the path are tight at the final prices, and as the first initial
was taken wherever several were tight, the edits are the least in ASCII order
among all of least cost.

Rows are put in order by a range partitioning, so that a long conversation is
spread over tasks.  Conversations that lie within one task are repaired there;
others go in chunks: a chunk's least costs from each role to each other, the
prices at its end from the chunks behind it, and its edits for each role before
it are found by tasks of their own.  Only these costs and edits come together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from sheaf.llm.shared import map_texts, staged

#: What an edit costs; a cut-off row that is not deleted costs one more.
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: States: nothing yet, system, user, assistant.  By state, what the next given role is and what ends there cost.
_NEXT = (2, 2, 3, 2)
_ENDS = (0, 2 * INSERT, INSERT, 0)
#: A row's code: its role (0 system, 1 user, 2 assistant, 3 other), and what is wrong with it.
BLANK, REPEATED, UNFINISHED = 4, 8, 16
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows and characters of a chunk.
ROWS, CHARACTERS = 128, 1 << 22

_FAR = 1 << 60
_SPACE = " \t\n\x0b\x0c\r"


def _arcs(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at a row: initial, cost, rows forward, state; by initial."""
    to = _NEXT[state]
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, to)]
    if not code & (BLANK | REPEATED):
        more = CUT_OFF if code & UNFINISHED else 0
        role = (code & 3) + 1
        if role == to or (role == 1 and state == 0):
            arcs.append(("K", more, 1, role))
        arcs.append(("R", RENAME + more, 1, to))
    return arcs


_ARCS = {(code, state): _arcs(code, state) for code in range(32) for state in range(4)}


class Auction:
    """Shortest paths through the rows of a chunk; ``ends`` are the prices of the states behind it."""

    def __init__(self, codes: bytes, ends: tuple[int, ...]) -> None:
        self.codes = codes
        self.price = [0] * (4 * len(codes)) + list(ends)
        # The least that rows and end cost in any way: never more than a distance.
        rest = min(ends)
        for i in range(len(codes) - 1, -1, -1):
            code = codes[i]
            rest += DELETE if code & (BLANK | REPEATED) else CUT_OFF if code & UNFINISHED else 0
            self.price[4 * i : 4 * i + 4] = [rest] * 4

    def path(self, state: int) -> tuple[int, str, int]:
        """Cost, initials and last state of the least path from ``state``."""
        price, codes, end = self.price, self.codes, 4 * len(self.codes)
        at, nodes, initials = state, [], []
        while at < end:
            row = at >> 2
            least, best, node = _FAR * 2, "", 0
            for initial, cost, forward, to in _ARCS[codes[row], at & 3]:
                y = (row + forward) * 4 + to
                if cost + price[y] < least:
                    least, best, node = cost + price[y], initial, y
            if price[at] < least:
                price[at] = least
                if nodes:
                    at = nodes.pop()
                    initials.pop()
            else:
                nodes.append(at)
                initials.append(best)
                at = node
        return price[state], "".join(initials), at & 3


def costs_through(codes: bytes) -> list[int]:
    """Least cost from each state to each through a chunk, row by row; ``_FAR`` where there is no way."""
    n = len(codes)
    keeps = [CUT_OFF if c & UNFINISHED else 0 for c in codes if c & 3 == 0 and not c & (BLANK | REPEATED)]
    # Nothing, and system, are left or reached by deleting all other rows.
    to_none = [DELETE * n, _FAR, _FAR, _FAR]
    to_system = [DELETE * (n - 1) + min(keeps) if keeps else _FAR, DELETE * n, _FAR, _FAR]
    columns = [to_none, to_system]
    for role in (2, 3):
        auction = Auction(codes, tuple(0 if s == role else _FAR for s in range(4)))
        columns.append([auction.path(s)[0] for s in range(4)])
    return [columns[b][a] for a in range(4) for b in range(4)]


def edited(initials: str, state: int, roles: list, texts: list) -> tuple[list[str], int]:
    """The repaired rows ``role:text`` behind a state, and the state they lead to."""
    out, row = [], 0
    for initial in initials:
        if initial == "I":
            state = _NEXT[state]
            out.append("user:" if state == 2 else "assistant:")
            continue
        if initial == "K":
            state = 1 + "sua".index(roles[row][:1])
            out.append(f"{roles[row]}:{texts[row]}")
        elif initial == "R":
            state = _NEXT[state]
            out.append(f"{'user' if state == 2 else 'assistant'}:{texts[row]}")
        row += 1
    return out, state


def closing(state: int) -> str:
    """The insertions by which a conversation ends."""
    return "I" * (_ENDS[state] // INSERT)


def faults(codes: bytes) -> list[int]:
    """Blank, repeated and unfinished rows, and neighbours of which the second may not follow the first."""
    roles = [c & 3 for c in codes]
    return [
        sum(c & BLANK > 0 for c in codes),
        sum(c & REPEATED > 0 for c in codes),
        sum(c & UNFINISHED > 0 for c in codes),
        sum(p not in _LEGAL for p in zip(roles, roles[1:])),
    ]


class Turns:
    """Least, greatest and number of distinct turns of rows in order; null turns do not count."""

    def __init__(self) -> None:
        self.least = self.most = None
        self.n = 0

    def add(self, turn) -> None:
        if turn is not None and (self.n == 0 or turn != self.most):
            self.least = turn if self.n == 0 else self.least
            self.most, self.n = turn, self.n + 1

    def join(self, least, most, n: int) -> None:
        if n:
            self.n += n - (self.n > 0 and self.most == least)
            self.least = least if self.least is None else self.least
            self.most = most

    def gaps(self) -> int:
        return 0 if not self.n else min(int(self.most) - int(self.least) + 1 - self.n, (1 << 63) - 1)


class Chunk:
    def __init__(self, conv) -> None:
        self.conv, self.codes, self.roles, self.texts, self.turns, self.size = conv, bytearray(), [], [], Turns(), 0

    def add(self, turn, role: str, text: str, code: int) -> None:
        self.codes.append(code)
        # Texts of rows that must go are not held.
        held = not code & (BLANK | REPEATED)
        self.roles.append(role if held else None)
        self.texts.append(text if held else None)
        self.size += len(text) if held else 0
        self.turns.add(turn)

    def full(self, rows: int) -> bool:
        return len(self.codes) >= rows or self.size >= CHARACTERS


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_CHUNK = "place bigint, codes binary, roles array<string>, texts array<string>, least bigint, most bigint, turns bigint, through array<bigint>"


def rows_in_order(turns: DataFrame, *, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, code), in order over the partitions: by turn, then role and text."""
    own = turns.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    )
    # Written, so that a row has one number wherever it is read.
    rows = staged(
        own.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).withColumn("no", F.monotonically_increasing_id())
    )
    same = ["conv", "role", "digest"]
    first = (
        rows.groupBy(*same)
        .agg(F.min(F.struct("turn", "no")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(*(F.col(c).alias("f_" + c) for c in same), "first")
    )
    alike = [rows[c].eqNullSafe(first["f_" + c]) for c in same]
    marked = rows.join(first, alike[0] & alike[1] & alike[2], "left")
    repeated = F.col("first").isNotNull() & (F.col("first.no") != F.col("no"))
    trimmed = F.rtrim("text", F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(trimmed == "", F.lit(BLANK))
        .when(repeated, F.lit(REPEATED))
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), F.lit(UNFINISHED))
        .otherwise(F.lit(0))
    )
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    order = ["conv", "turn", "role", "digest", "no"]
    coded = marked.select(*order, "text", (kind + fault).alias("code"))
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "code")


def repair(
    turns: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    chunk_rows: int = ROWS,
) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The rows of a conversation are taken by turn, null turns first, those of
    one turn by role and text.  Of each row the first fault counts: blank (only
    white space), duplicate (role and text came before), truncated (its last
    character but white space is none of ``.!?``).  ``gaps`` are the turns
    missing between the least and the greatest, ``illegal`` the neighbours
    whose roles' initials are not su, ua or au.  ``audit`` has the initials of
    the cheapest edits (Keep 0, Rerole 2, Delete 3, Insert 2; blank and
    duplicate rows must go, other truncated ones cost 1 more) by which the
    initials become ``(s?(ua)+)?``, the least in ASCII order where several cost
    the same; the hash is that of the repaired ``role:text``, joined by line ends.

    A null role or text is one space, a null ``conv_id`` a conversation like
    others.  Rows repeated in full are duplicates.  An empty table gives no
    row; columns of other names are not used.
    """
    ordered = rows_in_order(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    kind = ordered.schema["conv"].dataType
    fields = StructType.fromDDL(f"whole boolean, {_RESULT}, repaired_sha256 string, {_CHUNK}").fields
    schema = StructType([StructField("conv", kind), *fields])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 36
        chunk, alone = None, False  # alone: the chunk is the conversation's first, and began in this task
        made: list[dict] = []

        def opened(chunk: Chunk) -> dict:
            nonlocal place
            place += 1
            codes, t = bytes(chunk.codes), chunk.turns
            return {
                "conv": chunk.conv, "whole": False, "place": place, "codes": codes, "roles": chunk.roles, "texts": chunk.texts,
                "least": t.least, "most": t.most, "turns": t.n, "through": costs_through(codes),
            }

        def solved(chunk: Chunk) -> dict:
            codes = bytes(chunk.codes)
            cost, initials, state = Auction(codes, _ENDS).path(0)
            audit = initials + closing(state)
            lines, _ = edited(audit, 0, chunk.roles, chunk.texts)
            blank, duplicate, truncated, illegal = faults(codes)
            return {
                "conv": chunk.conv, "whole": True, "gaps": chunk.turns.gaps(), "blank": blank, "duplicate": duplicate,
                "truncated": truncated, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": digest("\n".join(lines)),
            }

        def batch() -> pa.RecordBatch:
            columns = [pa.array([r.get(n) for r in made], type=f.type) for n, f in zip(names, arrow, strict=True)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for rows in batches:
            for conv, no, role, text, code in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if chunk is None:
                    chunk, alone = Chunk(conv), False
                elif chunk.conv != conv:
                    made.append(solved(chunk) if alone else opened(chunk))
                    chunk, alone = Chunk(conv), True
                elif chunk.full(chunk_rows):
                    made.append(opened(chunk))
                    chunk, alone = Chunk(conv), False
                chunk.add(no, role, text, code)
                if len(made) >= ROWS:
                    yield batch()
        if chunk is not None:
            # The conversation may go on in the next task.
            made.append(opened(chunk))
        if made:
            yield batch()

    found = staged(ordered.mapInArrow(run, schema), partition_by="whole")
    result = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done = found.filter("whole").select(*result).unionByName(_across_tasks(found.filter("not whole")).select(*result))
    return done.withColumnRenamed("conv", "conv_id")


def _across_tasks(chunks: DataFrame) -> DataFrame:
    """Results of conversations in several chunks."""
    kind = chunks.schema["conv"].dataType.simpleString()

    def prices(listed):
        out = {"place": [], "ends": []}
        for parts in listed:
            ends = list(_ENDS)
            for part in reversed(parts):
                out["place"].append(part["place"])
                out["ends"].append(ends)
                through = part["through"]
                ends = [min(through[4 * a + b] + ends[b] for b in range(4)) for a in range(4)]
        return out

    costs = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "through"))).alias("parts"))
    ends = map_texts(costs, ["parts"], prices, "place bigint, ends array<bigint>")

    def paths(codes, ends):
        out = {"cost": [], "initials": [], "states": []}
        for own, behind in zip(codes, ends, strict=True):
            auction = Auction(own, tuple(behind))
            cost, initials, states = zip(*(auction.path(s) for s in range(4)))
            for name, value in zip(out, (cost, initials, states), strict=True):
                out[name].append(list(value))
        return out

    slim = chunks.select("conv", "place", "codes", "least", "most", "turns").join(ends, "place")
    traced = staged(
        map_texts(
            slim, ["codes", "ends"], paths, "cost array<bigint>, initials array<string>, states array<int>",
            keep=("conv", "place", "codes", "least", "most", "turns"),
        )
    )

    def follow(listed):
        out = {n: [] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "steps")}
        for parts in listed:
            state, audit, steps, turns, sums, last = 0, [], [], Turns(), [0] * 4, None
            for part in parts:
                initials, codes = part["initials"][state], part["codes"]
                sums = [a + b for a, b in zip(sums, faults(codes), strict=True)]
                sums[3] += last is not None and (last, codes[0] & 3) not in _LEGAL
                last = codes[-1] & 3
                turns.join(part["least"], part["most"], part["turns"])
                steps.append({"place": part["place"], "initials": initials, "state": state})
                audit.append(initials)
                state = part["states"][state]
            audit.append(closing(state))
            steps[-1]["initials"] += closing(state)
            values = [turns.gaps(), *sums, parts[0]["cost"][0], "".join(audit), steps]
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return out

    listed = traced.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "codes", "least", "most", "turns", "cost", "initials", "states"))).alias("parts")
    )
    steps = "steps array<struct<place: bigint, initials: string, state: int>>"
    totals = staged(map_texts(listed, ["parts"], follow, f"{_RESULT}, {steps}", keep=("conv",)))
    each = totals.select(F.explode("steps").alias("s")).select("s.place", "s.initials", "s.state")

    def lines(initials, state, roles, texts):
        return {"lines": [edited(*own)[0] for own in zip(initials, state, roles, texts, strict=True)]}

    pieces = map_texts(
        chunks.select("conv", "place", "roles", "texts").join(each, "place"),
        ["initials", "state", "roles", "texts"], lines, "lines array<string>", keep=("conv", "place"),
    )

    schema = StructType.fromDDL(f"conv {kind}, repaired_sha256 string")
    arrow = to_arrow_schema(schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A hash reads its text in order: one task reads a conversation, and holds a chunk of it.
        now, total, any_line, begun = None, None, False, False
        for batch in batches:
            out = []
            for conv, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not begun or conv != now:
                    if begun:
                        out.append((now, total.hexdigest()))
                    now, total, any_line, begun = conv, hashlib.sha256(), False, True
                for line in lines:
                    total.update((("\n" if any_line else "") + line).encode("utf-8", "surrogatepass"))
                    any_line = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow, strict=True)], schema=arrow)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([now], arrow[0].type), pa.array([total.hexdigest()])], schema=arrow)

    digests = pieces.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "lines").mapInArrow(hashed, schema)
    digests = digests.withColumnRenamed("conv", "d_conv")
    return totals.join(digests, totals["conv"].eqNullSafe(digests["d_conv"]))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with damage by the hash of ``conv_id:turn``: rows lost, emptied, cut off, repeated, given to the user.

    Nulls are one space, also those of the columns that are returned; ``conv_id`` and ``turn`` keep theirs.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text: Column = (
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    )
    role = F.when(kind == 4, F.lit("user")).otherwise(shown("role"))
    rows = conversations.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    copies = F.explode(F.array_repeat(F.lit(True), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def repaired(conversations: DataFrame, rows: DataFrame, *, conv_id: str = "conv_id", chunk_rows: int = ROWS) -> DataFrame:
    """:func:`repair` of ``rows``, with a row for every conversation of ``conversations``; of one without rows nothing is wrong."""
    every = conversations.select(F.col(conv_id).alias("conv_id")).distinct()
    found = repair(rows, conv_id=conv_id, chunk_rows=chunk_rows).withColumnRenamed("conv_id", "r_conv")
    joined = every.join(found, every["conv_id"].eqNullSafe(found["r_conv"]), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *(F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(digest(""))).alias("repaired_sha256"),
    )
