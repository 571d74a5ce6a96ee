"""Damage to conversations, its faults, and the cheapest repair, found by an auction for shortest paths."""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sitebooks.runtime import materialise

# --- fixed values of the contract --------------------------------------------------
PARTS = 20  # crc32 of "conv_id:turn" modulo this: 0 drops, 1 empties, 2 strips stops, 3 repeats, 4 makes it the user's
STOPS = "[.!?]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
# -----------------------------------------------------------------------------------

#: States of the wanted form (s?(ua)+)?: nothing yet, behind a system row, behind a user row, behind an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: State a kept row leads to, by state and initial, and state that an inserted or re-roled row leads to.
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
NEXT = (USER, USER, ASSISTANT, USER)
#: What the end of a conversation costs in each state, and the edits it takes: the form ends with nothing or an assistant row.
ENDS, CLOSING = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
FAR = 1 << 40  # no way
#: Rows of a lattice solved at once, rows and characters of a segment, and lattices a task remembers.
LATTICE, SEGMENT, CHARS, REMEMBER = 24, 512, 1 << 20, 20_000


class Lattice:
    """The edits of a few rows as arcs between (row, state), and node prices found by auction.

    ``codes`` has one number per row: initial (3: another) + 4 if it must go +
    8 if truncated.  Node ``4 * row + state``; the last node is the target,
    reached from the four states behind the last row at the costs ``ends``.
    Rows are inserted before a row; behind the last one what follows does it.
    """

    def __init__(self, codes: bytes, ends: tuple[int, ...]):
        self.rows = len(codes)
        self.target = 4 * (self.rows + 1)
        self.arcs: list[list[tuple[str, int, int]]] = []  # by node: letter, cost, next node
        for i, code in enumerate(codes):
            initial, gone, kept = code & 3, code & 4, TRUNCATED if code & 8 else 0
            for state in range(4):
                here = [("D", DELETE, 4 * (i + 1) + state), ("I", INSERT, 4 * i + NEXT[state])]
                if not gone:
                    if (to := KEPT.get((state, initial))) is not None:
                        here.append(("K", KEEP + kept, 4 * (i + 1) + to))
                    here.append(("R", REROLE + kept, 4 * (i + 1) + NEXT[state]))
                self.arcs.append(here)
        self.arcs += [[("", cost, self.target)] for cost in ends]
        self.price = [0] * (self.target + 1)
        if min(ends[USER], ends[ASSISTANT]) >= FAR:  # user and assistant states lead to each other only, thus nowhere
            for node in range(self.target):
                if node % 4 in (USER, ASSISTANT):
                    self.price[node] = FAR

    def auction(self, origin: int) -> int:
        """The length of a shortest path from ``origin`` to the target.

        Prices keep ``price[i] <= cost + price[j]`` on all arcs, with equality
        along the path.  If the path's last node is cheaper than its best arc,
        its price rises to that arc and the path shrinks by the node; else the
        path grows by the arc.  When the path reaches the target (price 0), the
        origin's price is the distance.  Prices stay right for further origins.
        """
        price, arcs, path = self.price, self.arcs, [origin]
        while path[-1] != self.target:
            node = path[-1]
            best, to = min((cost + price[j], j) for _, cost, j in arcs[node])
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[origin]

    def tight(self) -> list[list[tuple[str, int]]]:
        """By node the arcs without slack that lead on to the target: those of shortest paths."""
        price = self.price
        alive = [False] * self.target + [True]
        out: list[list[tuple[str, int]]] = [[] for _ in range(self.target + 1)]
        # Arcs lead to later rows, or by an insertion to another state of the row; three rounds see every chain of them.
        for i in range(self.rows, -1, -1):
            for _ in range(3):
                for node in range(4 * i, 4 * i + 4):
                    out[node] = [(x, j) for x, cost, j in self.arcs[node] if alive[j] and price[node] == cost + price[j]]
                    alive[node] = bool(out[node])
        return out

    def trace(self, state: int, tight: list[list[tuple[str, int]]]) -> tuple[str, int]:
        """The least word of letters along shortest paths from a state before the first row, and the state at the end.

        From a node each letter leads to one other node, so the least letter at
        each step gives the least word.
        """
        node, letters = state, []
        while True:
            letter, to = min(tight[node])
            if to == self.target:
                return "".join(letters), node - 4 * self.rows
            letters.append(letter)
            node = to


@lru_cache(REMEMBER)
def prices(codes: bytes, ends: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end from each state before the rows of one lattice."""
    lattice = Lattice(codes, ends)
    return tuple(lattice.auction(state) for state in range(4))


@lru_cache(REMEMBER)
def edits(codes: bytes, ends: tuple[int, ...]) -> tuple[tuple[str, int], ...]:
    """The cheapest edits of one lattice from each state before it, with the state they lead to."""
    lattice = Lattice(codes, ends)
    for state in range(4):
        lattice.auction(state)
    tight = lattice.tight()
    return tuple(lattice.trace(state, tight) for state in range(4))


def chained(codes: bytes, ends: tuple[int, ...], rows: int):
    """Lattices of any number of rows from the last on; the prices before one are the ends of the one before it.

    Gives each lattice's rows and ends, and last the costs before all rows.
    Only differences of ends matter, and small numbers need few bids.
    """
    made, shift = [], 0
    for a in reversed(range(0, len(codes), rows)):
        low = min(ends)
        shift += low
        ends = tuple(e - low if e < FAR else FAR for e in ends)
        made.append((codes[a : a + rows], ends))
        ends = tuple(min(e, FAR) for e in prices(*made[-1]))
    return made[::-1], tuple(min(e + shift, FAR) for e in ends)


def solved(codes: bytes, ends: tuple[int, ...], rows: int = LATTICE) -> tuple[tuple[int, ...], list[tuple[str, int]]]:
    """Costs of a run of rows from each state before it, and the cheapest edits from there with the state they lead to."""
    parts, costs = chained(codes, ends, rows)
    traces, out = [edits(*part) for part in parts], []
    for state in range(4):
        letters = []
        for trace in traces:
            part, state = trace[state]
            letters.append(part)
        out.append(("".join(letters), state))
    return costs, out


def matrix(codes: bytes, rows: int = LATTICE) -> list[int]:
    """Costs of a run of rows from each state before it to each state behind it, as 16 numbers."""
    columns = [chained(codes, tuple(0 if k == e else FAR for k in range(4)), rows)[1] for e in range(4)]
    return [columns[e][state] for state in range(4) for e in range(4)]


# --- rows --------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times`` of the rows after damage; a repeated row has ``times`` 2.  Null role and text are one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    luck = F.pmod(F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")), F.lit(PARTS))
    text = F.when(luck == 1, "").when(luck == 2, F.regexp_replace(word("text"), STOPS, "")).otherwise(word("text"))
    return conversations.where(luck != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(luck == 4, "user").otherwise(word("role")).alias("role"),
        text.alias("text"),
        F.when(luck == 3, 2).otherwise(1).cast("long").alias("times"),
    )


SEGMENTS = (
    "part long, seg long, roles array<string>, texts array<string>, digests array<binary>, codes binary, copies array<long>, "
    "distinct long, low long, high long"
)
GONE, CUT, EMPTY, TWICE = 4, 8, 16, 32  # bits of a row's code: must go, truncated, blank, duplicate
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def code(role: str, text: str) -> int:
    """Initial and faults of a row by itself."""
    initial = INITIALS.find(role[:1]) if role else -1
    end = text.rstrip(SPACE)[-1:]
    return (3 if initial < 0 else initial) + (GONE + EMPTY if not end else 0 if end in ".!?" else CUT)


def duplicate(code: int) -> int:
    return code if code & EMPTY else code & ~CUT | GONE | TWICE


def segments(rows: DataFrame, most: int = SEGMENT) -> DataFrame:
    """Rows of a conversation in order, in segments of bounded size, numbered by ``part`` and ``seg`` in order.

    Rows are ordered by conversation, turn (nulls first), role and text.  Each
    task gets a range of that order, so a conversation of any length is spread
    over tasks.  Equal rows are counted before they move: ``copies`` says how
    many rows one stands for; where these fill more than a segment, the further
    ones have no text.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    keys = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role")]
    ordered = counted.repartitionByRange(*keys, F.substring("text", 1, 200).asc()).sortWithinPartitions(*keys, F.asc("text"))
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string(SEGMENTS).fields])

    def run(batches):
        part, seg = TaskContext.get().partitionId(), 0
        conv, held, size, chars = None, [], 0, 0

        def segment():
            turns = {r[0] for r in held if r[0] is not None}
            columns = [conv, part, seg, [r[1] for r in held], [r[2] for r in held], [r[3] for r in held]]
            columns += [bytes(r[4] for r in held), [r[5] for r in held], len(turns), min(turns, default=None), max(turns, default=None)]
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.binary())]
            kinds += [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
            for own, turn, role, text, times in zip(*[c.to_pylist() for c in batch.columns]):
                if held and own != conv:
                    yield segment()
                    seg, held, size, chars = seg + 1, [], 0, 0
                conv = own
                kind = code(role, text)
                digest = None if kind & EMPTY else sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
                while times:
                    if size >= most or chars >= CHARS:
                        yield segment()
                        seg, held, size, chars = seg + 1, [], 0, 0
                    some = min(times, most - size)
                    held.append((turn, role, text, digest, kind, some))
                    size, chars, times = size + some, chars + len(text or ""), times - some
                    role, text, digest, kind = None, None, None, duplicate(kind)
        if held:
            yield segment()

    return ordered.mapInArrow(run, schema)


def coded(table: DataFrame, lattice: int = LATTICE) -> DataFrame:
    """Per segment one code for each row, all faults known, and the costs of passing it from state to state.

    A row is a duplicate if its role and text are in an earlier row of the
    conversation: the first place of each content is an aggregate, and only
    digests and places move.
    """
    place = F.struct("part", "seg", "i")
    rows = table.select("conv_id", "part", "seg", F.posexplode("digests").alias("i", "digest")).where("digest is not null")
    first = rows.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("k")).where("k > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    later = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).where(place > F.col("first"))
    later = later.groupBy(F.col("part").alias("p"), F.col("seg").alias("s")).agg(F.collect_list("i").alias("later"))
    light = table.select("conv_id", "part", "seg", "codes", "copies", "distinct", "low", "high")
    light = light.join(later, (F.col("part") == F.col("p")) & (F.col("seg") == F.col("s")), "left").drop("p", "s")
    made = (
        "part long, seg long, distinct long, low long, high long, codes binary, matrix array<long>, blank long, duplicate long, "
        "truncated long, illegal long, first string, last string"
    )
    schema = T.StructType([table.schema["conv_id"], *T._parse_datatype_string(made).fields])

    def run(batches):
        for batch in batches:
            out = []
            for codes, copies, later in zip(*[batch.column(i).to_pylist() for i in (3, 4, 8)]):
                codes = bytearray(codes)
                for i in later or []:
                    codes[i] = duplicate(codes[i])
                full = b"".join(bytes([c]) + bytes([duplicate(c)]) * (k - 1) for c, k in zip(codes, copies))
                kinds = np.frombuffer(full, np.uint8)
                initials = "".join((INITIALS + "?")[c & 3] for c in full)
                illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
                counts = [int(np.count_nonzero(kinds & bit)) for bit in (EMPTY, TWICE, CUT)]
                plain = bytes(c & 15 for c in full)
                out.append((plain, matrix(plain, lattice), *counts, illegal, initials[0], initials[-1]))
            columns = list(zip(*out)) if out else [()] * 8
            kinds = [pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *batch.columns[5:8], *made], names=schema.names)

    return light.mapInArrow(run, schema)


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def in_order(rows: DataFrame, down: bool = False) -> DataFrame:
    """Each conversation's segments in one task, one behind the other; a task reads them as a stream."""
    order = [F.desc(c) if down else F.asc(c) for c in ("part", "seg")]
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def batched(rows, kinds, names, size=500):
    """Record batches of tuples."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def ending(segs: DataFrame) -> DataFrame:
    """``(part, seg, ends)``: what the rest of the conversation costs from each state behind a segment."""

    def run(batches):
        def rows():
            conv, ends = object(), ENDS
            for batch in batches:
                for own, part, seg, costs in zip(*[c.to_pylist() for c in batch.columns]):
                    if own != conv:
                        conv, ends = own, ENDS
                    yield part, seg, list(ends)
                    ends = tuple(min(costs[4 * state + e] + ends[e] for e in range(4)) for state in range(4))

        yield from batched(rows(), [pa.int64(), pa.int64(), pa.list_(pa.int64())], ["part", "seg", "ends"])

    return in_order(segs.select("conv_id", "part", "seg", "matrix"), down=True).mapInArrow(run, "part long, seg long, ends array<long>")


def chosen(segs: DataFrame, ends: DataFrame, lattice: int = LATTICE) -> DataFrame:
    """``(part, seg, state, edits, cost)``: the state before each segment, its edits, and the cost of all from here on."""
    told = segs.select("conv_id", "part", "seg", "codes").join(
        ends.select(F.col("part").alias("p"), F.col("seg").alias("s"), "ends"), (F.col("part") == F.col("p")) & (F.col("seg") == F.col("s"))
    )
    kind = segs.schema["conv_id"]
    schema = T.StructType([kind, *T._parse_datatype_string("part long, seg long, costs array<long>, words array<string>, next array<int>").fields])

    def solve(batches):
        for batch in batches:
            out = [solved(codes, tuple(ends), lattice) for codes, ends in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            made = [
                pa.array([list(costs) for costs, _ in out], pa.list_(pa.int64())),
                pa.array([[w for w, _ in ways] for _, ways in out], pa.list_(pa.string())),
                pa.array([[s for _, s in ways] for _, ways in out], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=schema.names)

    ways = told.select("conv_id", "part", "seg", "codes", "ends").mapInArrow(solve, schema)

    def follow(batches):
        def rows():
            conv, state = object(), START
            for batch in batches:
                for own, part, seg, costs, words, after in zip(*[c.to_pylist() for c in batch.columns]):
                    if own != conv:
                        conv, state = own, START
                    yield part, seg, state, words[state], costs[state]
                    state = after[state]

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
        yield from batched(rows(), kinds, ["part", "seg", "state", "edits", "cost"])

    return in_order(ways).mapInArrow(follow, "part long, seg long, state int, edits string, cost long")


def apply(state: int, edits: str, roles: list, texts: list, copies: list) -> tuple[list[tuple[str, str]], int]:
    """The rows that edits leave of a segment, and the state behind them."""
    rows, out = iter([(r, t) for r, t, k in zip(roles, texts, copies) for r, t in [(r, t), *[(None, None)] * (k - 1)]]), []
    for letter in edits:
        if letter == "I":
            role, text = None, ""
        else:
            role, text = next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = KEPT[state, INITIALS.index(role[:1])]
        else:
            state = NEXT[state]
            role = ROLES["ua"[state - USER]]
        out.append((role, text))
    return out, state


def repaired(conversations: DataFrame, most: int = SEGMENT, lattice: int = LATTICE) -> DataFrame:
    """Pieces of damaged conversations with their faults and cheapest repair.

    One row per piece (at most ``most`` rows of a conversation): ``conv_id, part,
    seg`` (its order), ``edits`` (initials of Keep, Rerole, Delete, Insert),
    ``rows`` (role and text of what is left), ``cost`` (of all edits from here
    on), counts of faults, and turns.  The wanted form is ``(s?(ua)+)?`` in
    initials of roles; edits are the cheapest that give it, of equally cheap
    ones the least in ASCII order.

    Edits are arcs of a lattice of row and state with integer costs.  An auction
    raises node prices until they are the distances to the end; the arcs
    without slack on shortest paths are then followed by least letter.  Small
    lattices are solved one behind the other; the cost of a piece from state
    to state (4 x 4) is all that its neighbours need, so pieces of one
    conversation are solved by many tasks.

    Null roles and texts are one space (and in the damage a null id or turn
    too); rows with a null id are one conversation; rows of equal turn are
    ordered by role and text; repeated rows are duplicates; texts of any
    length are kept whole; a conversation that loses all rows has no piece; an
    empty table gives none; other columns are ignored.
    """
    table = materialise(segments(damaged(conversations), most), "turns")
    segs = materialise(coded(table, lattice), "turn-codes")
    ways = materialise(chosen(segs, ending(segs), lattice), "turn-edits")
    same = lambda a, b: (F.col(f"{a}.part") == F.col(f"{b}.part")) & (F.col(f"{a}.seg") == F.col(f"{b}.seg"))
    facts = segs.drop("codes", "matrix").alias("f").join(ways.alias("w"), same("f", "w"))
    facts = facts.select("f.*", "state", "edits", "cost").alias("g")
    full = table.select("part", "seg", "roles", "texts", "copies").alias("t").join(facts, same("t", "g")).select("g.*", "roles", "texts", "copies")
    keep = [f for f in full.schema.fields if f.name not in ("roles", "texts", "copies")]
    schema = T.StructType([*keep, *T._parse_datatype_string("rows array<struct<role: string, text: string>>, after int").fields])
    at = [full.columns.index(c) for c in ("state", "edits", "roles", "texts", "copies")]

    def run(batches):
        for batch in batches:
            out = [apply(*row) for row in zip(*[batch.column(i).to_pylist() for i in at])]
            rows = pa.array([[{"role": r, "text": t} for r, t in rows] for rows, _ in out], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))
            made = [*batch.columns[: len(keep)], rows, pa.array([s for _, s in out], pa.int32())]
            yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return full.mapInArrow(run, schema)


def digest(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, cost, all edits, and a checksum of the repaired rows.

    A checksum needs a conversation's rows in order, so its pieces pass through
    one task as a stream, of which only sums and the checksum's state are held.
    """
    schema = T.StructType(
        [
            pieces.schema["conv_id"],
            *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )
    read = ["conv_id", "part", "seg", "distinct", "low", "high", "blank", "duplicate", "truncated", "illegal", "first", "last", "cost", "edits", "after", "rows"]

    def run(batches):
        def rows():
            conv, now = object(), None

            def close():
                for letter in CLOSING[now["state"]]:
                    now["audit"].append(letter)
                    add({USER: "assistant:", SYSTEM: "user:"}[now["state"]])
                    now["state"] = NEXT[now["state"]]
                gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["distinct"]
                return (conv, gaps, *now["counts"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest())

            def add(line):
                now["sha"].update((line if now["fresh"] else "\n" + line).encode("utf-8", "surrogatepass"))
                now["fresh"] = False

            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for own, _, _, distinct, low, high, blank, twice, cut, illegal, first, last, cost, edits, after, left in zip(*columns):
                    if now is None or own != conv:
                        if now is not None:
                            yield close()
                        conv = own
                        now = {"low": None, "high": None, "distinct": 0, "counts": [0] * 4, "cost": cost, "audit": [], "sha": sha256(), "fresh": True, "last": None}
                    if low is not None:
                        now["distinct"] += distinct - (now["high"] == low)
                        now["low"] = low if now["low"] is None else now["low"]
                        now["high"] = high
                    illegal += now["last"] is not None and not legal(now["last"], first)
                    now["counts"] = [a + b for a, b in zip(now["counts"], (blank, twice, cut, illegal))]
                    now["audit"].append(edits)
                    now["last"], now["state"] = last, after
                    for row in left:
                        add(f"{row['role']}:{row['text']}")
            if now is not None:
                yield close()

        kinds = [*kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        yield from batched(rows(), kinds, schema.names)

    kind = [to_arrow_type(pieces.schema["conv_id"].dataType)]
    found = in_order(pieces.select(*read)).mapInArrow(run, schema)
    every = conversations.select(F.col("conv_id").alias("c")).distinct()
    joined = every.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("c").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
