"""Conversation structure repair by an auction shortest-path algorithm.

A conversation's turns should read, by role initials, ``(s?(ua)+)?``: nothing, or an optional system turn and then
pairs of user and assistant.  Each row may be kept (cost 0), given the role user or assistant (2) or deleted (3; blank
and repeated rows must be), an empty user or assistant row may be inserted anywhere (2), and a truncated row that is
not deleted adds 1.  The cheapest edits are a shortest path in a lattice of (row, state) nodes with integer arc costs; the states
are: nothing yet, after the system turn, after a user, after an assistant.

The auction algorithm keeps a price per node and one path from the origin.  With i the path's end, if the price of i is
below the least of (arc cost + price of the arc's end), the price rises to it and the path contracts by
i; else the path extends along the least arc.  When it reaches the end, prices are a dual solution: every arc
with price = cost + next price is tight, the shortest paths are exactly the tight ones, and the least string of
edit initials is traced through tight arcs in ASCII order.  Long conversations are solved in segments of ``SEGMENT`` rows from the last to
the first: the converged prices of a segment's first nodes are the final prices of the segment
before, so the work stays linear in the rows.  Segments with equal rows and prices are solved once per Python worker.

Rows are dealt by conversation and sorted by turn, and each task streams its sorted rows.  Of a conversation it
holds one byte per row; texts over ``HELD`` characters wait in a temporary file of the task until the edits are known, because the SHA-256 of the
repaired conversation is one sequential pass over all its rows (the one reason that a conversation, however long,
meets in one task).  Repeated rows are found before that by an aggregate over (conversation, role, text
digest) with map-side combining, so no task keeps a set of texts.

Defined results: a null id, role, text or turn reads as one space in the damage key; null roles and texts are one space, null turns come first and
stay null for gaps; a null conversation id is a conversation; rows of equal turn are ordered by role and text; an
empty role has no initial and cannot be kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innflow.llm.common import cut_lineage, ship

SEGMENT = 32
HELD = 4 << 20
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
STATES = 4
# from a state, the one role that may be inserted or given, and the state after it
NEEDED = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
FINAL = {0, 3}

# A row's code: its fault in the low bits, its initial above.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = {"s": 4, "u": 8, "a": 12}


def kept_state(state: int, initial: int) -> int | None:
    """The state after keeping a row of that initial (0: none of s, u, a), None where it cannot stand there."""
    if initial == INITIALS["s"]:
        return 1 if state == 0 else None
    if initial == INITIALS["u"]:
        return None if state == 2 else 2
    return 3 if initial == INITIALS["a"] and state == 2 else None


@lru_cache(maxsize=None)
def row_arcs(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(initial, cost, next state) of the edits that use up a row, in ASCII order."""
    fault, initial = code & 3, code & 12
    arcs = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        extra = CUT if fault == TRUNCATED else 0
        after = kept_state(state, initial)
        if after is not None:
            arcs.append(("K", KEEP + extra, after))
        arcs.append(("R", REROLE + extra, NEEDED[state][0]))
    return tuple(arcs)


class Lattice:
    """The nodes (row, state) of a segment; ``exits`` are the prices after its last row, None where a path cannot end (or go on) there."""

    def __init__(self, codes: bytes, exits: tuple[int | None, ...], last: bool):
        self.codes, self.exits, self.last = codes, exits, last
        self.end = (len(codes) + 1) * STATES
        self.price = [0] * (self.end + 1)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        row, state = divmod(node, STATES)
        out = []
        if row < len(self.codes):
            out = [(name, cost, (row + 1) * STATES + after) for name, cost, after in row_arcs(self.codes[row], state)]
        elif self.exits[state] is not None:
            out = [("", self.exits[state], self.end)]
        if row < len(self.codes) or self.last:  # between segments the next one's first row has the insertions
            out.append(("I", INSERT, row * STATES + NEEDED[state][0]))
        return sorted(out)

    def auction(self, origin: int) -> int:
        """Raises prices until the path from ``origin`` reaches the end; returns its cost.  Prices of earlier origins stay valid."""
        price, path = self.price, [origin]
        while path[-1] != self.end:
            i = path[-1]
            least, ahead = min((cost + price[j], j) for _, cost, j in self.arcs(i))
            if price[i] < least:
                price[i] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(ahead)
        return price[origin]

    def trace(self, origin: int) -> tuple[str, int]:
        """The ASCII-least edits of a shortest path from ``origin`` through tight arcs, and the state in which it leaves the last row."""
        dead: set[int] = set()
        path: list[tuple[int, Iterator]] = [(origin, iter(self.arcs(origin)))]
        names: list[str] = []
        while path[-1][0] != self.end:
            node, rest = path[-1]
            for name, cost, ahead in rest:
                if ahead not in dead and self.price[node] == cost + self.price[ahead]:
                    path.append((ahead, iter(() if ahead == self.end else self.arcs(ahead))))
                    names.append(name)
                    break
            else:  # a tight arc may lead where no tight path goes on
                dead.add(node)
                path.pop()
                names.pop()
        return "".join(names), path[-2][0] % STATES


@lru_cache(maxsize=1 << 16)
def solved(codes: bytes, exits: tuple[int | None, ...], last: bool) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """For each state before the segment: the least cost to the end, and the edits and the state after them."""
    lattice = Lattice(codes, exits, last)
    costs = tuple(lattice.auction(state) for state in range(STATES))
    return costs, tuple(lattice.trace(state) for state in range(STATES))


def cheapest(codes: bytes) -> tuple[int, str]:
    """Least cost and ASCII-least edit initials of a conversation given its rows' codes."""
    cuts = range(0, max(1, len(codes)), SEGMENT)
    exits: tuple[int | None, ...] = tuple(0 if s in FINAL else None for s in range(STATES))
    base, traces = 0, []
    for k, start in enumerate(reversed(cuts)):
        costs, edits = solved(bytes(codes[start:start + SEGMENT]), exits, not k)
        traces.append(edits)
        lowest = min(costs)
        base += lowest
        exits = tuple(c - lowest for c in costs)  # only differences matter, so equal segments meet in the cache
    state, out = 0, []
    for edits in reversed(traces):
        names, state = edits[state]
        out.append(names)
    return base + exits[0], "".join(out)


class Waiting:
    """Rows of one conversation in order, on the task's disk beyond ``HELD`` characters."""

    def __init__(self):
        self.rows: list[tuple[str, str]] = []
        self.chars, self.file = 0, None

    def add(self, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.chars += len(role) + len(text)
        if self.chars > HELD:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            pickle.dump(self.rows, self.file)
            self.rows, self.chars = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file is not None:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
            self.file.close()
        yield from self.rows


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The rows of the repaired conversation."""
    state, rows = 0, iter(rows)
    for name in audit:
        role, text = ("", "") if name == "I" else next(rows)
        if name == "D":
            continue
        if name == "K":
            state = kept_state(state, INITIALS.get(role[:1], 0))
        else:
            state, role = NEEDED[state]
        yield role, text


class Conversation:
    """What is held of a conversation while its rows pass in order of turn."""

    def __init__(self, key):
        self.key, self.codes, self.waiting = key, bytearray(), Waiting()
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        body = text.rstrip(SPACE)
        again = again or self.before == (turn, role, text)
        fault = BLANK if not body else DUPLICATE if again else TRUNCATED if body[-1] not in ".!?" else FINE
        self.codes.append(fault | INITIALS.get(role[:1], 0))
        self.faults[fault] += 1
        if self.before is not None and self.before[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            self.turns += self.high != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        self.before = (turn, role, text)
        self.waiting.add(role, text)

    def report(self) -> tuple:
        cost, audit = cheapest(bytes(self.codes))
        digest = hashlib.sha256()
        for k, (role, text) in enumerate(repaired(audit, self.waiting)):
            digest.update(f"{chr(10) * (k > 0)}{role}:{text}".encode("utf-8", "surrogatepass"))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, *(self.faults[f] for f in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, cost, audit, digest.hexdigest())


def _reported(key_type: pa.DataType):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [key_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for b in batches:
            for key, alive, turn, role, text, again in zip(*(b.column(c).to_pylist() for c in ("key", "alive", "turn", "role", "text", "again")), strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        out.append(now.report())
                    now = Conversation(key)
                if alive:
                    now.add(turn, role, text, again)
                if len(out) >= 2_000:
                    yield batch(out)
                    out = []
        if now is not None:
            out.append(now.report())
        yield batch(out)

    return report


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key, alive, turn, role, text``: every 20th row each dropped (alive false), emptied, stripped of ``.!?``, repeated or made a user's, by its key's CRC32."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    read = rows.select(F.col(conv).alias("key"), F.col(turn).cast("bigint").alias("turn"), shown(role).alias("role"), shown(text).alias("text"),
                       (F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn))) % 20).alias("_k"))
    k = F.col("_k")
    body = F.when(k == 1, F.lit("")).when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = read.select("key", (k != 0).alias("alive"), "turn", F.when(k == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), body.alias("text"),
                          F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return changed.drop("_copy")


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``damaged`` rows: faults, cost and initials of the cheapest edits, digest of the repaired conversation."""
    ship(rows.sparkSession)
    digest, when = F.md5(F.col("text").cast("binary")), F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    # texts that one conversation has at two turns or more; equal rows of one turn lie side by side later
    seen = rows.where("alive").where(F.btrim(F.col("text"), F.lit(SPACE)) != "").groupBy(F.col("key").alias("_key"), F.col("role").alias("_role"), digest.alias("_digest")).agg(
        F.min(when).alias("_first"), F.max(when).alias("_last")).where("_first < _last").drop("_last")
    seen = cut_lineage(seen, "conversation-repeats")
    marked = rows.join(seen, rows["key"].eqNullSafe(F.col("_key")) & (rows["role"] == F.col("_role")) & (digest == F.col("_digest")) & F.col("alive"), "left")
    marked = marked.select("key", "alive", "turn", "role", "text", F.coalesce(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn")) > F.col("_first"), F.lit(False)).alias("again"))
    ordered = marked.repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text")
    kind = rows.schema["key"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_type

    return ordered.mapInArrow(_reported(to_arrow_type(kind)), schema)
