"""Conversation structure repair by the cheapest edits, with an audit of them.

Rows of a conversation, in order of their turn, should read
``(s?(ua)+)?`` in role initials.  The edits are: keep a row (K, free), give it
the role user or assistant (R), delete it (D; required for blank and duplicate
rows) and insert an empty turn of user or assistant (I).  Rows that look
truncated cost extra unless they are deleted.

Edit lattice.  A node is a number of rows consumed and a state (nothing yet,
or the last initial); edits are edges.  A forward search from the first node
and a reverse search from the goals, each with a heap ordered by cost and
rows, hold every node's least cost and, among equal costs, its least audit.  They
meet when their costs add up to the best crossing; all crossings of that cost
are finished, and the least concatenated audit is taken.  Two audits of one
cost between the same nodes never are prefixes of each other, so least parts
make the least whole; and an audit determines the repaired roles, as a role in
``s?(ua)+`` follows from its place.

1. Rows become narrow: ids, turn, role, a 128-bit digest of role and text, and
   the faults that the text shows alone.  Equal rows are counted (partial counts
   first), so a row repeated ever so often is one row with a number.
2. A text is a duplicate after its first turn: first turns are an aggregate, and
   only those of repeated texts are joined back.
3. Narrow rows are dealt by ranges of (conversation, turn), so a conversation with a
   third of all rows is spread over many tasks.  Each task reduces its part of a
   conversation to the cheapest audits between any two states: a whole
   conversation to one, a part of a longer one to a table of at most 16, made by
   the same searches over blocks of rows, then over blocks of blocks.
4. The texts are dealt by conversation, in order, behind its parts.  A task joins
   the parts' tables by one more search and streams the texts through the audit into
   the digest of the repaired conversation.  One digest has to see one
   conversation's texts in order: this step is as long as the longest
   conversation, but holds only its audit and one batch of texts.

Cases: a null id is a conversation of its own; null turns come first and count
as no turn; rows of one turn stand in order of their roles, then digests; null
roles and texts are one space; an empty role has no initial and is never legal;
repeated rows are duplicates; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_few, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: A state: nothing yet, or the initial of the last row.  What may follow it, and which states may end.
START = ""
FOLLOWS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
STATES = tuple(FOLLOWS)
GOALS = ("", "a")
#: Rows of one search; longer parts are joined by searches over the tables of such blocks.
BLOCK = 256
#: Distinct sequences of rows whose audits a worker remembers.
REMEMBERED = 50_000

WHITE = "\\x20\\x09-\\x0D"
INTACT, BLANK, CUT, DOUBLE = "", "blank", "truncated", "duplicate"


# -- the searches -----------------------------------------------------------
def row_edges(initial: str, fault: str, copies: int = 1):
    """Edges (from, to, cost, audit) over one row and its further copies, which are duplicates."""
    more, rest = DELETE * (copies - 1), "D" * (copies - 1)
    out = [(q, q, DELETE + more, "D" + rest) for q in STATES]
    if fault in (INTACT, CUT):
        extra = (TRUNCATED if fault == CUT else 0) + more
        for q, after in FOLLOWS.items():
            if initial in after:
                out.append((q, after[initial], KEEP + extra, "K" + rest))
            out += [(q, after[r], REROLE + extra, "R" + rest) for r in ROLES if r in after]
    return out


INSERTS = [(q, after[r], INSERT, "I") for q, after in FOLLOWS.items() for r in ROLES if r in after]


def _least(held, node, cost, audit):
    """Whether (cost, audit) is better than what is held for the node; an audit is a tuple of parts."""
    if node not in held:
        return True
    known_cost, known = held[node]
    return cost < known_cost or cost == known_cost and "".join(audit) < "".join(known)


class _Side:
    """One direction of the search: a heap, and the settled and open nodes' cost and least audit."""

    def __init__(self, sources, edges, sign: int):
        self.edges, self.sign = edges, sign
        self.held, self.settled = {n: (0, ()) for n in sources}, set()
        # Free edges always consume a row: in order of cost, then rows, a node's equals before it are settled.
        self.heap = [(0, sign * i, q) for i, q in sources]
        heapq.heapify(self.heap)

    def cost(self):
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self):
        """Settle the next node; the nodes whose labels were made or bettered."""
        cost, place, state = heapq.heappop(self.heap)
        node = (self.sign * place, state)
        self.settled.add(node)
        audit = self.held[node][1]
        for other, more, part in self.edges(*node):
            joined = (*audit, part) if self.sign > 0 else (part, *audit)
            if _least(self.held, other, cost + more, joined):
                self.held[other] = (cost + more, joined)
                heapq.heappush(self.heap, (cost + more, self.sign * other[0], other[1]))
                yield other


def search(layers, start: str, goals) -> tuple[int, str] | None:
    """Least cost and audit from ``start`` before the first layer to one of ``goals`` behind the last.

    A layer is a list of edges (from, to, cost, audit); inserts stand between layers as well."""
    n = len(layers)
    ahead, behind = [], []
    for layer in layers:
        out, back = {}, {}
        for a, b, cost, part in layer:
            out.setdefault(a, []).append((b, cost, part))
            back.setdefault(b, []).append((a, cost, part))
        ahead.append(out)
        behind.append(back)

    def forward(i, q):
        for a, b, cost, part in INSERTS:
            if a == q:
                yield (i, b), cost, part
        if i < n:
            for b, cost, part in ahead[i].get(q, ()):
                yield (i + 1, b), cost, part

    def reverse(i, q):
        for a, b, cost, part in INSERTS:
            if b == q:
                yield (i, a), cost, part
        if i:
            for a, cost, part in behind[i - 1].get(q, ()):
                yield (i - 1, a), cost, part

    sides = _Side([(0, start)], forward, 1), _Side([(n, g) for g in goals], reverse, -1)
    best = min((0 for x in sides[0].held if x in sides[1].held), default=None)
    while None not in (costs := [s.cost() for s in sides]):
        # Beyond the best cost nothing is left to meet.  Every route of that cost then leaves the nodes settled
        # ahead for one settled behind, so their labels hold the least audits of both its parts.
        if best is not None and sum(costs) > best:
            break
        side, other = sides if costs[0] <= costs[1] else reversed(sides)
        for node in side.settle():
            if node in other.held:
                met = side.held[node][0] + other.held[node][0]
                best = met if best is None else min(best, met)
    if best is None:
        return None
    (ahead, behind) = (s.held for s in sides)
    return best, min("".join(ahead[x][1] + behind[x][1]) for x in ahead
                     if x in behind and ahead[x][0] + behind[x][0] == best)


def table_of(layers) -> list[tuple[str, str, int, str]]:
    """The layers as one: edges between any two states."""
    out = []
    for a in STATES:
        for b in STATES:
            if (found := search(layers, a, (b,))) is not None:
                out.append((a, b, *found))
    return out


def whole(layers) -> tuple[int, str]:
    """The cheapest repair: least cost and audit.  Everything may be deleted, so there is one."""
    while len(layers) > BLOCK:
        layers = [table_of(layers[k:k + BLOCK]) for k in range(0, len(layers), BLOCK)]
    return search(layers, START, GOALS)


def reduced(layers) -> list[tuple[str, str, int, str]]:
    while len(layers) > BLOCK:
        layers = [table_of(layers[k:k + BLOCK]) for k in range(0, len(layers), BLOCK)]
    return table_of(layers)


@functools.lru_cache(maxsize=REMEMBERED)
def _repair_of(rows: tuple) -> tuple[int, str]:
    return whole([row_edges(*r) for r in rows])


# -- faults and damage ------------------------------------------------------
def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{WHITE}]")


def is_cut(text: Column) -> Column:
    """The last character that is no white space ends no sentence."""
    return text.rlike(f"[^{WHITE}]") & ~text.rlike(f"[.!?][{WHITE}]*\\z")


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _narrow(rows: DataFrame) -> DataFrame:
    text = F.col("text")
    fault = F.when(is_blank(text), BLANK).when(is_cut(text), CUT).otherwise(INTACT)
    return rows.select("conv", "turn", "role", F.xxhash64("role", "text").alias("d1"),
                       F.xxhash64(F.lit(1), "text", "role").alias("d2"), fault.alias("fault"))


KEYS = ("turn", "role", "d1", "d2")


def _faulty(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and first fault."""
    counted = written(_narrow(rows).groupBy("conv", *KEYS).agg(F.count(F.lit(1)).alias("copies"),
                                                               F.first("fault").alias("fault")))
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    several = written(counted.groupBy("conv", "d1", "d2").agg(first, F.count(F.lit(1)).alias("turns"))
                      .filter("turns > 1").select("conv", "d1", "d2", "first.turn"))
    c, f = counted.alias("c"), broadcast_if_few(several).alias("f")
    met = c.join(f, F.col("c.conv").eqNullSafe(F.col("f.conv")) & (F.col("c.d1") == F.col("f.d1"))
                 & (F.col("c.d2") == F.col("f.d2")), "left")
    # Without a match both first values are null, and so is nothing that was joined: d1 tells.
    again = F.col("f.d1").isNotNull() & ~F.col("c.turn").eqNullSafe(F.col("f.turn")) & (F.col("c.fault") != BLANK)
    return met.select("c.conv", *[f"c.{k}" for k in KEYS], "c.copies",
                      F.when(again, DOUBLE).otherwise(F.col("c.fault")).alias("fault"))


# -- parts ------------------------------------------------------------------
class _Part:
    """What a task knows of its rows of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.layers = conv, [], []
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn, role, copies, fault):
        initial = role[:1]
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        # Copies of one row stand side by side: no initial may follow itself.
        self.illegal += copies - 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.n += copies
        if fault == BLANK:
            self.blank += copies
        else:
            self.duplicate += copies - (fault != DOUBLE)
            self.truncated += fault == CUT
        self.rows.append((initial, BLANK if fault == DOUBLE else fault, copies))
        if len(self.rows) == BLOCK:
            self.fold()

    def fold(self):
        """Rows held so far become a table; so many tables become one."""
        if self.rows:
            self.layers.append(table_of([row_edges(*r) for r in self.rows]))
            self.rows = []
        if len(self.layers) == BLOCK:
            self.layers = [table_of(self.layers)]

    def result(self, number: int, edge: bool) -> dict:
        """``edge``: the conversation may go on in another task."""
        if edge:
            self.fold()
            paths = reduced(self.layers)
        elif self.layers:
            self.fold()
            paths = [("", "", *whole(self.layers))]
        else:
            paths = [("", "", *_repair_of(tuple(self.rows)))]
        return {"conv": self.conv, "number": number, "edge": edge, "stats": json.dumps(
            [self.n, self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.first_turn,
             self.last_turn, self.first, self.last]),
            "paths": [dict(zip(("a", "b", "cost", "audit"), p, strict=True)) for p in paths]}


PATHS = "array<struct<a:string,b:string,cost:bigint,audit:string>>"
PART = f"conv bigint, number int, edge boolean, stats string, paths {PATHS}"
_PART = pa.schema([("conv", pa.int64()), ("number", pa.int32()), ("edge", pa.bool_()), ("stats", pa.string()),
                   ("paths", pa.list_(pa.struct([("a", pa.string()), ("b", pa.string()), ("cost", pa.int64()),
                                                 ("audit", pa.string())])))])


def _parts(rows: DataFrame) -> DataFrame:
    """One row for each conversation and task that holds rows of it."""

    def run(batches):
        part, first, done, number = None, True, [], 0
        for batch in batches:
            number = batch.column("number")[0].as_py() if len(batch) else number
            for conv, turn, role, copies, fault in zip(*[batch.column(c).to_pylist() for c in (
                    "conv", "turn", "role", "copies", "fault")], strict=True):
                if part is None or conv != part.conv:
                    if part is not None:
                        done.append(part.result(number, first))
                        first = False
                    part = _Part(conv)
                part.add(turn, role, copies, fault)
            if len(done) > 1000:
                yield pa.RecordBatch.from_pylist(done, _PART)
                done = []
        if part is not None:
            # The first and last conversation of a task may have rows in other tasks.
            done.append(part.result(number, True))
        if done:
            yield pa.RecordBatch.from_pylist(done, _PART)

    keys = ["conv", *KEYS]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return dealt.withColumn("number", F.spark_partition_id()).mapInArrow(run, PART)


def joined_stats(stats: list[str]) -> dict:
    """The numbers of a conversation from those of its parts, in order."""
    n = blank = duplicate = truncated = illegal = turns = 0
    low = high = last = None
    for s in map(json.loads, stats):
        if n:
            illegal += last + s[8] not in ("su", "ua", "au")
            turns -= high is not None and s[6] == high
        n, blank, duplicate, truncated, illegal, turns = (
            n + s[0], blank + s[1], duplicate + s[2], truncated + s[3], illegal + s[4], turns + s[5])
        if s[6] is not None:
            low, high = s[6] if low is None else low, s[7]
        last = s[9]
    return {"rows": n, "gaps": 0 if low is None else high - low + 1 - turns, "blank": blank, "duplicate": duplicate,
            "truncated": truncated, "illegal": illegal}


# -- applying the audit -----------------------------------------------------
class _Repaired:
    """Streams a conversation's rows through its audit into the digest of what is left."""

    def __init__(self, conv, parts):
        self.conv, self.stats = conv, joined_stats([p["stats"] for p in parts])
        if len(parts) == 1 and not parts[0]["edge"]:
            self.cost, self.audit = parts[0]["paths"][0]["cost"], parts[0]["paths"][0]["audit"]
        else:
            self.cost, self.audit = whole([[(p["a"], p["b"], p["cost"], p["audit"]) for p in part["paths"]] for part in parts])
        self.digest, self.at, self.state, self.begun = hashlib.sha256(), 0, START, False

    def _put(self, role: str, text: str):
        # Lone surrogates can't stand in a column's UTF-8, so every text can be encoded.
        self.digest.update((("\n" if self.begun else "") + role + ":" + text).encode())
        self.begun, self.state = True, role[:1]

    def _next(self) -> str:
        return ROLES["a" if self.state == "u" else "u"]

    def inserts(self):
        while self.audit[self.at:self.at + 1] == "I":
            self._put(self._next(), "")
            self.at += 1

    def row(self, role: str, text: str):
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
        elif edit == "R":
            self._put(self._next(), text)

    def result(self) -> dict:
        self.inserts()
        if self.at != len(self.audit):
            raise ValueError(f"conversation {self.conv}: the audit doesn't fit its rows")
        return {"conv_id": self.conv, **self.stats, "cost": self.cost, "audit": self.audit,
                "repaired_sha256": self.digest.hexdigest()}


RESULT = ("conv_id bigint, rows bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")
_RESULT = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in (
    "rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
    ("repaired_sha256", pa.string())])


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row for each conversation: faults, ``cost`` and ``audit`` of the cheapest edits, digest of the repaired text."""
    rows = conversations.select(F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                                _filled(role).alias("role"), _filled(text).alias("text"))
    parts = written(_parts(_faulty(rows)))

    def run(batches):
        held, current, done = [], None, []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("part", "conv", "number", "edge", "stats", "paths",
                                                                 "role", "text")], strict=True):
                is_part, conv, number, edge, stats, paths, own_role, own_text = r
                if is_part:
                    if current is not None:
                        done.append(current.result())
                        current = None
                    held.append({"number": number, "edge": edge, "stats": stats, "paths": paths})
                    continue
                if current is None:
                    current, held = _Repaired(conv, held), []
                current.row(own_role, own_text)
            if len(done) > 1000:
                yield pa.RecordBatch.from_pylist(done, _RESULT)
                done = []
        if current is not None:
            done.append(current.result())
        if done:
            yield pa.RecordBatch.from_pylist(done, _RESULT)

    null = F.lit(None)
    tables = parts.select(F.lit(True).alias("part"), "conv", "number", "edge", "stats", "paths",
                          null.cast("bigint").alias("turn"), null.cast("string").alias("role"),
                          null.cast("string").alias("text"), null.cast("bigint").alias("d1"), null.cast("bigint").alias("d2"))
    texts = rows.select(F.lit(False).alias("part"), "conv", null.cast("int").alias("number"), null.cast("boolean").alias("edge"),
                        null.cast("string").alias("stats"), null.cast(PATHS).alias("paths"), "turn", "role", "text",
                        F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "text", "role").alias("d2"))
    dealt = (tables.union(texts).repartition("conv")
             .sortWithinPartitions("conv", F.desc("part"), "number", "turn", "role", "d1", "d2"))
    return dealt.mapInArrow(run, RESULT)
