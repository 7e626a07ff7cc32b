"""Repair of conversation structure by a Viterbi search whose survivors are emitted as soon as they agree.

A repaired conversation is an optional system turn, then pairs of a user and an assistant turn. Turns are kept, given
another role, deleted or inserted; the cheapest edits win, of equally cheap ones those whose initials sort first. One
path survives for each place in the pattern. Their edits form a tree of backpointers that counts what hangs on each node:
where the survivors share their first edits these are final, are emitted, and their turns are let go. Turns are streamed
in order, so memory holds what is still undecided. A survivor that cannot win any more is dropped; else a path that goes
on deleting everything would keep all undecided.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import read_table, small_batches

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: cost of each edit, and of a truncated turn that stays
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
BLANKS = " \t\n\v\f\r"
ENDS = (".", "!", "?")
ROLES = {"s": "system", "u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

#: places in the pattern: nothing yet, after the system turn, after a user, after an assistant
START, SYSTEM, USER, ASSISTANT = range(4)
#: the place that a turn leads to by its initial, and the initial that an inserted or reroled turn gets
FOLLOW = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT = ("u", "u", "a", "u")
ACCEPT = (START, ASSISTANT)


class Node:
    """An edit, the one before it, and how many edits and survivors hang on it."""

    __slots__ = ("parent", "edit", "depth", "children", "held")

    def __init__(self, parent: Node | None, edit: str):
        self.parent, self.edit, self.children, self.held = parent, edit, [], 0
        self.depth = 0 if parent is None else parent.depth + 1
        if parent is not None:
            parent.children.append(self)

    def release(self) -> None:
        """Take one survivor off; what nothing hangs on any more goes, with all before it that it alone held."""
        self.held -= 1
        node = self
        while node.parent is not None and not node.held and not node.children:
            parent, node.parent = node.parent, None
            parent.children.remove(node)
            node = parent


def _suffixes(p: Node, q: Node) -> tuple[str, str]:
    """The edits of both since they parted."""
    a, b = [], []
    while p is not q:
        if p.depth >= q.depth:
            a.append(p.edit)
            p = p.parent
        else:
            b.append(q.edit)
            q = q.parent
    return "".join(reversed(a)), "".join(reversed(b))


def _sign(x: str, y: str) -> int:
    """-1 or 1 for the order of two strings of which neither begins the other, else 0."""
    return 0 if x.startswith(y) or y.startswith(x) else -1 if x < y else 1


class Survivors:
    """Feed turns with ``push``, end with ``finish``; both give ``(edit, role, text)`` of what has been decided."""

    def __init__(self):
        self.root = Node(None, "")
        self.root.held = 1
        #: place -> (cost, last edit)
        self.alive: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        #: (place, place) -> order of their edits, 0 while those of one begin those of the other
        self.order: dict[tuple[int, int], int] = {}
        self.place = START  # of what has been emitted
        self.pending: deque[tuple[str, str]] = deque()
        self.cost = 0
        self._advance({START: (0, START, "")})

    def _compare(self, a: tuple, b: tuple) -> int:
        """Order of two candidates ``(cost, place before, edits since)`` by their whole undecided edits."""
        (_, p, x), (_, q, y) = a, b
        if p == q:
            return _sign(x, y)
        known = self.order.get((p, q), 0)
        if known:
            return known
        s, t = _suffixes(self.alive[p][1], self.alive[q][1])
        return _sign(s + x, t + y)

    def _better(self, a: tuple, b: tuple | None) -> bool:
        return b is None or a[0] < b[0] or (a[0] == b[0] and self._compare(a, b) < 0)

    def _advance(self, best: dict[int, tuple]) -> None:
        """Survivors after the candidates ``best``, with insertions; drop what cannot win."""
        changed = True
        while changed:
            changed = False
            for place in list(best):
                cost, before, edits = best[place]
                to, new = FOLLOW[place][NEXT[place]], (cost + COST[INSERT], before, edits + INSERT)
                if self._better(new, best.get(to)):
                    best[to] = new
                    changed = True
        if ASSISTANT in best:
            # what follows the start can follow an assistant once its system turn is deleted
            least = best[ASSISTANT][0]
            for place, more in ((START, COST[DELETE]), (SYSTEM, 0)):
                if place in best and best[place][0] > least + more:
                    del best[place]
        places = sorted(best)
        order = {}
        for i, p in enumerate(places):
            for q in places[i + 1 :]:
                order[p, q] = s = self._compare(best[p], best[q])
                order[q, p] = -s
        made: dict[tuple[int, str], Node] = {}
        alive = {}
        for p in places:
            cost, before, edits = best[p]
            node = self.alive[before][1]
            for n, edit in enumerate(edits, 1):
                if (before, edits[:n]) not in made:
                    made[before, edits[:n]] = Node(node, edit)
                node = made[before, edits[:n]]
            node.held += 1
            alive[p] = (cost, node)
        for _, node in self.alive.values():
            node.release()
        self.alive, self.order = alive, order

    def push(self, role: str, text: str, must_go: bool, truncated: bool) -> Iterator[tuple]:
        self.pending.append((role, text))
        best: dict[int, tuple] = {}
        for place, (cost, _) in self.alive.items():
            options = [(place, cost + COST[DELETE], DELETE)]
            if not must_go:
                stays = cost + TRUNCATED * truncated
                to = FOLLOW[place].get(role[:1])
                if to is not None:
                    options.append((to, stays, KEEP))
                options.append((FOLLOW[place][NEXT[place]], stays + COST[REROLE], REROLE))
            for to, total, edit in options:
                new = (total, place, edit)
                if self._better(new, best.get(to)):
                    best[to] = new
        self._advance(best)
        yield from self._decided()

    def _decided(self) -> Iterator[tuple]:
        while not self.root.held and len(self.root.children) == 1:
            node = self.root.children.pop()
            node.parent, self.root = None, node
            yield self._emit(node.edit)

    def _emit(self, edit: str) -> tuple[str, str, str]:
        if edit == DELETE:
            return edit, *self.pending.popleft()
        role, text = (ROLES[NEXT[self.place]], "") if edit == INSERT else self.pending.popleft()
        if edit == REROLE:
            role = ROLES[NEXT[self.place]]
        self.place = FOLLOW[self.place][role[:1]]
        return edit, role, text

    def finish(self) -> Iterator[tuple]:
        """The rest; ``cost`` is that of the whole conversation then."""
        ends = [(self.alive[p][0], p, "") for p in ACCEPT if p in self.alive]
        best = ends[0]
        for e in ends[1:]:
            if self._better(e, best):
                best = e
        self.cost = best[0]
        node, edits = self.alive[best[1]][1], []
        while node is not self.root:
            edits.append(node.edit)
            node = node.parent
        for e in reversed(edits):
            yield self._emit(e)


def fault(text: str, seen: bool) -> str | None:
    """The first fault of a turn."""
    bare = text.rstrip(BLANKS)
    if not bare:
        return "blank"
    return "duplicate" if seen else None if bare.endswith(ENDS) else "truncated"


def ordered(turns: DataFrame, live: Column) -> DataFrame:
    """``conv_id, turn, role, text, nth, live`` in one partition and in order for each conversation.

    ``nth`` counts the turns of equal role and text. The order is by turn (nulls first), then role and text, so rows of
    one turn do not depend on how they are read. One shuffle serves the counting and the order.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text"), live.alias("live")
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text", "live").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("nth", F.row_number().over(same))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "nth")]
    return rows.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "nth", "live")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(new, conv_id, turn, role, text, nth, live)`` of every row; ``new`` at the first row of a conversation."""
    first, last = True, None
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(6))):
            new = first or row[0] != last
            first, last = False, row[0]
            yield new, *row


def repair(turns: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text``: all edits of every conversation of ``conv_id, turn, role, text``, in order.

    ``edit`` is K, R, D or I; role and text are those of the repaired turn (of the deleted one for D). A blank turn and
    one whose role and text were seen before are always deleted. Null roles and texts count as empty; null conv_ids are
    one conversation; other columns are ignored. A conversation is streamed through one task, as its edits depend on all
    turns before; only what is undecided is held there.
    """
    kind = turns.schema["conv_id"].dataType

    def run(batches):
        out: list[tuple] = []
        search, conv, place = None, None, 0

        def rows(edits):
            nonlocal place
            for e in edits:
                out.append((conv, place, *e))
                place += 1

        for new, now, _, role, text, nth, _ in _streamed(batches):
            if new:
                if search is not None:
                    rows(search.finish())
                search, conv, place = Survivors(), now, 0
            f = fault(text, nth > 1)
            rows(search.push(role, text, f in ("blank", "duplicate"), f == "truncated"))
            if len(out) >= 1000:
                yield _batch(out, arrow)
                out = []
        if search is not None:
            rows(search.finish())
        if out:
            yield _batch(out, arrow)

    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("place", T.LongType()),
            T.StructField("edit", T.StringType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    arrow = turns.select("conv_id").limit(0).toArrow().schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()
    return small_batches(ordered(turns, F.lit(True))).mapInArrow(run, schema)


def _batch(rows: list[tuple], types: tuple) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(types))])


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Report:
    """What is said of one conversation, turn by turn."""

    def __init__(self, conv):
        self.conv, self.n = conv, dict.fromkeys(REPORT, 0)
        self.search, self.audit, self.hash = Survivors(), [], hashlib.sha256()
        self.first = self.last = None
        self.distinct, self.role, self.begun = 0, None, False

    def _take(self, edits) -> None:
        for edit, role, text in edits:
            self.audit.append(edit)
            if edit != DELETE:
                self.hash.update(f"{chr(10) * self.begun}{role}:{text}".encode())
                self.begun = True

    def push(self, turn, role: str, text: str, nth: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        if self.role is not None and self.role + role[:1] not in LEGAL:
            self.n["illegal"] += 1
        self.role = role[:1]
        f = fault(text, nth > 1)
        if f:
            self.n[f] += 1
        self._take(self.search.push(role, text, f in ("blank", "duplicate"), f == "truncated"))

    def row(self) -> tuple:
        self._take(self.search.finish())
        if self.distinct:
            self.n["gaps"] = self.last - self.first + 1 - self.distinct
        self.n["cost"] = self.search.cost
        return (self.conv, *self.n.values(), "".join(self.audit), self.hash.hexdigest())


def reports(turns: DataFrame, live: Column | None = None) -> DataFrame:
    """``conv_id``, ``REPORT``, ``audit``, ``repaired_sha256``: one row for every conversation.

    As ``repair``, but the edits are reduced to their initials and the repaired turns, ``role:text`` joined by newlines,
    to a digest as they are decided. Rows for which ``live`` is not true count for nothing, but their conversations are
    in the result: zeros, no edits and the digest of nothing where no row is live. Gaps are turn numbers missing between
    the least and the greatest. An empty table gives no rows.
    """
    kind = turns.schema["conv_id"].dataType
    arrow = turns.select("conv_id").limit(0).toArrow().schema.field(0).type, *[pa.int64()] * len(REPORT), pa.string(), pa.string()

    def run(batches):
        out, size, now = [], 0, None
        for new, conv, turn, role, text, nth, alive in _streamed(batches):
            if new:
                if now is not None:
                    out.append(now.row())
                    size += len(out[-1][-2]) + 100
                if size >= 1 << 20:
                    yield _batch(out, arrow)
                    out, size = [], 0
                now = _Report(conv)
            if alive:
                now.push(turn, role, text, nth)
        if now is not None:
            out.append(now.row())
        if out:
            yield _batch(out, arrow)

    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            *[T.StructField(c, T.LongType()) for c in REPORT],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )
    live = F.lit(True) if live is None else F.coalesce(live, F.lit(False))
    return small_batches(ordered(turns, live)).mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, live``: rows damaged by a checksum of conversation and turn; a dropped one is not live."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    role = F.when(F.col("kind") == 4, "user").otherwise(space("role"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    rows = turns.select("conv_id", "turn", "role", "text", kind.alias("kind"))
    return rows.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        (F.col("kind") != 0).alias("live"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report on the repair of every conversation, after damage."""
    return reports(damaged(read_table(spark, sf_dir, "conversations")), F.col("live"))
