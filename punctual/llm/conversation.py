"""Conversation structure repair: Viterbi over the rows of each conversation, decided as soon as survivors coalesce.

Rows of a conversation are taken by turn (nulls first; rows of one turn by role, then text). The first fault of a row
counts: ``blank`` (no character but ASCII white space), ``duplicate`` (same role and text as an earlier row) or
``truncated`` (the last such character isn't one of ``.!?``). Edits: Keep costs 0, Rerole (to the role that fits, user
or assistant) 3, Delete 4 and the only choice for blank and duplicate rows, Insert (an empty user or assistant row,
anywhere) 3; a truncated row that stays costs 3 more. The cheapest edits whose roles' initials make ``(s?(ua)+)?`` are
chosen; of equally cheap ones those whose initials, in order, are least in ASCII order.

A state is the part of the pattern that was read: nothing, the system row, a user row, an assistant row. Every state
keeps its cheapest path; on equal costs the complete unresolved suffixes of both are compared (equally dear paths to one
state after the same rows never begin one another, since inserts cost). Paths share a tree of back pointers with
reference counts: a node that no survivor comes from goes, a node with one successor joins it, and once all survivors
come from one node the edits up to there are emitted and forgotten. A state dearer than the cheapest by more than
``CATCH_UP`` (what any other state needs at most to go on like it) can't win and is dropped. A worker holds the rows
since the survivors parted, not the conversation; if two phases of a conversation stay equally good to its end (say, one
role in every row), that is the whole of it.

Before that, equal rows of a turn are counted together (so copies shrink before any shuffle), and what was seen earlier
comes from the first turn of every role and text, an aggregate joined back on keys that spread one conversation over all
tasks. Conversations are then dealt by their key and read in sorted order, one row at a time; a conversation is one
stream, since its edits depend on each other from the first row to the last.

Null roles and texts stand as one space; a null key is a conversation of its own, null turns come first. A row whose
role is empty or has another initial can't be kept as it is. Rows without any usable conversation give no edits. Repeated
rows are duplicates. The input columns are named by parameters, all others are ignored; results have fixed names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
# States: what of the pattern was read.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
INITIAL = {USER: "u", ASSISTANT: "a"}
LEGAL = {"su", "ua", "au"}
CATCH_UP = 7
BATCH_ROWS = 500

_SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Row:
    """``copies`` equal rows; ``seen``: role and text came up in an earlier turn."""

    turn: int | None
    role: str
    text: str
    copies: int = 1
    seen: bool = False


@dataclass
class Edit:
    letter: str
    row: Row | None = None
    role: str | None = None
    times: int = 1


class Node:
    """A stretch of edits; ``heirs``: nodes that go on from it, and one more if a state survives here."""

    __slots__ = ("parent", "edits", "heirs")

    def __init__(self, parent: Node | None, edits: list[Edit]):
        self.parent, self.edits, self.heirs = parent, edits, 1
        if parent is not None:
            parent.heirs += 1

    def release(self) -> None:
        node: Node | None = self
        while node is not None:
            node.heirs -= 1
            if node.heirs:
                return
            node = node.parent


def _letters(made: list[Edit]) -> str:
    return "".join(edit.letter * edit.times for edit in made)


def _suffix(node: Node | None, last: list[Edit]) -> str:
    """The initials of all edits not emitted yet that lead to ``node``, and of ``last``."""
    parts = [_letters(last)]
    while node is not None:
        parts.append(_letters(node.edits))
        node = node.parent
    return "".join(reversed(parts))


class Repair:
    """The survivors of one conversation; ``read`` and ``end`` give the edits that are decided by then."""

    def __init__(self) -> None:
        self.root = Node(None, [])
        self.root.heirs = 0
        first = Node(self.root, [])
        self.survivors: dict[int, tuple[int, Node]] = {EMPTY: (0, first)}
        self.most_held = 0

    def _offer(self, best: dict, state: int, cost: int, parent: Node, edits: list[Edit]) -> None:
        known = best.get(state)
        if known is not None and cost >= known[0]:
            if cost > known[0]:
                return
            if _suffix(parent, edits) >= _suffix(known[1], known[2]):
                return
        best[state] = (cost, parent, edits)

    def _with_inserts(self) -> dict[int, tuple[int, Node, list[Edit]]]:
        """The survivors, and what inserted rows lead to; two in a row reach every state that they can."""
        best: dict[int, tuple[int, Node, list[Edit]]] = {}
        for state, (cost, node) in self.survivors.items():
            best[state] = (cost, node, [])
        for _ in range(2):
            for state, (cost, node, edits) in list(best.items()):
                target = FOLLOWS[state]
                self._offer(best, target, cost + INSERT_COST, node, [*edits, Edit(INSERT, None, ROLES[target])])
        return best

    def _settle(self, best: dict[int, tuple[int, Node, list[Edit]]]) -> list[Edit]:
        """New survivors from ``best``; the edits that all of them share."""
        least = min(cost for cost, _, _ in best.values())
        old = [node for _, node in self.survivors.values()]
        self.survivors = {
            state: (cost, Node(parent, edits)) for state, (cost, parent, edits) in best.items() if cost <= least + CATCH_UP
        }
        for node in old:
            node.release()
        return self._decided()

    def _decided(self) -> list[Edit]:
        held = 0
        for _, leaf in self.survivors.values():
            node = leaf
            while node.parent is not self.root:
                above = node.parent
                if above.heirs == 1:  # nobody else goes on from there
                    above.edits.extend(node.edits)
                    node.edits, node.parent = above.edits, above.parent
                else:
                    node = above
            held += len(leaf.edits)
        self.most_held = max(self.most_held, held)
        out: list[Edit] = []
        while self.root.heirs == 1:
            node = next(leaf for _, leaf in self.survivors.values())
            if len(self.survivors) == 1:
                out += node.edits
                node.edits = []
                return out
            while node.parent is not self.root:
                node = node.parent
            out += node.edits
            node.edits, node.parent, self.root = [], None, node
        return out

    def read(self, row: Row, must_go: int, truncated: bool) -> list[Edit]:
        """``must_go``: how many of the row's copies can only be deleted."""
        if must_go < row.copies:
            starts = self._with_inserts()
            best: dict[int, tuple[int, Node, list[Edit]]] = {}
            extra, initial = TRUNCATED_COST if truncated else 0, row.role[:1]
            for state, (cost, node, edits) in starts.items():
                target = FOLLOWS[state]
                if initial == INITIAL[target]:
                    self._offer(best, target, cost + extra, node, [*edits, Edit(KEEP, row, row.role)])
                if initial == "s" and state == EMPTY:
                    self._offer(best, SYSTEM, cost + extra, node, [*edits, Edit(KEEP, row, row.role)])
                self._offer(best, target, cost + REROLE_COST + extra, node, [*edits, Edit(REROLE, row, ROLES[target])])
                self._offer(best, state, cost + DELETE_COST, node, [*edits, Edit(DELETE, row)])
            out = self._settle(best)
            if not must_go:
                return out
        else:
            out = []
        # Inserts are never least in ASCII order before a forced Delete, so they wait until after it.
        gone = {
            state: (cost + DELETE_COST * must_go, node, [Edit(DELETE, row, None, must_go)])
            for state, (cost, node) in self.survivors.items()
        }
        return out + self._settle(gone)

    def end(self) -> tuple[int, list[Edit]]:
        """The cost of the cheapest edits, and those not given yet."""
        ends: dict[int, tuple[int, Node, list[Edit]]] = {}
        for state, (cost, node, edits) in self._with_inserts().items():
            if state in (EMPTY, ASSISTANT):
                self._offer(ends, 0, cost, node, edits)
        return ends[0][0], self._settle(ends)


def is_blank(text: str) -> bool:
    return not text.rstrip(_SPACE)


def is_truncated(text: str) -> bool:
    return not text.rstrip(_SPACE).endswith((".", "!", "?"))


@dataclass
class Conversation:
    """One conversation as it is read: its counts, and its repair."""

    key: object
    repair: Repair = field(default_factory=Repair)
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    least: int | None = None
    most: int | None = None
    turns: int = 0
    before: str | None = None
    sequence: int = 0

    def read(self, row: Row) -> list[Edit]:
        if row.turn is not None and row.turn != self.most:
            self.least = row.turn if self.least is None else self.least
            self.most, self.turns = row.turn, self.turns + 1
        initial = row.role[:1]
        self.illegal += row.copies - 1 + (self.rows > 0 and f"{self.before}{initial}" not in LEGAL)
        self.before, self.rows = initial, self.rows + row.copies
        if is_blank(row.text):
            self.blank += row.copies
            return self.repair.read(row, row.copies, False)
        must_go = row.copies if row.seen else row.copies - 1
        self.duplicate += must_go
        truncated = not row.seen and is_truncated(row.text)
        self.truncated += truncated
        return self.repair.read(row, must_go, truncated)

    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.turns


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _sorted_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, keys: DataFrame | None) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``copies`` and ``seen``, a conversation in one task and in order.

    Conversations that are only in ``keys`` have one row with 0 copies.
    """
    space = F.lit(" ")
    named = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        F.lit(1).alias("copies"),
    )
    if keys is not None:
        only = [F.lit(None).cast("long"), F.lit(""), F.lit(""), F.lit(0)]
        names = ["turn", "role", "text", "copies"]
        kept = [made.alias(name) for made, name in zip(only, names, strict=True)]
        named = named.unionByName(keys.select(F.col(conv).alias("conv"), *kept))
    real = F.col("copies") > 0
    # Markers stay apart from rows, and several of them are one.
    counted = named.withColumn("real", real).groupBy("conv", "turn", "role", "text", "real").agg(F.sum("copies").alias("copies"))
    counted = counted.withColumn("print", F.md5(F.encode("text", "UTF-8")))
    keyed = [F.col("conv").alias("c"), F.col("role").alias("r"), F.col("print").alias("p")]
    first = counted.filter("real").groupBy(*keyed).agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("open"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("print") == F.col("p"))
    later = F.col("turn").isNotNull() & (F.col("open") | (F.col("turn") > F.col("first")))
    joined = counted.join(first, same, "left").withColumn("seen", F.coalesce(later, F.lit(False)))
    slim = joined.select("conv", "turn", "role", "text", "copies", "seen", "real")
    return slim.repartition("conv").sortWithinPartitions("conv", "real", F.col("turn").asc_nulls_first(), "role", "text")


def edits(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    keys: DataFrame | None = None,
) -> DataFrame:
    """The edits of every conversation in order, and after them one row with its counts.

    Columns: the key under its name, ``sequence`` (from 0), ``edit`` (K, R, D or I; null in the row with counts),
    ``times`` (equal rows deleted together), ``turn``, ``role`` (after the edit; null when deleted), ``text`` (as read;
    empty for Insert) and ``counts`` (gaps, blank, duplicate, truncated, illegal, cost; null in rows with edits).
    ``keys`` may name further conversations (in column ``conv``), which get their row even if ``rows`` has none of them.
    The rows of a conversation are in one task and in order.
    """
    ordered = _sorted_rows(rows, conv, turn, role, text, keys)
    counts = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])
    plain = [("sequence", T.LongType()), ("edit", T.StringType()), ("times", T.LongType()), ("turn", T.LongType())]
    plain += [("role", T.StringType()), ("text", T.StringType()), ("counts", counts)]
    schema = T.StructType([T.StructField("conv", ordered.schema["conv"].dataType), *(T.StructField(*one) for one in plain)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        types: list[pa.DataType] = []

        def flush() -> pa.RecordBatch:
            made = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, schema.names)

        def write(known: Conversation, decided: list[Edit]) -> None:
            for edit in decided:
                row = edit.row
                out.append((known.key, known.sequence, edit.letter, edit.times, row and row.turn, edit.role, row.text if row else "", None))
                known.sequence += 1

        def close(known: Conversation) -> None:
            cost, decided = known.repair.end()
            write(known, decided)
            found = [known.gaps(), known.blank, known.duplicate, known.truncated, known.illegal, cost]
            out.append((known.key, known.sequence, None, 0, None, None, None, dict(zip(COUNTS, found, strict=True))))

        known: Conversation | None = None
        for batch in batches:
            types = types or [
                batch.schema.field("conv").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                pa.struct([(name, pa.int64()) for name in COUNTS]),
            ]
            names = ("conv", "turn", "role", "text", "copies", "seen")
            for key, *values in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
                if known is None or key != known.key:
                    if known is not None:
                        close(known)
                    known = Conversation(key)
                if values[3]:
                    write(known, known.read(Row(*values)))
                if len(out) >= BATCH_ROWS:
                    yield flush()
        if known is not None:
            close(known)
            yield flush()

    return ordered.mapInArrow(read, schema).withColumnRenamed("conv", conv)


def repaired(found: DataFrame) -> DataFrame:
    """The rows that stay or come in, from what ``edits`` gives."""
    return found.filter(F.col("edit").isin(KEEP, REROLE, INSERT)).drop("times", "counts")


def digests(found: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation from what ``edits`` gives: its counts, ``audit`` and ``repaired_sha256``.

    The audit is the edits' initials in order; the hash is that of the repaired rows as ``role:text``, joined by new lines.
    """
    fields = [T.StructField("conv", found.schema[conv].dataType), *(T.StructField(name, T.LongType()) for name in COUNTS)]
    schema = T.StructType([*fields, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, hashed, any_row = [], hashlib.sha256(), False
        for batch in batches:
            done = []
            names = ("conv", "edit", "times", "role", "text", "counts")
            for key, edit, times, role, text, counts in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
                if edit is None:
                    done.append((key, *(counts[name] for name in COUNTS), "".join(audit), hashed.hexdigest()))
                    audit, hashed, any_row = [], hashlib.sha256(), False
                    continue
                audit.append(edit * times)
                if edit != DELETE:
                    hashed.update(f"{chr(10) * any_row}{role}:{text}".encode("utf-8", "surrogatepass"))
                    any_row = True
            types = [batch.schema.field("conv").type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            columns = zip(*done, strict=True) if done else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

    return found.withColumnRenamed(conv, "conv").mapInArrow(read, schema).withColumnRenamed("conv", conv)


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str, fate: Column) -> DataFrame:
    """Rows with set faults: ``fate`` 0 drops a row, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it a user's."""
    space = F.lit(" ")
    said, by = F.coalesce(F.col(text), space), F.coalesce(F.col(role), space)
    made = rows.withColumn("_fate", fate).filter(F.col("_fate").isNull() | (F.col("_fate") != 0))
    changed = made.withColumns(
        {
            text: F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said),
            role: F.when(F.col("_fate") == 4, "user").otherwise(by),
            "_times": F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))),
        }
    )
    return changed.withColumn("_times", F.explode("_times")).drop("_times", "_fate")
