"""Operator 12: conversation structure repair by a dynamic programme over persistent audits.

Every row of a conversation is kept (K, free), given the role user or assistant (R, 1) or deleted (D, 2, the only way for
blank rows and for rows whose role and text were seen earlier); an empty user or assistant row may be inserted anywhere (I, 5);
a truncated row that stays adds 5.  The cheapest edits are wanted after which the role initials read ``(s?(ua)+)?``, and of
equally cheap ones those whose initials, the *audit*, come first in ASCII.

The programme keeps one audit per state of that pattern (start, after s, after u, after a).  Audits are nodes of a shared
tree (``Audits``): a node adds a label to its parent's string and knows its ancestors 1, 2, 4, ... steps up and the rolling hash of
its string.  Equally cheap audits are compared through their longest common prefix, found by lifting both nodes past
differing hashes; equal hashes are verified along the nodes.  (Of equally cheap audits of one state neither is a prefix of
the other: both hold one initial per row, so the longer one would have more insertions and the same other edits.)

Conversations of any length are worked on in blocks of at most ``BLOCK_ROWS`` rows.  Rows are sorted by conversation and turn
over range partitions, so a long conversation lies in many of them; a block gives, for each state before it, the best audit
to each state after it.  A conversation's blocks are then joined by the same programme, with whole blocks' audits as
labels.  The repaired rows come out of a last pass in order, row by row, which also feeds the checksum; SHA-256 has to
read a conversation from its start, so that one pass streams a conversation through one task (with constant memory per row).

Nulls in role and text are one space.  Rows are ordered by turn, nulls first, then by the SHA-256 of role and text, so rows of
one turn have a fixed order; identical rows are copies, of which the first may stay.  A role counts by its first character; a
role that is empty or begins otherwise than with s, u or a cannot stay as it is.  Conversations without a row left (all
dropped) have zeros, an empty audit and the checksum of nothing; a null conversation id is a conversation; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

BLOCK_ROWS = 512
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what a given or inserted role has to be
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"


class Audits:
    """Strings as linked nodes that share their prefixes; node 0 is the empty string."""

    BASE, PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self):
        self.label, self.length, self.depth, self.hash = [""], [0], [0], [0]
        self.up: list[list[int]] = [[]]  # up[node][k] is 2 ** k nodes above

    def add(self, parent: int, label: str) -> int:
        h = self.hash[parent]
        for c in label:
            h = (h * self.BASE + ord(c)) % self.PRIME
        up, at = [parent], parent
        while len(self.up[at]) >= len(up):
            at = self.up[at][len(up) - 1]
            up.append(at)
        self.label.append(label)
        self.length.append(self.length[parent] + len(label))
        self.depth.append(self.depth[parent] + 1)
        self.hash.append(h)
        self.up.append(up)
        return len(self.label) - 1

    def ancestor(self, node: int, depth: int) -> int:
        rest, k = self.depth[node] - depth, 0
        while rest:
            if rest & 1:
                node = self.up[node][k]
            rest, k = rest >> 1, k + 1
        return node

    def seem_equal(self, a: int, b: int) -> bool:
        return a == b or self.hash[a] == self.hash[b] and self.length[a] == self.length[b]

    def are_equal(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are built from the same labels; ends where they share a node."""
        while a != b:
            if self.label[a] != self.label[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def common(self, a: int, b: int) -> tuple[int, int]:
        """The deepest ancestors of one depth that have equal hashes."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.seem_equal(a, b):
            return a, b
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.seem_equal(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.up[a][0], self.up[b][0]

    def labels(self, node: int) -> list[str]:
        out = []
        while node:
            out.append(self.label[node])
            node = self.up[node][0]
        return out[::-1]

    def before(self, a: int, b: int) -> bool:
        """Whether a's string comes before b's."""
        x, y = self.common(a, b)
        if not self.are_equal(x, y):  # hashes collided
            return "".join(self.labels(a)) < "".join(self.labels(b))
        depth, s, t = self.depth[x], "", ""
        while depth < max(self.depth[a], self.depth[b]):
            depth += 1
            s += self.label[self.ancestor(a, depth)] if depth <= self.depth[a] else ""
            t += self.label[self.ancestor(b, depth)] if depth <= self.depth[b] else ""
            n = min(len(s), len(t))
            if s[:n] != t[:n]:
                break
        return s < t

    def best(self, options: list[tuple[int, int, str]]) -> tuple[int, int] | None:
        """(cost, node) of the cheapest, then first, of (cost, parent, label); a label of None is the parent itself."""
        if not options:
            return None
        cost = min(o[0] for o in options)
        found = None
        for c, parent, label in options:
            if c == cost:
                node = parent if label is None else self.add(parent, label)
                if found is None or self.before(node, found):
                    found = node
        return cost, found


Front = list  # per state: (cost, node), or None where it cannot be reached


def with_insertions(audits: Audits, front: Front) -> Front:
    """The states reached by inserting rows here; more than one round of the pattern is never cheaper."""
    out = list(front)
    for to, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        options = [(out[s][0] + INSERT, out[s][1], "I") for s in sources if out[s]]
        if out[to]:
            options = [o for o in options if o[0] <= out[to][0]] + [(*out[to], None)]
        out[to] = audits.best(options)
    return out


def deleted(audits: Audits, front: Front, n: int) -> Front:
    return with_insertions(audits, [f and (f[0] + DELETE * n, audits.add(f[1], "D" * n)) for f in front])


def edited(audits: Audits, front: Front, initial: str, truncated: bool) -> Front:
    """One row that is neither blank nor seen earlier."""
    options: list[list] = [[], [], [], []]
    stays = STAYS_TRUNCATED * truncated
    for state, f in enumerate(front):
        if f is None:
            continue
        cost, node = f
        options[state].append((cost + DELETE, node, "D"))
        options[NEXT[state]].append((cost + REROLE + stays, node, "R"))
        if initial == "ua"[NEXT[state] - USER]:
            options[NEXT[state]].append((cost + KEEP + stays, node, "K"))
        elif initial == "s" and state == START:
            options[SYSTEM].append((cost + KEEP + stays, node, "K"))
    return with_insertions(audits, [audits.best(o) for o in options])


def block_cells(rows: list[tuple], starts: list[int]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a block of (initial, copies, blank, seen earlier, truncated)."""
    out = []
    for start in starts:
        audits = Audits()
        front: Front = [None] * 4
        front[start] = (0, 0)
        front = with_insertions(audits, front)
        for initial, copies, blank, seen, truncated in rows:
            if not (blank or seen):
                front = edited(audits, front, initial, truncated)
                copies -= 1
            if copies:
                front = deleted(audits, front, copies)
        out += [(start, state, f[0], "".join(audits.labels(f[1]))) for state, f in enumerate(front) if f]
    return out


def joined_blocks(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[str]]:
    """(cost, audit per block) of the best way through all blocks that ends in a legal state."""
    audits = Audits()
    front: Front = [(0, 0), None, None, None]
    for cells in blocks:
        options: list[list] = [[], [], [], []]
        for start, end, cost, audit in cells:
            if front[start]:
                options[end].append((front[start][0] + cost, front[start][1], audit))
        front = [audits.best(o) for o in options]
    cost, node = audits.best([(*front[s], None) for s in (START, ASSISTANT) if front[s]])
    return cost, audits.labels(node)


class Summary:
    """What a block tells about its rows, apart from the audits."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "opens", "closes")
    TYPES = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, opens string, closes string"

    def __init__(self, **values):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.opens = self.closes = None
        self.__dict__ |= values

    @classmethod
    def of(cls, rows: list[tuple], turns: list[int | None]) -> Summary:
        out = cls()
        for (initial, copies, blank, seen, truncated), turn in zip(rows, turns, strict=True):
            if not copies:
                continue
            faulty = copies if blank or seen else copies - 1
            out.add(cls(blank=copies * blank, duplicate=0 if blank else faulty, truncated=int(truncated and not blank and not seen), illegal=copies - 1,
                        turns=int(turn is not None), low=turn, high=turn, opens=initial, closes=initial))
        return out

    def add(self, after: Summary) -> None:
        """Join what comes after; turns ascend, so equal ones meet at the border."""
        for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, c, getattr(self, c) + getattr(after, c))
        if after.opens is not None:
            if self.closes is not None:
                self.illegal += self.closes + after.opens not in LEGAL
            self.opens = after.opens if self.opens is None else self.opens
            self.closes = after.closes
        if after.low is not None:
            self.turns -= self.high == after.low
            self.low = after.low if self.low is None else self.low
            self.high = after.high

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _space(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged by the checksum of ``conv_id:turn`` modulo 20.

    0 drops the row (copies 0), 1 empties the text, 2 removes its sentence ends, 3 doubles the row, 4 sets the role user.
    """
    k = F.crc32(F.concat(_space(conv_col), F.lit(":"), _space(turn_col)).cast("binary")) % 20
    rows = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), _space(role_col).alias("role"),
                       _space(text_col).alias("text"), k.alias("k"))
    k = F.col("k")
    text = F.when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(k == 0, 0).when(k == 3, 2).otherwise(1).cast("long").alias("copies"))


def as_given(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies`` of undamaged rows."""
    return rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), _space(role_col).alias("role"),
                       _space(text_col).alias("text"), F.lit(1).cast("long").alias("copies"))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows with their faults: identical ones are one row with ``copies``, dropped ones leave a row of no copies and no content."""
    gone = F.col("copies") == 0
    rows = rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").otherwise(F.col("role")).alias("role"),
                       F.when(gone, "").otherwise(F.col("text")).alias("text"), "copies")
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    one = (rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("content", content))
    # the earliest turn of each content; null turns come first
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    early = (one.where("copies > 0").groupBy("conv_id", "content").agg(F.min(turn).alias("first"))
             .select(F.col("conv_id").alias("c"), F.col("content").alias("s"), F.col("first.turn").alias("t")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("content") == F.col("s")) & F.col("turn").eqNullSafe(F.col("t"))
    stripped = F.rtrim("text", F.lit(BLANKS))
    return one.join(early, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", "content", F.substring("role", 1, 1).alias("initial"), (stripped == "").alias("blank"),
        F.col("s").isNull().alias("seen"), (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


CELLS = "cells array<struct<start:int,end:int,cost:long,audit:string>>"


def blocked(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows in order with their ``block`` and ``place`` (kind 1), and a row per block with its cells and summary (kind 0); written once."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("content")]
    given = distinct_rows(rows)
    kind = given.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(
        f"block long, kind int, place int, role string, text string, copies long, {CELLS}, {Summary.TYPES}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held, turns, conv, whole, fresh, rows_seen = [], [], None, False, True, False
        arrow = None

        def closed() -> dict:
            cells = block_cells(held, [START] if whole else [START, SYSTEM, USER, ASSISTANT])
            s = Summary.of(held, turns)
            return {"conv_id": conv, "block": number, "kind": 0, "cells": [dict(zip(("start", "end", "cost", "audit"), c, strict=True)) for c in cells]} | {
                f: getattr(s, f) for f in Summary.FIELDS}

        def emitted(summaries: list[dict], convs) -> pa.RecordBatch:
            cols = {f.name: [r.get(f.name) for r in summaries] for f in schema}
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], t) for f, t in zip(schema, arrow, strict=True)], names=schema.names)

        for b in batches:
            if arrow is None:
                whole_struct = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
                arrow = [b.column("conv_id").type, pa.int64(), pa.int32(), pa.int32(), b.column("role").type, b.column("text").type, pa.int64(), whole_struct,
                         *[pa.int64()] * 7, pa.string(), pa.string()]
            done, block, place = [], [], []
            light = [b.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "copies", "blank", "seen", "truncated")]
            for c, turn, *row in zip(*light, strict=True):
                if held and (c != conv or len(held) == block_rows):
                    done.append(closed())
                    number, held, turns = number + 1, [], []
                if not rows_seen or c != conv:
                    # the first conversation of a partition may have begun in the one before
                    conv, fresh = c, rows_seen
                    rows_seen = True
                elif not held:
                    fresh = False
                if not held:
                    whole = fresh
                block.append(number)
                place.append(len(held))
                held.append(tuple(row))
                turns.append(turn)
            n = b.num_rows
            by_name = {"conv_id": b.column("conv_id"), "block": pa.array(block, pa.int64()), "kind": pa.array([1] * n, pa.int32()), "place": pa.array(place, pa.int32()),
                       "role": b.column("role"), "text": b.column("text"), "copies": b.column("copies")}
            yield pa.RecordBatch.from_arrays([by_name[f.name] if f.name in by_name else pa.nulls(n, t) for f, t in zip(schema, arrow, strict=True)],
                                             names=schema.names)
            if done:
                yield emitted(done, None)
        if held:
            yield emitted([closed()], None)

    placed = given.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(placed.mapInArrow(run, schema), "conversation-blocks")


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def audited(blocks: DataFrame) -> DataFrame:
    """Per block its part of the conversation's audit, and the conversation's figures."""
    kind = blocks.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(f"block long, audit string, {RESULT}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, arrow = None, [], None

        def finished() -> list[tuple]:
            cost, audits = joined_blocks([[tuple(c.values()) for c in r["cells"]] for r in held])
            total = Summary()
            for r in held:
                total.add(Summary(**{f: r[f] for f in Summary.FIELDS}))
            figures = (total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost)
            return [(conv, r["block"], a, *figures) for r, a in zip(held, audits, strict=True)]

        def emitted(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow, strict=True)], names=schema.names)

        for b in batches:
            arrow = [b.column("conv_id").type, pa.int64(), pa.string(), *[pa.int64()] * 6]
            out = []
            for r in b.to_pylist():
                if held and r["conv_id"] != conv:
                    out += finished()
                    held = []
                conv = r["conv_id"]
                held.append(r)
            if out:
                yield emitted(out)
        if held:
            yield emitted(finished())

    summaries = blocks.where("kind = 0").select("conv_id", "block", "cells", *Summary.FIELDS)
    return summaries.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, schema)


class Walk:
    """Applies a conversation's audit to its rows in order."""

    def __init__(self):
        self.state, self.audit, self.at = START, "", 0

    def open(self, audit: str) -> None:
        self.audit, self.at = audit, 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield NAMES[self.state], "", "I"

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of the rows that stay or come in."""
        for _ in range(copies):
            yield from self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "D":
                continue
            if edit == "R":
                self.state = NEXT[self.state]
                role = NAMES[self.state]
            else:
                self.state = SYSTEM if role[:1] == "s" else NEXT[self.state]
            yield role, text, edit


def in_order(blocks: DataFrame, audits: DataFrame) -> DataFrame:
    """Each block's audit, then its rows, conversation by conversation."""
    texts = blocks.where("kind = 1").select("conv_id", "block", "kind", "place", "role", "text", "copies")
    return (texts.unionByName(audits.withColumn("kind", F.lit(0)), allowMissingColumns=True)
            .repartition("conv_id").sortWithinPartitions("conv_id", "block", "kind", "place"))


def lines_of(batch: pa.RecordBatch, state: dict) -> Iterator[tuple]:
    """Events of an ordered batch: ("open", row) at a conversation's first block, ("line", role, text, edit), ("audit", text)."""
    for r in batch.to_pylist():
        if r["kind"] == 0:
            if "walk" not in state or r["conv_id"] != state["conv"]:
                if "walk" in state:
                    yield from (("line", *x) for x in state["walk"].inserted())
                    yield ("close",)
                state |= {"walk": Walk(), "conv": r["conv_id"]}
                yield "open", r
            else:
                yield from (("line", *x) for x in state["walk"].inserted())
            state["walk"].open(r["audit"])
            yield "audit", r["audit"]
        else:
            yield from (("line", *x) for x in state["walk"].row(r["role"], r["text"], r["copies"]))


def ended(state: dict) -> Iterator[tuple]:
    if "walk" in state:
        yield from (("line", *x) for x in state["walk"].inserted())
        yield ("close",)


def digest(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Figures, audit and checksum of the repaired conversation for every ``conv_id`` of ``rows(conv_id, turn, role, text, copies)``."""
    blocks = blocked(rows, block_rows)
    kind = blocks.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(f"{RESULT}, audit string, repaired_sha256 string").fields])
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        open_: dict = {}
        arrow = None

        def finished(events: Iterator[tuple]) -> list[tuple]:
            out = []
            for what, *x in events:
                if what == "open":
                    open_.update(row=x[0], audit=[], hash=hashlib.sha256(), any=False)
                elif what == "audit":
                    open_["audit"].append(x[0])
                elif what == "line":
                    open_["hash"].update(("\n" * open_["any"] + x[0] + ":" + x[1]).encode())
                    open_["any"] = True
                else:
                    r = open_["row"]
                    out.append((r["conv_id"], *(r[c] for c in names), "".join(open_["audit"]), open_["hash"].hexdigest()))
            return out

        def emitted(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow, strict=True)], names=schema.names)

        for b in batches:
            arrow = [b.column("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            yield from emitted(finished(lines_of(b, state)))
        yield from emitted(finished(ended(state)))

    return in_order(blocks, audited(blocks)).mapInArrow(run, schema)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations: ``conv_id, place (from 0), role, text, edit`` (K, R or I)."""
    blocks = blocked(rows, block_rows)
    kind = blocks.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("place long, role string, text string, edit string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        at = {"place": 0}

        def emitted(events: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            out = []
            for what, *x in events:
                if what == "open":
                    at["place"] = 0
                elif what == "line":
                    out.append((state["conv"], at["place"], *x))
                    at["place"] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], names=schema.names)

        arrow = None
        for b in batches:
            arrow = [b.column("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield from emitted(lines_of(b, state))
        yield from emitted(ended(state))

    return in_order(blocks, audited(blocks)).mapInArrow(run, schema)
