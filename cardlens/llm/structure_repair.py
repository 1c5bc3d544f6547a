"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

A conversation's rows (by turn, null first; ties by role, then text) are read once. Edits: keep
a row (0), rerole it to user or assistant (2), delete it (3; blank and duplicate rows must be
deleted), insert an empty user or assistant row anywhere (2); a truncated row that stays adds 1.
The repaired role initials read ``(s?(ua)+)?``. Among the cheapest repairs the one whose edit
initials (D, I, K, R in order) are least in ASCII wins.

Faults, the first that holds: blank (no character but white space), duplicate (role and text
stood earlier in the conversation), truncated (the last character that is not white space is
not one of ``.!?``).

Survivor-coalescence Viterbi: after every row each state of the role automaton keeps its best
path (at most four). Paths are a backpointer tree; a node counts its children, a node without
any is freed up to the fork it came from, and as soon as the root has one child only, its edits
are final and emitted. States that cannot win any more are dropped: whatever follows, the start
state is at least as good as "after assistant", which costs at most 3 more than the start state
and nothing more than "after system". Ties need the complete unresolved edits of two paths
compared: survivors carry the rank of their unresolved edits among each other, so a comparison is
(rank, edits of this row) whatever the length of the unresolved part. The hash of the repaired rows
is carried per survivor, so no text waits for a decision: what stays in memory is a few bytes per
row whose edit is still open.

On Spark: one shuffle by conversation, in which Spark's sort finds duplicates (a window over
conversation, role and text) and brings the rows in order, both spilling to disk; the walk is an
Arrow stream that holds one batch. One conversation is one task's stream, because its hash is
over all its rows in order.

Edge cases: null roles and texts are one space (so such a text is blank); a null turn comes first; rows
with a null id are one conversation; a conversation none of whose rows are ``present`` has zeros, an empty
audit and the hash of the empty text; repeated rows are duplicates; other columns stay out of the
report, whatever their names; an empty table gives an empty report.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package, write_shared

WHITE = " \t\n\x0b\x0c\r"
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_REROLE, _DELETE, _INSERT, _TRUNCATED = 2, 3, 2, 1
_START, _SYSTEM, _USER, _ASSISTANT = range(4)  # states: what the repaired rows end with
_KEEP = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # the role that an inserted or reroled row must have
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_BRIDGES = ((_START, _USER, 1), (_START, _ASSISTANT, 2), (_SYSTEM, _USER, 1), (_SYSTEM, _ASSISTANT, 2), (_USER, _ASSISTANT, 1),
            (_ASSISTANT, _USER, 1))  # inserts that lead from state to state


class _Node:
    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent, edits: str):
        self.parent, self.edits, self.children = parent, edits, []


class Repair:
    """The walk over one conversation; ``emit`` gets the edits of each row, in order, as they become final."""

    def __init__(self, emit, hashed: bool = True):
        self.emit = emit
        self.root = _Node(None, "")
        first = hashlib.sha256() if hashed else None
        self.bases = [(self.root, first, _START)]  # paths up to the last row: (node, hash, state)
        self.open = {_START: (0, 0, "", 0)}  # state: (cost, rank of the base's edits, inserts after the base, base)
        self._bridge()

    def _bridge(self):
        """Best path to every state, inserts after the last row included; hopeless states go."""
        base = list(self.open.items())
        for state, to, n in _BRIDGES:
            for own, (cost, rank, _, at) in base:
                if own == state:
                    path = (cost + n * _INSERT, rank, "I" * n, at)
                    if to not in self.open or path[:3] < self.open[to][:3]:
                        self.open[to] = path
        cost = {q: p[0] for q, p in self.open.items()}
        best = cost[_ASSISTANT]
        if _START in cost and cost[_START] > best + _DELETE:
            del self.open[_START]
        if _SYSTEM in cost and cost[_SYSTEM] > best:
            del self.open[_SYSTEM]

    def row(self, role: str, text: bytes, must_delete: bool, truncated: bool):
        extra = _TRUNCATED if truncated else 0
        paths: dict = {}

        def offer(to, *path):
            if to not in paths or path < paths[to]:
                paths[to] = path

        for state, (cost, rank, edits, at) in self.open.items():
            offer(state, cost + _DELETE, rank, edits + "D", at)
            if not must_delete:
                if role[:1] in _KEEP[state]:
                    offer(_KEEP[state][role[:1]], cost + extra, rank, edits + "K", at)
                offer(_NEXT[state], cost + _REROLE + extra, rank, edits + "R", at)
        order = {key: i for i, key in enumerate(sorted((p[1], p[2]) for p in paths.values()))}
        old = self.bases
        self.open = {q: (p[0], order[p[1], p[2]], "", q) for q, p in paths.items()}
        self._bridge()
        self.bases = {}
        for at in {p[3] for p in self.open.values()}:
            _, _, edits, before = paths[at]
            parent, digest, state = old[before]
            node = _Node(parent, edits)
            parent.children.append(node)
            self.bases[at] = (node, digest and _extend(digest, state, edits, role, text), at)
        for node, _, _ in old if isinstance(old, list) else old.values():
            while not node.children and node is not self.root:  # no survivor goes through it
                node.parent.children.remove(node)
                node = node.parent
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            self.emit(self.root.edits)

    def finish(self):
        """(cost, hash in hex); what was still open is emitted, then the inserts after the last row."""
        state = min((q for q in (_START, _ASSISTANT) if q in self.open), key=lambda q: self.open[q][:3])
        cost, _, edits, at = self.open[state]
        node, digest, own = self.bases[at]
        rest = []
        while node is not self.root:
            rest.append(node.edits)
            node = node.parent
        for one in reversed(rest):
            self.emit(one)
        self.emit(edits)
        return cost, digest and _extend(digest, own, edits, "", b"").hexdigest()


def _steps(state: int, edits: str, role: str) -> Iterator[tuple]:
    """(edit, role of the repaired row or None, state before it) of each edit."""
    for edit in edits:
        if edit == "D":
            yield edit, None, state
            continue
        to = _KEEP[state][role[:1]] if edit == "K" else _NEXT[state]
        yield edit, role if edit == "K" else _ROLE[to], state
        state = to


def _extend(digest, state: int, edits: str, role: str, text: bytes):
    """A new hash that goes on with the repaired rows of ``edits``."""
    if edits in ("", "D"):
        return digest
    digest = digest.copy()
    for edit, own, before in _steps(state, edits, role):
        if edit != "D":
            digest.update((b"" if before == _START else b"\n") + own.encode() + b":" + (b"" if edit == "I" else text))
    return digest


def _ordered(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None,
             extra: tuple = ()) -> DataFrame:
    """Rows by conversation and turn with their faults; one shuffle."""
    q = lambda c: F.col(f"`{c}`")
    rows = turns.select(q(id_col).alias("id"), (F.lit(True) if present is None else present).alias("present"), q(turn_col).cast("long").alias("turn"),
                        F.coalesce(q(role_col), F.lit(" ")).alias("role"), F.coalesce(q(text_col), F.lit(" ")).alias("text"), *extra)
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    same = Window.partitionBy("id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.repartition("id").withColumn("repeated", F.row_number().over(same) > 1)  # the window is met by the shuffle on id
    rows = rows.withColumn("blank", last == "").withColumn("cut", ~last.isin(".", "!", "?"))
    return rows.sortWithinPartitions(F.asc_nulls_first("id"), F.asc_nulls_first("turn"), "role", "text", "repeated")  # of equal rows the first is none


def _noting_type(batches, kinds: list):
    """The batches; the type of their id becomes the first of ``kinds``."""
    for batch in batches:
        kinds[0] = batch.schema.field("id").type
        yield batch


def _conversations(batches, names: list):
    """(id, rows of it) one after the other; rows come as they are asked for, batch by batch."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in names))

    return groupby(rows(), key=lambda r: r[0])


def _flush(rows: list, names: list, kinds: list):
    """The rows as an Arrow batch; the list is emptied."""
    import pyarrow as pa

    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    rows.clear()
    return out


def _report_batches(batches):
    import pyarrow as pa

    names, kinds = ["id"] + [f.split()[0] for f in REPORT.split(", ")], [None] + [pa.int64()] * 6 + [pa.string()] * 2
    done = []
    for key, rows in _conversations(_noting_type(batches, kinds), ["id", "present", "turn", "role", "text", "repeated", "blank", "cut"]):
        audit: list = []
        walk, faults, gaps, illegal, previous = Repair(audit.append), [0, 0, 0], _Gaps(), 0, None
        for _, present, turn, role, text, repeated, blank, cut in rows:
            if not present:
                continue
            fault = 0 if blank else 1 if repeated else 2 if cut else None
            if fault is not None:
                faults[fault] += 1
            gaps.add(turn)
            illegal += previous is not None and previous + role[:1] not in ("su", "ua", "au")
            previous = role[:1]
            walk.row(role, text, fault in (0, 1), fault == 2)
        cost, digest = walk.finish()
        done.append((key, gaps.count(), *faults, illegal, cost, "".join(audit), digest))
        if len(done) >= 1000:
            yield _flush(done, names, kinds)
    if done:
        yield _flush(done, names, kinds)


class _Gaps:
    """Turn numbers missing between the least and the greatest of ascending turns."""

    def __init__(self):
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn):
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1

    def count(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def repair_report(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  present: Column | None = None) -> DataFrame:
    """One row per conversation: id, and the columns of ``REPORT``. Rows for which ``present`` is false only name
    their conversation."""
    ship_package(turns.sparkSession)
    rows = _ordered(turns, id_col, turn_col, role_col, text_col, present)
    sent = rows.select("id", "present", "turn", "role", F.col("text").cast("binary").alias("text"), "repeated", "blank", "cut")
    kind = turns.schema[id_col].dataType.simpleString()
    return sent.mapInArrow(_report_batches, f"id {kind}, {REPORT}").withColumnRenamed("id", id_col)


def _edit_batches(batches):
    """Edits of every row, as they become final: (id, row, repaired rows before it, edits with roles)."""
    import pyarrow as pa

    steps = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())]))
    names, kinds, ready = ["id", "row", "place", "steps"], [None, pa.int64(), pa.int64(), steps], []
    for key, rows in _conversations(_noting_type(batches, kinds), ["id", "present", "turn", "role", "row", "repeated", "blank", "cut"]):
        waiting, at = [], [0, _START]  # rows whose edits are open; repaired rows so far and their state
        waiting_from = [0]

        def emit(edits, key=key, waiting=waiting, at=at, waiting_from=waiting_from):
            row, role = waiting[waiting_from[0]] if waiting_from[0] < len(waiting) else (None, "")
            waiting_from[0] += 1
            if waiting_from[0] > 1000:
                del waiting[:waiting_from[0]]
                waiting_from[0] = 0
            found = [{"edit": e, "role": r} for e, r, _ in _steps(at[1], edits, role)]
            if found:
                ready.append((key, row, at[0], found))
            for step in found:
                if step["edit"] != "D":
                    at[0] += 1
                    at[1] = _KEEP[at[1]][step["role"][:1]]

        walk = Repair(emit, hashed=False)
        for _, present, _, role, row, repeated, blank, cut in rows:
            if present:
                waiting.append((row, role))
                walk.row(role, b"", blank or repeated, cut)
                if len(ready) >= 10_000:
                    yield _flush(ready, names, kinds)
        walk.finish()
    if ready:
        yield _flush(ready, names, kinds)


def repair_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired rows: id, position (from 0), edit (K, R or I), role, text, and the turn the row had (inserted rows: null)."""
    ship_package(turns.sparkSession)
    rows = write_shared(turns.withColumn("__row", F.monotonically_increasing_id()) if "__row" not in turns.columns else turns, "turns")
    ordered = _ordered(rows, id_col, turn_col, role_col, text_col, None, (F.col("__row").alias("row"),))
    kind = turns.schema[id_col].dataType.simpleString()
    edits = ordered.select("id", "present", "turn", "role", "row", "repeated", "blank", "cut") \
        .mapInArrow(_edit_batches, f"id {kind}, row long, place long, steps array<struct<edit: string, role: string>>")
    own = rows.select(F.col("__row").alias("row"), F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    found = edits.join(own, "row", "left").select("id", "turn", "text", "place", F.posexplode("steps").alias("nth", "step")).filter("step.edit <> 'D'")
    inserted = F.col("step.edit") == "I"
    return found.select(F.col("id").alias(id_col), (F.col("place") + F.col("nth")).alias("position"), "step.edit", F.col("step.role").alias("role"),
                        F.when(inserted, F.lit("")).otherwise(F.col("text")).alias("text"), F.when(~inserted, F.col("turn")).alias("turn"))
