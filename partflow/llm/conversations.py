"""Conversation structure repair: the cheapest edits, by a persistent audit DP.

A conversation's rows are read in order and edited from left to right: keep,
reroll to another role, delete, insert. The roles kept so far are one of four
states (nothing, system, user, assistant), and of each state only the cheapest
way there matters, ties to the least audit (the edits' initials).

The audits of all states are nodes of one tree: a node is an edit and a link to
the audit before it, so prefixes are shared and a step adds a few nodes. A node
has its ancestors at distances of powers of two and a rolling hash of its whole
audit. Two audits of one cost are compared at the first edit they differ in,
which is found by jumping up both as long as the hashes differ; where hashes
agree the edits themselves are compared, so a collision changes nothing.

What all live states agree on is final. It leaves the tree as the rows go by, so
a conversation of any length is a stream: Spark sorts it (and spills), one task
reads it, and memory holds the rows since the states last agreed. One task has to,
as the digest of a conversation is a chain over all its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK, END = " \t\n\v\f\r", ".!?"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a kept role initial, and the states it can follow.
_AFTER = {"s": (SYSTEM, (START,)), "u": (USER, (START, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
_NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_NAME = {USER: "user", ASSISTANT: "assistant"}
#: Nodes of a tree from which agreed edits leave it.
FLUSH = 2048
_PRIME, _BASE = (1 << 61) - 1, 0x5851F42D4C957F2D


class Audits:
    """A tree of audits: node 0 is the empty one."""

    def __init__(self):
        self.parent, self.edit, self.depth, self.hash, self.up = [0], [""], [0], [0], [()]
        #: What the edit did: number of its row (or None), new role (or None).
        self.row: list[int | None] = [None]
        self.role: list[str | None] = [None]

    def add(self, parent: int, edit: str, row: int | None, role: str | None) -> int:
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.parent.append(parent)
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _PRIME)
        self.up.append(tuple(up))
        self.row.append(row)
        self.role.append(role)
        return len(self.parent) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while (gap := self.depth[node] - depth) > 0:
            node = self.up[node][gap.bit_length() - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal: by hash, then verified edit by edit to where they meet."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def fork(self, a: int, b: int) -> tuple[int, int] | None:
        """The first edits in which two audits of one length differ."""
        if self.same(a, b):
            return None
        k = max(len(self.up[a]), 1) - 1
        while k >= 0:
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
            else:
                k -= 1
        return a, b

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before ``b`` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        at = self.fork(self.ancestor(a, depth), self.ancestor(b, depth))
        return self.depth[a] < self.depth[b] if at is None else self.edit[at[0]] < self.edit[at[1]]

    def common(self, nodes: list[int]) -> int:
        """The deepest node above (or among) all ``nodes``."""
        one = nodes[0]
        for node in nodes[1:]:
            depth = min(self.depth[one], self.depth[node])
            one, node = self.ancestor(one, depth), self.ancestor(node, depth)
            k = len(self.up[one]) - 1
            while one != node:
                while k >= len(self.up[one]) or (k > 0 and self.up[one][k] == self.up[node][k]):
                    k -= 1
                one, node = self.up[one][k], self.up[node][k]
        return one

    def path(self, node: int, above: int = 0) -> list[int]:
        """The nodes from below ``above`` to ``node``."""
        out = []
        while node != above:
            out.append(node)
            node = self.parent[node]
        return out[::-1]


class Edit(NamedTuple):
    edit: str
    role: str
    text: str


class Repair:
    """One conversation: ``add`` its rows in order, then ``finish``; final edits come out as they are known."""

    def __init__(self):
        self.tree = Audits()
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        self._inserts()
        self.rows: dict[int, tuple[str, str]] = {}
        self.at, self.most = 0, FLUSH

    def _offer(self, best: dict, state: int, cost: int, parent: int, edit: str, row: int | None, role: str | None) -> None:
        held = best.get(state)
        if held is not None and held[0] < cost:
            return
        node = self.tree.add(parent, edit, row, role)
        if held is None or cost < held[0] or self.tree.less(node, held[1]):
            best[state] = cost, node

    def _inserts(self) -> None:
        for state in (START, SYSTEM, ASSISTANT, USER):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(self.best, _NEXT[state], cost + INSERT, node, "I", None, _NAME[_NEXT[state]])

    def add(self, role: str, text: str, delete: bool, truncated: bool) -> list[Edit]:
        """``delete``: the row may not stay."""
        best: dict[int, tuple[int, int]] = {}
        extra = TRUNCATED if truncated else 0
        own = _AFTER.get(role[:1])
        for state, (cost, node) in self.best.items():
            self._offer(best, state, cost + DELETE, node, "D", self.at, None)
            if not delete:
                if own and state in own[1]:
                    self._offer(best, own[0], cost + KEEP + extra, node, "K", self.at, None)
                to = _NEXT[state]
                self._offer(best, to, cost + REROLE + extra, node, "R", self.at, _NAME[to])
        self.best = best
        self._inserts()
        self.rows[self.at] = role, text
        self.at += 1
        self._drop_hopeless()
        return self._flush() if len(self.tree.parent) > self.most else []

    def _drop_hopeless(self) -> None:
        """States that another one beats whatever follows.

        After an assistant everything can follow that can after a system row,
        and the conversation can also end. What can follow nothing at all only
        has a kept system row more, which costs no more than its deletion.
        """
        if ASSISTANT in self.best:
            cost = self.best[ASSISTANT][0]
            if SYSTEM in self.best and self.best[SYSTEM][0] > cost:
                del self.best[SYSTEM]
            if START in self.best and self.best[START][0] > cost + DELETE:
                del self.best[START]

    def _edits(self, nodes: list[int]) -> list[Edit]:
        out = []
        for n in nodes:
            row = self.tree.row[n]
            role, text = ("", "") if row is None else self.rows.pop(row)
            out.append(Edit(self.tree.edit[n], self.tree.role[n] or role, text))
        return out

    def _flush(self) -> list[Edit]:
        """The edits all live states agree on; the tree starts anew below them."""
        old = self.tree
        top = old.common([node for _, node in self.best.values()])
        done = self._edits(old.path(top))
        self.tree = Audits()
        moved = {top: 0}
        for state, (cost, node) in self.best.items():
            for n in old.path(node, top):
                if n not in moved:
                    moved[n] = self.tree.add(moved[old.parent[n]], old.edit[n], old.row[n], old.role[n])
            self.best[state] = cost, moved[node]
        self.most = max(FLUSH, 2 * len(self.tree.parent))
        return done

    def finish(self) -> tuple[int, list[Edit]]:
        """The cost, and the edits that have not come out yet."""
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        cost = min(c for c, _ in ends)
        node = None
        for c, n in ends:
            if c == cost and (node is None or self.tree.less(n, node)):
                node = n
        return cost, self._edits(self.tree.path(node))


class _Conversation:
    """Counts, digest and edits of one conversation while its rows go by."""

    def __init__(self):
        self.repair = Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.seq = 0
        self.low = self.high = self.before = self.last = None
        self.audit: list[str] = []
        self.sha, self.kept = hashlib.sha256(), 0

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> list[Edit]:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = role[:1]
        seen = seen or self.before == (turn, role, text)
        self.before = turn, role, text
        body = text.strip(BLANK)
        blank, duplicate, cut = not body, bool(body) and seen, bool(body) and not seen and body[-1] not in END
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        return self._done(self.repair.add(role, text, blank or duplicate, cut))

    def _done(self, edits: list[Edit]) -> list[Edit]:
        for e in edits:
            self.audit.append(e.edit)
            if e.edit != "D":
                self.sha.update(("\n" if self.kept else "").encode() + f"{e.role}:{e.text}".encode())
                self.kept += 1
        return edits

    def finish(self) -> tuple[tuple, list[Edit]]:
        cost, edits = self.repair.finish()
        edits = self._done(edits)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit), self.sha.hexdigest()), edits


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, dropped) with the damage that each row's hash calls for.

    By crc32 of ``conv:turn`` modulo 20: 0 drops the row (it stays as a marker,
    so that its conversation is not lost), 1 empties its text, 2 removes ``.``,
    ``!`` and ``?`` from it, 3 repeats it, 4 makes it the user's. A null role or text is one
    space, and so is a null id or turn in what is hashed.
    """
    kind = F.crc32(F.concat(_spaced(F.col(conv)), F.lit(":"), _spaced(F.col(turn)))) % 20
    plain = rows.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), _spaced(F.col(role)).alias("role"), _spaced(F.col(text)).alias("text"), kind.alias("kind")
    )
    body = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", END, "")).otherwise(F.col("text"))
    who = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = plain.select("conv", "turn", who.alias("role"), body.alias("text"), (F.col("kind") == 0).alias("dropped"), F.explode(times).alias("copy"))
    return out.drop("copy")


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame, turns: bool = False) -> DataFrame:
    """The cheapest repair of each conversation of ``rows`` (conv, turn, role, text, dropped).

    With ``turns`` a row for every edit, in order: (conv, seq, edit, role, text);
    deleted ones with what they said. Otherwise a row for each conversation: conv
    and the fields of SUMMARY. Rows are taken by turn, null ones first, rows of
    one turn by role and text. A fault is the first of blank, duplicate (role and
    text came before) and truncated. Dropped rows only name their conversation;
    one without other rows has zeros, an empty audit and the digest of no text.
    A null conversation is one of its own. Roles other than system, user and
    assistant are told apart by their initial only; an empty one follows nothing.
    An audit holds a letter per edit. An empty table gives an empty one.
    """
    rows = rows.select("conv", "turn", "role", "text", "dropped")
    sized = F.concat(_spaced(F.col("conv")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text"))
    # Markers get a key that no saying has, as nulls would all meet in one task.
    keyed = rows.withColumn("key", F.when(F.col("dropped"), F.md5(sized)).otherwise(F.sha2(sized, 256)))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    # Sayings that come more than once, and where first; counted before the shuffle, so a hot one is no hot key.
    often = keyed.filter("not dropped").groupBy("key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "first")
    late = F.coalesce(order > F.col("first"), F.lit(False))
    marked = keyed.join(often, "key", "left").select("conv", "turn", "role", "text", "dropped", late.alias("late"))
    ordered = marked.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []

        def said(edits: list[Edit]) -> None:
            if turns:
                for e in edits:
                    out.append((now, state.seq, e.edit, e.role, e.text))
                    state.seq += 1

        def ended() -> None:
            if state is not None:
                summary, edits = state.finish()
                said(edits)
                if not turns:
                    out.append((now, *summary))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * len(fields)
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields)
            out.clear()
            return made

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            for conv, turn, role, text, dropped, late in zip(*columns):
                if state is None or conv != now:
                    ended()
                    now, state = conv, _Conversation()
                if not dropped:
                    said(state.add(turn, role, text, late))
                if len(out) >= 4096:
                    yield batch_of()
        ended()
        yield batch_of()

    schema = "conv long, seq long, edit string, role string, text string" if turns else f"conv long, {SUMMARY}"
    fields = [f.split()[0] for f in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]
    return ordered.mapInArrow(run, schema)
