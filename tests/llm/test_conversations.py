"""Conversation repair against a search over all edits, and its audits against plain strings."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from partflow.llm import conversations
from partflow.llm.conversations import Audits, Repair, damage, repair

SPACES = " \t\n\v\f\r"


def cheapest(rows):
    """(cost, audit, texts) over all edits of rows (role, text, delete, truncated): every state keeps every least string."""
    best = {"": (0, "", ())}

    def offer(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def after(state, initial):
        """States are what is kept so far, folded: '', 's', 'u', 'a'."""
        return initial if (state, initial) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")} else None

    def inserted(ways):
        for _ in range(3):
            for state, (c, a, t) in list(ways.items()):
                for role in ("user", "assistant"):
                    if after(state, role[0]):
                        offer(ways, role[0], (c + 5, a + "I", (*t, f"{role}:")))
        return ways

    best = inserted(best)
    for role, text, delete, truncated in rows:
        new = {}
        for state, (c, a, t) in best.items():
            offer(new, state, (c + 2, a + "D", t))
            if not delete:
                for edit, who, cost in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    to = after(state, who[:1])
                    if to:
                        offer(new, to, (c + cost + 5 * truncated, a + edit, (*t, f"{who}:{text}")))
        best = inserted(new)
    return min(best[s] for s in ("", "a") if s in best)


def outcome(rows):
    job = Repair()
    out = [e for r in rows for e in job.add(*r)]
    cost, rest = job.finish()
    out += rest
    return cost, "".join(e.edit for e in out), tuple(f"{e.role}:{e.text}" for e in out if e.edit != "D")


def row(kind, n):
    return ({"s": "system", "u": "user", "a": "assistant", "x": "tool", "e": ""}[kind[0]], f"t{n}.", "d" in kind, "t" in kind)


def test_all_short_conversations():
    kinds = ("s", "u", "a", "x", "ud", "at")
    for n in range(5):
        for combo in itertools.product(kinds, repeat=n):
            rows = [row(k, i) for i, k in enumerate(combo)]
            assert outcome(rows) == cheapest(rows), combo


@pytest.mark.parametrize("flush", [1, 40, 2048])
def test_long_conversations(monkeypatch, flush):
    """Agreed edits leave the tree early, late or never: the result is the same."""
    monkeypatch.setattr(conversations, "FLUSH", flush)
    rng = random.Random(flush)
    for n in (30, 200, 400):
        for kinds in (("s", "u", "a", "x", "e", "ud", "ad", "at", "st"), ("u",), ("a", "u", "u", "a"), ("s",), ("ud", "s")):
            rows = [row(rng.choice(kinds), i % 7) for i in range(n)]
            assert outcome(rows) == cheapest(rows)


def test_memory_stays_bounded(monkeypatch):
    monkeypatch.setattr(conversations, "FLUSH", 64)
    job, rng, most = Repair(), random.Random(1), 0
    for i in range(4000):
        job.add(*row(rng.choice(("u", "a", "at", "s", "ud")), i))
        most = max(most, len(job.tree.parent), len(job.rows))
    assert most < 400


@pytest.mark.parametrize("prime", [conversations._PRIME, 7])
def test_audits_compare_like_strings(monkeypatch, prime):
    """Also where nearly all hashes collide."""
    monkeypatch.setattr(conversations, "_PRIME", prime)
    rng = random.Random(prime)
    tree, texts = Audits(), [""]
    for _ in range(400):
        at = rng.randrange(max(0, len(texts) - 12), len(texts))
        edit = rng.choice("DK")
        tree.add(at, edit, None, None)
        texts.append(texts[at] + edit)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert tree.less(a, b) == (texts[a] < texts[b])
        top = tree.common([a, b])
        up = set(tree.path(a)) | {0}
        assert top in up and top in set(tree.path(b)) | {0} and all(n not in set(tree.path(b)) for n in tree.path(a, top))


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def brute(rows):
    held = defaultdict(list)
    for r in rows:
        held[r[0]]
    for r in damaged(rows):
        held[r[0]].append(r[1:])
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, ready = set(), [0, 0, 0], []
        for _, role, text in own:
            body = text.strip(SPACES)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            ready.append((role, text, fault in (0, 1), fault == 2))
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, texts = cheapest(ready)
        yield conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest()


def odd_rows():
    rng = random.Random(8)
    texts = ["", " \t", "Yes.", "No!", "cut", "why?\n", "a.b", "é.", "x" * 50_000 + "."]
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice([*texts, None])) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, None, None), (70, None, "user", "a."), (70, None, "assistant", "b."), (70, None, "user", "a.")]
    rows += rows[:9] + [(80, -(2**40), "user", "far."), (80, 2**40, "assistant", "near.")]
    rows += [(90, t, "user" if t % 2 else "assistant", rng.choice(["same.", f"t{t}."])) for t in range(900)]
    alone = next(c for c in range(100, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (alone, 0, "user", "gone.")]


def test_conversations(spark):
    """Nulls, empty and long texts, ties, repeated rows, a hot conversation, one that is dropped whole, clashing columns."""
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "k", True) for r in rows], "conv_id long, turn long, role string, text string, key string, dropped boolean").repartition(4)
    bad = damage(df)
    got = {tuple(r) for r in repair(bad).collect()}
    assert got == set(brute(rows))
    assert any(r[7] == "" and r[1:7] == (0,) * 6 for r in got)
    # The edits, one row each, give the same audit and the same digest.
    said = defaultdict(list)
    for r in sorted(repair(bad, turns=True).collect(), key=lambda r: r["seq"]):
        said[r["conv"]].append(r)
    for r in got:
        edits = said[r[0]]
        assert "".join(e["edit"] for e in edits) == r[7]
        assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in edits if e["edit"] != "D").encode()).hexdigest() == r[8]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair(damage(none)).collect() == [] and repair(damage(none), turns=True).collect() == []
