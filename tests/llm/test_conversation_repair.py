"""Operator 12 against enumeration and a plain string programme, in one block and in many, with colliding hashes and awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from segmenta.llm import conversation_repair as R
from segmenta.llm import queries

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    """Rows after damage by conversation, in order; conversations that lost all rows too."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out[conv] += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return ordered(out)


def ordered(convs):
    sha = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, sha(r))) for c, rows in convs.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def applied(rows, found, audit):
    """(cost, repaired rows) of an audit, or None where it is not allowed."""
    rows, found, cost, out = iter(zip(rows, found)), None, 0, []
    for e in audit:
        turn = "a" if out and out[-1][0][:1] == "u" else "u"
        name = {"u": "user", "a": "assistant"}[turn]
        if e == "I":
            cost += 5
            out.append((name, ""))
            continue
        (_, role, text), fault = next(rows)
        if e == "D":
            cost += 2
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += 5 * (fault == "truncated") + (e == "R")
        out.append((name if e == "R" else role, text))
    return (cost, out) if LEGAL.match("".join(r[:1] or "?" for r, _ in out)) else None


def enumerated(rows):
    found = faults(rows)
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for ins in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            audit = ins[0] + "".join(e + i for e, i in zip(edits, ins[1:]))
            got = applied(rows, found, audit)
            if got and (best is None or (got[0], audit) < best[:2]):
                best = (got[0], audit, got[1])
    return best


def plain(rows):
    """The same by (cost, audit) pairs held whole."""
    def filled(front):
        for to, sources in (("u", ("", "s", "a")), ("a", ("u",))):
            front[to] = min([front[to]] + [(front[s][0] + 5, front[s][1] + "I") for s in sources])
        return front

    never = (10**9, "")
    front = filled({"": (0, ""), "s": never, "u": never, "a": never})
    for (_, role, _), fault in zip(rows, faults(rows)):
        new = {s: (c + 2, x + "D") for s, (c, x) in front.items()}
        if fault not in ("blank", "duplicate"):
            more = 5 * (fault == "truncated")
            for s, (c, x) in front.items():
                to = "a" if s == "u" else "u"
                new[to] = min(new[to], (c + more + 1, x + "R"))
                if role[:1] == to:
                    new[to] = min(new[to], (c + more, x + "K"))
                if role[:1] == "s" and s == "":
                    new["s"] = min(new["s"], (c + more, x + "K"))
        front = filled(new)
    cost, audit = min(front[""], front["a"])
    return cost, audit, applied(rows, faults(rows), audit)[1]


def expected(conv, rows, solve=plain):
    cost, audit, out = solve(rows)
    found = faults(rows)
    turns = {r[0] for r in rows} - {None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{k: found.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}


def by_conv(rows):
    return sorted(rows, key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0))


def collected(df):
    return by_conv(r.asDict() for r in df.collect())


def made_up(n, most, seed):
    """Conversations of few different texts, so that faults and ties abound."""
    rng = random.Random(seed)
    return [(c, rng.choice([None, *range(most)]) if rng.random() < 0.3 else t,
             rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
             rng.choice(["Yes.", "No!", "", " \t\n", None, "half", "What? ", "a b.\x0b", "\x85", "Ü"]))
            for c in range(n) for t in range(rng.randint(1, most))]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_whole_table(spark):
    for folder in (SMALL, MEDIUM):
        t = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
        want = [expected(c, rows) for c, rows in damaged((r["conv_id"], r["turn"], r["role"], r["text"]) for r in t).items()]
        assert collected(queries.op12_conversation_repair(spark, folder)) == by_conv(want)


def test_against_enumeration(spark):
    rows = made_up(150, 4, 1)
    plan = ordered({c: [(t, " " if r is None else r, " " if x is None else x) for cc, t, r, x in rows if cc == c] for c in {r[0] for r in rows}})
    want = [expected(c, one, enumerated) for c, one in plan.items()]
    got = R.digest(R.as_given(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert collected(got) == by_conv(want)


@pytest.mark.parametrize("block_rows", [1, 3, 512])
def test_long_conversations_in_blocks(spark, block_rows):
    rows = made_up(6, 90, 2) + [(None, t, "user", "x.") for t in range(5)] + [(77, 1, "user", "same")] * 40
    want = [expected(c, one) for c, one in damaged(rows).items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(R.digest(R.damage(df), block_rows)) == by_conv(want)


def test_repaired_rows(spark):
    rows = made_up(20, 12, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    want = {c: plain(one)[2] for c, one in damaged(rows).items()}
    got = defaultdict(list)
    for r in sorted(R.repair(R.damage(df), 2).collect(), key=lambda r: (r.conv_id, r.place)):
        assert r.place == len(got[r.conv_id])
        got[r.conv_id].append((r.role, r.text))
    assert {c: x for c, x in want.items() if x} == dict(got)


def test_awkward_tables(spark):
    wide = "conv_id long, turn long, role string, text string, block string, kind string, copies string, content int"
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x.", "b", "k", "c", 1), (None, None, None, None, "b", "k", "c", 1), (5000, None, "assistant", "y" * 300_000 + ".", "b", "k", "c", 1)]
    got = collected(R.digest(R.damage(spark.createDataFrame(rows, wide))))
    assert got == by_conv(expected(c, one) for c, one in damaged(r[:4] for r in rows).items())
    lost = next(r for r in got if r["conv_id"] == gone)
    assert lost["audit"] == "" and lost["cost"] == 0 and lost["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert R.digest(R.damage(spark.createDataFrame([], wide))).count() == 0


def test_collisions_are_verified(monkeypatch):
    """With a hash of two values the order of audits stays that of their strings."""
    monkeypatch.setattr(R.Audits, "PRIME", 2)
    rng, audits = random.Random(4), R.Audits()
    nodes = {0: ""}
    for _ in range(400):
        parent = rng.choice(list(nodes))
        label = rng.choice("DIKR")
        nodes[audits.add(parent, label)] = nodes[parent] + label
    for a, b in itertools.product(rng.sample(list(nodes), 80), repeat=2):
        assert audits.before(a, b) == (nodes[a] < nodes[b])
    for one in ordered({0: [(t, *rng.choice([("user", "a."), ("assistant", "b."), ("user", "c"), ("system", "d."), ("tool", "e.")])) for t in range(30)]}).values():
        items = [(r[1][:1], 1, f == "blank", f == "duplicate", f == "truncated") for r, f in zip(one, faults(one))]
        cost, audit = R.joined_blocks([R.block_cells(items[i:i + 7], [0] if not i else [0, 1, 2, 3]) for i in range(0, len(items), 7)])
        assert (cost, "".join(audit)) == plain(one)[:2]
