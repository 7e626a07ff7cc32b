"""Repairs against a search that keeps every cheapest path as a whole string."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from chainmart.llm import conversation_repair as cr

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\v\f\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        f = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(f)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by all prefixes of the pattern: whole paths, nothing decided early."""
    fs = faults(rows)
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}
    start = {"": (0, "", ())}

    def better(d, k, v):
        if k not in d or v[:2] < d[k][:2]:
            d[k] = v
            return True
        return False

    def inserts(d):
        again = True
        while again:
            again = False
            for k, (c, a, r) in list(d.items()):
                for to in grammar[k]:
                    if to in "ua":
                        again |= better(d, to, (c + 2, a + "I", (*r, ({"u": "user", "a": "assistant"}[to], ""))))
        return d

    now = inserts(start)
    for (role, text), f in zip(rows, fs):
        new, extra = {}, int(f == "truncated")
        for k, (c, a, r) in now.items():
            better(new, k, (c + 3, a + "D", r))
            if f in ("blank", "duplicate"):
                continue
            for to in grammar[k]:
                if role[:1] == to:
                    better(new, to, (c + extra, a + "K", (*r, (role, text))))
                if to in "ua":
                    full = {"u": "user", "a": "assistant"}[to]
                    better(new, to, (c + 2 + extra, a + "R", (*r, (full, text))))
        now = inserts(new)
    return min(now[k] for k in ("", "a") if k in now)


def exhaustive(rows):
    """The same by listing every edit script up to a length."""
    fs, best = faults(rows), None
    n = len(rows)
    for size in range(n, 2 * n + 3):
        for script in itertools.product("DIKR", repeat=size):
            if sum(e != "I" for e in script) != n:
                continue
            place, at, cost = "", 0, 0
            for e in script:
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[place]
                if e == "I":
                    place, cost = to, cost + 2
                    continue
                role, f = rows[at][0], fs[at]
                at += 1
                if e == "D":
                    cost += 3
                    continue
                if f in ("blank", "duplicate"):
                    break
                cost += int(f == "truncated") + 2 * (e == "R")
                if e == "K":
                    if not (role[:1] and (role[:1] in "s" and place == "" or role[:1] == to)):
                        break
                    to = role[:1]
                place = to
            else:
                if place in ("", "a") and (best is None or (cost, "".join(script)) < best):
                    best = cost, "".join(script)
    return best


def searched(rows):
    s, out = cr.Survivors(), []
    most = 0
    for (role, text), f in zip(rows, faults(rows)):
        out += s.push(role, text, f in ("blank", "duplicate"), f == "truncated")
        most = max(most, len(s.pending))
    out += s.finish()
    assert not s.pending
    return s.cost, "".join(e for e, _, _ in out), tuple((r, t) for e, r, t in out if e != "D"), most


def made(rng, n, roles):
    texts = ("fine.", "ok!", "cut", " ", "", "Why? ", "cut off\n", "done.")
    return [(roles[rng.integers(len(roles))], texts[rng.integers(len(texts))] + str(rng.integers(3)) * rng.integers(2)) for _ in range(n)]


def test_search_against_whole_paths():
    rng = np.random.default_rng(2)
    roles = ("user", "assistant", "system", "", "tool", "u", "sys")
    for i in range(3000):
        rows = made(rng, rng.integers(0, 14), roles[: 2 + i % 6])
        got = searched(rows)
        assert got[:3] == cheapest(rows), rows
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in got[2]))
    for _ in range(40):
        rows = made(rng, rng.integers(0, 4), roles)
        assert searched(rows)[:2] == exhaustive(rows)


def test_memory_is_bounded():
    """A long conversation with faults here and there is decided as it comes; a tie without end is still right."""
    rows = [(("user", "assistant")[i % 2], f"{i}." if i % 97 else "") for i in range(20_000)]
    got = searched(rows)
    assert got[3] < 20 and len(got[1]) >= 20_000
    tied = [("tool", f"{i}.") for i in range(301)]
    assert searched(tied)[:3] == cheapest(tied)


def report(conv, rows):
    """What the registered query says of damaged ``(turn, role, text)`` in order."""
    told = dict.fromkeys(cr.REPORT, 0)
    pairs = [(r, t) for _, r, t in rows]
    told |= {k: v for k, v in Counter(faults(pairs)).items() if k}
    turns = {t for t, _, _ in rows if t is not None}
    told["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    told["illegal"] = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    told["cost"], audit, repaired = cheapest(pairs)
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    return (conv, *(told[c] for c in cr.REPORT), audit, hashlib.sha256(text.encode()).hexdigest())


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = "user" if kind == 4 else shown[2], shown[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return Counter(report(c, sorted(rs, key=order)) for c, rs in convs.items())


AWKWARD = [
    (1, None, None, None, "x"), (1, None, "user", "hi.", "x"), (1, 5, "assistant", None, None), (1, 5, "assistant", "yo.", "x"),
    (None, 1, "user", "q?", "x"), (None, 2, "assistant", "a", "x"), (None, 2, "assistant", "a", "x"),
    (2, None, "system", "only.", "x"), (3, 9, "", "", "x"), (4, -3, "user", "z" * 300_000, "x"), (4, 10**12, "assistant", "é 　", "x"),
    *[(5, i, ("user", "assistant")[i % 2], f"t{i}.", "x") for i in range(3000)],
    *[(6 + i, 0, "user", "u.", "x") for i in range(60)],
]


def test_reports(spark):
    schema = "conv_id long, turn long, role string, text string, live string"
    awkward = spark.createDataFrame(AWKWARD, schema).repartition(5)
    assert any(r.audit == "" for r in cr.reports(cr.damaged(awkward), cr.F.col("live")).collect())
    for df in (awkward, spark.read.parquet(f"{SF}/conversations.parquet")):
        want = brute([tuple(r)[:4] for r in df.collect()])
        got = cr.reports(cr.damaged(df), cr.F.col("live")).collect()
        assert Counter(map(tuple, got)) == want
        assert any("I" in r.audit for r in got)
    assert cr.reports(awkward.limit(0)).count() == 0


def test_repair_gives_the_turns(spark):
    df = spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string, place string")
    told = {r.conv_id: r for r in cr.reports(df).collect()}
    rows = sorted(map(tuple, cr.repair(df).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
        group = list(group)
        assert [r[1] for r in group] == list(range(len(group)))
        assert "".join(r[2] for r in group) == told[conv].audit
        text = "\n".join(f"{r[3]}:{r[4]}" for r in group if r[2] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == told[conv].repaired_sha256
    assert cr.repair(df.limit(0)).count() == 0


def test_registered(spark):
    want = brute([tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()])
    out = cr.op12_conversation_repair(spark, "/root/testdata/sf0.001")
    assert out.columns == ["conv_id", *cr.REPORT, "audit", "repaired_sha256"]
    assert Counter(map(tuple, out.collect())) == want


@pytest.mark.parametrize("rows, audit", [([], ""), ([("user", "a.")], "KI"), ([("system", "a.")], "D"), ([("assistant", "b.")], "IK")])
def test_small(rows, audit):
    assert searched(rows)[1] == audit
