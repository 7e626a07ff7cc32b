"""The trie against one built from whole sequences, and against SQL (tests of the registered queries)."""

import hashlib
import re
import zlib
from collections import Counter

from chainmart.llm import prefix_trie as pt

SF = "/root/testdata/sf0.01"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(rs)] for c, rs in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = Counter()
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[:-1] == q for x in members)]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        kids = sum(len(q) == len(p) + 1 for q in below)
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        nodes[min(cs), len(p), up, len(cs), kids, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return nodes


COLUMNS = "conv_id long, turn long, role string, text string, node string, depth string"
AWKWARD = [
    # equal conversations, one that begins another, null and repeated turns, empty texts, ids below zero and far apart
    *[(c, t, "user", f"t{t} w", "x", "y") for c in range(40, 60) for t in range(6)],
    (60, None, None, None, "x", "y"), (60, 1, "user", None, None, "y"), (61, 1, "user", "a b  c\n", "x", "y"),
    (61, 1, "user", "a b  c\n", "x", "y"), (62, 1, "", "", "x", "y"), (63, 2, None, "", "x", "y"),
    (-41, 1, "user", "neg", "x", "y"), (-40, 1, "user", "neg", "x", "y"), (10**15 + 1, 0, "user", "far", "x", "y"),
    (None, 1, "user", "lost", "x", "y"), (81, 0, "user", "turnless once its own first turns go", "x", "y"),
    *[(100 + i, 0, "user", "one", "x", "y") for i in range(30)],
    *[(200, t, "user", f"{t % 7}", "x", "y") for t in range(300)],
    *[(220 + i, t, "user", f"{t}", "x", "y") for i in (0, 1) for t in range(12)],
]


def test_trie(spark):
    awkward = spark.createDataFrame(AWKWARD, COLUMNS).repartition(4)
    for df in (awkward, spark.read.parquet(f"{SF}/conversations.parquet")):
        convs = rebuilt([tuple(r)[:4] for r in df.collect()])
        got = pt.trie(pt.with_shared_heads(df)).collect()
        assert Counter(map(tuple, got)) == brute(convs)
    assert any(not t for t in rebuilt([r[:4] for r in AWKWARD]).values())  # a turnless one is among them
    assert pt.trie(pt.with_shared_heads(awkward.limit(0))).count() == 0


def test_one_conversation(spark):
    df = spark.createDataFrame([(1, t, "user", "a b", "n", "d") for t in range(3)], COLUMNS)
    convs = rebuilt([(1, t, "user", "a b") for t in range(3)])
    assert Counter(map(tuple, pt.trie(pt.with_shared_heads(df)).collect())) == brute(convs)
