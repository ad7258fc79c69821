"""The prefix trie against a trie of nested dictionaries."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from lossgrid.llm import prefixes
from lossgrid.llm.common import prepared

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, key string"


def plain(rows):
    def hashed(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashed(role or "", text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, len(whole) == d))
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        return [p] + [q for k in kids.get(p, []) for q in below(k)]

    out = []
    for p, held in members.items():
        sub = below(p)
        ends = ",".join(str(c) for c in sorted(c for c, last in held if last))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in sub if q)
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in held), len(p), parent, len(held), len(kids.get(p, [])), sum(q not in kids for q in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(n, seed, texts=4, copies=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for t in range(rng.integers(1, 9)):
            rows.append((c * int(rng.integers(1, 3)) if seed == 2 else c, t, ["user", "assistant"][t % 2], f"text {rng.integers(0, texts)}"))
    for c in range(copies):
        rows += [(1000 + c, t, "user", f"copy {t}" * 3) for t in range(7)]
    return rows


def frame(session, rows):
    return session.createDataFrame([(*r, 1, "k") for r in rows], TURNS).repartition(5)


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


@pytest.mark.parametrize("rows", [
    table(150, 1), table(60, 2, texts=2), table(20, 3, copies=300),
    [(i, 0, "u", "same") for i in range(40)],
    [(i, i % 3, None, None) for i in range(30)],
    [(5, t, "u", f"{t}") for t in range(300)] + [(6, t, "u", f"{t}") for t in range(299)],
    [(1, None, "u", "a"), (1, None, "u", "a"), (1, 2, "u", "b"), (1, 2, "r", "b"), (1, 2, "u", "c" * 100_000), (None, 1, "u", "x"), (100, 0, "", ""), (101, 0, "z", "été")],
    [(0, 0, "u", "a"), (112, 0, "u", "a")],
])
def test_nodes_equal_a_plain_trie(session, rows):
    found = sorted((tuple(r) for r in prefixes.op13(frame(session, rows)).collect()), key=repr)
    assert found == plain(rows)
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(db.execute(prefixes.SQL_OP13).fetchall(), key=repr) == found


def test_no_conversations(session):
    assert prefixes.op13(frame(session, [])).count() == 0
    assert prefixes.op13(frame(session, [(None, 1, "u", "a")])).count() == 0


def test_intervals_equal_a_walk_to_both_sides():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 17, 64, 200):
        lcp = np.concatenate(([-1], rng.integers(0, 5, n - 1)))
        rows, depths = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        left, right = prefixes.extents(lcp, rows, depths)
        for i, d, a, b in zip(rows, depths, left, right):
            low = high = i
            while low > 0 and lcp[low] >= d:
                low -= 1
            while high + 1 < n and lcp[high + 1] >= d:
                high += 1
            assert (a, b) == (low, high)


def test_common_turns():
    a = bytes(range(64))
    assert prefixes.common_turns(a, a) == 4
    assert prefixes.common_turns(a, a[:40] + b"x" + a[41:]) == 2
    assert prefixes.common_turns(a[:32], a) == 2
    assert prefixes.common_turns(b"", a) == 0
