"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.llm.cases import SMALL
from tidemark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, c long, d long, path string"


def _plain(rows):
    """The contract, turn by turn: nodes as tuples in column order."""
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            conv[c].append((turn is not None, turn or 0, tie, role, text))
    conv = {c: [t[3:] for t in sorted(v)] for c, v in conv.items()}
    rebuilt = {}
    for c in conv:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = conv.get(base, [])[:h] + conv[c][h:]
    members = defaultdict(list)
    for c, s in sorted(rebuilt.items()):
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p, m in sorted(members.items(), key=lambda x: -len(x[0])):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(m) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in children[p])
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed, n, length, kinds):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(-3 * n, 3 * n), n):
        for t in range(rng.choice([0, 1, 2, 3, length])):
            out.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "bot", None, ""]), rng.choice([*("aé" * k for k in range(kinds)), None])))
    return out


def _got(spark, rows, leaf=pt.LEAF):
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in pt.prefix_trie(frame, leaf).collect()), key=str)


def test_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in pt.prefix_trie(table).collect()), key=str) == _plain(rows)


@pytest.mark.parametrize("seed,n,length,kinds,leaf", [(1, 30, 7, 2, 1), (3, 12, 24, 1, 2), (4, 40, 20, 3, 3)])
def test_random_tables(spark, seed, n, length, kinds, leaf):
    rows = _rows(seed, n, length, kinds)
    assert _got(spark, rows, leaf) == _plain(rows)


def test_edge_rows(spark):
    hot = [(7, i, "user", f"t{i % 3}") for i in range(120)]  # one conversation with most rows
    rows = [(None, 1, "user", "no conversation"), (10, None, None, None), (10, None, None, None), (10, 1, "user", ""),
            (11, 1, "", "user"), (12, 1, "user", "x" * 200_000), (13, 1, "user", "x" * 200_000), *hot]
    assert _got(spark, rows) == _plain(rows)


def test_empty_and_turnless(spark):
    assert _got(spark, []) == [] == _got(spark, [(None, 1, "user", "x")])
    alone = [c for c in range(1, 300) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:3]
    rows = [(c, 0, "user", "hello") for c in alone]  # their base is absent, so their only turn goes
    got = _got(spark, rows)
    assert got == _plain(rows) and len(got) == 1 and got[0][5] == 1


def test_positions_of_a_conversation_over_many_tasks(spark):
    frame = spark.createDataFrame([(c, t, "user", "") for c, n in ((1, 5), (2, 900), (3, 1)) for t in range(n)], "conv_id long, turn long, role string, text string")
    got = pt.positions(frame.repartition(4)).groupBy("c").agg({"pos": "max", "*": "count"}).collect()
    assert {r["c"]: (r["max(pos)"], r["count(1)"]) for r in got} == {1: (4, 5), 2: (899, 900), 3: (0, 1)}


@pytest.mark.parametrize("piece", [pt.PIECE, 40])
def test_members_hashed_over_many_tasks(spark, monkeypatch, piece):
    monkeypatch.setattr(pt, "PIECE", piece)
    rows = [(d, m, c) for d, m, n in ((1, 1, 400), (1, 2, 1), (2, 2, 3), (2, 3, 90)) for c in range(-5, n)]
    got = {(r["d"], r["m"]): r["sha"] for r in pt.ends_hashes(spark.createDataFrame(rows, "d long, m long, c long").repartition(4)).collect()}
    want = defaultdict(list)
    for d, m, c in sorted(rows):
        want[d, m].append(str(c))
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}
