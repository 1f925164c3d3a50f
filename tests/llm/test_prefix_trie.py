import hashlib
import os
import random
import zlib

import pytest

from tidelog.llm import prefix_trie
from tidelog.llm.prefix_trie import ordered_turns, prefix_trie as trie, rebuild

SCHEMA = "conv_id long, turn long, role string, text string, fp1 string, depth long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, group=5, folds=9):
    """Nodes by spreading every conversation into all its prefixes."""
    by_id = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.md5((text or "").encode()).hexdigest()
            by_id.setdefault(c, []).append((turn is not None, turn or 0, role or "", digest, text or ""))
    turns = {c: [(r[2], r[4]) for r in sorted(found)] for c, found in by_id.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % folds
        base = c - (abs(c) % group if c >= 0 else -(abs(c) % group))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {p: sum(1 for q in members if len(q) == len(p) + 1 and q[:len(p)] == p) for p in members}
    out = []
    for p, found in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in found if rebuilt[c] == p)
        out.append((
            min(found), len(p), min(members[p[:-1]]) if p else None, len(found), children[p],
            sum(1 for q in below if not children[q]),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    nodes = trie(rebuild(ordered_turns(frame), 5, 9))
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=str)


def conversations(seed, n, negative=False):
    pick = random.Random(seed)
    rows = []
    for c in range(-n if negative else 0, n):
        for turn in range(pick.randrange(0, 7)):
            rows.append((c, turn, pick.choice(["user", "assistant", None]), pick.choice(["a", "b", "é", "", None])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_version(spark, seed):
    rows = conversations(seed, 60, negative=seed == 2)
    assert found(spark, rows) == plain(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(0, None, "user", "first"), (0, 1, "user", "b"), (0, 1, "user", "a"), (0, 1, "user", "a"), (None, 0, "user", "x"),
            (7, 5, None, None), (7, 5, "", ""), (13, 0, "user", "long " * 30_000), (10**12, 0, "user", "alone")]
    assert found(spark, rows) == plain(rows)


def test_empty_table_has_no_nodes(spark):
    assert found(spark, []) == []


def test_many_children_and_common_ends(spark, monkeypatch):
    # A hot parent is broadcast, and its ends are hashed in blocks.
    monkeypatch.setattr(prefix_trie, "HOT_PARENTS", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = [(c, t, "user", "same") for c in range(40) for t in range(2)] + [(c, 2, "user", f"own {c}") for c in range(10, 30)]
    assert found(spark, rows) == plain(rows)


def test_members_are_not_gathered(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x", "", 0)], SCHEMA)
    plan = trie(rebuild(ordered_turns(rows), 5, 9))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are missing")
def test_query_on_the_smallest_table_equals_plain_version(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    nodes = trie(rebuild(ordered_turns(table), 5, 9)).select(*COLUMNS)
    assert sorted((tuple(r) for r in nodes.collect()), key=str) == plain(rows)
