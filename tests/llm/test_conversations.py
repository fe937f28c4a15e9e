"""Prefix trie of conversations against a dictionary of prefixes."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from lossloom.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, depth long, part long, digest string, path string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def content(row):
    role, text = row[2] or "", row[3] or ""
    return sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            own[row[0]].append(row)
    turns = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=lambda r: (r[1] is not None, r[1] or 0, content(r)))] for c, v in own.items()}
    nodes = defaultdict(set)
    ends = defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        path = turns.get(c - base, [])[:h] + mine[h:]
        ends[tuple(path)].append(c)
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].add(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = sum(saved[k] for k in children[path]) + ((len(nodes[path]) - 1) * len(path[-1][1]) if path else 0)
    return [(min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
             sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in nodes.items()]


def check(spark, rows, rows_a_run):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA)
    got = conversations.prefix_trie(df, rows_a_run=rows_a_run).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for c in [*range(0, 260), *range(-130, -90), 1000, 10**12]:
        for t in range(rng.choice([1, 2, 2, 3, 4, 6])):
            out.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "a longer turn", "é★", None])))
    copied = [("user", "same"), ("assistant", "same reply"), ("user", "and on")]
    for c in range(300, 420):
        out += [(c, t, *copied[t % 3]) for t in range(c % 4 + 5)]
    out += [(500, t, "user", str(t % 7)) for t in range(300)] + [(501, t, "user", str(t % 7)) for t in range(280)]
    out += [(None, 0, "user", "no conversation"), (7, 1, "user", "twice"), (7, 1, "user", "twice"), (7, 1, "user", "tie")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("rows_a_run", [1, 2, 5, 4096])
def test_every_node(spark, rows, rows_a_run):
    check(spark, rows, rows_a_run)


def test_single_conversations_and_no_turns(spark):
    check(spark, [(100, 0, "user", "x")], 4096)
    # Conversations whose own turns all fall into the opening of an absent one keep no turn and stand at the root.
    short = [(c, 0, "user", "x") for c in range(1, 99)]
    check(spark, short, 3)


def test_empty_table(spark):
    assert conversations.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    only_null = spark.createDataFrame([(None, 1, "a", "b", 1, 2, "x", "y")], SCHEMA)
    assert conversations.prefix_trie(only_null).count() == 0
