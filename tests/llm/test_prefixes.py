"""The conversation trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from llm.helpers import SF_DIR, read

from tidemark.llm.prefixes import conversation_trie, neighbour_corrections, op12_conversation_trie, sequences, share_openings

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_trie(sequences_by_id):
    members, ends = defaultdict(list), defaultdict(list)
    for conv_id, turns in sequences_by_id.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
        ends[tuple(turns)].append(conv_id)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        words = len(path[-1][1].encode().split()) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(convs) - 1) * words
    return sorted(
        (
            (
                min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path], leaves[path], saved[path],
                hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
            )
            for path, convs in members.items()
        ),
        key=str,
    )


def as_sequences(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
            convs[conv_id].append((turn is not None, turn or 0, role or "", digest, text or ""))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    want = brute_trie(rebuilt(as_sequences(read("conversations", "conv_id, turn, role, text"))))
    assert collected(op12_conversation_trie(spark, SF_DIR)) == want


def test_many_blocks_and_tasks(spark):
    """Blocks of a few turns: nearly every node is shared by neighbours, and must be counted once."""
    rnd = random.Random(12)
    for kinds in (1, 2, 4):
        rows = [
            (c, t, rnd.choice(["u", None]), rnd.choice(["a b", "a", None, "x y z"][:kinds]))
            for c in range(250)
            for t in range(rnd.choice([1, 2, 3, 5, 9]))
        ]
        df = spark.createDataFrame(rows, SCHEMA)
        for block in (5, 40, 100_000):
            assert collected(conversation_trie(sequences(df), block)) == brute_trie(as_sequences(rows))
        assert collected(conversation_trie(share_openings(sequences(df)), 30)) == brute_trie(rebuilt(as_sequences(rows)))


def test_hot_sequence_in_many_lists(spark):
    """A third of the conversations are equal: their ids reach the hash in several lists, in order."""
    rows = [(c, 0, "u", "same" if c % 3 == 0 else f"t {c % 50}") for c in range(30_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(conversation_trie(sequences(df), 50)) == brute_trie(as_sequences(rows))


def test_awkward_rows(spark):
    long = "w " * 200_000
    rows = [
        (1, None, None, None), (1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "a", "x"), (2, 5, "", ""), (2, 5, "u", "b"), (2, 5, "u", "a"),
        (None, 0, "u", "lost"), (3, 0, "u", long), (4, 0, "u", long), (-7, 0, "u", "n"), (3, 1, "1:u", ""), (4, 1, "1", "u"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digests", "2 AS node")
    assert collected(conversation_trie(sequences(df), 3)) == brute_trie(as_sequences(rows))
    assert conversation_trie(sequences(df.limit(0))).count() == 0
    assert op12_shared(spark, rows) == brute_trie(rebuilt(as_sequences(rows)))


def op12_shared(spark, rows):
    return collected(conversation_trie(share_openings(sequences(spark.createDataFrame(rows, SCHEMA)))))


def test_turnless_conversation_is_a_member_of_the_root(spark):
    """Conversation 21 takes more turns from the absent conversation 20 than it has."""
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(lone, 0, "u", "gone"), (40, 0, "u", "a b")]
    got = op12_shared(spark, rows)
    assert got == brute_trie(rebuilt(as_sequences(rows)))
    assert (lone, 0, None, 2, 1, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest()) in got


def test_one_deep_conversation(spark):
    rows = [(1, t, "u", "a") for t in range(3000)] + [(2, t, "u", "a") for t in range(1500)]
    got = conversation_trie(sequences(spark.createDataFrame(rows, SCHEMA)), 100)
    assert got.count() == 3001
    assert got.where("depth = 0").first().saved_tokens == 1500


def test_corrections_name_each_shared_node_once():
    a, b, c = (bytes([i]) * 16 for i in range(3))
    fixes = neighbour_corrections([a, b], [a, b, c], [2, 3, 4])
    assert [f[1:] for f in fixes] == [(-1, -1, -5), (-1, -1, -5), (0, -1, -3)]
    assert [f[1:] for f in neighbour_corrections([a], [b], [1])] == [(0, 0, 0)]
