"""The prefix trie against plain dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tastes.llm.prefix_trie import common_prefix, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, tie), role, text))
    sequences = {}
    for conv, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(conv).encode()) % 9
        head = sorted(own.get(conv - conv % 5, []))[:h]
        sequences[conv] = tuple(x[1:] for x in head + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(sequences):
        s = sequences[conv]
        ends[s].append(conv)
        for d in range(len(s) + 1):
            members[s[:d]].append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            held[0], len(node), members[node[:-1]][0] if node else -1, len(held), children[node],
            leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest(),
        )
        for node, held in members.items()
    )


def rows_of(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert df.columns == names
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def talks(seed: int, conversations: int, variety: int, longest: int):
    """Few different turns, so that prefixes meet in many ways."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(conversations * 2), conversations):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "é" * rng.randrange(variety)))
    return rows


@pytest.mark.parametrize(
    ("seed", "conversations", "variety", "longest", "partitions"),
    [(1, 60, 2, 4, 1), (2, 150, 2, 6, 13), (3, 150, 1, 12, 40), (4, 80, 3, 30, 5), (5, 30, 1, 2, 64)],
)
def test_equals_brute_force(spark, seed, conversations, variety, longest, partitions):
    rows = talks(seed, conversations, variety, longest)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = rows_of(prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(rows)


def test_odd_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).collect() == []
    rows = [
        (None, 0, "user", "of no conversation"),
        (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"),
        (2, 5, "", "x" * 100_000), (3, None, "user", ""), (3, None, "", "user"),
        (6, 0, "user", "a"), (6, 1, "user", "a"), (7, 3, "r", "t"), (10, 0, "user", "long"),
        *((20, i, "user", f"turn {i}") for i in range(3000)),
        *((21, i, "user", f"turn {i}") for i in range(3000)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumns({c: F.lit("c") for c in ("key", "part", "turns", "size", "depth", "id", "base", "n")})
    assert rows_of(prefix_trie(clash)) == brute(rows)


def test_copies_over_many_partitions(spark):
    rows = [(c, 0, "user", "same") for c in range(0, 3000)] + [(c, 1, "user", "next") for c in range(0, 3000, 3)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert rows_of(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_common_prefix():
    digests = [bytes([i]) * 16 for i in range(9)]
    for n in range(9):
        for shared in range(n + 1):
            a = b"".join(digests[:n])
            b = b"".join(digests[:shared]) + b"z" * 16 * (n - shared + 2)
            assert common_prefix(a, b) == shared
