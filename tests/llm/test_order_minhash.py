"""Order MinHash fingerprints against a plain restatement of the method."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tastes.llm.order_minhash import SIZE, fingerprint_edits, likeness, with_signature

M64 = (1 << 64) - 1


def chain(parts) -> int:
    """Hash of a row's values, each seeded with the one before; null is skipped."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else struct.pack("<i" if isinstance(p, tuple) else "<Q", *(p if isinstance(p, tuple) else (p & M64,)))
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def brute_signature(text: str, kmer=3, tuple_size=2, size=SIZE) -> list[int]:
    """Every order by itself: the minimal numbered k-mers, in text order, hashed."""
    pieces = re.findall(r"[^\x20\x09-\x0D]{1,4}", text)
    if not pieces:
        return []
    seen, kmers = Counter(), []
    for i in range(max(len(pieces) - kmer, 0) + 1):
        h = chain(pieces[i : i + kmer])
        kmers.append((chain([h, (seen[h],)]), i))
        seen[h] += 1
    out = []
    for j in range(size):
        start = (1 << 63) + j * (2**64 // size)
        chosen = sorted(kmers, key=lambda k: (k[0] - start) & M64)[:tuple_size]
        while len(chosen) < tuple_size:  # a text with fewer k-mers repeats them
            chosen += chosen[: tuple_size - len(chosen)]
        h = chain([x >> 32 for x, _ in sorted(chosen, key=lambda k: k[1])]) >> 32
        out.append(h - (1 << 32) if h >= 1 << 31 else h)
    return out


TEXTS = [
    "", " \n\t ", "a", "abc", "one two", "Nd, Nd, Nd, Nd, Nd, Nd, Nd", "é漢字 " * 30,
    "the quick brown fox jumps over the lazy dog",
    " ".join(f"word{i * i % 37}" for i in range(400)),
    " ".join(f"w{i}" for i in range(3000)),
    "abcdefghi" * 500,
]


@pytest.mark.parametrize(("kmer", "tuple_size", "size"), [(3, 2, SIZE), (2, 3, 16), (1, 1, 8)])
def test_signatures_equal_brute_force(spark, kmer, tuple_size, size):
    rows = [(i, t, "kept") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, text string, hashes string")
    got = with_signature(df, "text", "sig", kmer, tuple_size, size)
    assert got.columns == ["id", "text", "hashes", "sig"]
    for r in got.collect():
        assert r.sig == brute_signature(r.text, kmer, tuple_size, size), r.text[:40]
        assert r.hashes == "kept"


def test_order_and_edits_lower_the_likeness(spark):
    words = [f"w{i * 7919 % 1009}" for i in range(600)]
    one_edit = [*words[:300], "other", *words[301:]]
    moved = words[300:] + words[:300]
    shuffled = sorted(words)
    df = spark.createDataFrame(
        [(" ".join(words), " ".join(x)) for x in (words, one_edit, moved, shuffled, ["no"] * 9)],
        "a string, b string",
    )
    df = with_signature(with_signature(df, "a", "sa"), "b", "sb").select(likeness("sa", "sb").alias("n"))
    same, edit, swapped, mixed, other = [r.n for r in df.collect()]
    assert same == 1 and 0.8 < edit < 1 and mixed < swapped < edit and other == 0


def edits(docs):
    """doc_id, text -> expected rows, by the contract; rows by descending id."""
    sig = {t: brute_signature(t) for t in {t for _, t in docs}}
    share = lambda a, b: (
        float(a == b) if not a or not b else sum(x == y for x, y in zip(a, b)) / len(a)
    )
    out = []
    for i, (d, t) in enumerate(docs):
        following = docs[(i + 1) % len(docs)]
        n = len(t) // 3
        edited = t[: len(t) - n] + following[1][:n]
        s, e = sig[t], brute_signature(edited)
        digits = lambda x: "".join(f"{v & 0xFFFFFFFF:08X}" for v in x)
        out.append(
            (d, len(t), hashlib.sha256(edited.encode()).hexdigest(), digits(s), digits(e), share(s, e), share(s, sig[following[1]]), following[0])
        )
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_edits_equal_brute_force(spark, docs_df, partitions):
    docs = [(d, TEXTS[d % len(TEXTS)] + " x" * (d % 5)) for d in range(40, -1, -1) if d % 6]
    df = docs_df(docs, partitions).withColumn("key", F.lit(1)).withColumn("copies", F.lit("a"))
    got = fingerprint_edits(df).collect()
    assert sorted(tuple(r) for r in got) == sorted(edits(docs))


def test_odd_rows(spark, docs_df):
    assert fingerprint_edits(docs_df([])).collect() == []
    [alone] = fingerprint_edits(docs_df([(5, "some words here")])).collect()
    assert (alone.near_next, alone.next_doc_id) == (1.0, 5)
    # null text, a repeated row, a repeated id with another text, rows without an id
    rows = [(3, None), (2, "same row of text"), (2, "same row of text"), (1, "one"), (1, "two"), (None, "n"), (None, None)]
    got = fingerprint_edits(docs_df(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 0), (0, 1), (1, 3), (1, 3), (2, 16), (2, 16), (3, 0)]
    assert len({tuple(r) for r in got if r.doc_id == 2}) == 1
    assert {r.next_doc_id for r in got if r.doc_id == 3} == {2} and {r.doc_id for r in got if r.next_doc_id == 3} == {None}
    [long] = fingerprint_edits(docs_df([(1, "lorem ipsum " * 100_000)])).collect()
    assert long.n_chars == 1_200_000 and long.near_next == 1.0


def test_no_python_on_the_main_path(spark, docs_df):
    plan = fingerprint_edits(docs_df([(1, "a b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
