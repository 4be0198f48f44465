"""Tokenizer alignment against a walk over both token sequences."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import tastes.llm.alignment as alignment
from tastes.llm.alignment import VOCABULARY_A, VOCABULARY_B, align_tokenizers


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(public_tokenizers.path(VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY_B))


def byte_of() -> dict[str, int]:
    """Byte-level characters, from the vocabulary's own one-byte tokens: 256 in order of byte class."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in keep]
    return {**{chr(b): b for b in keep}, **{chr(256 + i): b for i, b in enumerate(moved)}}


def groups_of(text: str, models):
    """Groups of (A ids, B ids), or None if the bytes differ."""
    if not text:
        return None
    a, b = models
    chars = byte_of()
    encoded, ids_b = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    ta = [bytes(chars[c] for c in t) for t in encoded.tokens]
    pieces = [b.id_to_piece(i) for i in ids_b]
    tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    if not b"".join(ta) == (" " + text).encode() == b"".join(tb):
        return None
    groups, i, j, end_a, end_b = [], 0, 0, 0, 0
    while i < len(ta):
        ga, gb = [encoded.ids[i]], [ids_b[j]]
        end_a, end_b, i, j = end_a + len(ta[i]), end_b + len(tb[j]), i + 1, j + 1
        while end_a != end_b:
            if end_a < end_b:
                ga.append(encoded.ids[i])
                end_a, i = end_a + len(ta[i]), i + 1
            else:
                gb.append(ids_b[j])
                end_b, j = end_b + len(tb[j]), j + 1
        groups.append((ga, gb))
    return groups


def brute(docs, models):
    found = [(d, groups_of(t, models) or []) for d, t in docs]
    held = defaultdict(set)
    for row, (_, groups) in enumerate(found):
        for ga, gb in groups:
            for pair in ((x, y) for x in ga for y in gb):
                held[pair].add(row)
    best = defaultdict(int)
    for (x, _), rows in held.items():
        best[x] = max(best[x], len(rows))
    out = []
    for d, groups in found:
        counts = [(x, len(held[x, y])) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        out.append(
            (
                d, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(counts),
                sum(n == best[x] for x, n in counts), sum(n for _, n in counts),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "<|endoftext|> and <s> are text </s>", "1234567 89 0.5",
    "Größe, naïve café — déjà vu", "漢字かな交じり文 😀👩‍👩‍👧", "has ▁ in it", "tabs\tand\n\nlines  \r\n end ", " ",
    "a", "zzzzqqqqxxxx" * 40, "x" * 3000, "<0x41> \x00\x07 control", "don't I'll we've", "ﬁ ½ ① Å",
]


def test_equals_brute_force(spark, docs_df, models):
    docs = [(i, TEXTS[i % len(TEXTS)] + (" again" * (i // 28))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, TEXTS[0]), (102, TEXTS[0]), (None, TEXTS[3])]
    df = docs_df(docs).withColumns({c: F.lit("c") for c in ("key", "copies", "pair", "n_a", "pairs")})
    got = align_tokenizers(df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, models)


def units_of(monkeypatch, whole=False, links=1 << 16):
    monkeypatch.setattr(alignment, "GROUP_LINKS", links)
    units = alignment.Units(
        alignment.side_a(public_tokenizers.path(VOCABULARY_A)),
        alignment.side_b(public_tokenizers.path(VOCABULARY_B)),
    )
    assert not units.whole
    units.whole = whole
    return units


def row_of(units, texts):
    block = alignment.Block()
    for t in texts:
        block.add([t.encode()], [2], [t], units)
    return block.row(0).to_pydict()


def test_units_and_large_groups_change_nothing(monkeypatch):
    texts = [t for t in TEXTS if t] + ["two  spaces", " leads", "ends ", "a \u00a0 b", "x\x1c y", "\u3000 wide  \u2003"]
    plain = row_of(units_of(monkeypatch, whole=True), texts)
    assert row_of(units_of(monkeypatch), texts) == plain
    assert row_of(units_of(monkeypatch, links=0), texts) == plain
    monkeypatch.setattr(alignment, "MEMO_CHARACTERS", 5)
    monkeypatch.setattr(alignment, "UNIT_CHARACTERS", 7)
    assert row_of(units_of(monkeypatch), texts) == plain


def test_odd_tables(spark, docs_df):
    assert align_tokenizers(docs_df([])).collect() == []
    [row] = align_tokenizers(docs_df([(1, None)])).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "")
    [row] = align_tokenizers(docs_df([(1, "word " * 100_000)])).collect()
    assert row.n_a > 90_000 and row.n_best == row.n_links == row.count_sum
