"""Byte-level BPE: encoding with a segment tree of pair ranks, and decoding.

Every match of the split pattern is encoded by itself. A match that is a
token is that token; otherwise its bytes are merged. A segment tree over the
byte positions holds, at each live position, the rank of the pair that
begins there; its root is the lowest rank and, among equals, the leftmost
position. A merge joins that pair, and the pairs of the merged part, of its
left neighbour and of the swallowed part are point updates: logarithmic
work per merge, whatever the length of the match. The new matches of a block
of texts that are short enough go through their trees together, as rows of
one array; longer ones have a tree each.

Matches seen before are remembered per task (bounded). The vocabulary is a
file of base64 tokens and ranks; its path is a parameter and every machine
has it with the tokenizer package. One pass, no shuffle; texts of any length
are read whole.

Null and empty texts have no ids and decode to empty bytes. Ids are packed
as little-endian unsigned 32-bit integers. Other columns pass unchanged.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import bound_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_NONE = 1 << 62
_CACHE = 200_000
_BLOCK_CHARACTERS = 500_000
# Leaves of the trees that are worked on together, and rows at a time.
_SIZES = (4, 8, 16, 32, 64)
_ROWS = 1 << 13


class Vocabulary:
    """Ranks by bytes, bytes by rank, and the rank of every pair of tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            parts = (line.split() for line in lines)
            self.ranks = {base64.b64decode(p[0]): int(p[1]) for p in parts if p}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        ranks = self.ranks
        self.pairs: dict[tuple[int, int], int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        # The same as arrays: sorted pair keys, and a row per pair of bytes.
        self.none = max(self.tokens) + 1
        keys = np.array([a * (self.none + 1) + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks = np.array(list(self.pairs.values()), np.int64)[order]
        self.byte_ids = np.array([ranks.get(bytes([b]), self.none) for b in range(256)], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair of ids, _NONE where they make no token."""
        wanted = left * (self.none + 1) + right
        at = np.searchsorted(self.keys, wanted).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], _NONE)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed token ids of every match."""
        out: list[bytes] = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[at] = rank.to_bytes(4, "little")
            elif len(piece) > _SIZES[-1]:
                out[at] = np.array(self.merge(piece), "<u4").tobytes()
            else:
                size = next(n for n in _SIZES if len(piece) <= n)
                by_size.setdefault(size, []).append(at)
        for size, ats in by_size.items():
            for start in range(0, len(ats), _ROWS):
                part = ats[start : start + _ROWS]
                for at, ids in zip(part, self._merge_rows([pieces[a] for a in part], size), strict=True):
                    out[at] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """One segment tree per row, all merging in step."""
        m, shift = len(pieces), leaves.bit_length() - 1
        lengths = np.fromiter(map(len, pieces), np.int64, m)
        place = np.arange(leaves)
        live = place < lengths[:, None]
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8)
        ids = np.full((m, leaves + 1), self.none, np.int64)
        ids[:, :leaves] = np.where(live, self.byte_ids[raw.reshape(m, leaves)], self.none)
        after = np.tile(np.arange(1, leaves + 2), (m, 1))
        before = np.tile(np.arange(-1, leaves), (m, 1))

        def leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank == _NONE, _NONE, (rank << shift) + at)

        tree = np.full((m, 2 * leaves), _NONE, np.int64)
        first = self.pair_ranks(ids[:, :leaves].ravel(), ids[:, 1:].ravel()).reshape(m, leaves)
        tree[:, leaves:] = leaf(first, place)
        k = leaves >> 1
        while k:
            tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])
            k >>= 1

        def put(rows: np.ndarray, at: np.ndarray, value) -> None:
            node = at + leaves
            tree[rows, node] = value
            for _ in range(shift):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root = tree[rows, 1]
            rank, i = root >> shift, root & (leaves - 1)
            j = after[rows, i]
            following = after[rows, j]
            ids[rows, i] = rank
            after[rows, i] = following
            before[rows, following.clip(max=leaves)] = i
            live[rows, j] = False
            put(rows, j, _NONE)
            put(rows, i, leaf(self.pair_ranks(rank, ids[rows, following.clip(max=leaves)]), i))
            h = before[rows, i]
            has = h >= 0
            back, h = rows[has], h[has]
            put(back, h, leaf(self.pair_ranks(ids[back, h], rank[has]), h))
            rows = rows[tree[rows, 1] != _NONE]
        packed = ids[:, :leaves][live].astype("<u4").tobytes()
        ends = 4 * np.cumsum(live.sum(axis=1))
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one match."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        ids = [self.ranks[piece[i : i + 1]] for i in range(n)]
        pairs = self.pairs
        leaves = 1 << (n - 1).bit_length()
        tree = [_NONE] * (2 * leaves)
        for i in range(n - 1):
            rank = pairs.get((ids[i], ids[i + 1]))
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for k in range(leaves - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            k = leaves + i
            tree[k] = value
            k >>= 1
            while k:
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1

        def pair_at(i: int) -> int:
            j = after[i]
            rank = pairs.get((ids[i], ids[j])) if j < n else None
            return _NONE if rank is None else rank * leaves + i

        while tree[1] != _NONE:
            rank, i = divmod(tree[1], leaves)
            j = after[i]
            ids[i] = rank
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            put(j, _NONE)
            put(i, pair_at(i))
            if before[i] >= 0:
                put(before[i], pair_at(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Packed ids of texts; remembers the matches it has seen."""

    def __init__(self, path: str, pattern: str):
        self.words, self.split = vocabulary(path), regex.compile(pattern)
        self.seen: dict[str, bytes] = {}

    def __call__(self, texts: pd.Series) -> list[bytes]:
        out: list[bytes] = []
        block: list[list[str]] = []
        size = 0
        for value in texts:
            block.append(self.split.findall(value) if value else [])
            size += len(value) if value else 0
            if size >= _BLOCK_CHARACTERS:
                out += self._flush(block)
                block, size = [], 0
        return out + self._flush(block)

    def _flush(self, block: list[list[str]]) -> list[bytes]:
        seen = self.seen
        new = set().union(*block).difference(seen)
        if len(seen) + len(new) > _CACHE:
            seen.clear()
            new = set().union(*block)
        names = list(new)
        ids = self.words.merge_all([p.encode("utf-8") for p in names])
        seen.update(zip(names, ids, strict=True))
        return [b"".join(map(seen.__getitem__, pieces)) for pieces in block]


def unpack(tokens: dict[int, bytes], packed: bytes | None) -> bytes:
    """The bytes that packed ids stand for."""
    if not packed:
        return b""
    return b"".join(map(tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the packed token ids of its text column."""
    bound_batches(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("binary")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path, pattern)
        for batch in texts:
            yield pd.Series(encoder(batch), dtype=object)

    return docs.withColumn(ids, run(text))


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids",
           decoded: str = "decoded") -> DataFrame:
    """`encoded` with the bytes that its packed token ids stand for."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("binary")
    def run(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = vocabulary(path).tokens
        for batch in packed:
            yield pd.Series([unpack(tokens, p) for p in batch], dtype=object)

    return encoded.withColumn(decoded, run(ids))


def round_trip(docs: DataFrame, path: str | None = None,
               pattern: str = public_tokenizers.PATTERN, text: str = "text") -> DataFrame:
    """`docs` with `coded`: ids, and what they decode to, in one Python worker."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("ids binary, decoded binary")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, tokens = Encoder(path, pattern), vocabulary(path).tokens
        for batch in texts:
            ids = encoder(batch)
            yield pd.DataFrame({"ids": ids, "decoded": [unpack(tokens, p) for p in ids]})

    return docs.withColumn("coded", run(text))
