"""Cross-tokenizer alignment of two vocabularies over the corpus's distinct texts.

Texts are grouped by the full text, so that each distinct one is tokenised and
aligned once, whatever its copies. The bytes of both token sequences must be
those of a space and the text; offsets where a token of either vocabulary ends
cut both sequences into groups, and all pairs of an A and a B token occurrence
of one group are links.

No token of either vocabulary has a space after a character of a word (checked
when they are loaded; otherwise a text is one unit). A space between two words is
then a place where tokens of both end, so a text is a row of units, a word each,
which are tokenised many at a time and remembered in a worker up to
`MEMO_CHARACTERS`: a word that returns costs one look-up.

The texts of a block, about `BLOCK_CHARACTERS`, are one row: a dictionary of
their distinct pairs, and each text's entries as places in it. Only dictionaries
are exploded: their pairs' copies add up to the corpus's counts (the documents
that hold a pair), which are compared with the highest of their A id and joined
back to the dictionaries, some thousand rows a block instead of every pair of
every text. Blocks meet their scored dictionary by block number, a bounded
group, and give their texts' measures, which go to the doc_ids by the digest of
the text, both sides as plain scans, so that adaptive execution can split a
text that very many documents hold.

Defined results: a text that is null or empty, and one whose joined token bytes
differ from a space and the text (a text with U+2581, or characters the model
normalises), has no tokens: zeros and an empty groups_sha256. Texts of any
length are whole; a group of the two sequences that is large on both sides is
counted by its distinct ids. Every row of the table gives one row, repeated
ids and texts too; a null doc_id stays null. An empty table gives an empty
result. Other columns of the table are not looked at, whatever their names.
The vocabularies are files that every machine has with the tokenizer package;
their paths are parameters.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import Scratch

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"

# Characters of texts worked on together, of new units tokenised as one text, of
# the texts of one block, and of the units a worker remembers.
SLICE_CHARACTERS = 400_000
UNIT_CHARACTERS = 100_000
BLOCK_CHARACTERS = 2_000_000
MEMO_CHARACTERS = 2_000_000
# Link occurrences of one group beyond which its pairs are counted by distinct ids.
GROUP_LINKS = 1 << 16

_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK_SQL = (
    "block long, keys array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups_sha256 array<string>, starts array<int>, places array<int>, "
    "times array<long>, pairs array<long>, copies array<long>"
)
_MEASURES_SQL = (
    "key binary, n_a long, n_b long, n_groups long, n_links long, "
    "n_best long, count_sum long, groups_sha256 string"
)

# A space between two words, where the tokens of both vocabularies end.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes, in
    order, for the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Side:
    """One vocabulary: ids of texts, and the bytes and decimal text of ids."""

    def __init__(self, tokens: list[bytes], encode):
        self.tokens = tokens
        self.encode = encode
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.crosses_words = any(re.search(r"\S ", t.decode("utf-8", "replace")) for t in tokens)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def side_a(path: str) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    characters = byte_characters()
    tokens = [b""] * model.get_vocab_size()
    for token, i in model.get_vocab().items():
        known = all(c in characters for c in token)
        tokens[i] = bytes(characters[c] for c in token) if known else token.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        found = model.encode_batch([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    return Side(tokens, encode)


@lru_cache(maxsize=2)
def side_b(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(piece[3:-1], 16)]))
        else:
            tokens.append(piece.replace("▁", " ").encode())
    return Side(tokens, lambda texts: model.encode(texts, num_threads=1))


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `starts`, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


@lru_cache(maxsize=2)
def _decimals(size: int) -> list[str]:
    """Decimal ids followed by a comma, a bar or a semicolon, at 3 * id + mark."""
    return [f"{i}{mark}" for i in range(size) for mark in ",|;"]


class Units:
    """Aligned units: counts, the groups as text, and their pairs with occurrences.

    A unit's number finds its entries in all of them; `same` tells whether both
    token sequences have the unit's bytes.
    """

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.whole = a.crosses_words or b.crosses_words
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.characters = 0
        self.texts: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)
        self.same = np.zeros(0, bool)
        self.lengths = np.zeros(0, np.int64)
        self.pairs = self.times = np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        return [text] if self.whole else _BETWEEN.split(text)

    def learn(self, units: list[str]) -> None:
        """Align units that are not known yet, many as one text."""
        found, some, characters = [], [], 0
        for unit in units:
            # A unit whose bytes cannot come back would move all that follow; the
            # first or last unit of a text may have white space at its ends.
            if self.whole or "\u2581" in unit or unit != unit.strip():
                found.append(([unit], self._align([unit])))
                continue
            some.append(unit)
            characters += len(unit) + 1
            if characters >= UNIT_CHARACTERS:
                found += self._together(some)
                some, characters = [], 0
        if some:
            found += self._together(some)
        for names, _ in found:
            for name in names:
                self.number[name] = len(self.number)
                self.characters += len(name)
        parts = [x for _, x in found]
        self.texts += chain.from_iterable(x[0] for x in parts)
        for i, name in enumerate(("counts", "same", "lengths", "pairs", "times"), 1):
            setattr(self, name, np.concatenate([getattr(self, name), *(x[i] for x in parts)]))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _together(self, units: list[str]) -> list:
        aligned = self._align(units)
        if aligned is not None:
            return [(units, aligned)]
        return [([u], self._align([u])) for u in units]

    def _align(self, units: list[str]):
        """Texts, counts, same, lengths, pairs and times; None if a unit of many differs."""
        a, b = self.a, self.b
        text = " ".join(units)
        raw = (" " + text).encode()
        [ids_a], [ids_b] = a.encode([text]), b.encode([text])
        if not raw == a.joined(ids_a) == b.joined(ids_b):
            if len(units) > 1:
                return None
            none = np.zeros(0, np.int64)
            return [""], np.zeros((1, 4), np.int64), np.zeros(1, bool), np.zeros(1, np.int64), none, none
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
        in_a, in_b = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        in_a[ends_a] = in_b[ends_b] = True
        last_a, last_b = in_b[ends_a], in_a[ends_b]  # the last token of its group
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n = int(last_a.sum())
        count_a, count_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
        unit_of = np.searchsorted(unit_ends, ends_a[last_a])

        # The tokens by group, A before B, each with the mark that follows it.
        coded = np.empty(len(ids_a) + len(ids_b), np.int64)
        coded[np.arange(len(ids_a)) + before_b[group_a]] = ids_a * 3 + last_a
        coded[np.arange(len(ids_b)) + (before_a + count_a)[group_b]] = ids_b * 3 + last_b * 2
        table = _decimals(max(len(a.tokens), len(b.tokens)))
        written = list(map(table.__getitem__, coded.tolist()))

        def by_unit(values) -> np.ndarray:
            return np.bincount(unit_of, values, minlength=len(units)).astype(np.int64)

        links = count_a * count_b
        counts = np.column_stack([by_unit(count_a), by_unit(count_b), by_unit(np.ones(n)), by_unit(links)])
        ends = np.cumsum(counts[:, 0] + counts[:, 1]).tolist()
        texts = ["".join(written[s:e])[:-1] for s, e in zip([0, *ends], ends)]

        # All pairs of a group: each A token with the group's run of B tokens.
        chosen = links[group_a] <= GROUP_LINKS
        runs = count_b[group_a[chosen]]
        pairs = np.repeat(ids_a[chosen], runs) * len(b.tokens) + ids_b[_runs(before_b[group_a[chosen]], runs)]
        times, owner = np.ones(len(pairs), np.int64), np.repeat(unit_of[group_a[chosen]], runs)
        for g in np.flatnonzero(links > GROUP_LINKS):
            x, times_x = np.unique(ids_a[group_a == g], return_counts=True)
            y, times_y = np.unique(ids_b[group_b == g], return_counts=True)
            pairs = np.concatenate([pairs, (x[:, None] * len(b.tokens) + y).ravel()])
            times = np.concatenate([times, (times_x[:, None] * times_y).ravel()])
            owner = np.concatenate([owner, np.full(len(x) * len(y), unit_of[g])])
        order = np.argsort(owner, kind="stable")
        return (
            texts,
            counts,
            np.ones(len(units), bool),
            np.bincount(owner, minlength=len(units)),
            pairs[order],
            times[order],
        )


@lru_cache(maxsize=1)
def _remembered(path_a: str, path_b: str) -> Units:
    """Units of a worker process, kept from one task to the next."""
    return Units(side_a(path_a), side_b(path_b))


class Block:
    """The aligned texts of one block, and the row they become."""

    def __init__(self) -> None:
        self.keys: list[bytes] = []
        self.copies: list[int] = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.characters = 0

    def add(self, keys, copies, texts: list[str], units: Units) -> None:
        if units.characters > MEMO_CHARACTERS:
            units.clear()
        parts = [units.split(t) for t in texts]
        new = dict.fromkeys(chain.from_iterable(parts)).keys() - units.number.keys()
        if new:
            units.learn(list(new))
        numbers = [list(map(units.number.__getitem__, p)) for p in parts]
        flat = np.fromiter(chain.from_iterable(numbers), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in numbers])
        same = np.ones(len(texts), bool)
        same[owner[~units.same[flat]]] = False
        flat, owner = flat[same[owner]], owner[same[owner]]
        counts = np.zeros((len(texts), 4), np.int64)
        np.add.at(counts, owner, units.counts[flat])
        for i, x in enumerate(numbers):
            groups = ";".join(map(units.texts.__getitem__, x)) if same[i] else ""
            self.digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        at = _runs(units.starts[flat], units.lengths[flat])
        size = len(units.a.tokens) * len(units.b.tokens)
        held, times = _sums(np.repeat(owner, units.lengths[flat]) * size + units.pairs[at], units.times[at])
        self.pairs.append(held % size)
        self.times.append(times)
        self.lengths.append(np.bincount(held // size, minlength=len(texts)))
        self.counts.append(counts)
        self.keys += keys
        self.copies += copies
        self.characters += sum(map(len, texts))

    def row(self, number: int) -> pa.RecordBatch:
        pairs, times, lengths = (np.concatenate(x) for x in (self.pairs, self.times, self.lengths))
        distinct, places = np.unique(pairs, return_inverse=True)
        copies = np.zeros(len(distinct), np.int64)
        np.add.at(copies, places, np.repeat(np.array(self.copies, np.int64), lengths))
        counts = np.concatenate(self.counts)
        starts = np.cumsum(lengths) - lengths
        values = [
            pa.array([number], pa.int64()),
            _row(self.keys, pa.binary()),
            *(_row(counts[:, i], pa.int64()) for i in range(4)),
            _row(self.digests, pa.string()),
            _row(starts, pa.int32()),
            _row(places, pa.int32()),
            _row(times, pa.int64()),
            _row(distinct, pa.int64()),
            _row(copies, pa.int64()),
        ]
        names = [c.split()[0] for c in _BLOCK_SQL.split(", ")]
        return pa.RecordBatch.from_arrays(values, names=names)


def _row(values, kind: pa.DataType) -> pa.Array:
    """One row that holds all values as its list."""
    flat = pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def aligner(path_a: str | None, path_b: str | None):
    """A function for `mapInArrow` from (key, text, copies) to block rows.

    A block's number is unique in the table that is written: the task's
    partition and a running number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _remembered(
            path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B)
        )
        block = Block()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys, copies = batch.column("key").to_pylist(), batch.column("copies").to_pylist()
            texts = batch.column("text").to_pylist()
            begin, characters = 0, 0
            for i, text in enumerate(texts):
                characters += len(text)
                if characters >= SLICE_CHARACTERS or i + 1 == len(texts):
                    part = slice(begin, i + 1)
                    block.add(keys[part], copies[part], texts[part], units)
                    begin, characters = i + 1, 0
                    if block.characters >= BLOCK_CHARACTERS:
                        yield block.row(number)
                        number, block = number + 1, Block()
        if block.keys:
            yield block.row(number)

    return run


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows with the counts of their dictionary -> a row per text."""
    names = [c.split()[0] for c in _MEASURES_SQL.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].values for n in batch.schema.names if n != "block"}
            places, starts = row["places"].to_numpy(), row["starts"].to_numpy()
            times = row["times"].to_numpy()
            sums = []
            for name in ("best", "held"):
                scores = row[name].to_numpy() if row[name] is not None else np.zeros(0, np.int64)
                running = np.concatenate([[0], np.cumsum(times * scores[places])])
                sums.append(running[np.append(starts[1:], len(places))] - running[starts])
            arrays = [row["keys"], *(row[n] for n in _MEASURES), *map(pa.array, sums), row["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def align_tokenizers(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    key = F.unhex(F.sha2("text", 256))
    # Grouped by the text itself; the digest only names the group afterwards.
    texts = (
        docs.where("text != ''")
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(key.alias("key"), "text", "copies")
    )
    blocks = scratch.save(texts.mapInArrow(aligner(path_a, path_b), _BLOCK_SQL), "blocks")

    counts = scratch.save(
        blocks.select(F.inline(F.arrays_zip("pairs", "copies")))
        .groupBy("pairs")
        .agg(F.sum("copies").alias("held")),
        "counts",
    ).withColumnRenamed("pairs", "pair")
    size_b = len(side_b(path_b or public_tokenizers.path(VOCABULARY_B)).tokens)
    id_a = F.floor(F.col("pair") / size_b).alias("id_a")
    highest = counts.groupBy(id_a).agg(F.max("held").alias("highest"))
    scored = scratch.save(
        counts.withColumn("id_a", id_a)
        .join(highest, "id_a")
        .select("pair", "held", (F.col("held") == F.col("highest")).cast("long").alias("best")),
        "scored",
    )
    dictionaries = (
        blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
        .join(scored, "pair")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "held", "best"))).alias("scores"))
        .select("block", F.col("scores.held").alias("held"), F.col("scores.best").alias("best"))
    )
    texts_of = blocks.select(
        "block", "keys", *_MEASURES, "groups_sha256", "starts", "places", "times"
    )
    measures = scratch.save(
        texts_of.join(dictionaries, "block", "left").mapInArrow(_measured, _MEASURES_SQL), "measures"
    )
    columns = ("doc_id", *_MEASURES, "n_best", "count_sum", "groups_sha256")
    with_text = docs.where("text != ''").select("doc_id", key.alias("key")).join(measures, "key")
    without = docs.where("text is null or text = ''").select("doc_id")
    for column in columns[1:-1]:
        without = without.withColumn(column, F.lit(0).cast("long"))
    without = without.withColumn("groups_sha256", F.lit(""))
    return with_text.select(*columns).union(without.select(*columns))
