"""Benchmark decontamination: BM25 index of the items, block-max WAND, overlap.

The items are indexed; the documents are the queries. Every document is read
whole, as overlapping passages wide enough to hold any item in one piece. A
passage retrieves every item whose BM25 score reaches a share of the item's
own score (what a passage with all its words gets): the item's own share,
below which no passage can hold the wanted shingles (`least_share`), by block-max WAND: lists
sorted by item with a maximum per list and per block, a pivot where the
maxima could reach the threshold, and skips over blocks that cannot. Before
that the same safe bound is taken for the whole document: only items that a
passage of all its words would retrieve go into its lists. They are found by
the words without all of which an item stays under the threshold.

A retrieved item counts as contaminating when the passage holds its question
and its answer: the shares of their five-word shingles (of the whole
sequence where shorter) found in the passage both reach `overlap`. An item's
answer is its last sentence; an item of one sentence has its last fifth.

The index is broadcast in shards of at most `shard_items` items, so its size
is bounded whatever the benchmark's; each shard is one pass over the
documents, without a shuffle. Collection statistics are those of all items.

Items without an id or a word are ignored; null or blank documents match
nothing. Rows that repeat give repeated results. Words are runs of letters,
digits and other characters that are neither blanks nor ASCII punctuation,
lower-cased.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import bound_batches

K1, B = 1.2, 0.75
OVERLAP = 0.8
SHINGLE = 5
SHARD_ITEMS = 20_000
BLOCK = 16
# ASCII punctuation and control characters become blanks.
_BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MARKS = "…–—“”‘’«»¿¡"
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if not text.isascii():
        for mark in _MARKS:
            text = text.replace(mark, " ")
    plain = text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED)
    return plain.decode("utf-8", "surrogatepass").split()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words, parted; the answer is the last sentence that has words."""
    parts = [w for s in _SENTENCE.split(text) if (w := words_of(s))]
    if len(parts) > 1:
        return [w for part in parts[:-1] for w in part], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 5) if len(words) > 1 else len(words)
    return words[:cut], words[cut:]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    n = min(SHINGLE, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def share_within(part: list[str], passage: list[str]) -> float:
    """Share of the part's shingles that the passage holds; 1 for no words."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    n = min(SHINGLE, len(part))
    there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return len(wanted & there) / len(wanted)


def least_share(question: list[str], answer: list[str], impacts: dict[str, float], overlap: float) -> float:
    """No passage with less of the item's score holds `overlap` of both parts' shingles.

    A missing word takes all shingles that hold it, and a shingle is taken by
    its own words at most: the words that may be missing are bounded by a
    fractional knapsack of shingles per part.
    """
    lost, seen = 0.0, set()
    for part in (question, answer):
        wanted = shingles(part)
        missing = len(wanted) - math.ceil(len(wanted) * overlap - 1e-9)
        room = missing * min(SHINGLE, len(part))
        cost = Counter(t for s in wanted for t in set(s))
        can = [(impacts[t], c) for t, c in cost.items() if t not in seen and c <= missing]
        for x, c in sorted(can, key=lambda e: -e[0] / e[1]):
            lost += x * min(1.0, room / c)
            room -= c
            if room <= 0:
                break
        seen.update(cost)
    return 1.0 - lost


class Lists:
    """Lists of (item, impact) by word, with maxima per list and per block."""

    def __init__(self, impacts: dict[int, dict[str, float]]):
        self.items = sorted(impacts)
        self.of: dict[str, tuple[list[int], list[float]]] = {}
        for k in sorted(impacts):
            for t, x in impacts[k].items():
                ids, scores = self.of.setdefault(t, ([], []))
                ids.append(k)
                scores.append(x)
        self.most = {t: max(s) for t, (_, s) in self.of.items()}
        self.blocks = {
            t: (
                [ids[min(j + BLOCK, len(ids)) - 1] for j in range(0, len(ids), BLOCK)],
                [max(s[j : j + BLOCK]) for j in range(0, len(ids), BLOCK)],
            )
            for t, (ids, s) in self.of.items()
        }


    def least(self, shares: list[float]) -> float:
        """The lowest of the items' thresholds: a bound for all of them."""
        return min((shares[k] for k in self.items), default=1.0)


# Of all items: their number, their mean length, the items that hold a word.
Statistics = tuple[int, float, dict[str, int]]


class Index:
    """Impacts of a shard's items, relative to each item's own score."""

    def __init__(
        self,
        items: list[tuple[int, str]],
        retrieve: float | None = None,
        overlap: float = OVERLAP,
        statistics: Statistics | None = None,
    ):
        kept = [(i, words, text) for i, text in items if i is not None and (words := words_of(text))]
        self.ids = [i for i, _, _ in kept]
        self.parts = [question_and_answer(text) for _, _, text in kept]
        self.longest = max((len(w) for _, w, _ in kept), default=0)
        counts = [Counter(w) for _, w, _ in kept]
        total, mean, in_items = statistics or (
            len(kept),
            sum(len(w) for _, w, _ in kept) / max(1, len(kept)),
            Counter(t for c in counts for t in c),
        )
        idf = {t: math.log(1 + (total - n + 0.5) / (n + 0.5)) for t, n in in_items.items()}
        self.impacts: dict[int, dict[str, float]] = {}
        #: Items by the words without all of which they cannot be retrieved.
        self.triggers: dict[str, list[int]] = {}
        #: The share of its own score at which an item is retrieved.
        self.least: list[float] = []
        for k, c in enumerate(counts):
            norm = K1 * (1 - B + B * sum(c.values()) / mean)
            impact = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            own = sum(impact.values())
            self.impacts[k] = {t: x / own for t, x in impact.items()}
            share = retrieve
            if share is None:
                share = least_share(*self.parts[k], self.impacts[k], overlap)
            self.least.append(share - 1e-9)
            rest = 0.0
            for t, x in sorted(self.impacts[k].items(), key=lambda e: e[1]):
                rest += x
                if rest >= self.least[k]:
                    self.triggers.setdefault(t, []).append(k)
        self.keys = frozenset(self.triggers)

    def possible(self, words: set[str]) -> dict[int, dict[str, float]]:
        """The items that some passage of these words could retrieve."""
        found = {k for t in self.keys & words for k in self.triggers[t]}
        return {
            k: self.impacts[k]
            for k in found
            if sum(x for t, x in self.impacts[k].items() if t in words) >= self.least[k]
        }

    def search(self, passage: set[str], lists: Lists) -> list[tuple[int, float]]:
        """All items (positions) whose score reaches the threshold, by WAND."""
        least = lists.least(self.least)
        cursors = [[lists.of[t][0][0], 0, t] for t in passage if t in lists.of]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for n, c in enumerate(cursors):
                bound += lists.most[c[2]]
                if bound >= least:
                    pivot = n
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, reach = 0.0, None
            for c in cursors[: pivot + 1]:
                ends, tops = lists.blocks[c[2]]
                j = bisect_left(ends, item, c[1] // BLOCK)
                if j < len(ends):
                    bound += tops[j]
                    reach = ends[j] if reach is None else min(reach, ends[j])
            if bound >= least:
                if cursors[0][0] == item:
                    total = sum(lists.of[c[2]][1][c[1]] for c in cursors[: pivot + 1])
                    if total >= self.least[item]:
                        found.append((item, total))
                    target = item + 1
                else:
                    target = item
            else:
                # No item up to the nearest block end, or the next list, can do.
                target = max(item, item if reach is None else reach) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, max(item + 1, cursors[pivot + 1][0]))
            moved = []
            for n, c in enumerate(cursors):
                if n <= pivot and c[0] < target:
                    ids = lists.of[c[2]][0]
                    c[1] = bisect_left(ids, target, c[1])
                    if c[1] == len(ids):
                        continue
                    c[0] = ids[c[1]]
                moved.append(c)
            cursors = moved
        return found

    def contaminations(self, text: str | None, overlap: float) -> list[tuple]:
        """(item id, score, question, answer, first word, words) of each item's best passage."""
        words = words_of(text)
        possible = self.possible(set(words)) if words else {}
        if not possible:
            return []
        lists = Lists(possible)
        width = max(128, 2 * self.longest)
        stride = width - self.longest
        best: dict[int, tuple] = {}
        for start in range(0, max(1, len(words) - self.longest), stride):
            passage = words[start : start + width]
            for k, score in self.search(set(passage), lists):
                question, answer = self.parts[k]
                q, a = share_within(question, passage), share_within(answer, passage)
                if q >= overlap and a >= overlap and (k not in best or score > best[k][1]):
                    best[k] = (self.ids[k], score, q, a, start, len(passage))
        return [best[k] for k in sorted(best)]


Shard = tuple[list[tuple[int, str]], Statistics | None]


def _item_words():
    @F.pandas_udf("array<string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([words_of(t) for t in batch], dtype=object)

    return run


def shards(items: DataFrame, shard_items: int = SHARD_ITEMS) -> Iterator[Shard]:
    """The items in lists of bounded expected size, dealt by a hash of the id.

    With each list the statistics of all items, for its own words; none where
    the list holds all items.
    """
    items = items.select("item_id", "text").where("item_id is not null and text is not null")
    n = max(1, math.ceil(items.count() / shard_items))
    if n == 1:
        yield sorted((r["item_id"], r["text"]) for r in items.distinct().collect()), None
        return
    words = items.distinct().select("item_id", "text", _item_words()("text").alias("words"))
    words = words.where(F.size("words") > 0)
    size = words.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    word = F.explode(F.array_distinct("words")).alias("word")
    held = words.select(word).groupBy("word").count()
    for k in range(n):
        of_shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k
        rows = items.where(of_shard).distinct().collect()
        own = words.where(of_shard).select(word)
        counts = {r["word"]: r["count"] for r in held.join(own, "word", "left_semi").collect()}
        yield sorted((r["item_id"], r["text"]) for r in rows), (size["n"], size["mean"] or 1.0, counts)


_FOUND = (
    "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double,"
    "first_word:int,passage_words:int>>"
)


def _search(held: Broadcast, overlap: float):
    @F.pandas_udf(_FOUND)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items, statistics = held.value
        index = Index(items, overlap=overlap, statistics=statistics)
        names = ("item_id", "score", "question_overlap", "answer_overlap", "first_word",
                 "passage_words")
        for batch in texts:
            yield pd.Series(
                [
                    [dict(zip(names, hit, strict=True)) for hit in index.contaminations(t, overlap)]
                    for t in batch
                ],
                dtype=object,
            )

    return run


def _clean(held: Broadcast, overlap: float):
    @F.pandas_udf("boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items, statistics = held.value
        index = Index(items, overlap=overlap, statistics=statistics)
        for batch in texts:
            yield pd.Series([not index.contaminations(t, overlap) for t in batch], dtype=bool)

    return run


def contaminated(
    docs: DataFrame, items: DataFrame, overlap: float = OVERLAP, shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """One row per document row and benchmark item that it holds."""
    bound_batches(docs.sparkSession)
    out = None
    for shard in shards(items, shard_items):
        held = docs.sparkSession.sparkContext.broadcast(shard)
        hits = F.explode(_search(held, overlap)("text")).alias("hit")
        found = docs.select("doc_id", hits)
        out = found if out is None else out.union(found)
    return out.select("doc_id", "hit.*")


def reject_contaminated(
    docs: DataFrame, items: DataFrame, overlap: float = OVERLAP, shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """The rows of `docs`, all columns, that hold no benchmark item."""
    bound_batches(docs.sparkSession)
    for shard in shards(items, shard_items):
        held = docs.sparkSession.sparkContext.broadcast(shard)
        docs = docs.where(_clean(held, overlap)("text"))
    return docs
