"""Substring dedup: lines, paragraphs and pieces, hashed and grouped globally.

Units of a document, normalised (case, blanks) and hashed to 64 bits:

* every whole line, and every paragraph (lines up to a blank one);
* two neighbouring pieces of the whole text, over line ends. A piece ends
  after the word whose hash is the least of some `_WINDOW` consecutive words
  (winnowing); only the normalised words decide. Two equal stretches of n
  words have the same pieces but for `_WINDOW - 1` words at either end at
  most, whatever stands beside them and wherever their lines end;
* sentences: stretches of a line that end after a word that ends a sentence,
  before a capital that follows a word without one, and after words picked by
  their hash (1 in 32). They give a repeat its exact ends where it has them.

Hashes are polynomials over code points, then over the words' hashes, mixed:
a text's units are array work on the whole text, and a word is never an
object of its own. Very long texts are hashed in blocks of whole words.

Per hash the smallest document id is found by a partial aggregation; that
document keeps its first such unit, every other occurrence is a repeat.

Words that repeated units cover are cut out when they form a run of `min_run`
words or more, or fill a line or paragraph of `min_line` words or more;
shorter ones ("Yes.") are left, so ordinary text is not shredded. So every
stretch of `min_run + 2 * _WINDOW - 2` words or more (49 with the defaults)
that an earlier document holds, or the document itself before, loses
`min_run` words at least. Every removed unit survives in the document that
ranks first. Offsets of the removed stretches in the original text are
returned (code points, end exclusive).

Two shuffles of (hash, id) pairs and one join by id; texts are never grouped.
A unit in a third of all documents is one row per task of the aggregation,
and its join partition can be split, as both sides are scans.

Null texts stay null, empty ones empty. Rows that repeat a doc_id count as
one document: they keep what that document keeps. Every row without an id is
a document of its own; these rank last, in an order fixed when their keys are
written. Repeats are gathered and joined by row, never by id alone. An empty
table gives an empty result. Columns called like those added or used here
stay; the added ones then get underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import BLANKS, Scratch, bound_batches
from tastes.llm.common import free_name as _free

MIN_RUN = 25
MIN_LINE = 5
# A word ends a sentence where the upper bits of its hash are zero: 1 in 32.
_CUT_BITS = np.uint64(64 - 5)
# A run of MIN_RUN words is left of any 49 words: 25 + 2 * (13 - 1).
_WINDOW = 13
_BASE = 0x9E3779B97F4A7C15 | 1
# Code points hashed at a time; a longer word is taken whole.
_BLOCK = 1 << 16
# Marks that end a sentence, and marks that may follow them.
_ENDS = ".!?…。！？"
_CLOSING = "\"')]}»”’"


class Units(NamedTuple):
    """A text's words (places, lines) and its units (ranges of words, digests)."""

    starts: np.ndarray
    ends: np.ndarray
    line: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    digest: np.ndarray
    whole: np.ndarray  # whether the unit is a line or paragraph


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2^64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1024)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]))
                for b in (np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64)))
            )
        return self.up[:n], self.down[:n]


_powers = _Powers()


@cache
def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: whether it is a capital, ends a sentence, may follow an end."""
    upper = np.fromiter((chr(c).isupper() for c in range(0x110000)), bool, 0x110000)
    ends, closing = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    ends[[ord(c) for c in _ENDS]] = True
    closing[[ord(c) for c in _CLOSING]] = True
    return upper, ends, closing


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _places(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; only the six ASCII blanks part words."""
    blank = np.ones(len(points) + 2, bool)
    blank[1:-1] = (points == 32) | (points - np.uint32(9) < 5)
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges [begin, end) of `values`."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return _mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    found = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        base = starts[a]
        b = int(np.searchsorted(starts, base + _BLOCK))
        block = points[base : ends[b - 1]].astype(np.uint64)
        found[a:b] = _ranges(block, starts[a:b] - base, ends[a:b] - base)
        a = b
    return found


def _piece_ends(hashes: np.ndarray) -> np.ndarray:
    """Ends of pieces: after the least hash (the last of equals) of any window."""
    n = len(hashes)
    if n < _WINDOW:
        return np.zeros(0, np.int64)
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | (low - np.arange(n, dtype=np.uint64))
    size = 1
    while size < _WINDOW:
        step = min(size, _WINDOW - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    chosen = np.zeros(n, bool)
    chosen[(low - (least & low)).astype(np.int64)] = True
    return np.flatnonzero(chosen) + 1


def units_of(text: str) -> Units | None:
    """The units of `text`; none where it has no word."""
    points = _points(text)
    starts, ends = _places(points)
    n = len(starts)
    if not n:
        return None
    # Lower case may be longer, but it has the same words.
    low = _points(text.lower())
    hashes = _word_hashes(low, *((starts, ends) if len(low) == len(points) else _places(low)))
    line = np.searchsorted(np.flatnonzero(points == 10), starts)

    upper, ending, closing = _kinds()
    capital = upper[points[starts]]
    # The last character of each word that is not a closing mark.
    plain = np.where(closing[points], np.int32(-1), np.arange(len(points), dtype=np.int32))
    plain = np.maximum.accumulate(plain)[ends - 1]
    stop = (plain >= starts) & ending[points[plain]] | (hashes >> _CUT_BITS == 0)
    last = np.append(line[1:] != line[:-1], True)
    stop |= last
    stop[:-1] |= capital[1:] & ~capital[:-1]

    def stretches(after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([[0], after[:-1]]), after

    line_begin, line_end = stretches(np.flatnonzero(last) + 1)
    # Paragraphs of more than one line.
    at = line[line_begin]
    new = np.flatnonzero(np.diff(at) > 1) + 1
    top, bottom = np.append(0, new), np.append(new, len(at)) - 1
    many = bottom > top
    cuts = np.concatenate([[0], _piece_ends(hashes), [n]])
    cuts = cuts[np.append(True, np.diff(cuts) > 0)]
    pair_begin, pair_end = (cuts[:-2], cuts[2:]) if len(cuts) > 2 else (cuts[:-1], cuts[1:])
    part_begin, part_end = stretches(np.flatnonzero(stop) + 1)
    begin = np.concatenate([line_begin, line_begin[top[many]], pair_begin, part_begin])
    end = np.concatenate([line_end, line_end[bottom[many]], pair_end, part_end])
    whole = np.arange(len(begin)) < len(line_begin) + int(many.sum())
    digest = _ranges(hashes, begin, end).view(np.int64)
    return Units(starts, ends, line, begin, end, digest, whole)


def _again(units: Units) -> np.ndarray:
    """Units that the text holds before, without overlap."""
    order = np.lexsort((units.end, units.digest))
    sorted_digest = units.digest[order]
    new = np.append(True, sorted_digest[1:] != sorted_digest[:-1])
    first_end = units.end[order][new][np.cumsum(new) - 1]
    again = np.empty(len(order), bool)
    again[order] = units.begin[order] >= first_end
    return again


def cut_repeats(
    text: str, units: Units | None, elsewhere: np.ndarray, min_run: int, min_line: int
) -> tuple[str, list[tuple[int, int]]]:
    """The text without its repeats, and the removed stretches.

    `elsewhere` are the digests that a document before this one holds.
    """
    if units is None:
        return text, []
    hit = _again(units)
    if len(elsewhere):
        hit |= np.isin(units.digest, elsewhere)
    n = len(units.starts)

    def covered(which: np.ndarray) -> np.ndarray:
        opened = np.bincount(units.begin[which], minlength=n + 1)
        return np.cumsum(opened - np.bincount(units.end[which], minlength=n + 1))[:n] > 0

    repeat = covered(hit)
    if not repeat.any():
        return text, []
    doomed = covered(hit & units.whole & (units.end - units.begin >= min_line))
    # Runs of repeats, over line ends; a blank line does not break a run.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], repeat, [False]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    # Lines that repeats fill.
    first = np.flatnonzero(np.append(True, units.line[1:] != units.line[:-1]))
    stop = np.append(first[1:], n)
    sums = np.concatenate([[0], np.cumsum(repeat)])
    full = (sums[stop] - sums[first] == stop - first) & (stop - first >= min_line)
    long = end - begin >= min_run
    for a, b in zip(
        np.concatenate([begin[long], first[full]]).tolist(),
        np.concatenate([end[long], stop[full]]).tolist(),
        strict=True,
    ):
        doomed[a:b] = True
    if not doomed.any():
        return text, []
    return _without(text, units, doomed, first)


def _without(
    text: str, units: Units, doomed: np.ndarray, first: np.ndarray
) -> tuple[str, list[tuple[int, int]]]:
    """The text without the words of `doomed`; `first` are the lines' first words."""
    n = len(doomed)
    is_first = np.zeros(n + 1, bool)
    is_first[first] = is_first[n] = True
    before, after = np.append(False, doomed[:-1]), np.append(doomed[1:], False)
    opens = np.flatnonzero(doomed & (~before | is_first[:-1]))
    closes = np.flatnonzero(doomed & (~after | is_first[1:]))
    spans = list(zip(units.starts[opens].tolist(), units.ends[closes].tolist(), strict=True))
    # What follows a stretch in its line goes on with the next word.
    ends_line = is_first[closes + 1]
    resume = np.where(ends_line, units.ends[closes], units.starts[np.minimum(closes + 1, n - 1)])
    lines = text.split("\n")
    offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])])
    gone = is_first[opens] & ends_line  # the whole line
    touched: dict[int, list[tuple[int, int]]] = {}
    dropped = set(units.line[opens[gone]].tolist())
    for at, a, b in zip(
        units.line[opens].tolist(), units.starts[opens].tolist(), resume.tolist(), strict=True
    ):
        touched.setdefault(at, []).append((a, b))
    kept = []
    for k, line in enumerate(lines):
        if k in dropped:
            continue
        if k in touched:
            parts, at, base = [], 0, int(offsets[k])
            for a, b in touched[k]:
                parts.append(line[at : a - base])
                at = b - base
            parts.append(line[at:])
            line = "".join(parts).strip(BLANKS)
        kept.append(line)
    return "\n".join(kept), spans


def _unit_hashes(min_run: int, min_line: int):
    nothing = np.zeros(0, np.int64)

    @F.pandas_udf("units array<long>, own boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                units = units_of(text) if text else None
                if units is None:
                    rows.append((nothing, False))
                    continue
                # Whether the text is cut whatever the other documents hold.
                own = bool(cut_repeats(text, units, nothing, min_run, min_line)[1])
                rows.append((np.unique(units.digest), own))
            yield pd.DataFrame(rows, columns=["units", "own"])

    return run


def substring_dedup(
    docs: DataFrame,
    min_run: int = MIN_RUN,
    min_line: int = MIN_LINE,
    scratch: Scratch | None = None,
) -> DataFrame:
    """`docs`, all columns, with `text` cut, and removed spans and words.

    Adds `removed` (array of start, end in the original text) and
    `n_removed` (its stretches' code points).
    """
    bound_batches(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    names = docs.columns
    key, row, bare, found, result = (
        _free(n, names) for n in ("rank", "row", "unnamed", "elsewhere", "result")
    )
    # A row without an id is a document of its own; its key is written once.
    unnamed = docs.where("doc_id is null").withColumn(key, F.monotonically_increasing_id())
    unnamed = scratch.save(unnamed, "unnamed").withColumn(bare, F.lit(True))
    named = docs.where("doc_id is not null").withColumn(key, F.col("doc_id").cast("long"))
    docs = named.withColumn(bare, F.lit(False)).union(unnamed)
    docs = docs.withColumn(row, F.xxhash64("text"))
    row_key = ["rank", "row", "unnamed"]
    units = scratch.save(
        docs.select(
            *(F.col(c).alias(n) for c, n in zip((key, row, bare), row_key, strict=True)),
            _unit_hashes(min_run, min_line)("text").alias("u"),
        ).select(*row_key, "u.units", "u.own"),
        "units",
    )
    single = units.select(*row_key, F.explode("units").alias("unit"))
    by_id, by_key = F.expr("if(unnamed, null, rank)"), F.expr("if(unnamed, rank, null)")
    repeated = scratch.save(
        single.groupBy("unit")
        .agg(
            F.min(by_id).alias("first"),
            F.max(by_id).alias("last"),
            F.min(by_key).alias("first_key"),
            F.max(by_key).alias("last_key"),
        )
        .where("first <> last or first_key <> last_key or (first is not null and first_key is not null)")
        .select("unit", "first", F.expr("if(first is null, first_key, null)").alias("first_key")),
        "repeated",
    )
    # A row's repeats are no more than its own units; none where only repeats
    # within the document are to be cut.
    itself = units.where("own").select(*row_key, F.lit(None).cast("long").alias("unit"))
    of_doc = scratch.save(
        single.join(repeated, "unit")
        .where("not (rank <=> if(unnamed, first_key, first))")
        .select(*row_key, "unit")
        .union(itself)
        .groupBy(*row_key)
        .agg(F.collect_set("unit").alias("elsewhere")),
        "of_doc",
    )

    @F.pandas_udf("text string, removed array<struct<start:int,end:int>>, n_removed long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, elsewhere in batches:
            rows = []
            for text, others in zip(texts, elsewhere, strict=True):
                gone: list[tuple[int, int]] = []
                if text and others is not None:
                    known = np.asarray(others, np.int64)
                    text, gone = cut_repeats(text, units_of(text), known, min_run, min_line)
                rows.append(
                    (text, [{"start": a, "end": b} for a, b in gone], sum(b - a for a, b in gone))
                )
            yield pd.DataFrame(rows, columns=["text", "removed", "n_removed"])

    joined = docs.join(of_doc.toDF(key, row, bare, found), [key, row, bare], "left")
    return joined.withColumn(result, cut("text", found)).select(
        *(F.col(f"{result}.text") if n == "text" else F.col(f"`{n}`") for n in names),
        F.col(f"{result}.removed").alias(_free("removed", names)),
        F.col(f"{result}.n_removed").alias(_free("n_removed", names)),
    )

