"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lowers case, maps look-alike letters of other scripts and digits or
signs that stand for letters to one representative, drops decoration and
turns other punctuation into blanks. A lexicon entry is a word beginning (a
stem) with a weight; an exception phrase is a whole word, or a pair of
words, that contains an entry and yet marks nothing. One automaton holds
both kinds; a hit covered by an exception counts nothing. The weights'
sum is normalised by the length of the text, and a logistic function of the
sum and of the normalised sum gives the score.

Entries, exceptions and the logistic function are learnt from a bounded
sample of labelled rows (`fit_rows` of either label in expectation, picked
by a hash of the id): half of it gives the lexicon, by document counts of
every stem in either label, the other half fits the function. Everything
else, the scoring of whole texts, covers every row and runs in one pass
without a shuffle.

Null, empty and blank texts match nothing and get the score of a text
without hits. Labels other than 0 and 1, and label rows without a document,
are ignored; a document with both labels counts in both; of rows that repeat
a doc_id one is learnt from. Without labels of both
kinds there is no lexicon: every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import Scratch, bound_batches

FIT_ROWS = 4000
THRESHOLD = 0.7
STEM_LENGTHS = range(3, 13)
# Terms that a task counts before it hands them on, and those of one text.
_TERMS = 50_000

# Characters that look like a Latin letter, and that letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ӏ": "i",
}
# Digits and signs that stand for a letter. The letters i and
# l share their stand-ins (1, !, |), so they share one class.
STANDINS = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "i", "l": "i",
}
# Decoration inside a word, removed.
DECORATION = "*#_~^­​‌‍﻿"
_OTHER = " \t\n\x0b\x0c\r.,;:?()[]{}\"'`<>/\\+-=%&…–—“”‘’«»¿¡"

_FOLD = str.maketrans(
    {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
    | HOMOGLYPHS
    | STANDINS
    | dict.fromkeys(DECORATION)
    | dict.fromkeys(_OTHER, " ")
)


def fold(text: str | None) -> str:
    """The folded words, each between single blanks."""
    return f" {' '.join(text.lower().translate(_FOLD).split())} " if text else " "


@dataclass(frozen=True)
class Lexicon:
    """Stems with weights, exception phrases, and the logistic function."""

    stems: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    coefficients: tuple[float, ...] | None = None

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for stem, weight in self.stems.items():
            found.add_word(f" {stem}", (len(stem) + 1, weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(found):
            found.make_automaton()
        return found


def features(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, float, int, int]:
    """(weight sum, sum per 100 words, hits, words) of a folded text."""
    words = folded.count(" ") - 1
    if not len(automaton) or words < 1:
        return 0.0, 0.0, 0, max(words, 0)
    hits: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > hits.get(start, 0.0):
            hits[start] = weight  # of stems that begin one word, the heaviest
    for start, end in excused:
        for at in [at for at in hits if start <= at < end]:
            del hits[at]
    total = sum(hits.values())
    return total, 100 * total / (words + 50), len(hits), words


def _inputs(f: tuple[float, float, int, int]) -> tuple[float, float, float]:
    return min(f[0], 60.0) / 10, min(f[1], 60.0) / 10, float(f[2] > 0)


def score(f: tuple[float, float, int, int], lexicon: Lexicon) -> float:
    if lexicon.coefficients is None:
        return 0.0
    z = lexicon.coefficients[0] + sum(
        c * x for c, x in zip(lexicon.coefficients[1:], _inputs(f), strict=True)
    )
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _count_stems(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of either label for each stem, whole word and pair of words.

    A term's counts come in parts, to be added up.
    """
    counts: dict[tuple[str, str], list[int]] = {}

    def part() -> pd.DataFrame:
        return pd.DataFrame(
            [(kind, term, *n) for (kind, term), n in counts.items()],
            columns=["kind", "term", "clean", "toxic"],
        )

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = fold(text).split()
            terms = {("word", w) for w in words}
            terms |= {("pair", f"{a} {b}") for a, b in zip(words, words[1:], strict=False)}
            terms |= {
                ("stem", w[:n]) for w in set(words) for n in STEM_LENGTHS if n <= len(w)
            }
            for term in terms:
                counts.setdefault(term, [0, 0])[toxic] += 1
            if len(counts) >= _TERMS:
                yield part()
                counts.clear()
    yield part()


def choose_stems(
    counts: list[tuple[str, int, int]], n_clean: int, n_toxic: int
) -> dict[str, float]:
    """Stems typical of the toxic label, none a beginning of another.

    A stem qualifies when it marks the label clearly (smoothed odds of 8 or
    more) in enough documents that chance does not explain it. Of nested
    stems the one with the most evidence stays, the shorter on a tie.
    """
    evidence: dict[str, tuple[float, float]] = {}
    least = max(4, math.ceil(0.004 * n_toxic))
    for term, clean, toxic in counts:
        if toxic < least:
            continue
        p, q = (toxic + 0.5) / (n_toxic + 1), (clean + 0.5) / (n_clean + 1)
        if p >= 8 * q:
            evidence[term] = (toxic * math.log(p / q), math.log(p / q))
    chosen: dict[str, float] = {}
    for term in sorted(evidence, key=lambda t: (-round(evidence[t][0], 6), len(t), t)):
        if not any(
            term.startswith(c) or c.startswith(term)
            for c in (c for c in chosen if c[0] == term[0])
        ):
            chosen[term] = evidence[term][1]
    return chosen


def _fit_function(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge @ w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, fit_rows: int = FIT_ROWS
) -> Lexicon:
    """Learn from the labelled rows for which `usable` (over doc_id) holds."""
    bound_batches(docs.sparkSession)
    labelled = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    labelled = labelled.where("doc_id is not null and toxic in (0, 1)")
    if usable is not None:
        labelled = labelled.where(usable)
    labelled = labelled.distinct()
    n = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Lexicon()
    share = F.create_map(*(F.lit(x) for k in n for x in (k, min(1.0, fit_rows / n[k]))))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    sample = labelled.where(draw < share[F.col("toxic")] * 1_000_003)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    # Proven bound: at most 2 * fit_rows distinct labels in expectation.
    drawn = F.broadcast(sample.withColumn("half", half))
    rows = docs.select("doc_id", "text").join(drawn, "doc_id")
    scratch = Scratch(docs.sparkSession, "toxicity")
    held = scratch.save(rows.dropDuplicates(["doc_id", "toxic"]), "sample")

    first = held.where("half = 0")
    counted = first.mapInPandas(
        _count_stems, "kind string, term string, clean long, toxic long"
    )
    by_term = counted.groupBy("kind", "term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    # Neither a stem nor an exception is rarer than this in both labels.
    by_term = scratch.save(by_term.where("toxic >= 4 or clean >= 3"), "terms")
    sizes = Counter({r["toxic"]: r["count"] for r in first.groupBy("toxic").count().collect()})
    if not sizes[0] or not sizes[1]:
        return Lexicon()
    typical = by_term.where("kind = 'stem' and toxic >= 4 and toxic > 2 * clean").collect()
    stems = choose_stems(
        [(r["term"], r["clean"], r["toxic"]) for r in typical], sizes[0], sizes[1]
    )
    if not stems:
        return Lexicon()
    # Words and pairs that hold a stem and yet come in clean documents.
    holds = F.col("term").rlike("(?:^| )(?:" + "|".join(map(re.escape, stems)) + ")")
    rate = F.col("clean") / sizes[0] > F.col("toxic") / sizes[1]
    excused = by_term.where("kind <> 'stem' and clean >= 3").where(rate & holds).collect()
    lexicon = Lexicon(stems, frozenset(r["term"] for r in excused))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [_inputs(features(fold(t), automaton)) for t in batch["text"]]
            yield pd.DataFrame(found, columns=["a", "b", "c"]).assign(
                toxic=batch["toxic"].to_numpy()
            )

    second = held.where("half = 1").mapInPandas(measure, "a double, b double, c double, toxic int")
    points = np.array([tuple(r) for r in second.collect()], dtype=float).reshape(-1, 4)
    if len(points) == 0 or len(set(points[:, 3])) < 2:
        return Lexicon()
    return Lexicon(stems, lexicon.exceptions, _fit_function(points[:, :3], points[:, 3]))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with one more column `toxicity`: score, predicted, hits, weight, words."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("score double, predicted int, hits long, weight double, words long")
    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in texts:
            found = [features(fold(t), automaton) for t in batch]
            scores = [score(f, lexicon) for f in found]
            yield pd.DataFrame(
                {
                    "score": scores,
                    "predicted": [int(s >= threshold) for s in scores],
                    "hits": [f[2] for f in found],
                    "weight": [f[0] for f in found],
                    "words": [f[3] for f in found],
                }
            )

    return docs.withColumn("toxicity", rate("text"))


def reject_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores under the threshold."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.automaton()
        for batch in texts:
            yield pd.Series(
                [score(features(fold(t), automaton), lexicon) < threshold for t in batch],
                dtype=bool,
            )

    return docs.where(clean("text"))
