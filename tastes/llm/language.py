"""Language ID by error-correcting output codes.

Every language gets a codeword; one binary classifier per bit tells the
languages with that bit set from the others. A classifier is a log-odds
weight per hashed character n-gram (1 to 4 bytes of the lower-cased text,
letters only), from n-gram counts of a bounded sample: `fit_rows` documents
per language in expectation, picked by a hash of the id. A text's margin is
the mean weight of its n-grams. Decoding adds up, over the bits, the
logistic loss of the margin against each codeword, weighted by the bit's
accuracy on the sample; the nearest codeword wins. `ambiguous` is set when
the runner-up is nearly as near.

Up to six languages have the exhaustive code (every way to part them in
two); more have as many bits as keep the codewords far apart, from a fixed
pseudo-random sequence.

Null texts and texts without a letter are `und` with score 0, and so is
everything when no language could be learnt. Rows without a language are
not learnt from. Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import Scratch

FIT_ROWS = 600
BUCKETS = 1 << 14
GRAMS = (1, 2, 3, 4)
_GAIN = 20.0
_LETTER = re.compile(r"[^\W\d_]")
_BYTES = np.array(
    [b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint8
)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams; None for a text without a letter."""
    if not text or not _LETTER.search(text):
        return None
    raw = _BYTES[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    blank = raw == 32
    raw = raw[~(blank & np.roll(blank, 1))]
    raw = np.concatenate([raw, raw[:0]]).astype(np.uint32)
    out = np.zeros(BUCKETS)
    acc = np.zeros(len(raw), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(raw) < n:
            break
        acc = acc[: len(raw) - n + 1] * np.uint32(257) + raw[n - 1 :]
        mixed = (acc ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        mixed *= np.uint32(0xC2B2AE35)
        out += np.bincount(mixed >> np.uint32(32 - 14), minlength=BUCKETS)
    return out


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 per language."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 6:
        # Bit k of column c parts the languages; the first is always +1.
        columns = np.arange(1, 1 << (n - 1))
        return np.array(
            [[1.0 if k == 0 or not c >> (k - 1) & 1 else -1.0 for c in columns] for k in range(n)]
        )
    bits = 12 * int(np.ceil(np.log2(n)))
    codes = [np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits)) for seed in range(64)]
    for code in codes:  # every bit must part the languages
        code[0, np.abs(code.sum(axis=0)) == n] *= -1
    return max(codes, key=lambda c: -np.max(c @ c.T - 2 * bits * np.eye(n)))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray  # n-gram by bit
    trust: np.ndarray  # per bit

    def losses(self, counts: np.ndarray) -> np.ndarray:
        margin = np.clip(_GAIN * (counts @ self.weights) / counts.sum(), -30, 30)
        return np.log1p(np.exp(-self.codes * margin)) @ self.trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        counts = gram_counts(text) if self.languages else None
        if counts is None:
            return "und", 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        losses = self.losses(counts)
        near = np.exp(losses.min() - losses)
        best = int(np.argmin(losses))
        score = float(near[best] / near.sum())
        return self.languages[best], score, score < 0.6


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """N-gram shares of one language's sample, the mean over its documents."""
    total, n = np.zeros(BUCKETS), 0
    for text in group["text"]:
        counts = gram_counts(text)
        if counts is not None:
            total += counts / np.sqrt(counts.sum())
            n += 1
    return pd.DataFrame({"lang": [group["lang"].iloc[0]], "counts": [total.tobytes()], "n": [n]})


def fit_languages(
    docs: DataFrame, usable: Column | None = None, fit_rows: int = FIT_ROWS
) -> LanguageModel:
    """Learn from rows with a language for which `usable` (over doc_id) holds."""
    rows = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    if usable is not None:
        rows = rows.where(usable)
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not n:
        return LanguageModel((), np.ones((0, 0)), np.zeros((BUCKETS, 0)), np.zeros(0))
    share = F.create_map(*(F.lit(x) for k in n for x in (k, min(1.0, fit_rows / n[k]))))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003))
    sample = Scratch(docs.sparkSession, "language").save(
        rows.where(draw < share[F.col("lang")] * 1_000_003).select("lang", "text").distinct(),
        "sample",
    )
    # Groups are bounded: fit_rows documents each in expectation.
    learnt = sample.groupBy("lang").applyInPandas(_summed, "lang string, counts binary, n long")
    found = {r["lang"]: np.frombuffer(r["counts"]) for r in learnt.where("n > 0").collect()}
    languages = tuple(sorted(found))
    codes = codewords(len(languages))
    shares = np.array([(found[k] + 0.02) / (found[k] + 0.02).sum() for k in languages])
    shares = shares.reshape(len(languages), BUCKETS)
    weights = np.zeros((BUCKETS, codes.shape[1]))
    for b in range(codes.shape[1]):
        yes, no = codes[:, b] > 0, codes[:, b] < 0
        weights[:, b] = np.log(shares[yes].mean(axis=0)) - np.log(shares[no].mean(axis=0))
    plain = LanguageModel(languages, codes, weights, np.ones(codes.shape[1]))
    if len(languages) < 2:
        return plain

    def right(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = {k: i for i, k in enumerate(languages)}
        hits, total = np.zeros(codes.shape[1]), 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                counts = gram_counts(text)
                if counts is not None and lang in at:
                    hits += (counts @ weights) * codes[at[lang]] > 0
                    total += 1
        yield pd.DataFrame({"hits": [hits.tolist()], "n": [total]})

    rows = sample.mapInPandas(right, "hits array<double>, n long").collect()
    wrong = 1 - np.sum([r["hits"] for r in rows], axis=0) / max(1, sum(r["n"] for r in rows))
    trust = np.log((1 - wrong + 0.01) / (wrong + 0.01)).clip(0.1)
    return LanguageModel(languages, codes, weights, trust / trust.mean())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with one more column `language`: lang_pred, score, ambiguous."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(
                [model.predict(t) for t in batch], columns=["lang_pred", "score", "ambiguous"]
            )

    return docs.withColumn("language", run("text"))
