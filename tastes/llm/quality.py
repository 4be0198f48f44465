"""Quality rules: a table of thresholds compiled into one Spark projection.

Each rule names a measure and the least and the most it may be. The
measures (length, symbols, stop words, lines, repeated words) are built-in
expressions of the text; `judge` adds them and a verdict to the rows in one
projection over a scan: no shuffle, no user function. A rule whose measure
is undefined for a text (a ratio over no words) does not reject it.

Stop words are the table's own parameter: `stop_words` (lower case, found
where no letter stands beside them). The defaults are the
commonest function words of four languages; the default rule asks only that
texts of 100 words or more are not entirely without them.

Repeated words: three-word windows are hashed (64 bits); in texts where a
hash comes again the bare hashes are sorted, equal neighbours are repeats. Where
those are few, a window's place is looked up among them; otherwise the windows
are sorted with their places. The words under any repeated window count once each.

Null and empty texts have no words: counts are 0, and they fail the length
rule. Columns named like a measure are replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import BLANK_PATTERN, BLANKS

SYMBOLS = "#*$%&|<>"
# Distinct repeated windows of a text up to which looking one up beats sorting all.
FEW_REPEATS = 100
# Common function words of English, French, German, Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as",
    "with", "be", "at", "by", "this", "from", "or", "an",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "qui", "est",
    "dans", "pour", "pas", "sur", "au", "par", "avec",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "dem", "ein", "eine",
    "nicht", "im", "auf", "für", "ist", "als", "auch",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "su", "para", "lo", "al",
)


@dataclass(frozen=True)
class Rule:
    """`measure` must lie in [least, most]; None leaves an end open."""

    measure: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        value, bounds = F.col(self.measure), F.lit(True)
        if self.least is not None:
            bounds = bounds & (value >= self.least)
        if self.most is not None:
            bounds = bounds & (value <= self.most)
        return F.coalesce(bounds, F.lit(True))


RULES = (
    Rule("symbol_ratio", most=0.3),  # symbols per word
    Rule("mean_word_chars", least=2.0, most=15.0),
    Rule("bang_ratio", most=0.3),  # exclamation marks per word
    Rule("dup_line_ratio", most=0.5),  # of the lines with a word
    Rule("repeat_ratio", most=0.5),  # words under a repeated window
    Rule("stop_word_deficit", most=0),  # 100 words or more, none of them a stop word
)


def _count(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{re.escape(characters)}]")).cast("long")


def words_of(text: Column) -> Column:
    """The words of a text."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_PATTERN)
    )


def _windows(words: Column) -> Column:
    """Hash of every three-word window, in order; `words` is a column."""
    hashed = F.transform(
        words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _sorted(hashes: Column) -> Column:
    """The hashes in order; none for the most texts, which repeat nothing."""
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(hashes)).otherwise(
        F.array().cast("array<long>")
    )


def _repeats(ordered: Column) -> Column:
    """The distinct hashes that come again; `ordered` is a column."""
    return F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i + 1)))


def _repeat_places(hashes: Column, repeats: Column) -> Column:
    """Places of windows whose hash is among the repeats, in order; both are columns."""
    none, n = F.array().cast("array<int>"), F.size(repeats)
    places = F.transform(
        hashes, lambda h, i: F.when(F.array_contains(repeats, h), i).otherwise(-1)
    )
    few = F.array_remove(places, -1)
    return F.when(n == 0, none).when(n <= FEW_REPEATS, few).otherwise(_sorted_places(hashes))


def _sorted_places(hashes: Column) -> Column:
    """Places of windows whose hash comes again, in order.

    Sorted by hash, a repeat equals the one after it or the one before it.
    """
    windows = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    n = F.size(windows)
    after = F.zip_with(
        windows,
        F.slice(windows, 2, n),
        lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)),
    )
    before = F.concat(F.array(F.lit(False)), after)
    flagged = F.zip_with(
        windows,
        F.zip_with(after, before, lambda a, b: a | b),
        lambda w, same: F.when(same, w["i"]),
    )
    return F.sort_array(F.filter(flagged, lambda i: i.isNotNull()))


def _covered(places: Column) -> Column:
    """Words under windows of three that begin at the (sorted) places."""
    gaps = F.zip_with(
        places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(3), b - a)
    )
    # Past the last place the gap is null, and least() ignores it: three words.
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, stop_words: tuple[str, ...] = STOP_WORDS
) -> DataFrame:
    """`docs` with the measures, `failed_rules`, `base_failed` and `kept`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    stops = r"(?<!\p{L})(?:" + "|".join(map(re.escape, stop_words)) + r")(?!\p{L})"
    step = docs.withColumns({"_words": words_of(text), "_lines": lines})
    step = step.withColumns({"_windows": _windows(F.col("_words"))})
    step = step.withColumns({"_ordered": _sorted(F.col("_windows"))})
    step = step.withColumns({"_repeats": _repeats(F.col("_ordered"))})
    step = step.withColumns({"_places": _repeat_places(F.col("_windows"), F.col("_repeats"))})
    n_words, n_lines = F.size("_words").cast("long"), F.size("_lines").cast("long")
    step = step.withColumns(
        {
            "n_words": n_words,
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": _count(text, SYMBOLS),
            "n_bangs": _count(text, "!"),
            "n_lines": n_lines,
            "n_dup_lines": n_lines - F.size(F.array_distinct("_lines")),
            "n_repeat_words": F.coalesce(_covered(F.col("_places")), F.lit(0).cast("long")),
            "has_stop_word": F.lower(text).rlike(stops),
        }
    )
    per_word = F.when(F.col("n_words") > 0, F.col("n_words"))
    step = step.withColumns(
        {
            "symbol_ratio": F.col("n_symbols") / per_word,
            "mean_word_chars": F.col("word_chars") / per_word,
            "bang_ratio": F.col("n_bangs") / per_word,
            "dup_line_ratio": F.col("n_dup_lines")
            / F.when(F.col("n_lines") > 0, F.col("n_lines")),
            "repeat_ratio": F.col("n_repeat_words") / per_word,
            "stop_word_deficit": ((F.col("n_words") >= 100) & ~F.col("has_stop_word")).cast("int"),
        }
    )
    failed = F.filter(
        F.array(*(F.when(~rule.holds(), F.lit(rule.measure)) for rule in rules)),
        lambda name: name.isNotNull(),
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return step.withColumns({"failed_rules": failed, "base_failed": base}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    ).drop("_words", "_lines", "_windows", "_ordered", "_repeats", "_places")
