"""Substring dedup restated word by word: loops, and units known by their words.

Only where pieces and one sentence in 32 end depends on a hash, the polynomial
that the operator's docstring names; it is restated here on Python integers.
"""

from __future__ import annotations

import re

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def word_hash(word: str) -> int:
    x, power = len(word), 1
    for c in word:
        x, power = x + ord(c) * power, power * BASE & MASK
    x &= MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def piece_ends(hashes: list[int], window: int = 13) -> list[int]:
    """After the least upper half of any 13 hashes; of equals, the last one."""
    return sorted(
        {
            min(range(k, k + window), key=lambda i: (hashes[i] >> 32, -i)) + 1
            for k in range(len(hashes) - window + 1)
        }
    )


def naive_sentences(words) -> list[tuple[int, int]]:
    """(first word, end) of the sentences of `words` with place and line."""
    found, start = [], 0
    for k, (word, _, _, line) in enumerate(words):
        bare = word.rstrip("\"')]}»”’")
        stop = bool(bare) and bare[-1] in ".!?…。！？" or word_hash(word.lower()) >> 59 == 0
        if k + 1 < len(words) and words[k + 1][3] == line:
            stop |= words[k + 1][0][0].isupper() and not word[0].isupper()
        else:
            stop = True
        if stop:
            found.append((start, k + 1))
            start = k + 1
    return found


def naive_units(text: str):
    """(words with place and line, [(first word, end, whether whole)])."""
    words = []
    for k, line in enumerate(text.split("\n")):
        offset = sum(len(x) + 1 for x in text.split("\n")[:k])
        words += [
            (m.group(), offset + m.start(), offset + m.end(), k)
            for m in re.finditer(r"[^\x20\x09-\x0D]+", line)
        ]
    n = len(words)
    hashes = [word_hash(w[0].lower()) for w in words]
    units = []
    by_line: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_line.setdefault(w[3], []).append(k)
    for places in by_line.values():
        units.append((places[0], places[-1] + 1, True))
    paragraph: list[int] = []
    for at in [*sorted(by_line), None]:
        if paragraph and (at is None or at != paragraph[-1] + 1):
            if len(paragraph) > 1:
                units.append((by_line[paragraph[0]][0], by_line[paragraph[-1]][-1] + 1, True))
            paragraph = []
        paragraph.append(at)
    cuts = sorted({0, n, *piece_ends(hashes)}) if n else []
    if len(cuts) == 2:
        units.append((0, n, False))
    units += [(a, b, False) for a, b in zip(cuts, cuts[2:])]
    units += [(a, b, False) for a, b in naive_sentences(words)]
    return words, units


def naive_dedup(docs, min_run: int = 25, min_line: int = 5):
    """By id: (text, removed spans); `docs` are (id, text) with ids all different."""
    found, first = {}, {}
    for doc, text in sorted(docs):
        words, units = naive_units(text or "")
        keyed = [
            (a, b, whole, tuple(w[0].lower() for w in words[a:b])) for a, b, whole in units
        ]
        own: dict[tuple, int] = {}
        for _, b, _, key in keyed:
            own[key] = min(b, own.get(key, b))
        repeat, doomed = [False] * len(words), [False] * len(words)
        for a, b, whole, key in keyed:
            if first.setdefault(key, doc) != doc or own[key] <= a:
                repeat[a:b] = [True] * (b - a)
                if whole and b - a >= min_line:
                    doomed[a:b] = [True] * (b - a)
        start = None
        for k in range(len(words) + 1):
            if k < len(words) and repeat[k]:
                start = k if start is None else start
            elif start is not None:
                if k - start >= min_run:
                    doomed[start:k] = [True] * (k - start)
                start = None
        for line in {w[3] for w in words}:
            places = [k for k, w in enumerate(words) if w[3] == line]
            if len(places) >= min_line and all(repeat[k] for k in places):
                for k in places:
                    doomed[k] = True
        if not any(doomed):
            found[doc] = (text, [])
            continue
        kept, spans, offset = [], [], 0
        for at, line in enumerate(text.split("\n")):
            places = [k for k, w in enumerate(words) if w[3] == at]
            for k in places:
                if doomed[k] and k - 1 in places and doomed[k - 1]:
                    spans[-1] = (spans[-1][0], words[k][2])
                elif doomed[k]:
                    spans.append((words[k][1], words[k][2]))
            if any(doomed[k] for k in places):
                # A kept word brings the blanks after it; a removed one loses them.
                out = line[: words[places[0]][1] - offset]
                for j, k in enumerate(places):
                    after = words[places[j + 1]][1] if j + 1 < len(places) else offset + len(line)
                    if not doomed[k]:
                        out += text[words[k][1] : after]
                if not all(doomed[k] for k in places):
                    kept.append(out.strip(" \t\n\x0b\x0c\r"))
            else:
                kept.append(line)
            offset += len(line) + 1
        found[doc] = ("\n".join(kept), spans)
    return found
