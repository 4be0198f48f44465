from __future__ import annotations

import random

import pytest
from naive_substring import naive_dedup, naive_sentences, naive_units
from pyspark.sql import functions as F

from tastes.llm import substring
from tastes.llm.substring import substring_dedup, units_of

PASSAGE = (
    "The old harbour wall was rebuilt twice after the storms. Nobody kept a record of who paid "
    "for the second time, and the town simply went on. Fishermen tied their boats to the new "
    "rings without a word, while the masons slept in the chapel for a whole winter and left "
    "before spring came round again."
)


def text_of(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def collect(df):
    return {r.doc_id: r for r in df.collect()}


def test_passage_inside_other_lines_is_cut_but_for_the_first(docs_df):
    rows = [(i, f"{text_of(i)} {PASSAGE} {text_of(100 + i)}\n{text_of(200 + i)}") for i in range(20)]
    found = collect(substring_dedup(docs_df(rows)))
    assert found[0].text == rows[0][1] and found[0].n_removed == 0
    for i, text in rows[1:]:
        assert PASSAGE not in found[i].text and "masons slept" not in found[i].text
        assert "".join(text[s.start : s.end] for s in found[i].removed) == PASSAGE
        assert found[i].text == text.replace(PASSAGE + " ", "")


def test_lines(docs_df):
    line = "a line of seven words for everyone"
    rows = [(3, f"{line}\n{text_of(1)}"), (1, f"{text_of(2)}\n{line}\n\n{line}"), (2, "Yes.\n" + text_of(4)),
            (5, "Yes.\n" + text_of(6))]
    found = collect(substring_dedup(docs_df(rows)))
    assert found[1].text == f"{text_of(2)}\n{line}\n"  # the first keeps one of its own
    assert found[3].text == text_of(1)
    assert found[2].text.startswith("Yes.") and found[5].text.startswith("Yes.")


def odd_documents():
    """Lines, paragraphs, odd blanks, letters that grow in lower case, repeats within a text."""
    rng = random.Random(9)
    lines = [text_of(k, rng.randint(1, 40)).replace(" w1", ". W1") for k in range(30)]
    lines += ["", "  ", "Ünd. \"Dann!\") ging's \x85 fort\u00a0hin", "İZMİR İS FAR. ΟΔΟΣ\x1cΟΔΟΣ \t x", "\U0001f600 ok", "...", ")"]
    lines += [" ".join(["so"] * 60), "\r" + PASSAGE + "  ", PASSAGE.upper(), "\ud800 half of a pair"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(90)]
    words = " ".join(lines[:8]).split()
    for i in range(90, 130):  # stretches that begin and end anywhere
        a = rng.randrange(100)
        rows.append((i, f"{text_of(i, 5)} {' '.join(words[a : a + rng.randint(10, 70)])} {text_of(-i, 5)}"))
    return [*rows, (130, None), (131, "")]


def test_equals_brute_force(docs_df):
    rows = [(i, None if t is None else t.replace("\ud800", "")) for i, t in odd_documents()]
    want = naive_dedup(rows)
    found = collect(substring_dedup(docs_df(rows)))
    got = {i: (r.text, [(s.start, s.end) for s in r.removed]) for i, r in found.items()}
    assert got == want
    assert sum(bool(spans) for _, spans in want.values()) > 40
    assert all(r.n_removed == sum(s.end - s.start for s in r.removed) for r in found.values())


@pytest.mark.parametrize("block", [1, 7, substring._BLOCK])
def test_units_equal_brute_force(monkeypatch, block):
    """In blocks of any size, the units are those of a loop over words."""
    monkeypatch.setattr(substring, "_BLOCK", block)
    digests = {}
    for _, text in odd_documents():
        words, ranges = naive_units(text or "")
        units = units_of(text or "")
        if units is None:
            assert not words
            continue
        assert [(a, b) for _, a, b, _ in words] == list(zip(units.starts.tolist(), units.ends.tolist()))
        assert ranges == list(zip(units.begin.tolist(), units.end.tolist(), units.whole.tolist()))
        for (a, b, _), digest in zip(ranges, units.digest.tolist()):
            digests.setdefault(tuple(w[0].lower() for w in words[a:b]), set()).add(digest)
    assert all(len(x) == 1 for x in digests.values())
    assert len(set().union(*digests.values())) == len(digests)


def test_every_removed_unit_survives_somewhere(docs_df):
    rows = [(i, f"{text_of(i % 7)} {PASSAGE} {text_of(i % 5)}") for i in range(40)]
    found = collect(substring_dedup(docs_df(rows)))

    def sentences(text):
        words = naive_units(text)[0]
        return {tuple(w[0] for w in words[a:b]) for a, b in naive_sentences(words)}

    left = set().union(*(sentences(r.text) for r in found.values()))
    assert set().union(*(sentences(t) for _, t in rows)) <= left


def test_edges(docs_df):
    long = " ".join(text_of(k, 500) for k in range(400))
    rows = [(1, None), (2, ""), (3, " \n "), (None, PASSAGE), (None, PASSAGE), (7, PASSAGE), (8, long),
            (8, long), (9, long)]
    docs = docs_df(rows).withColumns(
        {c: F.lit(c) for c in ("rank", "elsewhere", "removed", "result", "unit")}
    )
    found = substring_dedup(docs)
    assert found.columns[: len(docs.columns)] == docs.columns
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id in (1, 2, 3) and r.text is not None) == [
        (2, ""), (3, " \n ")]
    assert [r.text for r in got if r.doc_id == 7] == [PASSAGE]
    assert [r.text for r in got if r.doc_id is None] == ["", ""]  # ranked last
    assert [r.text for r in got if r.doc_id == 8] == [long, long]  # one document
    assert [r.text for r in got if r.doc_id == 9] == [""]
    assert substring_dedup(docs_df([])).count() == 0


def windows(text, n=49):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_no_window_of_50_words_is_left_in_two_documents(docs_df):
    rng, rows = random.Random(3), []
    for i in range(60):
        words = text_of(500 + i // 2, 110).split()
        a = rng.randrange(60)
        span = words[a : a + 50] if i % 2 else words
        if i % 4 == 1:  # other capitals and other line ends
            span = [w.title() if rng.random() < 0.5 else w for w in span]
            span[20] += "\n" + span.pop(21)
        rows.append((i, f"{text_of(700 + i, 30)} {' '.join(span)} {text_of(900 + i, 30)}"))
    found = collect(substring_dedup(docs_df(rows)))
    for i, text in rows[1::2]:
        assert windows(rows[i - 1][1]) & windows(text)  # brute force: it is there
        assert not windows(found[i - 1].text) & windows(found[i].text)
        assert len(text.split()) - len(found[i].text.split()) >= 25
        assert found[i - 1].n_removed == 0


def test_lines_and_paragraphs_in_other_case(docs_df):
    line, cookie = "Please read the Terms of Service", "We Use Cookies\nTo Serve You"
    rows = [(1, f"{text_of(1)}\n{line}\n\n{cookie}"), (2, f"{line.lower()}\n{text_of(2)}\n\n{cookie.lower()}")]
    found = collect(substring_dedup(docs_df(rows)))
    assert found[1].n_removed == 0 and found[2].text == text_of(2) + "\n"


def test_rows_without_an_id_are_documents_of_their_own(docs_df):
    rows = [(None, f"{text_of(k)} {PASSAGE} {text_of(50 + k)}") for k in range(6)] + [(1, None), (None, None)]
    got = substring_dedup(docs_df(rows)).collect()
    assert len(got) == len(rows)
    assert sum(PASSAGE in r.text for r in got if r.text) == 1  # one keeps the passage
    assert sum(r.n_removed == len(PASSAGE) for r in got) == 5
