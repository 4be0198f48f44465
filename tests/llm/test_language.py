from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastes.llm.language import codewords, fit_languages, gram_counts, identify

SYLLABLES = {
    "aa": "ka lo mi ru ta".split(), "bb": "sch ung ein ver lich".split(), "cc": "tion eau oux ent ais".split(),
    "dd": "ción ado llo ñez que".split(), "ee": "ství ově řek ží".split(), "ff": "αθη τος και ντα".split(),
    "gg": "ство ени ать ого".split(), "hh": "ing the ough ly".split(),
}


def rows(languages, n=40):
    rng, out = random.Random(2), []
    for i in range(n * len(languages)):
        lang = languages[i % len(languages)]
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(40)]
        out.append((i, " ".join(words), lang))
    return out


@pytest.mark.parametrize("n", [1, 2, 4, 8])
def test_held_out_accuracy(docs_df, n):
    data = rows(sorted(SYLLABLES)[:n])
    docs = docs_df(data)
    model = fit_languages(docs, F.col("doc_id") % 5 != 2)
    found = {r.doc_id: r.language for r in identify(docs, model).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in data)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_codewords_differ_in_many_bits():
    for n in range(2, 40):
        code = codewords(n)
        distance = (code.shape[1] - code @ code.T) / 2 + 99 * np.eye(n)
        assert distance.min() >= max(1, 2 ** (n - 2) if n <= 6 else 8)
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_mixture_is_flagged(docs_df):
    data = rows(["aa", "bb"])
    model = fit_languages(docs_df(data))
    a, b = data[0][1], data[1][1]
    margins = [model.predict(x)[1] for x in (a, a + " " + b)]
    assert margins[0] > margins[1]


def test_edges(docs_df):
    model = fit_languages(docs_df(rows(["aa", "bb"])))
    odd = docs_df([(1, None), (2, ""), (3, "123 %%% \n"), (None, "kalomi " * 100_000, "bb"), (2, "")])
    odd = odd.withColumns({c: F.lit("x") for c in ("lang_pred", "score", "ambiguous")})
    found = identify(odd, model).collect()
    assert [tuple(r.language)[:2] for r in found if r.doc_id is not None] == [("und", 0.0)] * 4
    assert [r.language.lang_pred for r in found if r.doc_id is None] == ["aa"]
    nothing = fit_languages(docs_df([(1, "text without a language")]))
    assert identify(odd, nothing).collect()[0].language.lang_pred == "und"
    assert identify(docs_df([]), model).count() == 0
    assert gram_counts("a").sum() > 0
