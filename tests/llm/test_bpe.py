from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tastes.llm.bpe import VOCABULARY, decode, encode, round_trip, vocabulary

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(PATH).ranks, special_tokens={}
    )


def test_trees_equal_the_library(library):
    rng = random.Random(1)
    words, split = vocabulary(PATH), regex.compile(public_tokenizers.PATTERN)
    pools = ["abcdefghij '", "éèßñ áäöü", "  \n\t\r", "0123٣४½²", "中文字かな😀", "'s'll'RE!?.,$%", "aaaa", "THE the"]
    for _ in range(400):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 90)))
        pieces = [p.encode() for p in split.findall(text)]
        ids = library.encode_ordinary(text)
        assert [i for p in pieces for i in words.merge(p)] == ids
        assert b"".join(words.merge_all(pieces)) == np.array(ids, "<u4").tobytes()


def test_long_match(library):
    for text in ("ab" * 20_000, "é" * 5000, " " * 3000, "x" * 64, "x" * 65):
        assert vocabulary(PATH).merge(text.encode()) == library.encode_ordinary(text)


def test_round_trip(docs_df, library):
    texts = ["", None, " \n", "Plain words, plainly.", "naïve 😀 text\r\n\x00 end", "<|endoftext|>", "word " * 100_000]
    docs = docs_df([(i, t) for i, t in enumerate(texts)] + [(None, "a"), (3, "Plain words, plainly.")])
    docs = docs.withColumns({c: F.lit(1) for c in ("tokens", "token")})
    found = decode(encode(docs)).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        want = library.encode_ordinary(r.text or "")
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert bytes(r.decoded) == (r.text or "").encode()
    both = round_trip(docs).collect()
    assert sorted((bytes(r.coded.ids), bytes(r.coded.decoded)) for r in both) == sorted(
        (bytes(r.ids), bytes(r.decoded)) for r in found
    )
    assert encode(docs_df([])).count() == 0
