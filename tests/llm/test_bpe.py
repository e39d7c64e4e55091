import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tasteforge.llm.bpe import WordBpe, bpe_decode, bpe_encode, round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


HARD = [
    "", " ", "Hello  wörld's 12ab", "ΑΣ ΣΑΣ σς", "É́ é ﬁ İ ½² ⅷ", "\x1c a\x1db \x85y z　", "日本語 😀👍🏽 नमस्ते",
    "<|endoftext|> a<|startoftext|>b <|endoftext", "don't 'Sup A'S we'LL''ve", "a​b ﻿ _x_ --- ***", "x" * 3000,
    "ab" * 700 + "é" * 500, "ǅ ǆ ẞ ß ŉ K Å", "\x00\x01 \x7f", "##%%% re### &amp;&amp;",
]


def test_matches_the_library(bpe, library):
    rng = random.Random(5)
    texts = HARD + ["".join(rng.choice("aAbé ΣÜ1'st.,-\n\t日😀́<|>") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        got = bpe.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == expected, text
        assert bpe.decode(got) == library.decode(expected, skip_special_tokens=False)


def test_cache_generations_do_not_change_results(bpe, library, monkeypatch):
    monkeypatch.setattr("tasteforge.llm.bpe.CACHE_ENTRIES", 3)
    small = WordBpe(PATH)
    text = "one two three four five one two six one two three seven " * 3
    assert small.encode(text) == bpe.encode(text)


def test_frames(spark, library):
    rows = [(1, "Some text", "old"), (1, "Some text", "old"), (2, None, None), (None, "", "x"), (3, "long " * 50_000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe_decode(bpe_encode(df, PATH), PATH).collect()
    assert len(got) == 5
    for row in got:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    trip = round_trip(df, PATH)
    assert trip.columns == ["doc_id", "ids", "decoded", "n_tokens"]
    assert sorted(r.n_tokens for r in trip.collect())[-1] == 50_000
    assert round_trip(df.limit(0), PATH).count() == 0
