import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spindle.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), bpe.load(PATH)


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    mine = OWN.encode(text)
    assert np.frombuffer(mine, "<u4").tolist() == ids
    assert OWN.decode(mine) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcde '’sStTreRE019½²ΣσςİıéÉ漢字́\x00\x1c\x85\xa0 \n\t!?|<>_-ªº٣", max_size=60))
def test_like_the_library(text):
    same(text)


def test_special_tokens_long_words_and_sigma():
    for t in ["a<|endoftext|>b", "<|startoftext|><|endoftext|> <|endoftext", "x" * 4000, "ab" * 3000, "ΟΔΟΣ ΣΑΣ", "", "  ", "İstanbul É é"]:
        same(t)


def test_table_like_the_library(spark):
    texts = [r.text for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    random.Random(1).shuffle(texts)
    for t in texts:
        same(t)


def test_cache_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    fresh = bpe.load(PATH)
    text = "one two three four one two three four five"
    assert fresh.encode(text) == OWN.encode(text)


def test_odd_rows(spark, odd_docs, no_docs):
    got = queries.encoded_and_decoded(spark, odd_docs.select("doc_id", "text", "score"), with_ids=True).collect()
    assert len(got) == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
    assert queries.encoded_and_decoded(spark, no_docs).count() == 0
