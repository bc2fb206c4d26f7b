"""Token ids against the public library."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairnlake.llm.bpe import VOCABULARY, Encoder, load_merges, token_counts, token_ids


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return Encoder(load_merges())


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(), st.text("aab \n't", max_size=60), st.from_regex(r"(ab|aa|é|  |the ){0,30}")))
def test_any_text(library, encoder, text):
    assert encoder.encode([text]) == [library(text)] and encoder.count([text]) == [len(library(text))]


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|> x", "a" * 100_001, "ab" * 5000, "日本語の文" * 2000, "\n\n \t x  y", "0123456789" * 50, "列名在上次交付后被重新命名" * 40_000, "👍🏽 ok"])
def test_hard_texts(library, encoder, text):
    assert encoder.encode([text, None, text]) == [library(text), [], library(text)]


def test_frame(spark, library):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (4, "naïve — ok"), (4, "naïve — ok")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r.doc_id, r.ids) for r in token_ids(df, ["doc_id"], "text").collect())
    assert got == sorted((i, library(t) if t else []) for i, t in rows)
    assert sorted((r.doc_id, r.tokens) for r in token_counts(df, ["doc_id"], "text").collect()) == sorted((i, len(library(t)) if t else 0) for i, t in rows)
    assert token_ids(df.limit(0), ["doc_id"], "text").count() == 0
