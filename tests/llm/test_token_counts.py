"""Token counts against the libraries themselves, and the cache's behaviour."""

from __future__ import annotations

import functools
from collections import Counter

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer as Library

from tidemark.llm import token_counts
from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import Tokenizer

SF = "/root/testdata/sf0.001"


@functools.cache
def library_count(name):
    if name.endswith(".json"):
        lib = Library.from_file(P.path(name))
        return lambda t: len(lib.encode(t or "", add_special_tokens=False).ids)
    sp = SentencePieceProcessor(model_file=P.path(name))
    return lambda t: len(sp.encode(t or ""))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, odd_docs, tmp_path, name):
    count = library_count(name)
    special = spark.createDataFrame(
        [(20, "a<|endoftext|>b <|ENDOFTEXT|> <s> c"), (21, "<|endoftext|>"), (22, "A  b\n\nc"), (23, "a b c"), (24, "a\tb \x0b c ")], "doc_id bigint, text string"
    )
    docs = odd_docs.select("doc_id", "text").unionByName(special).unionByName(special)
    got = token_counts.count_tokens(docs, Tokenizer(P.path(name)), f"{tmp_path}/cache").collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), count(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want


def test_query_over_documents(spark):
    count = library_count("byte_bpe_50k.json")
    rows = QUERIES["op13_token_counts"][0](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), n := count(r.text), n > 512) for r in docs)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert any(r.over_limit for r in rows) and not all(r.over_limit for r in rows)


@settings(max_examples=1000, deadline=None)
@given(st.text(st.sampled_from(list("abZé'sd19 .\n\t <|>中")), max_size=80), st.integers(1, 20))
def test_parts_add_up(text, size):
    tok, count = _byte_level()
    parts = tok.parts(text, size)
    assert "".join(parts) == text and sum(count(parts)) == count([text])[0]


def _byte_level(made={}):
    if not made:
        tok = Tokenizer(P.path("byte_bpe_50k.json"))
        made["x"] = tok, tok.load()
    return made["x"]


def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path, monkeypatch):
    tok, cache = Tokenizer(P.path("byte_bpe_50k.json")), f"{tmp_path}/cache"
    seen = []
    real = token_counts.count_texts
    monkeypatch.setattr(token_counts, "count_texts", lambda df, t: (seen.append(sorted(r.text for r in df.collect())), real(df, t))[1])
    first = spark.createDataFrame([(i, f"text {i % 3}") for i in range(30)], "doc_id bigint, text string")
    more = spark.createDataFrame([(i, f"text {i % 5}") for i in range(30)], "doc_id bigint, text string")
    assert token_counts.count_tokens(first, tok, cache).count() == 30
    assert token_counts.count_tokens(more, tok, cache).count() == 30
    assert token_counts.count_tokens(more, tok, cache).count() == 30
    assert seen == [["text 0", "text 1", "text 2"], ["text 3", "text 4"]]
    assert token_counts.cached_counts(spark, cache, tok).count() == 5
    # another tokenizer version does not see these counts
    other = Tokenizer(P.path("word_bpe_49k.json"))
    assert other.version != tok.version and token_counts.cached_counts(spark, cache, other).count() == 0
    # stored counts decide, and rows appended twice do not multiply documents
    token_counts.append_counts(token_counts.cached_counts(spark, cache, tok), cache, tok)
    assert token_counts.count_tokens(more, tok, cache).count() == 30


def test_white_space_runs_share_a_count_only_where_the_tokenizer_merges_them(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "a \n\t b")], "doc_id bigint, text string")
    for name, n in (("word_bpe_49k.json", 1), ("byte_bpe_50k.json", 2)):
        tok = Tokenizer(P.path(name))
        token_counts.count_tokens(docs, tok, f"{tmp_path}/cache").count()
        assert token_counts.cached_counts(spark, f"{tmp_path}/cache", tok).count() == n


def test_empty_table_and_few_misses(spark, odd_docs, empty_docs, tmp_path):
    tok, cache = Tokenizer(P.path("byte_bpe_50k.json")), f"{tmp_path}/cache"
    assert token_counts.count_tokens(empty_docs, tok, cache).count() == 0
    token_counts.count_tokens(odd_docs.filter("doc_id <> 4 or doc_id is null"), tok, cache).count()
    rows = token_counts.count_tokens(odd_docs, tok, cache).collect()  # one miss: its key is broadcast
    count = library_count("byte_bpe_50k.json")
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r.doc_id, count(r.text)) for r in odd_docs.collect())
    copies = spark.range(5000).select("id", F.lit("the same text").alias("t"))
    rows = token_counts.count_tokens(copies, tok, cache, "id", "t").groupBy("n_tokens").count().collect()
    assert [(r.n_tokens, r["count"]) for r in rows] == [(3, 5000)]
