from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.llm import token_counts as t


@pytest.fixture(scope="module")
def counter():
    return t.Counter(t.model_path())


def brute(counter, text):
    return len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


ODD = st.lists(st.sampled_from(list("aZ9!'. \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　​éß你🙂<|>") + ["<|endoftext|>", "'re", "  "]), max_size=60).map("".join)


@settings(max_examples=500, deadline=None)
@given(ODD)
def test_equals_the_library(counter, text):
    assert counter.count([text])[0] == brute(counter, text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(counter, text):
    assert counter.count([text])[0] == brute(counter, text)


def test_windows_of_long_texts(counter, monkeypatch):
    monkeypatch.setattr(t, "WINDOW", 7)
    for text in ("a  b   c\n\nd " * 50, "!\xa0! " * 30, "x" * 100, "<|endoftext|> <|endoftext|>\n" * 20):
        assert counter.count([text])[0] == brute(counter, text)


def test_full_memory_of_pieces(counter, monkeypatch):
    monkeypatch.setattr(t, "KNOWN", 0)
    texts = ["new words here", "and new words there"]
    assert counter.count(list(texts)).tolist() == [brute(counter, x) for x in texts]


def test_odd_documents(counter, odd_docs, odd_rows, no_docs):
    got = Counter(map(tuple, t.token_counts(odd_docs, limit=100).collect()))
    counts = [(r.doc_id, len((r.text or "").encode()), brute(counter, r.text or "")) for r in odd_rows]
    assert got == Counter((*c, c[2] > 100) for c in counts)
    assert t.token_counts(no_docs).collect() == []


def test_whole_table(spark, counter):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in t.token_counts(docs).collect():
        assert (r.n_tokens, r.over_limit) == (n := brute(counter, texts[r.doc_id] or ""), n > 512)
