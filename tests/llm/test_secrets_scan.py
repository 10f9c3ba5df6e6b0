import hashlib
import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.llm import secrets_scan as s


def brute_base(text):
    """The contract, character by character: all runs, then drop the short ones."""
    found = [(m.start(), m.end(), "assign") for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[0], s.KINDS.index(x[2])))


PARTS = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "=", ": ", ' = "', "'", '"', "abcde", "abcdef", "AKIA", "AKIA" + "Z" * 16,
         "0123456789abcdef", "deadbeef" * 3, " ", "é", "\n", "ſecret", "toKen", "K", "."]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_patterns(text):
    base, spans = s.scan(text)
    assert base == brute_base(text)
    assert [x for x in spans if x[2] != "entropy"] == base


def entropy(text):
    return -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcd0123", max_size=60), st.integers(4, 12), st.floats(0.5, 3.0))
def test_windows_equal_brute_force(text, window, bits):
    held = set()
    for a in range(len(text) - window + 1):
        if entropy(text[a:a + window]) >= bits - 1e-9:
            held |= set(range(a, a + window))
    got = set()
    for a, b in s.high_windows(text, window, bits + 1e-6):
        got |= set(range(a, b))
    more = set()
    for a, b in s.high_windows(text, window, bits - 1e-6):
        more |= set(range(a, b))
    assert got <= held <= more


def test_entropy_finds_what_the_patterns_miss():
    key = "tG7kQ2vXz9LmB4wRy8Pc1NdF"
    for text in (f"use {key} here", f"é漢 {key}"):
        (a, b, kind), = s.scan(text)[1]
        assert kind == "entropy" and text[a:b] in key and b - a >= 20


@pytest.mark.parametrize("text", [
    "uuid 3f2b8c1d-9a4e-4f6b-8d7c-1e2a3b4c5d6e", "sha256: 3F2B8C1D9A4E4F6B8D7C1E2A3B4C5D6E", "key ExampleKey7kQ2vXz9LmB4wRy8",
    "plainlowercasewordsthatarelongbutnotsecret", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"])
def test_allow_list(text):
    assert s.scan(text)[1] == []


@pytest.mark.parametrize("text", [
    "for example {}", "bearer {} samples", "dummy {}", "GET /api/v1/keys/{}", "/usr/local/lib {}", "https://host/a/b/c {}", "abcdefghij {}",
    "3f2b8c1d-9a4e-4f6b-8d7c-1e2a3b4c5d6e {}", "{} 3f2b8c1d-9a4e-4f6b-8d7c-1e2a3b4c5d6e", "example/{}", "{}-sample", "/samples/{}"])
@pytest.mark.parametrize("key", ["tG7kQ2vXz9LmB4wRy8Pc1NdF", "tG7kQ2vXz9-LmB4wRy8Pc_1NdFh5J"])
def test_neighbours_do_not_hide_a_secret(text, key):
    spans = s.scan(text.format(key))[1]
    start = text.index("{}")
    assert [k for _, _, k in spans] == ["entropy"]
    assert spans[0][0] <= start and spans[0][1] >= start + len(key)


@pytest.mark.parametrize("key", [
    "k7q2w9zx4m1t8r3v6y0p5n2j7h4g9s1d", "x3z9q1w7k5m2v8t4y6rh", "MZXW6YTBOI2KQ4TPJRSG5VLU3NHWC7DE", "JBSWY3DPEHPK3PXPQ7ZL",
    "tGkQvXzLmBwRyPcNdFhJsZqWnKeUaYpC", "k7q2w-9zx4m1_t8r3v6y0-p5n2j7h4g9"])
def test_keys_without_all_three_sorts_of_characters(key):
    (a, b, kind), = s.scan(f"bearer {key} here")[1]
    assert kind == "entropy" and "bearer "[a:] == "" and b - a >= len(key) - 4


@pytest.mark.parametrize("text", ["some-article-title-2019-part-2-of-3", "AbstractSingletonProxyFactoryBean", "/srv/data/2019/part0001/raw",
                                  "ONE_LONG_CONSTANT_NAME_OF_2019", "12345678901234567890", "3f2b8c1d-9a4e-4f6b-8d7c-1e2a3b4c5d6e"])
def test_names_are_not_keys(text):
    assert s.scan(f"see {text} here")[1] == []


def test_base_spans_are_never_suppressed():
    text = 'password = "example_0123456789"'
    assert s.scan(text) == (brute_base(text),) * 2 and len(brute_base(text)) == 1


def test_odd_documents(odd_docs, odd_rows, no_docs):
    rows = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in s.scan_secrets(odd_docs).collect())
    want = Counter()
    for r in odd_rows:
        base = brute_base(r.text or "")
        kinds = Counter(k for _, _, k in base)
        want[r.doc_id, kinds["assign"], kinds["access"], kinds["hex"],
             hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()] += 1
    assert rows == want and s.scan_secrets(no_docs).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = s.scan_secrets(docs).collect()
    assert sum(r.n_assign + r.n_access + r.n_hex for r in found) > 10
    for r in found:
        assert r.base_sha256 == hashlib.sha256(s.joined(brute_base(texts[r.doc_id])).encode()).hexdigest()
