"""Long texts by sections: the same results as of the whole text, in memory that doesn't grow with its words."""

import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_simhash import brute_fingerprint

from sentimill.llm import quality as q
from sentimill.llm import simhash as s
from sentimill.llm import toxicity as t
from sentimill.llm.common import word_sections

TEXTS = st.lists(st.sampled_from(["A", "bc", "é", "漢字", "\ud800", "x" * 9, " ", "\t\n", "\x0b", " ", " "]), max_size=40).map("".join)


def words_text(n, seed=0):
    rng = np.random.default_rng(seed)
    return " ".join(f"W{i}{'!' * int(i % 3)}" for i in rng.integers(0, 60, n))


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 12))
def test_sections_have_the_words_of_the_text(text, most):
    whole = text.encode("utf-8", "surrogatepass")
    assert [w for some in word_sections(text, most) for w in some] == whole.split()
    assert [w for some in word_sections(text, most, lower=True) for w in some] == whole.lower().split()


def test_a_word_longer_than_many_sections():
    text = "a " + "b" * 1000 + " c"
    assert [w for some in word_sections(text, 7) for w in some] == text.encode().split()
    assert list(word_sections(None)) == list(word_sections("")) == [[]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["A", "b", "cc", "é"]), max_size=25).map(" ".join), st.integers(1, 9))
def test_fingerprints_by_sections(text, section):
    old, s.SECTION = s.SECTION, section
    try:
        assert s.fingerprint(text) == brute_fingerprint(text)
    finally:
        s.SECTION = old


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["Good", "good", "BAD!!", "|", "x1"]), min_size=1, max_size=30).map(" ".join), st.integers(1, 20))
def test_quality_features_by_sections(text, section):
    places, values = q.training_row(1, text, {})[1:]
    weights = np.sin(np.arange(1 << q.BITS))
    model = q.Model(np.arange(1 << q.BITS), weights, 0.1)
    want = model.score([text, "", text + " more"], {})
    old, q.SLICE = q.SLICE, section
    try:
        again = q.training_row(1, text, {})
        assert (again[1] == places).all() and np.allclose(again[2], values)
        assert np.allclose(model.score([text, "", text + " more"], {}), want)
    finally:
        q.SLICE = old


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 100, 333, 1000])
@pytest.mark.parametrize("section", [1, 40, 333])
def test_passages_have_the_windows_of_the_text(monkeypatch, n, section):
    def windows_of(lists):
        out = set()
        for words in lists:
            _, first, size = t.windows(np.array([len(words)]))
            out |= {tuple(words[a:a + k]) for a, k in zip(first, size)}
        return out

    text = " ".join(f"w{i}" for i in range(n))
    want = windows_of([text.encode().split()])
    whole = t.score(t.new_weights(2), ["x y", text, None])
    monkeypatch.setattr(t, "SLICE", section)
    assert windows_of(t.passages(text)) == want
    assert np.allclose(t.score(t.new_weights(2), ["x y", text, None]), whole, atol=1e-6)


def test_network_equals_a_plain_loop_over_words():
    """Logits of windows, a word and a unit at a time, from the formulas of the gates and of attention."""
    p = t.new_weights(4)
    p["word"] = np.random.default_rng(1).normal(size=p["word"].shape).astype(np.float32) * 0.3
    words = [b"you", b"are", b"a", b"plain", b"example", b"you"]
    x = [t.embed(p, t.word_inputs([w]))[0][0].astype(float) for w in words]

    def sig(v):
        return 1 / (1 + np.exp(-v))

    def states(way, order):
        h, out, k = np.zeros(t.HIDDEN), {}, t.HIDDEN
        for i in order:
            g, u = x[i] @ p["W" + way] + p["b" + way], h @ p["U" + way]
            z, r = sig(g[:k] + u[:k]), sig(g[k:2 * k] + u[k:2 * k])
            new = np.tanh(g[2 * k:] + r * u[2 * k:])
            h = out[i] = (1 - z) * new + z * h
        return out

    forth, back = states("f", range(len(words))), states("b", reversed(range(len(words))))
    both = [np.concatenate([forth[i], back[i]]) for i in range(len(words))]
    e = np.array([np.tanh(v @ p["A"]) @ p["a"] for v in both])
    share = np.exp(e) / np.exp(e).sum()
    want = sig(sum(a * v for a, v in zip(share, both)) @ p["o"] + p["c"][0])
    assert np.isclose(t.score(p, [b" ".join(words).decode()])[0], want, atol=1e-5)


@pytest.mark.parametrize("run", [
    lambda text: s.fingerprint(text),
    lambda text: q.Model(np.arange(1 << q.BITS), np.ones(1 << q.BITS), 0.0).score([text], {}),
    lambda text: sum(len(words) for words in t.passages(text)),
], ids=["simhash", "quality", "toxicity"])
def test_memory_does_not_grow_with_a_text(monkeypatch, run):
    monkeypatch.setattr(s, "SECTION", 1 << 14)
    monkeypatch.setattr(s, "HASHES", 1 << 11)
    monkeypatch.setattr(q, "SLICE", 1 << 14)
    monkeypatch.setattr(t, "SLICE", 1 << 14)
    peaks = []
    for n in (20_000, 200_000):
        text = words_text(n)
        tracemalloc.start()
        run(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] + (1 << 20)
