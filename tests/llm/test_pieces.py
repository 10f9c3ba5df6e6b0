from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.llm import pieces as p


pytestmark = pytest.mark.filterwarnings("error::RuntimeWarning")      # a sum that is lost shows as one


@pytest.fixture(scope="module")
def codec():
    return p.Codec(p.model_path())


def ids_of(codec, text, key=0, seed=p.SEED):
    return codec.encode([text], np.array([key], np.int64), seed)[0].tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_lossless(codec, text):
    ids = ids_of(codec, text)
    assert codec.decode(ids) == text
    assert all(codec.likely[i] > 0 for i in ids) and bool(ids) == bool(text)


def test_long_and_odd_texts_are_lossless(codec):
    for text in ("a" * 5000, " " * 300, "\n\t\r\x00", "▁▁ ▁a", "🙂" * 200, "word " * 2000, "ab" * 700 + "é" * 700):
        assert codec.decode(ids_of(codec, text)) == text


def brute_segmentations(codec, data):
    """(pieces, weight) of every segmentation of the bytes of a part of ASCII letters."""
    if not data:
        return [((), 1.0)]
    out = []
    for n in range(1, len(data) + 1):
        for i, b in enumerate(codec.bytes_of):
            if b == data[:n] and codec.likely[i] > 0 and not (n == 1 and i in codec.byte_id):
                out += [((i, *rest), codec.likely[i] * w) for rest, w in brute_segmentations(codec, data[n:])]
    return out


def test_samples_follow_the_lattice(codec):
    """Drawn as often as the weights of all segmentations say."""
    every = brute_segmentations(codec, b" then")
    total, n = sum(w for _, w in every), 40_000
    drawn, ends = codec.encode(["then"] * n, np.arange(n, dtype=np.int64))
    found = Counter(tuple(x.tolist()) for x in np.split(drawn, ends[:-1]))
    assert set(found) <= {s for s, _ in every}
    for segmentation, w in every:
        share = w / total
        assert abs(found[segmentation] / n - share) <= 5 * (share * (1 - share) / n) ** 0.5 + 1e-4


def marginals(codec, data):
    """Chance of every edge (start, end, piece) of a part, by sums over all segmentations in exact fractions."""
    table = {}
    for i, b in enumerate(codec.bytes_of):
        if codec.likely[i] > 0 and len(b) <= codec.longest and i not in codec.byte_id:
            table.setdefault(b, i)
    covered, at = [], 0
    for c in data.decode():
        covered += [c.encode() in table] * len(c.encode())
    edges = []
    for end in range(1, len(data) + 1):
        if not covered[end - 1]:
            edges.append((end - 1, end, int(codec.byte_id[data[end - 1]])))
        for start in range(max(0, end - codec.longest), end):
            if data[start:end] in table:
                edges.append((start, end, table[data[start:end]]))
    weight = {i: Fraction(float(codec.likely[i])) for _, _, i in edges}
    before, after = [Fraction(0)] * (len(data) + 1), [Fraction(0)] * (len(data) + 1)
    before[0] = after[-1] = Fraction(1)
    for a, b, i in edges:                                                 # ascending by end
        before[b] += before[a] * weight[i]
    for a, b, i in sorted(edges, key=lambda e: -e[0]):
        after[a] += after[b] * weight[i]
    return {(a, b, i): float(before[a] * weight[i] * after[b] / before[-1]) for a, b, i in edges}


@pytest.mark.parametrize("mode", ["together", "alone"])
@pytest.mark.parametrize("text, choices", [
    ("kalimatuntawilat" * 8, 20), ("λόγος" * 24, 0), ("константинрани" * 10, 20), ("كتابالقلم" * 24, 20), ("数据漢获取か一个" * 20, 20),
    ("\U0001f642\U0001f680e" * 35, 0)], ids=["latin", "greek", "cyrillic", "arabic", "han", "emoji"])
def test_long_parts_follow_the_lattice(text, choices, mode, monkeypatch):
    """Every edge of over 100 characters without white space is drawn as often as all segmentations say."""
    monkeypatch.setattr(p, "LONG", 64 if mode == "alone" else 4096)
    flat = p.Codec(p.model_path(), alpha=0.0)                             # all segmentations alike
    n = 1500 if mode == "alone" else 4000
    drawn, ends = flat.encode([text] * n, np.arange(n, dtype=np.int64))
    chance, found = marginals(flat, b" " + text.encode()), Counter()
    for own in np.split(drawn, ends[:-1]):
        at = 0
        for i in own.tolist():
            found[at, at + len(flat.bytes_of[i]), i] += 1
            at += len(flat.bytes_of[i])
    assert found.keys() <= chance.keys()
    assert sum(0.05 < c < 0.95 for c in chance.values()) >= choices       # (of some scripts only single letters are pieces)
    for edge, share in chance.items():
        assert abs(found[edge] / n - share) <= 5.5 * (share * (1 - share) / n) ** 0.5 + 1e-3


def test_either_way_draws_alike(codec, monkeypatch):
    texts = ["plain words and كتابكتاب or " + "xéy" * 40, "λόγος" * 300]
    keys = np.arange(2, dtype=np.int64)
    want = codec.encode(texts, keys)[0]
    monkeypatch.setattr(p, "LONG", 8)
    got = codec.encode(texts, keys)[0]
    assert codec.decode(got[:len(got)].tolist()) == codec.decode(want.tolist())
    assert (got[:len(want)] == want[:len(got)]).mean() > 0.99             # but for the rounding of a share


def test_a_text_without_white_space_takes_a_few_bytes_a_byte(codec):
    import tracemalloc

    text = "".join(chr(0x600 + i * 7 % 90) for i in range(50_000))
    tracemalloc.start()
    ids = ids_of(codec, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert codec.decode(ids) == text and peak < 60 * len(text.encode())


def test_same_in_any_batch(codec):
    texts = [f"some words and more words {i} {'x' * i}" for i in range(50)]
    keys = np.arange(50, dtype=np.int64) * 31
    whole = codec.encode(texts, keys)[0].tolist()
    assert whole == [i for t, k in zip(texts, keys) for i in ids_of(codec, t, k)]
    assert whole != codec.encode(texts, keys, p.SEED + 1)[0].tolist()
    assert ids_of(codec, texts[9], 1) != ids_of(codec, texts[9], 2)


def test_large_alpha_prefers_few_pieces(codec):
    sharp, flat = p.Codec(p.model_path(), alpha=4.0), p.Codec(p.model_path(), alpha=0.2)
    texts, keys = ["the quick brown fox jumps over the lazy dog"] * 50, np.arange(50, dtype=np.int64)
    assert len(sharp.encode(texts, keys)[0]) < len(flat.encode(texts, keys)[0])


def test_odd_documents(odd_docs, odd_rows, no_docs):
    encoded = p.encode(odd_docs)
    rows = encoded.collect()
    assert all(r.lossless for r in rows)
    assert Counter((r.doc_id, r.pieces is None) for r in rows) == Counter((r.doc_id, r.text is None) for r in odd_rows)
    decoded = p.decode(encoded).collect()
    assert Counter((r.doc_id, r.text) for r in decoded) == Counter((r.doc_id, r.text) for r in odd_rows)
    assert p.encode(no_docs).collect() == []
