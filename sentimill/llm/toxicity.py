"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is the sum of a hashed word embedding and of hashed embeddings of its
character n-grams (3 and 5 bytes, the word's ends marked).  Both directions read a window
of words; attention weighs their states into one vector, and a logistic unit scores
it.  A text is read whole, in overlapping windows, and scores as its highest window.

Training takes a bounded sample: of each label, the ``per_label`` labelled documents (not of
the held-out fold) with the smallest hash of their id, and every window of each.  The first
round learns from all of them under the document's label, each document weighing the same; the later
ones from a toxic document's highest window and a clean one's CLEAN_WINDOWS highest (a
toxic text has toxic words in some window, a clean one in none), of all its windows.  Both labels
weigh the same in every round, however rare one is.  It runs in one task and returns the weights (4 MB),
which go to every scoring task.  Scoring is one pass over the documents, without a shuffle.

Null and empty texts are one empty window and score like any other text.  Null labels
don't count, and of several for a doc_id the smallest does.  Without labelled rows
of both labels every score is below 0.5 (nothing is known to be toxic).  Repeated rows are
scored row by row; an empty table gives none.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, fold, slices, word_sections

WORDS, STRIDE = 32, 16                  # words of a window, and from one window's start to the next
EMBED, HIDDEN, ATTEND = 16, 12, 8
WORD_ROWS, GRAM_ROWS = 1 << 14, 1 << 15
GRAMS = (3, 5)
PER_LABEL = 1500
STEPS = 750                             # batches learnt from after the first round; a sample that is smaller is gone through more often
PICKED = 94                             # batches at least from one choice of the highest windows to the next (a pass over a full sample)
CLEAN_WINDOWS = 3
BATCH, FIRST_BATCH = 64, 256            # windows of a batch; in the first round, which has all windows
RATE, EMBED_RATE = 0.01, 0.05
FOLDS, HELD_OUT = 5, 0                  # held out: crc32(doc_id as text) mod 5 is 0
TOGETHER = 2048                         # windows scored together
EMBEDDED = 1 << 16                      # words embedded together
SLICE = 4 << 20                         # characters of text whose words are held together


# ---- words ------------------------------------------------------------------------

def words_of(text: str | None) -> Iterator[bytes]:
    return (word for section in word_sections(text, lower=True) for word in section)


def passages(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, a long one's in overlapping passages that together have the windows of the whole."""
    held: list[bytes] = []
    for section in word_sections(text, SLICE, lower=True):
        if len(held) > WORDS:                            # a section more: what is held ends with a window in its place
            end = len(held) - (len(held) - WORDS) % STRIDE
            yield held[:end]
            held = held[end - WORDS:]
        held = held + section
    yield held


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the word embedding, rows of the n-gram embeddings, word of each n-gram), hashed."""
    line = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    factor = np.uint64(0x9E3779B97F4A7C15)
    run = np.arange(len(line)) - first[word]
    power = (run + 1).astype(np.uint64) * factor
    whole = np.add.reduceat((line + np.uint64(7)) * _mix(power), first) if len(words) else np.empty(0, np.uint64)
    rows, owners = [], []
    for n in GRAMS:
        if len(line) < n:
            continue
        code = np.zeros(len(line) - n + 1, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + line[k:len(line) - n + 1 + k]
        same = word[:len(code)] == word[n - 1:]
        rows.append((_mix(code[same] * np.uint64(n)) >> np.uint64(20)) % np.uint64(GRAM_ROWS))
        owners.append(word[:len(code)][same])
    gram = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.argsort(owner, kind="stable")
    return ((_mix(whole) >> np.uint64(20)) % np.uint64(WORD_ROWS)).astype(np.int64), gram[order], owner[order]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in the text, words) of every window of texts with so many words."""
    counts = 1 + np.maximum(0, -(-(sizes - WORDS) // STRIDE))
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.minimum(nth * STRIDE, np.maximum(sizes[text] - WORDS, 0))
    return text, first, np.minimum(sizes[text], WORDS)


# ---- the network --------------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    out = {"word": np.zeros((WORD_ROWS, EMBED), np.float32), "gram": draw(GRAM_ROWS, EMBED, scale=0.01)}
    for way in "fb":
        out |= {f"W{way}": draw(EMBED, 3 * HIDDEN, scale=EMBED ** -0.5), f"U{way}": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5),
                f"b{way}": np.zeros(3 * HIDDEN, np.float32)}
    return out | {"A": draw(2 * HIDDEN, ATTEND, scale=(2 * HIDDEN) ** -0.5), "a": draw(ATTEND, scale=1.0),
                  "o": draw(2 * HIDDEN, scale=0.3), "c": np.full(1, -1.0, np.float32)}


def embed(p: dict, inputs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(input vector of each word, factor of its n-grams)."""
    word, gram, owner = inputs
    n = np.bincount(owner, minlength=len(word))
    part = np.zeros((len(word), EMBED), np.float32)
    if len(gram):
        some = np.flatnonzero(n)
        part[some] = np.add.reduceat(p["gram"][gram], np.cumsum(n[some]) - n[some], axis=0)
    factor = (1 / np.sqrt(np.maximum(n, 1))).astype(np.float32)
    return p["word"][word] + part * factor[:, None], factor


def _read(x: np.ndarray, code: np.ndarray, sizes: np.ndarray, recurrent: np.ndarray, back: bool, keep: list | None) -> np.ndarray:
    """States (step, window, HIDDEN) of one direction; windows are sorted by size, the longest first.

    ``x``: each word's part of the gates; ``code`` (window, WORDS): words.
    """
    states = np.zeros((code.shape[1], len(code), HIDDEN), np.float32)
    h = np.zeros((len(code), HIDDEN), np.float32)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -t, "left"))                 # windows that are longer than t
        at = sizes[:n] - 1 - t if back else np.full(n, t)
        g = x[code[np.arange(n), at]]
        u = h[:n] @ recurrent
        zr = g[:, :2 * HIDDEN] + u[:, :2 * HIDDEN]
        np.negative(zr, out=zr)
        np.clip(zr, -30, 30, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        new = np.tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        if keep is not None:
            keep.append((n, at, h[:n].copy(), z, r, new, u[:, 2 * HIDDEN:]))
        h[:n] = new + z * (h[:n] - new)
        states[at, np.arange(n)] = h[:n]
    return states


def forward(p: dict, gates: tuple[np.ndarray, np.ndarray], code: np.ndarray, sizes: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logit of each window (sorted by size, the longest first)."""
    forth = _read(gates[0], code, sizes, p["Uf"], False, None if keep is None else keep.setdefault("f", []))
    back = _read(gates[1], code, sizes, p["Ub"], True, None if keep is None else keep.setdefault("b", []))
    states = np.concatenate([forth, back], axis=2)                   # (step, window, 2 HIDDEN)
    seen = np.tanh(states @ p["A"])
    e = seen @ p["a"]
    e[np.arange(code.shape[1])[:, None] >= sizes[None, :]] = -np.inf
    e -= np.where(sizes > 0, e.max(axis=0), 0)
    weight = np.exp(e)
    weight /= np.maximum(weight.sum(axis=0), 1e-30)
    pooled = np.einsum("tn,tnh->nh", weight, states)
    if keep is not None:
        keep |= {"states": states, "seen": seen, "weight": weight, "pooled": pooled}
    return pooled @ p["o"] + p["c"][0]


def backward(p: dict, code: np.ndarray, sizes: np.ndarray, keep: dict, error: np.ndarray, n_words: int) -> tuple[dict, tuple]:
    """Gradients of the dense weights, and of both directions' gates by word; ``error``: of the logits."""
    grads = {"o": keep["pooled"].T @ error, "c": error.sum(keepdims=True)}
    d_pooled = error[:, None] * p["o"]
    weight, states, seen = keep["weight"], keep["states"], keep["seen"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
    d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grads["a"] = np.einsum("tn,tnk->k", d_e, seen)
    d_seen = d_e[:, :, None] * p["a"] * (1 - seen * seen)
    grads["A"] = np.einsum("tnh,tnk->hk", states, d_seen)
    d_states = d_states + d_seen @ p["A"].T
    d_gates = []
    for way, part in (("f", d_states[:, :, :HIDDEN]), ("b", d_states[:, :, HIDDEN:])):
        d_x = np.zeros((n_words, 3 * HIDDEN), np.float32)
        d_u = np.zeros_like(p["U" + way])
        d_h = np.zeros((len(code), HIDDEN), np.float32)
        for n, at, h, z, r, new, un in reversed(keep[way]):
            g = d_h[:n] + part[at, np.arange(n)]
            d_new = g * (1 - z) * (1 - new * new)
            d_z = g * (h - new) * z * (1 - z)
            d_r = d_new * un * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_new], axis=1)
            d_rec = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_u += h.T @ d_rec
            d_h[:n] = g * z + d_rec @ p["U" + way].T
            np.add.at(d_x, code[np.arange(n), at], d_g)
        grads["U" + way], grads["b" + way] = d_u, d_x.sum(axis=0)
        d_gates.append(d_x)
    return grads, tuple(d_gates)


class Trainer:
    def __init__(self, seed: int = 0):
        self.p = new_weights(seed)
        self.m = {k: np.zeros_like(v) for k, v in self.p.items() if k not in ("word", "gram")}
        self.v = {k: np.zeros_like(v) for k, v in self.m.items()}
        self.past = {"word": np.full(WORD_ROWS, 1e-6, np.float32), "gram": np.full(GRAM_ROWS, 1e-6, np.float32)}
        self.steps = 0

    def step(self, words: list[bytes], code: np.ndarray, sizes: np.ndarray, labels: np.ndarray,
             weights: np.ndarray | float = 1.0) -> float:
        p = self.p
        inputs = word_inputs(words)
        x, factor = embed(p, inputs)
        keep: dict = {}
        logits = forward(p, (x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]), code, sizes, keep)
        error = (weights * (sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        grads, d_gates = backward(p, code, sizes, keep, error, len(words))
        d_word = np.zeros_like(x)
        for way, d_x in zip("fb", d_gates):
            grads["W" + way] = x.T @ d_x
            d_word += d_x @ p["W" + way].T
        self.steps += 1
        for k, g in grads.items():                                  # Adam
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            p[k] -= RATE * (self.m[k] / (1 - 0.9 ** self.steps)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.steps)) + 1e-8)
        word, gram, owner = inputs
        for name, rows, g in (("word", word, d_word), ("gram", gram, (d_word * factor[:, None])[owner])):
            places, inverse = np.unique(rows, return_inverse=True)  # Adagrad on the rows met
            total = np.zeros((len(places), EMBED), np.float32)
            np.add.at(total, inverse, g)
            self.past[name][places] += (total * total).mean(axis=1)
            p[name][places] -= EMBED_RATE * total / np.sqrt(self.past[name][places])[:, None]
        return float(np.mean(np.logaddexp(0, np.where(labels > 0, -logits, logits))))


def train(rows: Iterable[tuple[int, Iterable[bytes]]], steps: int = STEPS, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights from (label, words of the text); of a text its words' numbers are held, not the words."""
    trainer, rng = Trainer(seed), np.random.default_rng(seed)
    known: dict[bytes, int] = {}
    labels, numbers = [], []
    for label, words in rows:
        labels.append(label)
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32))
    if len(set(labels)) < 2:
        return trainer.p
    codes = np.concatenate([*numbers, np.zeros(WORDS, np.int32)])
    vocabulary = list(known) or [b""]
    sizes = np.array([len(own) for own in numbers], np.int64)
    text, first, size = windows(sizes)
    start = (np.cumsum(sizes) - sizes)[text] + first
    label = np.array(labels)[text]

    def learn(chosen: np.ndarray, weights: np.ndarray, batch: int) -> None:
        order = rng.permutation(len(chosen))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            some = some[np.argsort(-size[chosen[some]], kind="stable")]          # the longest first
            own = chosen[some]
            met, inverse = np.unique(codes[start[own][:, None] + np.arange(WORDS)], return_inverse=True)
            trainer.step([vocabulary[i] for i in met], inverse.reshape(len(own), WORDS), size[own],
                         label[own].astype(np.float32), weights[some])

    learn(np.arange(len(text)), balanced(1 / np.bincount(text)[text], label), FIRST_BATCH)
    until = trainer.steps + steps
    while trainer.steps < until:                                     # each document's highest windows
        chosen = highest(text, _logits(trainer.p, _gates(trainer.p, vocabulary), codes, start, size), label)
        again = min(until, trainer.steps + PICKED)
        while trainer.steps < again:
            learn(chosen, balanced(np.ones(len(chosen)), label[chosen]), BATCH)
    return trainer.p


def balanced(weights: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``weights`` scaled so that either label has half of their sum, and their mean is 1."""
    total = np.bincount(label, weights, minlength=2)
    return weights * (len(weights) / (2 * total))[label]


def highest(text: np.ndarray, logits: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The windows to learn from: the highest of each toxic text, the CLEAN_WINDOWS highest of each clean one."""
    order = np.lexsort((-logits, text))
    counts = np.bincount(text)
    rank = np.arange(len(text)) - (np.cumsum(counts) - counts)[text[order]]
    return order[rank < np.where(label[order] > 0, 1, CLEAN_WINDOWS)]


def _gates(p: dict, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each word's part of the gates of both directions, from EMBEDDED words at a time."""
    found = [embed(p, word_inputs(words[at:at + EMBEDDED]))[0] for at in range(0, len(words), EMBEDDED)]
    x = np.concatenate(found)
    return x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]


def _logits(p: dict, gates: tuple[np.ndarray, np.ndarray], codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logit of every window, TOGETHER of them at a time; ``codes`` has WORDS more at its end."""
    out = np.empty(len(size))
    order = np.argsort(-size, kind="stable")
    for at in range(0, len(order), TOGETHER):
        some = order[at:at + TOGETHER]
        out[some] = forward(p, gates, codes[start[some][:, None] + np.arange(WORDS)[None, :]], size[some])
    return out


def score(p: dict, texts: list[str | None]) -> np.ndarray:
    """Probability of each text: its highest window's."""
    best = np.full(len(texts), -np.inf)
    together: list[tuple[int, list[bytes]]] = []
    held = 0
    for i, t in enumerate(texts):
        size = min(len(t or ""), SLICE)
        for words in passages(t):
            if together and held + size > SLICE:
                _raise_to(best, p, together)
                together, held = [], 0
            together.append((i, words))
            held += size
    if together:
        _raise_to(best, p, together)
    return sigmoid(best)


def _raise_to(best: np.ndarray, p: dict, together: list[tuple[int, list[bytes]]]) -> None:
    """Raise ``best`` of each text to the highest logit of the windows of its words."""
    owner, words = np.array([i for i, _ in together]), [w for _, w in together]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = [w for own in words for w in own]
    codes, known = pd.factorize(np.array(flat, dtype=object)) if flat else (np.zeros(0, np.int64), [])
    codes = np.append(codes, np.zeros(WORDS, codes.dtype))           # windows may be padded past the end
    gates = _gates(p, list(known)) if flat else (np.zeros((1, 3 * HIDDEN), np.float32),) * 2
    text, first, size = windows(sizes)
    np.maximum.at(best, owner[text], _logits(p, gates, codes, (np.cumsum(sizes) - sizes)[text] + first, size))


# ---- Spark ---------------------------------------------------------------------

def training_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(label, text, draw): at most ``per_label`` labelled documents of each label."""
    own = (labels.filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
           .groupBy("doc_id").agg(F.min("toxic").alias("label"))
           .withColumn("draw", F.xxhash64("doc_id")))
    drawn = None
    for label in (0, 1):                                             # two ordered limits: per_label rows each
        some = own.filter(F.col("label") == label).orderBy("draw", "doc_id").limit(per_label)
        drawn = some if drawn is None else drawn.union(some)
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return (documents(docs).join(F.broadcast(drawn), "doc_id")
            .withColumn("nth", F.row_number().over(first)).filter("nth = 1")
            .select("label", "text", "draw"))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> dict[str, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((label, words_of(text.as_py())) for batch in batches
                for label, text in zip(batch.column(0).to_pylist(), batch.column(1)))
        held = io.BytesIO()
        np.savez(held, **train(rows))
        yield pa.RecordBatch.from_arrays([pa.array([held.getvalue()], pa.binary())], names=["weights"])

    sample = training_sample(docs, labels, per_label).repartition(1).sortWithinPartitions("draw", "text")
    rows = sample.mapInArrow(run, "weights binary").collect()            # none, if there is nothing to learn from
    return dict(np.load(io.BytesIO(bytes(rows[0][0])))) if rows else new_weights()


def classify(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """One row per document row: doc_id, held_out, score (of label 1), predicted."""
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            found = score(weights.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return (documents(docs).mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
