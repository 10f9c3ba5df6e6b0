"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text: its words, word pairs, and n-grams (1 to 3) of word shapes
(runs of lower-case letters, capitals and digits become one sign each; a word
equal to the one before is a repeat), hashed into 2^BITS places.  A place's value is
its share of the text's words, so long texts weigh no more than short ones and
whole texts are read (longer ones by sections, so a task's memory doesn't grow with a text's words).  A score is the sigmoid of the sparse dot product with the weights.

Training takes a bounded sample: of each label, the ``per_label`` labelled
documents (not of the held-out fold) with the smallest hash of their id.  It runs
in one task and returns the weights (2^BITS numbers), which go to every scoring
task.  Scoring is one pass over the documents without a shuffle.

Null texts count as empty: they have no feature but the bias and get a score like
any other.  Labels that are null don't count, and of several for a doc_id the
smallest does.  Without labelled rows every score is 0.5.  Repeated rows
are scored row by row; an empty table gives none.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import documents, fold, release_memory, slices, word_sections

BITS = 20
PER_LABEL = 3000
EPOCHS = 4
SCALE = 16.0                                        # a feature's value is SCALE times its share of the words
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.001         # FTRL: rate, its start, and the two penalties
FOLDS, HELD_OUT = 3, 1                              # held out: crc32(doc_id as text) mod 3 is 1
SLICE = 1 << 20                                     # bytes of a long text whose features are held at once
TOGETHER = 1 << 18                                  # bytes of shorter texts whose features are held at once
CONTEXT = 3                                         # words that a section's first features look back on
KNOWN_WORDS = 100_000                               # words whose hashes a worker remembers

SIGNS = bytes((ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c)
              for c in range(256))
RUNS = re.compile(rb"([aA0])\1+")
REPEAT = np.uint64(xxh64_intdigest(b"the word before"))
#: Odd factors that mix the hashes of an n-gram's parts, one for each kind of feature.
MIX = [np.uint64(xxh64_intdigest(b"kind %d" % k) | 1) for k in range(5)]


def word_hashes(word: bytes) -> bytes:
    """The hashes of the word and of its shape, as 16 bytes."""
    return struct.pack("=QQ", xxh64_intdigest(word.lower()), xxh64_intdigest(RUNS.sub(rb"\1", word.translate(SIGNS))))


def portions(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[bytes]], int]]:
    """(texts' numbers, their words, how many of these were there before): all texts of up to
    SLICE characters together, then each longer one by sections, led by the CONTEXT words before."""
    short = [i for i, t in enumerate(texts) if len(t or "") <= SLICE]
    yield short, [(texts[i] or "").encode("utf-8", "surrogatepass").split() for i in short], 0
    for i, t in enumerate(texts):
        if len(t or "") > SLICE:
            before: list[bytes] = []
            for section in word_sections(t, SLICE):
                yield [i], [before + section], len(before)
                before = (before + section)[-CONTEXT:]


def features(words: list[list[bytes]], known: dict, before: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(place, index in ``words``) of every feature occurrence that ends after the first ``before`` words (of one text)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    if len(known) > KNOWN_WORDS:
        known.clear()
    hashes = np.empty((total, 2), np.uint64)
    at = 0
    for w in words:
        for word in {*w}.difference(known):
            known[word] = word_hashes(word)
        if w:
            hashes[at:at + len(w)] = np.frombuffer(b"".join([known[x] for x in w]), np.uint64).reshape(-1, 2)
        at += len(w)
    text = np.repeat(np.arange(len(words)), sizes)
    word, shape = hashes[:, 0], hashes[:, 1].copy()
    same = (text[1:] == text[:-1])
    shape[1:][same & (word[1:] == word[:-1])] = REPEAT
    same2 = same[1:] & same[:-1]
    m, one, two, three = MIX, before, max(0, before - 1), max(0, before - 2)
    grams = [
        ((word * m[0])[one:], text[one:]),
        (((word[:-1] * m[1] + word[1:])[same] * m[1])[two:], text[1:][same][two:]),
        ((shape * m[2])[one:], text[one:]),
        (((shape[:-1] * m[3] + shape[1:])[same] * m[3])[two:], text[1:][same][two:]),
        ((((shape[:-2] * m[4] + shape[1:-1]) * m[4] + shape[2:])[same2] * m[4])[three:], text[2:][same2][three:]),
    ]
    place = np.concatenate([g >> np.uint64(64 - BITS) for g, _ in grams]).astype(np.int64)
    return place, np.concatenate([t for _, t in grams])


def train(rows: Sequence[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """FTRL-proximal over (label, places, values), shuffled by a fixed seed; returns (weights, bias)."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)     # the last place is the bias

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            label, places, values = rows[r]
            w = weights(places)
            error = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -30, 30))) - label
            g = error * values
            g2 = g * g
            z[places] += g - (np.sqrt(n[places] + g2) - np.sqrt(n[places])) / ALPHA * w
            n[places] += g2
    used = np.flatnonzero(np.abs(z) > L1)                           # the other weights are 0
    w = np.zeros(len(z))
    w[used] = weights(used)
    return w[:-1], float(w[-1])


def training_row(label: int, text: str, known: dict) -> tuple[int, np.ndarray, np.ndarray]:
    rows = CompactRows()
    rows.add(label, text, known)
    return rows[0]


class CompactRows(Sequence):
    """Rows of ``train``, which are all held at once, in 5 bytes a feature (6 in texts that hold one over 255 times, 8 over 65535)."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, np.ndarray, np.ndarray, float]] = []

    def add(self, label: int, text: str, known: dict) -> None:
        found, size = [], 0
        for _, words, before in portions([text]):
            found.append(np.unique(features(words, known, before)[0], return_counts=True))
            size += sum(map(len, words)) - before
        places, inverse = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([n for _, n in found]), minlength=len(places))
        few = np.min_scalar_type(int(counts.max(initial=0)))
        self.rows.append((label, places.astype(np.int32), counts.astype(few), SCALE / max(size, 1)))

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: int) -> tuple[int, np.ndarray, np.ndarray]:
        label, places, counts, value = self.rows[at]
        return label, np.append(places.astype(np.int64), 1 << BITS), np.append(counts.astype(np.float64) * value, 1.0)


class Model(NamedTuple):
    places: np.ndarray       # of the weights that aren't 0
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None], known: dict) -> np.ndarray:
        dense = known.get("weights")
        if dense is None:
            dense = np.zeros(1 << BITS)
            dense[self.places] = self.weights
        known["weights"] = dense
        total, size = np.zeros(len(texts)), np.zeros(len(texts))
        for own, words, before in portions(texts):
            place, owner = features(words, known.setdefault("words", {}), before)
            total[own] += np.bincount(owner, weights=dense[place], minlength=len(own))
            size[own] += np.fromiter(map(len, words), np.int64, len(words)) - before
        return 1.0 / (1.0 + np.exp(-np.clip(total * (SCALE / np.maximum(size, 1)) + self.bias, -30, 30)))


# ---- Spark ---------------------------------------------------------------------

def training_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(label, text, draw): at most ``per_label`` labelled documents of each label."""
    own = (labels.filter(F.col("quality").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
           .groupBy("doc_id").agg(F.min("quality").alias("label"))
           .withColumn("draw", F.xxhash64("doc_id")))
    drawn = None
    for label in (0, 1):                     # two ordered limits: per_label rows each
        some = own.filter(F.col("label") == label).orderBy("draw", "doc_id").limit(per_label)
        drawn = some if drawn is None else drawn.union(some)
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return (documents(docs).join(F.broadcast(drawn), "doc_id")
            .withColumn("nth", F.row_number().over(first)).filter("nth = 1")     # of rows with one id: one
            .select("label", "text", "draw"))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Train in one task on the bounded sample; only the weights that aren't 0 come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, known = CompactRows(), {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.add(label, text.as_py(), known)
        known.clear()
        weights, bias = train(rows)
        del rows
        release_memory()
        places = np.append(np.flatnonzero(weights), 1 << BITS)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(weights, bias)[places].astype(np.float64))],
                                         names=["place", "weight"])

    sample = training_sample(docs, labels, per_label).repartition(1).sortWithinPartitions("draw", "text")
    rows = sample.mapInArrow(run, "place long, weight double").collect()
    rows = [r for r in rows if r[0] < 1 << BITS], sum(r[1] for r in rows if r[0] == 1 << BITS)
    return Model(np.array([r[0] for r in rows[0]], np.int64), np.array([r[1] for r in rows[0]]), rows[1])


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` and a column ``__sm_score``."""
    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict = {}
        for column in texts:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            parts = [model.score(some.column(0).to_pylist(), known) for some in slices([batch], "text", TOGETHER)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0))
        known.clear()
        release_memory()

    return docs.withColumn("__sm_score", run(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """One row per document row: doc_id, held_out, score (of label 1), predicted."""
    return scored(documents(docs), fit(docs, labels, per_label)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("__sm_score").alias("score"),
        (F.col("__sm_score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """``docs`` without those that the classifier rejects (score under 0.5), all columns as they are."""
    return scored(docs, fit(docs, labels, per_label)).filter("__sm_score >= 0.5").drop("__sm_score")
