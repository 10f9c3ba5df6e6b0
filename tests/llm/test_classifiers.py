from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentimill.llm import quality as q
from sentimill.llm import toxicity as t

#: sf0.01 has 45 toxic documents to learn from and 6 held out, too few for an accuracy; sf0.1 has about ten times as many.
SF = {"quality": "/root/testdata/sf0.01", "toxic": "/root/testdata/sf0.1"}


def labelled(spark, column):
    docs, labels = (spark.read.parquet(f"{SF[column]}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, {r.doc_id: r[column] for r in labels.collect()}


@pytest.mark.parametrize("model,column,folds,held,least", [(q, "quality", 3, 1, 0.97), (t, "toxic", 5, 0, 0.95)], ids=["quality", "toxic"])
def test_held_out_accuracy(spark, model, column, folds, held, least):
    docs, labels, truth = labelled(spark, column)
    rows = model.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    known = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(known) > 50 and np.mean([a == b for a, b in known]) >= least
    # the rarer label is found, too
    rare = min((0, 1), key=[b for _, b in known].count)
    assert np.mean([a == b for a, b in known if b == rare]) >= 0.8


@pytest.mark.parametrize("model,column", [(q, "quality"), (t, "toxic")], ids=["quality", "toxic"])
def test_odd_documents(spark, odd_docs, odd_rows, no_docs, model, column):
    labels = spark.createDataFrame([(3, 0), (3, 1), (5, 1), (6, 0), (7, None), (None, 1), (8, 1), (9, 0), (10, 1), (99, 1)], f"doc_id long, {column} int")
    rows = model.classify(odd_docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1        # null, empty and blank score alike
    assert model.classify(no_docs, labels).collect() == []
    none = model.classify(odd_docs, labels.limit(0)).collect()
    assert len(none) == len(odd_rows)
    # labels of the held-out fold are never learnt
    folds, held = model.FOLDS, model.HELD_OUT
    only = labels.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == held)
    again = model.classify(odd_docs, only.filter("doc_id is not null")).collect()
    assert sorted(r.score for r in again) == sorted(r.score for r in none)


def test_quality_stage_keeps_columns(spark, odd_docs):
    labels = spark.createDataFrame([(3, 1), (5, 1), (6, 0)], "doc_id long, quality int")
    out = q.keep_good(odd_docs, labels)
    kept = q.classify(odd_docs, labels).filter("predicted = 1")
    assert out.columns == odd_docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in kept.collect())


def test_ftrl_follows_the_plain_formula():
    """Against FTRL-proximal written out per coordinate."""
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(2)), np.append(np.sort(rng.choice(20, 4, replace=False)), 1 << q.BITS), np.append(rng.random(4), 1.0)) for _ in range(30)]
    got, bias = q.train(rows, epochs=1)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= q.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * q.L1) / ((q.BETA + n[i] ** 0.5) / q.ALPHA + q.L2)

    for r in np.random.default_rng(0).permutation(len(rows)):
        label, places, values = rows[r]
        w = {i: weight(i) for i in places}
        error = 1 / (1 + np.exp(-sum(w[i] * x for i, x in zip(places, values)))) - label
        for i, x in zip(places, values):
            g = error * x
            old = n.get(i, 0.0)
            n[i] = old + g * g
            z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - old ** 0.5) / q.ALPHA * w[i]
    assert np.allclose(got[:20], [weight(i) if i in z else 0 for i in range(20)])
    assert np.isclose(bias, weight(1 << q.BITS))


def test_score_is_the_sparse_product():
    texts = ["Good words here", "", "BAD!! BAD!! | x", "Good words here"]
    weights = np.random.default_rng(0).normal(size=1 << q.BITS)
    model = q.Model(np.arange(1 << q.BITS), weights, 0.3)
    for text, got in zip(texts, model.score(texts, {})):
        _, places, values = q.training_row(1, text, {})
        assert np.isclose(got, 1 / (1 + np.exp(-(weights[places[:-1]] @ values[:-1] + 0.3))))


def test_rows_held_in_training_are_small():
    texts = ["Good words here", "", "a " * 300, " ".join(f"w{i}" for i in range(5000))]
    rows = q.CompactRows()
    for k, text in enumerate(texts):
        rows.add(k % 2, text, {})
    held = sum(places.nbytes + counts.nbytes for _, places, counts, _ in rows.rows)
    assert held <= 6 * sum(len(places) for _, places, _, _ in rows.rows) + 100      # 16 bytes a feature before
    for k, text in enumerate(texts):
        (label, places, values), (again, same_places, same_values) = rows[k], q.training_row(k % 2, text, {})
        assert label == again and (places == same_places).all() and (values == same_values).all()
        place, _ = q.features([text.encode().split()], {})
        found, n = np.unique(place, return_counts=True)
        assert (places == np.append(found, 1 << q.BITS)).all()
        assert (values == np.append(n.astype(float) * (q.SCALE / max(len(text.split()), 1)), 1.0)).all()


def test_windows_cover_all_words():
    for n in [0, 1, t.WORDS - 1, t.WORDS, t.WORDS + 1, t.WORDS + t.STRIDE, 500]:
        _, first, size = t.windows(np.array([n]))
        assert set().union(*(range(a, a + k) for a, k in zip(first, size))) == set(range(n))
        assert all(b < a + t.WORDS or n <= t.WORDS for a, b in zip(first, first[1:]))       # windows overlap


def test_gradients_are_the_differences_of_the_loss():
    rng = np.random.default_rng(0)
    words = [b"alpha", b"be", b"gamma", b"d", b"epsilon"]
    code, sizes = rng.integers(0, 5, (3, 4)), np.array([4, 3, 1])
    labels = np.array([1.0, 0.0, 1.0])
    p = {k: v.astype(np.float64) for k, v in t.new_weights(3).items()}
    inputs = t.word_inputs(words)

    def loss(keep=None):
        x, _ = t.embed(p, inputs)
        x = x.astype(np.float64)
        logits = t.forward(p, (x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]), code, sizes, keep)
        return np.sum(np.logaddexp(0, np.where(labels > 0, -logits, logits))), logits, x

    keep = {}
    _, logits, x = loss(keep)
    grads, d_gates = t.backward(p, code, sizes, keep, t.sigmoid(logits) - labels, len(words))
    for way, d in zip("fb", d_gates):
        grads["W" + way] = x.T @ d
    for name in ("Uf", "Ub", "Wf", "Wb", "bf", "bb", "A", "a", "o", "c"):
        flat = p[name].reshape(-1)
        for i in rng.choice(len(flat), min(5, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()[0]
            flat[i] = old - 1e-3
            down = loss()[0]
            flat[i] = old
            assert np.isclose((up - down) / 2e-3, grads[name].reshape(-1)[i], rtol=0.02, atol=2e-3), name


def test_text_scores_as_its_highest_window():
    p = t.new_weights(5)
    words = [f"w{i}" for i in range(150)]
    _, first, size = t.windows(np.array([150]))
    each = t.score(p, [" ".join(words[a:a + n]) for a, n in zip(first, size)])
    assert np.isclose(t.score(p, ["x", " ".join(words), None])[1], each.max(), atol=1e-5)


def test_training_reads_every_window(monkeypatch):
    """A word in one place of a long text is learnt from in the first round, and is in reach of the later ones."""
    met, scored = set(), set()
    step, highest = t.Trainer.step, t.highest
    monkeypatch.setattr(t.Trainer, "step", lambda self, words, *rest: (met.update(words), step(self, words, *rest))[1])
    monkeypatch.setattr(t, "highest", lambda text, logits, label: (scored.add(len(logits)), highest(text, logits, label))[1], raising=False)
    long = [f"w{i}".encode() for i in range(4000)]
    t.train([(1, long), (0, [b"clean"] * 3)], steps=1)
    assert met >= set(long)
    assert scored == {len(t.windows(np.array([4000]))[0]) + 1}


def test_highest_windows_of_each_text():
    text, label = np.repeat([0, 1, 2], [100, 50, 1]), np.repeat([1, 0, 0], [100, 50, 1])
    logits = np.random.default_rng(0).random(151)
    got = t.highest(text, logits, label).tolist()
    want = [np.argmax(logits[:100]), *(100 + np.argsort(-logits[100:150])[:t.CLEAN_WINDOWS]), 150]
    assert sorted(got) == sorted(want)


def test_both_labels_weigh_the_same():
    label = np.array([1, 0, 0, 0, 0, 0])
    got = t.balanced(np.array([3.0, 1, 1, 2, 1, 1]), label)
    assert np.isclose(got[0], got[1:].sum()) and np.isclose(got.mean(), 1) and np.isclose(got[3], 2 * got[1])


def test_loss_weights_scale_the_gradient():
    words, code, sizes = [b"a", b"b"], np.array([[0], [1]]), np.array([1, 1])
    one, two = t.Trainer(), t.Trainer()
    one.step(words, code, sizes, np.array([1.0, 0.0]), np.array([2.0, 0.0]))
    two.step(words[:1], code[:1], sizes[:1], np.array([1.0]))
    assert np.allclose(one.m["o"], two.m["o"], atol=1e-7)


def test_toxic_accuracy_where_toxic_labels_are_rare(spark, monkeypatch):
    """sf0.01: 45 toxic documents to learn from, 6 held out."""
    monkeypatch.setitem(SF, "toxic", "/root/testdata/sf0.01")
    test_held_out_accuracy(spark, t, "toxic", 5, 0, 0.95)


def test_a_passage_of_half_a_window_lies_whole_in_one():
    for n in (20, 33, 49, 100, 500):
        _, first, size = t.windows(np.array([n]))
        for at in range(n - t.WORDS // 2 + 1):
            assert any(a <= at and at + t.WORDS // 2 <= a + k for a, k in zip(first, size))
