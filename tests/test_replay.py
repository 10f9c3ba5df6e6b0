"""Bounded capture, paced replay, subjects as term sets, stored wide rows, the model in JSON."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentimill.operators import model, wide
from sentimill.plans import catalog
from sentimill.sources import messages
from sentimill.streaming import replay, scorer

from tables_of_tests import SF_SMALL


def lines(spark, path, first, last, files=1):
    rows = spark.range(first, last).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("value"))
    messages.write_json_lines(rows.repartitionByRange(files, "key"), path)


def test_capture_keeps_exactly_n_over_batches_and_restarts(spark, scratch):
    src, out = f"{scratch}/m", f"{scratch}/c"
    lines(spark, src, 0, 40, files=4)                      # a file a micro-batch: 25 is in the middle of the third

    def stream():
        return scorer.replay_files(spark, src, 1)

    assert replay.capture(stream(), out, 25, trigger={"availableNow": True}) == 25
    first = sorted(r["key"] for r in replay.read_capture(spark, out).collect())
    assert len(first) == 25 == len(set(first))
    assert replay.capture(stream(), out, 25, trigger={"availableNow": True}) == 25            # does nothing
    assert replay.capture(stream(), f"{scratch}/few", 99, trigger={"availableNow": True}) == 40   # the stream ends first
    lines(spark, src, 40, 80, files=2)
    assert replay.capture(stream(), f"{scratch}/few", 60, trigger={"availableNow": True}) == 60   # a restart in the middle
    keys = sorted(r["key"] for r in replay.read_capture(spark, f"{scratch}/few").collect())
    assert len(set(keys)) == 60 and keys[:40] == list(range(40))


def test_a_live_capture_stops_by_itself(spark, scratch):
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 7).load()
             .select(F.col("value").alias("key"), F.concat(F.lit("v"), "value").alias("value")))
    assert replay.capture(ticks, f"{scratch}/c", 30, trigger={"processingTime": "0 seconds"}) == 30
    assert sorted(r["key"] for r in replay.read_capture(spark, f"{scratch}/c").collect()) == list(range(30))
    assert not spark.streams.active


def test_a_replayed_epoch_captures_the_same(spark, scratch, monkeypatch):
    sink = replay.CaptureSink(f"{scratch}/c", 5)
    batch = [spark.createDataFrame([(10 * e + i, "x") for i in range(3)], "key long, value string") for e in range(3)]
    sink(batch[0], 0)
    monkeypatch.setattr(replay.Counts, "put", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        sink(batch[1], 1)                                  # written, but its count is not
    monkeypatch.undo()
    assert sorted(r["key"] for r in replay.read_capture(spark, f"{scratch}/c").collect()) == [0, 1, 2]
    for e in (1, 2, 1):
        sink(batch[e], e)
    assert sorted(r["key"] for r in replay.read_capture(spark, f"{scratch}/c").collect()) == [0, 1, 2, 10, 11]


def test_a_stored_array_is_replayed_second_by_second(spark, scratch):
    """A JSON array arrives at 20 a second and gives the batch answer of every second."""
    v = catalog.Views(spark, SF_SMALL)
    rows = [json.loads(r["value"]) for r in messages.encode_messages(v.tweets.filter("batch_id < 4")).orderBy("key").collect()]
    with open(f"{scratch}/tweets.json", "w") as f:
        json.dump(rows, f)
    stored = replay.store_array(spark, f"{scratch}/tweets.json")
    assert [json.loads(r["value"])["text"] for r in spark.read.parquet(stored).orderBy("idx").collect()] == [r["text"] for r in rows]
    sink, seconds = scorer.HistorySink(f"{scratch}/h", catalog.written(v.weights), v.stop), []

    def each(batch, epoch):
        seconds.append((epoch, batch.count(), batch.agg(F.max(F.unix_millis("arrived"))).first()[0]))
        sink(scorer.incoming_tweets(batch.drop("arrived")), epoch)

    replay.replay_to_end(spark, stored, each, rate=20, checkpoint=f"{scratch}/ck", trigger={"processingTime": "0 seconds"})
    assert [s for s in seconds if s[1]] == [(k, 20, 1000 * k) for k in range(len(rows) // 20)]
    got = scorer.read_history(spark, f"{scratch}/h", scorer.SENTIMENT_TABLE).select("batch_id", "positive", "negative", "volume")
    want = catalog.q_sentiment_by_batch(spark, SF_SMALL).filter("batch_id < 4").select("batch_id", "positive", "negative", "volume")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_subjects_of_several_words(spark):
    docs = spark.createDataFrame([(1, ["big", "cats", "big"]), (2, ["cats"]), (3, None), (4, []), (5, ["cats", "are", "big"])],
                                 "doc_id long, tokens array<string>")
    subjects = messages.split_subjects(spark, "Big  Cats, dogs,,cats,big big , ")
    got = sorted((r["doc_id"], r["subject"]) for r in messages.track_subjects(docs, subjects).collect())
    both = "big  cats"
    assert got == sorted([(1, both), (1, "big big"), (1, "cats"), (2, "cats"), (5, both), (5, "big big"), (5, "cats")])


CELLS = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["f:x", "f:y", "g:z", "f:"]), st.sampled_from(["1", "2", None]),
                           st.integers(0, 2)), max_size=12)


@settings(max_examples=5, deadline=None)
@given(CELLS)
def test_wide_rows_hold_the_newest_version_of_every_cell(spark, tmp_path_factory, rows):
    path, want = str(tmp_path_factory.mktemp("wide") / "t"), {}
    for version in range(3):
        own = [r[:3] for r in rows if r[3] == version]
        for key, qualifier in {r[:2] for r in own}:
            values = [r[2] for r in own if r[:2] == (key, qualifier) and r[2] is not None]
            want[key, qualifier] = max(values, default=None)
        wide.put(spark.createDataFrame(own, "row_key string, qualifier string, value string"), path, version, shard_cells=1)
    table = wide.read_table(spark, path)
    got = {(r["row_key"], k): v for r in wide.read_rows(table).collect() for k, v in r["cells"].items()}
    assert got == want
    cells = {(r["row_key"], r["qualifier"]): r["value"] for r in wide.read_cells(table).collect()}
    assert {k: v for k, v in cells.items()} == want
    assert {r["qualifier"] for r in wide.read_cells(table, "g").collect()} <= {"g:z"}


def test_a_row_of_any_width_is_stored_in_shards(spark, scratch):
    cells = spark.range(5000).select(F.lit("r").alias("row_key"), F.concat(F.lit("q:"), "id").alias("qualifier"), F.col("id").cast("string").alias("value"))
    wide.put(cells, f"{scratch}/t", shard_cells=100)
    table = wide.read_table(spark, f"{scratch}/t")
    sizes = [r[0] for r in table.select(F.size("cells")).collect()]
    assert len(sizes) == 50 and max(sizes) < 200
    assert len(wide.get(table, "r").first()["cells"]) == 5000 and wide.get(table, "s").count() == 0


def test_model_in_json_round_trip(spark, scratch):
    terms = spark.createDataFrame([(f"t{i:02}", i, (i - 7) / 3) for i in range(15)], "term string, idx int, weight double")
    model.save_json_model(terms.repartition(4), 0.25, f"{scratch}/m")
    text = spark.read.text(f"{scratch}/m").collect()
    stored = json.loads(text[0][0])
    assert len(text) == 1 and stored["intercept"] == 0.25 and stored["weights"] == [(i - 7) / 3 for i in range(15)]
    weights, intercept = model.load_json_model(spark, f"{scratch}/m", terms.select("term", "idx"))
    assert intercept == 0.25 and weights.exceptAll(terms).isEmpty() and weights.count() == 15
    with open(f"{scratch}/plain.json", "w") as f:              # as another program writes it
        json.dump(stored, f, indent=1)
    again, _ = model.load_json_model(spark, f"{scratch}/plain.json", terms.select("term", "idx"))
    assert again.exceptAll(terms).isEmpty()
    with pytest.raises(ValueError, match="15 weights"):
        model.load_json_model(spark, f"{scratch}/m", terms.select("term", "idx").limit(3))
