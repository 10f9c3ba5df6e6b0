"""The history while it is written, compacted and cut: readers see whole batches, one state at a time."""

import glob
import json
import os

import pytest

from sentimill import jobs
from sentimill.streaming import commits, scorer

STOP = ["the", "of"]


@pytest.fixture(scope="module")
def lists(spark):
    weights = spark.createDataFrame([("good", 0, 1.0), ("bad", 1, -1.0)], "term string, idx int, weight double")
    return weights, spark.createDataFrame([(w,) for w in STOP], "word string")


def put(spark, out, lists, epoch, *texts):
    rows = [(i, json.dumps({"created_at": "Mon Jan 01 00:00:01 +0000 2024", "lang": "en", "text": t, "user": {"screen_name": "u"}}))
            for i, t in enumerate(texts)]
    scorer.HistorySink(out, *lists)(scorer.incoming_tweets(spark.createDataFrame(rows, "key long, value string")), epoch)


def words(spark, out, n=None):
    return sorted((r["batch_id"], r["word"], r["n"]) for r in scorer.read_history(spark, out, scorer.WORDS_TABLE, n).collect())


def all_tables(spark, out):
    return {t: sorted(map(str, scorer.read_history(spark, out, t).select(*sorted(
        scorer.read_history(spark, out, t).columns)).collect())) for t in scorer.HISTORY_SCHEMAS}


def folders(out, table):
    return {os.path.dirname(f) for f in glob.glob(f"{out}/{table}/**/*.parquet", recursive=True)}


def test_a_batch_of_stop_words_leaves_the_last_words(spark, scratch, lists):
    out = f"{scratch}/h"
    put(spark, out, lists, 0, "good day", "good night")
    put(spark, out, lists, 1, "the of the")
    assert words(spark, out, 1) == [(0, "day", 1), (0, "good", 2), (0, "night", 1)]
    report = jobs.read_job(spark, out)
    assert {r["word"]: r["n"] for r in report["latest_words"].collect()} == {"day": 1, "good": 2, "night": 1}
    assert [r["volume"] for r in report["history_short"].orderBy("x").collect()] == [2, 1]     # it is in the other tables
    assert not [f for f in folders(out, scorer.WORDS_TABLE) if "batch_id=1" in f]


def test_a_batch_is_not_seen_before_its_record(spark, scratch, lists, monkeypatch):
    out = f"{scratch}/h"
    put(spark, out, lists, 0, "good")
    before = all_tables(spark, out)

    def crash(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(commits.CommitLog, "commit", crash)
    with pytest.raises(RuntimeError):
        put(spark, out, lists, 1, "bad day")
    monkeypatch.undo()
    assert len(folders(out, scorer.WORDS_TABLE)) == 2 and all_tables(spark, out) == before      # written, but nothing names it
    assert [r["volume"] for r in jobs.read_job(spark, out)["history_short"].collect()] == [1]
    put(spark, out, lists, 1, "bad day")                                                        # replayed
    assert words(spark, out, 1) == [(1, "bad", 1), (1, "day", 1)]
    assert scorer.read_history(spark, out, scorer.BATCHES_TABLE).count() == 2


def test_compaction_leaves_a_file_set_a_day_and_the_same_rows(spark, scratch, lists, monkeypatch):
    out = f"{scratch}/h"
    for epoch in range(4):
        put(spark, out, lists, epoch, f"good w{epoch}", "bad")
    before, newest = all_tables(spark, out), words(spark, out, 2)
    reader = scorer.read_history(spark, out, scorer.WORDS_TABLE)                                # a reader that is at work
    assert scorer.compact_history(spark, out) == 4
    assert all_tables(spark, out) == before and words(spark, out, 2) == newest
    days = {r["batch_date"] for r in scorer.read_history(spark, out, scorer.WORDS_TABLE).select("batch_date").collect()}
    assert len(scorer.read_history(spark, out, scorer.WORDS_TABLE).inputFiles()) == len(days)
    assert reader.count() == 12                                                                 # its files are still there
    put(spark, out, lists, 4, "good late")
    assert words(spark, out, 1) == [(4, "good", 1), (4, "late", 1)] and len(words(spark, out)) == 14
    assert len(words(spark, out, 3)) == 8                                                       # from the record and from the day
    before = all_tables(spark, out)
    calls = []
    monkeypatch.setattr(commits.CommitLog, "_put", lambda self, name, value: calls.append(name) or (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        scorer.compact_history(spark, out)                                                      # a crash before the switch
    monkeypatch.undo()
    assert calls and all_tables(spark, out) == before
    assert not os.listdir(f"{out}/_log/batch") == [] and scorer.compact_history(spark, out) == 1
    assert all_tables(spark, out) == before and scorer.compact_history(spark, out) == 0
    assert all_tables(spark, out) == before
    assert len(folders(out, scorer.WORDS_TABLE)) <= 2 * len(days)                               # the day's, and one of the crash
    put(spark, out, lists, 2, "replayed after compaction")
    assert all_tables(spark, out) == before


def test_a_reader_between_listing_and_switch_sees_one_state(spark, scratch, lists, monkeypatch):
    out = f"{scratch}/h"
    for epoch in range(3):
        put(spark, out, lists, epoch, f"w{epoch}")
    want = words(spark, out)
    real = commits.CommitLog._days
    busy = []

    def days(self):
        if not busy:                                       # compaction runs after the reader has listed the records
            busy.append(1)
            scorer.compact_history(spark, out)
        return real(self)

    monkeypatch.setattr(commits.CommitLog, "_days", days)
    assert words(spark, out) == want
    monkeypatch.undo()
    assert words(spark, out) == want


def test_retention_hides_at_once_and_deletes_later(spark, scratch, lists):
    out = f"{scratch}/h"
    for epoch in range(5):
        put(spark, out, lists, epoch, f"w{epoch}" if epoch != 3 else "the")
    scorer.retain(spark, out, scorer.WORDS_TABLE, 2)
    assert [w[0] for w in words(spark, out)] == [2, 4]                                          # batch 3 has no words
    assert scorer.read_history(spark, out, scorer.SENTIMENT_TABLE).count() == 5                 # a table at a time
    assert len(folders(out, scorer.WORDS_TABLE)) == 4
    scorer.retain(spark, out, scorer.WORDS_TABLE, 2)
    assert len(folders(out, scorer.WORDS_TABLE)) == 2 and [w[0] for w in words(spark, out)] == [2, 4]
    scorer.compact_history(spark, out)                                                          # reads no deleted folder
    assert [w[0] for w in words(spark, out)] == [2, 4] and words(spark, out, 9) == words(spark, out)
    scorer.retain(spark, out, scorer.WORDS_TABLE, 1)
    assert [w[0] for w in words(spark, out)] == [4] and scorer.read_history(spark, out, scorer.SENTIMENT_TABLE).count() == 5
    scorer.compact_history(spark, out)
    commits.CommitLog(spark, out).vacuum()
    assert [w[0] for w in words(spark, out)] == [4]
    scorer.reset_history(spark, out)
    assert words(spark, out) == [] and scorer.read_history(spark, out, scorer.BATCHES_TABLE).count() == 0


def test_another_query_does_not_write_over_a_batch(spark, scratch, lists):
    out = f"{scratch}/h"
    log = commits.CommitLog(spark, out)
    import datetime as dt
    log.commit(0, dt.datetime(2024, 1, 1), {}, "one")
    assert log.committed(0, "one") and log.committed(0) and not log.committed(1, "two")
    with pytest.raises(ValueError, match="another query"):
        log.committed(0, "two")
    scorer.compact_history(spark, out)
    with pytest.raises(ValueError, match="another query"):
        log.committed(0, "two")


def test_maintain_job(spark, scratch, lists):
    out = f"{scratch}/h"
    for epoch in range(3):
        put(spark, out, lists, epoch, f"w{epoch}")
    assert jobs.main(["maintain", "--history", out, "--retain", "2"]) == 0
    assert [w[0] for w in words(spark, out)] == [1, 2]
