"""Every registered query with a SQL form equals its DuckDB oracle (sf0.001, plus a sf0.01 sample)."""

import pytest

from sentimill.plans import catalog, oracle
from sentimill.plans.compare import compare

from tables_of_tests import SF_MID, SF_SMALL

NAMES = [n for n in catalog.QUERIES if n in oracle.SQL]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, name):
    ok, msg = compare(spark, name, SF_SMALL)
    assert ok, msg


@pytest.mark.parametrize("name", ["word_count", "top_words_by_batch", "predict", "sentiment_by_batch",
                                  "backfill_word_counts", "word_cloud_long", "recent_tweets"])
def test_query_matches_oracle_mid(spark, name):
    ok, msg = compare(spark, name, SF_MID)
    assert ok, msg
