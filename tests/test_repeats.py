"""Queries on events of which several share a series and a time, against their SQL twins."""

from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
from seriesforge.plans import catalog
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Two series every 20 minutes for three days; every seventh time is read three times, the last one is another value."""
    folder = tmp_path_factory.mktemp("repeated")
    rows, start = [], datetime(2024, 1, 29)
    for i in range(432):
        for copy in range(3 if i % 7 == 0 else 1):
            rows.append((start + timedelta(minutes=10 * i), 1 + i % 2, ("click", "view")[i % 2], float(i % 50 + 10 * copy), '{"k": %d}' % (i % 100)))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    frame = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], schema)
    frame.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["asof_lags", "metrics"])
def test_repeats_of_a_reading_count_once(spark, repeated, name):
    con = connect("/nowhere")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{repeated}/events.parquet/*.parquet'")
    assert compare(entry.queries()[name](spark, repeated), con, entry.oracle_sql()[name]) is None


def test_a_refresh_takes_narrower_buckets_where_readings_are_dense(spark, repeated, monkeypatch):
    widths, refresh = [], catalog.FT.refresh_features
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 60, raising=False)
    monkeypatch.setattr(catalog.FT, "refresh_features", lambda *a, **k: widths.append(k.get("cfg", catalog.FeatureConfig()).bucket_hours) or refresh(*a, **k))
    con = connect("/nowhere")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{repeated}/events.parquet/*.parquet'")
    assert compare(entry.queries()["incremental_refresh"](spark, repeated), con, entry.oracle_sql()["incremental_refresh"]) is None
    assert widths[0] < 96
