"""What the replays store of their state: every slice is a start, which must not repeat all before."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from burstline.plans import table_queries

EVENTS = (
    "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double, props string"
)


@pytest.mark.parametrize("name", ["stream_state", "stream_deduplicated"])
def test_a_start_applies_no_earlier_changes_again(spark, tmp_path, monkeypatch, name):
    tables, folder = tmp_path / "tables", tmp_path / "run"
    begin = datetime(2024, 1, 1)
    rows = [(n, n % 5, "view", begin + timedelta(hours=n), 1.0, "{}") for n in range(200)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tables}/events.parquet")
    accounts = {
        "customer": "c_custkey bigint, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_acctbal double, s_nationkey int",
    }
    for account, columns in accounts.items():
        spark.createDataFrame([], columns).write.parquet(f"{tables}/{account}.parquet")
    monkeypatch.setattr(table_queries, "run_folder", lambda spark, name: str(folder))
    assert table_queries.registered()[name](spark, str(tables)).collect()
    state = [p.name for p in Path(folder, "checkpoint", "state").rglob("*") if p.is_file()]
    assert any(p.endswith(".zip") for p in state)
    assert not any(p.endswith(".changelog") for p in state)
